"""Instalment ids, the run from feeds to cash flow, and postings that arrive after a close."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cashloom.operators import schedule
from cashloom.operators.cashflow import repair_balances, with_repairs
from cashloom.operators.schedule import reserve_ids
from cashloom.plans.cash import RunState, cashflow_close, cashflow_initial, cashflow_late_postings
from cashloom.plans.schedules import numbered_payables, payables_schedule
from cashloom.presets import term_table
from workload.frames import Frames
from workload.queries import whole_cycle

FOLDER = "/root/testdata/sf0.001"
INVOICE = "ID_NF_ENTRADA long, ID_CONDICAO int, DATA_EMISSAO date, VALOR_TOTAL decimal(16,2)"
PLAN = "ID_PROG_PAGAMENTO long, ID_NF_ENTRADA long, DATA_VENCIMENTO date, NUM_PARCELAS int, VALOR_PARCELA decimal(16,2), STATUS_PAGAMENTO int"


@pytest.mark.parametrize("per_range", [1, 7, 1 << 16])
def test_reserved_ids_are_dense_in_key_order(spark, monkeypatch, per_range):
    monkeypatch.setattr(schedule, "RANGE_ROWS", per_range)
    rng = random.Random(per_range)
    keys = rng.sample(range(10**6), 60) + [10**12, 10**12 + 1, -50]
    lines = [(k, rng.randrange(0, 5)) for k in keys] + [(10**12, 3)]
    frame = spark.createDataFrame(lines, "k long, n int").repartition(5)
    found = sorted((r.k, r.first, r.n) for r in reserve_ids(frame, "k", F.col("n"), "first", start_after=100, ties=["n"]).collect())
    ahead = 100
    for k, first, n in sorted(found, key=lambda r: (r[0], r[2])):
        assert first == ahead + 1
        ahead += n


def test_ranges_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(schedule, "RANGE_ROWS", 1)
    monkeypatch.setattr(schedule, "MOST_RANGES", 4)
    frame = spark.range(1000).withColumn("n", F.lit(2))
    assert sorted(r.first for r in reserve_ids(frame, "id", F.col("n"), "first").collect()) == list(range(1, 2001, 2))


def test_no_rows_and_a_table_to_start_after(spark):
    frame = spark.createDataFrame([], "k long, n int")
    assert reserve_ids(frame, "k", F.col("n"), "first").count() == 0
    used = spark.createDataFrame([(40,), (7,)], "id long")
    some = spark.createDataFrame([(5, 2), (6, 1)], "k long, n int")
    assert [(r.k, r.first) for r in reserve_ids(some, "k", F.col("n"), "first", start_after=used, id_column="id").orderBy("k").collect()] == [(5, 41), (6, 43)]


def test_numbered_schedule_is_the_schedule_with_ids(spark, rows):
    terms = term_table(spark)
    invoices = spark.createDataFrame(
        [(k, k % 8 + 1, date(2024, 1, 31) - timedelta(days=k), Decimal(k * 100 + 1) / 100) for k in range(1, 80)] + [(3, 4, date(2024, 1, 28), Decimal("3.01"))] * 2,
        INVOICE,
    )
    existing = spark.createDataFrame([], PLAN)
    plain = ["ID_NF_ENTRADA", "DATA_VENCIMENTO", "NUM_PARCELAS", "VALOR_PARCELA", "STATUS_PAGAMENTO"]
    made = numbered_payables(invoices, terms, existing)
    assert made.columns == ["ID_PROG_PAGAMENTO", *plain]
    assert rows(made, *plain) == rows(payables_schedule(invoices, terms, existing), *plain)
    got = [(r.ID_NF_ENTRADA, r.NUM_PARCELAS) for r in made.orderBy("ID_PROG_PAGAMENTO").collect()]
    assert got == sorted(got) and [r[0] for r in rows(made, "ID_PROG_PAGAMENTO")] and made.agg(F.max("ID_PROG_PAGAMENTO")).first()[0] == len(got)
    # a rerun adds nothing; lost instalments come back behind the last id
    assert numbered_payables(invoices, terms, made).count() == 0
    part = made.where((F.col("ID_NF_ENTRADA") % 3 != 0) | (F.col("NUM_PARCELAS") != 2))
    again = numbered_payables(invoices, terms, part)
    lost = made.where((F.col("ID_NF_ENTRADA") % 3 == 0) & (F.col("NUM_PARCELAS") == 2))
    assert rows(again, *plain) == rows(lost, *plain)
    last = part.agg(F.max("ID_PROG_PAGAMENTO")).first()[0]
    assert sorted(r.ID_PROG_PAGAMENTO for r in again.collect()) == list(range(last + 1, last + 1 + lost.count()))


def test_whole_cycle_keeps_its_references(spark):
    plans, done = whole_cycle(Frames(spark, FOLDER))
    new = plans.new_payables.select("ID_PROG_PAGAMENTO").collect()
    assert sorted(r[0] for r in new) == list(range(1, len(new) + 1))
    ids = {r[0] for r in new}
    posted = done.payments.history.collect()
    assert posted and {r.ID_PROG_PAGAMENTO for r in posted} <= ids
    settled = done.payments.schedule.where("STATUS_PAGAMENTO = 1").count()
    assert settled == len({r.ID_PROG_PAGAMENTO for r in posted})
    received = {r.ID_PROG_RECEBIMENTO for r in done.receipts.history.collect()}
    assert received == {r[0] for r in done.receipts.schedule.where("STATUS_RECEBIMENTO = 1").select("ID_PROG_RECEBIMENTO").collect()}
    assert done.cash.daily.count() > 0


IN, OUT = "DATA_RECEBIDO date, VALOR_PAGO decimal(16,2), CHEGADA date", "DATA_PGT_EFETUADO date, VALOR_PARCELA_PAGO decimal(16,2), CHEGADA date"


def ledgers(spark, rng, n, arrived):
    day = lambda: date(2024, 1, 1) + timedelta(days=rng.randrange(120))
    def lines(n):
        days = [day() for _ in range(n)]
        return [(d, Decimal(rng.randrange(1, 10**6)) / 100, arrived(d)) for d in days]
    return spark.createDataFrame(lines(n), IN), spark.createDataFrame(lines(n), OUT)


def test_repair_equals_recomputation(spark, rows):
    rng = random.Random(8)
    state = RunState(date(2024, 4, 10), status=0)
    # a third arrives later than the close, some of it for the open month
    receipts, payments = ledgers(spark, rng, 150, lambda d: date(2024, 4, 20) if rng.random() < 0.3 else min(d, date(2024, 4, 10)))
    known = [f.where(F.col("CHEGADA") <= state.today) for f in (receipts, payments)]
    before = cashflow_initial(*known, state, processed_at=state.today)
    fixed = cashflow_late_postings(receipts, payments, before.daily, before.monthly, arrived="CHEGADA", after=state.today, processed_at=state.today)
    want = cashflow_initial(receipts, payments, state, processed_at=state.today)
    assert rows(fixed.daily_next) == rows(want.daily)
    assert rows(fixed.monthly_next) == rows(want.monthly)
    # the next close goes on from the repaired balance
    later = RunState(date(2024, 5, 2), status=1)
    closed = cashflow_close(receipts, payments, fixed.daily_next, fixed.monthly_next, later, processed_at=state.today)
    whole = cashflow_initial(receipts, payments, RunState(later.today, status=0), processed_at=state.today)
    assert rows(fixed.daily_next.unionByName(closed.daily)) == rows(whole.daily)


def test_nothing_late_repairs_nothing(spark, rows):
    state = RunState(date(2024, 4, 10), status=0)
    receipts, payments = ledgers(spark, random.Random(9), 40, lambda d: min(d, date(2024, 4, 10)))
    before = cashflow_initial(receipts, payments, state, processed_at=state.today)
    fixed = cashflow_late_postings(receipts, payments, before.daily, before.monthly, arrived="CHEGADA", after=state.today, processed_at=state.today)
    assert fixed.daily.count() == fixed.monthly.count() == 0
    assert rows(fixed.daily_next) == rows(before.daily)
    none = before.daily.limit(0), before.monthly.limit(0)
    assert cashflow_late_postings(receipts, payments, *none, arrived="CHEGADA", after=date(2023, 1, 1)).daily_next.count() == 0


def test_only_rows_from_the_first_corrected_day_are_rewritten(spark):
    schema = "DATA date, SAIDA decimal(26,2), ENTRADA decimal(26,2), NET decimal(26,2), ACC decimal(26,2)"
    d = lambda k: date(2024, 1, k)
    closed = [(d(2), 0, 10, 10, 10), (d(4), 5, 0, -5, 5), (d(6), 0, 1, 1, 6)]
    history = spark.createDataFrame([(day, *map(Decimal, rest)) for day, *rest in closed], schema)
    fix = spark.createDataFrame([(d(3), Decimal(2), Decimal(0)), (d(6), Decimal(0), Decimal(4)), (d(7), Decimal(1), Decimal(1))], "DATA date, SAIDA decimal(26,2), ENTRADA decimal(26,2)")
    repaired = repair_balances(history, fix, "DATA", "NET", "ACC")
    got = sorted(tuple(map(lambda x: x if isinstance(x, date) else int(x), r)) for r in repaired.collect())
    assert got == [(d(3), 2, 0, -2, 8), (d(4), 5, 0, -5, 3), (d(6), 0, 5, 5, 8), (d(7), 1, 1, 0, 8)]
    assert sorted(r.DATA for r in with_repairs(history, repaired, "DATA").collect()) == [d(2), d(3), d(4), d(6), d(7)]
    # before the first closed day the balance starts from nothing
    early = spark.createDataFrame([(d(1), Decimal(0), Decimal(3))], "DATA date, SAIDA decimal(26,2), ENTRADA decimal(26,2)")
    assert [int(r.ACC) for r in repair_balances(history, early, "DATA", "NET", "ACC").orderBy("DATA").collect()] == [3, 13, 8, 9]


def test_ledger_is_read_only_where_it_was_touched(spark, tmp_path, plan):
    """Arrivals up to the close are in partitions that a repair could not even read."""
    state = RunState(date(2024, 4, 10), status=0)
    receipts, payments = ledgers(spark, random.Random(10), 60, lambda d: date(2024, 4, 20) if d.day % 5 == 0 else date(2024, 4, 1))
    before = cashflow_initial(*[f.where("CHEGADA <= '2024-04-10'") for f in (receipts, payments)], state, processed_at=state.today)
    want = cashflow_initial(receipts, payments, state, processed_at=state.today)
    history = [before.daily, before.monthly]
    for name, frame in (("in", receipts), ("out", payments), ("d", history[0]), ("m", history[1]), ("w", want.daily)):
        writer = frame.write.partitionBy("CHEGADA") if name in ("in", "out") else frame.write
        writer.parquet(f"{tmp_path}/{name}")
    for name in ("in", "out"):
        for file in (tmp_path / name / "CHEGADA=2024-04-01").glob("*.parquet"):
            file.write_bytes(b"not parquet")
    read = lambda name, schema=None: (spark.read.schema(schema) if schema else spark.read).parquet(f"{tmp_path}/{name}")
    fixed = cashflow_late_postings(read("in", IN), read("out", OUT), read("d"), read("m"), arrived="CHEGADA", after=state.today, processed_at=state.today)
    assert sorted(map(tuple, fixed.daily_next.collect())) == sorted(map(tuple, read("w").collect()))


def test_moments_of_a_closed_day_are_closed(spark):
    """A timestamp ledger: the last closed day counts to its end, the first open day not at all."""
    state = RunState(date(2024, 2, 10), status=0)
    flows = [("2024-01-15 08:00:00", 10, date(2024, 1, 15)), ("2024-01-31 23:59:00", 5, date(2024, 2, 20)), ("2024-02-01 00:00:00", 7, date(2024, 2, 20))]
    receipts = spark.createDataFrame([(datetime.fromisoformat(t), Decimal(v), a) for t, v, a in flows], IN.replace("DATA_RECEBIDO date", "DATA_RECEBIDO timestamp"))
    payments = spark.createDataFrame([], OUT)
    before = cashflow_initial(receipts.where("CHEGADA <= '2024-02-10'"), payments, state)
    fixed = cashflow_late_postings(receipts, payments, before.daily, before.monthly, arrived="CHEGADA", after=state.today)
    assert [(r.DATA, int(r.ACUMULADO_DIARIO)) for r in fixed.daily.collect()] == [(date(2024, 1, 31), 15)]

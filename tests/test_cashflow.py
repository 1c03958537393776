from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cashloom.operators import cashflow as cash
from cashloom.operators.parameters import encode_parameters, parse_parameters
from cashloom.plans.cash import (
    DAILY_COLUMNS,
    MONTHLY_COLUMNS,
    RunState,
    cashflow_close,
    cashflow_current_month,
    cashflow_initial,
    state_from_parameters,
)

STAMP = date(2023, 12, 1)


@pytest.fixture(scope="module")
def flows(spark):
    receipts = [(date(2022, 12, 30), "100.00"), (date(2023, 1, 5), "10.00"), (date(2023, 1, 5), "5.00"), (date(2023, 2, 28), "7.50"), (date(2023, 3, 2), "1.00"), (None, "99.00")]
    payments = [(date(2022, 12, 30), "40.00"), (date(2023, 1, 20), "20.00"), (date(2023, 3, 1), "3.00"), (date(2023, 3, 2), "0.25")]

    def frame(rows, day, amount):
        return spark.createDataFrame([(d, Decimal(v)) for d, v in rows], f"{day} date, {amount} decimal(16,2)")

    return frame(receipts, "DATA_RECEBIDO", "VALOR_PAGO"), frame(payments, "DATA_PGT_EFETUADO", "VALOR_PARCELA_PAGO")


def brief(df):
    order = df.columns[0]
    balance = "ACUMULADO_DIARIO" if "ACUMULADO_DIARIO" in df.columns else "VALOR_ACUMULADO_MES"
    return [(r[0].isoformat(), str(r[1]), str(r[2]), str(r[3])) for r in df.orderBy(order).select(order, "ENTRADA", "SAIDA", balance).collect()]


def test_initial_load(flows):
    load = cashflow_initial(*flows, RunState(date(2023, 3, 15), 0), processed_at=STAMP)
    assert load.daily.columns == list(DAILY_COLUMNS)
    assert load.monthly.columns == list(MONTHLY_COLUMNS)
    assert brief(load.daily) == [
        ("2022-12-30", "100.00", "40.00", "60.00"),
        ("2023-01-05", "15.00", "0.00", "75.00"),
        ("2023-01-20", "0.00", "20.00", "55.00"),
        ("2023-02-28", "7.50", "0.00", "62.50"),
    ]
    assert brief(load.monthly) == [
        ("2022-12-31", "100.00", "40.00", "60.00"),
        ("2023-01-31", "15.00", "20.00", "55.00"),
        ("2023-02-28", "7.50", "0.00", "62.50"),
    ]


def test_month_numbers_skip_december(flows):
    load = cashflow_initial(*flows, RunState(date(2023, 3, 15), 0), mode="month_number", processed_at=STAMP)
    assert [r[0] for r in brief(load.daily)] == ["2023-01-05", "2023-01-20", "2023-02-28"]


def test_before_the_cutoff_one_month_less(flows):
    load = cashflow_initial(*flows, RunState(date(2023, 3, 15), 0, cutoff=date(2023, 4, 1)), processed_at=STAMP)
    assert [r[0] for r in brief(load.monthly)] == ["2022-12-31", "2023-01-31"]


def test_close_continues_the_initial_load(flows):
    first = cashflow_initial(*flows, RunState(date(2023, 2, 10), 0), processed_at=STAMP)
    whole = cashflow_initial(*flows, RunState(date(2023, 4, 10), 0), processed_at=STAMP)
    state = RunState(date(2023, 4, 10), 1)
    closed = cashflow_close(*flows, first.daily, first.monthly, state, processed_at=STAMP)
    daily, monthly = first.daily.union(closed.daily), first.monthly.union(closed.monthly)
    assert brief(daily) == brief(whole.daily)
    assert brief(monthly) == brief(whole.monthly)
    assert brief(daily)[-1][3] == brief(monthly)[-1][3]
    again = cashflow_close(*flows, daily, monthly, state, processed_at=STAMP)
    assert again.daily.count() == again.monthly.count() == 0


def test_close_without_history_starts_from_zero(flows):
    load = cashflow_initial(*flows, RunState(date(2023, 4, 10), 0), processed_at=STAMP)
    none = cashflow_close(*flows, load.daily.where(F.lit(False)), load.monthly.where(F.lit(False)), RunState(date(2023, 4, 10), 1), processed_at=STAMP)
    assert brief(none.daily) == brief(load.daily)


def test_gates(flows):
    today = date(2023, 4, 10)
    load = cashflow_initial(*flows, RunState(today, 0), processed_at=STAMP)
    assert cashflow_initial(*flows, RunState(today, 1)).daily.count() == 0
    assert cashflow_close(*flows, load.daily, load.monthly, RunState(today, 0)).daily.count() == 0
    late = RunState(today, 1, cutoff=date(2023, 5, 1))
    assert cashflow_close(*flows, load.daily, load.monthly, late).monthly.count() == 0
    assert cashflow_current_month(*flows, load.daily, load.monthly, RunState(today, 0)).count() == 0


def test_current_month_opening(flows):
    first = cashflow_initial(*flows, RunState(date(2023, 1, 10), 0), processed_at=STAMP)
    run = dict(daily_history=first.daily, monthly_history=first.monthly, processed_at=STAMP)
    plain = cashflow_current_month(*flows, state=RunState(date(2023, 3, 10), 1), **run)
    assert brief(plain) == [("2023-03-01", "0.00", "3.00", "57.00"), ("2023-03-02", "1.00", "0.25", "57.75")]
    through = cashflow_current_month(*flows, state=RunState(date(2023, 3, 10), 1), through_unclosed=True, **run)
    assert brief(through) == [("2023-03-01", "0.00", "3.00", "59.50"), ("2023-03-02", "1.00", "0.25", "60.25")]
    # nothing unclosed: the last closed balance
    january = cashflow_current_month(*flows, state=RunState(date(2023, 1, 31), 1), through_unclosed=True, **run)
    assert brief(january)[0] == ("2023-01-05", "15.00", "0.00", "75.00")


def test_moments_on_a_closing_day_are_booked_once(spark):
    receipts = spark.createDataFrame(
        [(datetime(2023, 1, 31, 10, 0), Decimal("100.00")), (datetime(2023, 2, 28, 23, 59), Decimal("5.00")), (datetime(2023, 3, 1, 0, 0), Decimal("2.00"))],
        "DATA_RECEBIDO timestamp, VALOR_PAGO decimal(16,2)",
    )
    payments = spark.createDataFrame([(date(2023, 1, 31), Decimal("40.00"))], "DATA_PGT_EFETUADO date, VALOR_PARCELA_PAGO decimal(16,2)")
    first = cashflow_initial(receipts, payments, RunState(date(2023, 2, 10), 0), processed_at=STAMP)
    second = cashflow_close(receipts, payments, first.daily, first.monthly, RunState(date(2023, 3, 10), 1), processed_at=STAMP)
    third = cashflow_close(
        receipts, payments, first.daily.union(second.daily), first.monthly.union(second.monthly), RunState(date(2023, 4, 10), 1), processed_at=STAMP
    )
    whole = cashflow_initial(receipts, payments, RunState(date(2023, 4, 10), 0), processed_at=STAMP)
    assert brief(first.daily.union(second.daily).union(third.daily)) == brief(whole.daily)
    assert brief(first.monthly.union(second.monthly).union(third.monthly)) == brief(whole.monthly)


def test_close_reads_the_open_part_of_a_sorted_ledger(spark, tmp_path):
    """The bound of a table's last close prunes row groups, as a constant does."""
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")  # the default type has no statistics
    days = spark.range(200_000).select(F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") / 200).cast("int")).cast("timestamp").alias("DATA_RECEBIDO"), F.lit(Decimal("1.00")).cast("decimal(16,2)").alias("VALOR_PAGO"))
    days.repartitionByRange(20, "DATA_RECEBIDO").write.parquet(str(tmp_path / "r"))
    spark.conf.unset("spark.sql.parquet.outputTimestampType")
    receipts = spark.read.parquet(str(tmp_path / "r"))
    payments = spark.createDataFrame([], "DATA_PGT_EFETUADO date, VALOR_PARCELA_PAGO decimal(16,2)")
    history = spark.createDataFrame([(date(2022, 8, 31), date(2022, 8, 31), Decimal("0.00"))], "DATA date, DATA_FECHAMENTO date, ACUMULADO_DIARIO decimal(26,2)")
    months = history.withColumn("VALOR_ACUMULADO_MES", F.col("ACUMULADO_DIARIO"))
    later = cashflow_close(receipts, payments, history, months, RunState(date(2022, 10, 5), 1)).daily

    def read(df):
        df.collect()
        found = []

        def walk(node):
            name = node.nodeName()
            if name.startswith("Scan parquet"):
                found.append(node.metrics().apply("numOutputRows").value())
            for way in ("children", "innerChildren"):
                below = getattr(node, way)()
                for k in range(below.size()):
                    walk(below.apply(k))
            if name == "AdaptiveSparkPlan":
                walk(node.executedPlan())
            elif "QueryStage" in name:
                walk(node.plan())

        walk(df._jdf.queryExecution().executedPlan())
        return max(found)

    assert later.count() == 26 and 0 < read(later) < 60_000


def test_sums_and_latest(spark, flows, rows):
    receipts, _ = flows
    assert rows(cash.daily_sum(receipts.where("DATA_RECEBIDO is not null"), "DATA_RECEBIDO", "VALOR_PAGO", "t"))[1] == (date(2023, 1, 5), 1, Decimal("15.00"))
    months = rows(cash.monthly_sum(receipts.where("DATA_RECEBIDO is not null"), "DATA_RECEBIDO", "VALOR_PAGO", "t"))
    assert months[0] == (date(2022, 12, 31), 2022, 12, Decimal("100.00"))
    empty = cash.latest_row(receipts.where("false"), "DATA_RECEBIDO", "VALOR_PAGO")
    assert empty.first()[0] is None


def test_balance_per_party(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, -2), ("b", 1, 7)], "p string, d int, v int")
    found = cash.running_balance(df, "d", "v", "b", by=["p"], opening=F.lit(100))
    assert rows(found, "p", "d", "b") == [("a", 1, Decimal("105.00")), ("a", 2, Decimal("103.00")), ("b", 1, Decimal("107.00"))]


def test_parameters_round_trip(spark, rows):
    packed = [(1, "FLUXO,2023-01-01,2023-12-31,2023-11-01,30,0"), (2, "DATA,,,2023-11-29"), (3, "x,2023-13-01,a,b,c,d")]
    df = spark.createDataFrame(packed, "COD int, DESCRICAO string")
    parsed = parse_parameters(df)
    assert rows(parsed.where("COD = 2").drop("DESCRICAO")) == [(2, "DATA", None, None, date(2023, 11, 29), None, None)]
    assert rows(parsed.where("COD = 3").drop("DESCRICAO", "COD")) == [("x", None, None, None, None, None)]
    encoded = encode_parameters(parsed, code=1, status=1)
    assert rows(encoded, "COD", "DESCRICAO") == [(1, packed[0][1][:-1] + "1"), *packed[1:]]
    again = encode_parameters(parsed, code=2, status=1)
    assert rows(again.where("COD = 2"), "DESCRICAO") == [("DATA,,,2023-11-29,,1",)]


def test_state_machine_from_parameters(spark, flows):
    df = spark.createDataFrame([(1, "FLUXO,2023-01-01,2023-12-31,2023-11-01,30,0"), (2, "DATA,,,2023-03-01,,")], "COD int, DESCRICAO string")
    state = state_from_parameters(df, date(2023, 3, 15))
    assert state == RunState(date(2023, 3, 15), 0, date(2023, 3, 1))
    load = cashflow_initial(*flows, state, parameters=df)
    assert state_from_parameters(load.parameters, date(2023, 4, 1)).status == 1
    early = cashflow_initial(*flows, RunState(date(2023, 2, 15), 0, date(2023, 3, 1)), parameters=df)
    assert state_from_parameters(early.parameters, date(2023, 4, 1)).status == 0


def test_period_filters_reach_the_scan(spark, flows, plan, tmp_path):
    receipts, payments = flows
    receipts.write.parquet(str(tmp_path / "r"))
    payments.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "r")), spark.read.parquet(str(tmp_path / "p"))
    text = plan(cashflow_initial(*stored, RunState(date(2023, 3, 15), 0)).daily)
    assert "LessThan(DATA_RECEBIDO,2023-03-01)" in text
    assert "LessThan(DATA_PGT_EFETUADO,2023-03-01)" in text
    assert text.count("hashpartitioning(") == 1
    assert "SortMergeJoin" not in text

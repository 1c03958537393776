from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cashloom.operators import schedule, settlement
from cashloom.plans import posting, schedules
from cashloom.presets import term_table, tier_table

DUE = date(2023, 6, 15)
# received amount, days after due, tiers of an instalment of 100.00
GOLDEN = [
    ("100.00", 0, [1]),
    ("100.01", 0, []),
    ("99.99", 0, []),
    ("100.00", -3, []),
    ("100.00", 3, []),
    ("98.50", -3, [4]),
    ("98.10", -5, [4]),
    ("98.09", -5, []),
    ("98.05", -3, []),
    ("99.00", -1, [4]),
    ("99.01", -1, []),
    ("98.50", -6, []),
    ("98.00", -6, [3]),
    ("97.50", -8, [3]),
    ("97.00", -10, [3]),
    ("96.99", -10, []),
    ("96.99", -11, [2]),
    ("96.00", -11, [2]),
    ("95.00", -11, [2]),
    ("94.99", -11, []),
    ("96.00", -12, []),
    ("100.50", 1, [5]),
    ("100.49", 1, []),
    ("101.00", 4, [5]),
    ("101.50", 5, [5]),
    ("102.00", 5, [8]),
    ("101.60", 6, [6]),
    ("102.00", 8, [6, 8]),
    ("105.00", 10, [8]),
    ("105.01", 10, []),
    ("102.00", 11, [7]),
    ("102.01", 11, []),
    ("102.00", 12, []),
    ("99.00", 4, []),
    ("101.50", -3, [4]),
]


@pytest.fixture(scope="module")
def judged(spark):
    data = [
        (i, DUE, Decimal("100.00"), Decimal(amount), DUE + timedelta(days=days)) for i, (amount, days, _) in enumerate(GOLDEN)
    ]
    df = spark.createDataFrame(
        data,
        "ID_PROG_RECEBIMENTO int, DATA_VENCIMENTO date, VALOR_PARCELA decimal(16,2), VALOR_RECEBIDO decimal(16,2), DATA_RECEBIMENTO date",
    )
    return settlement.settlement_deviation(df)


def tiers_of(df):
    found = {i: [] for i in range(len(GOLDEN))}
    for row in df.collect():
        found[row.ID_PROG_RECEBIMENTO].append(row.ID_DESCONTO)
    return {i: sorted(t) for i, t in found.items()}


@pytest.mark.parametrize("small", [True, False])
def test_every_tier_boundary(spark, judged, monkeypatch, small):
    monkeypatch.setattr(settlement, "fits_broadcast", lambda df, rows=0: small)
    matched = settlement.tolerance_band_join(judged, tier_table(spark))
    assert tiers_of(matched) == {i: tiers for i, (_, _, tiers) in enumerate(GOLDEN)}


def test_tier_options(spark, judged):
    approved = tiers_of(settlement.tolerance_band_join(judged, tier_table(spark), approved_only=True))
    assert approved == {i: [t for t in tiers if t != 8] for i, (_, _, tiers) in enumerate(GOLDEN)}
    best = tiers_of(settlement.tolerance_band_join(judged, tier_table(spark), best_tier=True))
    assert best == {i: tiers[:1] for i, (_, _, tiers) in enumerate(GOLDEN)}


def test_band_join_broadcasts_the_tiers(spark, judged, plan):
    text = plan(settlement.tolerance_band_join(judged, tier_table(spark)))
    assert "BroadcastHashJoin" in text
    assert "NestedLoop" not in text


def test_divergent_gets_the_default_tier(spark, judged):
    matched = settlement.tolerance_band_join(judged, tier_table(spark))
    rest = settlement.unmatched_default(judged, matched).select("ID_PROG_RECEBIMENTO", "ID_DESCONTO", "MOTIVO").collect()
    assert {r[0] for r in rest} == {i for i, (_, _, tiers) in enumerate(GOLDEN) if not tiers}
    assert {r[1:] for r in rest} == {(9, "DESCONTO INVALIDO")}


def test_deviation_of_underpaid_and_undated(spark):
    df = spark.createDataFrame(
        [(DUE, Decimal("100.00"), Decimal("99.00"), DUE), (DUE, Decimal("100.00"), Decimal("99.00"), None), (DUE, Decimal("0.00"), Decimal("5.00"), DUE)],
        "DATA_VENCIMENTO date, VALOR_PARCELA decimal(16,2), VALOR_RECEBIDO decimal(16,2), DATA_RECEBIMENTO date",
    )
    found = [(r.DIAS_DIFERENCA, r.PORCENTAGEM, r.TIPO) for r in settlement.settlement_deviation(df).collect()]
    assert found == [(0, -1, False), (None, 1, True), (0, None, False)]


def invoice_rows(spark, data, key="ID_NF_SAIDA"):
    return spark.createDataFrame(
        [(i, term, day, Decimal(total)) for i, term, day, total in data], f"{key} int, ID_CONDICAO int, DATA_EMISSAO date, VALOR_TOTAL decimal(16,2)"
    )


def test_instalments_clamp_to_month_end(spark, rows):
    invoices = invoice_rows(spark, [(1, 7, date(2023, 1, 31), "100.00"), (2, 2, date(2023, 2, 28), "10.00"), (3, 99, date(2023, 1, 1), "1.00")])
    plan = schedule.generate_instalments(schedule.attach_terms(invoices, term_table(spark)), invoice_id="ID_NF_SAIDA", status="S")
    assert rows(plan, "ID_NF_SAIDA", "DATA_VENCIMENTO", "NUM_PARCELAS", "VALOR_PARCELA", "S") == [
        (1, date(2023, 1, 31), 1, Decimal("25.00"), 0),
        (1, date(2023, 2, 28), 2, Decimal("25.00"), 0),
        (1, date(2023, 3, 31), 3, Decimal("25.00"), 0),
        (1, date(2023, 4, 30), 4, Decimal("25.00"), 0),
        (2, date(2023, 3, 28), 1, Decimal("10.00"), 0),
    ]


def test_instalment_values_and_residue(spark):
    invoices = schedule.attach_terms(invoice_rows(spark, [(1, 4, date(2023, 1, 1), "100.00"), (2, 4, date(2023, 1, 1), "0.05")]), term_table(spark))

    def values(**options):
        plan = schedule.generate_instalments(invoices, invoice_id="ID_NF_SAIDA", status="S", **options)
        return [str(r[0]) for r in plan.orderBy("ID_NF_SAIDA", "NUM_PARCELAS").select("VALOR_PARCELA").collect()]

    assert values() == ["33.33"] * 3 + ["0.02"] * 3
    assert values(residue_on_last=True) == ["33.33", "33.33", "33.34", "0.02", "0.02", "0.01"]


def test_term_without_instalments_yields_none(spark):
    terms = spark.createDataFrame([(1, 0, 1)], "ID_CONDICAO int, QTD_PARCELAS int, ENTRADA int")
    invoices = schedule.attach_terms(invoice_rows(spark, [(1, 1, date(2023, 1, 1), "1.00")]), terms)
    assert schedule.generate_instalments(invoices, invoice_id="ID_NF_SAIDA", status="S").count() == 0


def test_schedules_add_nothing_on_rerun(spark):
    for job, key, status in (
        (schedules.payables_schedule, "ID_NF_ENTRADA", "STATUS_PAGAMENTO"),
        (schedules.receivables_schedule, "ID_NF_SAIDA", "STATUS_RECEBIMENTO"),
    ):
        invoices = invoice_rows(spark, [(i, i % 7 + 1, date(2023, 1, 31), "90.00") for i in range(70)], key)
        empty = spark.createDataFrame([], f"{key} int, DATA_VENCIMENTO date, NUM_PARCELAS int, VALOR_PARCELA decimal(16,2), {status} int")
        first = job(invoices, term_table(spark), empty)
        assert first.count() == 10 * (1 + 1 + 2 + 3 + 2 + 3 + 4)
        assert job(invoices, term_table(spark), first).count() == 0


def test_payments_settle_open_instalments_once(spark, rows):
    plan = spark.createDataFrame(
        [(10, 1, 1, DUE, Decimal("50.00"), 0), (11, 1, 2, date(2023, 7, 15), Decimal("50.00"), 0), (12, 2, 1, DUE, Decimal("9.00"), 1)],
        "ID_PROG_PAGAMENTO int, ID_NF_ENTRADA int, NUM_PARCELAS int, DATA_VENCIMENTO date, VALOR_PARCELA decimal(16,2), STATUS_PAGAMENTO int",
    )
    names = "ID_NF_ENTRADA string, DATA_VENCIMENTO string, DATA_PGT_EFETUADO string, VALOR_PGT_EFETUADO string"
    file = spark.createDataFrame(
        [("1", " 2023-06-15", "2023-06-10", " 49.00"), ("1", "2023-06-15", "2023-06-11", "1.00"), ("1", "2023-07-15", "2023-07-15", "?"), ("2", "2023-06-15", "2023-06-15", "9"), ("x", "", "", "")],
        names,
    )
    posted = posting.post_payments(file, plan)
    assert rows(posted.history, "ID_PROG_PAGAMENTO", "VALOR_PARCELA_PAGO") == [(10, Decimal("1.00")), (10, Decimal("49.00"))]
    assert rows(posted.schedule, "ID_PROG_PAGAMENTO", "STATUS_PAGAMENTO") == [(10, 1), (11, 0), (12, 1)]
    assert posted.schedule.columns == plan.columns
    again = posting.post_payments(file, posted.schedule)
    assert again.history.count() == 0


def test_receipts_post_once_and_divergent_ones_settle_too(spark, rows):
    invoices = spark.createDataFrame([(1, 900), (2, 901)], "ID_NF_SAIDA int, NUMERO_NF int")
    plan = spark.createDataFrame(
        [(10 * nf + k, nf, DUE + timedelta(days=30 * k), k, Decimal("100.00"), 0) for nf in (1, 2) for k in (1, 2)],
        "ID_PROG_RECEBIMENTO int, ID_NF_SAIDA int, DATA_VENCIMENTO date, NUM_PARCELAS int, VALOR_PARCELA decimal(16,2), STATUS_RECEBIMENTO int",
    )
    receipts = spark.createDataFrame(
        [
            (900, DUE + timedelta(days=30), DUE + timedelta(days=30), Decimal("100.00")),
            (900, DUE + timedelta(days=60), DUE + timedelta(days=68), Decimal("102.00")),
            (901, DUE + timedelta(days=30), DUE + timedelta(days=31), Decimal("50.00")),
            (999, DUE, DUE, Decimal("1.00")),
        ],
        "NUMERO_NF int, DATA_VENCIMENTO date, DATA_RECEBIMENTO date, VALOR_RECEBIDO decimal(16,2)",
    )
    history = spark.createDataFrame([], "ID_PROG_RECEBIMENTO int, ID_DESCONTO int")
    posted = posting.post_receipts(receipts, invoices, plan, history, tier_table(spark))
    assert rows(posted.history, "ID_PROG_RECEBIMENTO", "ID_DESCONTO") == [(11, 1), (12, 6), (12, 8), (21, 9)]
    assert posted.history.columns == ["ID_PROG_RECEBIMENTO", "ID_DESCONTO", "DATA_RECEBIDO", "VALOR_TOTAL_EM_HAVER", "VALOR_PAGO"]
    assert rows(posted.schedule, "ID_PROG_RECEBIMENTO", "STATUS_RECEBIMENTO") == [(11, 1), (12, 1), (21, 1), (22, 0)]
    again = posting.post_receipts(receipts, invoices, posted.schedule, posted.history, tier_table(spark))
    assert again.history.count() == 0
    single = posting.post_receipts(receipts, invoices, plan, history, tier_table(spark), best_tier=True)
    assert rows(single.history, "ID_PROG_RECEBIMENTO", "ID_DESCONTO") == [(11, 1), (12, 6), (21, 9)]


def test_another_matched_receipt_of_the_instalment_hides_a_divergent_one(spark, judged):
    """Divergence is judged per instalment: one accepted receipt is enough."""
    both = judged.where(F.col("ID_PROG_RECEBIMENTO").isin(0, 1)).withColumn("ID_PROG_RECEBIMENTO", F.lit(5))
    matched = settlement.tolerance_band_join(both, tier_table(spark))
    assert matched.count() == 1
    assert settlement.unmatched_default(both, matched).count() == 0

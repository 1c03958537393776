"""Every registered query against its SQL, and against the rules its plan has to keep."""

import pytest

import __spark_entry__ as driver
from workload.queries import ORACLES, QUERIES
from workload.check import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, plan, name):
    df = QUERIES[name](spark, FOLDER)
    assert difference(df, duck, ORACLES[name]) is None
    text = plan(df)
    for slow in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in text


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "DATA"


JOINING = [
    "p9_domain_membership",
    "j1_unprocessed_only",
    "j3_changed_members",
    "j6_resolve_party_address",
    "j7_build_invoice_fact",
    "j8_attach_terms",
    "j10_receipts_to_invoice",
    "j11_receipts_to_schedule",
    "j12_payments_to_open_schedule",
    "j13_tolerance_band_join",
    "j14_unmatched_default",
    "j17_existing_facts_removed",
    "s7_upsert",
    "q1_purchases_ingest_invoices",
    "q2_sales_ingest_changed_addresses",
    "q6_post_receipts_history",
    "j13_tolerance_band_join_many_tiers",
    "j3_changed_members_by_digest",
    "j1_unprocessed_only_bucketed_log",
    "q4_receivables_schedule_ids",
]


@pytest.mark.parametrize("name", JOINING)
def test_same_answer_with_sliced_keys_and_no_small_side(spark, duck, monkeypatch, name):
    """The paths for large data: nothing counts as small, and few rows make a key hot."""
    from cashloom.operators import dimensions, joins, quality, settlement

    monkeypatch.setitem(joins.spread_join.__kwdefaults__, "slice_rows", 25)
    monkeypatch.setitem(joins.spread_join.__kwdefaults__, "buckets", 256)
    for module in (dimensions, joins, quality, settlement):
        monkeypatch.setattr(module, "fits_broadcast", lambda df, rows=0: False)
    df = QUERIES[name](spark, FOLDER)
    assert difference(df, duck, ORACLES[name]) is None

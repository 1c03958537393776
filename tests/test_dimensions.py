from datetime import date

from pyspark.sql import functions as F

from cashloom.operators import dimensions as dims


def test_latest_per_key_prefers_recent_then_known(spark, rows):
    df = spark.createDataFrame(
        [
            ("t1", "A", "N/A", date(2023, 1, 1), 5),
            ("t1", "A", "a@x", date(2023, 1, 1), 5),
            ("t2", "OLD", "b@x", date(2023, 1, 1), 9),
            ("t2", "NEW", None, date(2023, 2, 1), 1),
            ("t3", "LOW", "c@x", date(2023, 1, 1), 1),
            ("t3", "HIGH", "N/A", date(2023, 1, 1), 2),
        ],
        "tax string, name string, email string, day date, nf int",
    )
    found = dims.latest_per_key(df, ["tax"], ["name", "email"], ["day", "nf"], defaults={"email": "N/A"})
    assert rows(found) == [("t1", "A", "a@x"), ("t2", "NEW", None), ("t3", "HIGH", "N/A")]


def test_new_and_changed_members(spark, rows):
    offered = spark.createDataFrame([("a", "x"), ("b", None), ("c", "z"), ("d", "w"), ("e", None)], "k string, v string")
    known = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None), ("e", None), ("c", "old")], "k string, v string")
    assert rows(dims.new_members(offered, known, "k")) == [("d", "w")]
    # NULL against a value is a change in either direction; a key known twice changes once
    assert rows(dims.changed_members(offered, known, "k", ["v"])) == [("b", None), ("c", "z")]


def test_addresses_are_keyed_by_party_and_code(spark, rows):
    offered = spark.createDataFrame([(1, "10", 2, 7), (1, "11", 1, 7), (2, "10", 1, 7)], "p int, cep string, t int, n int")
    known = spark.createDataFrame([(1, "10", 1, 7), (2, "10", 1, 7)], "p int, cep string, t int, n int")
    assert rows(dims.new_addresses(offered, known, ["p", "cep"])) == [(1, "11", 1, 7)]
    assert rows(dims.changed_addresses(offered, known, ["p", "cep"], ["t", "n"])) == [(1, "10", 2, 7)]


def test_upsert_updates_and_inserts(spark, rows):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (2, "dup", 21)], "k int, v string, w int")
    changes = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert rows(dims.merge_upsert(target, changes, ["k"], ["v"])) == [(1, "a", 10), (2, None, 20), (2, None, 21), (3, "c", None)]
    assert rows(dims.merge_upsert(target, changes, ["k"], ["v"], insert=False)) == [(1, "a", 10), (2, None, 20), (2, None, 21)]


def test_surrogate_keys_are_dense_and_stable(spark, rows):
    fresh = spark.range(1000).select(F.format_string("%014d", "id").alias("tax"))
    known = spark.createDataFrame([(41,), (7,)], "ID int")
    first = dims.assign_surrogate_keys(fresh.repartition(7), "tax", "ID", start_after=known)
    again = dims.assign_surrogate_keys(fresh.repartition(3), "tax", "ID", start_after=known)
    ids = rows(first)
    assert sorted(i for i, _ in ids) == list(range(42, 1042))
    assert ids == rows(again)
    assert sorted(i for i, _ in rows(dims.assign_surrogate_keys(fresh, "tax", "ID"))) == list(range(1, 1001))
    empty = known.where(F.lit(False))
    assert min(i for i, _ in rows(dims.assign_surrogate_keys(fresh, "tax", "ID", start_after=empty))) == 1


def test_unprocessed_keeps_rows_without_a_key(spark, rows):
    feed = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "nf int, d string")
    log = spark.createDataFrame([(1, "a"), (None, "c"), (2, "z")], "nf int, d string")
    assert rows(dims.unprocessed_only(feed, log, ["nf", "d"])) == [(2, "b"), (None, "c")]


def test_existing_facts_leave_distinct_rows(spark, rows):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "nf int, v string")
    facts = spark.createDataFrame([(1,), (5,)], "nf int")
    assert rows(dims.existing_facts_removed(new, facts, "nf")) == [(2, "b"), (None, "c")]


def test_invoice_fact_keeps_unknown_parties_and_terms(spark, rows):
    feed = spark.createDataFrame([("t1", "30 dias", 1), ("t9", "30 dias", 2), ("t1", "??", 3)], "tax string, term string, nf int")
    parties = spark.createDataFrame([("t1", 100)], "tax string, pid int")
    terms = spark.createDataFrame([("30 dias", 2)], "term string, tid int")
    fact = dims.build_invoice_fact(feed, parties, terms, party_key="tax", term_column="term")
    assert rows(fact, "nf", "pid", "tid") == [(1, 100, 2), (2, None, 2), (3, 100, None)]
    located = dims.resolve_party_address(feed, terms, parties, type_column="term", party_key="tax")
    assert rows(located, "nf", "pid", "tid") == [(1, 100, 2), (3, 100, None)]

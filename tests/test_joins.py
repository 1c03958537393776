"""Joins with hot keys against the plain join."""

import random

import pytest
from pyspark.sql import functions as F

from cashloom.operators import joins
from cashloom.operators.joins import fits_broadcast, lookup_join, spread_join


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the left rows on one key, a tenth NULL; that key has three rows on the right."""
    random.seed(7)
    left = []
    for i in range(3000):
        draw = random.random()
        key = 1 if draw < 0.33 else None if draw < 0.43 else random.randrange(2, 400)
        left.append((key, random.randrange(3), i))
    right = [(k, s, f"r{k}-{s}") for k in range(0, 300, 2) for s in range(3)] + [(1, s, f"hot{s}-{n}") for s in range(3) for n in range(3)] + [(None, 1, "null")]
    return (
        spark.createDataFrame(left, "k int, s int, l int").repartition(8),
        spark.createDataFrame(right, "k int, s int, r string"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize(("slice_rows", "buckets"), [(1, 4), (1, 1 << 12), (50, 1 << 14), (10**6, 1 << 14)])
def test_same_rows_as_the_plain_join(sides, rows, how, slice_rows, buckets):
    left, right = sides
    spread = spread_join(left, right, ["k", "s"], how, slice_rows=slice_rows, buckets=buckets)
    plain = left.join(right, ["k", "s"], how)
    assert spread.columns == plain.columns
    assert rows(spread) == rows(plain)


def test_hot_key_reaches_several_tasks(spark, sides):
    left, right = sides
    hot = spread_join(left, right, ["k"], "inner", slice_rows=20).where(F.col("k") == 1)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        sizes = [r["count"] for r in hot.groupBy(F.spark_partition_id()).count().collect()]
        plain = left.join(right, ["k"]).where(F.col("k") == 1).groupBy(F.spark_partition_id()).count().count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert plain == 1
    assert len(sizes) > 2
    assert max(sizes) < 0.8 * sum(sizes)


def test_key_types_must_agree(sides):
    left, right = sides
    with pytest.raises(ValueError, match="cast first"):
        spread_join(left, right.withColumn("k", F.col("k").cast("long")), "k")
    with pytest.raises(ValueError, match="does not support"):
        spread_join(left, right, "k", "full")


def test_broadcast_needs_a_small_side(spark, sides, plan, monkeypatch):
    left, right = sides
    assert fits_broadcast(right, 1000)
    assert not fits_broadcast(right, 10)
    monkeypatch.setattr(joins, "BROADCAST_TEXT", 10)
    assert not fits_broadcast(right, 1000)
    monkeypatch.undo()
    dimension = right.groupBy("k").agg(F.first("r").alias("r"))
    assert "BroadcastHashJoin" in plan(lookup_join(left, dimension, "k", "left"))


def test_lookup_join_past_the_bound(sides, rows, monkeypatch):
    left, right = sides
    expected = rows(left.join(right, ["k", "s"], "left"))
    monkeypatch.setattr(joins, "fits_broadcast", lambda df, rows=0: False)
    assert rows(lookup_join(left, right, ["k", "s"], "left")) == expected


def _key_shuffles(df):
    """Shuffles of whole rows (with their text ``t``) in the plan that Spark starts from."""
    import re

    text = df._jdf.queryExecution().executedPlan().toString()
    return [m for m in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text) if re.search(r"\bt#", m)]


def test_distinct_unprocessed_rows_of_calm_and_hot_keys(spark, rows):
    from cashloom.operators.dimensions import unprocessed_distinct

    feed = spark.createDataFrame(
        [(1, 1, "hot")] * 40 + [(1, 1, f"hot {i % 5}") for i in range(40)] + [(2, 1, "done")] * 30 + [(None, 1, "null")] * 25 + [(None, None, "null")]
        + [(i, i % 3, f"row {i // 2}") for i in range(3, 60) for _ in range(1 + i % 2)],
        "k int, d int, t string",
    ).repartition(5)
    log = spark.createDataFrame([(2, 1), (2, 1), (4, 1), (5, 2), (None, 1), (9, 77)], "k int, d int")
    upper = lambda df: df.withColumn("t", F.upper("t"))
    done = {(2, 1), (4, 1), (5, 2)}
    wanted = sorted({(r.k, r.d, r.t.upper()) for r in feed.collect() if (r.k, r.d) not in done}, key=repr)
    for slice_rows in (1, 10, 1_000_000):
        found = unprocessed_distinct(feed, log, ["k", "d"], upper, range_column="d", slice_rows=slice_rows, buckets=16)
        assert rows(found) == wanted


def test_rows_of_a_feed_are_not_sorted_to_lose_processed_ones(spark):
    from cashloom.operators.dimensions import unprocessed_distinct

    feed = spark.range(10).selectExpr("cast(id as int) k", "cast(id as string) t")
    found = unprocessed_distinct(feed, feed.where("k > 6").select("k"), ["k"], lambda df: df)
    assert "ShuffledHashJoin [k" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.k for r in found.collect()) == list(range(7))


def test_calm_rows_stay_where_the_join_has_placed_them(spark):
    from cashloom.operators.dimensions import unprocessed_distinct

    feed = spark.range(10).selectExpr("cast(id as int) k", "cast(id as string) t")
    found = unprocessed_distinct(feed, feed.select("k"), ["k"], lambda df: df)
    # the rows of hot keys are the only ones shuffled again by all their columns, also where the log is small
    assert len(_key_shuffles(found)) == 1

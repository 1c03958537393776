"""Stored tables laid out by key: upserts in place, and the bucketed log."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cashloom.operators.dimensions import merge_upsert, unprocessed_only
from cashloom.sources.tables import BucketedLog, KeyedTable

SCHEMA = "id int, code string, name string, n long"


@pytest.fixture
def table(spark, tmp_path):
    base = spark.range(2000).select(F.col("id").cast("int").alias("id"), (F.col("id") % 3).cast("string").alias("code"), F.lit("old").alias("name"), "id").toDF("id", "code", "name", "n")
    made = KeyedTable(spark, f"{tmp_path}/t", spark.createDataFrame([], SCHEMA).schema, ["id", "code"], parts=16)
    made.create(base)
    return made


def files(table):
    return {
        place: sorted(os.listdir(os.path.join(table.path, place))) for place in os.listdir(table.path) if place.startswith(table.place)
    }


def test_only_touched_partitions_are_read_and_replaced(spark, table, rows):
    before = table.read()
    keys = table._placed(before).where(F.col(table.place).isin(3, 9)).limit(20)
    changes = keys.select(F.col("id").cast("long").alias("id"), "code", F.lit("new").alias("name"))  # another type of the same key
    expected = rows(merge_upsert(before, changes.withColumn("id", F.col("id").cast("int")), ["id", "code"], ["name"]))
    old = files(table)
    # a partition that is not touched could not even be read
    untouched = next(p for p in old if p not in (f"{table.place}=3", f"{table.place}=9"))
    victim = next(os.path.join(table.path, untouched, f) for f in old[untouched] if f.endswith(".parquet"))
    content = open(victim, "rb").read()
    open(victim, "wb").write(b"not parquet")
    assert set(table.upsert(spark.createDataFrame(changes.collect(), changes.schema), ["name"])) <= {3, 9}
    open(victim, "wb").write(content)
    new = files(table)
    assert {p for p in old if old[p] != new[p]} <= {f"{table.place}=3", f"{table.place}=9"}
    assert rows(table.read()) == expected


def test_upsert_adds_changes_and_may_be_repeated(spark, table, rows):
    changes = spark.createDataFrame([(5, "2", "five"), (None, "x", "null key"), (9999, "0", "added")], "id int, code string, name string")
    expected = rows(merge_upsert(table.read(), changes, ["id", "code"], ["name"]))
    table.upsert(changes, ["name"])
    assert rows(table.read()) == expected
    known = changes.where("id is not null")
    table.upsert(known, ["name"])
    assert rows(table.read()) == expected
    assert table.upsert(changes.limit(0), ["name"]) == []
    assert rows(table.read()) == expected


def test_mark_and_no_insert(spark, table):
    hits = spark.createDataFrame([(6, "0"), (6, "0"), (7, "1"), (123456, "9")], "id int, code string")
    assert len(table.mark(hits, "name", "settled")) <= 3
    assert sorted(r.id for r in table.read().where("name = 'settled'").collect()) == [6, 7]
    assert table.read().count() == 2000


def test_a_failed_upsert_leaves_the_table(spark, table, rows):
    before = rows(table.read())
    broken = spark.createDataFrame([(5, "2", "x")], "id int, code string, name string").withColumn(
        "name", F.when(F.col("id") == 5, F.raise_error(F.lit("lost")).cast("string"))
    )
    with pytest.raises(Exception, match="lost"):
        table.upsert(broken, ["name"])
    assert rows(table.read()) == before


def test_number_of_parts_is_part_of_the_layout(spark, table):
    other = KeyedTable(spark, table.path, table.schema, table.keys, parts=8)
    with pytest.raises(ValueError):
        KeyedTable(spark, table.path, table.schema, table.keys, parts=0)
    assert other.read().count() == 2000 and other.place != table.place


def feed_and_log(spark):
    rng = random.Random(4)
    log = [(rng.randrange(300), rng.randrange(20)) for _ in range(400)]
    feed = [(rng.choice([7, rng.randrange(400), None]), rng.randrange(25), k) for k in range(900)] + [(7, 3, 1)] * 300
    return spark.createDataFrame(feed, "number int, day int, row int"), spark.createDataFrame(log, "number int, day int")


def test_bucketed_log_gives_the_same_rows(spark, tmp_path, rows):
    feed, log = feed_and_log(spark)
    stored = BucketedLog(spark, f"{tmp_path}/log", log.schema, ["number", "day"], buckets=8)
    assert rows(stored.unprocessed(feed)) == rows(feed)
    stored.append(log.where("day < 9"))
    stored.append(log.where("day >= 9"))
    want = rows(unprocessed_only(feed, log, ["number", "day"]))
    assert rows(stored.unprocessed(feed)) == want
    assert rows(stored.unprocessed(feed, range_column="day")) == want
    again = BucketedLog(spark, f"{tmp_path}/log", log.schema, ["number", "day"], buckets=8)
    assert rows(again.unprocessed(feed)) == want
    fresh = again.unprocessed(feed)
    again.forget()
    assert rows(fresh) == want
    stored.forget()


def test_the_log_is_not_shuffled_and_appends_keep_the_layout(spark, tmp_path, plan):
    feed, log = feed_and_log(spark)
    stored = BucketedLog(spark, f"{tmp_path}/log", log.schema, ["number", "day"], buckets=8)
    for part in range(3):
        stored.append(log.where(F.col("day") % 3 == part))
    offered = feed.select("number", "day").na.drop().distinct()
    text = plan(offered.join(stored.read().hint("merge"), ["number", "day"], "left_semi"), "simple")
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    # up from the log's scan to the join nothing but a sort and a filter
    depth = lambda line: len(line) - len(line.lstrip(" :+-*("))
    above, at = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < at:
            above.append(line)
            at = depth(line)
    join = next(i for i, line in enumerate(above) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in above[:join])
    stored.forget()

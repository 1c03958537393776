"""Steps that several queries share: how often they compute, and what a task of theirs holds."""

import pytest
from pyspark.sql import functions as F

from cashloom.operators import cashflow
from cashloom.sources.feeds import scan_csv
from cashloom.sources.staging import shared_copy
from workload import queries
from workload.frames import Frames

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("feed", ["purchase_feed", "sales_feed"])
def test_a_feed_computes_a_tax_id_once_a_row(spark, plan, feed):
    """However a tax id is typed out, its check digits are computed for it in one place."""
    text = plan(getattr(Frames(spark, FOLDER), feed)(), "simple")
    assert 1 <= text.count("div 100000000000)") <= 4


def test_a_lot_of_many_lines_is_many_files(spark):
    """No file, and so no task's sort, holds more lines than asked for, and the scan reads the same rows."""
    f = Frames(spark, FOLDER)
    few, many = (queries.feed_folder(f, n) for n in (1_000_000, 500))
    lines = spark.read.text(many).groupBy(F.input_file_name()).count().collect()
    assert len(lines) > 30 and max(r["count"] for r in lines) <= 502
    whole, parts = (scan_csv(spark, path, queries.FEED_FIELDS) for path in (few, many))
    assert whole.rows.count() == parts.rows.count() == parts.rows.join(whole.rows, list(queries.FEED_FIELDS), "left_semi").count()
    assert sorted(r.LINHA for r in whole.malformed.collect()) == sorted(r.LINHA for r in parts.malformed.collect())


def test_blocks_of_movements_are_bounded(spark, monkeypatch):
    """However small the blocks asked for, the driver handles a bounded number of them, and balances are the same."""
    monkeypatch.setattr(cashflow, "MOST_BLOCKS", 7)
    made = []

    def kept(df):
        made.append(df.select("__block").distinct().count())
        return shared_copy(df)

    rows = spark.range(1000).select("id", (F.col("id") % 13).cast("decimal(16,2)").alias("v"))
    found = cashflow.running_balance_of_movements(rows, ["id"], "v", "b", block_rows=3, stage=kept)
    total = 0
    for r in found.orderBy("id").collect():
        total += r.v
        assert r.b == total
    assert made[0] <= 7

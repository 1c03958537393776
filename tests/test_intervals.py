"""The dyadic index against plain comparison, and the join of settlements with very many tiers."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cashloom.operators import intervals, settlement
from cashloom.operators.intervals import dyadic_cover, dyadic_path, ranges_of_points
from workload.frames import Frames

EDGES = [(0, 0), (0, 1), (1, 1), (3, 9), (-5, 2), (-5, -1), (7, 3), (0, 2**31 - 1), (5, 2**31 - 1), (1023, 1024), (1024, 2047)]


def test_covers_are_disjoint_and_exact(spark):
    rng = random.Random(1)
    pairs = EDGES[:5] + EDGES[-2:] + [tuple(sorted((rng.randrange(3000), rng.randrange(3000)))) for _ in range(200)]
    frame = spark.createDataFrame(pairs, "low int, high int").select("low", "high", dyadic_cover(F.col("low"), F.col("high")).alias("nodes"))
    for r in frame.collect():
        held = [x for n in r.nodes for x in range(n.node << n.level, (n.node + 1) << n.level)]
        assert sorted(held) == list(range(max(r.low, 0), r.high + 1))
        levels = [n.level for n in r.nodes]
        assert all(levels.count(k) <= 2 for k in levels)


def test_covers_of_ranges_about_a_power_of_two(spark):
    """Their nodes, in order, leave no gap, however few levels are looked at."""
    pairs = [(k, k + (1 << n) + d) for n in range(31) for k in (0, 1, 1 << n) for d in (-2, -1, 0, 1) if 0 <= (1 << n) + d and k + (1 << n) + d < 1 << 31]
    frame = spark.createDataFrame(pairs, "low long, high long").select("low", "high", dyadic_cover(F.col("low"), F.col("high")).alias("nodes"))
    for r in frame.collect():
        at = r.low
        for level, node in sorted(r.nodes, key=lambda n: n.node << n.level):
            assert node << level == at
            at += 1 << level
        assert at == r.high + 1


def test_a_path_has_one_node_a_level(spark):
    path = spark.createDataFrame([(1000,)], "p int").select(dyadic_path(F.col("p"))).first()[0]
    assert [(n.level, n.node) for n in path] == [(k, 1000 >> k) for k in range(intervals.LEVELS + 1)]


@pytest.mark.parametrize("node_rows", [1, 50, 4096])
def test_every_pair_once(spark, rows, node_rows):
    rng = random.Random(2)
    points = sorted({(rng.random() < 0.5, rng.randrange(200)) for _ in range(150)}) + [(True, 2**31 - 1), (False, -4), (None, 3)]
    ranges = [(k, rng.random() < 0.5, *sorted((rng.randrange(-5, 200), rng.randrange(200)))) for k in range(300)]
    ranges += [(1000 + k, True, low, high) for k, (low, high) in enumerate(EDGES)] + [(2000, True, None, 5), (2001, None, 0, 9)]
    # one node that many ranges share
    ranges += [(3000 + k, True, 64, 127) for k in range(200)]
    found = ranges_of_points(
        spark.createDataFrame(points, "side boolean, at int"),
        spark.createDataFrame(ranges, "id int, side boolean, low int, high int"),
        ["side"], point="at", low="low", high="high", node_rows=node_rows,
    )
    want = [
        (at, id) for id, side, low, high in ranges for s, at in points
        if None not in (s, side, low) and s == side and at >= 0 and low <= at <= high
    ]
    assert rows(found, "at", "id") == sorted(want, key=repr)


@pytest.fixture
def many(spark):
    """50,000 tiers of a few days each, and settlements of which a third fall on one day."""
    key = F.col("id")
    tiers = spark.range(50_000).select(
        key.cast("int").alias("ID_DESCONTO"), (key % 1500).cast("int").alias("MINIMO_DIAS"), (key % 1500 + key % 4).cast("int").alias("MAXIMO_DIAS"),
        F.lit(Decimal("0.00")).cast("decimal(5,2)").alias("MINIMO"), (key % 3).cast("decimal(5,2)").alias("MAXIMO"), (key % 2).cast("int").alias("TIPO_DESCONTO"),
    )
    day = F.when(key % 3 == 0, 7).otherwise(key % 1600)
    settlements = spark.range(3000).select(
        key.alias("ID_PROG_RECEBIMENTO"), day.cast("int").alias("DIAS_DIFERENCA"), (key % 2 == 1).alias("TIPO"),
        F.lit(Decimal("100.00")).cast("decimal(16,2)").alias("VALOR_PARCELA"),
        (F.lit(100) + key % 4).cast("decimal(16,2)").alias("VALOR_RECEBIDO"), (key % 4).cast("decimal(10,2)").alias("PORCENTAGEM"),
    )
    return settlements, tiers


def test_fifty_thousand_tiers(spark, many, plan):
    settlements, tiers = many
    bands = tiers.withColumn("TIPO", F.col("TIPO_DESCONTO") == 1).drop("TIPO_DESCONTO")
    days = [(r.ID_PROG_RECEBIMENTO, r.DIAS_DIFERENCA, r.TIPO, int(r.PORCENTAGEM)) for r in settlements.collect()]
    by_day: dict = {}
    for k in range(50_000):
        for d in range(k % 1500, k % 1500 + k % 4 + 1):
            by_day.setdefault((d, k % 2 == 1), []).append((k, k % 3))
    candidates = settlement.tiers_by_days(settlements, bands)
    # no candidate but pairs that match by day
    assert candidates.count() == sum(len(by_day.get((d, side), [])) for _, d, side, _ in days)
    assert "CartesianProduct" not in plan(candidates) and "BroadcastNestedLoopJoin" not in plan(candidates)
    found = settlement.tolerance_band_join(settlements, tiers).select("ID_PROG_RECEBIMENTO", "ID_DESCONTO")
    want = [(i, k) for i, d, side, percent in days for k, most in by_day.get((d, side), []) if percent <= most]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_a_shared_day_is_spread(spark, many, monkeypatch):
    """The day of a third of the settlements is cut into slices, with the same rows."""
    from cashloom.operators import joins

    settlements, tiers = many
    want = settlement.tolerance_band_join(settlements, tiers, best_tier=True).select("ID_PROG_RECEBIMENTO", "ID_DESCONTO").collect()
    monkeypatch.setitem(joins.spread_join.__kwdefaults__, "slice_rows", 50)
    again = settlement.tolerance_band_join(settlements, tiers, best_tier=True).select("ID_PROG_RECEBIMENTO", "ID_DESCONTO").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, want)) and want


def test_settlements_are_compared_with_ranges_not_with_tiers(spark, many):
    """Tiers of one day with the same range of percent are met as one row, and none is lost, equal ids and NULL included."""
    settlements, tiers = many
    bands = tiers.withColumn("TIPO", F.col("TIPO_DESCONTO") == 1).drop("TIPO_DESCONTO")
    more = bands.unionByName(bands.limit(100)).unionByName(bands.limit(10).withColumn("ID_DESCONTO", F.lit(None).cast(bands.schema["ID_DESCONTO"].dataType)))
    columns = ["ID_PROG_RECEBIMENTO", "MINIMO", "MAXIMO", "ID_DESCONTO"]
    want = settlement.tiers_by_days(settlements, more).select(columns)
    for together in (1_000_000, 1000):
        ranges = settlement.ranges_by_days(settlements, more, together=together)
        spelled = ranges.withColumn("t", F.explode("__tiers")).select(*columns[:3], "t.ID_DESCONTO")
        assert sorted(map(str, spelled.collect())) == sorted(map(str, want.collect()))
    assert settlement.ranges_by_days(settlements, more).count() <= 3 * settlements.count() < want.count()


MATCHED = ["ID_PROG_RECEBIMENTO", "ID_DESCONTO"]


@pytest.fixture
def nothing_sent_unasked(spark):
    """Tables of a size that Spark does not broadcast by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_settlements_are_not_shuffled_for_few_tiers(spark, many, plan, rows, monkeypatch, nothing_sent_unasked):
    """Neither they nor the tiers are, and what is past one of the bounds gives the same rows."""
    settlements, tiers = many
    matched = settlement.tolerance_band_join(settlements, tiers)
    assert "SortMergeJoin" not in plan(matched) and "BroadcastNestedLoopJoin" not in plan(matched)
    want = rows(matched, *MATCHED)
    for bound in ("DAY_TIERS", "BROADCAST_ROWS"):
        with monkeypatch.context() as m:
            m.setattr(settlement, bound, 100)
            shuffled = settlement.tolerance_band_join(settlements, tiers)
            assert "SortMergeJoin" in plan(shuffled)
            assert rows(shuffled, *MATCHED) == want


def test_few_tiers_are_told_exactly(spark, many, monkeypatch):
    settlements, tiers = many
    bands = tiers.withColumn("TIPO", F.col("TIPO_DESCONTO") == 1).drop("TIPO_DESCONTO")
    days = settlements.select("TIPO", "DIAS_DIFERENCA").distinct()
    sizes = {"BROADCAST_ROWS": days.count(), "DAY_TIERS": settlement._tiers_of_days(days, bands).count()}
    assert settlement._few_tiers(days, bands)
    for name, size in sizes.items():
        for bound, few in ((size, True), (size - 1, False)):
            with monkeypatch.context() as m:
                m.setattr(settlement, name, bound)
                assert settlement._few_tiers(days, bands) is few


def test_settlements_with_the_same_tiers_come_in_a_row(spark, many):
    """So that a file repeats the same ids for them."""
    settlements, tiers = many
    found = settlement.tolerance_band_join(settlements.coalesce(1), tiers).select("TIPO", "DIAS_DIFERENCA", "PORCENTAGEM").collect()
    assert found == sorted(found) and len(found) > 3000


def test_settlements_are_built_of_orders_shuffled_once(spark, plan, rows, tmp_path, nothing_sent_unasked):
    """The same rows as of two schedules joined by invoice and due date, also where orders come twice or lack something."""
    orders = [(k, float(100 + k), f"2000-01-{k % 28 + 1:02}") for k in range(200)] + [(7, 5.0, "2000-01-08"), (7, 107.0, "2000-01-08"), (7, 9.0, "2000-03-08")]
    orders += [(None, 1.0, "2000-01-01"), (300, None, "2000-01-01"), (301, 1.0, None)]
    frame = spark.createDataFrame(orders, "o_orderkey long, o_totalprice double, day string")
    frame.select("o_orderkey", "o_totalprice", F.col("day").cast("timestamp").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    f = Frames(spark, str(tmp_path))
    receipts = f.receipts().withColumnRenamed("NUMERO_NF", "ID_NF_SAIDA")
    joined = f.receivable_schedule().join(receipts, ["ID_NF_SAIDA", "DATA_VENCIMENTO"])
    found = f.settlements()
    assert rows(found) == rows(joined, *found.columns) and found.count() > 250
    placed = [line for line in plan(found).splitlines() if "hashpartitioning" in line]
    assert placed and all("hashpartitioning(o_orderkey" in line for line in placed)
    assert "ReusedExchange" in plan(found)

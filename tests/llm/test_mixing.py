"""Source mixing: targets by plain Python, and what must hold of every mix."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from cashloom.llm import mixing
from cashloom.llm.mixing import drawn_blocks, mix_sources, permuted, plan_mix, split_quotas, taken_words, water_level
from cashloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected_targets(sizes):
    """Pour one source's excess at a time."""
    names = sorted(n for n in sizes if n is not None) + [n for n in sizes if n is None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    left, fixed = Fraction(3, 2) * sum(sizes.values()), {}
    while True:
        rest = [n for n in names if n not in fixed]
        share = {n: left * weight[n] / sum(weight[m] for m in rest) for n in rest}
        over = [n for n in rest if share[n] > 2 * sizes[n]]
        if not over:
            return {**fixed, **{n: float(x) for n, x in share.items()}}
        for n in over:
            fixed[n] = float(2 * sizes[n])
            left -= 2 * sizes[n]


def check(rows, table):
    """``rows`` of the query against the documents as (doc_id, text, source)."""
    size, total = {}, Counter()
    for key, text, source in table:
        size[key] = len(words(text))
        total[source] += size[key]
    source_of = {key: source for key, _, source in table}
    targets = expected_targets(dict(total))
    assert sorted(r.doc_id for r in rows) == sorted(size)
    taken = Counter()
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == total[source_of[r.doc_id]]
        assert r.target == pytest.approx(targets[source_of[r.doc_id]], rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size
        taken[source_of[r.doc_id]] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 0.5
    assert sum(targets.values()) == pytest.approx(1.5 * sum(total.values()))


def test_query_on_the_given_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source").collect()
    found = QUERIES["op13_source_mixing"](spark, FOLDER).collect()
    check(found, [tuple(r) for r in docs])
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        again = QUERIES["op13_source_mixing"](spark, FOLDER).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_odd_rows(spark, tmp_path):
    table = [(1, "a b c", "z"), (2, None, "z"), (3, "", None), (4, "w " * 5000, None), (5, "q r", "é"), (6, " ", "A"), (7, " \t", "B")]
    table += [(10 + k, "one two three four", "hot") for k in range(500)]
    spark.createDataFrame(table, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    check(QUERIES["op13_source_mixing"](spark, str(tmp_path)).collect(), table)


def test_empty_table_and_tables_without_words(spark):
    schema = "doc_id long, text string, source string"
    assert taken_words(mix_sources(spark.createDataFrame([], schema))).count() == 0
    rows = taken_words(mix_sources(spark.createDataFrame([(1, None, "a"), (2, " ", None)], schema))).collect()
    assert sorted((r.key, r.size, r.target, r.taken) for r in rows) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_repeated_rows_null_keys_and_clashing_columns(spark):
    rows = [(None, "a b c d", "s", 1, 2, 3)] * 40 + [(7, "e f", "t", 1, 2, 3)] * 3
    docs = spark.createDataFrame(rows, "id long, body string, source string, size long, offset long, target long")
    mixture = mix_sources(docs, key="id", text="body")
    found = taken_words(mixture).collect()
    assert Counter((r.key, r.size) for r in found) == {(None, 4): 40, (7, 2): 3}
    by_source = defaultdict(int)
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        by_source[r.source] += r.taken
    assert [by_source[n] for n in mixture.mix.names] == mixture.mix.quotas


def test_pieces_are_disjoint_and_shards_have_their_room(spark, monkeypatch):
    """Every word once a pass, the first pass whole before the second, shards of equal size, gapless places."""
    monkeypatch.setattr(mixing, "LEAST_BLOCK", 16)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    mixture = mix_sources(docs, shard_blocks=20)
    pieces = mixture.pieces.collect()
    blocks = defaultdict(set)
    seen = Counter()
    for p in pieces:
        blocks[p.shard].add(p.place)
        for w in range(p.first, p.first + p.words):
            seen[p.source_no, p.offset + w, p.turn] += 1
    assert set(seen.values()) == {1}
    units = int(mixture.mix.units().sum())
    shards = -(-units // 20)
    assert shards > 50 and sorted(blocks) == list(range(shards))
    for shard, places in blocks.items():
        room = units * (shard + 1) // shards - units * shard // shards
        assert places == set(range(room))
    taken = Counter()
    for no, _, turn in seen:
        taken[no, turn] += 1
    for no, (size, quota) in enumerate(zip(mixture.mix.sizes, mixture.mix.quotas, strict=True)):
        assert (taken[no, 0], taken[no, 1]) == (min(size, quota), max(0, quota - size))
    assert taken_words(mixture).agg({"taken": "sum"}).first()[0] == sum(mixture.mix.quotas)


def test_groups_of_documents_do_not_change_what_is_laid_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for rows in (3, 50, 10**6):
        laid = mixing.laid_out(docs, key="doc_id", text="text", source="source", group_rows=rows).where("size > 0").collect()
        ends = defaultdict(list)
        for r in sorted(laid, key=lambda r: r.offset):
            assert r.offset == (ends[r.source][-1] if ends[r.source] else 0)
            ends[r.source].append(r.offset + r.size)


def test_water_level():
    assert water_level([100, 100, 100], [5, 2, 1]) == pytest.approx([200, 500 / 3, 250 / 3])
    assert water_level([0, 10], [5, 2]) == [0.0, 15.0]
    assert water_level([], []) == []
    sizes = {f"s{k}": (k * 7919) % 1000 for k in range(60)} | {None: 5}
    plan = plan_mix(sizes)
    want = expected_targets(sizes)
    assert plan.targets == pytest.approx([want[n] for n in plan.names])
    assert plan.names[-1] is None and plan.names[:-1] == sorted(plan.names[:-1])


def test_block_size_follows_the_corpus():
    assert plan_mix({"a": 1000}).block == 256
    huge = plan_mix({"a": 10**13, "b": 5 * 10**12})
    assert huge.units().sum() <= 1.5 * 2**24 + 4


@pytest.mark.parametrize("size", [1, 2, 3, 255, 256, 1000])
def test_permutation(size):
    found = permuted(np.arange(size), size, 42, 3, 1)
    assert sorted(found.tolist()) == list(range(size))
    if size > 200:
        assert found.tolist() != permuted(np.arange(size), size, 43, 3, 1).tolist() != list(range(size))


def test_tree_is_the_same_from_any_side():
    units = np.array([500, 0, 31, 2000, 1], np.int64)
    whole = list(split_quotas(units, 77, 5, 0, 77))
    parts = [x for low in range(0, 77, 9) for x in split_quotas(units, 77, 5, low, min(77, low + 9))]
    assert [(s, b.tolist(), o.tolist()) for s, b, o in whole] == [(s, b.tolist(), o.tolist()) for s, b, o in parts]
    before = np.zeros(5, np.int64)
    for shard, ahead, own in whole:
        assert ahead.tolist() == before.tolist()
        assert own.sum() == 2532 * (shard + 1) // 77 - 2532 * shard // 77
        before = before + own
    assert before.tolist() == units.tolist()


def test_draws_of_the_tree_follow_the_distribution():
    """The left half's share of a source: mean and variance of the hypergeometric distribution."""
    units = np.array([300, 700], np.int64)
    left = [sum(int(own[0]) for _, _, own in split_quotas(units, 2, seed, 0, 1)) for seed in range(2000)]
    assert np.mean(left) == pytest.approx(150, abs=0.6)
    assert np.var(left) == pytest.approx(500 * 0.3 * 0.7 * 500 / 999, rel=0.12)


def test_drawn_blocks_are_each_source_s_own(spark):
    plan = plan_mix({"a": 100_000, "b": 30_100, None: 777})
    rows = drawn_blocks(spark, plan, seed=1, shard_blocks=8).collect()
    assert len({(r.source_no, r.block, r.turn) for r in rows}) == len(rows) == plan.units().sum()
    assert [sum(r.words for r in rows if r.source_no == k) for k in range(3)] == plan.quotas

"""Importance resampling against its SQL and against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import xxhash

from cashloom.llm import resampling
from cashloom.llm.queries import ORACLES, QUERIES
from cashloom.llm.resampling import feature_counts, intern_ngrams, learn_gains, ranked, resample, weigh
from workload.check import connect, difference

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def expected(rows, target, percent=5):
    s, t = Counter(), Counter()
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            counts.update(crc32(f.encode()) % 10000 for f in features(text)[0])
    all_s, all_t = float(sum(s.values())), float(sum(t.values()))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
    out = []
    for key, text in rows:
        found, n = features(text)
        weight = sum(gain(crc32(f.encode()) % 10000) for f in found)
        h = int(hashlib.sha256(f"42:{key}".encode()).hexdigest()[:8], 16)
        out.append((key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted((*r[:4], rank.get(r[0])) for r in out)


def test_query_equals_its_sql(spark):
    name = "op11_importance_resampling"
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


def test_query_equals_plain_python(spark, documents):
    target = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    found = QUERIES["op11_importance_resampling"](spark, FOLDER).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, found.collect())) == expected(documents[1], target)


TEXTS = [None, "", "  .,;!", "A", "Ünïcode ÄÖ été 日本 words", "x " * 700, "one two three " * 9, "a" * 400 + " " + "b" * 33 + " c", "0 9 ~ z\x7fy"]


def test_odd_texts_extra_columns_and_repeated_rows(spark, rows):
    lines = [(k, x, -1, "w") for k, x in enumerate(TEXTS * 2)]
    docs = spark.createDataFrame(lines, "id long, body string, score long, weight string")
    target = spark.createDataFrame([("one two",), (None,)], "text string")
    found = resample(docs, target, key="id", text="body", percent=50)
    assert found.columns == ["id", "body", "n_words", "n_features", "weight", "score", "rank"]
    want = expected([(k, x) for k, x, *_ in lines], ["one two", None], 50)
    assert rows(found, "id", "n_features", "weight", "score", "rank") == sorted(want, key=repr)


def test_nothing_to_draw_from_and_no_target(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c " * 20), (None, "d e f " * 20)], "doc_id long, text string")
    assert resample(none, some).count() == 0
    found = {r.doc_id: r for r in resample(some, none, percent=100).collect()}
    assert {r.rank for r in found.values()} == {1, 2}


def test_ties_go_to_the_smaller_key_over_many_partitions(spark):
    random.seed(2)
    lines = [(k, random.choice([5, 7, 7, 9]), random.random() < 0.8) for k in range(3000)]
    frame = spark.createDataFrame(lines, "doc_id long, score long, able boolean").repartition(13)
    found = {r.doc_id: r.rank for r in ranked(frame, resampling.F.col("able"), 40, key="doc_id").collect()}
    able = sorted((-s, k) for k, s, a in lines if a)
    want = {k: i + 1 for i, (_, k) in enumerate(able[: 40 * len(able) // 100])}
    assert found == {k: want.get(k) for k, _, _ in lines}


def test_keys_are_xxhash64():
    random.seed(3)
    words = [bytes(random.choices(range(97, 123), k=k % 50 + 1)) for k in range(2000)]
    length = np.array([len(w) for w in words])
    end = np.cumsum(length + 1) - 1
    assert resampling._Bytes(b" ".join(words)).hashes(end - length, length).tolist() == [xxhash.xxh64_intdigest(w) for w in words]


def test_equal_keys_of_different_bytes_do_not_share_a_slot(monkeypatch):
    """With all keys alike, only the bytes tell n-grams apart."""
    monkeypatch.setattr(resampling._Bytes, "hashes", lambda self, start, length: np.full(len(start), 7, np.uint64))
    text = "a bb a bb ccc a bbb " * 3
    found = [intern_ngrams(b) for b in resampling._blocks([text])]
    counts = Counter()
    for one in found:
        counts.update(dict(zip(one.bucket.tolist(), one.count.tolist(), strict=True)))
    assert counts == Counter(crc32(f.encode()) % 10000 for f in features(text)[0])


@pytest.mark.parametrize("block, segment", [(7, 11), (50, 1 << 18), (1 << 15, 40)])
def test_a_long_text_over_many_blocks(spark, monkeypatch, block, segment):
    random.seed(4)
    monkeypatch.setattr(resampling, "BLOCK_WORDS", block)
    monkeypatch.setattr(resampling, "SEGMENT", segment)
    texts = [" ".join(random.choices("alpha be c delta-e ef".split(), k=n)) for n in (300, 1, 0, 2, 40)]
    counts, n_features = Counter(), Counter()
    for one in resampling._blocks(texts):
        found = intern_ngrams(one)
        for b, n in zip(found.bucket.tolist(), found.count.tolist(), strict=True):
            counts[b] += n
        n_features.update(found.owner.tolist())
    want = [f for t in texts for f in features(t)[0]]
    assert +counts == Counter(crc32(f.encode()) % 10000 for f in want)
    assert n_features == +Counter({k: len(features(t)[0]) for k, t in enumerate(texts)})


def test_gains_and_weights_by_themselves(spark):
    docs = spark.createDataFrame([(1, "red red blue"), (2, "green")], "doc_id long, text string")
    target = spark.createDataFrame([("red",)], "t string")
    gains = learn_gains(docs, target, target_text="t")
    assert gains[crc32(b"red") % 10000] > gains[crc32(b"green") % 10000]
    found = {r.doc_id: r.weight for r in weigh(docs, gains, keep=["doc_id"]).collect()}
    assert found[1] == sum(gains[crc32(f.encode()) % 10000] for f in features("red red blue")[0])
    assert {r.bucket: r.n for r in feature_counts(target, text="t").collect()} == {crc32(b"red") % 10000: 1}

"""Periodic runs against their SQL and against plain Python."""

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest

from cashloom.llm import periodic
from cashloom.llm.periodic import collapse, periodic_runs, text_runs
from cashloom.llm.queries import ORACLES, QUERIES
from workload.check import connect, difference

FOLDER = "/root/testdata/sf0.001"


def expected_runs(words):
    """Every lag, every place; a stretch with a smaller period is not the lag's own."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(all(words[x] == words[x + d] for x in range(i, i + length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected_row(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), crc32(str(key).encode())
    if h % 10 == 0 and n:
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = expected_runs(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        key, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_equals_its_sql(spark):
    name = "op12_periodic_runs"
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


def test_query_equals_plain_python(spark, documents, rows, tmp_path):
    odd = [(90000 + k, x) for k, x in enumerate([None, "", " \t\n", "a " * 50, "a b c d" * 12, "u v w " * 5 + "u"] * 10)]
    lines = [(k, x) for k, x in documents[1] if len(x or "") < 4000] + odd
    spark.createDataFrame(lines, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    assert rows(found, *COLUMNS) == sorted((expected_row(k, x) for k, x in lines), key=repr)
    assert any(r[1] for r in rows(found, *COLUMNS))


@pytest.mark.parametrize("seed", range(6))
def test_random_words(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(300):
        n = rng.randint(0, 90)
        words = [rng.choice([b"a", b"b", b"c", b"d"][: rng.choice([1, 2, 2, 3, 4])]) for _ in range(n)]
        if n > 8 and rng.random() < 0.7:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 3))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        texts.append(words + words[: rng.randint(0, n)] * rng.randint(0, 4))
    assert text_runs(texts) == [expected_runs(w) for w in texts]


def test_a_period_whose_grams_come_twice_in_it():
    """Every short gram of the period has a nearer copy inside the period; only longer grams pair at its lag."""
    unit = list("aaaaabbbbbaaaaabbbbbbbbbbaaaaaaaaaabbbbbaaaaabbbbbbbbbb")
    words = [c.encode() for c in unit * 5 + ["x"]]
    assert text_runs([words]) == [expected_runs(words)]


def test_blocks_do_not_change_runs(monkeypatch):
    texts = [[b"a"] * 9, [b"a"] * 9, [], [b"a", b"b"] * 6, [b"b", b"a"] * 6, [b"z"]]
    want = [expected_runs(w) for w in texts]
    for size in (1, 10, 20, 1000):
        monkeypatch.setattr(periodic, "BLOCK_WORDS", size)
        assert text_runs(texts) == want


def test_very_long_texts_stay_cheap():
    unit = [str(k).encode() for k in range(300)]
    for words, run in (([b"a"] * 200_000, (0, 200_000, 1)), ([b"a", b"b"] * 100_000, (0, 200_000, 2)), (unit * 700, (0, 210_000, 300))):
        assert text_runs([words]) == [[run]]
    # many short runs, and a million words without any
    assert len(text_runs([([b"r"] * 6 + [b"s", b"t"]) * 3 + unit])[0]) == len(expected_runs(([b"r"] * 6 + [b"s", b"t"]) * 3 + unit))
    assert text_runs([[b"%d" % x for x in np.random.default_rng(1).integers(0, 1000, 1_000_000)]]) == [[]]


def test_operator_keeps_columns_and_whole_texts(spark):
    lines = [(1, "so so so so so so fine", "keep", 7), (None, None, "x", 8), (1, "so so so so so so fine", "keep", 7), (2, "", "y", 9)]
    docs = spark.createDataFrame(lines, "id int, body string, runs string, extra long")
    found = periodic_runs(docs, text="body")
    assert found.columns == ["id", "body", "extra", "runs", "collapsed", "n_words"]
    got = sorted(((r.id or 0, r.body, r.extra, [tuple(x) for x in r.runs], r.collapsed, r.n_words) for r in found.collect()), key=repr)
    one = (1, "so so so so so so fine", 7, [(0, 6, 1)], "so fine", 7)
    assert got == sorted([(0, None, 8, [], "", 0), one, one, (2, "", 9, [], "", 0)], key=repr)
    assert periodic_runs(docs.limit(0), text="body").count() == 0


def test_collapse_of_overlapping_runs():
    words = [b"a", b"a", b"a", b"a", b"a", b"a", b"b"] * 4
    runs = expected_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    assert len(runs) > 1 and collapse(words, runs) == [w for i, w in enumerate(words) if i not in gone]

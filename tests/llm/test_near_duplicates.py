"""Similarity joins and repeats against plain Python."""

import itertools
import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from cashloom.llm import embeddings, ngram, repeats
from cashloom.llm.components import connected_components
from cashloom.llm.embeddings import near_duplicates
from cashloom.llm.ngram import similar_components
from cashloom.llm.repeats import cut_repeats, later_windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


class Forest(dict):
    def find(self, k):
        while self.setdefault(k, k) != k:
            self[k] = k = self[self[k]]
        return k

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) > 4 else ({tuple(words)} if words else set())


def expected_components(rows):
    sets = [(k, shingles(t)) for k, t in rows]
    forest = Forest()
    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if x and y and a is not None and b is not None and min(len(x), len(y)) * 100 >= 80 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    forest.link(a, b)
    return Counter((k, len(s), None if k is None else forest.find(k)) for k, s in sets)


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near_texts():
    """Copies with more and more edits, of short, middling and long texts, around the limit of 0.8."""
    draw = random.Random(4)
    rows = []
    for size in (1, 2, 3, 4, 5, 6, 8, 12, 20, 28, 29, 30, 31, 45, 60, 90, 200, 600):
        base = [f"v{draw.randrange(10**6)}" for _ in range(size)]
        rows += [edited(draw, base, draw.randint(0, max(1, size // 20))) for _ in range(8)]
        rows += [" ".join(base[: draw.randint(max(1, size * 3 // 4), size)]) for _ in range(3)]
        rows += [" ".join(base).upper(), "\t" + "  ".join(base) + "\n"]
    rows += [None, "", " \n", "same", "same", "Same"]
    return list(enumerate(rows, start=10))


def test_jaccard_components(spark, near_texts):
    rows = [*near_texts, (None, near_texts[0][1]), near_texts[5], near_texts[60]]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_shingles string")
    found = Counter(tuple(r) for r in similar_components(frame).select("doc_id", "n_shingles", "component_id").collect())
    assert found == expected_components(rows)
    assert similar_components(frame.limit(0)).count() == 0


def test_jaccard_in_large_tiles(spark, monkeypatch):
    """Copies that link with the original only, in tiles over the size that is joined directly."""
    monkeypatch.setattr(ngram, "PAIRED", 4)
    draw = random.Random(8)
    base = [f"v{k}" for k in range(60)]
    rows = [(k, edited(draw, base, 2)) for k in range(1, 90)] + [(500, " ".join(base))]
    found = Counter(tuple(r) for r in similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found == expected_components(rows)


@pytest.mark.parametrize("block, words", [(3, 512), (16, 1), (4096, 2)])
def test_jaccard_in_blocks_around_the_threshold(spark, monkeypatch, block, words):
    """One big group whose members are now above, now below the threshold to each other, in blocks of main sets and others."""
    monkeypatch.setattr(ngram, "BLOCK", block)
    monkeypatch.setattr(ngram, "PAIRED", 4)
    monkeypatch.setattr(ngram, "MAP_WORDS", words)
    draw = random.Random(block)
    base = [f"w{k}" for k in range(260)]
    rows = []
    for k in range(90):
        text = list(base)
        for _ in range(draw.choice([0, 1, 2, 4, 5, 6, 7, 9])):
            text[draw.randrange(len(text))] = f"x{draw.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    rows += [(200 + k, " ".join(base[: 200 + k])) for k in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = similar_components(frame).collect()
    assert Counter(map(tuple, found)) == expected_components(rows)
    assert 3 < len({r.component_id for r in found}) < 90


def test_jaccard_releases_its_working_copies(spark, documents, tmp_path):
    """Of the copies on the way only those stay that the answer reads."""
    from cashloom.sources.staging import shared_folder

    import os

    before = set(os.listdir(shared_folder(spark)))
    similar_components(documents[0].select("doc_id", "text")).count()
    assert len(set(os.listdir(shared_folder(spark))) - before) <= 8


def test_jaccard_on_the_table(spark, documents):
    frame, rows = documents
    assert Counter(tuple(r) for r in similar_components(frame.select("doc_id", "text")).collect()) == expected_components(rows)


def test_every_linked_pair_shares_a_tile():
    draw = np.random.default_rng(3)
    for _ in range(400):
        n = int(np.exp(draw.uniform(0, 7)))
        a = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
        gone = int(len(a) * draw.uniform(0, 0.2))
        b = np.unique(np.concatenate([draw.permutation(a)[gone:], draw.integers(0, 2**64, int(gone * draw.uniform(0, 1)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert len(np.intersect1d(ngram.tile_keys(a), ngram.tile_keys(b)))


def test_tiles_of_near_copies_are_taken_together(spark, tmp_path):
    """Two sets that share a tile share a merged one; a set of a group of near copies stands in few of those, chance meetings stay apart."""
    draw = random.Random(12)
    tiles = [draw.sample(range(1, 81), draw.randint(40, 70)) for _ in range(60)]  # parts of one group
    tiles += [[5, 1000 + k] for k in range(50)]  # a set that meets others one by one
    rows = [(key, member) for key, tile in enumerate(tiles) for member in tile]
    with ngram.Staging(spark, str(tmp_path)) as stage:
        found = ngram.merged_tiles(spark.createDataFrame(rows, "key long, set_id long"), stage).collect()
    merged = {}
    for r in found:
        merged.setdefault(r.key, set()).add(r.set_id)
    assert len(found) == sum(map(len, merged.values())) < len(rows) / 4

    def pairs(groups):
        return [pair for group in groups for pair in itertools.combinations(sorted(group), 2)]

    assert set(pairs(tiles)) <= set(pairs(merged.values()))
    assert len(pairs(merged.values())) <= ngram.MERGED * len(pairs(tiles))
    assert not any({1000 + i, 1000 + k} <= group for group in merged.values() for i in range(10) for k in range(i))


def test_copies_alone_are_no_tile(spark):
    """One set in several tasks, which meets nothing else, has no tile."""
    copies = spark.createDataFrame([(" ".join(f"w{k}" for k in range(80)),)] * 8, "text string").repartition(4)
    assert not ngram.tiles(copies, 3).count()


def test_components(spark):
    draw = random.Random(1)
    links = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(draw.randrange(1000, 1300), draw.randrange(1000, 1300)) for _ in range(150)]
    links += [(7, 7), (7, 7)]
    forest = Forest()
    for a, b in links:
        if a != b:
            forest.link(a, b)
    frame = spark.createDataFrame([*links, (None, 5), (6, None)], "a long, b long")
    found = {r.node: r.component for r in connected_components(frame).collect()}
    assert found == {k: forest.find(k) for k in list(forest)}
    assert connected_components(frame.limit(0)).count() == 0


def expected_cuts(rows, length=100):
    seen, found = set(), {}
    for key, text in sorted({(2**63 if k is None else k, t or "") for k, t in rows}, key=lambda r: (r[0], sha256(r[1].encode()).hexdigest())):
        data = text.encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(window)
        spans = sum(1 for k in range(len(data)) if gone[k] and not (k and gone[k - 1]))
        found[key, text] = (len(data), sum(gone), spans, sha256(bytes(c for c, g in zip(data, gone, strict=True) if not g)).hexdigest())
    return Counter((k, *found[2**63 if k is None else k, t or ""]) for k, t in rows)


def long_texts():
    draw = random.Random(6)
    piece = lambda n: "".join(draw.choice("abcdeé \n") for _ in range(n))
    shared = [piece(n) for n in (99, 100, 101, 150, 400)]
    rows = [(k, piece(draw.randint(0, 120)) + draw.choice(shared) + piece(draw.randint(0, 60)) + draw.choice(shared)) for k in range(40)]
    rows += [(100, "x" * 500), (101, "y" * 99), (102, "y" * 100), (103, "xy" * 200), (104, "y" * 250), (50, None), (51, ""), (52, shared[4]), (53, shared[4])]
    return rows + [rows[3], rows[44], (None, shared[3]), (3, piece(300))]


def test_repeats(spark):
    rows = long_texts()
    frame = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, n_spans int")
    found = Counter(tuple(r) for r in cut_repeats(frame, digest=True).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert found == expected_cuts(rows)
    cut = cut_repeats(frame)
    assert cut.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "text"]
    assert cut.where("doc_id in (52, 53)").orderBy("doc_id").select("text").collect()[1].text == ""
    assert cut_repeats(frame.limit(0)).count() == 0


def test_repeats_on_the_table_and_in_small_parts(spark, documents, monkeypatch):
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", 0)
    frame, rows = documents
    found = cut_repeats(frame.select("doc_id", "text"), digest=True).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r) for r in found.collect()) == expected_cuts(rows)


def test_repeats_around_anchors_of_very_many_texts(spark, monkeypatch):
    """A passage that most texts share amid different text: its anchors have no bucket, and nothing is lost."""
    seen, whole = [], repeats.hot_spans
    monkeypatch.setattr(repeats, "HOT", 8)
    monkeypatch.setattr(repeats, "HELD_WINDOWS", 1000)
    monkeypatch.setattr(repeats, "hot_spans", lambda texts, hot, *rest: seen.append(len(hot)) or whole(texts, hot, *rest))
    draw = random.Random(12)
    piece = lambda n: "".join(draw.choice("abcdeé \n") for _ in range(n))
    common = piece(230)
    rows = long_texts() + [(k, piece(draw.randint(0, 150)) + common + piece(draw.randint(0, 150))) for k in range(200, 260)]
    rows += [rows[-1], (None, common), (230, piece(90) + common), (300, common[30:160] + piece(40) + common)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = cut_repeats(frame, digest=True).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r) for r in found.collect()) == expected_cuts(rows)
    assert len(seen) == 1 and seen[0] >= 3


@pytest.mark.parametrize("seed", range(30))
def test_index_marks_later_windows(seed):
    draw = random.Random(seed)
    letters = draw.choice([b"ab", b"abcdefgh", bytes(range(256))])
    some = lambda n: bytes(draw.choice(letters) for _ in range(n))
    base, contexts = some(300), []
    for _ in range(draw.randint(1, 14)):
        start = draw.randint(0, 110)
        changed = bytearray(base[start : start + 184])
        changed[draw.randrange(184)] = draw.choice(letters)
        contexts.append(draw.choice([some(draw.randint(100, 184)), (some(draw.randint(1, 9)) * 200)[:184], bytes(changed)]))
    at = np.array([draw.randint(0, 50) for _ in contexts])
    seen, expected = set(), set()
    for k, c in enumerate(contexts):
        for q in range(len(c) - 99):
            if c[q : q + 100] in seen:
                expected.add((k, q + int(at[k])))
            seen.add(c[q : q + 100])
    whose, where = later_windows(contexts, np.arange(len(contexts)), at)
    assert set(zip(whose.tolist(), where.tolist(), strict=True)) == expected


def test_equal_windows_choose_equal_anchors():
    draw = np.random.default_rng(2)
    for _ in range(50):
        shared = draw.integers(97, 100, 100).astype(np.uint8)
        one, two = (np.concatenate([draw.integers(97, 100, n).astype(np.uint8), shared, draw.integers(97, 100, 30).astype(np.uint8)]) for n in (17, 60))
        (a, x), (b, y) = repeats.anchors(one), repeats.anchors(two)
        inside = {(p - 17, h) for p, h in zip(a.tolist(), x.tolist(), strict=True) if 17 <= p <= 101}
        assert inside & {(p - 60, h) for p, h in zip(b.tolist(), y.tolist(), strict=True) if 60 <= p <= 144}


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefghijklmnopqrstuvwxyz "])
def test_a_window_is_sent_around_its_least_anchor_only(alphabet):
    rng = np.random.default_rng(len(alphabet))
    data = bytes(rng.choice(list(alphabet), 3000).astype(np.uint8))
    at, hashes = repeats.anchors(np.frombuffer(data, np.uint8))
    start, stop = repeats._contexts(at, hashes, len(data), repeats.LENGTH)
    sent = np.zeros(len(data) - repeats.LENGTH + 1, int)
    for a, z in zip(start.tolist(), stop.tolist(), strict=True):
        sent[a : max(a, z - repeats.LENGTH + 1)] += 1
    assert len(set(hashes.tolist())) == len(hashes) and (sent == 1).all()


def test_places_of_hot_anchors_go_to_the_texts_while_they_are_few(spark, monkeypatch):
    rng = np.random.default_rng(3)
    passage = "".join(rng.choice(list("abcdefgh "), 150))
    frame = spark.createDataFrame([(k, "".join(rng.choice(list("abcdefgh "), 60)) + passage) for k in range(40)], "doc_id long, text string")
    met, meeting = [], repeats._meeting
    monkeypatch.setattr(repeats, "HOT", 8)
    monkeypatch.setattr(repeats, "_meeting", lambda texts, small, how: met.append(small.columns) or meeting(texts, small, how))
    assert cut_repeats(frame, digest=True).where("n_removed >= 150").count() == 39
    assert len(met) == 3 and met[1] == ["o", "sid", "places"]


def test_spans_of_a_document_are_sorted_and_apart(spark):
    rng = np.random.default_rng(4)
    passage = "".join(rng.choice(list("abcdefgh "), 2000))
    found = repeats.repeat_spans(spark.createDataFrame([(1, "a" + passage), (2, "b" + passage)], "doc_id long, text string"))
    (row,) = found.collect()
    assert (row.o, row.whole, np.frombuffer(row.spans, "<u4").tolist()) == (2, False, [1, 2001])



def test_vectors(spark):
    draw = np.random.default_rng(9)
    rows = []
    for k in range(60):
        base = draw.standard_normal(16)
        rows += [(k * 10 + j, (base + draw.standard_normal(16) * 0.08).tolist()) for j in range(draw.integers(1, 6))]
    rows += [(700, rows[0][1]), (701, rows[0][1]), (702, [3 * x for x in rows[5][1]]), (703, None), (704, [0.0] * 16), (705, [float("nan")] * 16)]
    rows += [(706, [float("inf")] + [1.0] * 15), (707, [None] + [1.0] * 15), (708, [1.0, 2.0]), (709, []), (None, rows[0][1]), (700, rows[0][1]), (710, [1e-300] * 16), (711, [1e300] * 16)]
    usable = [(k, np.array(v, float)) for k, v in rows if k is not None and k not in range(703, 710)]
    unit = np.stack([v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for _, v in usable])
    close = unit @ unit.T >= 0.95
    forest, links = Forest(), Counter()
    for n, (a, _) in enumerate(usable):
        for m, (b, _) in enumerate(usable):
            if n != m and close[n, m]:
                links[n] += 1
                forest.link(a, b)
    expected = Counter((k, links[n], forest.find(k), forest.find(k) == k) for n, (k, _) in enumerate(usable))
    expected += Counter((k, 0, k, k is not None) for k, _ in rows if k is None or k in range(703, 710))
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, kept string")
    for options in ({}, {"leaf": 16, "trees": 12}):
        assert Counter(tuple(r) for r in near_duplicates(frame, **options).collect()) == expected
    assert near_duplicates(frame.limit(0)).count() == 0


def test_vectors_of_different_lengths(spark):
    """Each length links within itself, equal and near vectors alike."""
    rows = [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.0, 1.0, 0.0]), (4, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [1.0, 0.02]), (7, [0.0, 1.0]), (8, [2.0]), (9, [3.0]), (10, [])]
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {
        1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), 4: (2, 4, True), 5: (2, 4, False), 6: (2, 4, False), 7: (0, 7, True),
        8: (1, 8, True), 9: (1, 8, False), 10: (0, 10, True),
    }


@pytest.mark.parametrize("share, spread", [(0.05, 0.15), (0.05, 0.22), (0.11, 0.2), (0.33, 0.2)])
def test_cells_hold_groups_among_vectors_that_lean_to_one_side(share, spread):
    """At production defaults, with a background cosine of 0.83: every link of the group has an end in a core, and its other end around."""
    draw = np.random.default_rng(3)
    n, d = 16_384, 64
    v = draw.standard_normal((n, d))
    lean = draw.standard_normal(d)
    v += lean * 2.2 * np.sqrt(d) / np.linalg.norm(lean)
    group = int(n * share)
    v[:group] = v[0] + draw.standard_normal((group, d)) * spread * np.linalg.norm(v[0]) / np.sqrt(d)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    assert 0.8 < (v[-500:] @ v[-1000:-500].T).mean() < 0.86
    cells, _ = embeddings.find_cells(v, n, 0.95)
    none, row, code, _, core = embeddings.cells_of(v, np.arange(n), cells)
    a, b = draw.integers(0, group, (2, 20_000))
    linked = (a != b) & (np.einsum("ij,ij->i", v[a], v[b]) >= 0.95)
    a, b = a[linked], b[linked]
    assert len(a) > 5000 and (~none[a] | ~none[b]).mean() >= 0.99
    # an end outside the core is around it
    met = {}
    for r, c in zip(row.tolist(), code.tolist(), strict=True):
        met.setdefault(r, set()).add(c)
    assert all(met.get(x, set()) & met.get(y, set()) for x, y, ok in zip(a[:300].tolist(), b[:300].tolist(), (~none[a] | ~none[b])[:300], strict=True) if ok)


def test_vector_recall_on_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    found = {r.vec_id: r.n_links for r in near_duplicates(frame, leaf=32, trees=8).collect()}
    rows = frame.collect()
    unit = np.array([r.embedding for r in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert all(found[r.vec_id] <= n for r, n in zip(rows, links, strict=True))
    assert sum(found.values()) >= 0.9 * links.sum()


def test_vectors_in_large_groups(spark, monkeypatch):
    """Groups of thousands of near copies, at the defaults: every link between their vectors, in one block and in several."""
    draw = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centres = unit(draw.standard_normal((2, 64)))
    near = [unit(c + draw.standard_normal((n, 64)) * s / 8) for c, n, s in zip(centres, (4000, 2000), (0.2, 0.25), strict=True)]
    vectors = np.concatenate([*near, unit(draw.standard_normal((8000, 64)))])
    links = np.concatenate([(vectors[k : k + 2000] @ vectors.T >= 0.95).sum(axis=1) - 1 for k in range(0, len(vectors), 2000)])
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(8)
    for size in (embeddings.BLOCK_BYTES, 1):
        monkeypatch.setattr(embeddings, "BLOCK_BYTES", size)
        found = {r.vec_id: r for r in near_duplicates(frame).collect()}
        assert all(found[k].n_links <= n for k, n in enumerate(links.tolist()))
        assert sum(r.n_links for r in found.values()) >= 0.999 * links.sum()
        assert sum(found[k].component_id == 0 for k in range(4000)) >= 3990

"""Encoding against the tokenizers library, decoding round trips, and packing plans against their rules."""

import random
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cashloom.llm.bpe import Vocabulary, decode_documents, encode_documents, token_digests
from cashloom.llm.packing import CAPACITY, pack_documents, plan_bins

PATH = public_tokenizers.path("word_bpe_49k.json")
EDGES = [
    None, "", " ", "a", "I'LL we'Re 12 ½", "ΣΑΣ İstanbul ǅ", "日本語 🙂👍 ​", "x" * 5000, "ab" * 3000,
    "<|endoftext|>a<|startoftext|>", "''s's't", "\x00\x1c\x85\xa0", "é é ñ", "!!!???...",
]


@pytest.fixture(scope="module")
def vocab():
    return Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_equals_the_library(vocab, library, documents):
    for text in [*EDGES, *(t for _, t in documents[1])]:
        ids = vocab.encode(text or "")
        assert ids.tolist() == ids_of(library, text)
        assert vocab.decode(ids).decode() == library.decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("abthein'. sr1", max_size=60))
def test_equals_the_library_on_any_text(text):
    vocab = VOCAB.setdefault("v", None) or VOCAB.__setitem__("v", Vocabulary(PATH)) or VOCAB["v"]
    assert vocab.encode(text).tolist() == vocab.file.encode(text, add_special_tokens=False).ids


VOCAB: dict = {}


def test_may_follow_is_what_merging_does(vocab):
    draw = random.Random(2)
    reached = {i for _, i in vocab.automaton.items()}
    assert len(reached) == len(vocab.symbols)
    tokens = [i for i in reached if all(ord(c) < 128 for c in vocab.symbols[i])]
    ends = [i for i in reached if ord(vocab.symbols[i][-1]) >= 256 and all(ord(c) % 256 < 128 for c in vocab.symbols[i])]
    for _ in range(2000):
        a, b = draw.choice(tokens), draw.choice(ends)
        word = "".join(chr(ord(c) % 256) for c in vocab.symbols[a] + vocab.symbols[b])
        if vocab.words(word.lower()) == [word]:
            assert vocab.may_follow(a, b) == (ids_of(vocab.file, word) == [a, b])


def test_frames(spark, library):
    rows = [(k, t, "kept") for k, t in enumerate(EDGES)] + [(None, "null id", None), (3, "a", "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = encode_documents(frame, PATH)
    assert coded.columns == ["doc_id", "text", "ids"]
    assert sorted((r.text or "", r.ids) for r in coded.collect()) == sorted((t or "", ids_of(library, t)) for _, t, _ in rows)
    decoded = {tuple(r.ids): r.decoded for r in decode_documents(coded, PATH).collect()}
    assert all(d == library.decode(list(i), skip_special_tokens=False) for i, d in decoded.items())
    found = token_digests(frame, PATH).collect()
    assert Counter(r.ids_sha256 for r in found) == Counter(sha256(" ".join(map(str, ids_of(library, t))).encode()).hexdigest() for _, t, _ in rows)
    assert token_digests(frame.limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_plans_keep_the_rules(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 30, 100, 4096])
    kinds = [lambda: draw.randint(1, capacity), lambda: draw.randint(1, max(1, capacity // 3)), lambda: capacity // 2]
    counts = Counter(draw.choice(kinds)() for _ in range(draw.randint(0, 400)))
    bins, placed, ranks = defaultdict(list), Counter(), defaultdict(list)
    for p in plan_bins(counts, capacity):
        placed[p.length] += p.each * p.bins
        ranks[p.length].append((p.first, p.each * p.bins))
        for b in range(p.bins):
            bins[p.sequence + b].append((p.offset, p.each * p.length))
    assert placed == counts and sorted(bins) == list(range(len(bins)))
    for content in bins.values():
        end = 0
        for offset, size in sorted(content):
            assert offset == end
            end += size
        assert end <= capacity
    for spans in ranks.values():
        end = 0
        for first, size in sorted(spans):
            assert first == end
            end += size
    # no bin can be saved by more than first-fit's bound
    least = max(-(-sum(k * n for k, n in counts.items()) // capacity), sum(n for k, n in counts.items() if 2 * k > capacity))
    assert len(bins) <= least * 11 / 9 + 1


def test_plan_size_does_not_follow_the_counts():
    counts = {k: 5000 - k for k in range(1, CAPACITY + 1)}
    assert len(plan_bins(counts)) < 4 * len(plan_bins({k: 10**6 * n for k, n in counts.items()})) < 200_000
    with pytest.raises(ValueError):
        plan_bins({CAPACITY + 1: 1})


def test_packed_documents(spark, library, documents):
    texts = [(k, t) for k, t in enumerate(EDGES)] + [(None, "null id"), (1, ""), (99, "word " * 9000)] + documents[1]
    frame = spark.createDataFrame([(k, t, 1) for k, t in texts], "doc_id long, text string, length int")
    found = pack_documents(frame, PATH).collect()
    expected = Counter()
    for k, t in texts:
        ids = [*ids_of(library, t), 1]
        for n, at in enumerate(range(0, len(ids), CAPACITY)):
            part = ids[at : at + CAPACITY]
            expected[k, n, at, len(part), crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    by_bin = defaultdict(list)
    for r in found:
        by_bin[r.sequence_id].append((r.offset, r.length))
    for content in by_bin.values():
        end = 0
        for offset, size in sorted(content):
            assert offset == end
            end += size
        assert end <= CAPACITY
    assert len(by_bin) <= -(-sum(r.length for r in found) // CAPACITY) + 1
    assert pack_documents(frame.limit(0), PATH).count() == 0

"""Long repeats across documents by a run-length compressed suffix index.

A position of a document is an anchor if the hash of the bytes from there is the smallest of
any window of the required length around it. Equal windows choose the same anchor, so the
places of repeated anchors are the only ones where windows can repeat, and the bytes around an
anchor, its context, go to a bucket chosen by the anchor: windows that are equal meet in one
bucket, however many documents there are. A context holds the windows of which its anchor is the
least, so each window is sent once. An anchor that too many contexts share has no
bucket: its windows are hashed, the first of each hash is found by an aggregation that combines
before the shuffle, and a join back marks the others.

A bucket's distinct contexts are indexed by a run-compressed Burrows-Wheeler transform that
keeps the text position at both ends of each run. The position at the head of a run, the one
at the end of the run before, and how far the text from both agrees are all that is needed:
from there the longest match with the neighbour in suffix order is streamed along the text,
one byte shorter and one place further on at each step until the next sampled position.
Windows whose match is long enough form chains of equal windows; all but the first of the
corpus in each chain are marked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b, sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..sources.staging import Staging, shared_copy
from .memory import letting_go, letting_go_of_groups
from .ngram import mix

LENGTH = 100
"""Bytes of a string whose later occurrences are removed."""

GRAM = 16
"""Bytes that an anchor's hash covers."""

CHUNK = 1 << 18
"""Bytes of a document whose anchors are found at once."""

BUCKET_BYTES = 800_000
"""Context bytes of a bucket, at most on average; before equal contexts are put together."""

FLUSH = 60_000
"""Contexts a task holds before it hands them on."""

ANCHOR_BUCKET = 300_000
"""Anchors of a bucket, on average."""

HOT = 10_000
"""Contexts of one anchor that may meet in a bucket; they are counted to within a factor of two."""

HELD_WINDOWS = 200_000
"""Keys or windows around such anchors, and marks of them, that a task holds before it hands them on."""

BROADCAST_ROWS, BROADCAST_BYTES = 2_000_000, 64 << 20
"""Bounds on what is broadcast to meet the texts; more is joined by a shuffle."""

_LAST = (1 << 63) - 1


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position."""
    words = data.astype(np.uint64)
    for step in (1, 2, 4):
        words = words[: len(words) - step] | words[step:] << np.uint64(8 * step)
    return mix(words[:-8] ^ mix(words[8:] + np.uint64(0x9E3779B97F4A7C15)))


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of each ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        values = best(values[: len(values) - size], values[size:])
        size *= 2
    rest = width - size
    return best(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of a document's anchors; none where it is shorter than ``length``."""
    width = length - GRAM + 1
    places, hashes = [], []
    for start in range(0, len(data) - length + 1, CHUNK):
        found = gram_hashes(data[start : start + CHUNK + length - 1])
        least = _sliding(found, width, np.minimum)
        # a hash is an anchor's if it is the least of a window around it
        padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
        padded[width - 1 : width - 1 + len(least)] = least
        at = np.flatnonzero(found == _sliding(padded, width, np.maximum))
        places.append(at + start)
        hashes.append(found[at])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    place, hashed = np.concatenate(places), np.concatenate(hashes)
    place, fresh = np.unique(place, return_index=True)  # the ends of chunks are seen twice
    return place, hashed[fresh]


def _runs(values: np.ndarray) -> list[slice]:
    """Where runs of equal values lie."""
    if not len(values):
        return []
    cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return [slice(a, z) for a, z in zip(cuts, cuts[1:], strict=False)]


class RunIndex(NamedTuple):
    """A run-compressed transform: symbol (-1 at a string's start) and length of each run, text positions at its ends."""

    symbols: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    last: np.ndarray


def suffix_order(text: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Positions of the suffixes of ``length`` bytes and more, by at least their first ``length``, then by position.

    ``left``: bytes from each position to its string's end, which is a symbol below all bytes.
    Prefix doubling in which only suffixes that still tie, and that a longer one still asks
    for, are sorted again.
    """
    n = len(text)
    symbols = np.zeros(n + 6, np.uint64)
    symbols[:n] = text.astype(np.uint64) + np.uint64(1)
    packed = symbols[:n].copy()
    for step in range(1, 7):
        packed <<= np.uint64(9)
        packed |= symbols[step : step + n] * (left > step)
    order = np.argsort(packed, kind="stable")
    packed = packed[order]
    head = np.ones(n, bool)
    np.not_equal(packed[1:], packed[:-1], out=head[1:])
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, slots, 0))
    place, size = order, 7
    while size < length:
        tied = ~head
        tied[:-1] |= ~head[1:]
        # of shorter suffixes only those are told apart further that one of ``length`` bytes leads to
        tied &= left[place] > max(0, length - size * (-(-length // size) - 1) - 1)
        slots, place = slots[tied], place[tied]
        if not len(slots):
            break
        after = np.where(left[place] > size, rank[np.minimum(place + size, n - 1)] + 1, 0)
        keys = rank[place] << 32 | after
        by = np.argsort(keys, kind="stable")
        keys, place = keys[by], place[by]
        order[slots] = place
        head = np.ones(len(slots), bool)
        np.not_equal(keys[1:], keys[:-1], out=head[1:])
        rank[place] = np.maximum.accumulate(np.where(head, slots, 0))
        size *= 2
    return order[left[order] >= length]


def run_index(text: np.ndarray, starts: np.ndarray, left: np.ndarray, length: int) -> RunIndex:
    """The transform of the strings' suffixes that are long enough to match.

    As shorter suffixes are left out, a suffix and its neighbour may be carried on from one
    that is not next to it; runs are broken there too, so that every step between two sampled
    positions leads from neighbours to neighbours.
    """
    order = suffix_order(text, left, length)
    n = len(order)
    begins = np.zeros(len(text), bool)
    begins[starts] = True
    before = np.where(begins[order], -1, text[order - 1].astype(np.int16))
    neighbour = np.full(len(text), -1, np.int64)
    neighbour[order[1:]] = order[:-1]
    # strings' ends differ from each other, so each stands in a run of its own
    head = np.ones(n, bool)
    head[1:] = (before[1:] != before[:-1]) | (before[1:] < 0) | (neighbour[order[1:] - 1] != order[:-1] - 1)
    at = np.flatnonzero(head)
    ends = np.append(at[1:], n)
    return RunIndex(before[at], ends - at, order[at], order[ends - 1])


def agreement(text: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length on which the text from positions ``a`` and ``b`` agrees within their strings."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = padded[: len(text) + 7].astype(np.uint64)
    for step in (1, 2, 4):
        words = words[: len(words) - step] | words[step:] << np.uint64(8 * step)
    most = np.minimum(left[a], left[b]).astype(np.int64)
    found = np.zeros(len(a), np.int64)
    active = np.arange(len(a))
    while len(active):
        x = words[a[active] + found[active]] ^ words[b[active] + found[active]]
        # zero bytes at the low end, where the text goes on
        low = x & (~x + np.uint64(1))
        same = np.where(x == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64)
        found[active] += same
        active = active[(same == 8) & (found[active] < most[active])]
    return np.minimum(found, most)


def matches(index: RunIndex, text: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose longest match with their neighbour in suffix order has ``length`` bytes, and that neighbour.

    At the head of a run the neighbour is the sampled end of the run before. From one sampled
    position to the next in the text, the neighbour moves along and the match gets shorter.
    """
    place, neighbour = index.first[1:], index.last[:-1]
    reach = agreement(text, left, place, neighbour)
    # the very first suffix has no neighbour, but ends what is carried on from the sample before
    place, neighbour, reach = np.append(place, index.first[:1]), np.append(neighbour, index.first[:1]), np.append(reach, index.first[:1] * 0)
    by = np.argsort(place)
    place, neighbour, reach = place[by], neighbour[by], reach[by]
    until = np.concatenate([place[1:], [len(text)]])
    count = np.clip(np.minimum(until - place, reach - length + 1), 0, None)
    long = count > 0
    count, place, neighbour = count[long], place[long], neighbour[long]
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(place, count) + step, np.repeat(neighbour, count) + step


def later_windows(contexts: list[bytes], owner: np.ndarray, start: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Owner and position of every window that equals one with a smaller (owner, position).

    ``owner`` and ``start`` say whose and where each context is.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    text = np.frombuffer(b"".join(contexts), np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    which = np.repeat(np.arange(len(contexts)), sizes)
    inside = np.arange(len(text)) - starts[which]
    left = sizes[which] - inside
    place, neighbour = matches(run_index(text, starts, left, length), text, left, length)
    # chains of equal windows: every one is led to the first of its chain in suffix order
    lead = np.arange(len(text))
    lead[place] = neighbour
    part = place
    while len(part):
        further = lead[lead[part]]
        moved = further != lead[part]
        lead[part] = further
        part = part[moved]
    linked = np.zeros(len(text), bool)
    linked[place] = linked[neighbour] = True
    members = np.flatnonzero(linked)
    whose, where = owner[which[members]], start[which[members]] + inside[members]
    chain = lead[members]
    by = np.lexsort((where, whose, chain))
    whose, where, chain = whose[by], where[by], chain[by]
    head = np.concatenate([[True], chain[1:] != chain[:-1]]) if len(chain) else np.empty(0, bool)
    leader = np.maximum.accumulate(np.where(head, np.arange(len(chain)), 0))
    later = (whose != whose[leader]) | (where != where[leader])
    return whose[later], where[later]


def hopeful(contexts: list[bytes], offsets: list[int], length: int = LENGTH) -> list[bool]:
    """Whether a context may share a window with another that has the same anchor.

    Around equal anchors a common window reaches ``length - GRAM`` bytes to the left and right
    together, so for some step of a grid it reaches at least so far to the left and so far to
    the right; contexts that agree with no other on any step share none.
    """
    around = length - GRAM
    grid = [(k * around // 4, (3 - k) * around // 4) for k in range(4)]
    seen: dict[tuple[int, bytes], int] = {}
    steps = []
    for context, at in zip(contexts, offsets, strict=True):
        mine = [(left, context[at - left : at + GRAM + right]) for left, right in grid if at >= left and len(context) - at - GRAM >= right]
        steps.append(mine)
        for key in mine:
            seen[key] = seen.get(key, 0) + 1
    return [any(seen[key] > 1 for key in mine) for mine in steps]


def _spans(whose: np.ndarray, where: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, start and end of the stretches that windows at these places cover."""
    if not len(whose):
        return whose, where, where
    by = np.lexsort((where, whose))
    whose, where = whose[by], where[by]
    head = np.concatenate([[True], (whose[1:] != whose[:-1]) | (where[1:] - where[:-1] > length)])
    at = np.flatnonzero(head)
    return whose[at], where[at], where[np.concatenate([at[1:] - 1, [len(where) - 1]])] + length


def text_id(text: Column) -> Column:
    """64 bits of a text's SHA-256."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, -10).cast("long")


def _sid(data: bytes) -> int:
    return int.from_bytes(sha256(data).digest()[:8], "big", signed=True)


_ANCHOR = np.dtype([("hash", "<u8"), ("owner", "<u4"), ("place", "<u4")])


def repeated_anchors(texts: DataFrame, buckets: int, length: int = LENGTH) -> DataFrame:
    """sid and place of anchors found more than once; ``texts``: one column, text.

    A row without a sid has the mixed hash of an anchor found more than HOT times instead. One row
    an anchor: a row for each text and bucket would grow with the product of both.

    Copies of a text within a task count once, those of other tasks as repeats of each other.
    Of a task's own repeats one goes to the anchor's bucket and all are known already, so an
    anchor that a third of all texts share brings its bucket one row per task.
    """

    bound = HOT

    def emit(found: list, task: int) -> Iterator[pa.RecordBatch]:
        if not found:
            return
        sids = np.array([f[0] for f in found], np.int64)
        owner = np.repeat(np.arange(len(found)), [len(f[1]) for f in found])
        # an anchor's hash is the least of many; mixed once more, hashes spread over the buckets alike
        place, hashed = np.concatenate([f[1] for f in found]), mix(np.concatenate([f[2] for f in found]))
        by = np.argsort(hashed)
        owner, place, hashed = owner[by], place[by], hashed[by]
        head = np.concatenate([[True], hashed[1:] != hashed[:-1]])
        many = ~head | np.concatenate([~head[1:], [False]])
        power = np.zeros(len(hashed), np.int64)
        power[head] = np.log2(np.diff(np.append(np.flatnonzero(head), len(hashed)))).astype(np.int64)
        made = []

        def packed(bucket: int, pick: np.ndarray, shared: bool) -> None:
            names, at = np.unique(owner[pick], return_inverse=True)
            block = np.empty(len(at), _ANCHOR)
            # fewer than 2**24 texts are held at once; the byte above has the power of two in an anchor's number
            block["hash"], block["owner"], block["place"] = hashed[pick], at | power[pick] << 24, place[pick]
            made.append((bucket, shared, block.tobytes(), sids[names].tobytes()))

        single = np.flatnonzero(head)
        target = ((hashed[single] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        for at in _runs(target):
            packed(int(target[at.start]), single[at], False)
        known = np.flatnonzero(many)
        known = known[np.argsort(owner[known], kind="stable")]
        for k in range(0, len(known), 1 << 18):
            packed((task * 7919 + k) % buckets, known[k : k + (1 << 18)], True)
        for k in range(0, len(made), 64):
            columns = list(zip(*made[k : k + 64], strict=True))
            kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["bucket", "shared", "block", "names"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, found, held = TaskContext.get().partitionId(), set(), [], 0
        for batch in batches:
            pa.default_memory_pool().release_unused()  # of the batch before
            for x in batch.column(0):
                data = (x.as_py() or "").encode("utf-8", "surrogatepass")
                sid = _sid(data)
                if len(data) < length or sid in seen:
                    continue
                seen.add(sid)
                place, hashed = anchors(np.frombuffer(data, np.uint8), length)
                found.append((sid, place, hashed))
                held += len(place)
                if held > ANCHOR_BUCKET:
                    yield from emit(found, task)
                    found, held = [], 0
        yield from emit(found, task)

    def meet(table: pa.Table) -> pa.Table:
        parts = []
        for s, block, names in zip(*(table.column(c) for c in ("shared", "block", "names")), strict=True):
            got = np.frombuffer(block.as_buffer(), _ANCHOR)
            whose = np.frombuffer(names.as_buffer(), np.int64)[got["owner"] & 0xFFFFFF]
            parts.append((got["hash"], whose, got["place"], np.full(len(got), s.as_py()), np.int64(1) << (got["owner"] >> 24).astype(np.int64)))
        hashed, owner, place, known, number = (np.concatenate(c) for c in zip(*parts, strict=True))
        by = np.flatnonzero(~known)
        by = by[np.argsort(hashed[by])]
        # the same place of the same text, from another task's copy, is no repeat
        h, o, a = hashed[by], owner[by], place[by]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
        hot = h[first][np.add.reduceat(number[by], first) > bound] if len(h) else h
        twice = np.zeros(len(by), bool)
        twice[1:] = (h[1:] == h[:-1]) & ((o[1:] != o[:-1]) | (a[1:] != a[:-1]))
        twice[:-1] |= twice[1:]
        pick = np.concatenate([by[twice], np.flatnonzero(known)])
        pick = pick[np.argsort(owner[pick], kind="stable")]
        names = pa.concat_arrays([pa.array(owner[pick]), pa.nulls(len(hot), pa.int64())])
        return pa.table({"sid": names, "place": pa.array(np.concatenate([place[pick].astype(np.int64), hot.view(np.int64)]))})

    return texts.mapInArrow(letting_go(rows), "bucket int, shared boolean, block binary, names binary").groupBy("bucket").applyInArrow(letting_go_of_groups(meet), "sid long, place long")


def _meeting(texts: DataFrame, small: DataFrame, how: str) -> DataFrame:
    """``texts`` joined by (o, sid) to a stored table that is broadcast if it is small."""
    sizes = [F.octet_length(f.name) for f in small.schema if f.dataType.typeName() in ("binary", "string")]
    lists = [
        F.size(f.name) * 4 if f.dataType.elementType.typeName() == "integer" else F.aggregate(f.name, F.lit(0), lambda n, x: n + F.octet_length(x) + 40)
        for f in small.schema
        if f.dataType.typeName() == "array"
    ]
    bytes_ = sum((F.coalesce(x, F.lit(0)) for x in sizes + lists), F.lit(0).cast("long"))
    found = small.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(bytes_), F.lit(0)).alias("bytes")).first()
    fits = found.n <= BROADCAST_ROWS and found.bytes <= BROADCAST_BYTES
    return texts.join(F.broadcast(small) if fits else small, ["o", "sid"], how)


def _anchors_at(data: bytes, places: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text's anchors, and their hashes."""
    at = np.unique(places.values.to_numpy()).astype(np.int64)
    at = at[at <= len(data) - GRAM]
    grams = np.frombuffer(data, np.uint8)[at[:, None] + np.arange(GRAM)].astype(np.uint64)
    shifts = np.uint64(8) * np.arange(8, dtype=np.uint64)
    low, high = (grams[:, :8] << shifts).sum(axis=1, dtype=np.uint64), (grams[:, 8:] << shifts).sum(axis=1, dtype=np.uint64)
    return at, mix(low ^ mix(high + np.uint64(0x9E3779B97F4A7C15)))


def _contexts(at: np.ndarray, hashes: np.ndarray, size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each anchor's context in a text of ``size`` bytes: the windows that hold no anchor of a smaller hash.

    ``at``: sorted places of all the text's repeated anchors. A window that repeats does so around
    its least anchor, which is among them wherever the window stands, so it lies in that one's context.
    """
    start, stop = np.maximum(0, at + GRAM - length), np.minimum(size, at + length)
    reach = length - GRAM
    for step in range(1, len(at)):
        near = at[step:] - at[:-step] <= reach
        if not near.any():
            break
        left, right = np.flatnonzero(near & (hashes[:-step] < hashes[step:])), np.flatnonzero(near & (hashes[step:] < hashes[:-step]))
        start[left + step] = np.maximum(start[left + step], at[left] + 1)
        stop[right] = np.minimum(stop[right], at[right + step] + GRAM - 1)
    return start, stop


_PIECE = np.dtype([("high", "<u8"), ("low", "<u8"), ("owner", "<u4"), ("place", "<u4")])
_NAME = np.dtype([("o", "<i8"), ("sid", "<u8")])
_MASK = (1 << 64) - 1

STEPS = 4
"""Keys of a context around a hot anchor; a window repeats only if one of them does."""


def _grid(length: int) -> list[tuple[int, int]]:
    """Bytes left and right of an anchor that each key of its context covers."""
    around = length - GRAM
    return [(k * around // STEPS, (STEPS - 1 - k) * around // STEPS) for k in range(STEPS)]


def _met(texts: DataFrame, pieces: Callable, buckets: int, later: bool) -> DataFrame:
    """o, sid and places (packed unsigned 32-bit) of pieces that occur more than once: all of them, or with ``later`` all but each one's first.

    ``pieces`` gives (place, bytes) of a row of ``texts``: o, sid, text, places. A task puts its
    own equal pieces together and packs what is left by a bucket of the hash, so a piece that a
    third of all texts share brings its bucket one entry each time a task hands on. Pieces are
    told apart by 128-bit hashes; "first" is by o, sid and place.
    """
    limit = HELD_WINDOWS

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: dict[bytes, tuple[int, int, int]] = {}
        marks: list[tuple[int, int, int]] = []
        twice: set[bytes] = set()

        def packed(entries: list[tuple[int, int, int]], hashes: np.ndarray) -> tuple[bytes, bytes]:
            owners: dict[tuple[int, int], int] = {}
            block = np.zeros(len(entries), _PIECE)
            block["owner"] = [owners.setdefault(e[:2], len(owners)) for e in entries]
            block["place"] = [e[2] for e in entries]
            if len(hashes):
                block["high"], block["low"] = hashes[:, 0], hashes[:, 1]
            return block.tobytes(), np.array(list(owners), _NAME).tobytes()

        def emit() -> Iterator[pa.RecordBatch]:
            made = []
            if held:
                if not later:
                    marks.extend(held[h] for h in twice)
                hashes = np.frombuffer(b"".join(held), "<u8").reshape(-1, 2)
                entries = list(held.values())
                target = hashes[:, 0] % np.uint64(buckets)
                order = np.argsort(target, kind="stable")
                for at in _runs(target[order]):
                    mine = order[at]
                    made.append((int(target[mine[0]]), False, *packed([entries[k] for k in mine.tolist()], hashes[mine])))
            for k in range(0, len(marks), 1 << 16):
                made.append(((task * 7919 + k) % buckets, True, *packed(marks[k : k + (1 << 16)], np.empty((0, 2)))))
            for k in range(0, len(made), 64):
                columns = zip(*made[k : k + 64], strict=True)
                kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["bucket", "marked", "block", "names"])
            held.clear()
            marks.clear()
            twice.clear()

        for batch in batches:
            for o, sid, text_, places in zip(*(batch.column(c) for c in ("o", "sid", "text", "places")), strict=True):
                name = (o.as_py(), sid.as_py() & _MASK)  # texts of one id are ordered like their hashes
                for place, piece in pieces(text_.as_py().encode("utf-8", "surrogatepass"), places):
                    h, mine = blake2b(piece, digest_size=16).digest(), (*name, place)
                    before = held.get(h)
                    if before is None:
                        held[h] = mine
                    elif before != mine:
                        twice.add(h)
                        marks.append(max(before, mine))
                        held[h] = min(before, mine)
                if len(held) + len(marks) > limit:
                    yield from emit()
        yield from emit()

    def meet(table: pa.Table) -> pa.Table:
        blocks, names, known = [], [], []
        for marked, block, listed in zip(*(table.column(c) for c in ("marked", "block", "names")), strict=True):
            blocks.append(np.frombuffer(block.as_buffer(), _PIECE))
            names.append(np.frombuffer(listed.as_buffer(), _NAME)[blocks[-1]["owner"]])
            known.append(np.full(len(blocks[-1]), marked.as_py()))
        found, name, marked = (np.concatenate(x) for x in (blocks, names, known))
        o, sid, place = name["o"], name["sid"], found["place"]
        at = np.flatnonzero(~marked)
        order = at[np.lexsort((place[at], sid[at], o[at], found["low"][at], found["high"][at]))]
        high, low = found["high"][order], found["low"][order]
        head = np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]) if len(order) else np.empty(0, bool)
        leader = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
        first = order[leader]
        differs = (o[order] != o[first]) | (place[order] != place[first]) | (sid[order] != sid[first])
        if not later:
            shared = np.zeros(len(order), bool)
            shared[leader[differs]] = True  # with another one, the first counts too
            differs |= shared
        pick = np.concatenate([order[differs], np.flatnonzero(marked)])
        pick = pick[np.lexsort((place[pick], sid[pick], o[pick]))]
        o, sid, place = o[pick], sid[pick], place[pick]
        cuts = _runs_of_two(o, sid)
        blobs = [np.unique(place[x]).astype("<u4").tobytes() for x in cuts]
        heads = [x.start for x in cuts]
        return pa.table({"o": pa.array(o[heads], pa.int64()), "sid": pa.array(sid[heads].view(np.int64)), "places": pa.array(blobs, pa.binary())})

    sent = texts.mapInArrow(letting_go(rows), "bucket int, marked boolean, block binary, names binary")
    return sent.groupBy("bucket").applyInArrow(letting_go_of_groups(meet), "o long, sid long, places binary")


def _runs_of_two(a: np.ndarray, b: np.ndarray) -> list[slice]:
    """Where runs of equal pairs lie."""
    if not len(a):
        return []
    cuts = [0, *(np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1).tolist(), len(a)]
    return [slice(x, z) for x, z in zip(cuts, cuts[1:], strict=False)]


def hot_spans(texts: DataFrame, hot: np.ndarray, buckets: int, stage: Staging, length: int = LENGTH) -> DataFrame:
    """o, sid and part of the windows around hot anchors that equal an earlier one; ``texts``: o, sid, text, places.

    First the keys of the contexts meet, a few for each; where a key repeats, only the windows that
    reach as far to both sides as it does can repeat, and only those are hashed then.
    """
    grid = _grid(length)
    around = length - GRAM

    def keys(data: bytes, places: pa.Scalar) -> Iterator[tuple[int, bytes]]:
        at, hashes = _anchors_at(data, places)
        for place in at[np.isin(mix(hashes), hot)].tolist():
            for k, (left, right) in enumerate(grid):
                if place >= left and place + GRAM + right <= len(data):
                    # where the anchor lies in it follows from the key's number
                    yield place * STEPS + k, bytes([k]) + data[place - left : place + GRAM + right]

    def windows(data: bytes, found: pa.Scalar) -> Iterator[tuple[int, bytes]]:
        packed = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in found.values]).astype(np.int64)
        place, k = packed // STEPS, packed % STEPS
        low = np.array([left for left, _ in grid])[k]
        # a window that starts ``left`` bytes before the anchor ends ``around - left`` behind it; the next key takes over where its own bytes are covered
        high = np.array([*(left - 1 for left, _ in grid[1:]), around])[k]
        spread = np.arange(around // STEPS + STEPS + 1)
        starts = place[:, None] - low[:, None] - spread
        starts = np.unique(starts[(spread <= (high - low)[:, None]) & (starts >= 0) & (starts <= len(data) - length)])
        for start in starts.tolist():
            yield start, data[start : start + length]

    hopeful_ = stage(_met(texts, keys, max(1, buckets // 8), later=False))
    listed = stage(hopeful_.groupBy("o", "sid").agg(F.collect_list("places").alias("places")))
    again = _meeting(texts.drop("places"), listed, "inner")
    found = _met(again, windows, buckets, later=True)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for x in batch.column("places"):
                starts = np.frombuffer(x.as_buffer(), "<u4").tolist()
                parts.append(np.array(union([(a, a + length) for a in starts]), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("o"), batch.column("sid"), pa.array(parts, pa.binary())], names=["o", "sid", "part"])

    return found.mapInArrow(letting_go(merged), "o long, sid long, part binary")


def repeat_spans(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """o, sid, whole and spans of every document from which something goes.

    o is the id (the largest number where it is NULL) and sid the number of the text (64 bits of
    its SHA-256), together a document; rows that agree in both are one. whole: a later copy of a whole
    text, of which all goes. spans: (start, stop) pieces, sorted and apart, of any other, packed as
    unsigned 32-bit numbers.
    """
    source = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("o"), F.coalesce(text, F.lit("")).alias("text"))
    hashed = source.withColumn("sid", text_id(F.col("text")))
    work = Staging(docs.sparkSession)
    listed = work(hashed.select("o", "sid", F.octet_length("text").alias("n")))
    classes = listed.where(F.col("n") >= length).groupBy("sid").agg(F.min("o").alias("o"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"))
    classes = work(classes)
    total = listed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n

    found = work(repeated_anchors(source.select("text"), max(1, total // 40 // ANCHOR_BUCKET), length))
    # one value per text before anything is joined: a text's anchors come from many buckets
    hot = np.unique(np.array([r.place for r in found.where("sid is null").select("place").collect()], np.int64).view(np.uint64))
    whole = found.where("sid is not null").groupBy("sid").agg(F.collect_list(F.col("place").cast("int")).alias("places"))
    placed = work(whole.join(classes.select("sid", "o"), "sid").select("o", "sid", "places"))
    size = placed.agg(F.coalesce(F.sum(F.size("places").cast("long")), F.lit(0)).alias("n")).first().n
    buckets = max(1, size * (2 * length - GRAM) // BUCKET_BYTES)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, round_ = TaskContext.get().partitionId(), 0
        held: dict[bytes, tuple[int, bytes, int]] = {}
        marks: list[tuple[int, bytes, int, int]] = []

        def emit() -> Iterator[pa.RecordBatch]:
            by_bucket: dict[int, list[bytes]] = {}
            for k in held:
                by_bucket.setdefault(bucket_of[k], []).append(k)
            made = []
            for b, group in by_bucket.items():
                owners = {}
                rows = np.array([(owners.setdefault(held[k][:2], len(owners)), held[k][2], len(k)) for k in group], np.int64)
                names = b"".join(o.to_bytes(8, "little", signed=True) + s for o, s in owners)
                made.append((b, False, b"".join(group), rows.astype("<u4").tobytes(), names))
            for k in range(0, len(marks), 1 << 16):
                part = marks[k : k + (1 << 16)]
                owners = {}
                rows = np.array([(owners.setdefault((o, s), len(owners)), a, z) for o, s, a, z in part], np.int64)
                names = b"".join(o.to_bytes(8, "little", signed=True) + s for o, s in owners)
                made.append(((task * 7919 + round_ + k) % buckets, True, b"", rows.astype("<u4").tobytes(), names))
            for k in range(0, len(made), 64):
                columns = list(zip(*made[k : k + 64], strict=True))
                kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["bucket", "marked", "bytes", "rows", "names"])

        bucket_of: dict[bytes, int] = {}
        for batch in batches:
            pa.default_memory_pool().release_unused()
            for o, sid, text_, places in zip(*(batch.column(c) for c in ("o", "sid", "text", "places")), strict=True):
                owner, name = o.as_py(), (sid.as_py() & _MASK).to_bytes(8, "big")
                data = text_.as_py().encode("utf-8", "surrogatepass")
                at, hashes = _anchors_at(data, places)
                begin, end = _contexts(at, hashes, len(data), length)
                hashes = mix(hashes)
                whole_ = end - begin >= length
                if len(hot):
                    whole_ &= ~np.isin(hashes, hot)
                at, hashes, begin, end = (x[whole_] for x in (at, hashes, begin, end))
                target = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                for place, bucket, start, stop in zip(at.tolist(), target.tolist(), begin.tolist(), end.tolist(), strict=True):
                    context = data[start:stop]
                    # where the anchor lies in it comes first, so that contexts of one anchor meet
                    context = (place - start).to_bytes(2, "little") + context
                    mine, before = (owner, name, start), held.get(context)
                    if before is None:
                        held[context], bucket_of[context] = mine, bucket
                    elif before != mine:
                        # all windows of the later of two equal contexts are repeats
                        later = max(before, mine)
                        held[context] = min(before, mine)
                        marks.append((*later, later[2] + len(context) - 2))
                if len(held) + len(marks) > FLUSH:
                    yield from emit()
                    held.clear()
                    bucket_of.clear()
                    marks.clear()
                    round_ += 1
        yield from emit()

    def index(table: pa.Table) -> pa.Table:
        out: list[tuple[tuple[int, bytes], int, int]] = []
        held: dict[bytes, tuple[int, bytes, int]] = {}
        for marked, data, rows, names in zip(*(table.column(c) for c in ("marked", "bytes", "rows", "names")), strict=True):
            table_, packed, data = np.frombuffer(rows.as_buffer(), "<u4").reshape(-1, 3).astype(np.int64), names.as_py(), data.as_py()
            owners = [(int.from_bytes(packed[k : k + 8], "little", signed=True), packed[k + 8 : k + 16]) for k in range(0, len(packed), 16)]
            if marked.as_py():
                out += [(owners[k], a, z) for k, a, z in table_.tolist()]
                continue
            at = 0
            for k, start, size in table_.tolist():
                context, at = data[at : at + size], at + size
                mine, before = (*owners[k], start), held.get(context)
                if before is None:
                    held[context] = mine
                elif before != mine:
                    later = max(before, mine)
                    held[context] = min(before, mine)
                    out.append((later[:2], later[2], later[2] + size - 2))
        some = hopeful([c[2:] for c in held], [int.from_bytes(c[:2], "little") for c in held], length)
        held = {c: h for (c, h), keep in zip(held.items(), some, strict=True) if keep}
        if held:
            names = sorted({h[:2] for h in held.values()})
            number = {name: k for k, name in enumerate(names)}
            ordered = sorted(held.items(), key=lambda x: x[1])
            whose = np.array([number[h[:2]] for _, h in ordered], np.int64)
            start = np.array([h[2] for _, h in ordered], np.int64)
            found = later_windows([c[2:] for c, _ in ordered], whose, start, length)
            out += [(names[k], a, z) for k, a, z in zip(*(x.tolist() for x in _spans(*found, length)), strict=True)]
        merged: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
        for name, a, z in out:
            merged.setdefault(name, []).append((a, z))
        blobs = [np.array(union(x), "<u4").tobytes() for x in merged.values()]
        sids = pa.array([int.from_bytes(n[1], "big", signed=True) for n in merged], pa.int64())
        return pa.table({"o": pa.array([n[0] for n in merged], pa.int64()), "sid": sids, "part": pa.array(blobs, pa.binary())})

    texts = _meeting(hashed, placed, "inner")
    sent = texts.mapInArrow(letting_go(contexts), "bucket int, marked boolean, bytes binary, rows binary, names binary")
    parts = sent.groupBy("bucket").applyInArrow(letting_go_of_groups(index), "o long, sid long, part binary")
    if len(hot):
        parts = parts.unionByName(hot_spans(texts, hot, max(1, 8 * total // 40 // ANCHOR_BUCKET), work, length))

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # many buckets have pieces of a document that overlap
            blobs = [np.array(union([tuple(s) for p in x.values for s in np.frombuffer(p.as_buffer(), "<u4").reshape(-1, 2).tolist()]), "<u4").tobytes() for x in batch.column("spans")]
            yield pa.RecordBatch.from_arrays([batch.column("o"), batch.column("sid"), pa.array(blobs, pa.binary())], names=["o", "sid", "spans"])

    listed_parts = parts.groupBy("o", "sid").agg(F.collect_list("part").alias("spans"))
    spans = listed_parts.mapInArrow(letting_go(united), "o long, sid long, spans binary")
    twice = classes.where("copies > 1").select("sid", F.col("o").alias("first"))
    copies = spread_join(listed, twice, "sid").where("o <> first").select("o", "sid").distinct()
    done = shared_copy(
        spans.select("o", "sid", F.lit(False).alias("whole"), "spans").unionByName(
            copies.select("o", "sid", F.lit(True).alias("whole"), F.lit(None).cast("binary").alias("spans"))
        )
    )
    work.release()
    return done


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal stretches that spans cover; spans that touch are one."""
    made: list[list[int]] = []
    for a, z in sorted(spans):
        if made and a <= made[-1][1]:
            made[-1][1] = max(made[-1][1], z)
        else:
            made.append([a, z])
    return [tuple(x) for x in made]


def cut_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, digest: bool = False) -> DataFrame:
    """``docs`` with n_bytes, n_removed and n_spans, and the text that is left in place of the whole.

    With ``digest``, kept_sha256 stands in place of the text: the hash of exactly the bytes
    left. In a text, a character of which bytes were cut off is left out. Every byte goes that
    lies in a string of ``length`` bytes which also starts earlier, in a document with a smaller
    id or earlier in the same; a NULL id comes last, rows equal in id and text are one document,
    and of different texts with one id the one with the smaller hash is the earlier. NULL and
    empty texts lose nothing and give an empty text. Columns of ``docs`` with the names of new
    ones are replaced.
    """
    new = ("n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else text)
    kept = [c for c in docs.columns if c not in (*new, text)]
    spans = repeat_spans(docs, key=key, text=text, length=length)
    source = docs.select(
        *kept, F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("o"), text_id(F.coalesce(text, F.lit(""))).alias("sid"), F.coalesce(text, F.lit("")).alias("__text")
    )
    joined = _meeting(source, spans, "left").select(*kept, "__text", "whole", "spans")
    schema = joined.select(*kept).schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add(new[3], "string")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for x, whole, parts in zip(*(batch.column(c) for c in ("__text", "whole", "spans")), strict=True):
                data = x.as_py().encode("utf-8", "surrogatepass")
                gone: list[tuple[int, int]] = []
                if whole.as_py():
                    gone = [(0, len(data))]
                elif parts.is_valid:
                    gone = [tuple(s) for s in np.frombuffer(parts.as_buffer(), "<u4").reshape(-1, 2).tolist()]
                left = b"".join(data[a:z] for a, z in zip([0, *(z for _, z in gone)], [*(a for a, _ in gone), len(data)], strict=True))
                made.append((len(data), len(data) - len(left), len(gone), sha256(left).hexdigest() if digest else left.decode("utf-8", "ignore")))
            columns = zip(*made, strict=True) if made else [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=[*kept, *new])

    return joined.mapInArrow(letting_go(rows), schema)

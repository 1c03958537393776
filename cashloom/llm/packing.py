"""Packing of token sequences into as few bins of one capacity as best-fit finds.

Lengths are whole numbers up to the capacity, so the plan is made on their histogram, whose
size does not grow with the corpus. Lengths over a third of the capacity fit at most twice in
a bin: the longest are matched first, each with the longest partner that fits beside it. The
others follow in descending order, each into the tightest gap that holds it. Bins with equal
content are one class of the plan, so its work and size depend on the capacity alone.

Pieces find their places without the driver: a piece's rank among those of its length, the
number counted within its task plus those of the tasks before, says which bin of the plan it
goes to.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import shared_copy
from .bpe import vocabulary
from .memory import letting_go

CAPACITY = 4096
END = 1
"""Token id that closes a document."""


class Placement(NamedTuple):
    """Pieces ``first`` to ``first + bins * each - 1`` of one length, ``each`` side by side in ``bins`` bins."""

    length: int
    first: int
    each: int
    bins: int
    sequence: int
    offset: int


class _Bins(NamedTuple):
    """Bins with equal content: their number, what is free in each, and (length, copies, content before)."""

    n: int
    gap: int
    content: tuple | None


def _matched(counts: dict[int, int], capacity: int) -> list[_Bins]:
    """Bins of one or two lengths over a third of the capacity, the longest matched first."""
    large = sorted(length for length in counts if 3 * length > capacity)
    left = {length: counts[length] for length in large}
    made = []
    while large:
        length = large[-1]
        at = bisect_left(large, capacity - length + 1) - 1
        if at < 0:
            made.append(_Bins(left[length], capacity - length, (length, 1, None)))
            large.pop()
            continue
        partner = large[at]
        if partner == length:
            pairs, single = divmod(left[length], 2)
            if pairs:
                made.append(_Bins(pairs, capacity - 2 * length, (length, 2, None)))
            left[length] = single
            if single:
                # the odd one may still take a shorter partner
                shorter = large[at - 1] if at else None
                if shorter is None:
                    made.append(_Bins(1, capacity - length, (length, 1, None)))
                else:
                    made.append(_Bins(1, capacity - length - shorter, (shorter, 1, (length, 1, None))))
                    left[shorter] -= 1
                    if not left[shorter]:
                        large.remove(shorter)
            large.remove(length)
            continue
        pairs = min(left[length], left[partner])
        made.append(_Bins(pairs, capacity - length - partner, (partner, 1, (length, 1, None))))
        for one in (length, partner):
            left[one] -= pairs
            if not left[one]:
                large.remove(one)
    return made


def plan_bins(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Placement]:
    """Where the pieces of each length go. ``counts``: pieces by length, from 1 to the capacity."""
    counts = {int(k): int(n) for k, n in counts.items() if n}
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError("lengths must lie between 1 and the capacity")
    by_gap: dict[int, list[_Bins]] = {}
    gaps: list[int] = []

    def put(bins: _Bins) -> None:
        if bins.gap not in by_gap:
            by_gap[bins.gap] = []
            insort(gaps, bins.gap)
        by_gap[bins.gap].append(bins)

    for bins in _matched(counts, capacity):
        put(bins)
    for length in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                bins = _Bins(-(-left // (capacity // length)), capacity, None)
            else:
                same = by_gap[gaps[at]]
                bins = same.pop()
                if not same:
                    del by_gap[gaps.pop(at)]
            # one after the other, the gap that a piece leaves is the tightest for the next
            each = bins.gap // length
            full = min(bins.n, left // each)
            rest = left - full * each if full < bins.n else 0
            if full:
                put(_Bins(full, bins.gap - each * length, (length, each, bins.content)))
            if rest:
                put(_Bins(1, bins.gap - rest * length, (length, rest, bins.content)))
            if bins.n > full + (rest > 0):
                put(_Bins(bins.n - full - (rest > 0), bins.gap, bins.content))
            left -= full * each + rest

    placed, sequence, taken = [], 0, dict.fromkeys(counts, 0)
    for gap in gaps:
        for bins in by_gap[gap]:
            offset, content = 0, bins.content
            while content is not None:
                length, each, content = content
                placed.append(Placement(length, taken[length], each, bins.n, sequence, offset))
                taken[length] += each * bins.n
                offset += each * length
            sequence += bins.n
    return placed


def token_pieces(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Each document's ids with ``end`` behind them, cut only where longer than ``capacity``.

    One row per piece: doc_id, piece, start, length, ids_crc32 (of its little-endian unsigned
    32-bit ids), and task and nth: the task that made it and its place among that task's pieces
    of the same length. NULL and empty texts are a piece of the end alone.
    """
    source = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    kind = source.schema["__key"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, task = vocabulary(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64).tolist()
        for batch in batches:
            owner, piece, start, length, check, nth = [], [], [], [], [], []
            for k, x in enumerate(batch.column("__text")):
                ids = np.append(vocab.encode(x.as_py() or ""), np.int32(end)).astype("<u4")
                for number, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    owner.append(k)
                    piece.append(number)
                    start.append(at)
                    length.append(len(part))
                    check.append(crc32(part.tobytes()))
                    nth.append(seen[len(part)])
                    seen[len(part)] += 1
            columns = [batch.column("__key").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(c, pa.int64()) for c in (start, length, check)]
            columns += [pa.array([task] * len(owner), pa.int32()), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(letting_go(rows, keep=True), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long")


def pack(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a stored table of :func:`token_pieces`) with sequence_id and offset, without task and nth.

    Places in a sequence are gapless from 0. Which of two pieces of equal length comes where is
    a matter of the tasks that made them. Other columns stay.
    """
    by_task = shared_copy(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")))
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row per length
    plan = sorted(plan_bins(counts, capacity))
    table = np.array(plan, np.int64).reshape(-1, len(Placement._fields))
    starts = table[:, 0] << 44 | table[:, 1]
    # a row per length and task; no window sees a piece
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    ranked = pieces.join(first, ["length", "task"]).withColumn("__rank", F.col("__first") + F.col("nth"))
    kept = [c for c in pieces.columns if c not in ("task", "nth", "sequence_id", "offset")]
    source = ranked.select(*kept, F.col("length").alias("__length"), "__rank")
    schema = pieces.select(*kept).schema.add("sequence_id", "long").add("offset", "long")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lengths, ranks = batch.column("__length").to_numpy(), batch.column("__rank").to_numpy()
                at = table[np.searchsorted(starts, lengths << 44 | ranks, side="right") - 1]
                inside = ranks - at[:, 1]
                found = at[:, 4] + inside // at[:, 2], at[:, 5] + inside % at[:, 2] * lengths
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), *map(pa.array, found)], names=[*kept, "sequence_id", "offset"]
                )

    return source.mapInArrow(rows, schema)


def pack_documents(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pieces of all ``docs`` with their places; an empty table gives none."""
    return pack(shared_copy(token_pieces(docs, path, capacity=capacity, end=end)), capacity=capacity)

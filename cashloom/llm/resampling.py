"""Importance resampling towards a target distribution of hashed n-grams.

A document's features are its runs of one to three words; a feature belongs to the bucket of
its CRC-32. A bucket's gain compares its share of the target texts with its share of the
corpus, a document's weight adds up the gains of its features, and a Gumbel draw on top of the
weight picks documents without replacement.

Within a task, the n-grams of a block of documents are interned in an open-addressed NumPy
table: keys are xxhash64 of an n-gram's bytes, and a slot is shared only by n-grams whose bytes
are equal. A slot stores the bucket and the number of occurrences, so the bucket is computed once
for each distinct n-gram; occurrences keep their slot and gather its gain.

Defined results: a NULL text counts as empty; a text without a word has no features and weight
0; an empty corpus or target counts as zero features. A NULL id counts as an empty one in the
draw. Repeated rows are drawn one by one, in any order among themselves.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import shared_copy

BUCKETS = 10_000
LONGEST = 3
"""Words of the longest n-gram."""

BLOCK_WORDS = 1 << 15
"""Words whose n-grams share one table; the table has four slots for each n-gram at most."""

SEGMENT = 1 << 18
"""Bytes of a text that are cut into words at once."""

_PRIMES = tuple(np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
"""Fixed values: the five primes of xxhash64."""

_STRIPE = 32
"""Bytes from which xxhash64 works on four lanes."""

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
"""A byte's lower-case form where it belongs to a word, a space elsewhere; bytes of other letters stay."""

_SHIFTS = 128
"""Byte lengths whose CRC shifts are tabulated; a longer shift takes several steps."""

_shift_table: np.ndarray | None = None


def _shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What a CRC-32 adds to that of the same bytes with ``length`` more behind them.

    CRC-32 is linear: the CRC of ``a + b`` is that of ``a``, shifted by the bytes of ``b``, xor that of ``b``.
    """
    global _shift_table
    if _shift_table is None:
        step = np.array([crc32(bytes([i ^ 255])) ^ 0xFF000000 for i in range(256)], np.uint32)
        table = np.empty((_SHIFTS, 4, 256), np.uint32)
        table[0] = np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
        for n in range(1, _SHIFTS):
            table[n] = table[n - 1] >> 8 ^ step[table[n - 1] & 255]
        _shift_table = table.reshape(-1)
    found, left = crc.astype(np.uint32), np.asarray(length, np.int64)
    while left.any():
        n = np.minimum(left, _SHIFTS - 1) * 1024
        found = (
            _shift_table[n + (found & 255)]
            ^ _shift_table[n + 256 + (found >> 8 & 255)]
            ^ _shift_table[n + 512 + (found >> 16 & 255)]
            ^ _shift_table[n + 768 + (found >> 24)]
        )
        left = np.maximum(left - (_SHIFTS - 1), 0)
    return found


class _Block(NamedTuple):
    """Words of several documents, joined by single spaces.

    ``owner`` is the document of a word in its batch, ``before`` the number of words (at most
    ``LONGEST`` - 1) of the same document ahead of it in the block, and ``counted`` is false for
    words that only lead over from the block before.
    """

    words: list[bytes]
    owner: np.ndarray
    before: np.ndarray
    counted: np.ndarray


def _segments(text: str) -> Iterator[list[bytes]]:
    """The words of a text, a bounded part at a time."""
    data = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SEGMENT)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _blocks(texts: Sequence[str | None]) -> Iterator[_Block]:
    """The texts' words in blocks of about ``BLOCK_WORDS``; a longer text goes on in the next block."""
    words: list[bytes] = []
    runs: list[tuple[int, int, int]] = []  # document, words, how many of them lead over

    def block() -> _Block:
        owner, sizes, led = (np.array(c, np.int64) for c in zip(*runs, strict=True))
        start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = np.arange(len(words)) - start
        return _Block(words, np.repeat(owner, sizes), np.minimum(place, LONGEST - 1), place >= np.repeat(led, sizes))

    for k, text in enumerate(texts):
        lead: list[bytes] = []
        for part in _segments(text or ""):
            for at in range(0, len(part), BLOCK_WORDS):
                fresh = part[at : at + BLOCK_WORDS]
                words += lead
                words += fresh
                runs.append((k, len(lead) + len(fresh), len(lead)))
                lead = words[max(len(words) - (LONGEST - 1), len(words) - runs[-1][1]) :]
                if len(words) >= BLOCK_WORDS:
                    yield block()
                    words, runs = [], []
    if words:
        yield block()


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


class _Bytes:
    """A buffer that gives the eight bytes from any position as one number."""

    def __init__(self, data: bytes) -> None:
        self.data = data
        padded = np.frombuffer(data + bytes(8), np.uint8)
        self.eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))

    def lanes(self, at: np.ndarray, size: int) -> np.ndarray:
        """``size`` bytes from each position, as numbers."""
        found = self.eight[at]
        return found if size == 8 else found & np.uint64((1 << 8 * size) - 1)

    def hashes(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """xxhash64 with seed 0 of each range."""
        p1, p2, p3, p4, p5 = _PRIMES
        found = p5 + length.astype(np.uint64)
        short = np.flatnonzero(length < _STRIPE)
        done = np.zeros(len(start), np.int64)
        for lane in range(0, _STRIPE - 8, 8):
            short = short[length[short] >= lane + 8]
            if not len(short):
                break
            k = _rotated(self.lanes(start[short] + lane, 8) * p2, 31) * p1
            found[short] = _rotated(found[short] ^ k, 27) * p1 + p4
            done[short] += 8
        four = np.flatnonzero((length - done >= 4) & (length < _STRIPE))
        found[four] = _rotated(found[four] ^ self.lanes(start[four] + done[four], 4) * p1, 23) * p2 + p3
        done[four] += 4
        for _ in range(3):
            one = np.flatnonzero((length > done) & (length < _STRIPE))
            found[one] = _rotated(found[one] ^ self.lanes(start[one] + done[one], 1) * p5, 11) * p1
            done[one] += 1
        found = (found ^ found >> np.uint64(33)) * p2
        found = (found ^ found >> np.uint64(29)) * p3
        found ^= found >> np.uint64(32)
        long = np.flatnonzero(length >= _STRIPE)
        if len(long):
            ends = (start[long] + length[long]).tolist()
            found[long] = np.array([xxhash.xxh64_intdigest(self.data[a:b]) for a, b in zip(start[long].tolist(), ends, strict=True)], np.uint64)
        return found

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the ranges of equal length from ``a`` and ``b`` hold the same bytes."""
        same = np.ones(len(a), bool)
        left = np.arange(len(a))
        lane = 0
        while len(left):
            rest = length[left] - lane
            unlike = self.eight[a[left] + lane] ^ self.eight[b[left] + lane]
            part = np.flatnonzero(rest < 8)
            unlike[part] &= (np.uint64(1) << (8 * rest[part]).astype(np.uint64)) - np.uint64(1)
            same[left[unlike != 0]] = False
            left = left[(unlike == 0) & (rest > 8)]
            lane += 8
        return same


class Interned(NamedTuple):
    """Slots of a block's table (bucket and count of each) and, by occurrence, its slot and document."""

    bucket: np.ndarray
    count: np.ndarray
    slot: np.ndarray
    owner: np.ndarray


def _slots(source: _Bytes, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The occurrence that claimed each used slot of an open-addressed table, and every occurrence's slot.

    An occurrence probes from its key's home slot: an empty slot is claimed by one of those that
    reach it, a slot with the same key, length and bytes is shared, any other leads to the next.
    """
    keys = source.hashes(start, length)
    size = 1 << max(4, int(2 * len(keys) - 1).bit_length())
    table = np.full(size, -1, np.int32)
    slot = (keys & np.uint64(size - 1)).astype(np.int64)
    pending = np.arange(len(keys), dtype=np.int32)
    while len(pending):
        at = slot[pending]
        free = table[at] < 0
        table[at[free]] = pending[free]
        holder = table[at]
        met = holder == pending
        alike = np.flatnonzero(~met & (keys[holder] == keys[pending]) & (length[holder] == length[pending]))
        met[alike] = source.equal(start[holder[alike]], start[pending[alike]], length[pending[alike]])
        pending = pending[~met]
        slot[pending] = slot[pending] + 1 & size - 1
    used = np.flatnonzero(table >= 0)
    number = np.empty(size, np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    return table[used], number[slot]


def intern_ngrams(block: _Block, buckets: int = BUCKETS) -> Interned:
    """All n-grams that end in a counted word of the block.

    The CRC-32 of a longer n-gram is put together from those of its words, once for each slot.
    """
    n_words = len(block.words)
    lengths = np.fromiter(map(len, block.words), np.int64, n_words)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    # every word has a slot, counted or not, as longer n-grams need its CRC
    last = [np.arange(n_words), *(np.flatnonzero(block.counted & (block.before >= n)) for n in range(1, LONGEST))]
    word = np.concatenate(last)
    more = np.repeat(np.arange(LONGEST), list(map(len, last)))
    start = starts[word - more]
    source = _Bytes(b" ".join(block.words))
    first, slot = _slots(source, start, ends[word] - start)

    crc = np.zeros(len(first), np.uint32)
    single = np.flatnonzero(more[first] == 0)
    crc[single] = [crc32(block.words[i]) for i in word[first[single]].tolist()]
    alone = crc[slot[:n_words]]
    behind = _shifted(np.full(n_words, crc32(b" ")), lengths) ^ alone  # of a space and the word
    for n in range(1, LONGEST):
        ones = np.flatnonzero(more[first] == n)
        at = word[first[ones]]
        found = alone[at - n]
        for k in range(n - 1, -1, -1):
            found = _shifted(found, lengths[at - k] + 1) ^ behind[at - k]
        crc[ones] = found

    counted = np.concatenate([block.counted, np.ones(len(word) - n_words, bool)])
    slot = slot[counted]
    return Interned((crc % np.uint32(buckets)).astype(np.int64), np.bincount(slot, minlength=len(first)), slot, block.owner[word[counted]])


def feature_counts(texts: DataFrame, *, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """bucket and n: the features of all texts by bucket. A task sends at most ``buckets`` rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for block in _blocks(batch.column(0).to_pylist()):
                found = intern_ngrams(block, buckets)
                counts += np.bincount(found.bucket, found.count, minlength=buckets).astype(np.int64)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(counts[met])], names=["bucket", "n"])

    return texts.select(text).mapInArrow(rows, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def learn_gains(docs: DataFrame, target: DataFrame, *, text: str = "text", target_text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, ``floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets))))``.

    The driver gets one count for each bucket, whatever the tables hold.
    """

    def totals(frame: DataFrame, column: str) -> np.ndarray:
        counts = np.zeros(buckets)
        for r in feature_counts(frame, text=column, buckets=buckets).collect():
            counts[r.bucket] = r.n
        return counts

    s, t = totals(docs, text), totals(target, target_text)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, *, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns of ``docs``) with n_words, n_features and weight, the sum of the features' gains.

    Columns of ``docs`` with these three names are replaced.
    """
    made = ("n_words", "n_features", "weight")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    source = docs.select(*kept, F.col(text).alias("__text"))
    schema = source.drop("__text").schema
    for name in made:
        schema = schema.add(name, "long")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in made)
            for block in _blocks(batch.column(len(kept)).to_pylist()):
                found = intern_ngrams(block, len(gains))
                # whole numbers below 2 ** 53 add up exactly
                weight += np.bincount(found.owner, gains[found.bucket][found.slot], minlength=batch.num_rows).astype(np.int64)
                n_features += np.bincount(found.owner, minlength=batch.num_rows)
                n_words += np.bincount(block.owner[block.counted], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], *map(pa.array, (n_words, n_features, weight))], names=[*kept, *made]
            )

    return source.mapInArrow(rows, schema)


def gumbel(key: Column, seed: int) -> Column:
    """A document's draw from a Gumbel distribution, in thousandths, from the SHA-256 of ``seed:key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, eligible: Column, percent: int, *, key: str, score: str = "score", rank: str = "rank") -> DataFrame:
    """``scored`` with the rank of the highest scores among the eligible rows, NULL for what is not drawn.

    ``percent`` of the eligible rows are drawn, rounded down; ties go to the smaller key. Rows are
    dealt by score over range partitions and numbered inside them; the sizes of the partitions,
    one row each, say where a partition's ranks start. No task needs more than its own range.
    """
    flagged = scored.withColumn("__eligible", F.coalesce(eligible, F.lit(False)))
    order = [F.desc("__eligible"), F.desc(score), F.asc_nulls_last(key)]
    dealt = flagged.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed = shared_copy(dealt)
    part, inside = F.shiftrightunsigned("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("__part")).agg(F.sum(F.col("__eligible").cast("long")).alias("__n"))
    # a row for each partition; its window never sees a document
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = shared_copy(sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), "__n"))
    total = starts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    place = F.col("__before") + inside + 1
    drawn = F.col("__eligible") & (place <= percent * total // 100)
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .withColumn(rank, F.when(drawn, place))
        .select(*(c for c in scored.columns if c != rank), rank)
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    keep: Sequence[str] | None = None,
    percent: int = 5,
    least_words: int = 20,
    seed: int = 42,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``docs`` (or its columns ``keep``, the key among them) with n_words, n_features, weight, score and rank.

    Columns of ``docs`` with these five names are replaced. Of the documents with at least
    ``least_words`` words, ``percent`` are drawn; the others have no rank. Rows with a rank are the sample, in the order of their rank.
    """
    gains = learn_gains(docs, target, text=text, target_text=target_text, buckets=buckets)
    weighed = weigh(docs, gains, text=text, keep=[c for c in keep or docs.columns if c not in ("score", "rank")])
    # kept, as range partitions are chosen in a pass of their own
    scored = shared_copy(weighed.withColumn("score", F.col("weight") + gumbel(F.col(key), seed)))
    return ranked(scored, F.col("n_words") >= least_words, percent, key=key)

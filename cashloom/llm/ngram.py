"""Exact similarity join of word n-gram sets by Jaccard.

Sets of nearby sizes share a band. A band's hash space is cut into more parts than two linked
sets of the band can differ in elements, so linked sets agree on at least one whole part: a
tile is the sets of a band that agree on one part, and every link lies in a tile. A set without
enough filled parts for that also stands in the tiles of its empty parts, and small sets meet
by single elements of their prefixes instead. Tiles therefore lose no link, and unlike single
shared elements they hardly ever hold sets that only share a passage.

Near copies share tens of tiles, each with slightly different others. Tiles of like sizes with
the same first set are taken together as one, so that a set stands in few of them and two sets
are compared there once and not in each tile that both stand in.

Within a tile, bitmaps of the hashed elements bound the overlap of two sets from above (two
sets differ in at least as many elements as their parity bitmaps differ in bits); only pairs
within the bound are intersected exactly as sorted arrays.

First every set is compared with the smallest set it shares a tile with. Tiles whose sets are
all connected then need no more work, and in the others only sets of different components
are compared, large tiles block by block. Of the pairs that bitmaps allow in a block, mostly
links, two rounds verify only the most alike ones that would join its components to each
other; a last round verifies every pair that is still allowed between components.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..sources.staging import Staging, shared_copy
from .components import connected_components
from .memory import letting_go, letting_go_of_groups

WORDS = 5
NUMERATOR, DENOMINATOR = 80, 100
"""Two sets link when DENOMINATOR * intersection >= NUMERATOR * union."""

SMALL = 24
"""Sets up to this size meet by single elements."""

FLUSH = 1_500_000
"""Tile keys a task holds before it hands them on."""

BUCKET = 1_000_000
"""Tile keys of one bucket, on average."""

BLOCK = 4096
"""Sets of a tile that one task compares with as many others."""

MAP_WORDS = 512
"""64-bit words of a bitmap in a block; longer ones are folded, which leaves them a bound."""

PAIRED = 32
"""Sets of a tile up to which its pairs are joined directly."""

MERGED = 4
"""Pairs of sets that tiles taken together may hold, in multiples of the pairs of the single tiles."""

BROADCAST_IDS = 2_000_000
"""Ids that are broadcast to pick documents; more are joined by a shuffle."""

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_VALUES = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over all 64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, all from one running sum; equal ranges have equal hashes."""
    power, inverse = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * power[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None, words: int = WORDS, chunk: int = 1 << 20) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams, A-Z lower-cased; of fewer words, one of them all."""
    if not text:
        return np.empty(0, np.uint64)
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return np.empty(0, np.uint64)
    parts = []
    size = min(words, len(found))
    # long texts go piece by piece, each with the words that the next n-grams begin with
    for at in range(0, len(found) - size + 1, chunk):
        data = np.frombuffer(b" ".join(found[at : at + chunk + size - 1]), np.uint8)
        spaces = np.flatnonzero(data == 32)
        starts = np.concatenate([[0], spaces + 1])
        ends = np.concatenate([spaces, [len(data)]])
        n = len(starts) - size + 1
        parts.append(span_hashes(data, starts[:n], ends[size - 1 :]))
    # a sort alone takes a fraction of the time of np.unique
    every = np.sort(np.concatenate(parts))
    return every[np.concatenate([[True], every[1:] != every[:-1]])]


def _bands() -> Iterator[tuple[int, int, int, int]]:
    """Bands of set sizes above SMALL: lowest size, lowest of the next band, parts, largest difference.

    A pair belongs to the band of its smaller set. The parts are as many as make it unlikely
    for a set to have too few filled ones.
    """
    low = SMALL + 1
    while True:
        after = max(low + 1, int(low * 1.4))
        high = (after - 1) * DENOMINATOR // NUMERATOR
        # |a xor b| <= (1 - t) / (1 + t) * (|a| + |b|)
        most = 2 * high * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)
        parts = most + 1
        while True:
            load = low / parts
            empty = np.exp(-load)
            spread = np.sqrt(parts * max(empty - (1 + load) * empty * empty, 0))
            if parts - most - parts * empty >= 1 + 3.5 * spread or parts > 3 * most + 8:
                break
            parts += 1
        yield low, after, parts, most
        low = after


_known: list[tuple[int, int, int, int]] = []
_source = _bands()


def bands_of(size: int) -> list[tuple[int, int, int]]:
    """Number, parts and largest difference of each band a set of this size takes part in."""
    while not _known or _known[-1][0] <= size:
        _known.append(next(_source))
    return [(k, p, d) for k, (low, after, p, d) in enumerate(_known) if low <= size <= (after - 1) * DENOMINATOR // NUMERATOR]


def tile_keys(elements: np.ndarray) -> np.ndarray:
    """The tiles that a set of sorted hashes stands in."""
    n = len(elements)
    keys = []
    if n <= SMALL * DENOMINATOR // NUMERATOR:
        # linked sets share an element among the first few of either, in any common order
        prefix = n - -(-n * NUMERATOR // DENOMINATOR) + 1
        keys.append(mix(elements[:prefix] ^ np.uint64(0x5851F42D4C957F2D)))
    for band, parts, most in bands_of(n):
        place = ((elements >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        sums = np.add.reduceat(mix(elements + np.uint64(0x632BE59BD9B4E019)), heads)
        tag = place[heads].astype(np.uint64) + np.uint64(band << 40)
        keys.append(mix(sums + mix(tag)))
        if parts - len(heads) >= parts - most:  # too few filled parts: also by the empty ones
            free = np.setdiff1d(np.arange(parts), place[heads]).astype(np.uint64)
            keys.append(mix(free + np.uint64((band << 40) + (1 << 36))))
    return np.concatenate(keys)


def set_table(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and set_id: the sum of a set's 64-bit hashes, mixed once more.

    Sets are told apart by this number; among a billion sets, the chance that any two share it
    is about 3 %.
    """
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x.as_py(), words) for x in batch.column(1)]
            columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_set_id(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_id"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(letting_go(rows), f"doc_id {kind}, n_shingles long, set_id long")


def _set_id(elements: np.ndarray) -> int:
    return int(mix(elements ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64).view(np.int64))


# 48 bits of a key; its bucket follows from the others
_PACKED = np.dtype([("low", "<u4"), ("middle", "<u2"), ("owner", "<u4")])


def tiles(docs: DataFrame, buckets: int, *, text: str = "text", words: int = WORDS) -> DataFrame:
    """key and set_id of all tiles that hold two different sets or more.

    A task packs its keys by bucket of the key. Of the sets of a tile that it has itself, one
    goes to the tile's bucket and all go, already known to share it, to buckets of their own,
    so a tile that a third of all sets share brings its bucket one set per task at most.
    """

    def packed(bucket: int, keys: np.ndarray, owners: np.ndarray, shared: bool) -> tuple:
        names, at = np.unique(owners, return_inverse=True)
        block = np.empty(len(keys), _PACKED)
        block["low"], block["middle"] = keys & np.uint64(0xFFFFFFFF), keys >> np.uint64(32) & np.uint64(0xFFFF)
        block["owner"] = at
        return bucket, shared, block.tobytes(), names.tobytes()

    def emit(keys: list[np.ndarray], owners: list[int], task: int) -> Iterator[pa.RecordBatch]:
        if not keys:
            return
        owner = np.repeat(np.array(owners, np.int64), [len(k) for k in keys])
        key = np.concatenate(keys)
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])])
        key, owner = key[fresh], owner[fresh]
        head = np.concatenate([[True], key[1:] != key[:-1]])
        tail = np.concatenate([key[1:] == key[:-1], [False]])
        many = tail | ~head
        made = []
        one_key, one_owner = key[head], owner[head]
        place = ((one_key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        # keys of a bucket that agree in 48 bits only add candidates
        cuts = [0, *(np.flatnonzero(place[1:] != place[:-1]) + 1).tolist(), len(place)]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            made.append(packed(int(place[start]), one_key[start:stop], one_owner[start:stop], False))
        known_key, known_owner = key[many], owner[many]
        for k in range(0, len(known_key), 1 << 18):
            part = slice(k, k + (1 << 18))
            made.append(packed((task * 7919 + k) % buckets, known_key[part], known_owner[part], True))
        for k in range(0, len(made), 64):
            columns = list(zip(*made[k : k + 64], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())],
                names=["bucket", "shared", "block", "names"],
            )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), set()
        keys, owners, held = [], [], 0
        for batch in batches:
            for x in batch.column(0):
                elements = shingle_set(x.as_py(), words)
                if not len(elements):
                    continue
                name = _set_id(elements)
                if name in seen:
                    continue
                seen.add(name)
                keys.append(tile_keys(elements))
                owners.append(name)
                held += len(keys[-1])
                if held > FLUSH:
                    yield from emit(keys, owners, task)
                    keys, owners, held = [], [], 0
        yield from emit(keys, owners, task)

    def meet(table: pa.Table) -> pa.Table:
        keys, owners, shared = [], [], []
        for s, block, names in zip(*(table.column(c) for c in ("shared", "block", "names")), strict=True):
            rows = np.frombuffer(block.as_buffer(), _PACKED)
            keys.append(rows["low"].astype(np.int64) | rows["middle"].astype(np.int64) << 32)
            owners.append(np.frombuffer(names.as_buffer(), np.int64)[rows["owner"]])
            shared.append(np.full(len(rows), s.as_py()))
        key, owner, known = np.concatenate(keys), np.concatenate(owners), np.concatenate(shared)
        out_key, out_owner = [key[known]], [owner[known]]
        key, owner = key[~known], owner[~known]
        order = np.argsort(key)
        key = key[order]
        twice = _repeated(key)
        key, owner = key[twice], owner[order][twice]
        # copies of one set in several tasks are no tile
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        key, owner = key[fresh], owner[fresh]
        twice = _repeated(key)
        out_key.append(key[twice])
        out_owner.append(owner[twice])
        return pa.table({"key": pa.array(np.concatenate(out_key)), "set_id": pa.array(np.concatenate(out_owner))})

    sent = docs.select(F.col(text)).mapInArrow(letting_go(rows), "bucket int, shared boolean, block binary, names binary")
    return sent.groupBy("bucket").applyInArrow(letting_go_of_groups(meet), "key long, set_id long").distinct()


def _repeated(key: np.ndarray) -> np.ndarray:
    """Which of sorted keys have an equal neighbour."""
    twice = np.zeros(len(key), bool)
    twice[1:] = key[1:] == key[:-1]
    twice[:-1] |= twice[1:]
    return twice


def merged_tiles(named: DataFrame, stage: Staging) -> DataFrame:
    """key and set_id of fewer tiles, one of which holds each two sets that share a tile of ``named``, a stored frame.

    Tiles go together by their first set and by their size to the next power of two; what that
    makes goes together by its first set in another order. Those that would hold more than MERGED
    times the pairs of the single tiles stay as they are.
    """
    tiles = named.withColumn("pairs", F.lit(None).cast("long"))
    for order, size in ((F.col("set_id"), F.floor(F.log2("n"))), (F.xxhash64("set_id"), F.lit(0))):
        about = tiles.groupBy("key").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"), F.max("pairs").alias("pairs")).where("n > 1")
        pairs = F.coalesce("pairs", F.expr("n * (n - 1)"))
        about = stage(about.select("key", F.xxhash64("first", size).alias("group"), pairs.alias("pairs")))
        together = stage(tiles.select("key", "set_id").join(about, "key").select("group", "set_id").distinct())
        sizes = together.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
        judged = sizes.join(about.groupBy("group").agg(F.sum("pairs").alias("pairs")), "group")
        judged = stage(judged.select("group", "pairs", F.expr(f"n * (n - 1) <= {MERGED} * pairs").alias("worth")))
        single = stage(about.join(judged.where("not worth").select("group"), "group").select("key", "pairs"))
        few = single.count() <= BROADCAST_IDS
        alone = tiles.select("key", "set_id").join(F.broadcast(single) if few else single, "key")
        kept = together.join(judged.where("worth").select("group", "pairs"), "group").withColumnRenamed("group", "key")
        tiles = stage(kept.unionByName(alone))
    return tiles.select("key", "set_id")


def _bitmap(elements: np.ndarray) -> bytes:
    """Parity of the number of elements hashed to each bit; four bits and more per element."""
    bits = 1 << max(6, int(4 * len(elements) - 1).bit_length())
    counts = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _fold(bitmap: np.ndarray, size: int) -> np.ndarray:
    """A bitmap brought to ``size`` words: the parity of bits that fall together."""
    return np.bitwise_xor.reduce(bitmap.reshape(-1, size), axis=0) if len(bitmap) > size else bitmap


def _possible(na: np.ndarray, nb: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes that differ in at least so many elements may link."""
    inside = (na + nb - differ) // 2
    inside = np.minimum(inside, np.minimum(na, nb))
    return DENOMINATOR * inside >= NUMERATOR * (na + nb - inside)


def candidate_sets(docs: DataFrame, wanted: DataFrame, what: str, *, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """set_id, n and x of wanted sets; x: their ``bits`` or all ``elements``, sorted 64-bit hashes.

    ``wanted``: set_id, rep (a document that has the set) and rep_rows (rows with that id and
    set), stored. The documents are read once more rather than keeping all sets.
    """
    few = wanted.count() <= BROADCAST_IDS
    source = docs.select(F.col(key).alias("rep"), F.col(text).alias("text"))
    source = source.join(F.broadcast(wanted) if few else wanted, "rep").select("set_id", "rep_rows", "text")
    make = _bitmap if what == "bits" else np.ndarray.tobytes

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                names, repeats, sizes, made = [], [], [], []
                for name, count, x in zip(*whole.slice(start, 256).columns, strict=True):
                    elements, expected = shingle_set(x.as_py(), words), name.as_py()
                    # an id may have other texts too
                    if expected not in seen and _set_id(elements) == expected:
                        if count.as_py() > 1:
                            seen.add(expected)
                        names.append(expected)
                        repeats.append(count.as_py())
                        sizes.append(len(elements))
                        made.append(make(elements))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(repeats, pa.int64()), pa.array(sizes, pa.int64()), pa.array(made, pa.binary())],
                    names=["set_id", "rep_rows", "n", "x"],
                )

    found = source.mapInArrow(letting_go(rows), "set_id long, rep_rows long, n long, x binary")
    single = found.where("rep_rows = 1").select("set_id", "n", "x")
    if wanted.where("rep_rows > 1").limit(1).count():
        single = single.unionByName(found.where("rep_rows > 1").select("set_id", "n", "x").dropDuplicates(["set_id"]))
    return single


def _attached(pairs: DataFrame, sets: DataFrame, slice_rows: int | None = None) -> DataFrame:
    """Pairs with both ends' sizes and x. Bitmaps are light, and adaptive execution may split their joins; with
    ``slice_rows``, for whole sets, an end that very many pairs share is spread over tasks beforehand, and pairs
    that are few go to the sets instead of the sets to them."""

    def named(end: str) -> DataFrame:
        return sets.select(F.col("set_id").alias(end), F.col("n").alias(f"n{end}"), F.col("x").alias(f"x{end}"))

    if slice_rows is None:
        return pairs.join(named("b"), "b").join(named("a"), "a")
    few = pairs.count() <= BROADCAST_IDS
    half = named("b").join(F.broadcast(pairs), "b") if few else spread_join(pairs, named("b"), "b", slice_rows=slice_rows)
    # of the sets only those that are the other end of a pair
    ends = pairs.select("a").distinct()
    others = named("a").join(F.broadcast(ends) if few else ends, "a", "left_semi")
    return spread_join(half, others, "a", slice_rows=slice_rows)


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that their bitmaps allow."""
    for batch in batches:
        differ = np.zeros(batch.num_rows, np.int64)
        for k, (x, y) in enumerate(zip(batch.column("xa"), batch.column("xb"), strict=True)):
            left, right = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            size = min(len(left), len(right))
            differ[k] = np.bitwise_count(_fold(left, size) ^ _fold(right, size)).sum()
        keep = pa.array(_possible(batch.column("na").to_numpy(), batch.column("nb").to_numpy(), differ))
        yield batch.select(["a", "b"]).filter(keep)


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that link, by intersection of sorted arrays."""
    for batch in batches:
        links = []
        for x, y in zip(batch.column("xa"), batch.column("xb"), strict=True):
            left, right = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = np.sort(np.concatenate([left, right]))
            inside = int((both[1:] == both[:-1]).sum())
            links.append(DENOMINATOR * inside >= NUMERATOR * (len(left) + len(right) - inside))
        yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))


def _small_crossing(tile: DataFrame, bits: DataFrame) -> DataFrame:
    """Distinct pairs of sets of different components in a tile of up to PAIRED sets that the bitmaps allow."""
    left = tile.where(F.col("members") <= PAIRED).select("key", F.col("set_id").alias("a"), F.col("comp").alias("ca"))
    right = left.withColumnsRenamed({"a": "b", "ca": "cb"})
    pairs = left.join(right, "key").where("a < b and ca <> cb").select("a", "b").distinct()
    return _attached(pairs, bits).mapInArrow(letting_go(_bounded), pairs.schema)


class _Block(NamedTuple):
    """Sets of a tile: ids, components, sizes and bitmaps of equal length."""

    name: np.ndarray
    comp: np.ndarray
    n: np.ndarray
    maps: np.ndarray


def _block_of(table: pa.Table, rows: np.ndarray | None = None) -> _Block:
    if rows is not None:
        table = table.take(pa.array(rows))
    maps = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("x").combine_chunks()]
    size = min(MAP_WORDS, *map(len, maps)) if maps else 1
    name, comp, n = (table.column(c).to_numpy().astype(np.int64) for c in ("set_id", "comp", "n"))
    return _Block(name, comp, n, np.stack([_fold(m, size) for m in maps]) if maps else np.empty((0, 1), np.uint64))


class _Crossing:
    """Pairs of sets of different components that the bitmaps allow: ``every`` one, or the most alike that join components."""

    def __init__(self, every: bool) -> None:
        self.every = every
        self.joined: dict[int, int] = {}
        self.ends: list[tuple[np.ndarray, np.ndarray]] = []

    def find(self, c: int) -> int:
        while self.joined.get(c, c) != c:
            c = self.joined[c]
        return c

    def compare(self, one: _Block, two: _Block) -> None:
        """``one`` with ``two``, or a block with itself."""
        size, same = min(one.maps.shape[1], two.maps.shape[1]), one is two
        left, right = _folded(one.maps, size), _folded(two.maps, size)
        for k in range(len(one.name)):
            others = np.flatnonzero(two.comp != one.comp[k])
            if same:
                others = others[two.name[others] > one.name[k]]
            if not len(others):
                continue
            differ = np.bitwise_count(right[others] ^ left[k]).sum(axis=1).astype(np.int64)
            allowed = _possible(np.full(len(others), one.n[k]), two.n[others], differ)
            others = others[allowed][np.argsort(differ[allowed], kind="stable")]
            if not self.every:
                # the most alike set of each other component
                tried, others = others[np.sort(np.unique(two.comp[others], return_index=True)[1])], []
                for o in tried.tolist():
                    x, y = self.find(int(one.comp[k])), self.find(int(two.comp[o]))
                    if x != y:
                        self.joined[max(x, y)] = min(x, y)
                        others.append(o)
            if len(others):
                self.ends.append((np.full(len(others), one.name[k]), two.name[others]))

    def table(self) -> pa.Table:
        a, b = (np.concatenate([e[i] for e in self.ends]) if self.ends else np.empty(0, np.int64) for i in (0, 1))
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})


def _large_crossing(tile: DataFrame, bits: DataFrame, every: bool) -> DataFrame:
    """The same of larger tiles: ``every`` pair, or the most alike that join a block's components.

    The sets of a tile's largest component are its main ones; among them nothing is open, so
    others are compared with main sets and with each other. A tile of one block meets as it is.
    Of a larger one, main sets and others are dealt to blocks, a block becomes one row, and
    every block of others meets the main blocks and the blocks of others: a set is repeated once
    for each block it has to meet, main sets, mostly nearly all, once for the others' few blocks.
    """
    counts = tile.where(F.col("members") > PAIRED).groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct("n", "comp"))
    sizes = counts.groupBy("key").agg(best["comp"].alias("most"), best["n"].alias("n_main"), (F.sum("n") - best["n"]).alias("n_other"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    sizes = sizes.select("key", "most", blocks("n_main").alias("mains"), blocks("n_other").alias("others"))
    dealt = tile.join(sizes, "key").select("key", "set_id", "comp", "members", "mains", "others", (F.col("comp") == F.col("most")).alias("main"))

    def meet(table: pa.Table) -> pa.Table:
        main, crossing = table.column("main").to_numpy(zero_copy_only=False), _Crossing(every)
        mains, others = (_block_of(table, np.flatnonzero(x)) for x in (main, ~main))
        crossing.compare(others, mains)
        crossing.compare(others, others)
        return crossing.table()

    whole = dealt.where(F.col("members") <= BLOCK).select("key", "set_id", "comp", "main").join(bits, "set_id")
    met = whole.groupBy("key").applyInArrow(letting_go_of_groups(meet), "a long, b long")
    many = dealt.where(F.col("members") > BLOCK)
    if not many.limit(1).count():
        return met.distinct()

    def pack(table: pa.Table) -> pa.Table:
        block = _block_of(table)
        row = {c: table.column(c).slice(0, 1) for c in ("key", "main", "own", "mains", "others")}
        blobs = {"set_id": block.name, "comp": block.comp, "n": block.n, "x": block.maps}
        return pa.table({**row, **{c: pa.array([v.tobytes()], pa.binary()) for c, v in blobs.items()}})

    own = F.pmod(F.xxhash64("set_id"), F.when(F.col("main"), F.col("mains")).otherwise(F.col("others"))).cast("int")
    fields = "key long, main boolean, own int, mains int, others int, set_id binary, comp binary, n binary, x binary"
    packed = many.drop("members").withColumn("own", own).join(bits, "set_id").groupBy("key", "main", "own").applyInArrow(letting_go_of_groups(pack), fields)
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # a main block (i) with a block of others (j), or two blocks of others
    pair = lambda mixed, i, j: F.struct(mixed.alias("mixed"), i.alias("i"), j.alias("j"))
    mine = F.col("own")
    meets = F.when(F.col("main"), F.transform(upto("others"), lambda j: pair(F.lit(True), mine, j))).otherwise(
        F.concat(
            F.transform(upto("mains"), lambda i: pair(F.lit(True), i, mine)),
            F.transform(upto("others"), lambda o: pair(F.lit(False), F.least(mine, o), F.greatest(mine, o))),
        )
    )
    sent = packed.withColumn("pair", F.explode(meets)).select("key", "pair.mixed", "pair.i", "pair.j", "main", "set_id", "comp", "n", "x")

    def compare(table: pa.Table) -> pa.Table:
        found, crossing = [], _Crossing(every)
        for k in range(table.num_rows):
            name, comp, n, x = (np.frombuffer(table.column(c)[k].as_buffer(), np.int64) for c in ("set_id", "comp", "n", "x"))
            found.append((table.column("main")[k].as_py(), _Block(name, comp, n, x.view(np.uint64).reshape(len(name), -1))))
        found.sort(key=lambda b: b[0])  # others first
        # hashing may have left the other block of a pair empty
        if len(found) > 1 or not table.column("mixed")[0].as_py():
            crossing.compare(found[0][1], found[-1][1])
        return crossing.table()

    return met.unionByName(sent.groupBy("key", "mixed", "i", "j").applyInArrow(letting_go_of_groups(compare), "a long, b long")).distinct()


def _folded(maps: np.ndarray, size: int) -> np.ndarray:
    """Rows of bitmaps brought to ``size`` words each."""
    return np.bitwise_xor.reduce(maps.reshape(len(maps), -1, size), axis=1) if maps.shape[1] > size else maps


def similar_components(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) of every row.

    Texts without words, NULL and empty ones included, link with nothing. Rows without an id
    have no component. Rows repeated with one id are one document of that id; where their texts
    differ, the id joins what its texts join.
    """
    spark = docs.sparkSession
    sets = shared_copy(set_table(docs, key=key, text=text, words=words))
    owned = sets.where("n_shingles > 0 and doc_id is not null").groupBy("set_id", "doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("n_shingles").alias("n"))
    least = F.min(F.struct("doc_id", "rows"))
    classes = owned.groupBy("set_id").agg(least.alias("least"), F.max("n").alias("n"))
    classes = shared_copy(classes.select("set_id", F.col("least.doc_id").alias("rep"), F.col("least.rows").alias("rep_rows"), "n"))
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n

    # what the answer does not read is released as soon as the next step is stored
    with Staging(spark) as kept:
        with Staging(spark) as work:
            named = work(tiles(docs, max(1, total // (2 * BUCKET)), text=text, words=words))
            together = merged_tiles(named, work)
            tile = together.groupBy("key").agg(F.min("set_id").alias("least"), F.count(F.lit(1)).alias("members"))
            tiled = kept(together.join(tile, "key"))

        def of(ids: DataFrame, stage: Staging) -> DataFrame:
            return stage(classes.join(ids.distinct(), "set_id", "left_semi").select("set_id", "rep", "rep_rows"))

        def verified(pairs: DataFrame, stage: Staging) -> DataFrame:
            """Pairs that link; ``pairs`` is stored."""
            with Staging(spark) as work:
                ends = pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id")))
                elements = work(candidate_sets(docs, of(ends, work), "elements", key=key, text=text, words=words))
                return stage(_attached(pairs, elements, 20_000).mapInArrow(letting_go(_exact), "a long, b long"))

        bits = kept(candidate_sets(docs, of(tiled.select("set_id"), kept), "bits", key=key, text=text, words=words))
        with Staging(spark) as work:
            first = tiled.where("set_id <> least").groupBy("set_id").agg(F.min("least").alias("a")).select("a", F.col("set_id").alias("b"))
            links = verified(work(_attached(first, bits).mapInArrow(letting_go(_bounded), "a long, b long")), work)
            # an id with several texts ties their sets together
            ties = owned.groupBy("doc_id").agg(F.min("set_id").alias("a"), F.max("set_id").alias("b"), F.collect_set("set_id").alias("all")).where("a <> b")
            links = work(links.unionByName(ties.select("a", F.explode("all").alias("b")).where("a <> b")))
            nodes = shared_copy(connected_components(links))
        tiled = tiled.drop("least")
        for last in (False, False, True):
            comp = F.coalesce("component", "set_id").alias("comp")
            mine = tiled.join(nodes.withColumnRenamed("node", "set_id"), "set_id", "left").select("key", "set_id", "members", comp)
            open_keys = mine.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
            mine = kept(mine.join(open_keys, "key"))
            with Staging(spark) as work:
                crossing = work(_large_crossing(mine, bits, last).unionByName(_small_crossing(mine, bits)).distinct())
                if not crossing.limit(1).count():
                    break
                # what small tiles hold is now verified pair by pair
                tiled = mine.where(F.col("members") > PAIRED).drop("comp")
                found = verified(crossing, work)
                if found.limit(1).count():
                    nodes = shared_copy(connected_components(found.unionByName(nodes.select(F.col("node").alias("a"), F.col("component").alias("b")))))

    label = F.coalesce("component", "set_id")
    labelled = classes.join(nodes.withColumnRenamed("node", "set_id"), "set_id", "left").select("set_id", "rep", label.alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    answer = labelled.join(smallest, "label").select("set_id", "component_id")
    known = spread_join(sets, answer, "set_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id"))
    return known.select("doc_id", "n_shingles", component.alias("component_id"))

"""Mixing of sources to target weights, by a multivariate-hypergeometric splitting tree.

The documents of a source are laid end to end in an order given by hashes, and its words are cut
into blocks of equal size. A source's quota is a whole number of words: the first pass takes all
blocks in a random order, a second one begins only when the first is through, and the last block
is taken in part so that the quota is met to the word. As no third pass exists, no document
gives more than twice its words.

Which output shard gets how many blocks of which source is decided by a tree: the root holds the
quotas of all sources in blocks, and every node gives its left half of the shards a draw from the
multivariate hypergeometric distribution, as if all blocks had been shuffled and cut. The blocks
that went to the left also say where the right half's blocks begin in each source's permutation,
so shards draw disjoint blocks without knowing of each other. A shard then shuffles its blocks.

Block and shard sizes grow with the corpus once it has 2^32 words, so that a mix has at most about
2^25 blocks and 2^17 shards whatever it is made from. Everything follows from the rows and the
seed: no partition number, task or clock plays a part, so reruns agree.

Defined results: a NULL text has size 0; a document of size 0 is never taken; a NULL source is a
source of its own, after all others. Repeated rows are documents of their own. An empty table
gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import shared_copy

WORD = r"[^\x20\x09-\x0D]+"

WEIGHTS = (5, 2, 1)
"""Weights of the sources in order, repeating."""

SHARE = Fraction(3, 2)
"""Words of the mix, in words of the corpus."""

PASSES = 2
"""How often a source may be taken at most."""

LEAST_BLOCK = 256
"""Words of a block of a corpus of up to 2^32 words."""

MOST_BLOCKS = 1 << 24
"""Blocks that a corpus is cut into at most, but for one short block a source."""

SHARD_BLOCKS = 256
"""Blocks of an output shard."""

GROUP_ROWS = 4096
"""Documents that are laid end to end in one group, on average, of a corpus of up to 2^32 documents."""

MOST_GROUPS = 1 << 20
"""Groups of a source, whose totals one task adds up."""


def water_level(sizes: Sequence[int], weights: Sequence[int], share: Fraction = SHARE, passes: int = PASSES) -> list[float]:
    """Targets in proportion to ``weights`` that add up to ``share`` of all sizes, none above ``passes`` times its size.

    What a source cannot take is shared by the others, by weight, until none is above.
    """
    left, open_ones = share * sum(sizes), list(range(len(sizes)))
    targets = [0.0] * len(sizes)
    while open_ones:
        total = sum(weights[i] for i in open_ones)
        full = [i for i in open_ones if left * weights[i] >= passes * sizes[i] * total]
        if not full:
            for i in open_ones:
                targets[i] = float(left * weights[i] / total)
            break
        for i in full:
            targets[i] = float(passes * sizes[i])
            left -= passes * sizes[i]
        open_ones = [i for i in open_ones if i not in set(full)]
    return targets


class Mix(NamedTuple):
    """One number a source: name, words, target, and the words to take; and the words of a block.

    Sources are in the order of their code points, NULL last.
    """

    names: list[str | None]
    sizes: list[int]
    targets: list[float]
    quotas: list[int]
    block: int

    def units(self) -> np.ndarray:
        """Blocks to take of each source, the last one in part."""
        return np.array([_units(n, q, self.block) for n, q in zip(self.sizes, self.quotas, strict=True)], np.int64)


def _units(size: int, quota: int, block: int) -> int:
    if not size:
        return 0
    whole, rest = divmod(quota, size)
    return whole * -(-size // block) + -(-rest // block)


def plan_mix(sizes: Mapping[str | None, int], weights: Sequence[int] = WEIGHTS, *, share: Fraction = SHARE, passes: int = PASSES) -> Mix:
    """Targets and quotas of sources with so many words."""
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    counts = [int(sizes[n]) for n in names]
    targets = water_level(counts, [weights[i % len(weights)] for i in range(len(names))], share, passes)
    quotas = [min(round(t), passes * n) for t, n in zip(targets, counts, strict=True)]
    block = LEAST_BLOCK
    while block * MOST_BLOCKS < sum(counts):
        block *= 2
    return Mix(names, counts, targets, quotas, block)


def permuted(index: np.ndarray, size: int, *seed: int) -> np.ndarray:
    """A permutation of 0 to ``size`` - 1 at ``index``: a Feistel network, walked until it lands inside."""
    half = max(1, (int(size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(seed).integers(1, 1 << 63, 6, dtype=np.uint64) | np.uint64(1)
    found = np.asarray(index).astype(np.uint64)
    outside = np.arange(len(found))
    while len(outside):
        x = found[outside]
        left, right = x >> np.uint64(half), x & mask
        for key in keys:
            mixed = (right + key) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ mixed >> np.uint64(29)) * (key | np.uint64(1))
            left, right = right, left ^ (mixed >> np.uint64(40)) & mask
        found[outside] = left << np.uint64(half) | right
        outside = outside[found[outside] >= size]
    return found.astype(np.int64)


def split_quotas(units: np.ndarray, shards: int, seed: int, low: int, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each shard from ``low`` to ``high`` - 1: its number, and of each source the blocks before it and its own.

    Walks only the nodes above these shards. A node is a range of shards; its draw depends on the
    seed and the range alone, so all who pass it agree.
    """
    total = int(units.sum())

    def room(first: int, last: int) -> int:
        return total * last // shards - total * first // shards

    waiting = [(0, shards, np.zeros_like(units), units)]
    while waiting:
        first, last, before, own = waiting.pop()
        if last <= low or first >= high:
            continue
        if last - first == 1:
            yield first, before, own
            continue
        middle = (first + last) // 2
        draw = np.random.default_rng((seed, first, last)).multivariate_hypergeometric(own, room(first, middle), method="marginals")
        waiting.append((middle, last, before + draw, own - draw))
        waiting.append((first, middle, before, draw))


def _drawn(mix: Mix, source: int, first: int, n: int, seed: int) -> tuple[np.ndarray, ...]:
    """Block, pass and words of the places ``first`` to ``first + n - 1`` in a source's order of blocks.

    Whole blocks come in a permutation of each pass, the short block at the end of the source last.
    """
    size, block = mix.sizes[source], mix.block
    whole, each = size // block, -(-size // block)
    turn, place = np.divmod(np.arange(first, first + n), each)
    number = place.copy()
    for k in np.unique(turn).tolist():
        at = np.flatnonzero((turn == k) & (place < whole))
        number[at] = permuted(place[at], whole, seed, source, k) if len(at) else place[at]
    so_far = turn * size + place * block
    full = np.where(place < whole, block, size - whole * block)
    return number, turn, np.minimum(full, mix.quotas[source] - so_far)


def drawn_blocks(spark, mix: Mix, *, seed: int, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """One row per block of the mix: source_no, block, turn, words (taken from its start), shard, place.

    ``turn`` counts the passes over a source from 0; ``place`` is the block's place in its shard.
    """
    units = mix.units()
    shards = max(1, -(-int(units.sum()) // shard_blocks))
    names = ["source_no", "block", "turn", "words", "shard", "place"]
    step = 64  # shards that one row of the range stands for

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in batch.column(0).to_pylist():
                leaves = list(split_quotas(units, shards, seed, start * step, min(shards, (start + 1) * step)))
                ids, own = np.array([s for s, _, _ in leaves]), np.array([o for _, _, o in leaves])
                # shards side by side draw from one stretch of a source's order
                parts = []
                for source in np.flatnonzero(own.sum(axis=0)).tolist():
                    drawn = _drawn(mix, source, int(leaves[0][1][source]), int(own[:, source].sum()), seed)
                    parts.append(np.stack([np.full(len(drawn[0]), source), *drawn, np.repeat(ids, own[:, source])]))
                if not parts:
                    continue
                table = np.concatenate(parts, axis=1)
                table = table[:, np.argsort(table[-1], kind="stable")]
                places = [np.random.default_rng((seed, shards, s)).permutation(n) for s, n in zip(ids.tolist(), own.sum(axis=1).tolist(), strict=True)]
                columns = [*table, np.concatenate(places)]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)

    return spark.range(-(-shards // step)).mapInArrow(rows, ", ".join(f"{n} long" for n in names))


def laid_out(docs: DataFrame, *, key: str, text: str, source: str, group_rows: int = GROUP_ROWS) -> DataFrame:
    """key, source, size and offset: each document's words, and the words of its source before it.

    Documents go to groups by a hash of key and text, a group is summed in one pass, and the
    groups' totals, one row each, say where a group starts in its source. A source with a third
    of all rows has a third of the groups' rows, but no larger group than any other.
    """
    n_words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    sized = shared_copy(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), n_words.alias("size"), F.xxhash64(key, text).alias("mark")))
    # rows in the footers; a power of two, so that it seldom changes
    groups = min(MOST_GROUPS, 1 << max(0, int(sized.count() // group_rows).bit_length()))
    grouped = sized.withColumn("group", F.pmod("mark", F.lit(groups)))
    inside = Window.partitionBy("source", "group").orderBy("mark", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = grouped.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    totals = grouped.groupBy("source", "group").agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("source").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("source").alias("s"), F.col("group").alias("g"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("start"))
    joined = placed.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("group") == F.col("g")))
    return joined.select("key", "source", "size", (F.col("start") + F.col("ahead")).alias("offset"))


class Mixture(NamedTuple):
    """``documents``: key, source, source_no, size, offset, source_size, target. ``pieces``: see :func:`mix_sources`."""

    documents: DataFrame
    pieces: DataFrame
    mix: Mix


def mix_sources(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE,
    passes: int = PASSES,
    seed: int = 42,
    shard_blocks: int = SHARD_BLOCKS,
) -> Mixture:
    """Plan a mix of all ``docs``: what each source gives, and the pieces of documents in each output shard.

    ``pieces`` has one row per stretch of a document that the mix takes: shard, place (of its block
    in the shard), source_no, offset (of the document, which with source_no names it), key, first
    (word of the document the stretch starts with), words and turn. Sorted by shard, place and
    offset, they are the mix. The driver gets one number a source.
    """
    laid = shared_copy(laid_out(docs, key=key, text=text, source=source))
    sizes = {r.source: r.total for r in laid.groupBy("source").agg(F.sum("size").alias("total")).collect()}
    mix = plan_mix(sizes, weights, share=share, passes=passes)
    spark = docs.sparkSession
    facts = spark.createDataFrame(
        list(zip(range(len(mix.names)), mix.names, mix.sizes, mix.targets, strict=True)), "source_no long, s string, source_size long, target double"
    )
    # one row a source, as many as the driver has just planned for
    documents = laid.join(F.broadcast(facts), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    block = F.lit(mix.block)
    cut = documents.where("size > 0").select(
        "key", "source_no", "offset", "size",
        F.explode(F.sequence(F.expr(f"offset div {mix.block}"), F.expr(f"(offset + size - 1) div {mix.block}"))).alias("block"),
    )
    # nobody can tell beforehand how many rows a task makes of its shards: no broadcast
    met = cut.join(drawn_blocks(spark, mix, seed=seed, shard_blocks=shard_blocks).hint("merge"), ["source_no", "block"])
    begin = F.greatest(F.col("offset"), F.col("block") * block)
    end = F.least(F.col("offset") + F.col("size"), F.col("block") * block + F.col("words"))
    pieces = met.select(
        "shard", "place", "source_no", "offset", "key", (begin - F.col("offset")).alias("first"), (end - begin).alias("words"), "turn"
    ).where("words > 0")
    return Mixture(documents, pieces, mix)


def taken_words(mixture: Mixture) -> DataFrame:
    """The mix's documents with taken, the words of all their pieces; a document is met by its place in its source."""
    taken = mixture.pieces.groupBy("source_no", "offset").agg(F.sum("words").alias("taken"))
    some = mixture.documents.where("size > 0").join(taken, ["source_no", "offset"], "left")
    none = mixture.documents.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return some.withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))).unionByName(none)

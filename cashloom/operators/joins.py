"""Joins that survive hot keys, and the size check before a broadcast.

A shuffle join sends every row of one key to one task. Where a key may hold a large share
of the rows, :func:`spread_join` spreads that key over several tasks. NULL keys, which
never match, are spread the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000
"""Row bound of a dimension that is broadcast."""

MEMBER_ROWS = 1_000_000
"""Row bound of a one-column set of values that is broadcast."""

BROADCAST_TEXT = 64 << 20
"""Bound on the bytes of text in a side that is broadcast."""

SLICE_ROWS = 2_000_000
"""Rows of one key group that one task takes without being split."""

BUCKETS = 1 << 16
"""Key-hash buckets counted to find the hot ones; bounds the broadcast histogram."""

_BUCKET, _ROWS, _SLICES, _SLICE = "__bucket", "__rows", "__slices", "__slice"


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` stays within ``rows`` rows and ``BROADCAST_TEXT`` bytes of text; never with nested columns.

    Runs one counting job; meant for dimension tables.
    """
    if any(f.dataType.typeName() in ("array", "map", "struct", "variant") for f in df.schema):
        return False  # how large such values are cannot be told from their rows
    text = [f.name for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    size = F.lit(0).cast("long")
    for name in text:
        size = size + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    found = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return found.n <= rows and found.bytes <= BROADCAST_TEXT


def lookup_join(facts: DataFrame, dimension: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join facts to a dimension: broadcast when its row count is small, spread otherwise."""
    on = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(dimension):
        return facts.join(F.broadcast(dimension), on, how)
    return spread_join(facts, dimension, on, how)


def member_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """:func:`spread_join` to a narrow table of keys and ids, such as the parties of a feed; up to ``MEMBER_ROWS`` of them go to the rows instead.

    Nothing of ``left`` is counted, shuffled or sorted then.
    """
    on = [on] if isinstance(on, str) else list(on)
    _same_types(left, right, on)
    if fits_broadcast(right, MEMBER_ROWS):
        return left.join(F.broadcast(right), on, how)
    return spread_join(left, right, on, how)


def _same_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> None:
    for key in on:
        if left.schema[key].dataType != right.schema[key].dataType:
            raise ValueError(f"key {key!r}: {left.schema[key].dataType} and {right.schema[key].dataType} differ, cast first")


def _bucket(on: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(buckets)).cast("int")


def _hot_buckets(left: DataFrame, on: Sequence[str], slice_rows: int, buckets: int) -> DataFrame:
    """The key-hash buckets over their allowance and the slices each is cut into, to be broadcast."""
    histogram = left.select(_bucket(on, buckets).alias(_BUCKET)).groupBy(_BUCKET).agg(F.count(F.lit(1)).alias(_ROWS))
    # one row per bucket, so this unpartitioned window never sees more than `buckets` rows
    fair_share = F.sum(_ROWS).over(Window.partitionBy()) / buckets
    allowance = F.greatest(F.lit(float(slice_rows)), 2 * fair_share)
    return F.broadcast(
        histogram.select(_BUCKET, F.ceil(F.col(_ROWS) / allowance).cast("int").alias(_SLICES)).where(F.col(_SLICES) > 1)
    )


def hot_apart(left: DataFrame, on: Sequence[str], *, slice_rows: int = SLICE_ROWS, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Rows of keys that a plain shuffle by key can take, and the rows that :func:`spread_join` would cut into slices.

    Rows of one key are all on one side. The first side may be joined by key and stays placed by
    it, for what follows on the same key. Where nothing is hot, adaptive execution drops the second.
    """
    hot = _hot_buckets(left, on, slice_rows, buckets).select(_BUCKET)
    placed = left.withColumn(_BUCKET, _bucket(on, buckets))
    return placed.join(hot, _BUCKET, "left_anti").drop(_BUCKET), placed.join(hot, _BUCKET, "left_semi").drop(_BUCKET)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    *,
    slice_rows: int = SLICE_ROWS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``left.join(right, on, how)`` for inner, left, left_semi and left_anti, safe for hot keys of ``left``.

    The left keys are counted per hash bucket; partial aggregation keeps that to ``buckets``
    rows a task. A bucket with more than ``slice_rows`` rows and more than twice its fair
    share is cut into slices: left rows of the bucket are dealt over the slices and the
    matching right rows are repeated once per slice. No slice exceeds the allowance by
    much, the repeats add at most about half of ``right`` when its keys are spread, and for
    a key that is hot on both sides they stay a small part of the join's own output.

    The counting reads the key columns of ``left`` once more. The slice of a row depends on
    its input partition and its other columns only, so a task that is run again deals its rows
    the same way, also where the input is already placed by the key.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join does not support {how!r}")
    _same_types(left, right, on)
    if how in ("left_semi", "left_anti"):
        right = right.select(*on).distinct()

    bucket = _bucket(on, buckets)
    hot = _hot_buckets(left, on, slice_rows, buckets)

    rest = [F.col(f.name) for f in left.schema if f.name not in on and f.dataType.typeName() not in ("array", "binary", "map", "struct", "variant")]
    number = F.spark_partition_id() + (F.pmod(F.xxhash64(*rest), F.lit(buckets)).cast("int") if rest else F.lit(0))
    dealt = (
        left.withColumn(_BUCKET, bucket)
        .join(hot, _BUCKET, "left")
        .withColumn(_SLICE, F.when(F.col(_SLICES).isNull(), F.lit(0)).otherwise(F.pmod(number, F.col(_SLICES))))
        .drop(_BUCKET, _SLICES)
    )
    repeated = (
        right.withColumn(_BUCKET, bucket)
        .join(hot, _BUCKET, "left")
        .withColumn(_SLICE, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SLICES), F.lit(1)) - 1)))
        .drop(_BUCKET, _SLICES)
    )
    return dealt.join(repeated, [*on, _SLICE], how).drop(_SLICE)

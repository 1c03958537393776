"""Stored tables laid out by key: changed a partition at a time, or joined without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..operators.dimensions import merge_upsert
from ..operators.joins import spread_join

MOST_PARTS = 1 << 16
"""Bound on the partitions of a keyed table, whose numbers an upsert collects."""


class KeyedTable:
    """A Parquet table cut into partitions by a hash of its key.

    An upsert reads and replaces the partitions that its changes fall into and no others, by
    dynamic partition overwrite: the new partitions are written beside the table and take
    their places when all are done, so a run that fails leaves the old rows, and one that is
    repeated gives the same rows. Partitions take their places one by one; should the driver be
    lost between two of them, run the upsert again. One writer at a time.

    The partition column names the number of partitions, so a table cannot be opened with another
    one. Keys are hashed as ``schema``, the table's own, has them.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], parts: int = 256):
        if not 0 < parts <= MOST_PARTS:
            raise ValueError(f"parts must lie between 1 and {MOST_PARTS}")
        self.spark, self.path, self.schema, self.keys = spark, path, schema, list(keys)
        self.parts = parts
        self.place = f"part_of_{parts}"

    def _placed(self, df: DataFrame) -> DataFrame:
        hashed = F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.keys])
        return df.withColumn(self.place, F.pmod(hashed, F.lit(self.parts)).cast("int"))

    def _write(self, df: DataFrame) -> None:
        writer = df.select(*self.schema.names, self.place).repartition(self.place).write.partitionBy(self.place)
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def create(self, df: DataFrame) -> None:
        """Lay out the table's first rows; the folder must not hold a table yet."""
        self._placed(df.select(*self.schema.names)).repartition(self.place).write.partitionBy(self.place).parquet(self.path)

    def read(self, only: Column | None = None) -> DataFrame:
        """The table's rows; ``only``, a condition on the partition column, prunes what is read."""
        stored = self.spark.read.schema(StructType([*self.schema.fields]).add(self.place, IntegerType())).parquet(self.path)
        return (stored if only is None else stored.where(only)).select(*self.schema.names)

    def touched(self, changes: DataFrame) -> list[int]:
        """The numbers of the partitions that the changes' keys fall into, at most ``parts``."""
        return sorted(r[0] for r in self._placed(changes.select(*self.keys)).select(self.place).distinct().collect())

    def upsert(self, changes: DataFrame, columns: Sequence[str], *, insert: bool = True) -> list[int]:
        """Set ``columns`` where the key matches and, with ``insert``, add the other changes; returns the partitions replaced.

        ``changes`` holds one row per key and is read twice. A NULL in the key matches nothing;
        with ``insert`` such a change is added.
        """
        numbers = self.touched(changes)
        if not numbers:
            return numbers
        typed = changes.select(*[F.col(c).cast(self.schema[c].dataType).alias(c) for c in (*self.keys, *columns)])
        now = self.read(F.col(self.place).isin(numbers))
        self._write(self._placed(merge_upsert(now, typed, self.keys, columns, insert=insert)))
        return numbers

    def mark(self, hits: DataFrame, column: str, value: object) -> list[int]:
        """Set one column to ``value`` on the rows whose key is among ``hits``."""
        return self.upsert(hits.select(*self.keys).distinct().withColumn(column, F.lit(value)), [column], insert=False)


class BucketedLog:
    """A log of processed keys, stored in buckets by its key, so that joins on it move the other side only.

    ``buckets`` should be at least ``spark.sql.shuffle.partitions``: Spark shuffles a table with
    fewer buckets again to keep its parallelism. An append keeps the layout; it adds a file to each
    bucket it has rows for.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int = 1024):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path, schema, list(keys), buckets
        # the catalogue of a session knows the table for as long as it is used here; its files are its own
        self.name = f"log_{uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = ", ".join(f"`{k}`" for k in self.keys)
        spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")

    def append(self, rows: DataFrame) -> None:
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        # one file for each bucket that has rows, instead of one for each bucket and task
        typed.repartition(self.buckets, *self.keys).write.insertInto(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def unprocessed(self, feed: DataFrame, *, range_column: str | None = None) -> DataFrame:
        """Feed rows whose key is not in the log; a NULL in the key never matches.

        The feed's distinct keys are shuffled to the log's buckets, those found there come
        back, and the feed drops their rows. The log is read where it lies, cut to the feed's range
        of ``range_column`` where one is named.
        """
        log = self.read().select(*self.keys)
        if range_column is not None:
            low, high = feed.agg(F.min(range_column)).scalar(), feed.agg(F.max(range_column)).scalar()
            log = log.where((F.col(range_column) >= low) & (F.col(range_column) <= high))
        offered = feed.select(*self.keys).na.drop().distinct()
        known = offered.join(log.hint("merge"), self.keys, "left_semi")
        return spread_join(feed, known, self.keys, "left_anti")

    def forget(self) -> None:
        """Take the table out of the session's catalogue; frames made before still read its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

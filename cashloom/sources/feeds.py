"""Readers of the CSV feeds."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .schemas import RECEIPT_SCHEMA, SALES_FEED_SCHEMA


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column text; for feeds that are cast after cleaning."""
    return spark.read.csv(path, header=True)


def read_typed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV bound to ``schema`` by position, whatever the header says; a field that does not parse is NULL."""
    return spark.read.csv(
        path, schema=schema, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    )


class Scan(NamedTuple):
    """What a scan of files could read, and the lines that it could not."""

    rows: DataFrame
    malformed: DataFrame


MALFORMED = "__malformed"


def scan_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | StructType) -> Scan:
    """CSV with a header bound by position, and its malformed lines apart.

    A line is malformed if it has too few or too many fields, which is also what a quote
    without its partner leads to. ``malformed`` has ARQUIVO, the file's path, and LINHA, the line as
    it is in the file, so that it can be mended and sent again. With a schema instead of names,
    fields are trimmed and cast, and one that does not parse is NULL, its row kept. A byte order
    mark, blank lines and either kind of line break are no part of the data; a quote inside a quoted
    field is doubled.
    """
    names = columns.names if isinstance(columns, StructType) else list(columns)
    schema = StructType()
    for name in [*names, MALFORMED]:
        schema = schema.add(name, StringType())
    # all fields of a line have to be parsed to count them, whatever columns are asked for
    options = {"header": True, "escape": '"', "columnPruning": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    raw = spark.read.options(**options).schema(schema).csv(path)
    # Spark wants a field beside the malformed line in every query on it
    broken = F.concat(F.col(MALFORMED), F.coalesce(F.col(f"`{names[0]}`"), F.lit("")))
    rows = raw.where(broken.isNull())
    if isinstance(columns, StructType):
        rows = rows.select(*[F.trim(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in columns])
    else:
        rows = rows.select(*names)
    malformed = raw.select("*", F.col("_metadata.file_path").alias("ARQUIVO")).where(broken.isNotNull())
    return Scan(rows, malformed.select("ARQUIVO", F.col(MALFORMED).alias("LINHA")))


def read_purchases(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path)


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, SALES_FEED_SCHEMA)


def read_payments(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path)


def read_receipts(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, RECEIPT_SCHEMA)

"""Schema enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Bind columns to ``schema`` by position: rename, cast, and fail on NULL in a required field.

    The check runs inside the tasks that compute the column, so nothing is gathered to verify it.
    """
    if len(df.columns) != len(schema):
        raise ValueError(f"{len(df.columns)} columns for a schema of {len(schema)}")
    columns = []
    for source, field in zip(df.columns, schema, strict=True):
        value = F.col(f"`{source}`").cast(field.dataType)
        if not field.nullable:
            message = F.lit(f"NULL in required column {field.name}")
            value = F.when(value.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return df.select(*columns)

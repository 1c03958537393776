"""Parameter rows: six values packed into one comma-separated text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the fields in packed order
FIELDS = {
    "VAR_DESCRICAO": "string",
    "VAR_DT_INICIAL": "date",
    "VAR_DT_FINAL": "date",
    "VAR_DT_ATUAL": "date",
    "VAR_EXPURGO": "int",
    "VAR_STATUS": "int",
}


def parse_parameters(df: DataFrame, packed: str = "DESCRICAO") -> DataFrame:
    """Unpack into typed columns; a missing or unparsable part is NULL."""
    parts = F.split(packed, ",")
    return df.withColumns({name: F.get(parts, F.lit(i)).try_cast(to) for i, (name, to) in enumerate(FIELDS.items())})


def encode_parameters(df: DataFrame, *, code: int, status: int, packed: str = "DESCRICAO") -> DataFrame:
    """Set the status of one parameter and pack that row again; other rows keep their text."""
    hit = F.col("COD") == code
    changed = df.withColumn("VAR_STATUS", F.when(hit, F.lit(status)).otherwise(F.col("VAR_STATUS")))
    text = F.concat_ws(",", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in FIELDS])
    return changed.withColumn(packed, F.when(hit, text).otherwise(F.col(packed)))


def parameter_value(df: DataFrame, code: int, field: str):
    """One parsed value on the driver, None where the parameter is absent."""
    row = df.where(F.col("COD") == code).select(field).first()
    return None if row is None else row[0]

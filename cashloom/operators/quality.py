"""Feed validation and clean-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fill_default, trim_cast
from .joins import MEMBER_ROWS, fits_broadcast, spread_join

OK = "OK"


class Split(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def trim_cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Trim and cast the named text columns; unparsable text becomes NULL."""
    return df.withColumns({name: trim_cast(name, to) for name, to in types.items()})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL in the named columns by their default."""
    return df.withColumns({name: fill_default(name, value) for name, value in defaults.items()})


def first_failing_rule(rules: Sequence[tuple[Column, str]]) -> Column:
    """Code of the first rule whose predicate holds, else ``OK``. The order of the rules matters."""
    reason = None
    for predicate, code in rules:
        reason = F.when(predicate, code) if reason is None else reason.when(predicate, code)
    return F.lit(OK) if reason is None else reason.otherwise(OK)


def split_valid_rejected(df: DataFrame, *, reason: str, flags: Sequence[str] = ()) -> Split:
    """Rows whose reason is ``OK``, without reason, and the others with theirs; both without flags."""
    return Split(
        df.where(F.col(reason) == OK).drop(reason, *flags),
        df.where(F.col(reason) != OK).drop(*flags),
    )


def domain_membership(df: DataFrame, domain: DataFrame, column: str, flag: str) -> DataFrame:
    """Add ``flag``: whether the text in ``column`` occurs in the one-column ``domain``.

    The match is exact and NULL is not a member.
    """
    members = domain.select(F.col(domain.columns[0]).alias(column))
    small = fits_broadcast(members, MEMBER_ROWS)
    members = members.distinct().withColumn(flag, F.lit(True))
    joined = df.join(F.broadcast(members), column, "left") if small else spread_join(df, members, column, "left")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False))).select(*df.columns, flag)


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value in every named column (default: every column)."""
    return df.where(_complete(columns or df.columns))


def clean_with_rejects(df: DataFrame, *, reason: str = "MOTIVO") -> Split:
    """Trim every column as text, then part rows with a NULL and repeats from the distinct rest.

    Accepted and rejected rows add up to the input: a row occurring n times is accepted
    once and rejected n - 1 times.
    """
    trimmed = df.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in df.columns])
    complete = drop_null_rows(trimmed)
    full = _complete(df.columns)

    # Copies are counted per input partition first, so a row repeated all over the table
    # reaches the window as one counted row per partition. One pass finds all rejects: of a
    # row with a NULL every copy, of any other all but one.
    counted = (
        trimmed.withColumn("__part", F.spark_partition_id())
        .groupBy(*df.columns, "__part")
        .agg(F.count(F.lit(1)).alias("__copies"))
    )
    order = Window.partitionBy(*df.columns).orderBy("__part")
    surplus = F.col("__copies") - F.when(full & (F.row_number().over(order) == 1), 1).otherwise(0)
    rejected = (
        counted.withColumn("__surplus", surplus.cast("int"))
        .where(F.col("__surplus") > 0)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__surplus"))))
        .select(*df.columns, F.when(full, "Dado Repetido").otherwise("Dado Nulo").alias(reason))
    )
    return Split(complete.distinct(), rejected)


def _complete(columns: Sequence[str]) -> Column:
    keep = F.lit(True)
    for name in columns:
        keep = keep & F.col(name).isNotNull()
    return keep

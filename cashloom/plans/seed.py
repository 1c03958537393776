"""First fill of the reference tables from their CSV files."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ..sources.feeds import read_typed_csv
from ..sources.schemas import ADDRESS_TYPE_SCHEMA, POSTAL_CODE_SCHEMA, TERM_SCHEMA, TIER_SCHEMA


class ReferenceData(NamedTuple):
    postal_codes: DataFrame
    address_types: DataFrame
    terms: DataFrame
    tiers: DataFrame


def seed_reference_data(
    spark: SparkSession, *, postal_codes: str, address_types: str, terms: str, tiers: str
) -> ReferenceData:
    """The four reference tables, to be appended to their target tables, which assign the ids."""
    return ReferenceData(
        postal_codes=read_typed_csv(spark, postal_codes, POSTAL_CODE_SCHEMA),
        address_types=read_typed_csv(spark, address_types, ADDRESS_TYPE_SCHEMA),
        terms=read_typed_csv(spark, terms, TERM_SCHEMA),
        tiers=read_typed_csv(spark, tiers, TIER_SCHEMA),
    )

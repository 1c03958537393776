"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def trim_cast(column: Column | str, to: DataType | str) -> Column:
    """Trim, then cast; text that does not parse becomes NULL instead of failing the job."""
    return F.trim(_col(column)).try_cast(to)


def fill_default(column: Column | str, default) -> Column:
    """The column, or ``default`` where it is NULL."""
    return F.coalesce(_col(column), F.lit(default))


def normalize_term(column: Column | str) -> Column:
    """Bring a payment term as typed by people to its canonical description.

    A term with "ntra" in characters 2-5 (a down payment) is kept. The rest is told
    apart by how it ends, case-sensitively. Anything else, NULL too, is kept.
    """
    term = _col(column)
    # fixed values
    by_ending = [("90 dias", "30/60/90 dias"), ("noventa dias", "30/60/90 dias"), ("60 dias", "30/60 dias"), ("vista", "A vista")]
    result = F.when(F.substring(term, 2, 4) == "ntra", term)
    for ending, canonical in by_ending:
        result = result.when(term.endswith(ending), F.lit(canonical))
    return result.otherwise(term)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column

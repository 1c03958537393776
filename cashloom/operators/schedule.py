"""Instalment schedules from invoices and payment terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.amounts import instalment_value
from .joins import lookup_join

TERM_COLUMNS = ("QTD_PARCELAS", "ENTRADA")

RANGE_ROWS = 1 << 16
"""Rows of a range of ids whose counts one task adds up."""

MOST_RANGES = 1 << 16
"""Bound on the ranges, whose totals are broadcast."""


def attach_terms(invoices: DataFrame, terms: DataFrame, *, term_id: str = "ID_CONDICAO") -> DataFrame:
    """Add instalment count and down-payment flag to invoices; invoices without a known term drop out."""
    return lookup_join(invoices, terms.select(term_id, *TERM_COLUMNS), term_id)


def generate_instalments(
    invoices: DataFrame,
    *,
    invoice_id: str,
    status: str,
    issued: str = "DATA_EMISSAO",
    total: str = "VALOR_TOTAL",
    residue_on_last: bool = False,
) -> DataFrame:
    """One row per instalment of each invoice with attached terms, in one narrow step.

    Instalment k is due k months after issue, or k - 1 with a down payment; a day past the
    end of the month becomes its last day. An invoice with a count below 1 yields none.
    """
    count = F.col("QTD_PARCELAS")
    exploded = invoices.where(count >= 1).withColumn("NUM_PARCELAS", F.explode(F.sequence(F.lit(1), count)))
    return exploded.select(*_instalment(invoice_id, status, issued, total, residue_on_last))


def _due(issued: str, number: Column) -> Column:
    return F.add_months(issued, (number - F.col("ENTRADA")).cast("int"))


def _instalment(invoice_id: str, status: str, issued: str, total: str, residue_on_last: bool) -> list[Column | str]:
    number = F.col("NUM_PARCELAS")
    value = instalment_value(F.col(total), F.col("QTD_PARCELAS"), number, residue_on_last=residue_on_last)
    return [invoice_id, _due(issued, number).alias("DATA_VENCIMENTO"), number.cast("int").alias("NUM_PARCELAS"), value.alias("VALOR_PARCELA"), F.lit(0).alias(status)]


def unscheduled_numbers(invoices: DataFrame, existing: DataFrame, *, invoice_id: str, issued: str = "DATA_EMISSAO") -> DataFrame:
    """Invoices with attached terms and ``__numbers``, the instalments whose (invoice, due date) is not scheduled yet.

    Invoices with none drop out. The existing schedule reaches the join as one row an invoice,
    with no more dates than the invoice has instalments.
    """
    count = F.col("QTD_PARCELAS")
    known = existing.groupBy(invoice_id).agg(F.collect_set("DATA_VENCIMENTO").alias("__known"))
    lacking = F.filter(
        F.sequence(F.lit(1), count), lambda k: F.col("__known").isNull() | ~F.coalesce(F.array_contains("__known", _due(issued, k)), F.lit(False))
    )
    joined = invoices.where(count >= 1).join(known, invoice_id, "left")
    return joined.withColumn("__numbers", lacking).drop("__known").where(F.size("__numbers") > 0)


def reserve_ids(
    rows: DataFrame, key: str, count: Column, first: str, *, start_after: DataFrame | int = 0, id_column: str = "", ties: Sequence[str] = ()
) -> DataFrame:
    """Add ``first``, the first of ``count`` consecutive ids that a row gets, dense in the order of ``key`` and ``ties``.

    Prefix sums: the counts are added up over ranges of ``key``, the totals of the ranges before
    say where a range starts, and a window inside the range does the rest. So what the rows
    expand to is never numbered or sorted. ``key`` is a whole number, such as an id that was itself
    given densely; ranges are then of equal size. Reads ``rows`` three times: pass a stored
    frame. ``start_after``: the last id in use, or the table whose ``id_column`` has it.
    """
    found = rows.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("n")).first()
    ranges = min(MOST_RANGES, max(1, -(-found.n // RANGE_ROWS)))
    low = found.low or 0
    width = ((found.high or 0) - low) // ranges + 1
    grouped = rows.withColumns({"__range": F.coalesce(F.call_function("div", F.col(key) - F.lit(low), F.lit(width)), F.lit(-1)), "__count": count.cast("long")})
    totals = grouped.groupBy("__range").agg(F.sum("__count").alias("__total"))
    # one row a range, at most MOST_RANGES + 1: bounded for one window and for a broadcast
    earlier = F.sum("__total").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("__range", F.coalesce(earlier, F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__range").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    if isinstance(start_after, int):
        last: Column = F.lit(start_after)
    else:
        last = F.coalesce(start_after.agg(F.max(id_column)).scalar(), F.lit(0))
    placed = grouped.withColumn("__ahead", F.coalesce(F.sum("__count").over(inside), F.lit(0))).join(F.broadcast(starts), "__range")
    return placed.select(*rows.columns, (last + F.col("__start") + F.col("__ahead") + 1).cast("long").alias(first))


def numbered_instalments(
    invoices: DataFrame,
    *,
    invoice_id: str,
    status: str,
    id_column: str,
    issued: str = "DATA_EMISSAO",
    total: str = "VALOR_TOTAL",
    residue_on_last: bool = False,
) -> DataFrame:
    """The instalments ``__numbers`` of invoices that have reserved ids from ``__first`` on, in one narrow step."""
    exploded = invoices.select("*", F.posexplode("__numbers").alias("__place", "NUM_PARCELAS"))
    return exploded.select((F.col("__first") + F.col("__place")).alias(id_column), *_instalment(invoice_id, status, issued, total, residue_on_last))


def new_instalments(schedule: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Scheduled instalments whose (invoice, due date) is not in the existing schedule.

    The invoice id is unique among invoices, so a key has a handful of rows on either side.
    """
    return schedule.join(existing.select(*keys), list(keys), "left_anti").select(*schedule.columns)

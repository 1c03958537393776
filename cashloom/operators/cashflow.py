"""Daily and monthly cash flow with running balances."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.amounts import MONEY
from ..functions.periods import FIRST_DAY, month_end
from ..sources.staging import shared_copy


def daily_sum(df: DataFrame, day: str, amount: str, total: str) -> DataFrame:
    """Sum per day, with the month number."""
    return df.groupBy(F.to_date(day).alias(day), F.month(F.to_date(day)).alias("MES")).agg(F.sum(amount).alias(total))


def monthly_sum(df: DataFrame, day: str, amount: str, total: str) -> DataFrame:
    """Sum per month, with month end, year and month number."""
    return df.groupBy(
        month_end(F.to_date(day)).alias("DATA_FECHAMENTO"), F.year(day).alias("ANO"), F.month(day).alias("MES")
    ).agg(F.sum(amount).alias(total))


def _signed_rows(inflow: DataFrame, outflow: DataFrame, inflow_columns: tuple[str, str], outflow_columns: tuple[str, str]) -> DataFrame:
    """Both flows under (DATA, ENTRADA, SAIDA), NULL on the side a row does not belong to."""
    none = F.lit(None).cast(MONEY)
    ins = inflow.select(F.to_date(inflow_columns[0]).alias("DATA"), F.col(inflow_columns[1]).cast(MONEY).alias("ENTRADA"), none.alias("SAIDA"))
    outs = outflow.select(F.to_date(outflow_columns[0]).alias("DATA"), none.alias("ENTRADA"), F.col(outflow_columns[1]).cast(MONEY).alias("SAIDA"))
    return ins.unionByName(outs)


def _totals() -> tuple[Column, Column]:
    return F.coalesce(F.sum("ENTRADA"), F.lit(0)).cast("decimal(26,2)"), F.coalesce(F.sum("SAIDA"), F.lit(0)).cast("decimal(26,2)")


def merge_flows_daily(
    inflow: DataFrame, outflow: DataFrame, inflow_columns: tuple[str, str], outflow_columns: tuple[str, str]
) -> DataFrame:
    """In-flow and out-flow per day, 0 where one is absent: (DATA, SAIDA, ENTRADA, SALDO_DIARIO).

    Takes raw (day, amount) rows or daily sums. Both flows go through one aggregation,
    so a day costs one shuffled row per task.
    """
    total_in, total_out = _totals()
    days = _signed_rows(inflow, outflow, inflow_columns, outflow_columns).where(F.col("DATA").isNotNull())
    return (
        days.groupBy("DATA")
        .agg(total_out.alias("SAIDA"), total_in.alias("ENTRADA"))
        .withColumn("SALDO_DIARIO", (F.col("ENTRADA") - F.col("SAIDA")).cast("decimal(26,2)"))
    )


def merge_flows_monthly(
    inflow: DataFrame, outflow: DataFrame, inflow_columns: tuple[str, str], outflow_columns: tuple[str, str]
) -> DataFrame:
    """The same per month end: (DATA_FECHAMENTO, ANO, MES, ENTRADA, SAIDA, SALDO_MENSAL)."""
    total_in, total_out = _totals()
    rows = _signed_rows(inflow, outflow, inflow_columns, outflow_columns).where(F.col("DATA").isNotNull())
    return (
        rows.groupBy(month_end("DATA").alias("DATA_FECHAMENTO"))
        .agg(total_in.alias("ENTRADA"), total_out.alias("SAIDA"))
        .select(
            "DATA_FECHAMENTO",
            F.year("DATA_FECHAMENTO").alias("ANO"),
            F.month("DATA_FECHAMENTO").alias("MES"),
            "ENTRADA",
            "SAIDA",
            (F.col("ENTRADA") - F.col("SAIDA")).cast("decimal(26,2)").alias("SALDO_MENSAL"),
        )
    )


def running_balance(
    df: DataFrame, order: str, amount: str, balance: str, *, opening: Column | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Cumulative sum of ``amount`` in ``order``, plus the opening balance.

    Meant for rows already summed per day or month: without ``by`` all of them meet in one
    task, which is bounded by the number of days in the calendar span.
    """
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum(amount).over(window)
    if opening is not None:
        total = total + F.coalesce(opening, F.lit(0))
    return df.withColumn(balance, total.cast("decimal(26,2)"))


BLOCK_ROWS = 1_000_000
"""Movements of a block of :func:`running_balance_of_movements`."""

MOST_BLOCKS = 1000
"""Blocks at most: the driver plans, samples and reports in proportion to their number; past it blocks grow instead."""


def running_balance_of_movements(
    movements: DataFrame,
    order: Sequence[str],
    amount: str,
    balance: str,
    *,
    opening: Column | None = None,
    block_rows: int = BLOCK_ROWS,
    stage: Callable[[DataFrame], DataFrame] = shared_copy,
) -> DataFrame:
    """The balance after every single movement, in ``order``, however many there are.

    A blocked prefix scan: movements are dealt in order over blocks of about ``block_rows``, more
    where that would make over ``MOST_BLOCKS``; the sums of the blocks, one row each, give every
    block its opening balance, and a window adds up inside the block. No task gets more than a block. ``order`` should tell movements apart;
    of those it does not, each has the balance of one of their orders, as in any running sum.
    NULL amounts count as 0.
    """
    blocks = min(max(1, -(-movements.count() // block_rows)), MOST_BLOCKS)
    dealt = stage(movements.repartitionByRange(blocks, *order).withColumn("__block", F.spark_partition_id()))
    value = F.coalesce(F.col(amount), F.lit(0))
    sums = dealt.groupBy("__block").agg(F.sum(value).alias("__sum"))
    before = F.sum("__sum").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    # a row for each block: the window over them and the broadcast are bounded by their number
    openings = F.broadcast(sums.select("__block", F.coalesce(before, F.lit(0)).alias("__before")))
    inside = Window.partitionBy("__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum(value).over(inside) + F.col("__before")
    if opening is not None:
        total = total + F.coalesce(opening, F.lit(0))
    return dealt.join(openings, "__block").withColumn(balance, total.cast("decimal(26,2)")).select(*movements.columns, balance)


def repair_balances(history: DataFrame, corrections: DataFrame, order: str, net: str, balance: str) -> DataFrame:
    """Closed rows from the first corrected one on, as they have to be: (order, SAIDA, ENTRADA, ``net``, ``balance``).

    ``corrections`` holds ENTRADA and SAIDA to be added, signed, for some values of ``order``;
    some may be new to the history. A balance changes by the corrections up to its row, so
    it is repaired by their prefix sums, and a new row starts from the last balance before it.
    Nothing is summed that the history has summed before. Both sides hold one row per day or
    month, which bounds the window.
    """
    none = F.lit(None).cast("decimal(26,2)")
    old = history.select(order, "SAIDA", "ENTRADA", F.col(balance).alias("__old"), F.lit(None).cast("decimal(26,2)").alias("__change"))
    new = corrections.select(order, "SAIDA", "ENTRADA", none.alias("__old"), (F.col("ENTRADA") - F.col("SAIDA")).alias("__change"))
    rows = old.unionByName(new).groupBy(order).agg(
        F.sum("SAIDA").alias("SAIDA"), F.sum("ENTRADA").alias("ENTRADA"), F.max("__old").alias("__old"), F.sum("__change").alias("__change")
    )
    so_far = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    change = F.sum("__change").over(so_far)
    base = F.coalesce(F.last("__old", ignorenulls=True).over(so_far), F.lit(0))
    return (
        rows.withColumns({"__before": base, "__until": change})
        .where(F.col("__until").isNotNull())  # before the first correction nothing changes
        .select(
            order,
            F.col("SAIDA").cast("decimal(26,2)").alias("SAIDA"),
            F.col("ENTRADA").cast("decimal(26,2)").alias("ENTRADA"),
            (F.col("ENTRADA") - F.col("SAIDA")).cast("decimal(26,2)").alias(net),
            (F.col("__before") + F.col("__until")).cast("decimal(26,2)").alias(balance),
        )
    )


def with_repairs(history: DataFrame, repaired: DataFrame, order: str) -> DataFrame:
    """The next version of the history: its rows before the first repaired one, and the repaired ones."""
    first = repaired.agg(F.min(order)).scalar()
    return history.where(first.isNull() | (F.col(order) < first)).unionByName(repaired)


def latest_row(df: DataFrame, order: str, *values: str) -> DataFrame:
    """One row with the named values of the row latest in ``order``; NULLs where there is none."""
    return df.agg(*[F.max_by(v, order).alias(v) for v in values])


def first_open_day(history: DataFrame, order: str, closed: str, kind: DataType | str = "date") -> DataFrame:
    """One row with the day after the last close as ``kind``, the type of the column it bounds.

    Default and cast are inside the row, so that comparing a bare column with its scalar
    becomes a pushed filter. The row is the first by order, not an aggregate: scalars of
    aggregates over one table are merged into a record, and fields of it are not pushed.
    """
    default = F.lit(FIRST_DAY).cast("date")
    closings = history.where(F.col(order).isNotNull()).select(
        F.col(order).cast("timestamp").alias("at"), F.coalesce(F.date_add(closed, 1), default).alias("day")
    )
    none = history.sparkSession.range(1).select(F.lit(None).cast("timestamp").alias("at"), default.alias("day"))
    return closings.unionByName(none).orderBy(F.desc_nulls_last("at"), F.desc("day")).limit(1).select(F.col("day").cast(kind).alias("first_open"))


def audit_columns(df: DataFrame, day: str | None, *, processed_at: datetime | date | None = None) -> DataFrame:
    """Add month-end closing date (from ``day``, where given) and processing time."""
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at)
    if day is not None:
        df = df.withColumn("DATA_FECHAMENTO", month_end(day))
    return df.withColumn("DATA_PROCESSADO", stamp)

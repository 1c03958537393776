"""Date-range predicates.

The calendar forms compare the bare column with a constant, so they reach the scan as
pushed filters and prune partitions. ``month_number`` compares month numbers instead:
it skips earlier years' later months, and is kept for answers that must equal an
existing ledger built that way.
"""

from __future__ import annotations

from datetime import date, timedelta
from typing import Literal

from pyspark.sql import Column
from pyspark.sql import functions as F

PeriodMode = Literal["calendar", "month_number"]


def month_start(day: date) -> date:
    return day.replace(day=1)


def previous_month(day: date) -> date:
    """First day of the month before ``day``'s, across the year boundary."""
    return day.replace(year=day.year - 1, month=12, day=1) if day.month == 1 else day.replace(month=day.month - 1, day=1)


def closed_before(
    column: Column | str,
    reference: date,
    mode: PeriodMode = "calendar",
    *,
    year_test: Literal["up_to", "same", "none"] = "up_to",
) -> Column:
    """Dates in months before the reference month."""
    day = _col(column)
    if mode == "calendar":
        return day < F.lit(month_start(reference))
    if mode != "month_number":
        raise ValueError(f"unknown period mode {mode!r}")
    earlier = F.month(day) < reference.month
    if year_test == "none":
        return earlier
    if year_test == "same":
        return earlier & (F.year(day) == reference.year)
    return earlier & (F.year(day) <= reference.year)


FIRST_DAY = "0001-01-01"
"""The open day where nothing was closed yet."""


def after(column: Column | str, last_close: date | Column | None) -> Column:
    """Dates and moments after the day of the last close; all where nothing was closed yet.

    A moment on the closing day belongs to the closed period. To bound a scan by a table's last
    close, use :func:`since` with a sub-query that already gives the first open day.
    """
    if last_close is None:
        return F.lit(True)
    if isinstance(last_close, date):
        return since(column, F.lit(last_close + timedelta(days=1)))
    return since(column, F.coalesce(F.date_add(last_close, 1), F.lit(FIRST_DAY).cast("date")))


def since(column: Column | str, first_open: Column) -> Column:
    """Dates and moments from the first open day on, by the bare column, so that the bound reaches the scan."""
    return _col(column) >= first_open


def in_month_of(column: Column | str, reference: date) -> Column:
    """Dates in the reference month."""
    first = month_start(reference)
    following = first.replace(year=first.year + 1, month=1) if first.month == 12 else first.replace(month=first.month + 1)
    day = _col(column)
    return (day >= F.lit(first)) & (day < F.lit(following))


def month_end(column: Column | str) -> Column:
    return F.last_day(_col(column))


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column

"""Cash-flow jobs: first load, period close, and the open month."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import PeriodMode, closed_before, in_month_of, previous_month, since
from ..operators.cashflow import (
    audit_columns,
    first_open_day,
    latest_row,
    merge_flows_daily,
    merge_flows_monthly,
    repair_balances,
    running_balance,
    with_repairs,
)
from ..operators.parameters import encode_parameters, parameter_value, parse_parameters
from ..sources.staging import shared_copy

RECEIVED = ("DATA_RECEBIDO", "VALOR_PAGO")
PAID = ("DATA_PGT_EFETUADO", "VALOR_PARCELA_PAGO")

DAILY_COLUMNS = ("DATA", "SAIDA", "ENTRADA", "SALDO_DIARIO", "ACUMULADO_DIARIO", "DATA_FECHAMENTO", "DATA_PROCESSADO")
MONTHLY_COLUMNS = ("DATA_FECHAMENTO", "ANO", "MES", "ENTRADA", "SAIDA", "SALDO_MENSAL", "VALOR_ACUMULADO_MES", "DATA_PROCESSADO")


class Cashflow(NamedTuple):
    daily: DataFrame
    monthly: DataFrame


class InitialLoad(NamedTuple):
    daily: DataFrame
    monthly: DataFrame
    parameters: DataFrame | None


class Repair(NamedTuple):
    """Closed days and months that late postings change, and both histories with them."""

    daily: DataFrame
    monthly: DataFrame
    daily_next: DataFrame
    monthly_next: DataFrame


@dataclass(frozen=True)
class RunState:
    """When a job runs and what was done before: status 0 means nothing was loaded yet."""

    today: date
    status: int
    cutoff: date | None = None

    @property
    def past_cutoff(self) -> bool:
        return self.cutoff is None or self.today >= self.cutoff


def state_from_parameters(parameters: DataFrame, today: date) -> RunState:
    """Read status (parameter 1) and cut-off date (parameter 2) from packed parameter rows."""
    parsed = parse_parameters(parameters)
    return RunState(
        today, status=parameter_value(parsed, 1, "VAR_STATUS"), cutoff=parameter_value(parsed, 2, "VAR_DT_ATUAL")
    )


def daily_flow(
    receipts: DataFrame, payments: DataFrame, *, opening: Column | None = None, processed_at: datetime | date | None = None
) -> DataFrame:
    days = merge_flows_daily(receipts, payments, RECEIVED, PAID)
    balanced = running_balance(days, "DATA", "SALDO_DIARIO", "ACUMULADO_DIARIO", opening=opening)
    return audit_columns(balanced, "DATA", processed_at=processed_at).select(*DAILY_COLUMNS)


def monthly_flow(
    receipts: DataFrame, payments: DataFrame, *, opening: Column | None = None, processed_at: datetime | date | None = None
) -> DataFrame:
    months = merge_flows_monthly(receipts, payments, RECEIVED, PAID)
    balanced = running_balance(months, "DATA_FECHAMENTO", "SALDO_MENSAL", "VALOR_ACUMULADO_MES", opening=opening)
    return audit_columns(balanced, None, processed_at=processed_at).select(*MONTHLY_COLUMNS)


def _both(receipts: DataFrame, payments: DataFrame, predicate) -> tuple[DataFrame, DataFrame]:
    return receipts.where(predicate(RECEIVED[0])), payments.where(predicate(PAID[0]))


def _open(receipts: DataFrame, payments: DataFrame, daily_history: DataFrame, predicate) -> tuple[DataFrame, DataFrame]:
    """Both flows from the first day that the history has not closed, where ``predicate`` holds."""

    def bounded(flow: DataFrame, day: str) -> DataFrame:
        first = first_open_day(daily_history, "DATA", "DATA_FECHAMENTO", flow.schema[day].dataType)
        return flow.where(predicate(day) & since(day, first.scalar()))

    return bounded(receipts, RECEIVED[0]), bounded(payments, PAID[0])


def cashflow_initial(
    receipts: DataFrame,
    payments: DataFrame,
    state: RunState,
    *,
    mode: PeriodMode = "calendar",
    parameters: DataFrame | None = None,
    processed_at: datetime | date | None = None,
) -> InitialLoad:
    """First load: every closed month, with balances from zero; empty once the status is 1.

    Before the cut-off date the month just closed is left out as well. Past it, the
    parameter rows come back with the status set, to be written by the caller.
    """
    reference = state.today if state.past_cutoff else previous_month(state.today)
    gate = F.lit(state.status == 0)
    days = _both(receipts, payments, lambda d: gate & closed_before(d, reference, mode))
    months = _both(receipts, payments, lambda d: gate & closed_before(d, reference, mode, year_test="none"))
    if parameters is not None and state.status == 0 and state.past_cutoff:
        parameters = encode_parameters(parse_parameters(parameters), code=1, status=1).select(*parameters.columns)
    return InitialLoad(
        daily_flow(*days, processed_at=processed_at), monthly_flow(*months, processed_at=processed_at), parameters
    )


def cashflow_close(
    receipts: DataFrame,
    payments: DataFrame,
    daily_history: DataFrame,
    monthly_history: DataFrame,
    state: RunState,
    *,
    mode: PeriodMode = "calendar",
    processed_at: datetime | date | None = None,
) -> Cashflow:
    """Months closed since the last close, balances carried on; empty before the first load or the cut-off.

    Appending the result and running again yields nothing until another month has closed.
    """
    gate = F.lit(state.status == 1 and state.past_cutoff)
    flows = _open(receipts, payments, daily_history, lambda d: gate & closed_before(d, state.today, mode))
    return Cashflow(
        daily_flow(*flows, opening=latest_row(daily_history, "DATA", "ACUMULADO_DIARIO").scalar(), processed_at=processed_at),
        monthly_flow(
            *flows, opening=latest_row(monthly_history, "DATA_FECHAMENTO", "VALOR_ACUMULADO_MES").scalar(), processed_at=processed_at
        ),
    )


def cashflow_current_month(
    receipts: DataFrame,
    payments: DataFrame,
    daily_history: DataFrame,
    monthly_history: DataFrame,
    state: RunState,
    *,
    through_unclosed: bool | None = None,
    mode: PeriodMode = "calendar",
    processed_at: datetime | date | None = None,
) -> DataFrame:
    """The open month day by day, replacing the previous view; empty before the first load.

    It opens with the last closed balance or, with ``through_unclosed`` (default: before
    the cut-off), with the balance after the months that ended but were not closed yet.
    """
    if through_unclosed is None:
        through_unclosed = not state.past_cutoff
    gate = F.lit(state.status == 1)
    opening = latest_row(daily_history, "DATA", "ACUMULADO_DIARIO").scalar()
    if through_unclosed:
        closed = latest_row(monthly_history, "DATA_FECHAMENTO", "VALOR_ACUMULADO_MES").scalar()
        unclosed = _open(
            receipts, payments, daily_history, lambda d: gate & closed_before(d, state.today, mode, year_test="same")
        )
        months = monthly_flow(*unclosed, opening=closed, processed_at=processed_at)
        opening = F.coalesce(latest_row(months, "DATA_FECHAMENTO", "VALOR_ACUMULADO_MES").scalar(), closed)
    current = _both(receipts, payments, lambda d: gate & in_month_of(d, state.today))
    return daily_flow(*current, opening=opening, processed_at=processed_at)


def cashflow_late_postings(
    receipts: DataFrame,
    payments: DataFrame,
    daily_history: DataFrame,
    monthly_history: DataFrame,
    *,
    arrived: str,
    after: date,
    processed_at: datetime | date | None = None,
    stage: Callable[[DataFrame], DataFrame] = shared_copy,
) -> Repair:
    """Book postings dated in a closed month that arrived after ``after``, the day of the last close or repair.

    ``arrived`` names the ledgers' column with the day a row came in; of a ledger partitioned by
    it, only the partitions behind ``after`` are read, whatever the closed months hold. The rows
    are added up by day, once, and balances from the first corrected day on move by the sums up
    to them. Rows dated after the last closed day are left to the next close. Without late
    rows nothing is repaired; a repair that is run again must start ``after`` the last one.
    """
    last = latest_row(daily_history, "DATA", "DATA_FECHAMENTO").scalar()

    def late(flow: DataFrame, day: str) -> DataFrame:
        return flow.where((F.col(arrived) > F.lit(after)) & (F.to_date(day) <= last))

    days = stage(merge_flows_daily(late(receipts, RECEIVED[0]), late(payments, PAID[0]), RECEIVED, PAID))
    months = days.groupBy(F.last_day("DATA").alias("DATA_FECHAMENTO")).agg(F.sum("SAIDA").alias("SAIDA"), F.sum("ENTRADA").alias("ENTRADA"))
    daily = audit_columns(repair_balances(daily_history, days, "DATA", "SALDO_DIARIO", "ACUMULADO_DIARIO"), "DATA", processed_at=processed_at)
    monthly = audit_columns(
        repair_balances(monthly_history, months, "DATA_FECHAMENTO", "SALDO_MENSAL", "VALOR_ACUMULADO_MES"), None, processed_at=processed_at
    ).withColumns({"ANO": F.year("DATA_FECHAMENTO"), "MES": F.month("DATA_FECHAMENTO")})
    daily, monthly = stage(daily.select(*DAILY_COLUMNS)), stage(monthly.select(*MONTHLY_COLUMNS))
    return Repair(daily, monthly, with_repairs(daily_history, daily, "DATA"), with_repairs(monthly_history, monthly, "DATA_FECHAMENTO"))

"""One run from validated feeds to cash flow: invoices, schedules with ids, postings, balances."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame

from ..sources.staging import shared_copy
from .cash import InitialLoad, RunState, cashflow_initial
from .ingest import Ingest
from .posting import Posting, post_payments, post_receipts
from .schedules import numbered_payables, numbered_receivables


class Schedules(NamedTuple):
    """The new instalments of both sides, with their ids, and the whole schedules to post against."""

    new_payables: DataFrame
    new_receivables: DataFrame
    payables: DataFrame
    receivables: DataFrame


class Cycle(NamedTuple):
    payments: Posting
    receipts: Posting
    cash: InitialLoad


def schedule_invoices(
    purchases: Ingest,
    sales: Ingest,
    terms: DataFrame,
    *,
    payables: DataFrame,
    receivables: DataFrame,
    residue_on_last: bool = False,
    stage: Callable[[DataFrame], DataFrame] = shared_copy,
) -> Schedules:
    """Instalments of the invoices that two ingests accepted, behind those of the schedules so far.

    The new instalments are staged before anything refers to their ids.
    """
    new_out = stage(numbered_payables(purchases.invoices, terms, payables, residue_on_last=residue_on_last, stage=stage))
    new_in = stage(numbered_receivables(sales.invoices, terms, receivables, residue_on_last=residue_on_last, stage=stage))
    return Schedules(new_out, new_in, payables.unionByName(new_out), receivables.unionByName(new_in))


def post_and_report(
    schedules: Schedules,
    payments: DataFrame,
    receipts: DataFrame,
    *,
    invoices: DataFrame,
    tiers: DataFrame,
    payment_history: DataFrame,
    receipt_history: DataFrame,
    state: RunState,
    stage: Callable[[DataFrame], DataFrame] = shared_copy,
    **options,
) -> Cycle:
    """Post a payment file and receipts against the schedules and report the closed months.

    ``invoices``: number and id of the sales invoices that receipts name. The histories are what
    was posted before; the cash flow covers them and the new postings. ``options`` go to
    :func:`~cashloom.plans.cash.cashflow_initial`.
    """
    paid = post_payments(payments, schedules.payables, stage=stage)
    received = post_receipts(receipts, invoices, schedules.receivables, receipt_history, tiers, stage=stage)
    received = received._replace(history=stage(received.history))
    cash = cashflow_initial(
        receipt_history.unionByName(received.history), payment_history.unionByName(paid.history), state, **options
    )
    return Cycle(paid, received, cash)

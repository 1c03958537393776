"""Posting payments and receipts: history rows to append and the schedule's next version."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql.types import DateType, IntegerType

from ..functions import trim_cast
from ..operators.schema import conform_schema
from ..operators.settlement import (
    mark_settled,
    payments_to_open_schedule,
    receipts_to_unposted,
    settlement_deviation,
    tolerance_band_join,
    unmatched_default,
)
from ..sources.schemas import MONEY, PAYMENT_CASTS, optional
from ..sources.staging import shared_copy


class Posting(NamedTuple):
    history: DataFrame
    schedule: DataFrame


def post_payments(
    payments: DataFrame, schedule: DataFrame, *, stage: Callable[[DataFrame], DataFrame] = shared_copy
) -> Posting:
    """Post a payment file of text columns against the open instalments."""
    types = {**PAYMENT_CASTS, "ID_NF_ENTRADA": schedule.schema["ID_NF_ENTRADA"].dataType}
    typed = payments.select(*[trim_cast(name, to).alias(name) for name, to in types.items()])
    typed = typed.withColumnRenamed("VALOR_PGT_EFETUADO", "VALOR_PARCELA_PAGO")
    history = stage(payments_to_open_schedule(typed, schedule))
    settled = mark_settled(schedule, history, schedule_id="ID_PROG_PAGAMENTO", status="STATUS_PAGAMENTO")
    return Posting(history, settled)


def post_receipts(
    receipts: DataFrame,
    invoices: DataFrame,
    schedule: DataFrame,
    history: DataFrame,
    tiers: DataFrame,
    *,
    approved_only: bool = False,
    best_tier: bool = False,
    stage: Callable[[DataFrame], DataFrame] = shared_copy,
) -> Posting:
    """Post receipts: each instalment goes to the history under every tier that accepts it, or as divergent.

    Any receipt settles its instalment, divergent ones too. The matched receipts are read
    several times, so ``stage`` keeps them.
    """
    met = stage(settlement_deviation(receipts_to_unposted(receipts, invoices, schedule, history)))
    columns = ["ID_PROG_RECEBIMENTO", "ID_DESCONTO", "DATA_RECEBIMENTO", "VALOR_PARCELA", "VALOR_RECEBIDO"]
    matched = tolerance_band_join(met, tiers, approved_only=approved_only, best_tier=best_tier).select(*columns).distinct()
    divergent = unmatched_default(met, matched).select(*columns)
    posted = conform_schema(
        matched.unionByName(divergent),
        optional(
            ID_PROG_RECEBIMENTO=schedule.schema["ID_PROG_RECEBIMENTO"].dataType,
            ID_DESCONTO=IntegerType(),
            DATA_RECEBIDO=DateType(),
            VALOR_TOTAL_EM_HAVER=MONEY,
            VALOR_PAGO=MONEY,
        ),
    )
    settled = mark_settled(schedule, met, schedule_id="ID_PROG_RECEBIMENTO", status="STATUS_RECEBIMENTO")
    return Posting(posted, settled)

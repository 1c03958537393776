"""Matching payments and receipts to the schedule, and judging receipts against tolerance tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import deviation_percent, within_percent
from .intervals import ranges_of_points
from .joins import BROADCAST_ROWS, fits_broadcast, spread_join
from .quality import drop_null_rows

DIVERGENT_TIER = 9
"""Tier id of a settlement that no tier accepts."""

DIVERGENT_REASON = "DESCONTO INVALIDO"

TIERS_TOGETHER = 1_000_000
"""Tiers of one range of percent that a row holds."""

SETTLEMENT_ROWS = 1 << 17
"""Settlements of one day that a task takes without being split, where tiers are many."""

DAY_TIERS = 1 << 21
"""Tiers, counted once for each day that occurs, whose ids are sent to the settlements instead of shuffling these; an id takes 24 bytes."""


def receipts_to_invoice(
    receipts: DataFrame, invoices: DataFrame, *, number: str = "NUMERO_NF", invoice_id: str = "ID_NF_SAIDA"
) -> DataFrame:
    """Add the invoice id to receipts by invoice number; receipts without an invoice drop out."""
    return spread_join(receipts, invoices.select(number, invoice_id), number)


def receipts_to_schedule(
    receipts: DataFrame,
    schedule: DataFrame,
    history: DataFrame,
    *,
    keys: Sequence[str] = ("ID_NF_SAIDA", "DATA_VENCIMENTO"),
    schedule_id: str = "ID_PROG_RECEBIMENTO",
    amount: str = "VALOR_RECEBIDO",
    received: str = "DATA_RECEBIMENTO",
) -> DataFrame:
    """Instalments met by a receipt and not posted before, with the receipt's amount and date.

    Posted instalments leave the schedule first: its id is unique there, so that join has
    no hot key, whatever the receipts look like.
    """
    unposted = schedule.join(history.select(schedule_id).distinct(), schedule_id, "left_anti")
    met = spread_join(receipts.select(*keys, amount, received), unposted, keys)
    return met.select(*schedule.columns, amount, received)


def receipts_to_unposted(
    receipts: DataFrame,
    invoices: DataFrame,
    schedule: DataFrame,
    history: DataFrame,
    *,
    number: str = "NUMERO_NF",
    invoice_id: str = "ID_NF_SAIDA",
    due: str = "DATA_VENCIMENTO",
    schedule_id: str = "ID_PROG_RECEBIMENTO",
    amount: str = "VALOR_RECEBIDO",
    received: str = "DATA_RECEBIMENTO",
) -> DataFrame:
    """:func:`receipts_to_schedule` of receipts that name an invoice's number, in one join that hot keys have to be spread for.

    The schedule loses what was posted and gets the invoices' numbers by two joins on ids that
    are unique on one side; then receipts meet it once, by number and due date.
    """
    unposted = schedule.join(history.select(schedule_id).distinct(), schedule_id, "left_anti")
    numbered = unposted.join(invoices.select(number, invoice_id), invoice_id)
    met = spread_join(receipts.select(number, due, amount, received), numbered, [number, due])
    return met.select(*schedule.columns, amount, received)


def payments_to_open_schedule(
    payments: DataFrame,
    schedule: DataFrame,
    *,
    keys: Sequence[str] = ("ID_NF_ENTRADA", "DATA_VENCIMENTO"),
    status: str = "STATUS_PAGAMENTO",
    paid: Sequence[str] = ("DATA_PGT_EFETUADO", "VALOR_PARCELA_PAGO"),
    planned: Sequence[str] = ("ID_PROG_PAGAMENTO", "ID_NF_ENTRADA", "NUM_PARCELAS", "DATA_VENCIMENTO"),
    value: str = "VALOR_PARCELA",
) -> DataFrame:
    """Payments joined to the open instalment they settle, complete rows only.

    Two payments for one open instalment both stay.
    """
    columns = [*planned, paid[0], value, paid[1]]
    open_only = schedule.where(F.col(status) == 0).select(*planned, value)
    return drop_null_rows(spread_join(payments.select(*keys, *paid), open_only, keys).select(*columns))


def settlement_deviation(
    settlements: DataFrame,
    *,
    due: str = "DATA_VENCIMENTO",
    received: str = "DATA_RECEBIMENTO",
    expected: str = "VALOR_PARCELA",
    actual: str = "VALOR_RECEBIDO",
) -> DataFrame:
    """Add days between due date and receipt, the early flag and the deviation in percent.

    Days are absolute and the flag tells the side. Underpaid without being early counts as
    a deviation of -1 percent, which marks it as outside every tier.
    """
    days = F.datediff(received, due)
    early = F.when(days >= 0, False).otherwise(True)
    underpaid = ~early & (F.col(actual) < F.col(expected))
    percent = F.when(underpaid, F.lit(-1)).otherwise(deviation_percent(F.col(actual), F.col(expected)))
    return settlements.withColumns({"DIAS_DIFERENCA": F.abs(days), "PORCENTAGEM": percent, "TIPO": early})


def tolerance_band_join(
    settlements: DataFrame,
    tiers: DataFrame,
    *,
    expected: str = "VALOR_PARCELA",
    actual: str = "VALOR_RECEBIDO",
    approved_only: bool = False,
    best_tier: bool = False,
) -> DataFrame:
    """Add the id of each tier that accepts the settlement: days and percent in its range, same side.

    A settlement repeats when two tiers accept it, and is absent when none does.
    ``approved_only`` leaves unapproved tiers out; ``best_tier`` keeps the lowest matching
    id of each distinct settlement.
    """
    if approved_only:
        tiers = tiers.where(F.col("STATUS_APROVACAO") == 1)
    bands = tiers.select("ID_DESCONTO", "MINIMO_DIAS", "MAXIMO_DIAS", "MINIMO", "MAXIMO", (F.col("TIPO_DESCONTO") == 1).alias("TIPO"))
    accepted = F.col("DIAS_DIFERENCA").between(F.col("MINIMO_DIAS"), F.col("MAXIMO_DIAS")) & _percent_accepted(actual, expected)

    if fits_broadcast(tiers):
        matched = settlements.join(F.broadcast(bands), "TIPO").where(accepted)
    else:
        ranges = ranges_by_days(settlements, bands).where(_percent_accepted(actual, expected))
        matched = ranges.withColumn("__tier", F.explode("__tiers")).withColumn("ID_DESCONTO", F.col("__tier.ID_DESCONTO"))
    if best_tier:
        return matched.groupBy(*settlements.columns).agg(F.min("ID_DESCONTO").alias("ID_DESCONTO"))
    return matched.select(*settlements.columns, "ID_DESCONTO")


def _percent_accepted(actual: str, expected: str) -> Column:
    low, high = F.col("MINIMO"), F.col("MAXIMO")
    marked = F.col("PORCENTAGEM") == -1
    return F.when(marked, F.lit(-1).between(low, high)).otherwise(within_percent(F.col(actual), F.col(expected), low, high))


def tiers_by_days(settlements: DataFrame, bands: DataFrame) -> DataFrame:
    """Settlements with every tier of their side whose range of days holds theirs, for tiers too many to send everywhere.

    The days that occur, far fewer than settlements, find their tiers through the dyadic index;
    settlements then meet the tiers of their day and no others. A day that very many
    settlements share is spread over tasks.
    """
    days = settlements.select("TIPO", "DIAS_DIFERENCA").distinct()
    found = _tiers_of_days(days, bands)
    return spread_join(settlements, found.drop("MINIMO_DIAS", "MAXIMO_DIAS"), ["TIPO", "DIAS_DIFERENCA"])


def ranges_by_days(settlements: DataFrame, bands: DataFrame, *, together: int = TIERS_TOGETHER) -> DataFrame:
    """:func:`tiers_by_days` with one row for the tiers of a day that accept the same percent, in ``__tiers``.

    A settlement is compared with each range of percent of its day once, however many tiers
    share it, so that comparisons grow with the ranges and only accepted tiers are spelled out.
    ``together`` bounds the tiers of a row on average, also where all tiers are alike.

    Where the days are few they are sent to the tiers, which are not shuffled then; where the tiers
    of these days are few too they are sent to the settlements, which are not shuffled either.
    """
    days = settlements.select("TIPO", "DIAS_DIFERENCA").distinct()
    few = _few_tiers(days, bands)
    found = _tiers_of_days(days, bands, few=few or fits_broadcast(days))
    part = F.pmod(F.xxhash64("ID_DESCONTO"), F.lit(-(-bands.count() // together) or 1)).alias("__part")
    tiers = F.collect_list(F.struct("ID_DESCONTO")).alias("__tiers")
    ranges = found.groupBy("TIPO", "DIAS_DIFERENCA", "MINIMO", "MAXIMO", part).agg(tiers).drop("__part")
    if few:
        # settlements with the same tiers in a row: their ids take a fraction of the room in a file. The condition holds
        # always; without it the sort would be dropped, as a join need not keep an order.
        like = settlements.sortWithinPartitions("TIPO", "DIAS_DIFERENCA", "PORCENTAGEM").where(F.spark_partition_id() >= 0)
        return like.join(F.broadcast(ranges), ["TIPO", "DIAS_DIFERENCA"])
    # a settlement may have very many tiers, so a task gets few settlements
    return spread_join(settlements, ranges, ["TIPO", "DIAS_DIFERENCA"], slice_rows=SETTLEMENT_ROWS)


def _tiers_of_days(days: DataFrame, bands: DataFrame, *, few: bool = False) -> DataFrame:
    return ranges_of_points(days, bands, ["TIPO"], point="DIAS_DIFERENCA", low="MINIMO_DIAS", high="MAXIMO_DIAS", few=few)


def _few_tiers(days: DataFrame, bands: DataFrame) -> bool:
    """Whether there are at most ``BROADCAST_ROWS`` days, with at most ``DAY_TIERS`` tiers.

    One job tells both, so that settlements are read once for it: a day more than allowed
    counts as more tiers than allowed. Only the answer is made of some days, no frame is.
    """
    some = days.limit(BROADCAST_ROWS + 1)
    tiers = _tiers_of_days(some, bands, few=True).select("ID_DESCONTO")
    more = some.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BROADCAST_ROWS).select(F.explode(F.sequence(F.lit(0), F.lit(DAY_TIERS))))
    return fits_broadcast(tiers.union(more.select(F.lit(None).cast(bands.schema["ID_DESCONTO"].dataType))), DAY_TIERS)


def unmatched_default(
    settlements: DataFrame, matched: DataFrame, *, schedule_id: str = "ID_PROG_RECEBIMENTO", tier: int = DIVERGENT_TIER
) -> DataFrame:
    """Settlements of instalments that no tier accepted, under the divergent tier and with the reason."""
    rest = spread_join(settlements, matched, [schedule_id], "left_anti")
    return rest.withColumns({"ID_DESCONTO": F.lit(tier), "MOTIVO": F.lit(DIVERGENT_REASON)})


def mark_settled(schedule: DataFrame, settled: DataFrame, *, schedule_id: str, status: str) -> DataFrame:
    """The next version of the schedule, with status 1 on every instalment in ``settled``.

    The schedule id is unique in the schedule and is made unique in ``settled``.
    """
    hits = settled.select(schedule_id).distinct().withColumn("__hit", F.lit(True))
    joined = schedule.join(hits, schedule_id, "left")
    value = F.when(F.col("__hit"), F.lit(1)).otherwise(F.col(status))
    return joined.select(*[value.cast(schedule.schema[c].dataType).alias(c) if c == status else F.col(c) for c in schedule.columns])

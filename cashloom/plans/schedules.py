"""Instalment schedules of purchase and sales invoices."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType

from ..operators.schedule import attach_terms, generate_instalments, new_instalments, numbered_instalments, reserve_ids, unscheduled_numbers
from ..operators.schema import conform_schema
from ..sources.schemas import MONEY, required
from ..sources.staging import shared_copy


def _schedule(invoices: DataFrame, terms: DataFrame, existing: DataFrame, invoice_id: str, status: str, residue_on_last: bool) -> DataFrame:
    needed = invoices.select(invoice_id, "ID_CONDICAO", "DATA_EMISSAO", "VALOR_TOTAL")
    generated = generate_instalments(
        attach_terms(needed, terms), invoice_id=invoice_id, status=status, residue_on_last=residue_on_last
    )
    fields = {
        invoice_id: invoices.schema[invoice_id].dataType,
        "DATA_VENCIMENTO": DateType(),
        "NUM_PARCELAS": IntegerType(),
        "VALOR_PARCELA": MONEY,
        status: IntegerType(),
    }
    key = [invoice_id, "DATA_VENCIMENTO"]
    # placed by the key of the anti join, equal rows already meet: one shuffle serves both steps
    distinct = conform_schema(generated, required(**fields)).repartition(*key).distinct()
    return new_instalments(distinct, existing, key)


def _numbered(
    invoices: DataFrame, terms: DataFrame, existing: DataFrame, invoice_id: str, status: str, id_column: str, residue_on_last: bool, stage: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    needed = [invoice_id, "ID_CONDICAO", "DATA_EMISSAO", "VALOR_TOTAL"]
    lacking = unscheduled_numbers(attach_terms(invoices.select(*needed).distinct(), terms), existing, invoice_id=invoice_id)
    reserved = reserve_ids(
        stage(lacking), invoice_id, F.size("__numbers"), "__first", start_after=existing, id_column=id_column, ties=needed[1:]
    )
    fields = {
        id_column: LongType(),
        invoice_id: invoices.schema[invoice_id].dataType,
        "DATA_VENCIMENTO": DateType(),
        "NUM_PARCELAS": IntegerType(),
        "VALOR_PARCELA": MONEY,
        status: IntegerType(),
    }
    made = numbered_instalments(reserved, invoice_id=invoice_id, status=status, id_column=id_column, residue_on_last=residue_on_last)
    return conform_schema(made, required(**fields))


def numbered_payables(
    invoices: DataFrame, terms: DataFrame, existing: DataFrame, *, residue_on_last: bool = False, stage: Callable[[DataFrame], DataFrame] = shared_copy
) -> DataFrame:
    """New instalments of purchase invoices with ID_PROG_PAGAMENTO, dense after the ids of ``existing``.

    Same rows as :func:`payables_schedule`; ids follow the invoices' ids and the instalments'
    numbers. A rerun adds nothing.
    """
    return _numbered(invoices, terms, existing, "ID_NF_ENTRADA", "STATUS_PAGAMENTO", "ID_PROG_PAGAMENTO", residue_on_last, stage)


def numbered_receivables(
    invoices: DataFrame, terms: DataFrame, existing: DataFrame, *, residue_on_last: bool = False, stage: Callable[[DataFrame], DataFrame] = shared_copy
) -> DataFrame:
    """New instalments of sales invoices with ID_PROG_RECEBIMENTO; see :func:`numbered_payables`."""
    return _numbered(invoices, terms, existing, "ID_NF_SAIDA", "STATUS_RECEBIMENTO", "ID_PROG_RECEBIMENTO", residue_on_last, stage)


def payables_schedule(invoices: DataFrame, terms: DataFrame, existing: DataFrame, *, residue_on_last: bool = False) -> DataFrame:
    """New instalments of purchase invoices, to be appended to the payment schedule."""
    return _schedule(invoices, terms, existing, "ID_NF_ENTRADA", "STATUS_PAGAMENTO", residue_on_last)


def receivables_schedule(invoices: DataFrame, terms: DataFrame, existing: DataFrame, *, residue_on_last: bool = False) -> DataFrame:
    """New instalments of sales invoices; instalments scheduled before are left out, so a rerun adds nothing."""
    return _schedule(invoices, terms, existing, "ID_NF_SAIDA", "STATUS_RECEBIMENTO", residue_on_last)

"""Layouts, rule lists and small reference tables of the receivables / payables domain."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sources.schemas import TERM_SCHEMA, TIER_SCHEMA, with_id


@dataclass(frozen=True)
class Layout:
    """Column names of one side of the books."""

    name: str
    tax_id: str
    email: str
    phone: str
    party_id: str
    invoice_id: str
    log_columns: tuple[str, ...]
    default_email: bool

    @property
    def party_attributes(self) -> tuple[str, str, str]:
        return self.name, self.email, self.phone

    @property
    def feed_columns(self) -> tuple[str, ...]:
        return (self.name, self.tax_id, self.email, self.phone, *INVOICE_COLUMNS, *DELIVERY_COLUMNS)


# fixed values: feed columns after the four party columns, in file order
INVOICE_COLUMNS = ("NUMERO_NF", "DATA_EMISSAO", "VALOR_NET", "VALOR_TRIBUTO", "VALOR_TOTAL", "NOME_ITEM", "QTD_ITEM")
DELIVERY_COLUMNS = ("CONDICAO_PAGAMENTO", "CEP", "NUM_ENDERECO", "COMPLEMENTO", "TIPO_ENDERECO", "DATA_PROCESSAMENTO")

PURCHASES = Layout(
    name="NOME_FORNECEDOR",
    tax_id="CNPJ_FORNECEDOR",
    email="EMAIL_FORNECEDOR",
    phone="TELEFONE_FORNECEDOR",
    party_id="ID_FORNECEDOR",
    invoice_id="ID_NF_ENTRADA",
    log_columns=("DATA_PROCESSAMENTO", "DATA_EMISSAO", "NUMERO_NF", "CNPJ_FORNECEDOR"),
    default_email=True,
)

SALES = Layout(
    name="NOME",
    tax_id="CNPJ",
    email="EMAIL",
    phone="TELEFONE",
    party_id="ID_CLIENTE",
    invoice_id="ID_NF_SAIDA",
    log_columns=("DATA_PROCESSAMENTO", "NUMERO_NF", "DATA_EMISSAO"),
    default_email=False,
)

# fixed values: types of the feed columns that are trimmed and cast
FEED_CASTS = {
    "NUMERO_NF": "int",
    "DATA_PROCESSAMENTO": "date",
    "DATA_EMISSAO": "date",
    "VALOR_NET": "decimal(16,2)",
    "VALOR_TRIBUTO": "decimal(16,2)",
    "VALOR_TOTAL": "decimal(16,2)",
    "QTD_ITEM": "int",
    "NUM_ENDERECO": "int",
}

DEFAULT_TEXT = "N/A"
DEFAULT_NUMBER = 0


def feed_rules(layout: Layout, *, tax_id_ok: str, postal_ok: str) -> list[tuple[Column, str]]:
    """Rejection rules in order of precedence; the flags name boolean columns."""

    def missing(column: str) -> Column:
        return F.col(column).isNull()

    # fixed values: reason codes and their order
    return [
        (missing(layout.name), "NOME_NULO"),
        (~F.col(tax_id_ok), "CNPJ_INVALIDO"),
        (missing("NUMERO_NF"), "NUMERO_NF_NULO"),
        (missing("DATA_EMISSAO"), "DATA_EMISSAO_NULO"),
        (missing("VALOR_NET"), "VALOR_NET_NULO"),
        (missing("VALOR_TRIBUTO"), "VALOR_NET_NULO"),
        (missing("VALOR_TOTAL"), "VALOR_TOTAL"),
        (missing("NOME_ITEM"), "NOME_ITEM_NULO"),
        (missing("CONDICAO_PAGAMENTO"), "CONDICAO_PAGAMENTO_NULO"),
        (~F.col(postal_ok), "CEP_INVALIDO"),
        (missing("TIPO_ENDERECO"), "TIPO_ENDERECO_NULO"),
    ]


def earlier_feed_rules(layout: Layout) -> list[tuple[Column, str]]:
    """The older rule list: only missing values, contact data included."""
    # fixed values: columns and reason codes in order
    codes = [
        (layout.name, "NOME_NULO"),
        ("NUMERO_NF", "NUMERO_NF_NULO"),
        (layout.email, "EMAIL NULO"),
        (layout.phone, "TELEFONE NULO"),
        ("DATA_EMISSAO", "DATA_EMISSAO_NULO"),
        ("VALOR_NET", "VALOR_NET_NULO"),
        ("VALOR_TRIBUTO", "VALOR_NET_NULO"),
        ("VALOR_TOTAL", "VALOR_TOTAL NULO"),
        ("NOME_ITEM", "NOME_ITEM_NULO"),
        ("CONDICAO_PAGAMENTO", "CONDICAO_PAGAMENTO_NULO"),
        ("TIPO_ENDERECO", "TIPO_ENDERECO_NULO"),
    ]
    return [(F.col(column).isNull(), code) for column, code in codes]


# fixed values: payment terms (description, instalments, down payment); the id is the position
TERMS = [
    ("A vista", 1, 1),
    ("30 dias", 1, 0),
    ("30/60 dias", 2, 0),
    ("30/60/90 dias", 3, 0),
    ("Entrada/30 dias", 2, 1),
    ("Entrada/30/60 dias", 3, 1),
    ("Entrada/30/60/90 dias", 4, 1),
]

# fixed values, but for the descriptions, which are our own: tolerance tiers (description, days from, to, percent from, to, early, approved); the id is the position
TIERS = [
    ("on the day", 0, 0, "0.00", "0.00", 0, 1),
    ("early by more than ten days", 11, 11, "3.01", "5.00", 1, 1),
    ("early by up to ten days", 6, 10, "2.00", "3.00", 1, 1),
    ("early by up to five days", 1, 5, "1.00", "1.90", 1, 1),
    ("late by up to five days", 1, 5, "0.50", "1.50", 0, 1),
    ("late by up to ten days", 6, 10, "1.60", "2.00", 0, 1),
    ("late by more than ten days", 11, 11, "2.00", "2.00", 0, 1),
    ("late with interest", 5, 10, "2.00", "5.00", 0, 0),
    ("no tier", -1, -1, "-1.00", "-1.00", 0, 1),
]


def term_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *t) for i, t in enumerate(TERMS, start=1)], with_id("ID_CONDICAO", TERM_SCHEMA))


def tier_table(spark: SparkSession) -> DataFrame:
    rows = [
        (i, name, low_days, high_days, Decimal(low), Decimal(high), "-", date(2023, 1, 1), early, approved)
        for i, (name, low_days, high_days, low, high, early, approved) in enumerate(TIERS, start=1)
    ]
    return spark.createDataFrame(rows, with_id("ID_DESCONTO", TIER_SCHEMA))

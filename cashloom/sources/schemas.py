"""Schemas of the input files."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(16, 2)
PERCENT = DecimalType(5, 2)


def required(**fields) -> StructType:
    return StructType([StructField(name, kind, False) for name, kind in fields.items()])


def optional(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


def with_id(name: str, schema: StructType) -> StructType:
    return StructType([StructField(name, IntegerType(), False), *schema.fields])


# fixed values: columns and types of the tables and files below
ADDRESS_TYPE_SCHEMA = required(DESCRICAO=StringType(), SIGLA=StringType())

TIER_SCHEMA = required(
    DESCRICAO=StringType(),
    MINIMO_DIAS=IntegerType(),
    MAXIMO_DIAS=IntegerType(),
    MINIMO=PERCENT,
    MAXIMO=PERCENT,
    APROVADOR=StringType(),
    DATA_APROVACAO=DateType(),
    TIPO_DESCONTO=ShortType(),
    STATUS_APROVACAO=ShortType(),
)

TERM_SCHEMA = required(DESCRICAO=StringType(), QTD_PARCELAS=IntegerType(), ENTRADA=ShortType())

POSTAL_CODE_SCHEMA = required(
    CEP=StringType(), UF=StringType(), CIDADE=StringType(), BAIRRO=StringType(), LOGRADOURO=StringType()
)

SALES_FEED_SCHEMA = optional(
    NOME=StringType(),
    CNPJ=StringType(),
    EMAIL=StringType(),
    TELEFONE=StringType(),
    NUMERO_NF=StringType(),
    DATA_EMISSAO=DateType(),
    VALOR_NET=MONEY,
    VALOR_TRIBUTO=MONEY,
    VALOR_TOTAL=MONEY,
    NOME_ITEM=StringType(),
    QTD_ITEM=IntegerType(),
    CONDICAO_PAGAMENTO=StringType(),
    CEP=StringType(),
    NUM_ENDERECO=IntegerType(),
    COMPLEMENTO=StringType(),
    TIPO_ENDERECO=StringType(),
    DATA_PROCESSAMENTO=TimestampType(),
)

RECEIPT_SCHEMA = optional(
    NUMERO_NF=IntegerType(), DATA_VENCIMENTO=DateType(), DATA_RECEBIMENTO=DateType(), VALOR_RECEBIDO=MONEY
)

# fixed values: types of the payment file's columns, which are trimmed and cast
PAYMENT_CASTS = {
    "ID_NF_ENTRADA": "int",
    "DATA_VENCIMENTO": "date",
    "DATA_PGT_EFETUADO": "date",
    "VALOR_PGT_EFETUADO": "decimal(10,2)",
}

INVOICE_FIELDS = dict(
    NUMERO_NF=IntegerType(),
    DATA_EMISSAO=DateType(),
    VALOR_NET=MONEY,
    VALOR_TRIBUTO=MONEY,
    VALOR_TOTAL=MONEY,
    NOME_ITEM=StringType(),
    QTD_ITEM=IntegerType(),
)

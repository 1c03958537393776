from collections import Counter

import pytest
from pyspark.sql import functions as F

from cashloom.operators import quality
from cashloom.operators.schema import conform_schema
from cashloom.presets import PURCHASES, feed_rules
from cashloom.sources.schemas import MONEY, optional, required
from pyspark.sql.types import DateType, IntegerType, StringType


def test_first_rule_wins(spark):
    columns = ["NOME_FORNECEDOR", "NUMERO_NF", "DATA_EMISSAO", "VALOR_NET", "VALOR_TRIBUTO", "VALOR_TOTAL", "NOME_ITEM", "CONDICAO_PAGAMENTO", "TIPO_ENDERECO"]
    full = dict.fromkeys(columns, "x")
    cases = [
        ({}, True, True, "OK"),
        (dict.fromkeys(columns), False, False, "NOME_NULO"),
        ({"NUMERO_NF": None}, False, True, "CNPJ_INVALIDO"),
        ({"NUMERO_NF": None, "DATA_EMISSAO": None}, True, True, "NUMERO_NF_NULO"),
        ({"DATA_EMISSAO": None, "VALOR_NET": None}, True, True, "DATA_EMISSAO_NULO"),
        ({"VALOR_NET": None}, True, True, "VALOR_NET_NULO"),
        ({"VALOR_TRIBUTO": None, "VALOR_TOTAL": None}, True, True, "VALOR_NET_NULO"),
        ({"VALOR_TOTAL": None}, True, True, "VALOR_TOTAL"),
        ({"NOME_ITEM": None, "CONDICAO_PAGAMENTO": None}, True, True, "NOME_ITEM_NULO"),
        ({"CONDICAO_PAGAMENTO": None}, True, False, "CONDICAO_PAGAMENTO_NULO"),
        ({"TIPO_ENDERECO": None}, True, False, "CEP_INVALIDO"),
        ({"TIPO_ENDERECO": None}, True, True, "TIPO_ENDERECO_NULO"),
    ]
    data = [(*{**full, **change}.values(), tax, postal, want) for change, tax, postal, want in cases]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns) + ", tax boolean, postal boolean, want string")
    reason = quality.first_failing_rule(feed_rules(PURCHASES, tax_id_ok="tax", postal_ok="postal"))
    assert df.where(~reason.eqNullSafe(F.col("want"))).count() == 0
    assert spark.range(1).select(quality.first_failing_rule([])).first()[0] == "OK"


def test_split_is_complete(spark, rows):
    df = spark.createDataFrame([(1, "OK", True), (2, "BAD", False), (3, "OK", True)], "i int, MOTIVO string, flag boolean")
    parts = quality.split_valid_rejected(df, reason="MOTIVO", flags=["flag"])
    assert rows(parts.accepted) == [(1,), (3,)]
    assert rows(parts.rejected) == [(2, "BAD")]


@pytest.mark.parametrize("small", [True, False])
def test_membership_is_exact_text(spark, rows, monkeypatch, small):
    monkeypatch.setattr(quality, "fits_broadcast", lambda df, rows=0: small)
    df = spark.createDataFrame([("1001000", 1), ("01001000", 2), (None, 3), ("1001000", 4)], "CEP string, i int")
    domain = spark.createDataFrame([("1001000",), ("1001000",), (None,)], "code string")
    found = quality.domain_membership(df, domain, "CEP", "ok")
    assert found.columns == ["CEP", "i", "ok"]
    assert rows(found, "i", "ok") == [(1, True), (2, False), (3, False), (4, True)]


def test_clean_with_rejects_accounts_for_every_row(spark):
    data = [("a ", "1"), ("a", "1"), ("a", " 1"), ("b", None), ("b", None), ("c", "2")] * 3
    df = spark.createDataFrame(data, "x string, y string").repartition(5)
    parts = quality.clean_with_rejects(df)
    assert Counter(map(tuple, parts.accepted.collect())) == Counter([("a", "1"), ("c", "2")])
    rejected = Counter(map(tuple, parts.rejected.collect()))
    assert rejected == Counter({("b", None, "Dado Nulo"): 6, ("a", "1", "Dado Repetido"): 8, ("c", "2", "Dado Repetido"): 2})
    assert parts.accepted.count() + parts.rejected.count() == df.count()


def test_fill_defaults_and_drop_nulls(spark, rows):
    df = spark.createDataFrame([(None, None), ("x", 3), ("y", None)], "t string, n int")
    assert rows(quality.fill_defaults(df, {"t": "N/A", "n": 0})) == [("N/A", 0), ("x", 3), ("y", 0)]
    assert rows(quality.drop_null_rows(df)) == [("x", 3)]
    assert rows(quality.drop_null_rows(df, ["t"])) == [("x", 3), ("y", None)]


def test_conform_schema_binds_by_position(spark):
    df = spark.createDataFrame([("7", "2023-01-05", "12.345")], "a string, b string, c string")
    target = required(ID=IntegerType(), DIA=DateType(), VALOR=MONEY)
    row = conform_schema(df, target).first().asDict()
    assert {k: str(v) for k, v in row.items()} == {"ID": "7", "DIA": "2023-01-05", "VALOR": "12.35"}


def test_conform_schema_refuses_null_where_required(spark):
    df = spark.createDataFrame([("x", None)], "a string, b int")
    assert conform_schema(df, optional(A=StringType(), B=IntegerType())).first().B is None
    with pytest.raises(Exception, match="NULL in required column B"):
        conform_schema(df, required(A=StringType(), B=IntegerType())).collect()
    with pytest.raises(ValueError, match="schema of 1"):
        conform_schema(df, required(A=StringType()))

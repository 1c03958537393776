"""The queries: each is a function of the frames, next to the SQL with the same answer."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType

from cashloom import presets
from cashloom.functions import closed_before, complete_tax_id, in_month_of, is_valid_tax_id, normalize_term, since
from cashloom.functions.sql import register_functions
from cashloom.operators import cashflow as cash
from cashloom.operators import dimensions as dims
from cashloom.operators import parameters as params
from cashloom.operators import quality, schedule, settlement
from cashloom.operators.schema import conform_schema
from cashloom.plans import cash as cash_jobs
from cashloom.plans import cycle, ingest, posting, schedules
from cashloom.plans.seed import seed_reference_data
from cashloom.sources.feeds import scan_csv
from cashloom.sources.schemas import MONEY, optional, required
from cashloom.sources.staging import shared_copy, shared_folder
from cashloom.sources.tables import BucketedLog, KeyedTable

from . import sql
from .frames import FIRST_RUN, RAW_TERMS, STAMP, TODAY, Frames, dotted, money, raw_term, tax_id

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, answer: str) -> Callable:
    """Register a function of the frames as a query, with its SQL."""

    def register(build: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Frames(spark, folder))
        ORACLES[name] = sql.oracle(answer)
        return build

    return register


def cents(column: str):
    return (F.col(column) * 100).cast("long").alias(column)


def in_cents(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: (F.col(c) * 100).cast("long") for c in columns})


AMOUNTS = ("VALOR_NET", "VALOR_TRIBUTO", "VALOR_TOTAL")
FEED_LIST = (
    "NUMERO_NF, DATA_EMISSAO, VALOR_NET, VALOR_TRIBUTO, VALOR_TOTAL, NOME_ITEM, QTD_ITEM, CONDICAO_PAGAMENTO, CEP, "
)

# -- projections, filters, validation -----------------------------------------------------


@query(
    "p1_trim_cast",
    "SELECT NUMERO_NF, DATA_EMISSAO, VALOR_NET, VALOR_TRIBUTO, VALOR_TOTAL, QTD_ITEM, NUM_ENDERECO, DATA_PROCESSAMENTO FROM purchases_typed",
)
def p1(f: Frames) -> DataFrame:
    raw = f.purchase_feed().select(*presets.FEED_CASTS)
    return in_cents(quality.trim_cast_columns(raw, presets.FEED_CASTS), *AMOUNTS)


@query(
    "p4_fill_defaults",
    """SELECT NUMERO_NF, coalesce(EMAIL_FORNECEDOR, 'N/A') AS EMAIL_FORNECEDOR, coalesce(NUM_ENDERECO, 0) AS NUM_ENDERECO,
              coalesce(COMPLEMENTO, 'N/A') AS COMPLEMENTO FROM purchases_typed""",
)
def p4(f: Frames) -> DataFrame:
    defaults = {"EMAIL_FORNECEDOR": presets.DEFAULT_TEXT, "NUM_ENDERECO": presets.DEFAULT_NUMBER, "COMPLEMENTO": presets.DEFAULT_TEXT}
    return quality.fill_defaults(f.purchases_typed().select("NUMERO_NF", *defaults), defaults)


def judged_feed(f: Frames) -> DataFrame:
    # the tax id is judged below the join, once per row, and not inside the rules above it
    flagged = f.purchases_typed().withColumn("CNPJ_VALIDO", is_valid_tax_id("CNPJ_FORNECEDOR"))
    flagged = quality.domain_membership(flagged, f.postal_codes(), "CEP", "CEP_VALIDO")
    rules = presets.feed_rules(presets.PURCHASES, tax_id_ok="CNPJ_VALIDO", postal_ok="CEP_VALIDO")
    return flagged.withColumn("MOTIVO", quality.first_failing_rule(rules))


JUDGED = f"""
    SELECT *, {sql.reason("NOME_FORNECEDOR", "tax_ok", "postal_ok")} AS MOTIVO FROM (
      SELECT *, {sql.valid_tax_id("CNPJ_FORNECEDOR")} AS tax_ok, CEP IN (SELECT CEP FROM postal_codes) AS postal_ok FROM purchases_typed)"""


@query("p5_first_failing_rule", f"SELECT NUMERO_NF, DATA_PROCESSAMENTO, CNPJ_FORNECEDOR, MOTIVO FROM ({JUDGED})")
def p5(f: Frames) -> DataFrame:
    return judged_feed(f).select("NUMERO_NF", "DATA_PROCESSAMENTO", "CNPJ_FORNECEDOR", "MOTIVO")


# fixed values: reason codes of the older list, in order
@query(
    "p5_first_failing_rule_earlier_list",
    """SELECT NUMERO_NF, DATA_PROCESSAMENTO, CNPJ_FORNECEDOR,
         CASE WHEN NOME_FORNECEDOR IS NULL THEN 'NOME_NULO' WHEN NUMERO_NF IS NULL THEN 'NUMERO_NF_NULO'
              WHEN EMAIL_FORNECEDOR IS NULL THEN 'EMAIL NULO' WHEN TELEFONE_FORNECEDOR IS NULL THEN 'TELEFONE NULO'
              WHEN DATA_EMISSAO IS NULL THEN 'DATA_EMISSAO_NULO' WHEN VALOR_NET IS NULL THEN 'VALOR_NET_NULO'
              WHEN VALOR_TRIBUTO IS NULL THEN 'VALOR_NET_NULO' WHEN VALOR_TOTAL IS NULL THEN 'VALOR_TOTAL NULO'
              WHEN NOME_ITEM IS NULL THEN 'NOME_ITEM_NULO' WHEN CONDICAO_PAGAMENTO IS NULL THEN 'CONDICAO_PAGAMENTO_NULO'
              WHEN TIPO_ENDERECO IS NULL THEN 'TIPO_ENDERECO_NULO' ELSE 'OK' END AS MOTIVO
       FROM purchases_typed""",
)
def p5_earlier(f: Frames) -> DataFrame:
    reason = quality.first_failing_rule(presets.earlier_feed_rules(presets.PURCHASES))
    return f.purchases_typed().select("NUMERO_NF", "DATA_PROCESSAMENTO", "CNPJ_FORNECEDOR", reason.alias("MOTIVO"))


@query(
    "p6_split_valid_rejected",
    f"""SELECT NUMERO_NF, DATA_PROCESSAMENTO, CNPJ_FORNECEDOR, MOTIVO, CASE WHEN MOTIVO = 'OK' THEN 'accepted' ELSE 'rejected' END AS side
        FROM ({JUDGED})""",
)
def p6(f: Frames) -> DataFrame:
    parts = quality.split_valid_rejected(judged_feed(f), reason="MOTIVO", flags=("CNPJ_VALIDO", "CEP_VALIDO"))
    key = ("NUMERO_NF", "DATA_PROCESSAMENTO", "CNPJ_FORNECEDOR")
    accepted = parts.accepted.select(*key, F.lit("OK").alias("MOTIVO"), F.lit("accepted").alias("side"))
    return accepted.unionByName(parts.rejected.select(*key, "MOTIVO", F.lit("rejected").alias("side")))


TAX_TEXT = f"""
    SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN x.good WHEN 1 THEN x.off WHEN 2 THEN substr(x.good, 2)
             WHEN 3 THEN {sql.dotted("x.good")} WHEN 4 THEN 'A' || substr(x.good, 2) WHEN 5 THEN x.good || chr(10) END AS tax_text
    FROM orders JOIN customer_tax x ON x.k = o_custkey"""


@query("p7_tax_id_valid", f"SELECT o_orderkey, tax_text, {sql.valid_tax_id('tax_text')} AS valid FROM ({TAX_TEXT})")
def p7(f: Frames) -> DataFrame:
    key = F.col("o_orderkey") % 7
    good, off = F.col("good"), F.col("off")
    text = (
        F.when(key == 0, good)
        .when(key == 1, off)
        .when(key == 2, F.substring(good, 2, 13))
        .when(key == 3, dotted(good))
        .when(key == 4, F.concat(F.lit("A"), F.substring(good, 2, 13)))
        .when(key == 5, F.concat(good, F.lit("\n")))
    )
    ids = f.table("orders").select(
        "o_orderkey", tax_id(F.col("o_custkey")).alias("good"), tax_id(F.col("o_custkey"), wrong=F.lit(True)).alias("off")
    )
    texts = ids.select("o_orderkey", text.alias("tax_text"))
    return texts.withColumn("valid", is_valid_tax_id("tax_text"))


@query("p8_tax_id_complete", "SELECT c_custkey, good AS tax_id FROM customer JOIN known_customer_tax ON k = c_custkey")
def p8(f: Frames) -> DataFrame:
    base = F.concat(F.lpad(F.col("c_custkey").cast("string"), 8, "0"), F.lit("0001"))
    return f.table("customer").select("c_custkey", complete_tax_id(base).alias("tax_id"))


@query(
    "p9_domain_membership",
    "SELECT NUMERO_NF, DATA_PROCESSAMENTO, CEP, CEP IN (SELECT CEP FROM postal_codes) AS CEP_VALIDO FROM purchases_typed",
)
def p9(f: Frames) -> DataFrame:
    rows = f.purchases_typed().select("NUMERO_NF", "DATA_PROCESSAMENTO", "CEP")
    return quality.domain_membership(rows, f.postal_codes(), "CEP", "CEP_VALIDO")


@query(
    "p10_normalize_term",
    f"SELECT NUMERO_NF, CONDICAO_PAGAMENTO, {sql.normalized('CONDICAO_PAGAMENTO')} AS canonical FROM purchases_typed",
)
def p10(f: Frames) -> DataFrame:
    return f.purchases_typed().select("NUMERO_NF", "CONDICAO_PAGAMENTO", normalize_term("CONDICAO_PAGAMENTO").alias("canonical"))


@query(
    "p12_drop_null_rows",
    """SELECT NUMERO_NF, DATA_EMISSAO, VALOR_NET, CONDICAO_PAGAMENTO FROM purchases_typed
       WHERE NUMERO_NF IS NOT NULL AND DATA_EMISSAO IS NOT NULL AND VALOR_NET IS NOT NULL AND CONDICAO_PAGAMENTO IS NOT NULL""",
)
def p12(f: Frames) -> DataFrame:
    rows = f.purchases_typed().select("NUMERO_NF", "DATA_EMISSAO", "VALOR_NET", "CONDICAO_PAGAMENTO")
    return in_cents(quality.drop_null_rows(rows), "VALOR_NET")


@query(
    "p13_clean_with_rejects",
    """SELECT order_text, line_text, flag_text, CASE WHEN flag_text IS NULL THEN 'Dado Nulo' WHEN n = 1 THEN 'OK' ELSE 'Dado Repetido' END AS MOTIVO
       FROM (SELECT *, row_number() OVER (PARTITION BY order_text, line_text, flag_text) AS n
             FROM (SELECT CAST(l_orderkey AS VARCHAR) AS order_text, CAST(l_linenumber AS VARCHAR) AS line_text,
                          CASE WHEN l_orderkey % 13 <> 0 THEN l_returnflag END AS flag_text FROM lineitem))""",
)
def p13(f: Frames) -> DataFrame:
    rows = f.table("lineitem").select(
        F.concat(F.lit(" "), F.col("l_orderkey").cast("string")).alias("order_text"),
        F.col("l_linenumber").cast("string").alias("line_text"),
        F.when(F.col("l_orderkey") % 13 != 0, F.col("l_returnflag")).alias("flag_text"),
    )
    parts = quality.clean_with_rejects(rows)
    return parts.accepted.withColumn("MOTIVO", F.lit("OK")).unionByName(parts.rejected)


@query("p14_parse_parameters", "SELECT * FROM parsed")
def p14(f: Frames) -> DataFrame:
    return params.parse_parameters(f.parameters())


@query(
    "p15_encode_parameters",
    """SELECT ROW_ID, COD, CASE WHEN COD <> 1 THEN DESCRICAO ELSE coalesce(VAR_DESCRICAO, '') || ',' || coalesce(CAST(VAR_DT_INICIAL AS VARCHAR), '') || ',' ||
              coalesce(CAST(VAR_DT_FINAL AS VARCHAR), '') || ',' || coalesce(CAST(VAR_DT_ATUAL AS VARCHAR), '') || ',' ||
              coalesce(CAST(VAR_EXPURGO AS VARCHAR), '') || ',1' END AS DESCRICAO FROM parsed""",
)
def p15(f: Frames) -> DataFrame:
    parsed = params.parse_parameters(f.parameters())
    return params.encode_parameters(parsed, code=1, status=1).select("ROW_ID", "COD", "DESCRICAO")


ORDER_DAYS = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE "


def order_days(f: Frames, condition) -> DataFrame:
    kept = f.table("orders").where(condition).select("o_orderkey", "o_orderdate")
    return kept.withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("p17_closed_period_filter", ORDER_DAYS + "o_orderdate < DATE '2000-06-01'")
def p17(f: Frames) -> DataFrame:
    return order_days(f, closed_before("o_orderdate", TODAY))


@query("p17_closed_period_filter_month_number", ORDER_DAYS + "month(o_orderdate) < 6 AND year(o_orderdate) <= 2000")
def p17_month_number(f: Frames) -> DataFrame:
    return order_days(f, closed_before("o_orderdate", TODAY, "month_number"))


@query(
    "p18_since_last_close_filter",
    ORDER_DAYS
    + """o_orderdate < DATE '2000-06-01' AND CAST(o_orderdate AS DATE) >
         (SELECT last_day(max(CAST(l_shipdate AS DATE))) FROM lineitem WHERE l_shipdate < DATE '2000-01-01')""",
)
def p18(f: Frames) -> DataFrame:
    closed = f.table("lineitem").where(F.col("l_shipdate") < F.lit(date(2000, 1, 1)))
    closings = closed.agg(F.max("l_shipdate").alias("day")).select("day", F.last_day(F.to_date("day")).alias("closed"))
    first_open = cash.first_open_day(closings, "day", "closed", f.table("orders").schema["o_orderdate"].dataType)
    return order_days(f, closed_before("o_orderdate", TODAY) & since("o_orderdate", first_open.scalar()))


@query("p19_current_month_filter", ORDER_DAYS + "o_orderdate >= DATE '2000-06-01' AND o_orderdate < DATE '2000-07-01'")
def p19(f: Frames) -> DataFrame:
    return order_days(f, in_month_of("o_orderdate", TODAY))


@query(
    "p21_audit_columns",
    "SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS DATA_FECHAMENTO, DATE '2000-06-15' AS DATA_PROCESSADO FROM orders",
)
def p21(f: Frames) -> DataFrame:
    days = f.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return cash.audit_columns(days, "day", processed_at=STAMP).drop("day")


@query(
    "p22_settlement_deviation",
    """SELECT prog, CAST(days AS INTEGER) AS days, CAST(early AS INTEGER) AS early,
              CASE WHEN underpaid THEN -10000 WHEN val = 0 THEN NULL ELSE CAST((abs(r - val) * 1000000) // val AS BIGINT) END AS percent_e4 FROM judged""",
)
def p22(f: Frames) -> DataFrame:
    judged = settlement.settlement_deviation(f.settlements())
    return judged.select(
        F.col("ID_PROG_RECEBIMENTO").alias("prog"),
        F.col("DIAS_DIFERENCA").alias("days"),
        F.col("TIPO").cast("int").alias("early"),
        F.floor(F.col("PORCENTAGEM") * 10000).cast("long").alias("percent_e4"),
    )


# -- joins --------------------------------------------------------------------------------


ORACLE_J1 = """SELECT NUMERO_NF, DATA_PROCESSAMENTO, CNPJ_FORNECEDOR FROM purchases_typed f
       WHERE NOT EXISTS (SELECT 1 FROM purchases_log l WHERE l.NUMERO_NF = f.NUMERO_NF AND l.DATA_PROCESSAMENTO = f.DATA_PROCESSAMENTO)"""


@query("j1_unprocessed_only", ORACLE_J1)
def j1(f: Frames) -> DataFrame:
    rows = f.purchases_typed().select("NUMERO_NF", "DATA_PROCESSAMENTO", "CNPJ_FORNECEDOR")
    return dims.unprocessed_only(rows, f.purchases_log(), ["NUMERO_NF", "DATA_PROCESSAMENTO"])


@query("j1_unprocessed_only_bucketed_log", ORACLE_J1)
def j1_bucketed(f: Frames) -> DataFrame:
    """The same against a stored log in buckets, written by two appends."""
    rows = f.purchases_typed().select("NUMERO_NF", "DATA_PROCESSAMENTO", "CNPJ_FORNECEDOR")
    done, even = f.purchases_log(), F.col("NUMERO_NF") % 2 == 0
    log = BucketedLog(f.spark, f"{shared_folder(f.spark)}/log-{uuid4()}", done.schema, ["NUMERO_NF", "DATA_PROCESSAMENTO"], buckets=16)
    log.append(done.where(even))
    log.append(done.where(~even))
    fresh = log.unprocessed(rows, range_column="DATA_PROCESSAMENTO")
    fresh.schema  # analysed while the session still knows the table
    log.forget()
    return fresh


@query(
    "j1_unprocessed_only_by_party",
    """SELECT NUMERO_NF, DATA_PROCESSAMENTO, CNPJ_FORNECEDOR FROM purchases_typed f
       WHERE NOT EXISTS (SELECT 1 FROM lineitem l JOIN supplier_tax x ON x.k = l.l_suppkey
                         WHERE l.l_orderkey % 3 = 0 AND l.l_orderkey = f.NUMERO_NF AND x.good = f.CNPJ_FORNECEDOR)""",
)
def j1_by_party(f: Frames) -> DataFrame:
    rows = f.purchases_typed().select("NUMERO_NF", "DATA_PROCESSAMENTO", "CNPJ_FORNECEDOR")
    lines = f.table("lineitem").where(F.col("l_orderkey") % 3 == 0)
    log = lines.select(F.col("l_orderkey").cast("int").alias("NUMERO_NF"), tax_id(F.col("l_suppkey")).alias("CNPJ_FORNECEDOR"))
    return dims.unprocessed_only(rows, log, ["NUMERO_NF", "CNPJ_FORNECEDOR"])


def buyers(f: Frames) -> DataFrame:
    """One party per tax id, out of the sales feed."""
    return dims.latest_per_key(
        f.sales_feed(), ["CNPJ"], ("NOME", "EMAIL", "TELEFONE"), ("DATA_PROCESSAMENTO", "NUMERO_NF"), defaults={"EMAIL": "N/A"}
    )


BUYERS = f"""
    SELECT tax, name, email, phone FROM (
      SELECT CNPJ AS tax, upper_name AS name, EMAIL AS email, TELEFONE AS phone,
             row_number() OVER (PARTITION BY CNPJ ORDER BY DATA_PROCESSAMENTO DESC, nf_text DESC,
                 (CASE WHEN upper_name IS NULL THEN 0 ELSE 1 END + CASE WHEN EMAIL IS NULL THEN 0 ELSE 1 END) DESC) AS rn
      FROM (SELECT *, NOME AS upper_name, CASE WHEN o % 31 = 0 THEN 'abc' ELSE lpad(CAST(o AS VARCHAR), 9, '0') END AS nf_text FROM (
        SELECT CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'Customer ' || CAST(o_custkey AS VARCHAR) END AS NOME, o_orderkey AS o,
               {sql.typed_tax_id("o_orderkey")} AS CNPJ,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'c' || CAST(o_custkey AS VARCHAR) || '@mail.test' END AS EMAIL,
               '55-' || CAST(o_custkey AS VARCHAR) AS TELEFONE, CAST(o_orderdate AS DATE) + 1 AS DATA_PROCESSAMENTO
        FROM orders JOIN customer_tax x ON x.k = o_custkey))) WHERE rn = 1"""
PARTY_NAMES = "tax AS CNPJ, name AS NOME, email AS EMAIL, phone AS TELEFONE"


@query("j2_new_members", f"SELECT {PARTY_NAMES} FROM ({BUYERS}) WHERE tax NOT IN (SELECT tax FROM sales_parties)")
def j2(f: Frames) -> DataFrame:
    return dims.new_members(buyers(f), f.customers(), "CNPJ")


J3 = f"""SELECT b.tax AS CNPJ, b.name AS NOME, b.email AS EMAIL, b.phone AS TELEFONE FROM ({BUYERS}) b JOIN sales_parties p ON p.tax = b.tax
        WHERE b.name IS DISTINCT FROM p.name OR b.email IS DISTINCT FROM p.email OR b.phone IS DISTINCT FROM p.phone"""


@query("j3_changed_members", J3)
def j3(f: Frames) -> DataFrame:
    return dims.changed_members(buyers(f), f.customers(), "CNPJ", ("NOME", "EMAIL", "TELEFONE"))


@query("j3_changed_members_by_digest", J3)
def j3_by_digest(f: Frames) -> DataFrame:
    """The same, of stored parties reading their digests only."""
    attributes = ("NOME", "EMAIL", "TELEFONE")
    known = shared_copy(f.customers().withColumn("RESUMO", dims.row_digest(attributes)))
    return dims.changed_by_digest(buyers(f), known, "CNPJ", attributes, digest="RESUMO")


ADDRESS_KEY = ["ID_FORNECEDOR", "CEP"]
ADDRESS_NAMES = "id AS ID_FORNECEDOR, CEP, type_id AS ID_TIPO_ENDERECO, num AS NUMERO, compl AS COMPLEMENTO"


def offered_addresses(f: Frames) -> DataFrame:
    """One address per (supplier, postal code), out of the line items."""
    key = F.col("l_suppkey").alias("ID_FORNECEDOR")
    rows = f.table("lineitem").select(
        key,
        (F.lit(1001000) + (F.col("l_suppkey") + F.col("l_orderkey") % 3) % 25).cast("string").alias("CEP"),
        (F.col("l_linenumber") % 3 + 1).cast("int").alias("ID_TIPO_ENDERECO"),
        (F.col("l_suppkey") % 7).cast("int").alias("NUMERO"),
        F.concat(F.lit("Sala "), (F.col("l_orderkey") % 2).cast("string")).alias("COMPLEMENTO"),
        "l_orderkey",
    )
    return dims.latest_per_key(rows, ADDRESS_KEY, ("ID_TIPO_ENDERECO", "NUMERO", "COMPLEMENTO"), ["l_orderkey"])


OFFERED_ADDRESSES = """
    SELECT id, CEP, type_id, num, compl FROM (
      SELECT *, row_number() OVER (PARTITION BY id, CEP ORDER BY o DESC, type_id DESC, num DESC, compl DESC) AS rn FROM (
        SELECT l_suppkey AS id, CAST(1001000 + (l_suppkey + l_orderkey % 3) % 25 AS VARCHAR) AS CEP, CAST(l_linenumber % 3 + 1 AS INTEGER) AS type_id,
               CAST(l_suppkey % 7 AS INTEGER) AS num, 'Sala ' || CAST(l_orderkey % 2 AS VARCHAR) AS compl, l_orderkey AS o FROM lineitem)) WHERE rn = 1"""


@query(
    "j4_new_addresses",
    f"""SELECT {ADDRESS_NAMES} FROM ({OFFERED_ADDRESSES}) o
        WHERE NOT EXISTS (SELECT 1 FROM purchases_addresses a WHERE a.id = o.id AND a.CEP = o.CEP)""",
)
def j4(f: Frames) -> DataFrame:
    return dims.new_addresses(offered_addresses(f), f.supplier_addresses(), ADDRESS_KEY)


@query(
    "j5_changed_addresses",
    f"""SELECT o.id AS ID_FORNECEDOR, o.CEP, o.type_id AS ID_TIPO_ENDERECO, o.num AS NUMERO, o.compl AS COMPLEMENTO
        FROM ({OFFERED_ADDRESSES}) o JOIN purchases_addresses a ON a.id = o.id AND a.CEP = o.CEP
        WHERE a.type_id <> o.type_id OR a.num <> o.num OR a.compl <> o.compl""",
)
def j5(f: Frames) -> DataFrame:
    return dims.changed_addresses(
        offered_addresses(f), f.supplier_addresses(), ADDRESS_KEY, ("ID_TIPO_ENDERECO", "NUMERO", "COMPLEMENTO")
    )


def type_ids(f: Frames) -> DataFrame:
    return f.address_types().select(F.upper("DESCRICAO").alias("TIPO_ENDERECO"), "ID_TIPO_ENDERECO")


def supplier_ids(f: Frames) -> DataFrame:
    return dims.one_id_per_key(f.suppliers(), "CNPJ_FORNECEDOR", "ID_FORNECEDOR")


@query(
    "j6_resolve_party_address",
    """SELECT p.id AS ID_FORNECEDOR, t.type_id AS ID_TIPO_ENDERECO, f.CEP, f.NUM_ENDERECO, f.COMPLEMENTO
       FROM purchases_typed f LEFT JOIN address_types t ON t.label = f.TIPO_ENDERECO JOIN purchases_parties p ON p.tax = f.CNPJ_FORNECEDOR""",
)
def j6(f: Frames) -> DataFrame:
    rows = f.purchases_typed().select("CNPJ_FORNECEDOR", "TIPO_ENDERECO", "CEP", "NUM_ENDERECO", "COMPLEMENTO")
    resolved = dims.resolve_party_address(
        rows, type_ids(f), supplier_ids(f), type_column="TIPO_ENDERECO", party_key="CNPJ_FORNECEDOR"
    )
    return resolved.select("ID_FORNECEDOR", "ID_TIPO_ENDERECO", "CEP", "NUM_ENDERECO", "COMPLEMENTO")


@query(
    "j7_build_invoice_fact",
    f"""SELECT p.id AS ID_FORNECEDOR, t.ID_CONDICAO, f.NUMERO_NF, f.DATA_EMISSAO, f.VALOR_TOTAL, f.QTD_ITEM
        FROM purchases_typed f LEFT JOIN purchases_parties p ON p.tax = f.CNPJ_FORNECEDOR
        LEFT JOIN terms t ON t.DESCRICAO = {sql.normalized("f.CONDICAO_PAGAMENTO")}""",
)
def j7(f: Frames) -> DataFrame:
    rows = f.purchases_typed().withColumn("CONDICAO_PAGAMENTO", normalize_term("CONDICAO_PAGAMENTO"))
    terms = f.terms().select(F.col("DESCRICAO").alias("CONDICAO_PAGAMENTO"), "ID_CONDICAO")
    fact = dims.build_invoice_fact(
        rows, supplier_ids(f), terms, party_key="CNPJ_FORNECEDOR", term_column="CONDICAO_PAGAMENTO"
    )
    return fact.select("ID_FORNECEDOR", "ID_CONDICAO", "NUMERO_NF", "DATA_EMISSAO", cents("VALOR_TOTAL"), "QTD_ITEM")


@query(
    "j8_attach_terms",
    "SELECT i.id AS ID_NF_SAIDA, t.QTD AS QTD_PARCELAS, t.ENTRADA FROM invoices i JOIN terms t ON t.ID_CONDICAO = i.term",
)
def j8(f: Frames) -> DataFrame:
    return schedule.attach_terms(f.invoices(), f.terms()).select(
        "ID_NF_SAIDA", "QTD_PARCELAS", F.col("ENTRADA").cast("int").alias("ENTRADA")
    )


@query("j9_new_instalments", "SELECT id AS ID_NF_SAIDA, due AS DATA_VENCIMENTO, k AS NUM_PARCELAS FROM instalments WHERE id % 3 <> 0")
def j9(f: Frames) -> DataFrame:
    plan = f.instalments("ID_NF_SAIDA", "STATUS_RECEBIMENTO")
    existing = plan.where(F.col("ID_NF_SAIDA") % 3 == 0)
    fresh = schedule.new_instalments(plan, existing, ["ID_NF_SAIDA", "DATA_VENCIMENTO"])
    return fresh.select("ID_NF_SAIDA", "DATA_VENCIMENTO", "NUM_PARCELAS")


@query("j10_receipts_to_invoice", "SELECT id AS ID_NF_SAIDA, due AS DATA_VENCIMENTO, r AS VALOR_RECEBIDO FROM receipts WHERE id % 6 <> 0")
def j10(f: Frames) -> DataFrame:
    invoices = f.invoices().where(F.col("NUMERO_NF") % 6 != 0)
    found = settlement.receipts_to_invoice(f.receipts(), invoices)
    return found.select("ID_NF_SAIDA", "DATA_VENCIMENTO", cents("VALOR_RECEBIDO"))


@query(
    "j11_receipts_to_schedule",
    "SELECT prog AS ID_PROG_RECEBIMENTO, due AS DATA_VENCIMENTO, val AS VALOR_PARCELA, r AS VALOR_RECEBIDO, received AS DATA_RECEBIMENTO FROM met WHERE id % 10 <> 1",
)
def j11(f: Frames) -> DataFrame:
    receipts = f.receipts().withColumnRenamed("NUMERO_NF", "ID_NF_SAIDA")
    met = settlement.receipts_to_schedule(receipts, f.receivable_schedule(), f.receipt_history())
    return met.select("ID_PROG_RECEBIMENTO", "DATA_VENCIMENTO", cents("VALOR_PARCELA"), cents("VALOR_RECEBIDO"), "DATA_RECEBIMENTO")


PAID_NAMES = (
    "prog AS ID_PROG_PAGAMENTO, id AS ID_NF_ENTRADA, k AS NUM_PARCELAS, due AS DATA_VENCIMENTO, "
    "paid_on AS DATA_PGT_EFETUADO, val AS VALOR_PARCELA, paid AS VALOR_PARCELA_PAGO"
)


@query("j12_payments_to_open_schedule", f"SELECT {PAID_NAMES} FROM paid_rows")
def j12(f: Frames) -> DataFrame:
    joined = settlement.payments_to_open_schedule(f.payments(), f.payable_schedule())
    return in_cents(joined, "VALOR_PARCELA", "VALOR_PARCELA_PAGO")


TIER_NAMES = "prog AS ID_PROG_RECEBIMENTO, received AS DATA_RECEBIMENTO, r AS VALOR_RECEBIDO"


def tiered(f: Frames, **options) -> DataFrame:
    judged = settlement.settlement_deviation(f.settlements())
    matched = settlement.tolerance_band_join(judged, presets.tier_table(f.spark), **options)
    return matched.select("ID_PROG_RECEBIMENTO", "DATA_RECEBIMENTO", cents("VALOR_RECEBIDO"), "ID_DESCONTO")


@query("j13_tolerance_band_join", f"SELECT {TIER_NAMES}, ID_DESCONTO FROM matched")
def j13(f: Frames) -> DataFrame:
    return tiered(f)


@query("j13_tolerance_band_join_approved_only", f"SELECT {TIER_NAMES}, ID_DESCONTO FROM matched WHERE approved = 1")
def j13_approved(f: Frames) -> DataFrame:
    return tiered(f, approved_only=True)


@query("j13_tolerance_band_join_best_tier", f"SELECT {TIER_NAMES}, min(ID_DESCONTO) AS ID_DESCONTO FROM matched GROUP BY prog, received, r")
def j13_best(f: Frames) -> DataFrame:
    return tiered(f, best_tier=True)


MANY_TIERS = """SELECT o_orderkey AS tier, o_orderkey % 2003 AS low, o_orderkey % 2003 + o_orderkey % 5 AS high, o_orderkey % 13 * 25 AS low_bp,
                       o_orderkey % 13 * 25 + 50 AS high_bp, o_orderkey % 2 = 1 AS early FROM orders"""


@query(
    "j13_tolerance_band_join_many_tiers",
    f"""SELECT {TIER_NAMES}, tier AS ID_DESCONTO FROM judged j JOIN ({MANY_TIERS}) t ON j.early = t.early AND j.days BETWEEN t.low AND t.high
        WHERE NOT j.underpaid AND j.val <> 0 AND abs(j.r - j.val) * 10000 BETWEEN t.low_bp * j.val AND t.high_bp * j.val""",
)
def j13_many(f: Frames) -> DataFrame:
    """A tier of its own for every order: too many to send everywhere."""
    key = F.col("o_orderkey")
    tiers = f.table("orders").select(
        key.alias("ID_DESCONTO"),
        (key % 2003).cast("int").alias("MINIMO_DIAS"),
        (key % 2003 + key % 5).cast("int").alias("MAXIMO_DIAS"),
        (key % 13 * F.lit(0.25).cast("decimal(3,2)")).cast("decimal(5,2)").alias("MINIMO"),
        (key % 13 * F.lit(0.25).cast("decimal(3,2)") + F.lit(0.5).cast("decimal(3,2)")).cast("decimal(5,2)").alias("MAXIMO"),
        (key % 2).cast("int").alias("TIPO_DESCONTO"),
    )
    # once a settlement, not once a tier of it
    judged = settlement.settlement_deviation(f.settlements()).withColumn("__cents", cents("VALOR_RECEBIDO"))
    matched = settlement.tolerance_band_join(judged, tiers)
    return matched.select("ID_PROG_RECEBIMENTO", "DATA_RECEBIMENTO", F.col("__cents").alias("VALOR_RECEBIDO"), "ID_DESCONTO")


@query(
    "j14_unmatched_default",
    f"""SELECT {TIER_NAMES}, 9 AS ID_DESCONTO, 'DESCONTO INVALIDO' AS MOTIVO FROM judged WHERE prog NOT IN (SELECT prog FROM matched)""",
)
def j14(f: Frames) -> DataFrame:
    judged = settlement.settlement_deviation(f.settlements())
    matched = settlement.tolerance_band_join(judged, presets.tier_table(f.spark))
    rest = settlement.unmatched_default(judged, matched)
    return rest.select("ID_PROG_RECEBIMENTO", "DATA_RECEBIMENTO", cents("VALOR_RECEBIDO"), "ID_DESCONTO", "MOTIVO")


FLOW_COLUMNS = (cash_jobs.RECEIVED, cash_jobs.PAID)


@query("j15_merge_flows_daily", "SELECT d AS DATA, c_out AS SAIDA, c_in AS ENTRADA, c_in - c_out AS SALDO_DIARIO FROM flow_day")
def j15(f: Frames) -> DataFrame:
    merged = cash.merge_flows_daily(f.receipts_posted(), f.payments_posted(), *FLOW_COLUMNS)
    return in_cents(merged, "SAIDA", "ENTRADA", "SALDO_DIARIO")


MONTHLY_NAMES = (
    "m AS DATA_FECHAMENTO, CAST(year(m) AS INTEGER) AS ANO, CAST(month(m) AS INTEGER) AS MES, "
    "c_in AS ENTRADA, c_out AS SAIDA, c_in - c_out AS SALDO_MENSAL"
)


@query("j16_merge_flows_monthly", f"SELECT {MONTHLY_NAMES} FROM flow_month")
def j16(f: Frames) -> DataFrame:
    merged = cash.merge_flows_monthly(f.receipts_posted(), f.payments_posted(), *FLOW_COLUMNS)
    return in_cents(merged, "SAIDA", "ENTRADA", "SALDO_MENSAL")


@query(
    "j17_existing_facts_removed",
    """SELECT DISTINCT l_orderkey AS NUMERO_NF, l_returnflag FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0)""",
)
def j17(f: Frames) -> DataFrame:
    rows = f.table("lineitem").select(F.col("l_orderkey").alias("NUMERO_NF"), "l_returnflag")
    facts = f.invoices().where(F.col("NUMERO_NF") % 3 == 0)
    return dims.existing_facts_removed(rows, facts, "NUMERO_NF")


# -- aggregates, windows, latest ----------------------------------------------------------


@query("a1_daily_sum", "SELECT d AS DATA_RECEBIDO, CAST(month(d) AS INTEGER) AS MES, CAST(sum(c) AS BIGINT) AS total FROM flow_in GROUP BY d")
def a1(f: Frames) -> DataFrame:
    return in_cents(cash.daily_sum(f.receipts_posted(), *cash_jobs.RECEIVED, "total"), "total")


@query(
    "a2_monthly_sum",
    """SELECT last_day(d) AS DATA_FECHAMENTO, CAST(year(d) AS INTEGER) AS ANO, CAST(month(d) AS INTEGER) AS MES, CAST(sum(c) AS BIGINT) AS total
       FROM flow_out GROUP BY last_day(d), year(d), month(d)""",
)
def a2(f: Frames) -> DataFrame:
    return in_cents(cash.monthly_sum(f.payments_posted(), *cash_jobs.PAID, "total"), "total")


@query("w1_running_balance", "SELECT d AS DATA, CAST(sum(c_in - c_out) OVER (ORDER BY d) AS BIGINT) AS ACUMULADO_DIARIO FROM flow_day")
def w1(f: Frames) -> DataFrame:
    days = cash.merge_flows_daily(f.receipts_posted(), f.payments_posted(), *FLOW_COLUMNS)
    balanced = cash.running_balance(days, "DATA", "SALDO_DIARIO", "ACUMULADO_DIARIO")
    return balanced.select("DATA", cents("ACUMULADO_DIARIO"))


@query(
    "w1_running_balance_of_movements",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CAST(sum({sql.cents("l_extendedprice")}) OVER
              (ORDER BY CAST(l_shipdate AS DATE), l_orderkey, l_linenumber, l_partkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS BIGINT) AS ACUMULADO FROM lineitem""",
)
def w1_of_movements(f: Frames) -> DataFrame:
    """The balance behind every line item, in date order, in blocks of a few thousand."""
    lines = f.table("lineitem").select(
        F.to_date("l_shipdate").alias("DATA"), "l_orderkey", "l_linenumber", "l_partkey", money("l_extendedprice").alias("VALOR")
    )
    order = ["DATA", "l_orderkey", "l_linenumber", "l_partkey", "VALOR"]
    done = cash.running_balance_of_movements(lines, order, "VALOR", "ACUMULADO", block_rows=5000)
    return done.select("l_orderkey", "l_linenumber", "l_partkey", cents("ACUMULADO"))


@query(
    "w1_running_balance_by_party",
    """SELECT party, d, CAST(sum(c) OVER (PARTITION BY party ORDER BY d) AS BIGINT) AS balance FROM (
         SELECT o_custkey AS party, CAST(o_orderdate AS DATE) AS d, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS c
         FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE))""",
)
def w1_by_party(f: Frames) -> DataFrame:
    rows = f.table("orders").select(
        F.col("o_custkey").alias("party"), F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").cast("decimal(16,2)").alias("amount")
    )
    days = rows.groupBy("party", "d").agg(F.sum("amount").alias("amount"))
    return cash.running_balance(days, "d", "amount", "balance", by=["party"]).select("party", "d", cents("balance"))


@query(
    "w2_running_balance_opening",
    """SELECT d AS DATA, CAST((SELECT sum(c_in - c_out) FROM flow_day WHERE d < DATE '2000-01-01') + sum(c_in - c_out) OVER (ORDER BY d) AS BIGINT) AS ACUMULADO_DIARIO
       FROM flow_day WHERE d >= DATE '2000-01-01'""",
)
def w2(f: Frames) -> DataFrame:
    days = cash.merge_flows_daily(f.receipts_posted(), f.payments_posted(), *FLOW_COLUMNS)
    start = F.lit(date(2000, 1, 1))
    opening = days.where(F.col("DATA") < start).agg(F.sum("SALDO_DIARIO").alias("opening")).scalar()
    later = cash.running_balance(days.where(F.col("DATA") >= start), "DATA", "SALDO_DIARIO", "ACUMULADO_DIARIO", opening=opening)
    return later.select("DATA", cents("ACUMULADO_DIARIO"))


@query("o2_latest_row", "SELECT d AS DATA, c_in - c_out AS SALDO_DIARIO FROM flow_day ORDER BY d DESC LIMIT 1")
def o2(f: Frames) -> DataFrame:
    days = cash.merge_flows_daily(f.receipts_posted(), f.payments_posted(), *FLOW_COLUMNS)
    return in_cents(cash.latest_row(days, "DATA", "DATA", "SALDO_DIARIO"), "SALDO_DIARIO")


# -- generator, upserts, schema, keys -----------------------------------------------------


@query(
    "k1_generate_instalments",
    "SELECT id AS ID_NF_SAIDA, due AS DATA_VENCIMENTO, k AS NUM_PARCELAS, val AS VALOR_PARCELA, 0 AS STATUS_RECEBIMENTO FROM instalments",
)
def k1(f: Frames) -> DataFrame:
    return in_cents(f.instalments("ID_NF_SAIDA", "STATUS_RECEBIMENTO"), "VALOR_PARCELA")


@query(
    "k1_generate_instalments_residue_on_last",
    """SELECT id AS ID_NF_SAIDA, due AS DATA_VENCIMENTO, k AS NUM_PARCELAS,
              CASE WHEN k = qtd THEN total - val * (qtd - 1) ELSE val END AS VALOR_PARCELA, 0 AS STATUS_RECEBIMENTO FROM instalments""",
)
def k1_residue(f: Frames) -> DataFrame:
    invoices = schedule.attach_terms(f.invoices(), f.terms())
    plan = schedule.generate_instalments(invoices, invoice_id="ID_NF_SAIDA", status="STATUS_RECEBIMENTO", residue_on_last=True)
    return in_cents(plan, "VALOR_PARCELA")


S7 = """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment, c_nationkey FROM customer
       UNION ALL SELECT 1000000000 + c_custkey, 'NEW', NULL FROM customer WHERE c_custkey % 11 = 0"""


def customers_changed(f: Frames) -> tuple[DataFrame, DataFrame]:
    customer = f.table("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    key = F.col("c_custkey")
    changed = customer.where(key % 5 == 0).select(key, F.lit("CHANGED").alias("c_mktsegment"))
    added = customer.where(key % 11 == 0).select((key + 1000000000).alias("c_custkey"), F.lit("NEW").alias("c_mktsegment"))
    return customer, changed.unionByName(added)


@query("s7_upsert", S7)
def s7(f: Frames) -> DataFrame:
    customer, changes = customers_changed(f)
    return dims.merge_upsert(customer, changes, ["c_custkey"], ["c_mktsegment"])


@query("s7_upsert_by_partition", S7)
def s7_by_partition(f: Frames) -> DataFrame:
    """The same on a stored table, in place, and once more, which changes nothing."""
    customer, changes = customers_changed(f)
    table = KeyedTable(f.spark, f"{shared_folder(f.spark)}/customer-{uuid4()}", customer.schema, ["c_custkey"], parts=16)
    table.create(customer)
    for _ in range(2):
        table.upsert(changes, ["c_mktsegment"])
    return table.read()


S8 = "SELECT prog AS ID_PROG_PAGAMENTO, CASE WHEN id % 4 = 0 OR prog IN (SELECT prog FROM paid_rows) THEN 1 ELSE 0 END AS STATUS_PAGAMENTO FROM instalments"


@query("s8_mark_settled", S8)
def s8(f: Frames) -> DataFrame:
    plan = f.payable_schedule()
    settled = settlement.payments_to_open_schedule(f.payments(), plan)
    marked = settlement.mark_settled(plan, settled, schedule_id="ID_PROG_PAGAMENTO", status="STATUS_PAGAMENTO")
    return marked.select("ID_PROG_PAGAMENTO", "STATUS_PAGAMENTO")


@query("s8_mark_settled_by_partition", S8)
def s8_by_partition(f: Frames) -> DataFrame:
    """The same on a stored schedule, in place."""
    plan = f.payable_schedule()
    table = KeyedTable(f.spark, f"{shared_folder(f.spark)}/plan-{uuid4()}", plan.schema, ["ID_PROG_PAGAMENTO"], parts=16)
    table.create(plan)
    table.mark(settlement.payments_to_open_schedule(f.payments(), plan), "STATUS_PAGAMENTO", 1)
    return table.read().select("ID_PROG_PAGAMENTO", "STATUS_PAGAMENTO")


@query(
    "s13_conform_schema",
    "SELECT o_orderkey AS ID_NF, CAST(o_custkey AS INTEGER) AS ID_CLIENTE, CAST(o_orderdate AS DATE) AS DATA_EMISSAO, CAST(round(o_totalprice * 100) AS BIGINT) AS VALOR_TOTAL FROM orders",
)
def s13(f: Frames) -> DataFrame:
    rows = f.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    target = required(ID_NF=LongType(), ID_CLIENTE=IntegerType(), DATA_EMISSAO=DateType(), VALOR_TOTAL=MONEY)
    return in_cents(conform_schema(rows, target), "VALOR_TOTAL")


@query(
    "s15_assign_surrogate_keys",
    """SELECT (SELECT max(c_custkey) FROM customer WHERE c_custkey % 11 <> 0) + row_number() OVER (ORDER BY substr(md5(c_name), 1, 3), c_name) AS id, c_name
       FROM customer WHERE c_custkey % 11 = 0""",
)
def s15(f: Frames) -> DataFrame:
    customer = f.table("customer")
    known = customer.where(F.col("c_custkey") % 11 != 0).select(F.col("c_custkey").alias("id"))
    fresh = customer.where(F.col("c_custkey") % 11 == 0).select("c_name")
    return dims.assign_surrogate_keys(fresh, "c_name", "id", start_after=known)


# -- jobs ---------------------------------------------------------------------------------


def purchases(f: Frames, **options) -> ingest.Ingest:
    return ingest.purchases_ingest(
        f.purchase_feed(),
        processed=f.purchases_log(),
        postal_codes=f.postal_codes(),
        parties=f.suppliers(),
        addresses=f.supplier_addresses(),
        address_types=f.address_types(),
        terms=f.terms(),
        **options,
    )


def sales(f: Frames, **options) -> ingest.Ingest:
    return ingest.sales_ingest(
        f.sales_feed(),
        processed=f.sales_log(),
        postal_codes=f.postal_codes(),
        parties=f.customers(),
        addresses=f.customer_addresses(),
        address_types=f.address_types(),
        terms=f.terms(),
        **options,
    )


class Side(NamedTuple):
    prefix: str
    side: str
    run: Callable[[Frames], ingest.Ingest]
    layout: presets.Layout


def _register_ingest(s: Side) -> None:
    name, tax, mail, phone = s.layout.name, s.layout.tax_id, s.layout.email, s.layout.phone
    feed = (
        f"name AS {name}, tax AS {tax}, email AS {mail}, phone AS {phone}, {FEED_LIST} num AS NUM_ENDERECO, compl AS COMPLEMENTO, "
        "TIPO_ENDERECO, DATA_PROCESSAMENTO"
    )
    rejected_feed = feed.replace(" CEP,", " TRY_CAST(CEP AS INTEGER) AS CEP,") if s.side == "purchases" else feed
    parties = f"tax AS {tax}, name AS {name}, email AS {mail}, phone AS {phone}"
    addresses = f"id AS {s.layout.party_id}, type_id AS ID_TIPO_ENDERECO, CEP, num AS NUMERO, compl AS COMPLEMENTO"
    same = "a.id = l.id AND a.CEP = l.CEP"
    p = s.prefix

    def plain(df: DataFrame) -> DataFrame:
        dated = df.withColumn("DATA_PROCESSAMENTO", F.to_date("DATA_PROCESSAMENTO")) if "DATA_PROCESSAMENTO" in df.columns else df
        return in_cents(dated, *[c for c in AMOUNTS if c in df.columns])

    query(f"{p}_accepted", f"SELECT {feed} FROM {s.side}_accepted")(lambda f: plain(s.run(f).accepted))
    query(f"{p}_rejected", f"SELECT {rejected_feed}, MOTIVO FROM {s.side}_validated WHERE MOTIVO <> 'OK'")(lambda f: plain(s.run(f).rejected))
    log = ", ".join(c if c != tax else f"tax AS {tax}" for c in s.layout.log_columns)
    query(f"{p}_processed_log", f"SELECT {log} FROM {s.side}_accepted")(lambda f: plain(s.run(f).processed_log))
    query(f"{p}_new_parties", f"SELECT id AS {s.layout.party_id}, {parties} FROM {s.side}_entering")(lambda f: s.run(f).new_parties)
    query(
        f"{p}_changed_parties",
        f"""SELECT o.tax AS {tax}, o.name AS {name}, o.email AS {mail}, o.phone AS {phone} FROM {s.side}_offered o JOIN {s.side}_parties p ON p.tax = o.tax
            WHERE o.name IS DISTINCT FROM p.name OR o.email IS DISTINCT FROM p.email OR o.phone IS DISTINCT FROM p.phone""",
    )(lambda f: s.run(f).changed_parties)
    query(
        f"{p}_new_addresses", f"SELECT {addresses} FROM {s.side}_located l WHERE NOT EXISTS (SELECT 1 FROM {s.side}_addresses a WHERE {same})"
    )(lambda f: s.run(f).new_addresses)
    query(
        f"{p}_changed_addresses",
        f"""SELECT l.id AS {s.layout.party_id}, l.type_id AS ID_TIPO_ENDERECO, l.CEP, l.num AS NUMERO, l.compl AS COMPLEMENTO
            FROM {s.side}_located l JOIN {s.side}_addresses a ON {same}
            WHERE a.type_id IS DISTINCT FROM l.type_id OR a.num <> l.num OR a.compl <> l.compl""",
    )(lambda f: s.run(f).changed_addresses)
    facts = f"""SELECT p.id AS party, t.ID_CONDICAO, a.NUMERO_NF, a.DATA_EMISSAO, a.VALOR_NET, a.VALOR_TRIBUTO, a.VALOR_TOTAL, a.NOME_ITEM, a.QTD_ITEM
            FROM {s.side}_accepted a LEFT JOIN {s.side}_party_ids p ON p.tax = a.tax
            LEFT JOIN terms t ON t.DESCRICAO = {sql.normalized("a.CONDICAO_PAGAMENTO")}"""
    columns = ", ".join(presets.INVOICE_COLUMNS)
    ties = ", ".join(f"{c} NULLS FIRST" for c in ("ID_CONDICAO", *presets.INVOICE_COLUMNS[1:]))
    query(
        f"{p}_invoices",
        f"""SELECT row_number() OVER (ORDER BY substr(md5(party || chr(31) || NUMERO_NF), 1, 3), party, NUMERO_NF, {ties}) AS {s.layout.invoice_id},
                   party AS {s.layout.party_id}, ID_CONDICAO, {columns} FROM ({facts}) WHERE party IS NOT NULL AND ID_CONDICAO IS NOT NULL""",
    )(lambda f: plain(s.run(f).invoices))
    query(
        f"{p}_incomplete_invoices",
        f"""SELECT party AS {s.layout.party_id}, ID_CONDICAO, {columns}, CASE WHEN party IS NULL THEN '{s.layout.party_id}_NULO' ELSE 'ID_CONDICAO_NULO' END AS MOTIVO
            FROM ({facts}) WHERE party IS NULL OR ID_CONDICAO IS NULL""",
    )(lambda f: plain(s.run(f).incomplete_invoices))
    query(
        f"{p}_parties_next",
        f"""SELECT p.id AS {s.layout.party_id}, p.tax AS {tax}, CASE WHEN o.tax IS NULL THEN p.name ELSE o.name END AS {name},
                   CASE WHEN o.tax IS NULL THEN p.email ELSE o.email END AS {mail}, CASE WHEN o.tax IS NULL THEN p.phone ELSE o.phone END AS {phone}
            FROM {s.side}_parties p LEFT JOIN {s.side}_offered o ON o.tax = p.tax
            UNION ALL SELECT id, tax, name, email, phone FROM {s.side}_entering""",
    )(lambda f: s.run(f).parties_next)
    query(
        f"{p}_addresses_next",
        f"""SELECT a.id AS {s.layout.party_id}, CASE WHEN l.id IS NULL THEN a.type_id ELSE l.type_id END AS ID_TIPO_ENDERECO, a.CEP,
                   CASE WHEN l.id IS NULL THEN a.num ELSE l.num END AS NUMERO, CASE WHEN l.id IS NULL THEN a.compl ELSE l.compl END AS COMPLEMENTO
            FROM {s.side}_addresses a LEFT JOIN {s.side}_located l ON {same}
            UNION ALL SELECT {addresses.replace(" AS " + s.layout.party_id, "")} FROM {s.side}_located l WHERE NOT EXISTS (SELECT 1 FROM {s.side}_addresses a WHERE {same})""",
    )(lambda f: s.run(f).addresses_next)


def _register_verdicts(name: str, side: str, run: Callable[[Frames], ingest.Ingest]) -> None:
    def counted(f: Frames) -> DataFrame:
        return f.spark.createDataFrame(list(run(f).verdict_counts().items()), "MOTIVO string, linhas long")

    query(name, f"SELECT MOTIVO, count(*) AS linhas FROM {side}_validated GROUP BY MOTIVO")(counted)


_register_verdicts("q1_purchases_ingest_verdicts", "purchases", purchases)
_register_verdicts("q2_sales_ingest_verdicts", "sales", sales)
_register_ingest(Side("q1_purchases_ingest", "purchases", purchases, presets.PURCHASES))
_register_ingest(Side("q2_sales_ingest", "sales", sales, presets.SALES))


@query(
    "q3_payables_schedule",
    "SELECT id AS ID_NF_ENTRADA, due AS DATA_VENCIMENTO, k AS NUM_PARCELAS, val AS VALOR_PARCELA, 0 AS STATUS_PAGAMENTO FROM instalments WHERE id % 5 <> 0",
)
def q3(f: Frames) -> DataFrame:
    existing = f.payable_schedule().where(F.col("ID_NF_ENTRADA") % 5 == 0)
    return in_cents(schedules.payables_schedule(f.invoices("ID_NF_ENTRADA"), f.terms(), existing), "VALOR_PARCELA")


@query(
    "q4_receivables_schedule",
    "SELECT id AS ID_NF_SAIDA, due AS DATA_VENCIMENTO, k AS NUM_PARCELAS, val AS VALOR_PARCELA, 0 AS STATUS_RECEBIMENTO FROM instalments WHERE id % 5 <> 0",
)
def q4(f: Frames) -> DataFrame:
    existing = f.receivable_schedule().where(F.col("ID_NF_SAIDA") % 5 == 0)
    return in_cents(schedules.receivables_schedule(f.invoices(), f.terms(), existing), "VALOR_PARCELA")


NEW_IDS = "(SELECT max(prog) FROM instalments WHERE id % 5 = 0) + row_number() OVER (ORDER BY id, k)"


@query(
    "q3_payables_schedule_ids",
    f"""SELECT {NEW_IDS} AS ID_PROG_PAGAMENTO, id AS ID_NF_ENTRADA, due AS DATA_VENCIMENTO, k AS NUM_PARCELAS, val AS VALOR_PARCELA, 0 AS STATUS_PAGAMENTO
        FROM instalments WHERE id % 5 <> 0""",
)
def q3_ids(f: Frames) -> DataFrame:
    existing = f.payable_schedule().where(F.col("ID_NF_ENTRADA") % 5 == 0)
    return in_cents(schedules.numbered_payables(f.invoices("ID_NF_ENTRADA"), f.terms(), existing), "VALOR_PARCELA")


@query(
    "q4_receivables_schedule_ids",
    """SELECT (SELECT max(prog) FROM instalments WHERE id % 5 = 0 OR k = 2) + row_number() OVER (ORDER BY id, k) AS ID_PROG_RECEBIMENTO, id AS ID_NF_SAIDA,
              due AS DATA_VENCIMENTO, k AS NUM_PARCELAS, val AS VALOR_PARCELA, 0 AS STATUS_RECEBIMENTO FROM instalments WHERE id % 5 <> 0 AND k <> 2""",
)
def q4_ids(f: Frames) -> DataFrame:
    """Of some invoices a part is scheduled already."""
    existing = f.receivable_schedule().where((F.col("ID_NF_SAIDA") % 5 == 0) | (F.col("NUM_PARCELAS") == 2))
    return in_cents(schedules.numbered_receivables(f.invoices(), f.terms(), existing), "VALOR_PARCELA")


@query("q5_post_payments_history", f"SELECT {PAID_NAMES} FROM paid_rows")
def q5_history(f: Frames) -> DataFrame:
    posted = posting.post_payments(f.payment_file(), f.payable_schedule()).history
    return in_cents(posted, "VALOR_PARCELA", "VALOR_PARCELA_PAGO")


@query(
    "q5_post_payments_schedule",
    """SELECT prog AS ID_PROG_PAGAMENTO, id AS ID_NF_ENTRADA, due AS DATA_VENCIMENTO, k AS NUM_PARCELAS, val AS VALOR_PARCELA,
              CASE WHEN id % 4 = 0 OR prog IN (SELECT prog FROM paid_rows) THEN 1 ELSE 0 END AS STATUS_PAGAMENTO FROM instalments""",
)
def q5_schedule(f: Frames) -> DataFrame:
    return in_cents(posting.post_payments(f.payment_file(), f.payable_schedule()).schedule, "VALOR_PARCELA")


def posted_receipts(f: Frames) -> posting.Posting:
    return posting.post_receipts(
        f.receipts(), f.invoices(), f.receivable_schedule(), f.receipt_history(), presets.tier_table(f.spark)
    )


@query(
    "q6_post_receipts_history",
    """SELECT DISTINCT prog AS ID_PROG_RECEBIMENTO, ID_DESCONTO, received AS DATA_RECEBIDO, val AS VALOR_TOTAL_EM_HAVER, r AS VALOR_PAGO FROM matched WHERE id % 10 <> 1
       UNION ALL SELECT prog, 9, received, val, r FROM judged WHERE id % 10 <> 1 AND prog NOT IN (SELECT prog FROM matched)""",
)
def q6_history(f: Frames) -> DataFrame:
    return in_cents(posted_receipts(f).history, "VALOR_TOTAL_EM_HAVER", "VALOR_PAGO")


@query(
    "q6_post_receipts_schedule",
    """SELECT prog AS ID_PROG_RECEBIMENTO, id AS ID_NF_SAIDA, due AS DATA_VENCIMENTO, k AS NUM_PARCELAS, val AS VALOR_PARCELA,
              CASE WHEN id % 10 <> 1 AND (id * 7 + k) % 4 <> 0 THEN 1 ELSE 0 END AS STATUS_RECEBIMENTO FROM instalments""",
)
def q6_schedule(f: Frames) -> DataFrame:
    return in_cents(posted_receipts(f).schedule, "VALOR_PARCELA")


def daily(df: DataFrame) -> DataFrame:
    return in_cents(df, "SAIDA", "ENTRADA", "SALDO_DIARIO", "ACUMULADO_DIARIO")


def monthly(df: DataFrame) -> DataFrame:
    return in_cents(df, "SAIDA", "ENTRADA", "SALDO_MENSAL", "VALOR_ACUMULADO_MES")


def daily_sql(where: str, opening: str = "0") -> str:
    return f"""SELECT d AS DATA, c_out AS SAIDA, c_in AS ENTRADA, c_in - c_out AS SALDO_DIARIO,
                      CAST({opening} + sum(c_in - c_out) OVER (ORDER BY d) AS BIGINT) AS ACUMULADO_DIARIO,
                      last_day(d) AS DATA_FECHAMENTO, DATE '2000-06-15' AS DATA_PROCESSADO FROM flow_day WHERE {where}"""


def monthly_sql(where: str, opening: str = "0") -> str:
    return f"""SELECT {MONTHLY_NAMES}, CAST({opening} + sum(c_in - c_out) OVER (ORDER BY m) AS BIGINT) AS VALOR_ACUMULADO_MES,
                      DATE '2000-06-15' AS DATA_PROCESSADO FROM flow_month WHERE {where}"""


def balance_before(day: str) -> str:
    return f"(SELECT sum(c_in - c_out) FROM flow_day WHERE d < DATE '{day}')"


def initial(f: Frames, **options) -> cash_jobs.InitialLoad:
    state = cash_jobs.RunState(TODAY, status=0)
    return cash_jobs.cashflow_initial(f.receipts_posted(), f.payments_posted(), state, processed_at=STAMP, **options)


@query("q7_cashflow_initial", daily_sql("d < DATE '2000-06-01'"))
def q7(f: Frames) -> DataFrame:
    return daily(initial(f).daily)


@query("q7_cashflow_initial_monthly", monthly_sql("m < DATE '2000-06-01'"))
def q7_monthly(f: Frames) -> DataFrame:
    return monthly(initial(f).monthly)


@query("q7_cashflow_initial_month_number", daily_sql("month(d) < 6 AND year(d) <= 2000"))
def q7_month_number(f: Frames) -> DataFrame:
    return daily(initial(f, mode="month_number").daily)


@query("q7_cashflow_initial_monthly_month_number", monthly_sql("month(m) < 6"))
def q7_monthly_month_number(f: Frames) -> DataFrame:
    return monthly(initial(f, mode="month_number").monthly)


@query("q7_cashflow_initial_before_cutoff", daily_sql("d < DATE '2000-05-01'"))
def q7_before_cutoff(f: Frames) -> DataFrame:
    state = cash_jobs.RunState(TODAY, status=0, cutoff=date(2000, 7, 1))
    return daily(cash_jobs.cashflow_initial(f.receipts_posted(), f.payments_posted(), state, processed_at=STAMP).daily)


def history(f: Frames) -> cash_jobs.InitialLoad:
    """What the first load left behind."""
    return cash_jobs.cashflow_initial(
        f.receipts_posted(), f.payments_posted(), cash_jobs.RunState(FIRST_RUN, status=0), processed_at=FIRST_RUN
    )


def close(f: Frames) -> cash_jobs.Cashflow:
    before = history(f)
    return cash_jobs.cashflow_close(
        f.receipts_posted(), f.payments_posted(), before.daily, before.monthly, cash_jobs.RunState(TODAY, status=1), processed_at=STAMP
    )


@query("q8_cashflow_close", daily_sql("d >= DATE '2000-01-01' AND d < DATE '2000-06-01'", balance_before("2000-01-01")))
def q8(f: Frames) -> DataFrame:
    return daily(close(f).daily)


@query("q8_cashflow_close_monthly", monthly_sql("m >= DATE '2000-01-01' AND m < DATE '2000-06-01'", balance_before("2000-01-01")))
def q8_monthly(f: Frames) -> DataFrame:
    return monthly(close(f).monthly)


def current(f: Frames, through_unclosed: bool) -> DataFrame:
    before = history(f)
    return cash_jobs.cashflow_current_month(
        f.receipts_posted(),
        f.payments_posted(),
        before.daily,
        before.monthly,
        cash_jobs.RunState(TODAY, status=1),
        through_unclosed=through_unclosed,
        processed_at=STAMP,
    )


CURRENT = "d >= DATE '2000-06-01' AND d < DATE '2000-07-01'"


@query("q9_cashflow_current_month", daily_sql(CURRENT, balance_before("2000-01-01")))
def q9(f: Frames) -> DataFrame:
    return daily(current(f, through_unclosed=False))


@query("q9_cashflow_current_month_through_unclosed", daily_sql(CURRENT, balance_before("2000-06-01")))
def q9_through(f: Frames) -> DataFrame:
    return daily(current(f, through_unclosed=True))


def late(f: Frames) -> cash_jobs.Repair:
    """A first load without the postings that arrive after it, and their booking."""
    run = F.lit(TODAY)

    def ledger(flow: DataFrame, day: str, key: str, table: str) -> DataFrame:
        return flow.withColumn("CHEGADA", F.when(F.col(key) % 17 == 3, F.date_add(run, 20)).otherwise(F.least(F.to_date(day), run)))

    receipts = ledger(f.receipts_posted("o_orderkey"), "DATA_RECEBIDO", "o_orderkey", "orders")
    payments = ledger(f.payments_posted("l_orderkey"), "DATA_PGT_EFETUADO", "l_orderkey", "lineitem")
    known = [flow.where(F.col("CHEGADA") <= run) for flow in (receipts, payments)]
    before = cash_jobs.cashflow_initial(*known, cash_jobs.RunState(TODAY, status=0), processed_at=STAMP)
    days, months = shared_copy(before.daily), shared_copy(before.monthly)
    return cash_jobs.cashflow_late_postings(receipts, payments, days, months, arrived="CHEGADA", after=TODAY, processed_at=STAMP)


@query("q8_cashflow_late_postings", daily_sql("d < DATE '2000-06-01'"))
def q8_late(f: Frames) -> DataFrame:
    """Equal to a first load that had all postings."""
    return daily(late(f).daily_next)


@query("q8_cashflow_late_postings_monthly", monthly_sql("m < DATE '2000-06-01'"))
def q8_late_monthly(f: Frames) -> DataFrame:
    return monthly(late(f).monthly_next)


def bank_payments(payables: DataFrame) -> DataFrame:
    """A payment file of text columns for two thirds of the instalments, some amounts unreadable."""
    part, due = F.col("NUM_PARCELAS"), F.col("DATA_VENCIMENTO")
    mark = F.dayofmonth(due) + part
    return payables.where(mark % 3 != 0).select(
        F.col("ID_NF_ENTRADA").cast("string").alias("ID_NF_ENTRADA"),
        due.cast("string").alias("DATA_VENCIMENTO"),
        F.date_add(due, mark % 15 - 7).cast("string").alias("DATA_PGT_EFETUADO"),
        F.when(mark % 17 == 0, F.lit("?")).otherwise(F.col("VALOR_PARCELA").cast("string")).alias("VALOR_PGT_EFETUADO"),
    )


def bank_receipts(receivables: DataFrame, invoices: DataFrame) -> DataFrame:
    """Receipts by invoice number, early and late, with a little too much or too little."""
    part, due = F.col("NUM_PARCELAS"), F.col("DATA_VENCIMENTO")
    mark = F.dayofmonth(due) + part
    value = F.call_function("div", (F.col("VALOR_PARCELA") * 100).cast("long") * (10000 + (mark % 13 - 6) * 50), F.lit(10000).cast("long"))
    return receivables.where((F.dayofmonth(due) * 7 + part) % 4 != 0).join(invoices.select("ID_NF_SAIDA", "NUMERO_NF"), "ID_NF_SAIDA").select(
        "NUMERO_NF",
        "DATA_VENCIMENTO",
        F.date_add(due, mark % 25 - 12).alias("DATA_RECEBIMENTO"),
        (value.cast("decimal(18,0)") / 100).cast("decimal(16,2)").alias("VALOR_RECEBIDO"),
    )


def whole_cycle(f: Frames, stage: Callable[[DataFrame], DataFrame] = shared_copy) -> tuple[cycle.Schedules, cycle.Cycle]:
    """Both feeds to the end: parties, invoices, schedules with ids, postings, cash flow."""
    bought, sold = purchases(f, stage=stage), sales(f, stage=stage)
    invoices = stage(sold.invoices)
    payables, receivables = f.payable_schedule().limit(0), f.receivable_schedule().limit(0)
    plans = cycle.schedule_invoices(bought, sold._replace(invoices=invoices), f.terms(), payables=payables, receivables=receivables, stage=stage)
    none = plans.new_payables.limit(0)
    done = cycle.post_and_report(
        plans,
        bank_payments(plans.new_payables),
        bank_receipts(plans.new_receivables, invoices),
        invoices=invoices,
        tiers=presets.tier_table(f.spark),
        payment_history=posting.post_payments(bank_payments(none), none).history,
        receipt_history=f.spark.createDataFrame([], "ID_PROG_RECEBIMENTO long, ID_DESCONTO int, DATA_RECEBIDO date, VALOR_TOTAL_EM_HAVER decimal(16,2), VALOR_PAGO decimal(16,2)"),
        state=cash_jobs.RunState(TODAY, status=0),
        stage=stage,
        processed_at=STAMP,
    )
    return plans, done


@query(
    "q11_feed_to_cashflow",
    """SELECT d AS DATA, c_out AS SAIDA, c_in AS ENTRADA, c_in - c_out AS SALDO_DIARIO, CAST(sum(c_in - c_out) OVER (ORDER BY d) AS BIGINT) AS ACUMULADO_DIARIO,
              last_day(d) AS DATA_FECHAMENTO, DATE '2000-06-15' AS DATA_PROCESSADO
       FROM (SELECT d, CAST(sum(c_out) AS BIGINT) AS c_out, CAST(sum(c_in) AS BIGINT) AS c_in FROM cycle_flows WHERE d < DATE '2000-06-01' GROUP BY d)""",
)
def q11(f: Frames) -> DataFrame:
    return daily(whole_cycle(f)[1].cash.daily)


def seeded(f: Frames):
    """The four reference tables, through the CSV files they are seeded from; one postal code per customer."""
    nation = F.col("c_nationkey")
    codes = f.table("customer").select(
        (F.lit(1001000) + F.col("c_custkey")).cast("string").alias("CEP"),
        F.when(nation < 12, F.lit("SP")).otherwise(F.lit("RJ")).alias("UF"),
        F.col("c_mktsegment").alias("CIDADE"),
        F.concat(F.lit("Bairro "), nation.cast("string")).alias("BAIRRO"),
        F.concat(F.lit('Rua "A", '), F.col("c_custkey").cast("string")).alias("LOGRADOURO"),
    )
    folder = f"{shared_folder(f.spark)}/seed-{uuid4()}"
    codes.write.csv(f"{folder}/cep", header=True)
    f.address_types().select("DESCRICAO", F.upper("DESCRICAO").alias("SIGLA")).write.csv(f"{folder}/types", header=True)
    f.terms().drop("ID_CONDICAO").write.csv(f"{folder}/terms", header=True)
    presets.tier_table(f.spark).drop("ID_DESCONTO").write.csv(f"{folder}/tiers", header=True)
    return seed_reference_data(
        f.spark,
        postal_codes=f"{folder}/cep",
        address_types=f"{folder}/types",
        terms=f"{folder}/terms",
        tiers=f"{folder}/tiers",
    )


@query(
    "q10_seed_reference_data",
    """SELECT CAST(1001000 + c_custkey AS VARCHAR) AS CEP, CASE WHEN c_nationkey < 12 THEN 'SP' ELSE 'RJ' END AS UF, c_mktsegment AS CIDADE,
              'Bairro ' || CAST(c_nationkey AS VARCHAR) AS BAIRRO, 'Rua "A", ' || CAST(c_custkey AS VARCHAR) AS LOGRADOURO FROM customer""",
)
def q10(f: Frames) -> DataFrame:
    return seeded(f).postal_codes


@query(
    "q7_parameters_after_first_load",
    """SELECT ROW_ID, COD, CASE WHEN COD = 1 THEN concat_ws(',', coalesce(VAR_DESCRICAO, ''), coalesce(CAST(VAR_DT_INICIAL AS VARCHAR), ''), coalesce(CAST(VAR_DT_FINAL AS VARCHAR), ''),
                coalesce(CAST(VAR_DT_ATUAL AS VARCHAR), ''), coalesce(CAST(VAR_EXPURGO AS VARCHAR), ''), '1') ELSE DESCRICAO END AS DESCRICAO FROM parsed""",
)
def q7_parameters(f: Frames) -> DataFrame:
    """The parameter rows as the first load hands them back, its status set."""
    return initial(f, parameters=f.parameters()).parameters


@query("q7_cashflow_initial_when_loaded", daily_sql("false"))
def q7_loaded(f: Frames) -> DataFrame:
    """Nothing once the status says that the first load is done."""
    state = cash_jobs.RunState(TODAY, status=1)
    return daily(cash_jobs.cashflow_initial(f.receipts_posted(), f.payments_posted(), state, processed_at=STAMP).daily)


@query("q8_cashflow_close_again", daily_sql("false"))
def q8_again(f: Frames) -> DataFrame:
    """Nothing when the close is run again on the history it has grown."""
    before, done = history(f), close(f)
    days, months = before.daily.unionByName(done.daily), before.monthly.unionByName(done.monthly)
    again = cash_jobs.cashflow_close(
        f.receipts_posted(), f.payments_posted(), days, months, cash_jobs.RunState(TODAY, status=1), processed_at=STAMP
    )
    return daily(again.daily)


# -- files, stored tables, parameters, SQL ------------------------------------------------


@query("q10_seed_address_types", "SELECT lower(label) AS DESCRICAO, label AS SIGLA FROM address_types")
def q10_types(f: Frames) -> DataFrame:
    return seeded(f).address_types


@query("q10_seed_terms", "SELECT DESCRICAO, CAST(QTD AS INTEGER) AS QTD_PARCELAS, CAST(ENTRADA AS SMALLINT) AS ENTRADA FROM terms")
def q10_terms(f: Frames) -> DataFrame:
    return seeded(f).terms


@query(
    "q10_seed_tiers",
    """SELECT CAST(low_days AS INTEGER) AS MINIMO_DIAS, CAST(high_days AS INTEGER) AS MAXIMO_DIAS, CAST(low_bp AS BIGINT) AS MINIMO, CAST(high_bp AS BIGINT) AS MAXIMO,
              '-' AS APROVADOR, DATE '2023-01-01' AS DATA_APROVACAO, CAST(early AS SMALLINT) AS TIPO_DESCONTO, CAST(approved AS SMALLINT) AS STATUS_APROVACAO FROM tiers""",
)
def q10_tiers(f: Frames) -> DataFrame:
    return in_cents(seeded(f).tiers.drop("DESCRICAO"), "MINIMO", "MAXIMO")


LINE = "(l_orderkey * 7 + l_linenumber)"
GOOD_LINE = """CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR) || ',"Part ""' || CAST(l_partkey AS VARCHAR) || '"", ' || l_returnflag || '",' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"""


FILE_ROWS = 1_000_000
"""Lines of a file of the feed, at most."""


def feed_folder(f: Frames, file_rows: int = FILE_ROWS) -> str:
    """Line items as CSV files of three lots: a byte order mark, CRLF, blank lines, quoted commas, and three kinds of broken lines."""
    number, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    mark = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    part = F.concat(F.lit('"Part ""'), F.col("l_partkey").cast("string"), F.lit('"", '), F.col("l_returnflag"), F.lit('"'))
    good = F.concat_ws(",", number, line, part, F.col("l_quantity").cast("int").cast("string"))
    text = (
        F.when(mark % 29 == 0, F.concat_ws(",", number, line))
        .when(mark % 31 == 0, F.concat(good, F.lit(",one too many")))
        .when(mark % 37 == 0, F.concat_ws(",", number, line, F.lit('"Part'), F.lit("5")))
        .otherwise(good)
    )
    rows = f.table("lineitem").select((F.col("l_orderkey") % 3).cast("int").alias("lote"), F.lit(1).alias("at"), text.alias("value"))
    # a lot of many lines is many files, each with its header, so that no task sorts more than a file of any lot
    files = max(1, -(-rows.count() // file_rows))
    rows = rows.withColumn("parte", F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int"))
    every = f.spark.range(3 * files).select((F.col("id") % 3).cast("int").alias("lote"), F.floor(F.col("id") / 3).cast("int").alias("parte"))
    heads = every.withColumns({"at": F.lit(0), "value": F.lit("\ufeffNUMERO,LINHA,DESCRICAO,QTD")})
    blanks = every.withColumns({"at": F.lit(2), "value": F.lit("")})
    folder = f"{shared_folder(f.spark)}/feed-{uuid4()}"
    place = ["lote", "parte"]
    lines = heads.unionByName(rows).unionByName(blanks).repartitionByRange(3 * files, *place).sortWithinPartitions(*place, "at")
    lines.select(*place, "value").write.partitionBy(*place).option("lineSep", "\r\n").text(folder)
    return f"{folder}/lote=*/parte=*"


FEED_FIELDS = ("NUMERO", "LINHA", "DESCRICAO", "QTD")
BROKEN = f"{LINE} % 29 = 0 OR {LINE} % 31 = 0 OR {LINE} % 37 = 0"


@query(
    "s2_csv_raw_scan",
    f"""SELECT CAST(l_orderkey AS VARCHAR) AS NUMERO, CAST(l_linenumber AS VARCHAR) AS LINHA, 'Part "' || CAST(l_partkey AS VARCHAR) || '", ' || l_returnflag AS DESCRICAO,
               CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS QTD FROM lineitem WHERE NOT ({BROKEN})""",
)
def s2(f: Frames) -> DataFrame:
    return scan_csv(f.spark, feed_folder(f), FEED_FIELDS).rows


@query(
    "s2_csv_malformed_lines",
    f"""SELECT CAST(l_orderkey % 3 AS INTEGER) AS lote,
               CASE WHEN {LINE} % 29 = 0 THEN CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR)
                    WHEN {LINE} % 31 = 0 THEN {GOOD_LINE} || ',one too many'
                    ELSE CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR) || ',"Part,5' END AS LINHA FROM lineitem WHERE {BROKEN}""",
)
def s2_malformed(f: Frames) -> DataFrame:
    broken = scan_csv(f.spark, feed_folder(f), FEED_FIELDS).malformed
    return broken.select(F.regexp_extract("ARQUIVO", r"lote=(\d)", 1).cast("int").alias("lote"), "LINHA")


@query(
    "s1_csv_typed_scan",
    f"""SELECT l_orderkey AS NUMERO, CAST(l_linenumber AS INTEGER) AS LINHA, NULL::DATE AS DESCRICAO, CAST(CAST(l_quantity AS INTEGER) * 100 AS BIGINT) AS QTD
        FROM lineitem WHERE NOT ({BROKEN})""",
)
def s1(f: Frames) -> DataFrame:
    """Bound to types by position; a field that does not parse, here a date that is none, is NULL."""
    schema = optional(NUMERO=LongType(), LINHA=IntegerType(), DESCRICAO=DateType(), QTD=MONEY)
    return in_cents(scan_csv(f.spark, feed_folder(f), schema).rows, "QTD")


@query("s4_append_sink", "SELECT o_orderkey, o_orderstatus FROM orders")
def s4(f: Frames) -> DataFrame:
    """A table grown by three appends."""
    path = f"{shared_folder(f.spark)}/grown-{uuid4()}"
    orders = f.table("orders").select("o_orderkey", "o_orderstatus")
    for part in range(3):
        orders.where(F.col("o_orderkey") % 3 == part).write.mode("append").parquet(path)
    return f.spark.read.schema(orders.schema).parquet(path)


@query("s5_overwrite_sink", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0")
def s5(f: Frames) -> DataFrame:
    """A table replaced by another one, as the view of the open month is."""
    path = f"{shared_folder(f.spark)}/replaced-{uuid4()}"
    orders = f.table("orders").select("o_orderkey", "o_orderstatus")
    orders.where(F.col("o_orderkey") % 2 == 1).write.parquet(path)
    orders.where(F.col("o_orderkey") % 2 == 0).write.mode("overwrite").parquet(path)
    return f.spark.read.schema(orders.schema).parquet(path)


@query(
    "p16_scalar_lookup",
    "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) < (SELECT max(VAR_DT_INICIAL) FROM parsed WHERE COD = 2)",
)
def p16(f: Frames) -> DataFrame:
    """One value of the parameters, looked up by its code, in a later filter."""
    parsed = params.parse_parameters(f.parameters()).where("COD = 2").groupBy("COD").agg(F.max("VAR_DT_INICIAL").alias("VAR_DT_INICIAL"))
    day = params.parameter_value(parsed, 2, "VAR_DT_INICIAL")
    return f.table("orders").where(F.to_date("o_orderdate") < F.lit(day)).select("o_orderkey")


def in_sql(f: Frames, frame: DataFrame, text: str) -> DataFrame:
    """A query as text, over a temporary view and the library's SQL functions."""
    register_functions(f.spark)
    view = f"rows_{uuid4().hex}"
    frame.createTempView(view)
    try:
        return f.spark.sql(text.format(view=view))
    finally:
        f.spark.catalog.dropTempView(view)


@query("p7_tax_id_valid_in_sql", f"SELECT o_orderkey, tax_text, {sql.valid_tax_id('tax_text')} AS valid FROM ({TAX_TEXT})")
def p7_in_sql(f: Frames) -> DataFrame:
    return in_sql(f, p7(f).drop("valid"), "SELECT o_orderkey, tax_text, cnpj_valid(tax_text) AS valid FROM {view}")


@query("p10_normalize_term_in_sql", f"SELECT o_orderkey, {sql.normalized(sql.pick(RAW_TERMS, f'o_orderkey % {len(RAW_TERMS)}'))} AS term FROM orders")
def p10_in_sql(f: Frames) -> DataFrame:
    terms = f.table("orders").select("o_orderkey", raw_term(F.col("o_orderkey")).alias("raw"))
    return in_sql(f, terms, "SELECT o_orderkey, normalized_term(raw) AS term FROM {view}")

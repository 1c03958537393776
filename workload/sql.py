"""The domain frames and queries once more, as SQL over the given tables.

Money is in integer cents here. ``oracle`` puts the common table expressions a query
needs in front of it.
"""

from __future__ import annotations

import re

from .frames import ADDRESS_TYPES, RAW_TERMS

# fixed values, written out once more so that an error in the library's own shows: weights of the
# tax id's digits, payment terms (description, instalments, down payment), tolerance tiers (days
# from, to, hundredths of a percent from, to, early, approved); ids are positions
FIRST_WEIGHTS = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
SECOND_WEIGHTS = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
TERMS = [
    ("A vista", 1, 1),
    ("30 dias", 1, 0),
    ("30/60 dias", 2, 0),
    ("30/60/90 dias", 3, 0),
    ("Entrada/30 dias", 2, 1),
    ("Entrada/30/60 dias", 3, 1),
    ("Entrada/30/60/90 dias", 4, 1),
]
TIERS = [
    (0, 0, 0, 0, 0, 1),
    (11, 11, 301, 500, 1, 1),
    (6, 10, 200, 300, 1, 1),
    (1, 5, 100, 190, 1, 1),
    (1, 5, 50, 150, 0, 1),
    (6, 10, 160, 200, 0, 1),
    (11, 11, 200, 200, 0, 1),
    (5, 10, 200, 500, 0, 0),
    (-1, -1, -100, -100, 0, 1),
]


def cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def cents_of(text: str) -> str:
    """Cents of an amount given as text, NULL where it does not parse."""
    return f"CAST(TRY_CAST(trim({text}) AS DECIMAL(16,2)) * 100 AS BIGINT)"


def _dot(text: str, weights: tuple[int, ...]) -> str:
    return " + ".join(f"CAST(substr({text}, {i}, 1) AS INTEGER) * {w}" for i, w in enumerate(weights, start=1))


def _check(total: str) -> str:
    return f"(CASE WHEN ({total}) % 11 < 2 THEN 0 ELSE 11 - ({total}) % 11 END)"


def tax_ids(table: str, key: str) -> str:
    """Every key of a table with its tax id, and with the one whose check digits are off by one."""
    return f"""
        SELECT k, t AS good, substr(t, 1, 12) || lpad(CAST((CAST(substr(t, 13, 2) AS INTEGER) + 1) % 100 AS VARCHAR), 2, '0') AS off FROM (
          SELECT k, b || d1 || CAST({_check(_dot("(b || d1)", SECOND_WEIGHTS))} AS VARCHAR) AS t FROM (
            SELECT k, b, CAST({_check(_dot("b", FIRST_WEIGHTS))} AS VARCHAR) AS d1 FROM (
              SELECT DISTINCT {key} AS k, lpad(CAST({key} AS VARCHAR), 8, '0') || '0001' AS b FROM {table})))"""


def dotted(tax: str) -> str:
    return f"(substr({tax}, 1, 2) || '.' || substr({tax}, 3, 6) || '/' || substr({tax}, 9, 4) || '-' || substr({tax}, 13, 2))"


def typed_tax_id(order: str) -> str:
    """A party's tax id as the feeds have it, of a row joined to the tax ids ``x``."""
    tax = f"(CASE WHEN {order} % 29 = 0 THEN x.off ELSE x.good END)"
    return f"CASE WHEN {order} % 71 = 0 THEN {tax} || chr(10) WHEN {order} % 13 = 0 THEN {dotted(tax)} ELSE {tax} END"


def bare_tax_id(text: str) -> str:
    return f"regexp_replace({text}, '[.,\"''/-]', '', 'g')"


def valid_tax_id(text: str) -> str:
    digits = f"regexp_replace({text}, '[.,\"''/-]', '', 'g')"
    first = _check(_dot(digits, FIRST_WEIGHTS))
    second = _check(_dot(digits, SECOND_WEIGHTS))
    return f"""(CASE WHEN {text} IS NOT NULL AND regexp_full_match({digits}, '[0-9]{{14}}')
                     THEN {first} = CAST(substr({digits}, 13, 1) AS INTEGER) AND {second} = CAST(substr({digits}, 14, 1) AS INTEGER)
                     ELSE false END)"""


def pick(values: list[str], place: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {place} {cases} END)"


def broken(every: int, bad: str, good: str, defect: str) -> str:
    return f"CASE WHEN {defect} % {every} = 0 THEN {bad} ELSE {good} END"


def normalized(term: str) -> str:
    return f"""(CASE WHEN substr({term}, 2, 4) LIKE '%ntra%' THEN {term}
                     WHEN {term} LIKE '%90 dias' OR {term} LIKE '%noventa dias' THEN '30/60/90 dias'
                     WHEN {term} LIKE '%60 dias' THEN '30/60 dias'
                     WHEN {term} LIKE '%vista' THEN 'A vista'
                     ELSE {term} END)"""


def reason(name: str, tax_ok: str, postal_ok: str) -> str:
    return f"""(CASE WHEN {name} IS NULL THEN 'NOME_NULO'
                     WHEN NOT {tax_ok} THEN 'CNPJ_INVALIDO'
                     WHEN NUMERO_NF IS NULL THEN 'NUMERO_NF_NULO'
                     WHEN DATA_EMISSAO IS NULL THEN 'DATA_EMISSAO_NULO'
                     WHEN VALOR_NET IS NULL THEN 'VALOR_NET_NULO'
                     WHEN VALOR_TRIBUTO IS NULL THEN 'VALOR_NET_NULO'
                     WHEN VALOR_TOTAL IS NULL THEN 'VALOR_TOTAL'
                     WHEN NOME_ITEM IS NULL THEN 'NOME_ITEM_NULO'
                     WHEN CONDICAO_PAGAMENTO IS NULL THEN 'CONDICAO_PAGAMENTO_NULO'
                     WHEN NOT {postal_ok} THEN 'CEP_INVALIDO'
                     WHEN TIPO_ENDERECO IS NULL THEN 'TIPO_ENDERECO_NULO'
                     ELSE 'OK' END)"""


def _values(rows: list[tuple], columns: str) -> str:
    body = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


_ORDER = "(l_orderkey + l_partkey)"


def _feed_ctes(side: str, name: str, tax: str, email: str, phone: str, default_email: bool) -> dict[str, str]:
    """From typed feed to the eight ingest outputs of one side of the books."""
    mail = f"coalesce({email}, 'N/A')" if default_email else email
    known = "CASE WHEN email IS NOT NULL AND email <> 'N/A' THEN 1 ELSE 0 END"
    return {
        f"{side}_validated": f"""
            SELECT *, {reason("name", "tax_ok", "postal_ok")} AS MOTIVO FROM (
              SELECT DISTINCT upper({name}) AS name, CASE WHEN {valid_tax_id(tax)} THEN {bare_tax_id(tax)} ELSE {tax} END AS tax, {mail} AS email, {phone} AS phone,
                     NUMERO_NF, DATA_EMISSAO, VALOR_NET, VALOR_TRIBUTO, VALOR_TOTAL, NOME_ITEM, QTD_ITEM, CONDICAO_PAGAMENTO, CEP,
                     coalesce(NUM_ENDERECO, 0) AS num, coalesce(COMPLEMENTO, 'N/A') AS compl, TIPO_ENDERECO, DATA_PROCESSAMENTO,
                     {valid_tax_id(tax)} AS tax_ok, CEP IN (SELECT CEP FROM postal_codes) AS postal_ok
              FROM {side}_typed f
              WHERE NOT EXISTS (SELECT 1 FROM {side}_log l WHERE l.NUMERO_NF = f.NUMERO_NF AND l.DATA_PROCESSAMENTO = f.DATA_PROCESSAMENTO))""",
        f"{side}_accepted": f"SELECT * FROM {side}_validated WHERE MOTIVO = 'OK'",
        f"{side}_offered": f"""
            SELECT tax, name, email, phone FROM (
              SELECT *, row_number() OVER (PARTITION BY tax ORDER BY DATA_PROCESSAMENTO DESC, NUMERO_NF DESC, {known} DESC,
                                           name DESC, email DESC NULLS LAST, phone DESC) AS rn FROM {side}_accepted) WHERE rn = 1""",
        f"{side}_entering": f"""
            SELECT (SELECT max(id) FROM {side}_parties) + row_number() OVER (ORDER BY substr(md5(tax), 1, 3), tax) AS id, tax, name, email, phone
            FROM {side}_offered WHERE tax NOT IN (SELECT tax FROM {side}_parties)""",
        f"{side}_party_ids": f"SELECT tax, min(id) AS id FROM {side}_parties GROUP BY tax UNION ALL SELECT tax, id FROM {side}_entering",
        f"{side}_located": f"""
            SELECT p.id, t.type_id, d.CEP, d.num, d.compl FROM (
              SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY tax, CEP ORDER BY DATA_PROCESSAMENTO DESC, NUMERO_NF DESC,
                    (CASE WHEN num <> 0 THEN 1 ELSE 0 END + CASE WHEN compl <> 'N/A' THEN 1 ELSE 0 END) DESC,
                    TIPO_ENDERECO DESC, num DESC, compl DESC) AS rn FROM {side}_accepted) WHERE rn = 1) d
            LEFT JOIN address_types t ON t.label = d.TIPO_ENDERECO JOIN {side}_party_ids p ON p.tax = d.tax""",
    }


CTES: dict[str, str] = {
    "terms": _values([(i, *t) for i, t in enumerate(TERMS, start=1)], "ID_CONDICAO, DESCRICAO, QTD, ENTRADA"),
    "tiers": _values([(i, *t) for i, t in enumerate(TIERS, start=1)], "ID_DESCONTO, low_days, high_days, low_bp, high_bp, early, approved"),
    "address_types": _values([(i, n) for i, n in enumerate(ADDRESS_TYPES, start=1)], "type_id, label"),
    "flow_in": f"SELECT CAST(o_orderdate AS DATE) AS d, {cents('o_totalprice')} AS c FROM orders",
    "flow_out": f"SELECT CAST(l_shipdate AS DATE) AS d, {cents('l_extendedprice')} AS c FROM lineitem",
    "flow_day": """
        SELECT coalesce(i.d, o.d) AS d, coalesce(o.c, 0) AS c_out, coalesce(i.c, 0) AS c_in
        FROM (SELECT d, CAST(sum(c) AS BIGINT) AS c FROM flow_in GROUP BY d) i
        FULL OUTER JOIN (SELECT d, CAST(sum(c) AS BIGINT) AS c FROM flow_out GROUP BY d) o ON i.d = o.d""",
    "flow_month": """
        SELECT last_day(d) AS m, CAST(sum(c_out) AS BIGINT) AS c_out, CAST(sum(c_in) AS BIGINT) AS c_in FROM flow_day GROUP BY last_day(d)""",
    "invoices": f"""
        SELECT o_orderkey AS id, o_orderkey % 8 + 1 AS term, CAST(o_orderdate AS DATE) AS issued, {cents('o_totalprice')} AS c FROM orders""",
    "instalments": """
        SELECT id, CAST(issued + to_months(CAST(k - entrada AS INTEGER)) AS DATE) AS due, k, c AS total, qtd,
               CAST((2 * c + qtd) // (2 * qtd) AS BIGINT) AS val, id * 10 + k AS prog
        FROM (SELECT i.id, i.issued, i.c, t.QTD AS qtd, t.ENTRADA AS entrada, unnest(range(1, t.QTD + 1)) AS k
              FROM invoices i JOIN terms t ON t.ID_CONDICAO = i.term)""",
    "receipts": """
        SELECT id, due, due + CAST((id + k) % 25 - 12 AS INTEGER) AS received, CAST(val * (10000 + ((id + k) % 13 - 6) * 50) // 10000 AS BIGINT) AS r
        FROM instalments WHERE (id * 7 + k) % 4 <> 0""",
    "met": "SELECT s.*, r.received, r.r FROM receipts r JOIN instalments s ON s.id = r.id AND s.due = r.due",
    "judged": """
        SELECT prog, id, due, val, r, received, abs(received - due) AS days, received < due AS early,
               (received >= due AND r < val) AS underpaid FROM met""",
    "matched": """
        SELECT j.*, t.ID_DESCONTO, t.approved FROM judged j JOIN tiers t
          ON j.days BETWEEN t.low_days AND t.high_days AND j.early = (t.early = 1)
         AND CASE WHEN j.underpaid THEN -100 BETWEEN t.low_bp AND t.high_bp
                  ELSE abs(j.r - j.val) * 10000 BETWEEN t.low_bp * j.val AND t.high_bp * j.val AND j.val <> 0 END""",
    "payment_rows": """
        SELECT id, due, due + CAST((id + k) % 15 - 7 AS INTEGER) AS paid_on, CASE WHEN (id + k) % 17 = 0 THEN NULL ELSE val END AS paid
        FROM instalments WHERE (id + k) % 3 <> 0""",
    "paid_rows": """
        SELECT s.prog, s.id, s.k, s.due, p.paid_on, s.val, p.paid FROM payment_rows p
        JOIN instalments s ON s.id = p.id AND s.due = p.due WHERE s.id % 4 <> 0 AND p.paid IS NOT NULL""",
    "supplier_tax": tax_ids("lineitem", "l_suppkey"),
    "customer_tax": tax_ids("orders", "o_custkey"),
    "postal_codes": "SELECT CAST(1001000 + n_nationkey AS VARCHAR) AS CEP FROM nation WHERE n_nationkey < 20",
    "purchase_feed": f"""
        SELECT {broken(23, "NULL", "'Supplier ' || CAST(l_suppkey AS VARCHAR)", _ORDER)} AS NOME_FORNECEDOR,
               {typed_tax_id("l_orderkey")} AS CNPJ_FORNECEDOR,
               CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE 's' || CAST(l_suppkey AS VARCHAR) || '@mail.test' END AS EMAIL_FORNECEDOR,
               '55-' || CAST(l_suppkey AS VARCHAR) AS TELEFONE_FORNECEDOR,
               {broken(31, "'abc'", "' ' || CAST(l_orderkey AS VARCHAR) || ' '", _ORDER)} AS NUMERO_NF,
               {broken(37, "'not a date'", "CAST(CAST(l_shipdate AS DATE) AS VARCHAR)", _ORDER)} AS DATA_EMISSAO,
               {broken(41, "NULL", "CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR)", _ORDER)} AS VALOR_NET,
               {broken(43, "''", "'1.50'", _ORDER)} AS VALOR_TRIBUTO,
               {broken(47, "'x'", "' ' || CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR)", _ORDER)} AS VALOR_TOTAL,
               {broken(53, "NULL", "'Part ' || CAST(l_partkey AS VARCHAR)", _ORDER)} AS NOME_ITEM,
               CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS QTD_ITEM,
               {broken(59, "NULL", pick(RAW_TERMS, f"l_orderkey % {len(RAW_TERMS)}"), _ORDER)} AS CONDICAO_PAGAMENTO,
               CAST(1001000 + (l_suppkey + l_orderkey) % 25 AS VARCHAR) AS CEP,
               CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS NUM_ENDERECO,
               CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE 'Sala ' || CAST(l_orderkey % 4 AS VARCHAR) END AS COMPLEMENTO,
               {broken(61, "NULL", pick(["cobranca", "entrega", "faturamento"], "l_linenumber % 3"), _ORDER)} AS TIPO_ENDERECO,
               CAST(CAST(l_shipdate AS DATE) + 1 AS VARCHAR) AS DATA_PROCESSAMENTO
        FROM lineitem JOIN supplier_tax x ON x.k = l_suppkey""",
    "purchases_typed": f"""
        SELECT NOME_FORNECEDOR, CNPJ_FORNECEDOR, EMAIL_FORNECEDOR, TELEFONE_FORNECEDOR,
               TRY_CAST(trim(NUMERO_NF) AS INTEGER) AS NUMERO_NF, TRY_CAST(trim(DATA_EMISSAO) AS DATE) AS DATA_EMISSAO,
               {cents_of("VALOR_NET")} AS VALOR_NET, {cents_of("VALOR_TRIBUTO")} AS VALOR_TRIBUTO, {cents_of("VALOR_TOTAL")} AS VALOR_TOTAL,
               NOME_ITEM, TRY_CAST(trim(QTD_ITEM) AS INTEGER) AS QTD_ITEM, CONDICAO_PAGAMENTO, CEP,
               TRY_CAST(trim(NUM_ENDERECO) AS INTEGER) AS NUM_ENDERECO, COMPLEMENTO, upper(TIPO_ENDERECO) AS TIPO_ENDERECO,
               TRY_CAST(trim(DATA_PROCESSAMENTO) AS DATE) AS DATA_PROCESSAMENTO
        FROM purchase_feed""",
    "purchases_log": "SELECT CAST(l_orderkey AS INTEGER) AS NUMERO_NF, CAST(l_shipdate AS DATE) + 1 AS DATA_PROCESSAMENTO FROM lineitem WHERE l_orderkey % 3 = 0",
    "sales_typed": f"""
        SELECT {broken(23, "NULL", "'Customer ' || CAST(o_custkey AS VARCHAR)", "o_orderkey")} AS NOME,
               {typed_tax_id("o_orderkey")} AS CNPJ,
               {broken(5, "NULL", "'c' || CAST(o_custkey AS VARCHAR) || '@mail.test'", "o_orderkey")} AS EMAIL,
               '55-' || CAST(o_custkey AS VARCHAR) AS TELEFONE,
               {broken(31, "NULL", "CAST(o_orderkey AS INTEGER)", "o_orderkey")} AS NUMERO_NF,
               {broken(37, "NULL", "CAST(o_orderdate AS DATE)", "o_orderkey")} AS DATA_EMISSAO,
               {broken(41, "NULL", cents("o_totalprice"), "o_orderkey")} AS VALOR_NET,
               {broken(43, "NULL", "CAST(150 AS BIGINT)", "o_orderkey")} AS VALOR_TRIBUTO,
               {broken(47, "NULL", cents("o_totalprice"), "o_orderkey")} AS VALOR_TOTAL,
               {broken(53, "NULL", "'Item ' || CAST(o_orderkey % 100 AS VARCHAR)", "o_orderkey")} AS NOME_ITEM,
               CAST(o_orderkey % 9 + 1 AS INTEGER) AS QTD_ITEM,
               {broken(59, "NULL", pick(RAW_TERMS, f"o_orderkey % {len(RAW_TERMS)}"), "o_orderkey")} AS CONDICAO_PAGAMENTO,
               CAST(1001000 + (o_custkey + o_orderkey) % 25 AS VARCHAR) AS CEP,
               {broken(11, "NULL", "CAST(o_orderkey % 500 AS INTEGER)", "o_orderkey")} AS NUM_ENDERECO,
               {broken(3, "NULL", "'Sala ' || CAST(o_orderkey % 4 AS VARCHAR)", "o_orderkey")} AS COMPLEMENTO,
               {broken(61, "NULL", pick(ADDRESS_TYPES, "o_orderkey % 3"), "o_orderkey")} AS TIPO_ENDERECO,
               CAST(o_orderdate AS DATE) + 1 AS DATA_PROCESSAMENTO
        FROM orders JOIN customer_tax x ON x.k = o_custkey""",
    "sales_log": "SELECT CAST(o_orderkey AS INTEGER) AS NUMERO_NF, CAST(o_orderdate AS DATE) + 1 AS DATA_PROCESSAMENTO FROM orders WHERE o_orderkey % 3 = 0",
    "known_supplier_tax": tax_ids("supplier", "s_suppkey"),
    "known_customer_tax": tax_ids("customer", "c_custkey"),
    "purchases_parties": """
        SELECT k AS id, CASE WHEN k % 5 = 0 THEN 'OLD NAME' ELSE 'SUPPLIER ' || CAST(k AS VARCHAR) END AS name, good AS tax,
               CASE WHEN k % 4 = 0 THEN NULL ELSE 's' || CAST(k AS VARCHAR) || '@mail.test' END AS email, '55-' || CAST(k AS VARCHAR) AS phone
        FROM known_supplier_tax WHERE k % 11 <> 0""",
    "sales_parties": """
        SELECT k AS id, CASE WHEN k % 5 = 0 THEN 'OLD NAME' ELSE 'CUSTOMER ' || CAST(k AS VARCHAR) END AS name, good AS tax,
               CASE WHEN k % 4 = 0 THEN NULL ELSE 'c' || CAST(k AS VARCHAR) || '@mail.test' END AS email, '55-' || CAST(k AS VARCHAR) AS phone
        FROM known_customer_tax WHERE k % 11 <> 0""",
    "purchases_addresses": """
        SELECT s_suppkey AS id, 1 AS type_id, CAST(1001000 + s_suppkey % 25 AS VARCHAR) AS CEP, CAST(s_suppkey % 7 AS INTEGER) AS num, 'Sala 1' AS compl
        FROM supplier WHERE s_suppkey % 11 <> 0""",
    "sales_addresses": """
        SELECT c_custkey AS id, 1 AS type_id, CAST(1001000 + c_custkey % 25 AS VARCHAR) AS CEP, CAST(c_custkey % 7 AS INTEGER) AS num, 'Sala 1' AS compl
        FROM customer WHERE c_custkey % 11 <> 0""",
    "parameters": """
        SELECT o_orderkey AS ROW_ID, CAST(o_orderkey % 5 AS INTEGER) AS COD,
               o_orderpriority || ',' || d || CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE
                 ',' || CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE d END || ',' || d || ',' ||
                 CASE WHEN o_orderkey % 8 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 40 AS VARCHAR) END || ',' || CAST(o_orderkey % 2 AS VARCHAR) END AS DESCRICAO
        FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders)""",
    "parsed": """
        SELECT ROW_ID, COD, DESCRICAO, p[1] AS VAR_DESCRICAO, TRY_CAST(p[2] AS DATE) AS VAR_DT_INICIAL, TRY_CAST(p[3] AS DATE) AS VAR_DT_FINAL,
               TRY_CAST(p[4] AS DATE) AS VAR_DT_ATUAL, TRY_CAST(p[5] AS INTEGER) AS VAR_EXPURGO, TRY_CAST(p[6] AS INTEGER) AS VAR_STATUS
        FROM (SELECT *, string_split(DESCRICAO, ',') AS p FROM parameters)""",
    **_feed_ctes("purchases", "NOME_FORNECEDOR", "CNPJ_FORNECEDOR", "EMAIL_FORNECEDOR", "TELEFONE_FORNECEDOR", True),
    **_feed_ctes("sales", "NOME", "CNPJ", "EMAIL", "TELEFONE", False),
}


def _cycle_ctes(side: str) -> dict[str, str]:
    """Instalments of the invoices that one side's ingest accepts."""
    return {
        f"{side}_planned": f"""
            SELECT inv, NUMERO_NF, k, CAST(issued + to_months(CAST(k - entrada AS INTEGER)) AS DATE) AS due, CAST((2 * c + qtd) // (2 * qtd) AS BIGINT) AS val
            FROM (SELECT row_number() OVER () AS inv, a.NUMERO_NF, a.DATA_EMISSAO AS issued, a.VALOR_TOTAL AS c, t.QTD AS qtd, t.ENTRADA AS entrada, unnest(range(1, t.QTD + 1)) AS k
                  FROM {side}_accepted a JOIN {side}_party_ids p ON p.tax = a.tax JOIN terms t ON t.DESCRICAO = {normalized("a.CONDICAO_PAGAMENTO")})"""
    }


CTES |= _cycle_ctes("purchases") | _cycle_ctes("sales")
CTES |= {
    "cycle_paid": """
        SELECT due + CAST((day(due) + k) % 15 - 7 AS INTEGER) AS d, val AS c FROM purchases_planned WHERE (day(due) + k) % 3 <> 0 AND (day(due) + k) % 17 <> 0""",
    "cycle_met": """
        SELECT NUMERO_NF, k, val, due, due + CAST((day(due) + k) % 25 - 12 AS INTEGER) AS received, CAST(val * (10000 + ((day(due) + k) % 13 - 6) * 50) // 10000 AS BIGINT) AS r
        FROM sales_planned WHERE (day(due) * 7 + k) % 4 <> 0""",
    "cycle_matched": """
        SELECT j.NUMERO_NF, j.k, j.received, j.r, t.ID_DESCONTO FROM cycle_met j JOIN tiers t
          ON abs(j.received - j.due) BETWEEN t.low_days AND t.high_days AND (j.received < j.due) = (t.early = 1)
         AND CASE WHEN j.received >= j.due AND j.r < j.val THEN -100 BETWEEN t.low_bp AND t.high_bp
                  ELSE abs(j.r - j.val) * 10000 BETWEEN t.low_bp * j.val AND t.high_bp * j.val AND j.val <> 0 END""",
    "cycle_received": """
        SELECT received AS d, r AS c FROM (SELECT DISTINCT * FROM cycle_matched)
        UNION ALL SELECT received, r FROM cycle_met m WHERE NOT EXISTS (SELECT 1 FROM cycle_matched x WHERE x.NUMERO_NF = m.NUMERO_NF AND x.k = m.k)""",
    "cycle_flows": "SELECT d, 0 AS c_in, c AS c_out FROM cycle_paid UNION ALL SELECT d, c, 0 FROM cycle_received",
}


def oracle(query: str) -> str:
    """The query with the common table expressions it uses, in order of need."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(query)
    if not needed:
        return query
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in needed) + "\n" + query

"""Domain frames derived from the given tables. Every frame has a twin of the same name in ``sql.py``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashloom.functions.taxid import check_number
from cashloom.operators.quality import trim_cast_columns
from cashloom.operators.schedule import attach_terms, generate_instalments
from cashloom.presets import FEED_CASTS, term_table

TODAY = date(2000, 6, 15)
FIRST_RUN = date(2000, 1, 15)
STAMP = date(2000, 6, 15)
TAX = "__tax"

# fixed values: the address types and the terms as feeds write them
ADDRESS_TYPES = ["COBRANCA", "ENTREGA", "FATURAMENTO"]
RAW_TERMS = ["a vista", "30 dias", "60 dias", "noventa dias", "Entrada/30 dias", "30/60/90 dias", "Entrada/30/60 dias"]


class Frames:
    """The frames of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- cash movements ------------------------------------------------------------------

    def receipts_posted(self, *more: str) -> DataFrame:
        return self.table("orders").select(
            *more, at_hour("o_orderdate", F.col("o_orderkey") % 24).alias("DATA_RECEBIDO"), money("o_totalprice").alias("VALOR_PAGO")
        )

    def payments_posted(self, *more: str) -> DataFrame:
        return self.table("lineitem").select(
            *more, at_hour("l_shipdate", F.col("l_orderkey") % 24).alias("DATA_PGT_EFETUADO"), money("l_extendedprice").alias("VALOR_PARCELA_PAGO")
        )

    # -- invoices and schedules ----------------------------------------------------------

    def invoices(self, invoice_id: str = "ID_NF_SAIDA") -> DataFrame:
        key = F.col("o_orderkey")
        return self.table("orders").select(
            key.alias(invoice_id),
            (key % 8 + 1).cast("int").alias("ID_CONDICAO"),
            key.alias("NUMERO_NF"),
            F.to_date("o_orderdate").alias("DATA_EMISSAO"),
            money("o_totalprice").alias("VALOR_TOTAL"),
        )

    def terms(self) -> DataFrame:
        return term_table(self.spark)

    def instalments(self, invoice_id: str, status: str) -> DataFrame:
        return generate_instalments(attach_terms(self.invoices(invoice_id), self.terms()), invoice_id=invoice_id, status=status)

    def receivable_schedule(self) -> DataFrame:
        plan = self.instalments("ID_NF_SAIDA", "STATUS_RECEBIMENTO")
        return plan.select((F.col("ID_NF_SAIDA") * 10 + F.col("NUM_PARCELAS")).alias("ID_PROG_RECEBIMENTO"), *plan.columns)

    def payable_schedule(self) -> DataFrame:
        plan = self.instalments("ID_NF_ENTRADA", "STATUS_PAGAMENTO")
        settled = F.when(F.col("ID_NF_ENTRADA") % 4 == 0, 1).otherwise(0)
        return plan.withColumn("STATUS_PAGAMENTO", settled).select(
            (F.col("ID_NF_ENTRADA") * 10 + F.col("NUM_PARCELAS")).alias("ID_PROG_PAGAMENTO"), *plan.columns
        )

    def receipts(self) -> DataFrame:
        number, part = F.col("ID_NF_SAIDA"), F.col("NUM_PARCELAS")
        shift = ((number + part) % 25 - 12).cast("int")
        factor = 10000 + ((number + part) % 13 - 6) * 50
        value = F.call_function("div", (F.col("VALOR_PARCELA") * 100).cast("long") * factor, F.lit(10000).cast("long"))
        return (
            self.receivable_schedule()
            .where((number * 7 + part) % 4 != 0)
            .select(
                number.alias("NUMERO_NF"),
                "DATA_VENCIMENTO",
                F.date_add("DATA_VENCIMENTO", shift).alias("DATA_RECEBIMENTO"),
                (value.cast("decimal(18,0)") / 100).cast("decimal(16,2)").alias("VALOR_RECEBIDO"),
            )
        )

    def receipt_history(self) -> DataFrame:
        return self.receivable_schedule().where(F.col("ID_NF_SAIDA") % 10 == 1).select("ID_PROG_RECEBIMENTO")

    def settlements(self) -> DataFrame:
        """Schedule rows with the receipt that meets them, without going through the invoices.

        Both sides are spelled out of orders that were shuffled by their key, once and before they
        become instalments. The due dates are no key of the join, which would shuffle the instalments too.
        """
        placed = PlacedOrders(self.spark, self.folder)
        receipts = placed.receipts().withColumnsRenamed({"NUMERO_NF": "ID_NF_SAIDA", "DATA_VENCIMENTO": "__due"})
        met = placed.receivable_schedule().join(receipts, "ID_NF_SAIDA").where(F.datediff("__due", "DATA_VENCIMENTO") == 0)
        return met.select(
            "ID_PROG_RECEBIMENTO", "DATA_VENCIMENTO", "VALOR_PARCELA", "VALOR_RECEBIDO", "DATA_RECEBIMENTO"
        )

    def payment_file(self) -> DataFrame:
        """Payments as a text file has them: blanks around values, some amounts unreadable."""
        number, part = F.col("ID_NF_ENTRADA"), F.col("NUM_PARCELAS")
        shift = ((number + part) % 15 - 7).cast("int")
        amount = F.when((number + part) % 17 == 0, F.lit("?")).otherwise(F.concat(F.lit(" "), F.col("VALOR_PARCELA").cast("string")))
        return (
            self.payable_schedule()
            .where((number + part) % 3 != 0)
            .select(
                F.concat(number.cast("string"), F.lit(" ")).alias("ID_NF_ENTRADA"),
                F.col("DATA_VENCIMENTO").cast("string").alias("DATA_VENCIMENTO"),
                F.date_add("DATA_VENCIMENTO", shift).cast("string").alias("DATA_PGT_EFETUADO"),
                amount.alias("VALOR_PGT_EFETUADO"),
            )
        )

    def payments(self) -> DataFrame:
        typed = trim_cast_columns(
            self.payment_file(),
            {
                "ID_NF_ENTRADA": "long",
                "DATA_VENCIMENTO": "date",
                "DATA_PGT_EFETUADO": "date",
                "VALOR_PGT_EFETUADO": "decimal(10,2)",
            },
        )
        return typed.withColumnRenamed("VALOR_PGT_EFETUADO", "VALOR_PARCELA_PAGO")

    # -- feeds ---------------------------------------------------------------------------

    def _with_tax(self, table: str, key: Column, order: Column) -> DataFrame:
        """A feed's table with the party's tax id in a column of its own, computed once a row however often it is typed out."""
        return self.table(table).withColumn(TAX, tax_id(key, wrong=order % 29 == 0))

    def purchase_feed(self) -> DataFrame:
        """Line items as a purchase feed of text columns, with every defect the rules look for."""
        order, supplier, number = F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_linenumber")
        defect = order + F.col("l_partkey")

        def broken(every: int, bad: Column, good: Column) -> Column:
            return F.when(defect % every == 0, bad).otherwise(good)

        none = F.lit(None).cast("string")
        value = money("l_extendedprice").cast("string")
        shipped = F.to_date("l_shipdate")
        return self._with_tax("lineitem", supplier, order).select(
            broken(23, none, F.concat(F.lit("Supplier "), supplier.cast("string"))).alias("NOME_FORNECEDOR"),
            typed_tax_id(F.col(TAX), order).alias("CNPJ_FORNECEDOR"),
            F.when(order % 5 == 0, none).otherwise(F.concat(F.lit("s"), supplier.cast("string"), F.lit("@mail.test"))).alias("EMAIL_FORNECEDOR"),
            F.concat(F.lit("55-"), supplier.cast("string")).alias("TELEFONE_FORNECEDOR"),
            broken(31, F.lit("abc"), F.concat(F.lit(" "), order.cast("string"), F.lit(" "))).alias("NUMERO_NF"),
            broken(37, F.lit("not a date"), shipped.cast("string")).alias("DATA_EMISSAO"),
            broken(41, none, value).alias("VALOR_NET"),
            broken(43, F.lit(""), F.lit("1.50")).alias("VALOR_TRIBUTO"),
            broken(47, F.lit("x"), F.concat(F.lit(" "), value)).alias("VALOR_TOTAL"),
            broken(53, none, F.concat(F.lit("Part "), F.col("l_partkey").cast("string"))).alias("NOME_ITEM"),
            F.col("l_quantity").cast("int").cast("string").alias("QTD_ITEM"),
            broken(59, none, raw_term(order)).alias("CONDICAO_PAGAMENTO"),
            (F.lit(1001000) + (supplier + order) % 25).cast("string").alias("CEP"),
            F.when(order % 11 == 0, none).otherwise(number.cast("string")).alias("NUM_ENDERECO"),
            F.when(order % 3 == 0, none).otherwise(F.concat(F.lit("Sala "), (order % 4).cast("string"))).alias("COMPLEMENTO"),
            broken(61, none, pick(["cobranca", "entrega", "faturamento"], number % 3)).alias("TIPO_ENDERECO"),
            F.date_add(shipped, 1).cast("string").alias("DATA_PROCESSAMENTO"),
        )

    def purchases_typed(self) -> DataFrame:
        return trim_cast_columns(self.purchase_feed(), FEED_CASTS).withColumn("TIPO_ENDERECO", F.upper("TIPO_ENDERECO"))

    def purchases_log(self) -> DataFrame:
        return (
            self.table("lineitem")
            .where(F.col("l_orderkey") % 3 == 0)
            .select(
                F.col("l_orderkey").cast("int").alias("NUMERO_NF"),
                F.date_add(F.to_date("l_shipdate"), 1).alias("DATA_PROCESSAMENTO"),
            )
        )

    def sales_feed(self) -> DataFrame:
        """Orders as a sales feed typed by its scan."""
        order, customer = F.col("o_orderkey"), F.col("o_custkey")

        def broken(every: int, kind: str, good: Column) -> Column:
            return F.when(order % every == 0, F.lit(None).cast(kind)).otherwise(good)

        issued = F.to_date("o_orderdate")
        total = money("o_totalprice")
        return self._with_tax("orders", customer, order).select(
            broken(23, "string", F.concat(F.lit("Customer "), customer.cast("string"))).alias("NOME"),
            typed_tax_id(F.col(TAX), order).alias("CNPJ"),
            broken(5, "string", F.concat(F.lit("c"), customer.cast("string"), F.lit("@mail.test"))).alias("EMAIL"),
            F.concat(F.lit("55-"), customer.cast("string")).alias("TELEFONE"),
            F.when(order % 31 == 0, F.lit("abc")).otherwise(F.lpad(order.cast("string"), 9, "0")).alias("NUMERO_NF"),
            broken(37, "date", issued).alias("DATA_EMISSAO"),
            broken(41, "decimal(16,2)", total).alias("VALOR_NET"),
            broken(43, "decimal(16,2)", F.lit("1.50").cast("decimal(16,2)")).alias("VALOR_TRIBUTO"),
            broken(47, "decimal(16,2)", total).alias("VALOR_TOTAL"),
            broken(53, "string", F.concat(F.lit("Item "), (order % 100).cast("string"))).alias("NOME_ITEM"),
            (order % 9 + 1).cast("int").alias("QTD_ITEM"),
            broken(59, "string", raw_term(order)).alias("CONDICAO_PAGAMENTO"),
            (F.lit(1001000) + (customer + order) % 25).cast("string").alias("CEP"),
            broken(11, "int", (order % 500).cast("int")).alias("NUM_ENDERECO"),
            broken(3, "string", F.concat(F.lit("Sala "), (order % 4).cast("string"))).alias("COMPLEMENTO"),
            broken(61, "string", pick(ADDRESS_TYPES, order % 3)).alias("TIPO_ENDERECO"),
            F.date_add(issued, 1).cast("timestamp").alias("DATA_PROCESSAMENTO"),
        )

    def sales_log(self) -> DataFrame:
        return (
            self.table("orders")
            .where(F.col("o_orderkey") % 3 == 0)
            .select(
                F.col("o_orderkey").cast("int").alias("NUMERO_NF"),
                F.date_add(F.to_date("o_orderdate"), 1).cast("timestamp").alias("DATA_PROCESSAMENTO"),
            )
        )

    # -- dimensions ----------------------------------------------------------------------

    def postal_codes(self) -> DataFrame:
        nation = self.table("nation").where(F.col("n_nationkey") < 20)
        return nation.select((F.lit(1001000) + F.col("n_nationkey")).cast("string").alias("CEP"))

    def address_types(self) -> DataFrame:
        rows = [(i, name.lower()) for i, name in enumerate(ADDRESS_TYPES, start=1)]
        return self.spark.createDataFrame(rows, "ID_TIPO_ENDERECO int, DESCRICAO string")

    def _parties(self, table: str, key: Column, label: str, mail: str, names: tuple[str, ...]) -> DataFrame:
        """Known parties: every eleventh is missing, every fifth has an outdated name."""
        party_id, name, tax, email, phone = names
        text = key.cast("string")
        return self.table(table).where(key % 11 != 0).select(
            key.alias(party_id),
            F.when(key % 5 == 0, F.lit("OLD NAME")).otherwise(F.upper(F.concat(F.lit(label), text))).alias(name),
            tax_id(key).alias(tax),
            F.when(key % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit(mail), text, F.lit("@mail.test"))).alias(email),
            F.concat(F.lit("55-"), text).alias(phone),
        )

    def suppliers(self) -> DataFrame:
        names = ("ID_FORNECEDOR", "NOME_FORNECEDOR", "CNPJ_FORNECEDOR", "EMAIL_FORNECEDOR", "TELEFONE_FORNECEDOR")
        return self._parties("supplier", F.col("s_suppkey"), "Supplier ", "s", names)

    def customers(self) -> DataFrame:
        names = ("ID_CLIENTE", "NOME", "CNPJ", "EMAIL", "TELEFONE")
        return self._parties("customer", F.col("c_custkey"), "Customer ", "c", names)

    def _addresses(self, table: str, key: Column, party_id: str) -> DataFrame:
        """Known addresses: one per known party."""
        return self.table(table).where(key % 11 != 0).select(
            key.alias(party_id),
            F.lit(1).alias("ID_TIPO_ENDERECO"),
            (F.lit(1001000) + key % 25).cast("string").alias("CEP"),
            (key % 7).cast("int").alias("NUMERO"),
            F.lit("Sala 1").alias("COMPLEMENTO"),
        )

    def supplier_addresses(self) -> DataFrame:
        return self._addresses("supplier", F.col("s_suppkey"), "ID_FORNECEDOR")

    def customer_addresses(self) -> DataFrame:
        return self._addresses("customer", F.col("c_custkey"), "ID_CLIENTE")

    # -- parameters ----------------------------------------------------------------------

    def parameters(self) -> DataFrame:
        """Orders as packed parameter rows: some too short, some with unreadable parts."""
        order = F.col("o_orderkey")
        day = F.to_date("o_orderdate").cast("string")
        full = F.concat_ws(
            ",",
            F.col("o_orderpriority"),
            day,
            F.when(order % 6 == 0, F.lit("")).otherwise(day),
            day,
            F.when(order % 8 == 0, F.lit("n/a")).otherwise((order % 40).cast("string")),
            (order % 2).cast("string"),
        )
        short = F.concat_ws(",", F.col("o_orderpriority"), day)
        return self.table("orders").select(
            order.alias("ROW_ID"),
            (order % 5).cast("int").alias("COD"),
            F.when(order % 9 == 0, short).otherwise(full).alias("DESCRICAO"),
        )


class PlacedOrders(Frames):
    """The same frames of invoices, with what is made of one order in one partition; orders without a key are left out."""

    def table(self, name: str) -> DataFrame:
        if name != "orders":
            return super().table(name)
        orders = super().table(name).where(F.col("o_orderkey").isNotNull())
        return orders.select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), money("o_totalprice").alias("o_totalprice")).repartition("o_orderkey")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(16,2)")


def tax_id(key: Column, *, wrong: Column | None = None) -> Column:
    """Tax id of a party key; where ``wrong`` holds, its check digits are off by one."""
    base = key * 10000 + 1
    check = check_number(base)
    if wrong is not None:
        check = (check + F.when(wrong, 1).otherwise(0)) % 100
    return F.lpad((base * 100 + check).cast("string"), 14, "0")


def dotted(tax: Column) -> Column:
    """A tax id with the punctuation people type."""
    return F.concat(
        F.substring(tax, 1, 2), F.lit("."), F.substring(tax, 3, 6), F.lit("/"), F.substring(tax, 9, 4), F.lit("-"), F.substring(tax, 13, 2)
    )


def typed_tax_id(tax: Column, order: Column) -> Column:
    """A party's tax id as feeds have it: plain, dotted or with a line break behind it."""
    return F.when(order % 71 == 0, F.concat(tax, F.lit("\n"))).when(order % 13 == 0, dotted(tax)).otherwise(tax)


def at_hour(day: str, hour: Column) -> Column:
    """A moment of the day."""
    return F.col(day).cast("timestamp") + F.make_dt_interval(F.lit(0), hour.cast("int"))


def raw_term(key: Column) -> Column:
    return pick(RAW_TERMS, key % len(RAW_TERMS))


def pick(values: list[str], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place + 1).cast("int"))

from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cashloom.plans.ingest import purchases_ingest, sales_ingest
from cashloom.plans.seed import seed_reference_data
from cashloom.presets import INVOICE_COLUMNS, PURCHASES, SALES, TERMS, TIERS, DELIVERY_COLUMNS, term_table
from cashloom.sources.staging import Staging
from cashloom.sources.feeds import read_payments, read_purchases, read_receipts, read_sales

GOOD, OTHER, THIRD = "20030040000193", "31042053000280", "45612378900339"


def line(name="Alfa", tax=GOOD, email="a@mail.test", phone="11", nf="21", issued="2023-05-01", net="90.00", tribute="10.00", total="100.00",
         item="Prego", quantity="3", term="60 dias", cep="1001000", number="5", complement="Sala 2", kind="entrega", processed="2023-05-02"):
    return ",".join(v or "" for v in (name, tax, email, phone, nf, issued, net, tribute, total, item, quantity, term, cep, number, complement, kind, processed))


LINES = [
    line(),
    line(),  # copy
    line(nf=" 22 ", email=None, cep="1001001"),
    line(nf="22", cep="1001001"),
    line(name="Beta", tax=OTHER, nf="30", number="x", complement=None, term="Entrada/30 dias"),
    line(name="Gama", tax="20030040000194", nf="31"),
    line(name=None, tax="1", nf=None),
    line(name="Delta", tax=THIRD, nf="33", total="abc"),
    line(name="Delta", tax=THIRD, nf="34", cep="9"),
    line(name="Delta", tax=THIRD, nf="35", term="sob consulta"),
    line(nf="99"),  # processed before
]


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("feeds")
    header = ",".join(PURCHASES.feed_columns)
    (folder / "purchases.csv").write_bytes(("\r\n".join([header, *LINES]) + "\r\n\r\n").encode())
    sales_header = header.replace("VALOR_TOTAL", " VALOR_TOTAL ").replace("_FORNECEDOR", "_CLIENTE")
    body = [text.replace("2023-05-02", "2023-05-02 10:20:30.123").replace(",21,", ",0000021,").replace(",entrega,", ",ENTREGA,") for text in LINES]
    (folder / "sales.csv").write_bytes(("﻿" + "\r\n".join([sales_header, *body]) + "\r\n").encode())
    tables = dict(
        postal_codes=spark.createDataFrame([("1001000",), ("1001001",)], "CEP string"),
        address_types=spark.createDataFrame([(1, "cobranca"), (2, "entrega")], "ID_TIPO_ENDERECO int, DESCRICAO string"),
        terms=term_table(spark),
    )
    return folder, tables


def run(spark, world, side, log=None, parties=None, addresses=None):
    folder, tables = world
    if side is PURCHASES:
        feed, job, kind = read_purchases(spark, str(folder / "purchases.csv")), purchases_ingest, "date"
        stamp = date(2023, 5, 2)
    else:
        feed, job, kind = read_sales(spark, str(folder / "sales.csv")), sales_ingest, "timestamp"
        stamp = datetime(2023, 5, 2, 10, 20, 30, 123000)
    if log is None:
        log = spark.createDataFrame([(99, stamp)], f"NUMERO_NF int, DATA_PROCESSAMENTO {kind}")
    if parties is None:
        parties = spark.createDataFrame(
            [(7, "BETA", OTHER, "old@mail.test", "11")],
            f"{side.party_id} long, {side.name} string, {side.tax_id} string, {side.email} string, {side.phone} string",
        )
    if addresses is None:
        addresses = spark.createDataFrame(
            [(7, 1, "1001000", 0, "N/A")], f"{side.party_id} long, ID_TIPO_ENDERECO int, CEP string, NUMERO int, COMPLEMENTO string"
        )
    return job(feed, processed=log, parties=parties, addresses=addresses, **tables), parties, addresses


@pytest.mark.parametrize("side", [PURCHASES, SALES])
def test_one_feed(spark, world, rows, side):
    result, _, _ = run(spark, world, side)
    reasons = rows(result.rejected, side.name, "NUMERO_NF", "MOTIVO")
    assert reasons == sorted(
        [("GAMA", 31, "CNPJ_INVALIDO"), (None, None, "NOME_NULO"), ("DELTA", 33, "VALOR_TOTAL"), ("DELTA", 34, "CEP_INVALIDO")], key=repr
    )
    accepted = rows(result.accepted, side.tax_id, "NUMERO_NF", side.email)
    blank = "N/A" if side is PURCHASES else None
    assert accepted == sorted(
        [(GOOD, 21, "a@mail.test"), (GOOD, 22, "a@mail.test"), (GOOD, 22, blank), (OTHER, 30, "a@mail.test"), (THIRD, 35, "a@mail.test")], key=repr
    )
    new = {r[side.tax_id]: r[side.party_id] for r in result.new_parties.collect()}
    assert set(new) == {GOOD, THIRD}
    assert sorted(new.values()) == [8, 9]
    assert rows(result.changed_parties) == [(OTHER, "BETA", "a@mail.test", "11")]
    assert rows(result.new_addresses, side.party_id, "CEP", "ID_TIPO_ENDERECO", "NUMERO", "COMPLEMENTO") == sorted(
        [(new[GOOD], "1001000", 2, 5, "Sala 2"), (new[GOOD], "1001001", 2, 5, "Sala 2"), (new[THIRD], "1001000", 2, 5, "Sala 2")], key=repr
    )
    assert rows(result.changed_addresses, side.party_id, "CEP", "ID_TIPO_ENDERECO", "NUMERO", "COMPLEMENTO") == [(7, "1001000", 2, 0, "N/A")]
    invoices = rows(result.invoices, "NUMERO_NF", side.party_id, "ID_CONDICAO")
    assert invoices == sorted([(21, new[GOOD], 3), (22, new[GOOD], 3), (22, new[GOOD], 3), (30, 7, 5)], key=repr)
    lacking = rows(result.incomplete_invoices, "NUMERO_NF", side.party_id, "ID_CONDICAO", "MOTIVO")
    assert lacking == [(35, new[THIRD], None, "ID_CONDICAO_NULO")]
    ids = [r[0] for r in rows(result.invoices, side.invoice_id)]
    assert ids == [1, 2, 3, 4]
    assert result.processed_log.columns == list(side.log_columns)


@pytest.mark.parametrize("side", [PURCHASES, SALES])
def test_second_run_adds_nothing(spark, world, side):
    first, parties, addresses = run(spark, world, side)
    log = first.processed_log.select("NUMERO_NF", "DATA_PROCESSAMENTO").union(
        first.rejected.select("NUMERO_NF", "DATA_PROCESSAMENTO")
    )
    known = parties.where(F.lit(False)).unionByName(first.new_parties).unionByName(first.changed_parties.withColumn(side.party_id, F.lit(7).cast("long")))
    second, _, _ = run(spark, world, side, log=log, parties=known, addresses=addresses)
    # a key with a missing part is never logged, so that reject is seen again, and 99 is not in this log
    assert {r.NUMERO_NF for r in second.accepted.collect()} == {99}
    assert second.new_parties.count() == second.changed_parties.count() == 0


def test_layouts_have_seventeen_columns():
    for side in (PURCHASES, SALES):
        assert len(side.feed_columns) == 17
        assert side.feed_columns[4:] == INVOICE_COLUMNS + DELIVERY_COLUMNS


def test_reference_data_from_csv(spark, tmp_path):
    def write(name, *lines):
        (tmp_path / name).write_bytes("\r\n".join(lines).encode())
        return str(tmp_path / name)

    data = seed_reference_data(
        spark,
        postal_codes=write("cep.csv", "CEP,UF,CIDADE,BAIRRO,LOGRADOURO", "1001000,SP,Sao Paulo,Se,Praca da Se"),
        address_types=write("types.csv", "﻿DESCRICAO,SIGLA", "cobranca,COB", "entrega,ENT"),
        terms=write("terms.csv", "DESCRICAO,QTD_PARCELAS,ENTRADA", *[f"{d},{n},{e}" for d, n, e in TERMS]),
        tiers=write("tiers.csv", "a,b,c,d,e,f,g,h,i", *[f"{n},{lo}, {hi},{a},{b},X,2023-05-02,{e},{ok}" for n, lo, hi, a, b, e, ok in TIERS]),
    )
    assert [r.DESCRICAO for r in data.address_types.collect()] == ["cobranca", "entrega"]
    assert [tuple(r) for r in data.terms.collect()] == TERMS
    tiers = [(r.DESCRICAO, r.MINIMO_DIAS, r.MAXIMO_DIAS, str(r.MINIMO), str(r.MAXIMO), r.TIPO_DESCONTO, r.STATUS_APROVACAO) for r in data.tiers.collect()]
    assert tiers == TIERS
    assert data.postal_codes.first().CEP == "1001000"


def test_payment_and_receipt_files(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes(b"ID_NF_ENTRADA,DATA_VENCIMENTO,DATA_PGT_EFETUADO,VALOR_PGT_EFETUADO\r\n1,2023-06-15,2023-06-10, 49.00\r\n\r\n")
    (tmp_path / "r.csv").write_bytes(b"x,y,z,w\r\n 7,2023-06-15,2023-06-10, 49.00\r\n8,bad,2023-06-10,1\r\n")
    assert [tuple(r) for r in read_payments(spark, str(tmp_path / "p.csv")).collect()] == [("1", "2023-06-15", "2023-06-10", " 49.00")]
    found = [(r.NUMERO_NF, r.DATA_VENCIMENTO, str(r.VALOR_RECEBIDO)) for r in read_receipts(spark, str(tmp_path / "r.csv")).collect()]
    assert found == [(7, date(2023, 6, 15), "49.00"), (8, None, "1.00")]


@pytest.mark.parametrize("keep", [False, True])
def test_missing_values_and_what_is_known(spark, rows, keep):
    from cashloom.operators.dimensions import changed_members

    known = spark.createDataFrame([("a", "x@mail", "1"), ("b", None, "2"), ("c", "y@mail", "3")], "k string, mail string, phone string")
    offered = spark.createDataFrame([("a", "N/A", "1"), ("b", "z@mail", "2"), ("c", None, "4")], "k string, mail string, phone string")
    changed = rows(changed_members(offered, known, "k", ["mail", "phone"], keep_known={"mail": "N/A"} if keep else None))
    assert changed == ([("b", "z@mail", "2"), ("c", "y@mail", "4")] if keep else [("a", "N/A", "1"), ("b", "z@mail", "2"), ("c", None, "4")])


def test_one_company_however_its_id_is_typed(spark, world):
    folder, tables = world
    header = ",".join(PURCHASES.feed_columns)
    dotted = f"{GOOD[:2]}.{GOOD[2:5]}.{GOOD[5:8]}/{GOOD[8:12]}-{GOOD[12:]}"
    (folder / "typed.csv").write_text("\n".join([header, line(nf="1"), line(nf="2", tax=dotted)]) + "\n")
    empty = lambda schema: spark.createDataFrame([], schema)
    with Staging(spark) as stage:
        result = purchases_ingest(
            read_purchases(spark, str(folder / "typed.csv")),
            processed=empty("NUMERO_NF int, DATA_PROCESSAMENTO date"),
            parties=empty("ID_FORNECEDOR long, NOME_FORNECEDOR string, CNPJ_FORNECEDOR string, EMAIL_FORNECEDOR string, TELEFONE_FORNECEDOR string"),
            addresses=empty("ID_FORNECEDOR long, ID_TIPO_ENDERECO int, CEP string, NUMERO int, COMPLEMENTO string"),
            stage=stage,
            invoices_so_far=40,
            **tables,
        )
        assert [r.CNPJ_FORNECEDOR for r in result.new_parties.collect()] == [GOOD]
        assert sorted((r.ID_NF_ENTRADA, r.ID_FORNECEDOR) for r in result.invoices.collect()) == [(41, 1), (42, 1)]
        assert result.parties_next.count() == result.addresses_next.count() == 1
        paths = list(stage.paths)
        assert paths
    fs = spark._jvm.org.apache.hadoop.fs
    assert not any(fs.Path(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs.Path(p)) for p in paths)


def test_working_copies_are_written_small(spark, tmp_path):
    Staging(spark, str(tmp_path))(spark.range(10))
    [*_, file] = tmp_path.glob("*/*.parquet")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_a_feed_is_neither_copied_nor_shuffled_twice(spark, world):
    with Staging(spark) as stage:
        seen = []

        def kept(df):
            seen.append(df)
            return stage(df)

        folder, tables = world
        result = purchases_ingest(
            read_purchases(spark, str(folder / "purchases.csv")),
            processed=spark.createDataFrame([(99, date(2023, 5, 2))], "NUMERO_NF int, DATA_PROCESSAMENTO date"),
            parties=spark.createDataFrame([(7, "BETA", OTHER, "old@mail.test", "11")], "ID_FORNECEDOR long, NOME_FORNECEDOR string, CNPJ_FORNECEDOR string, EMAIL_FORNECEDOR string, TELEFONE_FORNECEDOR string"),
            addresses=spark.createDataFrame([(7, 1, "1001000", 0, "N/A")], "ID_FORNECEDOR long, ID_TIPO_ENDERECO int, CEP string, NUMERO int, COMPLEMENTO string"),
            stage=kept,
            **tables,
        )
        assert [("MOTIVO" in df.columns, "NUMERO_NF" in df.columns) for df in seen] == [(True, True), (False, False), (False, False), (False, False)]
        # a feed's few parties go to its rows: the invoices are not dealt out to meet them
        assert "__slice" not in result.incomplete_invoices._jdf.queryExecution().optimizedPlan().toString()

"""Scans of feed files with malformed lines, movements' balances, digests and SQL functions."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cashloom.functions import is_valid_tax_id, normalize_term
from cashloom.functions.sql import register_functions
from cashloom.functions.taxid import complete_tax_id
from cashloom.operators.cashflow import running_balance_of_movements
from cashloom.operators.dimensions import changed_by_digest, changed_members, row_digest
from cashloom.sources.feeds import scan_csv
from cashloom.sources.schemas import optional
from pyspark.sql.types import DateType, DecimalType, IntegerType

LINES = [
    "n,day,value",
    "1,2024-01-02, 5.50",
    '2,2024-01-03,"7,25"',
    "",
    "3,2024-01-04",
    "4,2024-01-05,1,2",
    '5,"2024-01-06,3',
    ' 6 ,bad,"4.00"',
    '"7",2024-01-08,"a ""quoted"" text"',
    ",,",
]


@pytest.fixture
def file(tmp_path):
    path = tmp_path / "feed.csv"
    path.write_bytes(b"\xef\xbb\xbf" + "\r\n".join(LINES).encode() + b"\r\n\r\n")
    return str(path)


def test_malformed_lines_are_apart_and_whole(spark, file):
    scan = scan_csv(spark, file, ["n", "day", "value"])
    assert sorted(r.n or "" for r in scan.rows.collect()) == ["", " 6 ", "1", "2", "7"]
    broken = scan.malformed.collect()
    assert sorted(r.LINHA for r in broken) == ["3,2024-01-04", "4,2024-01-05,1,2", '5,"2024-01-06,3']
    assert all(r.ARQUIVO.endswith("feed.csv") for r in broken)
    # fewer columns asked for do not make a line whole
    assert scan.rows.select("n").count() == 5 and scan.malformed.select("ARQUIVO").count() == 3


def test_typed_scan_keeps_rows_whose_fields_do_not_parse(spark, file):
    schema = optional(first=IntegerType(), second=DateType(), third=DecimalType(8, 2))
    rows = {r.first: (r.second, r.third) for r in scan_csv(spark, file, schema).rows.collect()}
    assert rows == {
        1: (date(2024, 1, 2), Decimal("5.50")), 2: (date(2024, 1, 3), None), 6: (None, Decimal("4.00")), 7: (date(2024, 1, 8), None), None: (None, None)
    }


def test_a_file_with_a_header_only(spark, tmp_path):
    (tmp_path / "e.csv").write_text("a,b\n")
    scan = scan_csv(spark, str(tmp_path / "e.csv"), ["a", "b"])
    assert scan.rows.count() == scan.malformed.count() == 0


@pytest.mark.parametrize("block", [1, 7, 10**6])
def test_balance_of_movements(spark, block):
    rng = random.Random(block)
    lines = [(k, date(2024, 1, rng.randrange(1, 5)), Decimal(rng.randrange(-500, 500)) / 100 if k % 9 else None) for k in range(200)]
    frame = spark.createDataFrame(lines, "k int, d date, v decimal(16,2)").repartition(6)
    found = {r.k: r.b for r in running_balance_of_movements(frame, ["d", "k"], "v", "b", opening=F.lit(100), block_rows=block).collect()}
    total, want = Decimal(100), {}
    for k, _, v in sorted(lines, key=lambda x: (x[1], x[0])):
        total += v or 0
        want[k] = total
    assert found == want
    assert running_balance_of_movements(frame.limit(0), ["d", "k"], "v", "b").count() == 0


def test_blocks_bound_what_a_task_gets(spark):
    frame = spark.range(3000).select("id", F.lit(Decimal("1.00")).cast("decimal(16,2)").alias("v"))
    kept = []
    running_balance_of_movements(frame, ["id"], "v", "b", block_rows=100, stage=lambda df: kept.append(df.cache()) or kept[-1])
    sizes = [r["count"] for r in kept[0].groupBy("__block").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 400


def test_changed_by_digest_equals_changed_members(spark, rows, plan, tmp_path):
    schema = "k string, a string, b string, n int"
    members = [("1", "x", None, 1), ("2", None, "x", 2), ("3", "x", "y", 3), ("4", "x", "", None), ("5", "q", "q", 5), ("5", "z", "q", 5)]
    offers = [("1", None, "x", 1), ("2", None, "x", 2), ("3", "x", "y", 4), ("4", "x", None, None), ("5", "q", "q", 5), ("9", "new", None, 0)]
    known = spark.createDataFrame(members, schema).withColumn("wide", F.lit("w" * 100))
    known.withColumn("digest", row_digest(["a", "b", "n"])).write.parquet(f"{tmp_path}/known")
    stored, offered = spark.read.parquet(f"{tmp_path}/known"), spark.createDataFrame(offers, schema)
    found = changed_by_digest(offered, stored, "k", ["a", "b", "n"], digest="digest")
    assert rows(found) == rows(changed_members(offered, known, "k", ["a", "b", "n"]))
    scans = [line for line in plan(found).splitlines() if "ReadSchema" in line]
    assert scans and all("wide" not in line and "a:string" not in line for line in scans)


def test_sql_functions_agree_with_the_columns(spark):
    register_functions(spark)
    names = register_functions(spark)  # replaced, not doubled
    assert "cnpj_valid" in names
    rng = random.Random(3)
    base = ["%012d" % rng.randrange(10**12) for _ in range(200)] + ["000000000000", "11444777000161"[:12]]
    ids = [r[0] for r in spark.createDataFrame([(b,) for b in base], "b string").select(complete_tax_id("b")).collect()]
    texts = ids + [x[:13] + str((int(x[13]) + 1) % 10) for x in ids] + ["11.444.777/0001-61", "1144477700016", None, "", "a" * 14, ids[0] + "\n", ids[1] + "0", "1" * 30]
    terms = ["a vista", "30 dias", "Entrada/30/60 dias", "noventa dias", "30/60/90 dias", None, "", "60 dias", "X VISTA"]
    frame = spark.createDataFrame([(t, terms[k % len(terms)]) for k, t in enumerate(texts)], "id string, term string")
    both = frame.select(
        is_valid_tax_id("id").alias("v"), F.expr("cnpj_valid(id)").alias("sv"), normalize_term("term").alias("t"), F.expr("normalized_term(term)").alias("st")
    )
    got = both.collect()
    assert [r.v for r in got] == [r.sv for r in got] and [r.t for r in got] == [r.st for r in got] and any(r.v for r in got)
    assert spark.sql("SELECT cnpj_check_digits('114447770001')").first()[0] == "61"

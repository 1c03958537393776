from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cashloom.functions import (
    after,
    closed_before,
    complete_tax_id,
    deviation_percent,
    in_month_of,
    is_valid_tax_id,
    normalize_term,
    trim_cast,
    within_percent,
)
from cashloom.functions.periods import previous_month

# made up for these tests
TAX_IDS = [
    ("20030040000193", True),
    ("31042053000280", True),
    ("45612378900339", True),
    ("7120003.450-0146", True),
    ("20.030.040/0001-93", True),
    ("9876543210111", False),
    ("09876543210111", True),
    ("20030040000194", False),
    ("45612378900330", False),
    ("00000000000000", True),
    ("ABCDEFGHIJKLMN", False),
    ("A0030040000193", False),
    (" 20030040000193", False),
    ("-2003004000019", False),
    ("200300400001931", False),
    ("20030040000193\n", False),
    ("20030040000193\r", False),
    ("9" * 40, False),
    ("", False),
    (None, False),
]


def test_tax_id_vectors(spark):
    df = spark.createDataFrame([(t,) for t, _ in TAX_IDS], "t string")
    found = [(r.t, r.v) for r in df.select("t", is_valid_tax_id("t").alias("v")).collect()]
    assert found == TAX_IDS


def test_strict_rejects_one_repeated_digit(spark):
    df = spark.createDataFrame([("00000000000000",), ("20030040000193",), ("0" * 14 + "\n",)], "t string")
    assert [r[0] for r in df.select(is_valid_tax_id("t", strict=True)).collect()] == [False, True, False]


def _digits(base: str) -> str:
    """Check digits the long way round."""
    for start in (5, 6):
        weight, total = start, 0
        for c in base:
            total += int(c) * weight
            weight = 9 if weight == 2 else weight - 1
        rest = total % 11
        base += "0" if rest < 2 else str(11 - rest)
    return base


def test_completed_ids_match_the_long_way_round(spark):
    bases = [f"{(i * 7919 * 104729) % 10**12:012d}" for i in range(500)] + ["000000000000", "999999999999"]
    df = spark.createDataFrame([(b,) for b in bases], "b string")
    found = [r[0] for r in df.select(complete_tax_id("b")).collect()]
    assert found == [_digits(b) for b in bases]
    assert df.select(complete_tax_id("b").alias("t")).where(~is_valid_tax_id("t")).count() == 0


def test_incomplete_base_gives_null(spark):
    df = spark.createDataFrame([("12345678901",), ("12345678901x",), (None,)], "b string")
    assert [r[0] for r in df.select(complete_tax_id("b")).collect()] == [None, None, None]


@pytest.mark.parametrize(
    ("term", "canonical"),
    [
        ("Entrada/30/60/90 dias", "Entrada/30/60/90 dias"),
        ("90 dias", "30/60/90 dias"),
        ("noventa dias", "30/60/90 dias"),
        ("60 dias", "30/60 dias"),
        ("30/60/90 dias", "30/60/90 dias"),
        ("a vista", "A vista"),
        ("30 dias", "30 dias"),
        ("90 DIAS", "90 DIAS"),
        ("90 dias ", "90 dias "),
        (None, None),
    ],
)
def test_terms(spark, term, canonical):
    assert spark.createDataFrame([(term,)], "t string").select(normalize_term("t")).first()[0] == canonical


def test_trim_cast_keeps_going(spark):
    df = spark.createDataFrame([(" 12 ", " 2023-01-31", "1.005"), ("x", "2023-02-30", ""), (None, None, None)], "a string, b string, c string")
    found = [tuple(r) for r in df.select(trim_cast("a", "int"), trim_cast("b", "date"), trim_cast("c", "decimal(16,2)")).collect()]
    assert found == [(12, date(2023, 1, 31), Decimal("1.01")), (None, None, None), (None, None, None)]


def test_december_is_closed_in_january_and_march(spark):
    df = spark.createDataFrame([(date(2022, 12, 31),), (date(2023, 1, 1),), (date(2023, 2, 28),)], "d date")

    def kept(condition):
        return [r.d.month for r in df.where(condition).collect()]

    assert kept(closed_before("d", date(2023, 1, 10))) == [12]
    assert kept(closed_before("d", date(2023, 3, 10))) == [12, 1, 2]
    assert kept(closed_before("d", date(2023, 1, 10), "month_number")) == []
    assert kept(closed_before("d", date(2023, 3, 10), "month_number")) == [1, 2]
    assert kept(in_month_of("d", date(2022, 12, 5))) == [12]
    assert kept(after("d", date(2022, 12, 31))) == [1, 2]
    assert kept(after("d", F.lit(None).cast("date"))) == [12, 1, 2]
    assert kept(after("d", None)) == [12, 1, 2]


def test_moments_of_the_closing_day_are_closed(spark):
    moments = [datetime(2022, 12, 31, 0, 0), datetime(2022, 12, 31, 23, 59), datetime(2023, 1, 1, 0, 0)]
    df = spark.createDataFrame([(m,) for m in moments], "d timestamp")
    for bound in (date(2022, 12, 31), F.lit(date(2022, 12, 31))):
        assert [r.d for r in df.where(after("d", bound)).collect()] == moments[2:]


def test_previous_month_crosses_the_year():
    assert previous_month(date(2023, 1, 31)) == date(2022, 12, 1)
    assert previous_month(date(2023, 3, 31)) == date(2023, 2, 1)


def test_percent_bounds_are_exact(spark):
    df = spark.createDataFrame(
        [(Decimal("101.90"), Decimal("100.00")), (Decimal("101.91"), Decimal("100.00")), (Decimal("1.00"), Decimal("0.00")), (Decimal("3.03"), Decimal("3.00"))],
        "r decimal(16,2), v decimal(16,2)",
    )
    within = within_percent(F.col("r"), F.col("v"), F.lit(Decimal("1.00")), F.lit(Decimal("1.90")))
    assert [r[0] for r in df.select(within).collect()] == [True, False, False, True]
    assert df.select(deviation_percent(F.col("r"), F.col("v"))).collect()[2][0] is None

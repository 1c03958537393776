"""The tax-id and term functions for SQL users: temporary functions with SQL bodies, inlined like any expression."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .taxid import FIRST_WEIGHTS, PUNCTUATION, SECOND_WEIGHTS


def _weighted(digits: str, weights: tuple[int, ...]) -> str:
    return " + ".join(f"CAST(substr({digits}, {at}, 1) AS INT) * {weight}" for at, weight in enumerate(weights, start=1))


def _check(total: str) -> str:
    # remainders 0 and 1 give 0, any other r gives 11 - r
    return f"((11 - ({total}) % 11) % 11 % 10)"


_QUOTED = PUNCTUATION.replace("'", "\\'").replace('"', '\\"')

FUNCTIONS = {
    "cnpj_bare": ("id STRING", "STRING", f"translate(id, '{_QUOTED}', '')"),
    "cnpj_check_digits": (
        "base STRING",
        "STRING",
        f"CASE WHEN base RLIKE '^[0-9]{{12}}\\\\z' THEN concat({_check(_weighted('base', FIRST_WEIGHTS))}, "
        f"{_check(_weighted('base', SECOND_WEIGHTS[:12]) + ' + ' + _check(_weighted('base', FIRST_WEIGHTS)) + f' * {SECOND_WEIGHTS[12]}')}) END",
    ),
    "cnpj_valid": (
        "id STRING",
        "BOOLEAN",
        "coalesce(cnpj_bare(id) RLIKE '^[0-9]{14}\\\\z' AND cnpj_check_digits(substr(cnpj_bare(id), 1, 12)) = substr(cnpj_bare(id), 13), false)",
    ),
    "normalized_term": (
        "term STRING",
        "STRING",
        "CASE WHEN substr(term, 2, 4) = 'ntra' THEN term WHEN endswith(term, '90 dias') OR endswith(term, 'noventa dias') THEN '30/60/90 dias' "
        "WHEN endswith(term, '60 dias') THEN '30/60 dias' WHEN endswith(term, 'vista') THEN 'A vista' ELSE term END",
    ),
}
"""Arguments, result and body by name; a body may use the functions before it."""


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session, replacing earlier ones; returns their names.

    They give what :mod:`.taxid` and :mod:`.text` give in DataFrames, without a Python worker.
    """
    for name, (arguments, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)

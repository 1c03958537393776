"""Company tax ids: 12 digits followed by two mod-11 check digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: weights of the 12 leading digits, and of those digits plus the first check digit
FIRST_WEIGHTS = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
SECOND_WEIGHTS = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)


PUNCTUATION = ".,\"'/-"


def strip_punctuation(tax_id: Column | str) -> Column:
    """Drop the punctuation people type inside a tax id; letters stay and make it invalid."""
    return F.translate(_col(tax_id), PUNCTUATION, "")


def _weighted_sum(base: Column, weights: tuple[int, ...]) -> Column:
    """Sum of the 12 digits of the number ``base``, each times its weight.

    A digit is the number cut off at its place minus ten times the number cut off one place
    further left, so each cut-off number appears once, with the two weights it counts under.
    """
    total = base * weights[11]
    for place in range(1, 12):
        cut = F.call_function("div", base, F.lit(10**place).cast("long"))
        total = total + cut * (weights[11 - place] - 10 * weights[12 - place])
    return total


def _digit(total: Column) -> Column:
    # remainders 0 and 1 give 0, any other r gives 11 - r
    return (F.lit(11) - total % 11) % 11 % 10


def check_number(base: Column) -> Column:
    """The two check digits, as a number 0-99, of a base given as a number below 10**12."""
    first = _digit(_weighted_sum(base, FIRST_WEIGHTS))
    second = _digit(_weighted_sum(base, SECOND_WEIGHTS) + first * SECOND_WEIGHTS[12])
    return first * 10 + second


def check_digits(base: Column | str) -> Column:
    """The two check digits of a 12-digit base, as text; NULL where the base is anything else."""
    base = _col(base)
    digits = F.lpad(check_number(base.try_cast("long")).cast("string"), 2, "0")
    return F.when(base.rlike(r"^[0-9]{12}\z"), digits)


def complete_tax_id(base: Column | str) -> Column:
    """Append the check digits to a 12-digit base."""
    return F.concat(_col(base), check_digits(base))


def is_valid_tax_id(tax_id: Column | str, *, strict: bool = False) -> Column:
    """True for 14 digits with matching check digits; NULL and any other text are false.

    A line break behind the digits makes it another text. All zeros satisfy the arithmetic. ``strict`` also rejects one digit repeated 14 times.
    """
    digits = strip_punctuation(tax_id)
    # longer digit strings are not numbers of this kind; cutting them keeps the arithmetic in range
    number = F.substring(digits, 1, 14).try_cast("long")
    # the arithmetic comes first because only what is always evaluated is computed once per row
    valid = (number % 100 == check_number(F.call_function("div", number, F.lit(100).cast("long")))) & digits.rlike(r"^[0-9]{14}\z")
    if strict:
        valid = valid & ~digits.rlike(r"^([0-9])\1{13}\z")
    return F.coalesce(valid, F.lit(False))


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column

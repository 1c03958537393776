"""Column expressions: every function takes and returns Spark columns."""

from .periods import after, closed_before, in_month_of, month_end, month_start, since
from .taxid import check_digits, complete_tax_id, is_valid_tax_id, strip_punctuation
from .text import fill_default, normalize_term, trim_cast
from .amounts import deviation_percent, instalment_value, within_percent

__all__ = [
    "after",
    "check_digits",
    "closed_before",
    "complete_tax_id",
    "deviation_percent",
    "fill_default",
    "in_month_of",
    "instalment_value",
    "is_valid_tax_id",
    "month_end",
    "month_start",
    "normalize_term",
    "since",
    "strip_punctuation",
    "trim_cast",
    "within_percent",
]

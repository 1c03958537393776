"""Heuristic quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule's cost and the share of documents it rejects are estimated on a sample, and rules
are tried in order of rejection per cost; a document that one rule rejects is not given to the
rest. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import shared_copy

SAMPLE = 1000
"""Documents that costs and rejections are estimated on; verdicts do not depend on it."""

WINDOW = 8
"""Words of a window that is looked for again in the same text."""

_SPACES = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"


class Rule(NamedTuple):
    """``rejects`` is a condition on the base columns and the text column ``__text``."""

    name: str
    rejects: Callable[[], Column]


RULES = (
    Rule("symbols", lambda: F.col("n_symbols") * 10 > F.col("n_words") * 3),
    Rule("repeated_lines", lambda: (F.col("n_dup_lines") > 2) & (F.col("n_dup_lines") * 100 > F.col("__n_lines") * 30)),
    Rule("word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words"))),
    Rule("shouting", lambda: F.length(F.regexp_replace("__text", r"[^\p{Lu}]+", "")) * 2 > F.col("word_chars")),
    Rule("exclamation", lambda: F.regexp_count("__text", F.lit("!")) * 10 > F.col("n_words") * 3),
    Rule("letters", lambda: F.length(F.regexp_replace("__text", r"[^\p{L}]+", "")) * 2 < F.col("word_chars")),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound once; a lambda's own references are not computed again for each element."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in the same list.

    Windows are compared by 64-bit hashes of their words' 64-bit hashes. A list without a
    repeated window, the usual case, costs one pass over its windows and no sort.
    """
    nothing = F.lit(0).cast("long")

    def starts(hashes: Column) -> Column:
        """Where repeated windows start, in order."""

        def repeated(ordered: Column) -> Column:
            same = lambda x, k: (F.get(ordered, k - 1)["h"] == x["h"]) | (F.get(ordered, k + 1)["h"] == x["h"])
            return F.sort_array(F.transform(F.filter(ordered, lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x["i"]))

        return _let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated)

    def covered(found: Column) -> Column:
        reach = F.transform(found, lambda i, k: F.least(F.lit(window), F.coalesce(F.get(found, k + 1) - i, F.lit(window))))
        return F.aggregate(reach, nothing, lambda total, x: total + x)

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), nothing).otherwise(_let(starts(hashes), covered))

    def windows(single: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(single) - (window - 1)), lambda i: F.xxhash64(F.slice(single, i, window)))

    hashes = lambda: _let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(F.size(words) > window, _let(hashes(), counted)).otherwise(nothing)


def base_counts(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with the whole text's counts, in long columns, NULL text counting as empty:

    n_words, word_chars (code points in words), n_symbols (characters of ``#*$%&|<>``),
    n_dup_lines (lines with a word that equal an earlier line), n_repeat_words (words in
    repeated windows), and the working columns __text and __n_lines (lines with a word).
    Columns of ``docs`` that have these names are replaced.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "__text", "__n_lines", "__words", "__lines")
    source = docs.select(*(F.col(c) for c in docs.columns if c not in made), F.coalesce(F.col(text), F.lit("")).alias("__body"))
    worded = source.withColumn("__words", F.array_remove(F.split("__body", f"{_SPACES}+"), "")).withColumn(
        "__lines", F.filter(F.split("__body", "\n"), lambda line: line.rlike(_WORD))
    )
    return (
        worded.withColumn("n_words", F.size("__words").cast("long"))
        .withColumn("word_chars", F.aggregate("__words", F.lit(0).cast("long"), lambda total, w: total + F.length(w)))
        .withColumn("n_symbols", F.length(F.regexp_replace("__body", r"[^#*$%&|<>]+", "")).cast("long"))
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
        .withColumn("n_repeat_words", repeat_words(F.col("__words")).cast("long"))
        .withColumn("__n_lines", F.size("__lines").cast("long"))
        .withColumnRenamed("__body", "__text")
        .drop("__words", "__lines")
    )


def base_failed() -> Column:
    """Fewer than 20 words, or over 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def order_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, *, text: str = "text", sample: int = SAMPLE) -> list[Rule]:
    """``rules`` by rejections per second on a random sample of about ``sample`` documents.

    A rule's cost is the time of a pass that evaluates it over the sample less that of an
    empty pass; both are taken twice and the shorter counts.
    """
    chosen, total = docs.select(text), docs.count()  # rows in the footers
    if total > sample:
        # drawn where the texts are read: no task gets the rows of another one
        chosen = chosen.sample(fraction=sample / total, seed=7)
    counted = shared_copy(base_counts(chosen, text=text))
    rows = counted.count()

    def seconds(condition: Column) -> tuple[float, int]:
        taken, found = [], 0
        for _ in range(2):
            began = time.perf_counter()
            found = counted.agg(F.count_if(condition)).first()[0]
            taken.append(time.perf_counter() - began)
        return min(taken), found

    nothing = seconds(F.length("__text") < 0)[0]
    ranked = []
    for place, rule in enumerate(rules):
        cost, found = seconds(rule.rejects())
        ranked.append((-(found / max(rows, 1)) / max(cost - nothing, 1e-4), place, rule))
    return [rule for *_, rule in sorted(ranked, key=lambda r: r[:2])]


def cascade(counted: DataFrame, rules: Sequence[Rule], *, into: str = "rejected_by") -> DataFrame:
    """The first rule in the given order that rejects each row of :func:`base_counts`, else NULL.

    Later rules are not evaluated for a rejected row.
    """
    verdict = F.when(base_failed(), F.lit("base"))
    for rule in rules:
        verdict = verdict.when(rule.rejects(), F.lit(rule.name))
    return counted.withColumn(into, verdict)


def judge_quality(docs: DataFrame, rules: Sequence[Rule] = RULES, *, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with :func:`base_counts`, base_failed, rejected_by (which rule depends on the order) and kept (which does not).

    Texts without words, NULL and empty ones included, fail the base. Repeated rows repeat.
    """
    judged = cascade(base_counts(docs, text=text), order_rules(docs, rules, text=text, sample=sample))
    return judged.withColumn("base_failed", base_failed()).withColumn("kept", F.col("rejected_by").isNull()).drop("__text", "__n_lines")

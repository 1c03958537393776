"""The corpus pipeline: language, quality, near duplicates, repeated passages, packing.

``STAGES`` names the stages in order; each takes ``(spark, docs, sf_dir)`` and gives the next
one its documents. Rows with a NULL id or text pass through like any other: a text without a
letter has no language and goes at the first stage, a row without an id is a duplicate of
nothing. Empty tables give empty results; without labels of both kinds no quality can be told
and all that the ranker then scores at its decision stay. A packed document keeps its id alone;
all other stages keep every column, whatever its name.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashloom.llm.langid import DIMENSIONS, UNKNOWN, learn_profiles, predict_language
from cashloom.llm.ngram import BROADCAST_IDS, similar_components
from cashloom.llm.packing import pack_documents
from cashloom.llm.quality import DECISION, learn_ranker, score_quality
from cashloom.llm.queries import remainder
from cashloom.llm.repeats import cut_repeats
from cashloom.sources.staging import shared_copy

LEAST_LIKENESS = 4 / DIMENSIONS**0.5
"""Cosine below which a text is like no language that was learned: four deviations of two random vectors' cosine."""

LEAST_LETTERS = 100
"""Letters without which a text's likeness says too little to reject it."""


BATCH_BYTES = 8 << 20
"""Bytes of texts that a task hands to Python at once; stages of one session add up what their batches leave behind."""

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage in a session whose Arrow batches hold at most ``BATCH_BYTES``; the setting stays, as results are lazy."""

    @wraps(stage)
    def smaller(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return smaller


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that their own labels teach; without any language, all go.

    Texts without a letter go, and those of ``LEAST_LETTERS`` letters or more that are like no
    language that was learned.
    """
    judged = predict_language(docs, learn_profiles(docs), into=("__lang", "__likeness"))
    unlike = (F.col("__likeness") < LEAST_LIKENESS) & (F.length(F.regexp_replace("text", r"[^\p{L}]+", "")) >= LEAST_LETTERS)
    return judged.where((F.col("__lang") != UNKNOWN) & ~unlike).select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranker scores at its decision or above; learned from labels of crc32(doc_id) mod 5 other than 0."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder("doc_id", 5) != 0)
    scored = score_quality(docs, learn_ranker(docs, labels), into="__score")
    return scored.where(F.col("__score") >= DECISION).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group, and all that link with nothing; rows repeated whole once."""
    answer = shared_copy(similar_components(docs.select("doc_id", "text")))
    gone = shared_copy(answer.where("doc_id <> component_id").select("doc_id").distinct())
    again = shared_copy(answer.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))

    def without(frame: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        few = ids.count() <= BROADCAST_IDS
        return frame.join(F.broadcast(ids) if few else ids, "doc_id", how)

    single = without(docs, gone, "left_anti")
    if again.limit(1).count():
        twice = without(single, again, "left_semi")
        rest = [c for c in docs.columns if c not in ("doc_id", "text")]
        # of rows equal in id and text that differ elsewhere, the one with the smallest other columns
        one = twice.groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("__rest")) if rest else twice.distinct()
        once = one.select("doc_id", "text", *[F.col(f"__rest.`{c}`").alias(c) for c in rest]).select(docs.columns)
        single = without(single, again, "left_anti").select(docs.columns).unionByName(once)
    return single.select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that earlier documents have; documents of which nothing is left go."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    # kept in one column, whatever their names
    apart = docs.select("doc_id", "text", F.struct(*rest, F.lit(0).alias("__none")).alias("__rest"))
    cut = cut_repeats(apart)
    left = cut.where((F.col("n_removed") < F.col("n_bytes")) | (F.col("n_bytes") == 0))
    back = left.select("doc_id", "text", *[F.col(f"__rest.`{c}`").alias(c) for c in rest])
    if "n_chars" in rest:
        back = back.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return back.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' token pieces in sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", in_small_batches(language)),
    ("quality_classifier", in_small_batches(quality)),
    ("ngram_jaccard_join", in_small_batches(near_duplicates)),
    ("suffix_array_dedup", in_small_batches(repeated_passages)),
    ("best_fit_packing", in_small_batches(packing)),
]

ORACLE_SQL = None
"""Learned profiles, components of links and packing have no SQL; tests compare the stages with plain Python."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = shared_copy(stage(spark, docs, sf_dir))
    return docs

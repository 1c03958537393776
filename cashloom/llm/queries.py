"""The registered queries of this subpackage, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: str, parts: int) -> Column:
    return F.crc32(F.col(key).cast("string")) % parts


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from .bpe import token_digests

    return token_digests(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    from .ngram import similar_components

    return similar_components(_table(spark, folder, "documents").select("doc_id", "text"))


def op4_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from .embeddings import near_duplicates

    return near_duplicates(_table(spark, folder, "embeddings"))


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    from .quality import DECISION, learn_ranker, score_quality

    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    held_out = remainder("doc_id", 5) == 0
    ranker = learn_ranker(docs, labels.where(~held_out))
    return score_quality(docs.select("doc_id", "text"), ranker).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= DECISION).cast("int").alias("predicted")
    )


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from .rules import judge_quality

    judged = judge_quality(_table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from .repeats import cut_repeats

    return cut_repeats(_table(spark, folder, "documents").select("doc_id", "text"), digest=True)


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from .langid import learn_profiles, predict_language

    docs = _table(spark, folder, "documents")
    held_out = remainder("doc_id", 4) == 2
    profiles = learn_profiles(docs.where(~held_out))
    return predict_language(docs.select("doc_id", "text"), profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    from .html import extract_main_text

    return extract_main_text(_table(spark, folder, "pages").select("page_id", "url", "html"))


def op10_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    from .warc import round_trip

    return round_trip(_table(spark, folder, "pages")).drop("url")


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    from .resampling import resample

    drawn = resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), keep=["doc_id"])
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    from .periodic import periodic_runs

    docs = _table(spark, folder, "documents").select("doc_id", planted_period("doc_id", "text").alias("text"))
    found = periodic_runs(docs, keep=["doc_id"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("(1000 * best.n) div (-best.p)").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted_period(key: str, text: str) -> Column:
    """The text, or, for a tenth of the documents, its words with a period from one place on, as the query's contract has it."""
    h = F.crc32(F.col(key).cast("string"))
    g = F.expr(f"crc32(cast({key} as string)) div 10")

    def periodic(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("int")
        repeated = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p)))
        return F.array_join(repeated, " ")

    words = F.array_remove(F.split(F.col(text), r"[\x20\x09-\x0D]+"), "")
    # bound once, as a lambda would split the text again for every word
    changed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, periodic(w)).otherwise(F.lit("")))[0]
    return F.when(h % 10 == 0, changed).otherwise(F.col(text))


def op13_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from .mixing import mix_sources, taken_words

    mixed = taken_words(mix_sources(_table(spark, folder, "documents")))
    return mixed.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_bpe_round_trip,
        op3_ngram_jaccard,
        op4_embedding_near_dedup,
        op5_quality_classifier,
        op6_quality_rules,
        op7_suffix_dedup,
        op8_language_id,
        op9_html_extraction,
        op10_warc_revisits,
        op11_importance_resampling,
        op12_periodic_runs,
        op13_source_mixing,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {
    "op6_quality_rules": rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, list_aggregate(words[i:i + 7], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) > 8)),
dup AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
cover AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM dup) GROUP BY doc_id),
base AS (
  SELECT w.doc_id, text, lines, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cover ON w.doc_id = cover.doc_id),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    n_symbols * 10 > n_words * 3 OR (n_dup_lines > 2 AND n_dup_lines * 100 > len(lines) * 30)
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) * 2 > word_chars
    OR length(regexp_replace(text, '[^!]+', '', 'g')) * 10 > n_words * 3
    OR length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) * 2 < word_chars AS rejected
  FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM judged""",
    "op10_warc_revisits": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(sha1(html), (10 * (i // 8) + 1)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest
  FROM p),
o AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM o""",
    **sql.ORACLES,
}

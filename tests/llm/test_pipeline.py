"""The stages of the corpus pipeline, each against plain Python on its own input."""

from collections import Counter

import pyarrow as pa

import corpus_pipeline as pipeline
from cashloom.llm import memory
from .test_near_duplicates import expected_components, expected_cuts

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["language_id", "quality_classifier", "ngram_jaccard_join", "suffix_array_dedup", "best_fit_packing"]
    extra = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "12 34", "en", "s", 5)], docs.schema)
    spoken = stages["language_id"](spark, docs.unionByName(extra), FOLDER)
    assert spoken.columns == docs.columns
    kept = {r.doc_id for r in spoken.select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()}

    good = pipeline.shared_copy(stages["quality_classifier"](spark, spoken, FOLDER))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    left = {r.doc_id for r in good.select("doc_id").collect()}
    judged = [k for k in kept if k in labels]
    assert sum((k in left) == (labels[k] == 1) for k in judged) >= 0.95 * len(judged)

    single = pipeline.shared_copy(stages["ngram_jaccard_join"](spark, good.unionByName(good.limit(3)), FOLDER))
    rows = [(r.doc_id, r.text) for r in good.select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in single.select("doc_id").collect()) == sorted(k for k, _, c in expected_components(rows) if k == c)

    cut = pipeline.shared_copy(stages["suffix_array_dedup"](spark, single, FOLDER))
    assert cut.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in single.select("doc_id", "text").collect()]
    expected = {k: n - gone for k, n, gone, _, _ in expected_cuts(rows)}
    found = {r.doc_id: r for r in cut.collect()}
    assert set(found) == {k for k, n in expected.items() if n}
    assert all(len(r.text) == r.n_chars and len(r.text.encode()) <= expected[k] for k, r in found.items())

    packed = stages["best_fit_packing"](spark, cut, FOLDER).collect()
    assert {r.doc_id for r in packed} == set(found)
    assert all(n == sum(1 for r in packed if r.doc_id == k) for k, n in Counter(r.doc_id for r in packed).items())


def test_run_is_the_stages_in_order(spark):
    done = pipeline.run(spark, FOLDER)
    assert done.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(done.columns)


def labelled(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_on_odd_rows(spark, tmp_path):
    """NULL ids and texts, a very long text, repeated rows, and columns named like working ones."""
    prose = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").where("n_chars between 500 and 3000").orderBy("doc_id").limit(20).collect()]
    names = "doc_id long, text string, lang string, source string, n_chars long, n_bytes long, n_spans string, component_id long, __score double"
    rows = [(k, x, "en", "s", len(x), 777 + k, "mine", -1, 0.5) for k, x in enumerate(prose)]
    rows += [(None, prose[0], "en", "s", 1, 2, "x", 3, 4.0), (50, None, None, None, None, None, None, None, None), (51, "", "en", "s", 0, 0, "", 0, 0.0)]
    long = " ".join(prose) * 40
    rows += [(52, long, "en", "s", len(long), 888, "long", 9, 0.1)] + [rows[3]] * 2 + [(rows[4][0], rows[4][1], "en", "zz", 5, 5, "other", 5, 5.0)]
    docs = spark.createDataFrame(rows, names)
    labelled(spark, tmp_path, [(k, k % 2, 0) for k in range(20)])
    stages = dict(pipeline.STAGES)
    spoken = pipeline.shared_copy(stages["language_id"](spark, docs, str(tmp_path)))
    assert spoken.columns == docs.columns and spoken.count() == len(rows) - 2
    good = stages["quality_classifier"](spark, spoken, str(tmp_path))
    assert good.columns == docs.columns and good.count() <= spoken.count()
    single = pipeline.shared_copy(stages["ngram_jaccard_join"](spark, spoken, str(tmp_path)))
    kept = single.collect()
    assert single.columns == docs.columns
    assert len([r for r in kept if r.doc_id == rows[3][0]]) == 1
    (four,) = [r for r in kept if r.doc_id == rows[4][0]]
    assert (four.source, four.n_bytes, four.n_spans) == ("s", 781, "mine")
    assert len([r for r in kept if r.doc_id is None]) == 1
    cut = pipeline.shared_copy(stages["suffix_array_dedup"](spark, single, str(tmp_path)))
    assert cut.columns == docs.columns
    left = {r.doc_id: r for r in cut.collect()}
    assert left[0].n_bytes == 777 and left[0].n_spans == "mine" and left[0].text == prose[0]
    assert None not in left  # its text is a later copy
    assert all(r.n_chars == len(r.text) for r in left.values())
    packed = stages["best_fit_packing"](spark, cut, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(left)


def test_stages_on_an_empty_table(spark, tmp_path):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    labelled(spark, tmp_path, [(1, 1, 0)])
    docs = spark.createDataFrame([], schema)
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.shared_copy(stage(spark, docs, str(tmp_path)))
        assert docs.columns == schema.names and docs.count() == 0, name
    assert pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0


def test_language_keeps_short_texts_and_rejects_unlearned_ones(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    russian = "Съешь же ещё этих мягких французских булок да выпей чаю, а потом мы пойдём гулять по городу и увидим много интересного вокруг. "
    extra = [(9001, "Zsófi", None, "s", 0), (9002, "A.", None, "s", 0), (9003, russian * 3, None, "s", 0), (9004, "日本語の文章です今日は天気がいいですね" * 9, None, "s", 0)]
    spoken = dict(pipeline.STAGES)["language_id"](spark, docs.unionByName(spark.createDataFrame(extra, docs.schema)), FOLDER)
    assert {r.doc_id for r in spoken.where("doc_id > 9000").collect()} == {9001, 9002}


def test_a_group_gives_its_memory_back_before_its_result_is_sent(monkeypatch):
    table, said = pa.table({"n": [1, 2]}), []
    monkeypatch.setattr(memory, "release", lambda: said.append("released"))
    assert memory.letting_go_of_groups(lambda t: said.append("made") or t)(table) is table
    assert said == ["made", "released"]

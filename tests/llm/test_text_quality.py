"""Language, quality, rules, web pages and archives: held-out accuracy, SQL, and edge cases."""

import re
from base64 import b32encode
from collections import Counter
from hashlib import sha1
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from cashloom.llm import langid, quality, rules, warc
from cashloom.llm.html import extract_main_text, main_text
from cashloom.llm.queries import ORACLES, QUERIES, remainder
from workload.check import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op6_quality_rules"])
def test_native(spark, plan, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_languages_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out").select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_edges(spark):
    rows = [("the cat and the hat " * 5, "en"), ("le chat et la souris " * 5, "fr"), (None, "fr"), ("no label", None), ("", "en")]
    learned = langid.learn_profiles(spark.createDataFrame(rows, "text string, lang string"))
    assert learned.languages == ["en", "fr"]
    asked = [(1, "the hat", "a"), (2, "LE CHAT", "b"), (3, None, "c"), (4, "12 ?!", "d"), (5, "", "e"), (5, "", "e"), (None, "the cat " * 200_000, "f"), (7, "日本語", "g")]
    frame = spark.createDataFrame(asked, "doc_id long, text string, score string")
    found = langid.predict_language(frame, learned).collect()
    by = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert [by[k][0] for k in (1, 2, 3, 4, 5, None)] == ["en", "fr", "und", "und", "und", "en"] and by[3][1] == by[4][1] == 0
    assert len(found) == 8 and by[7][0] in ("en", "fr")
    none = langid.learn_profiles(frame.limit(0).withColumnRenamed("score", "lang"))
    assert {r.lang_pred for r in langid.predict_language(frame, none).collect()} == {"und"}


def test_trigrams_do_not_depend_on_chunks(monkeypatch):
    text = "Ein  Satz, mit 3 Zahlen -- und  Rändern!  " * 40
    whole = dict(zip(*(x.tolist() for x in langid.trigrams(text)), strict=True))
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(langid, "CHUNK", size)
        assert dict(zip(*(x.tolist() for x in langid.trigrams(text)), strict=True)) == whole


def test_profiles_do_not_depend_on_what_a_task_holds(spark, monkeypatch):
    from cashloom.llm import langid

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    whole = langid.learn_profiles(docs)
    for held in (50, 3000, 20000):
        monkeypatch.setattr(langid, "HELD", held)
        again = langid.learn_profiles(docs)
        assert again.languages == whole.languages and (again.ready == whole.ready).all()
        assert abs(again.prototypes - whole.prototypes).max() < 1e-5


def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = QUERIES["op5_quality_classifier"](spark, folder).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in found) >= 0.95 * len(found)
    assert QUERIES["op5_quality_classifier"](spark, folder).where(remainder("doc_id", 5) == 0).where("not held_out").count() == 0


def test_quality_edges(spark):
    good, bad = "Some words of a calm and ordinary sentence, as people write them. " * 8, "BUY!! NOW!! CHEAP!! " * 40
    docs = spark.createDataFrame([(k, good + str(k) if k % 2 else bad + str(k), 1) for k in range(40)] + [(50, None, 1), (51, "", 1), (None, good, 1), (1, good, 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)] + [(None, 1), (3, None), (4, 1), (60, 0)], "doc_id long, quality int")
    ranker = quality.learn_ranker(docs, labels)
    found = quality.score_quality(docs, ranker).collect()
    assert len(found) == 44
    assert all(r.score == 0 for r in found if r.doc_id in (50, 51))
    assert all((r.score >= quality.DECISION) == (r.doc_id % 2 == 1) for r in found if r.doc_id is not None and r.doc_id < 40)
    alone = quality.learn_ranker(docs, labels.where("quality = 1"))
    assert {round(r.score, 6) for r in quality.score_quality(docs, alone).collect()} == {0.0, quality.DECISION}
    assert quality.score_quality(docs.limit(0), ranker).count() == 0


@pytest.mark.parametrize("label, predicted", [(0, 0), (1, 1), (None, 1)])
def test_quality_with_one_label_or_none(spark, label, predicted):
    """All labels 0 predict 0 and all 1 predict 1; without labels texts lie at the decision."""
    texts = ["Plain prose about a river and a bridge.", "zz ## zz ## zz !!", "word " * 200_000, "Plain prose about a river and a bridge."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [] if label is None else [(k, label, 0) for k in range(3)]
    ranker = quality.learn_ranker(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    scores = [r.score for r in quality.score_quality(docs, ranker).orderBy("doc_id").collect()]
    assert [int(x >= quality.DECISION) for x in scores] == [predicted] * 4
    assert scores[0] == scores[3] and (label == 0 or scores[0] == pytest.approx(quality.DECISION))


def test_rules_on_repeated_rows_and_null_ids(spark):
    lines = [(None, "one two three " * 9), (5, None), (5, None), (None, "one two three " * 9), (7, "! " * 30)]
    found = rules.judge_quality(spark.createDataFrame(lines, "doc_id long, text string"), sample=2)
    got = sorted(((r.doc_id, r.n_words, r.base_failed, r.kept) for r in found.collect()), key=repr)
    assert got == sorted([(None, 27, True, False)] * 2 + [(5, 0, True, False)] * 2 + [(7, 30, True, False)], key=repr)


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    inside = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


def test_rule_counts(spark, documents):
    texts = [None, "", " \n\t", "a b c d e f g h " * 3, "one two three four five six seven eight", "x\nx\n x\nx", "é ü   🙂 # <", "w " * 30_000, "a b c d e f g h a b c d e f g h i"]
    texts += [t for _, t in documents[1]]
    frame = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, kept string")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = rules.judge_quality(frame)
    found = {r.doc_id: r for r in judged.collect()}
    for k, text in enumerate(texts):
        assert tuple(found[k][n] for n in names) == counted(text)
    assert all(r.kept == (r.rejected_by is None) and not (r.base_failed and r.kept) for r in found.values())
    # the order of the rules changes who rejects, not what is rejected
    backwards = rules.cascade(rules.base_counts(frame), rules.RULES[::-1]).where("rejected_by is null").select("doc_id").collect()
    assert {r.doc_id for r in backwards} == {k for k, r in found.items() if r.kept}
    assert rules.judge_quality(frame.limit(0)).count() == 0


def test_rules_are_ordered_by_rejections_for_their_cost(spark):
    frame = spark.createDataFrame([("ordinary words " * 20,)] * 50, "text string")
    never = rules.Rule("never", lambda: rules.F.col("n_words") < 0)
    always = rules.Rule("always", lambda: rules.F.col("n_words") > 0)
    assert [r.name for r in rules.order_rules(frame, (never, always))] == ["always", "never"]


def test_main_text_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in extract_main_text(pages).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        text = " ".join(unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert found[page.page_id].text == text and found[page.page_id].n_chars == len(text)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header>Site name</header><div class="menu"><a href="x">One</a> <a href="y">Two</a></div>
<div id="content"><h1>Title &amp; more</h1><div class="text"><p>First   paragraph of the text, <b>long</b> enough to count.<script>var x = "<p>";</script></p>
<p>Second paragraph&nbsp;with a <a href="l">link</a> in it and more words.<ul><li>item one<li>item two</ul></div></div>
<form><input name="q">Search</form><div class="cookie-notice">We use cookies, many of them, for all kinds of things that you can not know.</div>
<section id="comments"><p>A reader comment that is rather long and goes on and on, as they do.</p></section><footer>&copy; us</footer></body></html>"""


def test_main_text_without_an_article_element():
    expected = "Title & more First paragraph of the text, long enough to count. Second paragraph with a link in it and more words. item one item two"
    assert main_text(PAGE) == expected
    inside = PAGE.replace('<div id="content">', "<article>").replace('<section id="comments">', "</article><section id='comments'>", 1)
    assert main_text(inside).startswith(expected)
    article = "<article><header><h1>H</h1></header><p>Body text</p><aside>ad</aside><div class='comments'>c</div></article>"
    assert main_text(f"<body><nav>n</nav>{article}<footer>f</footer></body>") == "H Body text"


def test_main_text_inside_wrappers_with_listed_words():
    """Names cut at hyphens, listed names and forms around the whole page lose nothing; what they name inside still goes."""
    body = "<h1>Title</h1><p>First paragraph of the text, long enough to count.</p><p>Second paragraph, with more words in it.</p>"
    expected = "Title First paragraph of the text, long enough to count. Second paragraph, with more words in it."
    other = '<div class="menu"><a href="x">One</a></div><div class="ad">Buy now</div><div class="cookie-notice">We use cookies</div>'
    wrappers = ["<div class='content has-sidebar'>|</div>", "<div id='page' class='no-comments'>|</div>", "<section class='social-science'>|</section>"]
    wrappers += ["<div class='layout nav-open'>|</div>", "<form action='page.aspx'>|</form>", "<div class='sidebar-right'>|</div>", "<form><div class='widget'>|</div></form>"]
    for wrapper in wrappers:
        for article in (body, f"<article>{body}</article>", f"<main>{body}</main>"):
            assert main_text(f"<html><body>{wrapper.replace('|', article + other)}</body></html>") == expected, (wrapper, article)
    comments = f"<section class='comments'>{'<p>A long comment.</p>' * 50}</section>"
    related = "<div class='related'><article><p>Teaser text.</p></article></div>"
    assert main_text(f"<body><article>{body}</article>{comments}{related}</body>") == expected


def test_main_text_beside_the_article_in_main():
    article = "<article><h1>Title</h1><p>The text of the article, long enough to count as such.</p><p>And a second paragraph of it.</p></article>"
    teasers = '<div class="grid"><p><a href="a">Another story to read</a></p><p><a href="b">One more story to read</a></p></div>'
    expected = "Title The text of the article, long enough to count as such. And a second paragraph of it."
    assert main_text(f"<body><main>{article}{teasers}</main></body>") == expected
    assert main_text(f"<body><article><main><article>{article[9:]}</main>{teasers}</article></body>") == expected
    plain = article.replace("article>", "div>")
    assert main_text(f"<body><p>Site</p><main>{plain}{teasers}</main></body>") == expected


STORY = "The river rose over night and took the old bridge with it, the mayor said on Monday. " * 3
CHAT = "I never liked that bridge anyway, and my uncle who built it said the same thing back then. " * 8


@pytest.mark.parametrize(
    "page",
    [
        "<body><article><p>{s}</p><section id='comments'><article class='c'><p>{c}</p></article><article class='c'><p>{c}</p></article></section></article></body>",
        "<body><article><p>{s}</p></article><div class='comments'><article><p>{c}</p></article></div></body>",
        "<body><main><article><p>{s}</p></article><section class='comment-list'><article>{c}</article></section></main></body>",
        "<body><article><p>{s}</p><div id='comments'><div class='comment'>{c}</div></div></article></body>",
        "<body><article><p>{s}</p><div class='related'><article>{c}</article><article>{c}</article></div></article></body>",
    ],
)
def test_reader_comments_are_left_out_however_long(page):
    assert main_text(page.format(s=STORY, c=CHAT)) == " ".join(STORY.split())


def test_an_article_in_a_doubtful_wrapper_stays_where_there_is_no_other():
    assert main_text(f"<body><div class='comments'><article><p>{STORY}</p></article></div></body>") == " ".join(STORY.split())


def test_cells_of_links_in_a_table_layout():
    menu = "<td><a href='/'>x</a> <a href='/y'>y</a> <a href='/z'>z</a></td>"
    page = f"<body><table><tr>{menu}<td><p>{STORY}</p><p>{STORY}</p></td></tr></table></body>"
    assert main_text(page) == " ".join((STORY * 2).split())


def test_main_text_edges(spark):
    texts = [None, "", "plain", "<p>open <b>tags <i>only", "<div>" * 3000 + "deep" + "</div>" * 3000, "<!-- only -->", "</p></div>stray", "<script>x</script>", "<p>" + "long text " * 100_000 + "</p>", "a<br>b"]
    frame = spark.createDataFrame([(k, None, t, "x") for k, t in enumerate(texts)] + [(None, "u", "plain", "x")], "page_id long, url string, html string, text string")
    found = [(r.page_id, r.text) for r in extract_main_text(frame).collect()]
    by = dict(found)
    assert by[0] == by[1] == by[5] == by[7] == "" and by[2] == by[None] == "plain" and by[3] == "open tags only"
    assert by[4] == "deep" and by[6] == "stray" and len(by[8]) == 10 * 100_000 - 1 and by[9] == "a b"
    assert extract_main_text(frame.limit(0)).count() == 0


def test_archives(spark, tmp_path):
    body = "<p>same</p>"
    rows = [(1, "http://a", body), (2, "http://b\r\nX: y", body), (9, None, body), (3, "c", None), (4, "d", ""), (5, "e", "ü\r\n\r\nWARC/1.1\r\n" * 3), (6, "f", "z" * 3_000_000), (None, "g", body), (7, "h", "only"), (7, "h", "only")]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, record_type int")
    warc.write_archives(frame, str(tmp_path / "w"), archive_bytes=1 << 20)
    found = warc.read_archives(spark, str(tmp_path / "w"), payloads=True).collect()
    assert len(found) == len(rows)
    originals = {None: 9, 1: 9, 2: 9, 3: 4}
    for r in found:
        text = next(t for k, _, t in rows if k == r.page_id) or ""
        assert r.payload_bytes == len(text.encode()) and r.payload_digest == b32encode(sha1(text.encode()).digest()).decode()
        assert r.refers_to == originals.get(r.page_id) and r.record_type == ("revisit" if r.page_id in originals else "response")
        assert (r.payload is None) == (r.page_id in originals) and (r.payload is None or r.payload.decode() == text)
    large = warc.round_trip(frame, min_payload=5).where("payload_bytes < 5")
    assert {r.record_type for r in large.collect()} == {"response"}
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_records_of_several_members_and_small_pieces():
    import gzip

    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    data = gzip.compress(record) + gzip.compress(record * 3)
    found = list(warc.parse_records(warc._unzip(memoryview(data), 7)))
    assert [block for _, block in found] == [b"hello"] * 4
    with pytest.raises(ValueError):
        list(warc.parse_records([record[:-6]]))


def test_features_are_bounded():
    rows = np.stack([quality.features(t) for t in ("a", "A!! B!!", "x " * 1000, "日本 語", "| | |")])
    assert np.isfinite(rows).all() and (np.abs(rows) <= 5).all()


def test_quality_is_learned_from_every_label(spark):
    """The fit is that of all pairs of all labelled documents, found here by plain Newton steps on all differences."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, quality.WIDTH))
    label = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=300) > 0.3).astype(int)
    learned = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(label, x, strict=True)], "label int, x array<double>").repartition(5)
    found = quality.fit_preferences(learned)
    unit = (x - x.mean(axis=0)) / x.std(axis=0)
    pairs = (unit[label == 1][:, None] - unit[label == 0][None]).reshape(-1, quality.WIDTH)
    weights = np.zeros(quality.WIDTH)
    for _ in range(20):
        p = 1 / (1 + np.exp(-pairs @ weights))
        curve = (pairs * (p * (1 - p))[:, None]).T @ pairs / len(pairs) + 1e-2 * np.eye(quality.WIDTH)
        weights -= np.linalg.solve(curve, pairs.T @ (p - 1) / len(pairs) + 1e-2 * weights)
    assert abs(found.weights - weights).max() < 2e-3
    strength = unit @ weights
    share = (label == 0).mean()
    errors = [((strength >= c) != label).sum() for c in np.quantile(strength, np.linspace(share - 0.1, share + 0.1, 400))]
    assert ((strength >= found.threshold) != label).sum() <= min(errors) + 1


def test_quality_labels_past_six_thousand_count(spark):
    """Rows that no bounded draw of ids would hold change the model: they all reach the fit."""
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat(F.lit("plain words "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    seen = []
    fit = quality.fit_preferences
    quality.fit_preferences = lambda learned, **o: (seen.append(learned.count()), fit(learned, **o))[1]
    try:
        quality.learn_ranker(docs, labels)
    finally:
        quality.fit_preferences = fit
    assert seen == [9000]

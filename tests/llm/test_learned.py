"""Language, page text and toxicity: held-out accuracy, and defined results for odd rows."""

import html
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from riskloom.llm import htmltext, langid, queries, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return queries.table(spark, SF, "documents")


@pytest.fixture(scope="module")
def language(docs):
    return queries.language_model(docs)


def test_held_out_fold(spark):
    rows = spark.range(200).select("id", langid.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_language_accuracy_on_the_held_out_fold(docs, language):
    told = langid.predict_language(docs, language).where(langid.held_out(F.col("doc_id"))).collect()
    right = sum(r["lang_pred"] == r["lang"] for r in told)
    assert right / len(told) > 0.98
    assert sum(not r["accepted"] for r in told) / len(told) < 0.01
    assert all(0 <= r["score"] <= 1 for r in told)


def test_languages_of_odd_texts(spark, language):
    rows = [(1, None), (2, ""), (3, "123 %%% \n"), (4, "THE and of the"), (5, "日本語の長いテキスト"), (6, "the " * 400_000), (6, "the " * 400_000)]
    df = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, score string")
    out = langid.predict_language(df, language)
    assert out.columns == ["doc_id", "text", "lang_pred", "score", "accepted"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and not got[1]["accepted"]
    assert got[4]["lang_pred"] == "en" and got[5]["lang_pred"] in language.languages and got[6]["lang_pred"] == "en"
    assert out.count() == 7 and langid.predict_language(df.limit(0), language).collect() == []


def test_pieces_of_a_long_text_add_up(language, monkeypatch):
    text = "the water and the fire " * 500
    whole = language.predict(text)
    monkeypatch.setattr(langid, "PIECE_CHARS", 1000)
    assert language.predict(text)[0] == whole[0] and abs(language.predict(text)[1] - whole[1]) < 1e-6


def test_no_labels_at_all(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = langid.fit_language_model(df)
    assert langid.predict_language(df, model).first()["lang_pred"] == "und"
    one = langid.fit_language_model(df.withColumn("lang", F.lit("en")))
    assert langid.predict_language(df, one).first()["lang_pred"] == "en"


def plain_article(page):
    body = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", body)
    blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p))).split()) for p in parts]
    return "\n\n".join(b for b in blocks if b)


def test_article_of_every_page(spark):
    pages = queries.table(spark, SF, "pages")
    model = htmltext.fit_page_model(pages)
    got = htmltext.extract_text(pages.withColumn("_h", F.col("html")), model).collect()
    assert len(got) == pages.count()
    assert all(r["text"] == plain_article(r["_h"]) for r in got)


PAGE = """<html><body class="post"><header><h1>Site</h1><nav><a href=x>Home</a></nav></header><div id="cookie-notice">We use cookies</div>
<div class="wrap"><main><article><h1>Title &amp; more</h1><p>First <a href=y>linked</a> para
 with   space.</p><div class="ad">Buy now</div><p>Second &eacute;.<ul><li>one<li>two</ul><script>var a = "</p>";</script>
<aside><p>Related stuff that is long enough to be text.</p></aside><section class="comments"><p>I think this is great, says a reader.</p></section>
<form><label>Name</label><input></form></article></main><div class="sidebar"><p>Some sidebar text</p></div></div><footer>&copy; 2020</footer></body></html>"""


def test_furniture_that_the_sample_lacks(spark):
    model = htmltext.fit_page_model(queries.table(spark, SF, "pages"))
    assert model.text(PAGE) == "Title & more\n\nFirst linked para with space.\n\nSecond é.\n\none\n\ntwo"
    plain = htmltext.TreeModel()
    assert plain.text("just text") == "just text" or plain.text("just text") == ""


def test_odd_pages(spark):
    model = htmltext.TreeModel()
    for page in ("", "<", "<p", "<!-- open", "</p></div>", "<b>" * 20_000 + "x", '<p class="' * 20_000, "<div>" * 5_000, "<script>", "a<br>b&#10;c&nbsp"):
        model.text(page)
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "<p>one\n two<p>three"), (3, "u", "<p>one\n two<p>three")]
    df = spark.createDataFrame(rows, "page_id long, text string, html string")
    got = htmltext.extract_text(df, model)
    assert got.columns == ["page_id", "text"] and got.count() == 4
    assert got.where("page_id < 3").select("text").distinct().first()["text"] == ""
    assert htmltext.extract_text(df.limit(0), model).collect() == []
    assert htmltext.fit_page_model(df.limit(0)).text("") == ""


def test_marginals_against_all_labellings():
    import itertools
    from math import exp

    model = htmltext.TreeModel()
    nodes, _ = htmltext.parse("<div><p>some words here</p><nav><a href=x>link</a></nav></div><div class=content>more</div>")
    score = model.unary(nodes)
    total, ones = 0.0, [0.0] * len(nodes)
    for states in itertools.product((0, 1), repeat=len(nodes)):
        z = sum(s * y for s, y in zip(score, states))
        z += sum(model.pair[states[n.parent]][y] for n, y in zip(nodes[1:], states[1:]))
        total += exp(z)
        for i, y in enumerate(states):
            ones[i] += y * exp(z)
    belief, _ = model.marginals(nodes)
    assert all(abs(b - o / total) < 1e-9 for b, o in zip(belief, ones))


def test_toxic_documents_are_found(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = queries.table(spark, sf, "documents").select("doc_id", "text"), queries.table(spark, sf, "labels").select("doc_id", "toxic")
    learn = labels.where("doc_id % 5 <> 0")
    sample = toxicity.labelled_sample(docs, learn, "toxic", rows_per_class=700)
    marked = sample.withColumn("insult", toxicity.holds_word(F.col("text"), queries.INSULTS) * F.col("toxic"))
    chain = toxicity.fit_chain(marked, ["insult", "toxic"])
    held = docs.join(labels.where("doc_id % 5 = 0"), "doc_id")
    got = toxicity.predict_toxicity(held, chain).collect()
    caught = [r["is_toxic"] for r in got if r["toxic"]]
    blamed = [r["is_toxic"] for r in got if not r["toxic"]]
    # Some labelled rows of this table hold none of the words that make the others toxic.
    assert sum(caught) / len(caught) > 0.75 and sum(blamed) / len(blamed) < 0.02


def test_odd_rows_of_the_chain(spark):
    chain = toxicity.train(["you idiot", "nice day", "idiot again", "fine text"] * 20, __import__("numpy").array([[1], [0], [1], [0]] * 20), ["bad"])
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "IDIOT " * 50_000, "z"), (3, "IDIOT " * 50_000, "z")], "doc_id long, text string, p_bad string")
    out = toxicity.predict_toxicity(df, chain)
    assert out.columns == ["doc_id", "text", "p_bad", "is_toxic"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[3]["is_toxic"] and not got[1]["is_toxic"] and got[1]["p_bad"] == got[2]["p_bad"] and out.count() == 4
    assert toxicity.predict_toxicity(df.limit(0), chain).collect() == []
    empty = toxicity.train([], __import__("numpy").zeros((0, 1), int), ["bad"])
    assert empty.predict("any")[0] <= 1


def test_brackets_in_quoted_values():
    def told(page):
        nodes, blocks = htmltext.parse(page)
        return [n.tag for n in nodes[1:]], [t for _, t in blocks]

    long = "<p class='ad'>no page text</p>" * 400
    assert told(f'<div data-x="{long}" id=main>page text</div>') == (["div"], ["page text"])
    assert told("""<div a="x>y" b='p>q' c = "r>s">one</div a="x>y">two""") == (["div"], ["one", "two"])
    # Only a value is quoted, and a quote that never closes ends with the tag.
    assert told("<p x=it's>one</p><p y=\"'>'\">two</p>") == (["p", "p"], ["one", "two"])
    assert told('<p title="open>one</p><p>two</p>') == (["p", "p"], ["one", "two"])
    nodes, _ = htmltext.parse("""<div data-x='<i class="ad">' CLASS = "main post"id=story>text</div>""")
    assert nodes[1].words == {"main", "post", "story"}


def test_pages_whose_markup_names_no_article():
    """The same texts come out when ``article`` and ``main`` are plain divisions in the whole table."""
    rows = duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet' ORDER BY page_id").fetchall()
    pages = [r[0] for r in rows]
    plain = [re.sub(r"(</?)(article|main)\b", r"\1div", p) if p else p for p in pages]
    model, other = htmltext.train(pages[:150]), htmltext.train(plain[:150])
    want, got = [model.text(p) for p in pages], [other.text(p) for p in plain]
    assert sum(a == b for a, b in zip(want, got)) >= 0.95 * len(pages)
    assert not [1 for a, b in zip(want, got) if a and not b]


def test_densest_element():
    page = "<body><nav><a href=x>one link and another</a></nav><div><div><p>a text of some length</p><p>and its second part</p></div><div><a href=y>more</a></div></div></body>"
    nodes, _ = htmltext.parse(page)
    article = htmltext.densest(nodes)
    assert nodes[article].tag == "div" and [nodes[c].tag for c in nodes[article].children] == ["p", "p"]
    assert htmltext.densest(htmltext.parse("<nav>menu</nav>")[0]) is None
    assert htmltext.densest(htmltext.parse("")[0]) is None

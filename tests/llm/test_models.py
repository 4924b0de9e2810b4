"""Main text of pages and the quality model."""

import html
import itertools
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from blotter.llm import main_text, quality_model
from tests.llm.awkward import TEXTS, awkward, empty

SF_DIR = "/root/testdata/sf0.01"
rng = random.Random(3)


def test_cut_is_minimal():
    for _ in range(300):
        n = rng.randint(1, 7)
        evidence = [rng.choice([-2, -1, -0.5, 0.5, 1, 3]) for _ in range(n)]
        edges = [(a, b, rng.choice([0.3, 1, 2])) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.4]

        def cost(kept):
            wrong = sum(abs(e) for e, k in zip(evidence, kept) if (e > 0) != bool(k))
            return wrong + sum(w for a, b, w in edges if kept[a] != kept[b])

        best = min(map(cost, itertools.product([0, 1], repeat=n)))
        assert cost(main_text.minimum_cut(evidence, edges)) == pytest.approx(best)


PAGE = """<html><body class="has-sidebar"><header class="site-header"><h1>Site</h1><a href=/>Home</a></header>
<div class="cookie-notice">We use cookies. Accept?</div><div id="wrapper"><div id="content"><h1>Title here</h1>
<p>First paragraph with <a href=x>a link</a> and text &amp; more&nbsp;stuff.<p>Second para<br>line two.
<div class="share-buttons"><a>Tweet</a></div><blockquote>Quote.</blockquote></div>
<div class="sidebar"><p>Side text goes here with long sentences, promising much.</p></div></div>
<section id="comments"><article><p>Nice article, thanks a lot for this.</p></article></section>
<form><label>Your name</label><input><p>Please fill in the form now.</p></form>
<footer>&copy; 2024 me</footer><script>if (a<b) {"<p>x</p>"}</script></body></html>"""


def test_a_page():
    assert main_text.main_text(PAGE).split("\n\n") == [
        "Title here",
        "First paragraph with a link and text & more stuff.",
        "Second para line two.",
        "Quote.",
    ]


ARTICLE = "<h1>Title here</h1><p>A first paragraph, with some words in it.</p>"


@pytest.mark.parametrize("name", ["no-sidebar", "has-sidebar", "with_menu", "nav-open", "sidebar-right"])
@pytest.mark.parametrize("inner", ["article", "main", 'div id="content"', 'div class="entry-content"'])
def test_a_wrapper_named_for_its_layout(name, inner):
    page = f'<body><div id="wrapper" class="{name}"><{inner}>{ARTICLE}</{inner.split()[0]}></div></body>'
    assert main_text.main_text(page) == "Title here\n\nA first paragraph, with some words in it."


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="related-posts"><article>{ARTICLE}</article></div>',
        f'<div id="comments"><article>{ARTICLE}</article></div>',
        f'<div class="sidebar"><article class="comment">{ARTICLE}</article></div>',
        f'<div class="widget"><div class="content">{ARTICLE}</div></div>',
        f'<nav class="no-sidebar"><article>{ARTICLE}</article></nav>',
    ],
)
def test_boilerplate_with_articles_stays(page):
    assert main_text.main_text(f"<body>{page}</body>") == ""


def test_broken_markup_is_read():
    parts = ["<p>", "</p>", "<div>", "</div>", '<a href="x">', "</a>", "<!--", "-->", "<script>", "</script>", "x y. ",
             '"', "'", "<", ">", "<li>", "</ul>", "<td>", "&amp;", "<br/>", "<article>", "</article>", "<nav>"]
    for _ in range(1500):
        assert "<p>" not in main_text.main_text("".join(rng.choice(parts) for _ in range(40)))
    assert main_text.main_text('<a "' * 50_000) == ""
    assert main_text.main_text("<article>" + "<p>Some words here.</p>" * 5000).count("\n\n") == 4999


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    for row in main_text.extracted(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search("<article>(.*?)</article>", row["html"], re.S).group(1)
        parts = re.split("</?(?:h1|p)>", article.replace("<br>", " "))
        parts = [" ".join(html.unescape(re.sub("</?b>", "", part)).split()) for part in parts]
        assert row["text"] == "\n\n".join(filter(None, parts))
        assert row["n_chars"] == len(row["text"])


def test_awkward_pages(spark):
    rows = [*TEXTS, (8, PAGE), (8, PAGE)]
    pages = awkward(spark, rows, "page_id", "html").withColumn("url", F.lit(None).cast("string"))
    found = main_text.extracted(pages).collect()
    assert len(found) == len(rows)
    assert all(r["text"] == "" for r in found if r["page_id"] in (1, 2, 3))
    nothing = empty(spark, "page_id", "html").withColumn("url", F.lit(""))
    assert main_text.extracted(nothing).count() == 0


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    found = quality_model.scored(docs, quality_model.fit(docs, labels)).join(labels, "doc_id")
    rows = found.filter("held_out").collect()
    right = sum((r["score"] >= 0.3) == (r["quality"] == 1) for r in rows)
    assert right / len(rows) > 0.95
    assert quality_model.fit(docs, labels) == quality_model.fit(docs.repartition(5), labels)


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    turned = labels.withColumn(
        "quality", F.when(quality_model.held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert quality_model.fit(docs, turned) == quality_model.fit(docs, labels)


def test_awkward_texts_are_scored(spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(9)] + [(None, 1), (4, None)], "doc_id long, quality int")
    docs = awkward(spark)
    for model in (quality_model.fit(docs, labels), quality_model.fit(empty(spark), labels.limit(0))):
        found = quality_model.scored(docs, model).collect()
        assert len(found) == len(TEXTS)
        assert all(0 <= r["score"] <= 1 for r in found)
        assert quality_model.scored(empty(spark), model).count() == 0


def test_dictionaries_see_whole_texts():
    data = bytes(range(256)) * 100
    found = quality_model._pieces(data, 392)
    assert len(found) <= 392 and found.startswith(data[:90]) and found.endswith(data[-90:])
    assert quality_model._pieces(data[:392], 392) == data[:392]


def test_signs_late_in_a_text_are_learned(spark):
    same = "".join(rng.choice("abcdefgh ") for _ in range(30_000))
    late = {k: " ".join(f"{'good' if k else 'bad'}{n % 7}" for n in range(4000)) for k in (0, 1)}
    rows = [(n, same + late[n % 2]) for n in range(600)]
    labels = spark.createDataFrame([(n, n % 2) for n in range(600)], "doc_id long, quality int")
    docs = awkward(spark, rows)
    model = quality_model.fit(docs, labels)
    assert b"good3 good4" in model.dictionaries[0][0] and b"bad3 bad4" in model.dictionaries[0][1]
    held = [r for r in quality_model.scored(docs, model).collect() if r["held_out"]]
    assert held and all((r["score"] > 0.5) == (r["doc_id"] % 2 == 1) for r in held)


@pytest.mark.parametrize("wrapper", ['<form id="aspnetForm"><div>', '<div class="tags-page">', '<div id="search-results-layout">'])
def test_a_wrapper_of_the_whole_page_is_no_boilerplate(wrapper):
    article = [f"Paragraph number {k} of the article tells the reader a good deal about it." for k in range(4)]
    page = f"<body>{wrapper}<nav><a href='/'>Home</a></nav>" + "".join(f"<p>{one}</p>" for one in article)
    assert main_text.main_text(page + "<footer>All rights reserved.</footer></body>") == "\n\n".join(article)


def test_a_form_beside_the_article_stays_out():
    form = "<form>" + "<p>Please fill in all of the fields of this form now.</p>" * 3 + "</form>"
    text = "The article itself is made of a number of sentences, like this one."
    assert main_text.main_text(f"<article><p>{text}</p></article>{form}") == text
    assert main_text.main_text(f"<p>{text}</p>" * 4 + form) == "\n\n".join([text] * 4)


@pytest.mark.parametrize("page", [
    "<div>Some words in a sentence of eight or more words here." * 20_000,
    "<div>Some words in a sentence, closed again. " * 20_000 + "</div>" * 20_000,
    "<span>" * 20_000 + "<p>word</b>" * 20_000,
    "<div>" * 20_000 + "<li>word." * 20_000,
    "<title>a" * 20_000,
])
def test_deep_pages_take_time_in_proportion(page):
    """No block holds the whole path to it, and no tag looks through all open elements."""
    began = time.process_time()
    main_text.main_text(page)
    assert time.process_time() - began < 6


def test_an_elements_begin_closes_what_it_may():
    page = "<article><ul><li>One.<li>Two <b>and<li>three.</ul><table><tr><td>A.<td>B.<tr><td>C.</table><p>D.<p>E.<div>F.</div>G."
    found = [("".join(b.pieces), b.within.tag, b.within.depth) for b in main_text._blocks(page)]
    assert found == [
        ("One.", "li", 3), ("Two and", "li", 3), ("three.", "li", 3), ("A.", "td", 4), ("B.", "td", 4),
        ("C.", "td", 4), ("D.", "p", 2), ("E.", "p", 2), ("F.", "div", 2), ("G.", "article", 1),
    ]

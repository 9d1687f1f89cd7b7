"""Blocks of pages, the labeller on layouts and pages it has not seen, and the query against the pages' own markup."""

import html as entities
import re
import time

import numpy as np
import pytest

from clickloom.llm import html_text as h
from clickloom.llm.html_blocks import blocks
from clickloom.llm.layouts import Layout
from clickloom.llm.queries import QUERIES

TESTDATA = "/root/testdata"


def texts(page):
    return [b.text for b in blocks(page)]


@pytest.fixture(scope="module")
def sampled(spark):
    pages = spark.read.parquet(f"{TESTDATA}/sf0.1/pages.parquet")
    return [r.html for r in pages.orderBy("page_id").limit(900).collect()]


@pytest.fixture(scope="module")
def model(sampled):
    own = h.training_pages(sampled[: h.SAMPLE])
    return h.fit([h.inputs(b) for b, _ in own], [y for _, y in own])


def test_blocks():
    page = "a<p>b c<ul><li>x<li>y &am<b>p;</b></ul><script>if(a<b)'</p>'</script><!-- <p>no --><div title='a>b'>t</div <p>z&nbsp;\n &lt;p> < 3<br>4"
    assert texts(page) == ["a", "b c", "x", "y &amp;", "t", "z <p> < 3 4"]
    assert texts("<head><title>T</title></head>one<STYLE>p{}</STYLE> two<p>three<td>four<table><tr><td>5<td>6<tr><td>7") == ["one two", "three", "four", "5", "6", "7"]
    assert texts("<p>cut &amp off<a href='x") == ["cut & off"]
    assert texts("") == texts("   ") == texts("<!-- ") == []


@pytest.mark.parametrize(
    "piece", ["<div>", "<p><table><td>", "<a title='", '<div a="b', "<p><b>", "</p>", "<script>", "<", "&", "<li>x", "<ul><li>"]
)
def test_time_follows_length(piece):
    start = time.perf_counter()
    blocks(piece * 60_000)
    assert time.perf_counter() - start < 5


def test_gradients():
    draw = np.random.default_rng(3)
    model = h.Labeller.drawn(1, 5)
    model.label[:] = draw.normal(0, 1, model.label.shape)
    pages = [draw.normal(0, 1, (n, h.INPUTS)).astype(np.float32) for n in (4, 7)]
    rows, inside = h._padded(pages)
    wanted = (draw.random(rows.shape[:2]) < 0.5).astype(np.float32)
    found = model.gradients(rows, inside, wanted)

    def loss():
        odds = model.scores(rows, inside).astype(float)
        return ((np.logaddexp(0, odds) - wanted * odds) * inside[:, :, 0]).sum() / inside.sum()

    for parameter, gradient in zip(model.parameters(), found):
        at = tuple(np.argwhere(np.abs(gradient) > np.abs(gradient).max() / 2)[0])
        before = parameter[at]
        parameter[at] = before + 0.01
        above = loss()
        parameter[at] = before - 0.01
        assert gradient[at] == pytest.approx((above - loss()) / 0.02, rel=0.05)
        parameter[at] = before


def test_padding_changes_nothing(model, sampled):
    own = [blocks(x) for x in sampled[:40]]
    together = h.labels_of(model, own)
    assert all((h.labels_of(model, [p])[0] == t).all() for p, t in zip(own, together))


def test_new_layouts(model, sampled):
    """Pages drawn from another seed with texts of other pages."""
    layout = Layout(98, [b.text for x in sampled[400:700] for b in blocks(x)])
    drawn = [h.labelled(layout.page()) for _ in range(400)]
    told = h.labels_of(model, [p for p, _ in drawn])
    wrong = np.array([(t != (y > 0.5)).sum() for t, (_, y) in zip(told, drawn)])
    assert wrong.sum() <= 0.004 * sum(len(y) for _, y in drawn)
    assert (wrong > 0).mean() <= 0.05


def main(model, page):
    own = blocks(page)
    return [b.text for b, yes in zip(own, h.labels_of(model, [own])[0]) if yes]


PROSE = ["The weather was mild for most of the week.", "It rained, however, on Friday.", "Short.", "What follows is a longer paragraph that says nothing, in many words, about the weather."]
AROUND = '<div id="header"><a href="/">Site</a></div><ul class="menu"><li><a href="/a">News</a></li><li><a href="/b">Sport</a></li></ul>'
AFTER = (
    '<div class="sidebar"><h3>Popular</h3><ul><li><a href="/x">Something else</a></li></ul></div>'
    '<div id="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b> says<p>I liked the rain, but not the wind that came with it.</p></div>'
    '<form><label>Name</label><button>Send</button></form></div><div class="footer">&copy; 2024 All rights reserved</div>'
)


@pytest.mark.parametrize(
    "opened, closed", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>"), ('<section id="story">', "</section>"), ('<div id="content"><div class="entry">', "</div></div>")]
)
def test_pages_written_by_hand(model, opened, closed):
    inner = "<h1>On the weather</h1>" + "".join(f"<p>{p}</p>" for p in PROSE[:2]) + '<div class="advertisement">Buy umbrellas now, free shipping</div>' + "".join(f"<p>{p}</p>" for p in PROSE[2:])
    page = f"<!doctype html><html><head><title>x</title></head><body>{AROUND}{opened}{inner}{closed}{AFTER}</body></html>"
    assert main(model, page) == ["On the weather", *PROSE]


def expected(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    parts = (" ".join(entities.unescape(re.sub(r"</?b>", "", p)).split()) for p in re.split(r"</?(?:h1|p)>", inner))
    return "\n\n".join(p for p in parts if p)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_the_articles(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{TESTDATA}/{sf}/pages.parquet").collect()}
    got = QUERIES["op12_html_extraction"](spark, f"{TESTDATA}/{sf}").collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, expected(pages[r.page_id].html), len(r.text))


SCHEMA = "page_id bigint, url string, html string, blocks string, text string, path int"


def test_defined_cases(spark, model):
    page = f"<body>{AROUND}<article><p>One.<p>Two.</article>{AFTER}"
    long = "<body><article>" + "<p>Words and words.</p>" * 20_000 + "</article><footer>end</footer>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", page), (3, "u", page), (None, "u", page), (4, "u", long), (5, "u", page[: page.index("Two") + 2]), (6, "u", "<nav><a href='/'>x</a></nav>")]
    frame = spark.createDataFrame([(*r, "b", "t", 5) for r in rows], SCHEMA)
    got = h.with_text(frame, model, into="main").collect()
    both = "One.\n\nTwo."
    want = [(1, ""), (2, ""), (3, both), (3, both), (None, both), (4, "\n\n".join(["Words and words."] * 20_000)), (5, "One.\n\nTw"), (6, "")]
    assert sorted(((r.page_id, r.main) for r in got), key=str) == sorted(want, key=str)
    assert all((r.blocks, r.text, r.path) == ("b", "t", 5) for r in got)


def test_empty_table_trains_on_invented_texts(spark):
    assert h.with_text(spark.createDataFrame([], SCHEMA)).count() == 0

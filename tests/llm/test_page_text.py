import html
import re
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import healthmart.llm.queries as Q
from healthmart.llm import page_text

from .conftest import TEST_DIR, plain

PAGES = "page_id bigint, url string, html string"


def article(page):
    """The blocks of the one article of a test page, by plain cutting."""
    inner = page.split("<article>")[1].split("</article>")[0] if "<article>" in page else ""
    inner = re.sub(r"</?b>|<br>", " ", inner)
    parts = (" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(x for x in parts if x)


def test_every_page_against_plain_cutting(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{TEST_DIR}/pages.parquet").collect()}
    rows = plain(Q.QUERIES["op7_page_text"](spark, TEST_DIR))
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == article(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_held_out_accuracy():
    xs, ys = page_text.examples(200, seed=1234)
    scores = page_text.trained().score(xs)
    right = sum(int(((s > 0) == (y > .5)).sum()) for s, y in zip(scores, ys))
    assert right / sum(map(len, ys)) > 0.985


def test_gradients_match_differences():
    model = page_text.Labeller(np.random.default_rng(0))
    xs, ys = page_text.examples(3, seed=5)

    def loss():
        z = np.concatenate(model.score(xs))
        y = np.concatenate(ys)
        return np.mean(np.log1p(np.exp(-np.where(y > .5, z, -z))))

    grad = model.gradients(xs, ys)
    for name, w in model.w.items():
        at = np.unravel_index(np.argmax(np.abs(grad[name])), w.shape)
        keep = w[at]
        w[at] = keep + 1e-5
        up = loss()
        w[at] = keep - 1e-5
        down = loss()
        w[at] = keep
        assert (up - down) / 2e-5 == pytest.approx(grad[name][at], rel=1e-3, abs=1e-7)


def test_blocks_of_broken_markup():
    cut = lambda page: [t for _, t, _ in page_text.blocks(page)]
    assert cut("<p>a<p>b &amp; c&nbsp;&#100;</p>e <b>f</b>g<br>h") == ["a", "b & c d", "e fg h"]
    assert cut("<p>x</p><script>var a='</p>';</script><style>p{}</style>y<!-- z --><!-- open") == ["x", "y"]
    assert cut("a < b <3 <p title='>'>c</p>") == ["a < b <3", "c"]
    assert cut("") == [] and cut("<div></div> \n") == []


def test_edges(spark):
    long = "<article>" + "".join(f"<p>sentence number {i} of a long page.</p>" for i in range(3000)) + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<nav><a href=/>Home</a></nav>"), (None, "u", "<article><p>One two three.</p></article>"), (5, "u", long), (5, "u", long)]
    df = spark.createDataFrame(rows, PAGES).withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit("clash"))
    got = plain(page_text.extract(df))
    by = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 6 and by[1] == by[2] == by[3] == "" and by[None] == "One two three."
    assert by[5] == article(long)
    assert page_text.extract(df.limit(0)).count() == 0


def test_two_newlines_between_blocks(spark):
    said = [f"This is sentence number {i} of a page with several paragraphs." for i in range(3)]
    df = spark.createDataFrame([(1, "u", "<article>" + "".join(f"<p>{x}</p>" for x in said) + "</article>")], PAGES)
    (row,) = plain(page_text.extract(df))
    assert row["text"] == "\n\n".join(said) and row["n_chars"] == sum(map(len, said)) + 4


def test_self_closed_and_unclosed_hidden_elements():
    cut = lambda page: [t for _, t, _ in page_text.blocks(page)]
    assert cut("<svg class='i'/><math/><p>a</p>") == cut("<svg hidden/><p>a</p>") == ["a"]
    assert cut("<svg id=a/>x</svg><p>b</p>") == ["b"]                           # the slash belongs to the value
    for tag in ("object", "canvas", "template", "svg", "math"):
        assert cut(f"<div>a <{tag}>x</div><p>b</p>") == ["a", "b"]
        assert cut(f"<div>a <{tag}>x <{tag}>y</{tag}> z</{tag}> b</div>") == ["a b"]
    assert cut("<p>a <object><p>x</p><br>y</object> b</p>c") == ["a b", "c"]
    assert cut("<p>a <svg><path d='M0'/><g><path></g><title>x</title></svg> b</p><p>c") == ["a b", "c"]
    assert cut("<article><svg><path><p>a</p></article>") == ["a"]               # HTML ends svg here
    assert cut("<svg><foreignObject><p>x</p></foreignObject></svg><p>a</p>") == ["a"]
    assert cut("<p>a</p><noscript>x <p>y") == ["a"]                             # raw text, to the end


def test_long_and_broken_pages(spark):
    """One page of many blocks among short ones, unclosed elements and unclosed tags: bounded memory, near linear time."""
    began = time.process_time()
    deep = page_text.blocks("<div class=a1>x" * 100_000)
    assert len(deep) == 100_000 and deep[0][0] == deep[-1][0]
    assert [t for _, t, _ in page_text.blocks("<a " * 300_000)] == [" ".join(["<a"] * 300_000)]
    assert [t for _, t, _ in page_text.blocks("<p>a</p>" + "<b " * 1000 + "<!-- open")] == ["a", " ".join(["<b"] * 1000)]
    assert time.process_time() - began < 20
    long = "<article>" + "".join(f"<p>sentence number {i} of a long page.</p>" for i in range(20_000)) + "</article>"
    said = "This is one sentence of a short page."
    rows = [(i, "u", f"<article><p>{said}</p></article>") for i in range(255)] + [(255, "u", long)]
    got = page_text.extract(spark.createDataFrame(rows, PAGES))
    assert {r["page_id"]: r["n_chars"] for r in got.collect()} == {i: len(said) for i in range(255)} | {255: len(article(long))}
    found, model = page_text.blocks(long), page_text.trained()
    tracemalloc.start()
    model.score([found])
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()

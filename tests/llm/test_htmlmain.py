import html
import re

import numpy as np
import pytest

from ledgerline.llm import htmlmain as H


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def field(pages):
    return H.fitted(pages, train_pages=100)


def test_blocks():
    page = ('<html><head><title>T</title></head><body><nav><ul><li><a href="/a">A &amp; b</a><li>c</ul></nav><!-- no --><script>var t="</p>";</script>'
            "<article class='postBody x-y'><h1>H</h1><p>one\n two<b> three<br>four<p>five<ul><li>six</li></ul>tail</article></p>stray<table><tr><td>x<td>y</table>")
    got = H.blocks(page)
    assert [b.text for b in got] == ["A & b", "c", "H", "one two three four", "five", "six", "tail", "stray", "x", "y"]
    assert got[2].tags >= {"t:article", "t:h1", "c:post", "c:body", "c:x", "c:y"} and got[0].linked > 0 and got[3].linked == 0
    assert [b.text for b in H.blocks("just text")] == ["just text"] and H.blocks("") == [] and H.blocks("<script>x") == []


@pytest.mark.parametrize("page, texts", [
    ('<svg class="i"/><article><p>all of it</p></article>', ["all of it"]),
    ('<p>before<iframe src=x/>after</p><iframe src="y"></iframe><p>more</p>', ["beforeafter", "more"]),
    ("<p>with <math><mi>x</mi><mo>=</mo><mn>2</mn></math> in it</p>", ["with x=2 in it"]),
    ("<svg><title>no</title><path d='M0'/></svg><p>text<canvas></canvas></p>", ["text"]),
    ("<noscript>off<p>one</p>", ["off", "one"]),
    ("<p>one</p><object data=x /><p>two</p><video src=v>", ["one", "two"]),
    ("<p>one</p><style>p{}<p>two</p>", ["one"]),
    ("<head/><body><p>one</p>", ["one"]),
])
def test_elements_without_an_end_tag_lose_no_text(page, texts):
    assert [b.text for b in H.blocks(page)] == texts


def test_article_text_of_the_pages(pages, field):
    rows = H.extracted(pages, field).collect()
    source = {r.page_id: r.html for r in pages.collect()}
    right = 0
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S).group(1)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article))
        right += r.text == "\n".join(x for x in parts if x)
        assert r.n_chars == len(r.text)
    assert len(rows) == len(source) and right >= 0.99 * len(rows)


def test_held_out_layouts(pages, field):
    rng = np.random.default_rng(77)
    hit = wrong = missed = 0
    for r in pages.orderBy("page_id").limit(60).collect():
        found, y = H.labelled(r.html)
        main, other = [b.text for b, l in zip(found, y) if l], [b.text for b, l in zip(found, y) if not l]
        for page, labels in H.layouts(main, other, main, rng, 2):
            got = H.blocks(page)
            if len(got) == len(labels):
                for a, b in zip(labels, field.decode(field.rows(got))):
                    hit, wrong, missed = hit + (a and b), wrong + (b and not a), missed + (a and not b)
    assert hit > 500 and wrong < 0.06 * hit and missed < 0.04 * hit


def test_viterbi_equals_enumeration(field):
    rng = np.random.default_rng(2)
    chain = H.Field(["a", "b", "c"])
    chain.emit, chain.move = rng.normal(size=(3, 2)), rng.normal(size=(2, 2))
    rows = [[0], [1, 2], [2], [0, 1], [1]]

    def score(y):
        return sum(chain.emit[r, k].sum() for r, k in zip(rows, y)) + sum(chain.move[a, b] for a, b in zip(y, y[1:]))

    best = max((tuple(int(c) for c in f"{i:05b}") for i in range(32)), key=score)
    assert tuple(chain.decode(rows)) == best and chain.decode([]) == []


def test_training_follows_the_exact_gradient():
    """After training, the expected and the seen feature counts agree (the maximum of the likelihood)."""
    chain = H.Field(["x", "y"])
    pages = [[[0], [1], [0]], [[1], [1]], [[0], [0], [1], [0]]]
    labels = [[1, 0, 1], [0, 1], [1, 0, 0, 1]]
    chain.train(pages, labels, steps=3000, rate=0.02, l2=0.0)

    def score(p, y):
        return sum(chain.emit[r, k].sum() for r, k in zip(p, y)) + sum(chain.move[a, b] for a, b in zip(y, y[1:]))

    seen = expected = 0.0
    for p, gold in zip(pages, labels):
        seqs = [tuple((i >> j) & 1 for j in range(len(p))) for i in range(2 ** len(p))]
        weight = np.exp([score(p, y) for y in seqs])
        share = weight / weight.sum()
        on = lambda y, p=p: sum(k for r, k in zip(p, y) if 0 in r)
        seen += on(gold)
        expected += sum(s * on(y) for s, y in zip(share, seqs))
    assert abs(seen - expected) < 0.05


def test_odd_pages(spark, field):
    rows = [(1, "u", None, "c"), (2, "u", "", "c"), (3, None, "<p>" + "word, " * 30000 + "end.</p>", "c"), (3, None, "<p>again, a text.</p>", "c"), (None, "u", "<nav>menu</nav>", "c"), (5, "u", "<<<>>> &&& <p <b", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = H.extracted(df, field).collect()
    assert len(out) == len(rows) and {r.page_id: r.text for r in out}[1] == "" and {r.page_id: r.text for r in out}[2] == ""
    assert H.extracted(df.limit(0), H.fitted(df.limit(0))).count() == 0

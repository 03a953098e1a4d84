import html
import random
import re

import numpy as np
import pytest

from quern.llm import htmltext, q_html


def article(page):
    """What the given pages hold between the article tags, by plain means."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1|article)>", re.sub(r"<br>", " ", inner))
    return "\n".join(t for p in parts if (t := " ".join(html.unescape(re.sub(r"</?b>", "", p)).split())))


def test_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = q_html.op10_html_text(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(pages)
    assert np.mean([r.text == article(pages[r.page_id]) for r in got]) >= 0.98
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.fixture(scope="module")
def model(spark):
    return htmltext.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


def test_composed_pages(model):
    rng = random.Random(99)
    texts = [" ".join(rng.choice("river stone house garden window music table".split()) for _ in range(n)) + "." for n in (5, 12, 30, 60, 20, 9)]
    right = n = 0
    vectors = htmltext.Features()
    for _ in range(150):
        found, label = htmltext.composed([rng.choice(texts) for _ in range(rng.randint(1, 12))], texts, rng)
        right += (model.label([vectors.of(found)])[0] == (label > 0)).sum()
        n += len(found)
    assert right / n > 0.93


def test_blocks():
    page = "<!doctype html><head><title>no</title><style>p{}</style><script>var t='</p>';</script></head><body><p class='a>b'>x &amp; y&nbsp; z<br>w<p>two <b>bold</b>\n <a href=q>link</a></p><!-- <p>no</p> --><textarea>no</textarea>tail<ul><li>1<li>2</ul>&#8364; <unclosed"
    assert [(p[-1][0], t) for p, t, _ in htmltext.blocks(page)] == [("p", "x & y z w"), ("p", "two bold link"), ("body", "tail"), ("li", "1"), ("li", "2"), ("body", "€ <unclosed")]
    assert htmltext.blocks("") == [] and htmltext.blocks("<<<>>>&&;")


def test_odd_rows(spark, model):
    long = "<html><body><nav><ul><li><a href=x>Home</a></li></ul></nav><article>" + "<p>many words of the story stand here, one by one.</p>" * 20_000 + "</article></body></html>"
    rows = [(1, None, "a"), (2, "", "a"), (3, "<html><script>x</script></html>", "a"), (4, long, None), (4, long, None), (None, "<", "a")]
    df = spark.createDataFrame(rows, "page_id long, html string, TEXT string")
    got = htmltext.extract(df, model).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got)
    assert all(r.text == "" for r in got if r.page_id in (1, 2, 3))
    assert all(r.text.count("\n") >= 19_000 for r in got if r.page_id == 4)
    assert htmltext.extract(df.limit(0), htmltext.fit(df.limit(0))).count() == 0


def test_gradients():
    rng = np.random.default_rng(0)
    m = htmltext.Labeller()
    m.w = {k: v.astype(np.float64) for k, v in m.w.items()}
    x, mask = htmltext.padded([rng.normal(size=(n, htmltext.DIMS)) for n in (3, 5)])
    y = (rng.random(mask.shape) > 0.5) * mask
    loss = lambda: -((np.log(p := m.forward(x, mask)[0]) * y + np.log(1 - p) * (1 - y)) * mask).sum() / mask.sum()
    grads = m.gradients(x, mask, y)
    for k in m.w:
        at = np.unravel_index(rng.integers(m.w[k].size), m.w[k].shape)
        m.w[k][at] += 1e-3
        up = loss()
        m.w[k][at] -= 2e-3
        down = loss()
        m.w[k][at] += 1e-3
        assert abs((up - down) / 2e-3 - grads[k][at]) < 2e-3


@pytest.mark.parametrize("tag", ['<svg class="i"/>', '<video-js id="v"></video-js>', "<audio-player>", "<template-x>", "<video src=v>", "<select>", "<svg><path d='M0'/></svg>", "<object data=o>no</object>", "<svg/><svg/>"])
def test_hidden_elements_end(tag):
    text = " ".join(t for _, t, _ in htmltext.blocks(f"<p>a</p>{tag}<p>rest</p>"))
    assert text == "a rest"


def test_math_is_text():
    got = htmltext.blocks("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math> holds</p><script>no</script>")
    assert "".join(t for _, t, _ in got).replace(" ", "") == "sox=2holds"

import re
import time
from html import unescape

import numpy as np
import pytest

from ledgermill.llm import pages

TABLE = "/root/testdata/sf0.01/pages.parquet"


@pytest.fixture(scope="module")
def network(spark):
    return pages.fit(spark.read.parquet(TABLE), rounds=14)


def article(html):
    """Main text of the given pages, whose layout is known."""
    inner = re.search(r"<article>(.*?)(</article>|$)", re.sub(r"<script.*?</script>", "", html, flags=re.S), re.S)[1]
    inner = re.sub(r"</?(b|i|em|strong|a|span)\b[^>]*>", "", re.sub(r"<!--.*?-->", "", inner, flags=re.S))
    return " ".join(unescape(re.sub(r"<[^>]*>", " ", inner)).split())


def test_blocks_of_broken_markup():
    html = ("<!DOCTYPE html><title>T</title><div class='menu top' id=m><a href='x>y'>One</a> two</div><script>if(a<b)'<p>no</p>'</script>"
            "<p>a<b>b<br>c<p>d &amp;amp; &lt;e&gt; &#233;&nbsp;f</i></p><!-- <p>no --><ul><li>x<li>y</ul>tail 1 < 2<style>p{}")
    found = pages.blocks(html)
    assert [b[1] for b in found] == ["T", "One two", "ab c", "d &amp; <e> é f", "x", "y", "tail 1 < 2"]
    assert found[1][0].path() == ("div", "menu", "top", "m") and 0 < found[1][2] < 1 and found[5][0].path() == ("ul", "li")
    assert pages.blocks(None) == pages.blocks("") == pages.blocks("<p></p><!-- open") == []
    assert pages.blocks("<p title='open>text") and pages.blocks("plain")[0][1] == "plain"


def test_main_text_of_given_pages(spark, network):
    table = spark.read.parquet(TABLE)
    got = {r.page_id: r for r in pages.main_text(table, network).collect()}
    given = table.toPandas()
    right = [got[r.page_id].text == article(r.html) for r in given.itertuples()]
    assert np.mean(right) > 0.98
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_other_layouts_and_odd_rows(spark, network):
    text = [f"Sentence number {i} says something of some length about the matter at hand." for i in range(8)]
    body = "".join(f"<p>{t}</p>" for t in text)
    html = (f"<body><header><div class='menu'><a href=/>Home</a><a href=/x>More</a></div></header><div class='cookie-notice'>We use cookies.</div>"
            f"<main><h1>Title of it</h1>{body}</main><aside class='sidebar'><p>Read this too</p></aside><section class='comments'>"
            "<p>Nice one!</p></section><form>Mail <input></form><footer>Terms</footer></body>")
    rows = [(1, "u", html, 1), (2, None, None, 2), (3, "u", "", 3), (None, "v", html, 4), (1, "u", html, 5)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = pages.main_text(table, network).collect()
    assert [r.page_id for r in got] == [1, 2, 3, None, 1] and [r.text for r in got[1:3]] == ["", ""]
    kept = [t in got[0].text for t in text]
    assert np.mean(kept) > 0.8 and "cookies" not in got[0].text and "Terms" not in got[0].text
    assert got[0].text == got[3].text == got[4].text
    assert pages.main_text(table.where("false"), network).collect() == []


def test_broken_markup_takes_linear_time():
    begin = time.perf_counter()
    sizes = {}
    for name, html in {"open": "<a " * 300_000 + "<div " * 100_000, "odd": "<p '>x" * 150_000 + "'", "mixed": "<p '>x<p \">" * 90_000 + "'",
                       "nested": "<div>x" * 150_000, "unmatched": "<div>x" * 80_000 + "</b9>y" * 80_000, "ends": "</ " * 300_000,
                       "signs": "<" * 900_000, "script": "<script " * 120_000, "class": '<p class="' * 90_000 + ">"}.items():
        found = pages.blocks(html)
        sizes[name] = len(found)
        pages._inputs([found])
    assert sizes["nested"] == 150_000 and sizes["open"] == sizes["ends"] == sizes["signs"] == 1 and sizes["class"] == 0
    assert time.perf_counter() - begin < 60  # some 9 MB, each kind in a second or two


def test_empty_and_unclosed_markup():
    text = lambda html: [b[1] for b in pages.blocks(html)]
    assert text("a</>b<!>c<?d>e</ x>f") == ["abcef"] and text("a < b > c <") == ["a < b > c <"]
    assert text("x<p title='a>y<p>z") == ["x", "y", "z"] and text("x<script>y</script >z<style a=b") == ["xz<style a=b"]
    assert pages.blocks("<p title='a>b' class=\"c d\">e")[0][0].path() == ("p", "c", "d")


def plain_scores(page, weights):
    """Logits by a plain walk over the blocks of one page."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    one = [pages._inputs([[block]]) for block in page]
    inputs = []
    for block, own in zip(page, one):
        names = [weights["path"][pages._bucket(n, pages._PATH_BUCKETS)] for n in block[0].path()]
        words = [weights["word"][b] for b in own["word"]]
        inputs.append(np.concatenate([np.mean(names, axis=0) if names else np.zeros(pages._PATH_SIZE),
                                      np.mean(words, axis=0) if words else np.zeros(pages._WORD_SIZE), own["numbers"][0]]))
    states = {}
    for side, order in (("ahead", range(len(page))), ("behind", range(len(page) - 1, -1, -1))):
        h = c = np.zeros(pages._HIDDEN)
        for i in order:
            put, forget, show, new = np.split(inputs[i] @ weights[f"in_{side}"] + h @ weights[f"loop_{side}"] + weights[f"bias_{side}"], 4)
            c = sigmoid(forget) * c + sigmoid(put) * np.tanh(new)
            h = sigmoid(show) * np.tanh(c)
            states[side, i] = h
    return [np.concatenate([states["ahead", i], states["behind", i], x]) @ weights["out"] + weights["bias_out"][0] for i, x in enumerate(inputs)]


def test_scores_equal_a_plain_walk(spark, network):
    html = [r.html for r in spark.read.parquet(TABLE).orderBy("page_id").limit(40).collect()]
    read = [pages.blocks(h) for h in [*html, "", "plain text", "<p>" + "<div>a <b>b</b>" * 40, "<ul><li>1<li>!</ul>"]]
    flags = pages.main_blocks(read, network)
    for page, flag in zip(read, flags):
        logits = plain_scores(page, network.weights)
        assert np.allclose(pages._scores(pages._inputs([page]), network.weights), logits, atol=1e-9) if page else not logits
        assert [x > 0 for x in logits] == flag.tolist()


def test_slopes_equal_differences():
    rng = np.random.default_rng(3)
    read = [pages.blocks(f"<nav><li>a{i}</li></nav><article><p>{'w ' * (i + 2)}</p><p>x.</p></article>") for i in range(4)]
    inputs = pages._inputs(read)
    truth = np.array([float(pages._told_by_names(b[0].path())) for page in read for b in page])
    weights = pages._new_weights(rng)

    def loss():
        logits = pages._scores(inputs, weights)
        return np.mean(np.log1p(np.exp(logits)) - truth * logits)

    slopes = pages._slopes(inputs, weights, truth)
    for name in ("in_ahead", "loop_behind", "bias_ahead", "out", "path", "word"):
        flat, slope = weights[name].reshape(-1), slopes[name].reshape(-1)
        for at in np.argsort(-np.abs(slope))[:4]:
            kept = flat[at]
            flat[at] = kept + 1e-5
            high = loss()
            flat[at] = kept - 1e-5
            assert abs((high - loss()) / 2e-5 - slope[at]) < 1e-6
            flat[at] = kept


def test_fit_without_pages():
    assert pages.main_blocks([pages.blocks("<article><p>Some words.</p></article>")], pages.learn([], rounds=2))[0].shape == (1,)

"""HTML extraction: gradients, block reading, made-up layouts, and the pages of the test tables."""

import html
import random
import re
import time
import zlib

import numpy as np
import pytest

from flowline.llm import htmltext, lstm, queries
from flowline.llm.htmltext import blocks_of

SF = "/root/testdata/sf0.001"


def test_gradients_are_those_of_the_loss():
    chance = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in lstm.initial(5, 3, seed=2).items()}
    x, mask = lstm.padded([chance.normal(size=(n, 5)) for n in (4, 1, 6)])
    y = chance.integers(0, 2, mask.shape).astype(float)
    _, gradients = lstm.loss_and_gradients(p, x, mask, y, mask)
    for name in lstm.PARAMETERS:
        for _ in range(4):
            at = tuple(chance.integers(0, n) for n in p[name].shape)
            near = []
            for step in (1e-2, -1e-2):
                moved = {**p, name: p[name].copy()}
                moved[name][at] += step
                near.append(lstm.loss_and_gradients(moved, x, mask, y, mask)[0])
            assert gradients[name][at] == pytest.approx((near[0] - near[1]) / 2e-2, abs=2e-3)


def test_padding_changes_nothing():
    chance = np.random.default_rng(3)
    p = lstm.initial(5, 4)
    long, short = chance.normal(size=(9, 5)), chance.normal(size=(3, 5))
    both = lstm.logits(p, *lstm.padded([long, short]))
    assert np.allclose(both[:3, 1], lstm.logits(p, *lstm.padded([short]))[:, 0], atol=1e-5)
    assert sorted(k for b in lstm.batches_by_length([5, 1, 9, 2], 10) for k in b) == [0, 1, 2, 3]


def texts(page):
    return [b.text for b in blocks_of(page)]


def plain_logits(p, x):
    """The network step by step for one page, from its definition."""

    def scan(rows, wx, wh, b):
        h, c, out = np.zeros(len(wh)), np.zeros(len(wh)), []
        for row in rows:
            i, f, o, g = np.split(row @ wx + h @ wh + b, 4)
            c = c / (1 + np.exp(-f)) + np.tanh(g) / (1 + np.exp(-i))
            h = np.tanh(c) / (1 + np.exp(-o))
            out.append(h)
        return out

    ahead = scan(x, p["fx"], p["fh"], p["fb"])
    back = scan(x[::-1], p["bx"], p["bh"], p["bb"])[::-1]
    return np.array([np.concatenate(both) @ p["w"] + p["b"][0] for both in zip(ahead, back)])


def test_forward_pass_equals_the_plain_one():
    chance = np.random.default_rng(8)
    p = {k: v + chance.normal(0, 0.3, v.shape) for k, v in lstm.initial(6, 4).items()}
    pages = [chance.normal(size=(n, 6)) for n in (1, 2, 7, 30)]
    found = lstm.logits(p, *lstm.padded(pages))
    for column, page in enumerate(pages):
        assert np.allclose(found[: len(page), column], plain_logits(p, page), atol=1e-4)


def test_blocks():
    assert texts("") == [] and texts(" \n ") == [] and texts("plain &amp; text") == ["plain & text"]
    assert texts("<p>a<b>b</b>c<br>d<p>e</p>f") == ["abc d", "e", "f"]
    assert texts("<div>one<!-- <p>no</p> -->two<script>var t='</p>';</script><style>p{}</style></div>three") == ["onetwo", "three"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("x < y &lt; z <unclosed") == ["x < y < z <unclosed"]
    assert texts('<p class="a>b">in</p><p title=\'x>y\'>on') == ["in", "on"]
    assert texts("<p>&#8364;&nbsp;&eacute;&#x1F642; \t\n end</p>") == ["€ é🙂 end"]
    assert texts("<title>no</title><textarea>no</textarea><p>yes<!-- never closed") == ["yes"]
    paths = [[e[0] for e in b.path] for b in blocks_of('<article><p>a<p>b</article><nav><a href="x">c</a></nav>')]
    assert paths == [["article", "p"], ["article", "p"], ["nav"]] or paths == [["article", "p"], ["article", "p"], ["nav", "a"]]
    assert blocks_of('<div CLASS="Side-Bar big" id=x1>t')[0].path == (("div", "side", "bar", "big", "x"),)
    assert texts("<a '" * 3000 + "<p>end") != []


def test_long_quoted_values():
    for n in (10, 4_000, 5_000, 100_000):
        for quote in "\"'":
            assert texts(f"<p data-x={quote}{'a' * n}<b>x</b> tail text{quote}>Main words.</p>") == ["Main words."]
    assert texts('<p title="never closed>one</p><p>two</p>') == ["one", "two"]
    assert texts('<p>one<a title="x>two</a>') == ["onetwo"] and texts('<b "x" <p>one') == ["one"]


def test_reading_is_linear():
    for page in ('<a "' * 200_000, '<a "' * 200_000 + ">", '<p ">" ' * 200_000 + "'", "<a " * 300_000, "<p '\">" * 200_000, "<" * 300_000):
        start = time.process_time()
        blocks_of(page)
        assert time.process_time() - start < 10


def test_depth_costs_nothing():
    n = 50_000
    for page in ("<div>x" * n, "<span>x" * n, "<i>" * n + "<b>" + "<div>" * n + "</b>" * n, "<tbody>" * n + "x", "<a>" * n + "</b>" * n):
        start = time.process_time()
        blocks = blocks_of(page)
        htmltext.vectors(blocks[:200])
        [b.node.path_vector() for b in blocks]
        assert time.process_time() - start < 10


def test_path_vectors_are_those_of_the_whole_path():
    chance = random.Random(2)
    words = ["div", "p", "article", "ad", "x", "nav"]
    for depth in (0, 1, 2, 3, 9, 150):
        path = tuple(tuple(chance.choices(words, k=chance.randrange(1, 4))) for _ in range(depth))
        want = np.zeros(htmltext.PATH_BUCKETS)
        for at, element in enumerate(path):
            for word in element:
                for name in (word, f"{word}<{len(path) - at > 2}"):
                    want[zlib.crc32(name.encode()) % htmltext.PATH_BUCKETS] += 1
        for _ in range(2):
            node = htmltext._paths.of(path)
            assert node.path() == path and node.path_vector().tolist() == np.minimum(want, 2).tolist()


def test_what_elements_say():
    said = lambda page: [b.node.said for b in blocks_of(page)]
    assert said("<p>a</p><article><header><h1>b</h1></header><p>c</p><footer>d</footer></article><header>e</header>") == [-1, 1, 1, 0, 0]
    assert said('<article class="has-ads banner-wide"><p>a</p><div class="ads">b</div></article>') == [1, 0]
    assert said('<div class="banner"><p>a</p><article><p>b</p></article></div>') == [0, 1]
    assert said('<main><section class="comments"><article><p>a</p></article></section></main><aside><article>b</article></aside>') == [0, 0]


@pytest.fixture(scope="module")
def learned():
    chance = random.Random(1)
    words = "stone river lamp under seven walked noon eight over bread winter glass".split()
    line = lambda n: " ".join(chance.choice(words) for _ in range(n)).capitalize() + "."
    pages = [
        f"<html><body><nav><ul><li>{line(2)}</li></ul></nav><article><h1>{line(5)}</h1>"
        + "".join(f"<p>{line(30)}</p>" for _ in range(chance.randrange(1, 9)))
        + f"</article><footer>{line(4)}</footer></body></html>"
        for _ in range(120)
    ]
    return htmltext.learn(pages), line


def test_layouts_it_was_not_shown(learned):
    parameters, line = learned
    body = [line(40) for _ in range(4)]
    other = [line(6) for _ in range(12)]
    page = f"""<!doctype html><head><title>{other[0]}</title></head><body class=home><div id="cookie-notice"><p>{other[1]}</p></div>
    <header class="site-header"><a href="/">{other[2]}</a></header><div class="menu"><ul><li><a href=1>{other[3]}</a><li><a>{other[4]}</a></ul></div>
    <main><h1>{line(5)}</h1><p>{body[0]}<p>{body[1]}</p><div class="ad"><p>{other[5]}</p></div><p>{body[2]}</p><p>{body[3]}</p></main>
    <aside class="sidebar"><ul><li><a>{other[6]}</a></ul></aside><form action=x><label>{other[7]}</label><input><button>{other[8]}</button></form>
    <section class="comments"><p>{other[9]}</p><p>{line(30)}</p></section><footer><p>{other[10]}</p></footer></body>"""
    found = " ".join(htmltext.main_blocks([page], parameters)[0])
    assert all(text in found for text in body)
    assert not any(text in found for text in other[:11])


def test_articles_of_every_kind(learned):
    """Linked prose, misleading and meaningless names, headlines in headers, tables and captions."""
    parameters, line = learned
    text = [line(25) for _ in range(12)]
    around = lambda inner: f"<body><nav><ul><li><a href=1>{text[10][:20]}</a></ul></nav>{inner}<footer><p>{text[11][:30]}</p></footer>"
    prose = "".join(f"<p>{t}</p>" for t in text[:4])
    cases = [
        (f"<article><p><a href=1>{text[0]}</a></p><ul><li><a href=2>{text[1]}</a></ul></article>", text[:2]),
        (f'<article class="has-ads banner-wide">{prose}</article>', text[:4]),
        (f"<article><header><h1>A headline of five words</h1></header>{prose}</article>", ["A headline of five words", *text[:4]]),
        (f"<article><p>{text[0]}</p><table><tr><td>one cell<td>4 711</tr></table><figure><img src=x><figcaption>What is seen</figcaption>"
         f"</figure><p>{text[1]}</p></article>", [text[0], "one cell", "4 711", "What is seen", text[1]]),
        (f'<div class="qx"><div class="zz9 kk"><h1>A headline of five words</h1>{prose}</div></div>', ["A headline of five words", *text[:4]]),
        (f'<div class="banner sidebar"><article>{prose}<section class="comments"><p>{text[5]}</p></section></article></div>', text[:4]),
    ]
    for inner, want in cases:
        assert htmltext.main_blocks([around(inner)], parameters)[0] == want, inner[:60]


def test_long_pages_are_learned_from_whole(spark, monkeypatch):
    """Pages are chosen by a hash and the room that is left, not by their length."""
    seen = []
    monkeypatch.setattr(htmltext, "learn", lambda pages: seen.append(pages) or {})
    long, short = "<p>word</p>" * 30_000, [f"<p>{k}</p>" for k in range(20)]
    df = spark.createDataFrame(list(enumerate([long, None, *short, *short])), "page_id bigint, html string")
    htmltext.fit(df)
    assert sorted(seen[-1]) == sorted([long, *short])
    monkeypatch.setattr(htmltext, "TRAIN_HTML_CHARS", 100)
    htmltext.fit(df)
    assert sum(map(len, seen[-1])) <= 100 and set(seen[-1]) <= set(short)


def test_made_pages_it_was_not_shown(learned):
    parameters, line = learned
    chance = random.Random(77)
    long, short = [line(30) for _ in range(50)], [line(5) for _ in range(50)]
    right = total = 0
    for _ in range(100):
        blocks, labels = htmltext.made_page(chance, long, short)
        if blocks:
            x, mask = lstm.padded([htmltext.vectors(blocks)])
            right += int(((lstm.logits(parameters, x, mask)[:, 0] > 0) == np.array(labels, bool)).sum())
            total += len(labels)
    assert right >= 0.95 * total


def plain_article(page):
    inside = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inside)).split())


def test_rows(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    long = "<article>" + "".join(f"<p>Paragraph {k} of many, with some words in it.</p>" for k in range(4000)) + "</article>"
    odd = [(10_000, "u", None), (10_001, None, ""), (None, "u", pages[0][2]), (7, "again", pages[1][2]), (7, "again", pages[1][2])]
    odd += [(10_002, "u", "<nav>menu</nav><script>only()"), (10_003, "u", long)]
    df = spark.createDataFrame([*pages, *odd], "page_id bigint, url string, html string").selectExpr("*", "'t' as text", "1 as n_chars", "2 as HTML")
    model = htmltext.fit(df)
    got = htmltext.extract(df, model).collect()
    assert len(got) == len(pages) + len(odd) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[10_000] == by_id[10_001] == by_id[10_002] == ""
    assert by_id[None] == plain_article(pages[0][2]) and by_id[10_003].count("Paragraph") == 4000
    assert htmltext.extract(df.limit(0), model).count() == 0
    assert htmltext.fit(df.limit(0))


def test_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.op1_html_text(spark, SF).collect()}
    assert {i: r.text for i, r in got.items()} == {i: plain_article(page) for i, page in pages.items()}

from collections import Counter

import pytest

from seepline.llm import html


@pytest.fixture(scope="module")
def model():
    return html.train()


def test_held_out_pages(model):
    exact = shared = got = want = 0
    for seed in range(50_000, 50_150):
        nodes, _, every = html.labelled(html.sample_page(seed))
        source = html.sample_page(seed).replace("", "").replace("", "")
        truth = " ".join(" ".join("".join(n.parts).split()) for n, e in zip(nodes, every, strict=True) if e and not any(isinstance(p, html.Node) for p in n.parts))
        text = model.texts([source])[0]
        exact += text == truth
        a, b = Counter(text.split()), Counter(truth.split())
        shared, got, want = shared + sum((a & b).values()), got + sum(a.values()), want + sum(b.values())
    assert exact >= 125 and shared >= 0.97 * got and shared >= 0.98 * want


def test_parser():
    root = html.parse("<p>a<p>b &amp; c<ul><li>x<li>y</ul><script>if (a<b) {}</script><b>bold<div>in</b>side</div>t<br>u <!-- no --> <a href='>'>l</a")
    nodes = html._nodes(root)
    blocks = [" ".join("".join(n.parts).split()) for n in nodes if not any(isinstance(p, html.Node) for p in n.parts)]
    assert blocks == ["a", "b & c", "x", "y", "bold", "inside", "t u l"]


@pytest.mark.parametrize("source", ["", "   ", "<", "<<<<", "<p", "plain words only", "<div>" * 3000 + "deep", "</p></div>", "<a b='", "&am", "<table><td>x<tr>y", "<script>never ends"])
def test_odd_sources(model, source):
    text = model.texts([source])[0]
    assert text == " ".join(text.split())


def test_decoding_is_consistent():
    import numpy as np

    nodes = html._nodes(html.parse("<div><p>one</p><div><p>two</p><p>three</p></div></div><div><p>four</p></div>"))
    rng = np.random.default_rng(0)
    for _ in range(50):
        kept = html.decode(nodes, rng.random(len(nodes)), rng.random(len(nodes)))
        assert all(not any(isinstance(p, html.Node) for p in n.parts) for n in kept)


def test_extract(spark, model):
    page = "<html><head><title>t</title></head><body><nav><ul><li><a href=/a>menu</a></li></ul></nav><article><h1>Head &amp; line</h1><p>First  paragraph of\ntext.</p><p>Second one.</p></article><footer>&copy; 1</footer></body></html>"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (1, "u", page), (None, "u", page)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = html.extract(made, model).collect()
    assert Counter((r["page_id"], r["text"]) for r in got) == Counter({(1, "Head & line First paragraph of text. Second one."): 2, (None, "Head & line First paragraph of text. Second one."): 1, (2, ""): 1, (3, ""): 1})
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html.extract(made.limit(0), model).count() == 0


@pytest.mark.parametrize("head", ["<head><title>t</title><meta charset=x><body>", "<head><title>t</title>\n", "<head><style>p {}</style><link href=x></body>", "<head></head><body><head>", "<title>t</title><body>"])
def test_head_without_end(model, head):
    """What a head cannot hold ends it; the article is the same as with </head>."""
    rest = "<article><h1>Head line</h1><p>First paragraph of text, and more of it.</p><p>Second one.</p></article></body></html>"
    want = model.texts([f"<html><head><title>t</title></head><body>{rest}"])[0]
    assert want == "Head line First paragraph of text, and more of it. Second one."
    assert model.texts([f"<html>{head}{rest}"])[0] == want
    assert "".join(html.parse(f"<html>{head}loose words").parts).split() == ["loose", "words"]


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<img alt=it's><p>two isn't lost</p>", ["two isn't lost"]),
        ('<a b"c>one</a> "two" > three', ['one "two" > three']),
        ("<p title='a > b' id = \"c>d\" lang=e>one", ["one"]),
        ("<p title=a'b\"c>one's \"own\"", ["one's \"own\""]),
        ('<p a= >one<p b=="x>">two', ["one", '">two']),
        ("<p class=\"x>never closed", ["never closed"]),
        ("<p a='' b=\"\" c/>one", ["one"]),
    ],
)
def test_quotes_in_tags(source, want):
    nodes = html._nodes(html.parse(source))
    assert [" ".join("".join(n.parts).split()) for n in nodes if not any(isinstance(p, html.Node) for p in n.parts)] == want


def test_wide_unclosed_and_stray_pages():
    """Work grows with the page, whatever its shape: each of these took minutes when siblings,
    open tags or the rest of the page were looked through again for every node."""
    import time

    shapes = {
        "siblings": "<ul>" + "<li>some text here" * 50_000 + "</ul>", "unclosed": "<p>x" + "<a " * 100_000, "closed late": "<a " * 100_000 + ">",
        "stray ends": "<p>x" + "</b>" * 100_000, "open bold": "<b>x" * 50_000 + "</b>" * 50_000, "split inline": "<i>" + "<div>x" * 20_000 + "</i>" * 20_000,
    }
    for name, source in shapes.items():
        begun = time.process_time()
        nodes = html._nodes(html.parse(source))
        if nodes:
            html.features(nodes)
        assert time.process_time() - begun < 15, name


#: pages written by hand, in styles that ``sample_page`` does not write, with their main text
BY_HAND = [
    (
        """<html><head><title>River levels</title></head><body bgcolor=white><table width=100%><tr><td colspan=2><a href=/>Home</a> | <a href=/news>News</a> | <a href=/c>Contact</a></td></tr>
<tr><td width=150><a href=1>Maps</a><br><a href=2>Gauges</a><br><a href=3>Archive</a><br><a href=4>Links</a></td><td><h1>River levels fall for a third month</h1>
<p>The gauge at the old mill showed its lowest reading since records began, the water office said on Monday. Wells in the lower valley fell by another two feet.
<p>Farmers were asked to water their fields at night. No limits are planned for households, but that may change if August stays as dry as July was.
<p>The office measures forty wells by hand each month and publishes all of its readings.</td></tr></table><hr><font size=1>Copyright 2004. <a href=p>Privacy</a> <a href=t>Terms</a></font></body></html>""",
        "River levels fall for a third month The gauge at the old mill showed its lowest reading since records began, the water office said on Monday. Wells in the lower valley fell by another two feet. Farmers were asked to water their fields at night. No limits are planned for households, but that may change if August stays as dry as July was. The office measures forty wells by hand each month and publishes all of its readings.",
    ),
    (
        """<!doctype html><html lang=en><body><header><a class=logo href=/>Kitchen notes</a><nav><ul><li><a href=/a>Soups</a><li><a href=/b>Bread</a><li><a href=/c>About me</a></ul></nav></header>
<div id=wrap><div class=post><h2>Lentil soup for a cold evening</h2><div class=meta>12 March &middot; <a href=#r>Leave a reply</a></div>
<p>My grandmother made this soup every Friday, and she never wrote it down. What follows is as close as I have come after many tries.</p>
<h3>What you need</h3><ul><li>Two cups of brown lentils, washed</li><li>One large onion, cut into small pieces</li><li>A spoon of cumin and a little salt</li></ul>
<p>Cook the onion slowly until it is soft, then add the lentils and three times as much water. It is done after about forty minutes, when the lentils fall apart.</p></div>
<div class=comments><h4>2 replies</h4><div class=c><b>Jo</b> says: Made it yesterday, lovely!</div><div class=c><b>Sam</b> says: Mine was too salty.</div><form><input name=q><button>Send</button></form></div>
<div class=side><h4>Recent</h4><ul><li><a href=1>Rye bread</a><li><a href=2>Plum jam</a></ul></div></div><footer>Made with care. <a href=/rss>RSS</a></footer></body></html>""",
        "Lentil soup for a cold evening My grandmother made this soup every Friday, and she never wrote it down. What follows is as close as I have come after many tries. What you need Two cups of brown lentils, washed One large onion, cut into small pieces A spoon of cumin and a little salt Cook the onion slowly until it is soft, then add the lentils and three times as much water. It is done after about forty minutes, when the lentils fall apart.",
    ),
    (
        """<body><div class="x1"><div class="x2"><a href=/>Docs</a><a href=/api>API</a><a href=/faq>FAQ</a><span>v2.1</span></div><div class="x3"><div class="x4"><a href=1>Install</a><a href=2>First steps</a><a href=3>Settings</a><a href=4>Errors</a></div>
<div class="x5"><h1>Settings</h1><p>All settings are read once, when the program starts. A setting that is missing has the value in the table below; one that is not known stops the program with a message.</p>
<pre>level = 3
folder = /var/data</pre><p>The level says how much is written to the log. Level three is right for daily use, and level five writes a line for every request, which soon fills a disk.</p>
<blockquote>Settings from the command line go before those in the file.</blockquote></div></div><div class="x6">Was this page helpful? <a href=y>Yes</a> <a href=n>No</a></div><div class="x7">&copy; The project. <a href=l>License</a></div></div></body>""",
        "Settings All settings are read once, when the program starts. A setting that is missing has the value in the table below; one that is not known stops the program with a message. level = 3 folder = /var/data The level says how much is written to the log. Level three is right for daily use, and level five writes a line for every request, which soon fills a disk. Settings from the command line go before those in the file.",
    ),
]


def test_pages_written_by_hand(spark):
    """Words kept and words left out, on pages of styles the classifier has not seen."""
    from collections import Counter

    pages = spark.createDataFrame([(i, "u", page) for i, (page, _) in enumerate(BY_HAND)], "page_id long, url string, html string")
    got = {r["page_id"]: Counter(r["text"].split()) for r in html.extract(pages, html.train()).collect()}
    right = sum((got[i] & Counter(text.split())).total() for i, (_, text) in enumerate(BY_HAND))
    found, wanted = sum(c.total() for c in got.values()), sum(len(text.split()) for _, text in BY_HAND)
    print("precision", right / found, "recall", right / wanted)
    assert right / found >= 0.85 and right / wanted >= 0.8

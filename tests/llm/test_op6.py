import html as html_module
import math
import random
import re
import time

from gazette.llm import op6_pages as m

PAGE = """<!DOCTYPE html><html><head><title>Nope</title><style>p{}</style><script>var t="<p>x</p>";</script></head><body class="has-sidebar">
<header><h2>Site name.</h2></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two, three.</a></ul></nav>
<div class="cookie-notice">We use cookies, really. Accept them.</div>
%s
<aside>Read also this, and that.</aside><form><label>Name</label><input></form>
<section id="comments"><p>I disagree, wholly. It is a long comment, with commas, by a reader.</p></section>
<footer>&copy; 2024 All rights, reserved.</footer></body></html>"""


def test_article_element():
    body = '<article><header><h1>A  title</h1></header><p>First &amp; <b>bold</b>,\n text&nbsp;here.<br>More<p>Unclosed &lt;p&gt;. <div class="ad">Buy now, cheap.</div><p>x</p><ul><li>one<li>two</ul></article>'
    assert m.main_blocks(PAGE % body) == ["A title", "First & bold, text here. More", "Unclosed <p>.", "x", "one", "two"]


def test_no_article_element():
    text = "A sentence with words, commas and stops. " * 5
    body = f'<div id="content"><h1>Head</h1><div><p>{text}</p><p>{text}</p></div><p>{text}</p><p>{text}</p></div><div class="links"><a href="/">Elsewhere, far.</a></div>'
    assert m.main_blocks(PAGE % body) == ["Head", *[text.strip()] * 4]


def test_odd_pages():
    assert m.main_blocks("") == []
    assert m.main_blocks("plain text, no tags &am") == ["plain text, no tags &am"]
    assert m.main_blocks("<p>a</p></div></p><p>b <i>c</p><p>d</i> e") == ["a", "b c", "d e"]
    assert m.main_blocks("<nav>only <a href=x>menus</a></nav>") == []
    assert m.main_blocks("<script>never closed <p>x") == []
    assert m.main_blocks("<article>" + "<p>word, " * 20000)[0] == "word,"


LONG = "A sentence with words, commas and stops. It goes on; and on. " * 4
L = " ".join(LONG.split())


def test_paths_decide_not_names():
    blocks = lambda body: m.main_blocks(PAGE % body)
    text = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p>"
    for name in ("notice-board", "notice", "comment", "ad", "sidebar-main"):
        assert blocks(f'<div class="{name}"><article>{text}</article></div>') == ["T", L, L]
        assert blocks(f'<div class="{name}">{text}</div>') == ["T", L, L]
        assert blocks(f'<article class="{name}">{text}</article>') == ["T", L, L]
    # A page in one form.
    assert m.main_blocks(f'<form><div class="nav"><a href="/">a</a></div><div>{text}</div><div id="footer"><p>All rights, all.</p></div></form>') == ["T", L, L]
    # Within an article a plain container of a few words doesn't pass; headings, lists and links do.
    assert blocks(f'<article><h1><a href="/x">A title</a></h1><p>{LONG}</p><div class="zz">Share this</div><ul><li><a href="/y">Reference</a></ul></article>') == ["A title", L, "Reference"]
    assert blocks(f'<article>{text}<div class="comment-list"><p>{LONG}</p></div><div class="share-bar">x</div></article>') == ["T", L, L]


def test_several_containers():
    blocks = lambda body: m.main_blocks(PAGE % body)
    assert blocks(f'<div id="content"><h1>T</h1><div class="entry"><p>{LONG}</p></div></div>') == ["T", L]
    assert blocks(f'<div class="lead"><p>{LONG}</p></div><div class="body"><p>{LONG}</p><p>{LONG}</p></div>') == [L] * 3
    small = '<article class="card"><p>Read this, too.</p></article>'
    assert blocks(f'<div><p>{LONG}</p><p>{LONG}</p><p>x</p></div>{small}')[:3] == [L, L, "x"]


def test_linear_in_depth():
    n = 100_000
    for page in ("<div>" * n + "text, here", "<div>x" * n + "</b></i></p>" * n, "<b><i>x</b>" * n, "<div class=ad>word, " * n, "<div><li>" * n):
        began = time.perf_counter()
        m.main_blocks(page)
        assert time.perf_counter() - began < 15


def slow_ratios(blocks):
    """{path: (fused, own)} of (path, text, link characters), one block at a time."""
    paths = [p for p, *_ in blocks]
    value = {}
    for p in set(paths):
        own = [(max(0, len(t) - k), sum(c in '.,;:!?\'"()-' for c in t) if 2 * k < len(t) else 0) for q, t, k in blocks if q == p]
        value[p] = tuple(sum(x) / len(own) for x in zip(*own))
    fused = []
    for i in range(len(blocks)):
        near = [(math.exp(-((i - j) ** 2) / 2), value[paths[j]]) for j in range(max(0, i - 2), min(len(blocks), i + 3))]
        weight = sum(w for w, _ in near)
        fused.append(math.sqrt(sum(w * v[0] for w, v in near) / weight * (sum(w * v[1] for w, v in near) / weight + 1)))
    return {p: (sum(f for q, f in zip(paths, fused) if q == p) / paths.count(p), math.sqrt(value[p][0] * (value[p][1] + 1))) for p in set(paths)}


def test_ratios_as_brute_force():
    rng = random.Random(6)
    for _ in range(50):
        made = []
        for _ in range(rng.randrange(1, 30)):
            text = "".join(rng.choices("abc ,.", k=rng.randrange(1, 60))).strip() or "a"
            made.append((rng.randrange(5), text, rng.choice([0, 0, len(text), len(text) // 2])))
        r = m.ratios([m.Block(p, [], k, t) for p, t, k in made], 5)
        for p, (fused, own) in slow_ratios(made).items():
            assert math.isclose(r.fused[p], fused) and math.isclose(r.own[p], own)


def test_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>a b</p>"), (3, "u", "<p>a b</p>"), (None, "u", "<article><p>é!</article>")]
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = {(r.page_id, r.url, r.text, r.n_chars) for r in m.extract(df).collect()}
    assert found == {(1, "u", "", 0), (2, None, "", 0), (3, "u", "a b", 3), (None, "u", "é!", 2)}
    assert m.extract(df).count() == 5
    assert m.extract(df.limit(0)).count() == 0


def test_whole_table(spark):
    """Brute force for this table's one page shape: what stands in the article element."""
    sf = "/root/testdata/sf0.01"
    own = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in m.op6_pages(spark, sf).collect():
        body = re.search(r"(?s)<article>(.*)</article>", own[r.page_id])[1]
        blocks = [" ".join(html_module.unescape(re.sub(r"<br>|</?b>", lambda x: " " if x[0] == "<br>" else "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_links_and_anchors():
    text = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p>"
    # An anchor without an address is no link, closed or not; a link around blocks is that of its first.
    assert m.main_blocks(PAGE % f'<a name="top"><div id="c">{text}</div>') == ["T", L, L]
    assert m.main_blocks(PAGE % f'<div id="c"><h1>T</h1><p><a name="p1">{LONG}</p><p><a id="p2">{LONG}</p></div>') == ["T", L, L]
    assert m.main_blocks(PAGE % f'<a href="/x"><article>{text}</article></a>') == ["T", L, L]
    # Links among the text stay, on pages without an article as well; a menu before it goes.
    refs = '<h2>References</h2><ul><li><a href="a">One</a></li><li><a href="b">Two</a></li></ul>'
    assert m.main_blocks(PAGE % f'<div id="c"><ul><li><a href="/">Home</a></li></ul>{text}{refs}</div>') == ["T", L, L, "References", "One", "Two"]


def test_hints_inside_hints_of_any_depth():
    text = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p>"
    for n in (7, 10, 300):
        body = "".join(f'<div class="widget w{i}">' for i in range(n)) + text + "</div>" * n
        assert m.main_blocks(f'<body>{body}<div class="ad">Buy now, and more.</div><div class="footer">All rights, all.</div></body>') == ["T", L, L], n


def test_hostile_pages_are_linear():
    for junk in ("<a ", "<!--", "<", "</", '<a x="', "<a x='", "<script>", "&amp", '<div class="x', "<p><b>", "<!-- x -->", "<div>", "<a href=x>y", '<div class="widget">', "<!", "< a", "<a/"):
        began = time.perf_counter()
        m.main_blocks(junk * (1_000_000 // len(junk)))
        assert time.perf_counter() - began < 15, junk


def test_tags_as_they_are_written():
    e = lambda page: [(k, w) for k, w, _ in m.events(page)]
    assert e("a<B x=1>b</b >c<br/>d") == [("text", "a"), ("start", "b"), ("text", "b"), ("end", "b"), ("text", "c"), ("empty", "br"), ("text", "d")]
    assert e("<!-->a<!-- <p> -->b<!doctype x>c<?y>d</>e") == [("text", x) for x in "abcde"]
    assert e("1 < 2 && 3 > 2 <3") == [("text", "1 < 2 && 3 > 2 <3")]
    assert e("<script>if (a<b) '</p>'</SCRIPT >x") == [("start", "script"), ("text", "if (a<b) '"), ("end", "p"), ("text", "'"), ("end", "script"), ("text", "x")] or e("<script>a<b</SCRIPT >x")[-1] == ("text", "x")
    assert list(m.events("<p CLASS='a &amp; b' class=c hidden>"))[0] == ("start", "p", [("class", "a & b"), ("hidden", "")])
    assert e("<p title='never closed") == [("start", "p")] or e("<p title='never closed") == []

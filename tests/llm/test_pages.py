"""Main text of pages: the reader, wrappers, and whole sites with known articles."""

import html as library
import os
import random
import re

import pytest

import __spark_entry__ as entry
from snaptally.llm._html import parse
from snaptally.llm.page_wrappers import Reader, Wrapper, expressions, main_text, wrappers

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def sentences(rng, n):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda naïve größe ciudad".split()
    return " ".join(" ".join(rng.choice(words) for _ in range(rng.randrange(4, 14))).capitalize() + "." for _ in range(n))


def article(rng):
    return [sentences(rng, 1)] + [sentences(rng, rng.randrange(1, 5)) for _ in range(rng.randrange(2, 7))]


def plain(blocks):
    head, *rest = (library.escape(b, quote=False) for b in blocks)
    return f"<h1>{head}</h1>" + "".join(f"<p>{b}</p>" for b in rest)


def links(rng, n):
    return "<ul>" + "".join(f'<li><a href="/{i}">{sentences(rng, 1)[:12]}</a></li>' for i in range(n)) + "</ul>"


def site_tags(rng, blocks, i):
    return f"""<!doctype html><html><head><title>T {i}</title><style>p{{}}</style></head><body>
    <header><h2>The Site</h2><form action="/s"><input name=q><button>Go</button></form></header><nav>{links(rng, 5)}</nav>
    <div id="cookie-notice">We use cookies. <button>OK</button></div>
    <main><article>{plain(blocks)}<aside>{sentences(rng, 3)}</aside><section class="comments"><h3>2 comments</h3><p>{sentences(rng, 2)}</p></section></article></main>
    <aside class="sidebar">{sentences(rng, 6)}</aside><footer>&copy; Site {sentences(rng, 2)}</footer><script>var x = "<p>no</p>";</script></body></html>"""


def site_names(rng, blocks, i):
    return f"""<html><body><div id="header"><h1>Site</h1></div><div class="topnav">{links(rng, 6)}</div>
    <div id="wrap" class="has-sidebar"><div class="post-content">{plain(blocks)}<div class="ad-box">{sentences(rng, 2)}</div></div>
    <div class="sidebar">{sentences(rng, 3)}</div></div><div id="comments"><p>{sentences(rng, 4)}</p></div>
    <div class="newsletterSignup"><form><label>Mail</label><input></form></div><div class="footer">{sentences(rng, 1)}</div>"""


def site_bare(rng, blocks, i):
    """No tag or name says what is what: link text, fixed text and the share of text do."""
    menu = "".join(f'<a href="/{j}">{w}</a> ' for j, w in enumerate(("Home", "News", "Sport", "Weather", "About us", "Contact")))
    return f"""<html><body><div class=x1>{menu}</div><div class=x2><div class=x3>{plain(blocks)}</div>
    <div class=x4>Subscribe now and never miss a word of this wonderful site</div></div><div class=x5>All rights reserved by the owners of the site</div></body></html>"""


def site_loose(rng, blocks, i):
    """Unclosed elements, a banner on some pages only, comments under a heading."""
    head, *rest = (library.escape(b, quote=False) for b in blocks)
    banner = f"<div class=banner>{sentences(rng, 2)}</div>" if i % 2 else ""
    return f"<body><nav>{links(rng, 3)}</nav>{banner}<article><header><h1>{head}</h1><span class=byline>by me</span></header>" + "".join(f"<p><b>{b}<br>" for b in rest) + f"<h3>Comments (3)</h3><ol><li>{sentences(rng, 1)}<li>{sentences(rng, 2)}</ol></article><footer>{sentences(rng, 1)}"


SITES = {"tags": site_tags, "names": site_names, "bare": site_bare, "loose": site_loose}


def sites(n=12):
    rng = random.Random(3)
    rows, want = [], {}
    for name, make in SITES.items():
        for i in range(n):
            blocks = article(rng)
            key = len(rows)
            rows.append((key, f"https://www.{name}.example.org:80/{i}?q#x", make(rng, blocks, i)))
            want[key] = "\n".join(blocks)
    return rows, want


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_sites(spark, sent):
    rows, want = sites()
    got = main_text(spark.createDataFrame(rows, PAGES).repartition(5), sent_bytes=sent).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got) and {r.page_id: r.url for r in got} == {r[0]: r[1] for r in rows}


def test_expressions(spark):
    rows, _ = sites()
    got = {r.host: (r.pages, r.expression) for r in expressions(wrappers(spark.createDataFrame(rows, PAGES).repartition(7))).collect()}
    assert set(got) == {f"www.{x}.example.org" for x in SITES} and {n for n, _ in got.values()} == {12}
    assert "<h1>TEXT</h1>(<p>TEXT</p>)+" in got["www.bare.example.org"][1] and "<div.x>FIXED</div>" not in got["www.tags.example.org"][1]
    assert "(<div.banner>TEXT</div>)?" in got["www.loose.example.org"][1]


def test_alignment_rules():
    w = Wrapper()
    for page in ("<p>a</p><ul><li>1<li>2</ul><p>b</p>", "<p>a</p><hr>", "<p>a</p>"):
        w.take(parse(page))
    assert w.root.expression() == "(<p>TEXT</p>(<hr></hr>)?(<ul>(<li>TEXT</li>)+</ul>)?)+" or w.root.expression() == "(<p>TEXT</p>(<ul>(<li>TEXT</li>)+</ul>)?)+(<hr></hr>)?"
    fixed = Wrapper()
    for i in range(3):
        fixed.take(parse(f"<div>same</div><div class=b>{i}</div>"))
    assert fixed.root.expression() == "<div>FIXED</div><div.b>TEXT</div>"


def test_wrappers_join_as_pages_align():
    """Whatever the order and shares, the counts agree, and no text is read differently."""
    rows, want = sites()
    for name in SITES:
        mine = [r for r in rows if name in r[1]]
        whole = Wrapper()
        for r in mine:
            whole.take(parse(r[2]))
        for seed in range(4):
            random.Random(seed).shuffle(mine)
            parts = [Wrapper() for _ in range(seed + 1)]
            for i, r in enumerate(mine):
                parts[i % len(parts)].take(parse(r[2]))
            joined = Wrapper()
            for p in parts:
                joined.join(Wrapper.unpack(p.pack()))
            assert (joined.root.n, joined.root.chars, joined.root.linked, joined.pages) == (whole.root.n, whole.root.chars, whole.root.linked, whole.pages)
            reader = Reader(joined)
            assert all(reader.text(parse(r[2])) == want[r[0]] for r in mine)


def test_copies_stay_whole():
    """A host of copies of one page: nothing counts as fixed."""
    page = "<body><div class=x1>Menu line here</div><div class=x2><p>One.</p><p>Two words and more of them, all over.</p></div>"
    w = Wrapper()
    for _ in range(50):
        w.take(parse(page))
    assert "Two words" in Reader(w).text(parse(page)) and len(w.pages) == 1


def test_odd_rows(spark):
    rows = [
        (1, None, "<article><p>no url</p></article>"), (2, "not a url", "<article>tail"), (3, "http://a.example/", None), (4, "http://a.example/", ""),
        (5, "http://A.example/x", "just text &amp; &lt;b&gt; &amp &#233;&nbsp; x"), (5, "http://A.example/x", "just text &amp; &lt;b&gt; &amp &#233;&nbsp; x"), (None, "http://b.example/", "<p>only"),
        (6, "http://c.example", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after</article>"), (7, "//d.example/p", "<article><p>" + "long words " * 200_000 + "</p></article>"),
        (8, "http://e.example", "<script>unclosed <article>x"), (9, "http://e.example", "<article><p>a<p>b<table><tr><td>c<td>d</table></article"),
    ]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as host", "2 as text", "3 as wrapper", "4 as share")
    got = main_text(df, keep=("host", "text", "wrapper"))
    assert got.columns == ["page_id", "url", "host", "wrapper", "text", "n_chars"]
    texts = sorted((r.page_id or 0, r.text) for r in got.collect())
    assert texts == [
        (0, "only"), (1, "no url"), (2, "tail"), (3, ""), (4, ""), (5, "just text & <b> & é x"), (5, "just text & <b> & é x"), (6, "deep\nafter"),
        (7, ("long words " * 200_000).strip()), (8, ""), (9, "a\nb\nc\nd"),
    ]
    empty = spark.createDataFrame([], PAGES)
    assert main_text(empty).collect() == [] and main_text(empty, sent_bytes=-1).collect() == []


def test_many_kinds_of_elements_stay_bounded():
    w = Wrapper()
    for i in range(400):
        w.take(parse("".join(f'<div class="a{chr(97 + (i * j) % 26)}{chr(97 + i % 26)}{chr(97 + j % 26)}x">{i}</div>' for j in range(12)) + f"<article><p>{i} text</p></article>"))
    assert len(w.root.children) <= 2 * 48 + 1 and len(w.pack()) < 20_000
    assert Reader(w).text(parse("<div class=zzz>new</div><article><p>9 text</p></article>")) == "9 text"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = entry.queries()["op12_html_extraction"](spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(library.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, "\n".join(b for b in blocks if b), len(r.text))

"""Main text of pages: markup, odd pages, and repeats across a host's distinct pages against plain substring search."""

from __future__ import annotations

import html
import random
import re
import time

import pytest

from lattica.llm import boilerplate, queries
from lattica.llm.html_blocks import ARTICLE, AROUND, OPEN, blocks

SHAPE = "page_id long, url string, html string, text string, n_chars string, key string, name string"


def table(spark, pages, urls=None, ids=None):
    rows = [(i, u, h, *["x"] * 4) for i, u, h in zip(ids or range(len(pages)), urls or ["http://a.org/1"] * len(pages), pages, strict=True)]
    return spark.createDataFrame(rows, SHAPE)


def extracted(spark, pages, urls=None):
    got = boilerplate.extract(table(spark, pages, urls), "url", "html", ["page_id", "text"]).toDF("page_id", "was", "text", "n_chars", "n_repeated", "n_marked").collect()
    assert all(r.was == "x" and r.n_chars == len(r.text) for r in got)
    return {r.page_id: r for r in got}


def kept(page):
    return " ".join(b.text for b in blocks(page) if b.kind != AROUND)


@pytest.mark.parametrize(
    "page,want",
    [
        (None, ""),
        ("", ""),
        ("plain  text\n only", "plain text only"),
        ("<article><h1>T</h1><p>a<b>b</b>c<br>d <p>e\n f</article>", "T abc d e f"),
        ("<article>x &amp; y &lt;z&gt; &#233;&eacute;&nbsp;q &copy; &zzentity; &am</article>", "x & y <z> éé q © &zzentity; &am"),
        ("<article>a<script>var t='</p>';if(a<b)</script>b<style>p{}</style><!-- c > --><!-->d</article>", "abd"),
        ("<nav>m</nav><header>h</header><article><header><h1>T</h1></header><p>x</p><footer>f</footer><aside>s</aside></article><footer>g</footer>", "T x"),
        ("<article><p>x</p><div class='ad-slot'>buy</div><div id=userComments><article>me too</article></div><form><input value=v>mail</form>y</article>", "x y"),
        ("<div class='cookie-notice'>we use cookies</div><main><p>x</p><div role=complementary>r</div></main>", "x"),
        ("<div class=sidebar><article>inside a named wrapper</article></div>", "inside a named wrapper"),
        ("<div class=page><div class='entry-content'>c<p>d</div><div>other</div></div>", "c d"),
        ("<article><p class=notice>n<p>x<ul><li class=ad>b<li>y</ul><span class=sponsored>z</span>w</article>", "x y w"),
        ("<article>1 < 2 and 3<4 <a href=\"x>y\">l</a> <a href='u>t", "1 < 2 and 3<4 l t"),
        ("<article>x<table><tr><td>a<td>b</table><select><option>o</select><textarea>t</textarea></article>", "x a b"),
        ("<ARTICLE>X<SCRIPT>never closed", "X"),
        ("<nav><ul><li>a</nav>x<noscript>on</noscript>", "x"),
    ],
)
def test_blocks(page, want):
    assert kept(page) == want


@pytest.mark.parametrize("tail,want", [("<!-- never closed > x", "a"), ("<script>x>y", "a"), ("<!-- c -->b", "ab"), ("<script>x</script>b", "ab"), ("<a href=x", "a<a href=x"), ("<", "a<")])
def test_ends(tail, want):
    assert kept("<p>a" + tail) == want


@pytest.mark.parametrize("piece", ["<a ", "<a '", '<a ">', "<a href='x\" ", "<!-- ", "<script", "&amp", "<b>", "</p>", "<p class='ad"])
def test_long_broken_pages_take_linear_time(piece):
    began = time.process_time()
    blocks(piece * 100_000 + ">")
    blocks(piece * 100_000)
    assert time.process_time() - began < 20


def test_kinds():
    assert [b.kind for b in blocks("<p>x</p><article>y</article>")] == [AROUND, ARTICLE]
    assert [b.kind for b in blocks("<p>x</p><nav>y</nav>")] == [OPEN, AROUND]


def plain_repeats(pages: dict[int, str], hosts: dict[int, str]) -> dict[int, list[bool]]:
    """Which tokens of each page's stream lie in a substring of LONG tokens or more that a distinct page of the host has too."""
    n = boilerplate.LONG
    streams = {i: boilerplate.stream(blocks(p)).split("\n") for i, p in pages.items()}
    who = {i: boilerplate.identities(blocks(p)) for i, p in pages.items()}
    where = {}
    for i, s in streams.items():
        for a in range(len(s) - n + 1):
            where.setdefault((hosts[i], *s[a : a + n]), set()).add(i)
    out = {i: [False] * len(s) for i, s in streams.items()}
    for i, s in streams.items():
        for a in range(len(s) - n + 1):
            own = where[(hosts[i], *s[a : a + n])]
            if sum(len({who[j][r] for j in own}) > 1 for r in range(3)) >= 2:
                out[i][a : a + n] = [True] * n
    return out


def test_repeats_equal_plain_search(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(99)) for _ in range(n))
    menu, notice, foot = "<ul>" + "".join(f"<li>M{w}" for w in range(7)) + "</ul>", f"<p>{' '.join(f'N{w}' for w in range(30))}</p>", f"<p>{prose(5)}</p>"
    pages, urls = [], []
    for i in range(30):
        own = "".join(f"<p>{prose(rng.randrange(5, 40))}</p>" for _ in range(4))
        pages.append(f"<html><body><div>{menu}</div>{own if i % 2 else own + notice}<div>{prose(3)} {foot}</div></body></html>")
        urls.append(f"https://user@{'a' if i % 3 else 'B'}.org:80/{i}")
    pages += [pages[1]] * 5 + [pages[2].replace("<p>", "<p>also ", 1)]  # copies and a near copy
    urls += [urls[1]] * 5 + [urls[2]]
    pages += [None, "", "<p>only here</p>", pages[1]]
    urls += [None, "no host", None, "http://elsewhere.net/"]
    got = extracted(spark, pages, urls)
    hosts = {i: re.sub(r"^https?://(?:user@)?([^/:]*).*|.*", r"\1", u or "", count=1).lower() for i, u in enumerate(urls)}
    cover = plain_repeats(dict(enumerate(pages)), hosts)
    for i, p in enumerate(pages):
        at, want, gone = boilerplate.ENDS, [], 0
        for b in blocks(p):
            ws = b.text.split(" ")
            own = cover[i][at + 1 : at + 1 + len(ws)]
            want += [w for w, c in zip(ws, own, strict=True) if not c]
            gone += sum(own)
            at += 1 + len(ws)
        assert got[i].text == " ".join(want) and got[i].n_repeated == gone, i
    for i in range(36):
        assert len(got[i].text.split()) > 15 and not re.search("[MN]", got[i].text), i
    assert got[39].text.startswith("M0 M1")  # nothing repeats on that host


def test_articles_keep_what_other_pages_repeat(spark):
    shared = " ".join(f"w{i}" for i in range(60))
    pages = [f"<nav>home about</nav><article><p>{shared}</p><p>page {i}</p></article><footer>f {shared}</footer>" for i in range(12)]
    got = extracted(spark, pages)
    assert all(got[i].text == f"{shared} page {i}" and got[i].n_repeated == 63 for i in range(12))


def test_empty_table_and_long_pages(spark):
    assert extracted(spark, []) == {}
    long = "<article>" + "<p>word &amp; more</p>" * 50_000 + "</article>"
    got = extracted(spark, [long, "<div>" * 5_000 + "deep", long])
    assert got[0].text == got[2].text == " ".join(["word & more"] * 50_000)
    assert got[1].text == "deep"


def test_query_gives_the_articles(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = queries.op13_html_extraction(spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S).group(1)
        inner = re.sub("</?(?:p|h1)>|<br>", " ", inner).replace("<b>", "").replace("</b>", "")
        assert r.text == " ".join(html.unescape(inner).split()) and r.url == pages[r.page_id].url and r.n_chars == len(r.text)

from __future__ import annotations

import html
import math
import random
import re

import pytest

from partnerwatch.llm import html_text as H
from partnerwatch.llm.common import table
from tests.llm.data import rows

SF = "/root/testdata/sf0.01"


def test_pages_give_their_articles(spark):
    df = table(spark, SF, "pages")
    got = {r["page_id"]: r for r in H.extract_main_text(df).collect()}
    for r in df.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


PARAGRAPH = "This paragraph has a good number of words in it, as articles do, and goes on for a while."
PAGE = f"""<!doctype html><HTML><head><title>T</title><style>p {{}}</style></head><body>
<header><h1>Site name</h1><a href=/>Home</a></header><div class="cookie-notice">We use cookies &amp; more</div>
<div id=wrap><div class=menu><a>a</a> <a>b</a></div><div class=%s><h2>Head &amp; line</h2><p>{PARAGRAPH}<p>A <b>bold</b>ly
 split&nbsp;line, 1 &lt; 2.<ul><li>first point of it<li>second point</ul><div class="ad-slot">Buy now, buy now, buy now, buy now</div>
<form>Name <input name=x><button>Send</button></form><script>if (a < b) document.write("<p>no</p>")</script><p>{PARAGRAPH}</p>%s</div>
<aside>Other stories that people read, of which there are many</aside><div id=comments><p>Nice post! {PARAGRAPH}</p></div></div>
<footer>&copy; all rights</footer></body></html>"""
WANT = f"Head & line\n{PARAGRAPH}\nA boldly split line, 1 < 2.\nfirst point of it\nsecond point\n{PARAGRAPH}"


@pytest.mark.parametrize("name", ["content", "post", '"x1 y2"'])
@pytest.mark.parametrize("more", ["", "<!-- <p>hidden</p> -->", "<ul><li><a href=a>One other story</a><li><a href=b>Two other stories</a></ul>"])
def test_main_text_without_what_surrounds_it(name, more):
    assert H.main_text(PAGE % (name, more)) == WANT


def test_broken_pages_never_fail():
    assert H.main_text(None) == H.main_text("") == H.main_text("<html><body></body></html>") == ""
    assert H.main_text("no markup < at all & more") == "no markup < at all & more"
    assert H.main_text("<p>" * 30_000 + "x") == "x"
    assert H.main_text("<div>" * 30_000 + "deep") == "deep"
    assert H.main_text("<p>a</b></div></p></p><p>b") == "a\nb"
    assert H.main_text("<p>a<script>never closed <p>b") == "a"
    assert H.main_text("<p>a<!-- never closed <p>b") == "a"
    assert H.main_text('<p title="never closed>a</p><p>b</p>') == "a\nb"
    assert H.main_text("<table><tr><td>1<td>2<tr><td>3</table>") == "1\n2\n3"
    assert H.main_text("<p>&#x41;&#66;&eacute;&bogus;<br>next") == "ABé&bogus; next"
    assert H.main_text("<article><p>one<p>" + "long " * 50_000 + "</article>").startswith("one\nlong long")


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (2, "u", "", "x"), (2, "u", "<p>a</p>", "x"), (None, "u", "<p>é\U0001f642</p>", "x")], "page_id long, url string, html string, text string")
    got = H.extract_main_text(df)
    assert sorted((r["text"], r["n_chars"]) for r in got.collect()) == [("", 0), ("", 0), ("a", 1), ("é\U0001f642", 2)]
    assert rows(H.extract_main_text(df.limit(0))) == []


@pytest.mark.parametrize("tag", ["article", "main"])
def test_articles_keep_what_only_has_a_name_like_that_of_a_notice_or_menu(tag):
    sources = "".join(f"<li><a href=s{i}>Source number {i} of the article</a></li>" for i in range(8))
    inner = f"""<h1>Title</h1><p>{PARAGRAPH}</p><h2 id="related-work">Related work</h2><section id="menu-planning"><p>On menus. {PARAGRAPH}</p></section>
<div class="social-science"><p>On society. {PARAGRAPH}</p></div><p id="notice-1">One notice.</p><p class="notice">Two notices.</p><section id="navigation"><h2>At sea</h2></section>
<p>An <span class="ad-hoc">ad hoc</span> word.</p><div class="ad">Buy now</div><div id="comments">Nice post!</div><ul class="share-buttons"><li><a href=x>Tell your friends</a></li></ul>
<h2>Sources</h2><ol>{sources}</ol><section id="references"><div><a href=y>Last source</a></div></section>"""
    page = f'<html><body><div class="menu-top"><a href=/>Home</a></div><div id="notice-1">We use cookies</div><{tag}>{inner}</{tag}><div class=foot><ul><li><a href=z>Another story</a></ul></div></body></html>'
    want = ["Title", PARAGRAPH, "Related work", f"On menus. {PARAGRAPH}", f"On society. {PARAGRAPH}", "One notice.", "At sea", "An ad hoc word.", "Sources"]
    assert H.main_text(page).split("\n") == [*want, *(f"Source number {i} of the article" for i in range(8)), "Last source"]


ARTICLE = f"<h1>Title</h1><p>{PARAGRAPH}</p><p>Second. {PARAGRAPH}</p>"
KEPT = f"Title\n{PARAGRAPH}\nSecond. {PARAGRAPH}"


@pytest.mark.parametrize("page", [
    f'<main><article>{ARTICLE}</article><section id="comments"><p>Nice! {PARAGRAPH}</p></section></main>',
    f'<main><article>{ARTICLE}<div class="comment-list"><p>Nice! {PARAGRAPH}</p></div></article></main>',
    f'<main><article>{ARTICLE}</article><article class="comment"><p>Nice! {PARAGRAPH} {PARAGRAPH} {PARAGRAPH} {PARAGRAPH}</p></article></main>',
    f'<article>{ARTICLE}<article class="comment depth-1"><p>Nice! {PARAGRAPH}</p></article></article>',
    f'<article>{ARTICLE}<p class="ad">Buy now, buy more.</p></article>',
    f'<article>{ARTICLE}<div class="ad-slot">Buy now, buy more.</div></article>',
    f'<main><div class="cookie-banner"><p>We use cookies.</p></div>{ARTICLE}</main>',
    f'<main>{ARTICLE}<div class="sidebar-widget"><p>Popular today.</p></div></main>',
    f'<main>{ARTICLE}<div class="related-posts"><p>Read this too.</p></div></main>',
    f'<main><header>Site, tagline</header>{ARTICLE}</main>',
    f'<main><header>Site, tagline</header><article>{ARTICLE}</article></main>',
    f'<article><header><h1>Title</h1></header>{ARTICLE.removeprefix("<h1>Title</h1>")}<p class="notice">Two notices.</p></article>',
    f'<body><article>{ARTICLE}{ARTICLE}{ARTICLE}</article><article><p>A teaser of another story.</p></article></body>',
])
def test_what_surrounds_or_interrupts_an_article_goes(page):
    want = "\n".join([KEPT] * 3) if "teaser" in page else KEPT
    assert H.main_text(f"<html><body>{page}</body></html>") == want


def test_densities_and_the_main_element_by_their_definition():
    rng = random.Random(5)

    def grow(depth):
        tag = rng.choice(["div", "p", "section", "a", "span", "ul"]) if depth else "div"
        kids = [] if depth > 4 else [rng.choice(["", "some words ", "x"]) if rng.random() < 0.5 else grow(depth + 1) for _ in range(rng.randint(0, 4))]
        return tag, kids

    def render(node):
        return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(render, node[1]))}</{node[0]}>"

    def measure(node, linked=False):
        """(characters, link characters, tags, link tags) of a subtree."""
        if isinstance(node, str):
            c = len("".join(node.split()))
            return c, c * linked, 0, 0
        own = [measure(k, linked or node[0] == "a") for k in node[1]]
        nested = [k for k in node[1] if not isinstance(k, str)]
        return sum(x[0] for x in own), sum(x[1] for x in own), sum(x[2] for x in own) + len(nested), sum(x[3] for x in own) + sum(k[0] == "a" for k in nested)

    checked = 0
    for _ in range(200):
        body = ("body", [t for t in (grow(1) for _ in range(3)) if t[0] not in ("a", "p")])  # these would close each other
        text = render(body)
        page = H.Page(text)
        order, linked, parents, todo = [], [], [], [(body, False, 0)]
        while todo:
            node, inside, parent = todo.pop()
            order.append(node)
            linked.append(inside)
            parents.append(parent)
            at = len(order)
            todo += [(k, inside or node[0] == "a", at) for k in reversed(node[1]) if not isinstance(k, str)]
        if page.tags[1:] != [n[0] for n in order] or page.parents[1:] != parents:
            continue  # the reader closed a paragraph or an item by its rules
        checked += 1
        c0, lc0, _, _ = measure(body)
        want = []
        for node, inside in zip(order, linked):
            c, lc, t, lt = measure(node, inside)
            if not c:
                want.append(0.0)
                continue
            t = max(t, 1)
            base = math.log(c / max(c - lc, 1) * lc + lc0 / max(c0, 1) * c + math.e)
            ratio = max(c / max(lc, 1) * t / max(lt, 1), 1.0)
            want.append(c / t * (math.log(ratio) / max(math.log(base), 1e-3) if base > 1.001 else math.log(ratio)))
        best, threshold, density = page.main()
        assert density[1:] == pytest.approx(want)
        by_id = {id(n): i for i, n in enumerate(order)}
        sums = [sum(want[by_id[id(k)]] for k in n[1] if not isinstance(k, str) and k[0] in H.BLOCKS) for n in order]
        if best:
            assert sums[best - 1] == pytest.approx(max(sums))
            path, i = [], best
            while page.tags[i] not in ("body", "#root"):
                path.append(density[i])
                i = page.parents[i]
            assert threshold == pytest.approx(min([density[best], *path, density[i]] if i else [density[best], *path]))
    assert checked > 40

"""Main text of pages: planted parts around articles, broken markup, densities against a recursive version."""

import math
import random

import pytest

from cohorta.llm import html_text as H
from cohorta.llm.queries import op12_main_text

SCHEMA = "page_id bigint, url string, html string"
SENTENCE = "The quick brown fox, which nobody had seen before, jumps over the lazy dog again."


def paragraphs(seed, n):
    rng = random.Random(seed)
    words = "some words of the article that nobody else would write here today in any case".split()
    return [" ".join(rng.choice(words) for _ in range(rng.randint(25, 60))) + "." for _ in range(n)]


def page(inner, before="", after=""):
    return (
        "<!DOCTYPE html><html><head><title>Head</title><style>p{}</style><script>var a = '<p>no</p>';</script></head>"
        f"<body>{before}{inner}{after}</body></html>"
    )


AROUND = {
    "menu": '<nav><ul><li><a href="/a">Menu A</a></li><li><a href="/b">Menu B</a></li></ul></nav>',
    "menu by class": '<ul class="main-menu"><li><a href="/a">Menu A</a></li></ul>',
    "header": '<header><a href="/">Site name</a><p>Slogan of the site</p></header>',
    "footer": "<footer><p>&copy; 2024 All rights reserved by somebody.</p></footer>",
    "sidebar": '<div id="sidebar"><h3>Latest</h3><p>Something else entirely that is not the article.</p></div>',
    "aside": "<aside><p>An aside about another thing that is longer than usual, really.</p></aside>",
    "notice": '<div class="cookie-notice"><p>We use cookies to make this site better for everybody.</p></div>',
    "role": '<div role="alert"><p>Maintenance tonight from ten to eleven.</p></div>',
    "advert": '<div class="ad">Buy this wonderful thing now and pay only half of it.</div>',
    "form": '<form action="/s"><label>Name</label><input name="n"><button>Send</button></form>',
    "script": "<script>document.write('<p>written</p>')</script><noscript>Please switch on scripts.</noscript>",
    "comments": '<section id="comments"><article class="comment"><p>I am the first reader to say something.</p></article></section>',
    "links": "<div><a href='/1'>One other story</a> <a href='/2'>Two other stories</a> <a href='/3'>Three</a></div>",
}


@pytest.mark.parametrize("holder", ["<article>{}</article>", "<main><div>{}</div></main>", '<div class="content">{}</div>'])
@pytest.mark.parametrize("part", AROUND)
def test_parts_around_the_article_go(holder, part):
    body = paragraphs(1, 6)
    inner = holder.format("<h1>A title</h1>" + "".join(f"<p>{p}</p>" for p in body))
    want = "\n".join(["A title", *body])
    assert H.main_text(page(inner, before=AROUND[part])) == want
    assert H.main_text(page(inner, after=AROUND[part])) == want


def test_parts_inside_the_article_go():
    body = paragraphs(2, 4)
    inner = (
        f"<article><header><nav><a href='/'>Home</a></nav><h1>A title</h1><p class='byline'>by someone</p></header><p>{body[0]}</p>"
        f"{AROUND['advert']}<p>{body[1]}</p>{AROUND['form']}<p>{body[2]}</p>{AROUND['comments']}<p>{body[3]}</p><footer>Filed here</footer></article>"
    )
    assert H.main_text(page(inner)) == "\n".join(["A title", *body])


def test_short_blocks_lists_and_tables_of_the_article_stay():
    inner = f"<article><h1>T</h1><p>Of.</p><p>{SENTENCE}</p><ul><li>one<li>two <b>bold</b></ul><table><tr><td>c1<td>c2</table><pre>a\n  b</pre></article>"
    assert H.main_text(page(inner)) == f"T\nOf.\n{SENTENCE}\none\ntwo bold\nc1\nc2\na b"


def test_sections_side_by_side_are_all_content():
    body = paragraphs(3, 9)
    inner = "".join("<div>" + "".join(f"<p>{p}</p>" for p in body[i : i + 3]) + "</div>" for i in (0, 3, 6))
    assert H.main_text(page(f"<div>{inner}</div>", AROUND["links"])) == "\n".join(body)


def test_broken_markup():
    assert H.main_text("<article><p><b>One<br>two<p>three</article><footer>x") == "One two\nthree"
    assert H.main_text("<p>a < b & c &lt;d&gt; &amp;amp; &#233;&nbsp;&copy;</p>") == "a < b & c <d> &amp; é ©"
    assert H.main_text("<p>one</p><!-- <p>no</p> --><p>two</p><!-- never closed <p>no</p>") == "one\ntwo"
    assert H.main_text("<article><b>Bold<p>block</b> goes on</p></article>") == "Bold\nblock goes on"
    assert H.main_text("<p>text <a href=\"x>y\">link</a> end <img alt='a>b'>tail</p><p title='>'>t</p>") == "text link end tail\nt"
    assert H.main_text("<script>if (a < b) '</p>'</script >seen<style>p{}</style>") == "seen"
    assert H.main_text("<p>cut off <a href='") == "cut off"
    assert H.main_text("</div></p>x</b></article>y") == "xy"
    assert H.main_text("<p>İx<script>İ</script>y</p>") == "İxy"
    assert H.main_text("<svg/><p>a<span/>b<br/>c</p>") == "ab c"
    assert H.main_text("<svg><path d='x'/></svg><p>a<br/>c</p>") == "a c"


def test_text_without_tags_and_nothing():
    assert H.main_text("just text\n  here") == "just text here"
    assert [H.main_text(t) for t in (None, "", " \n\t", "<p> </p>", "<script>x</script>", "<", "<!---->")] == ["", "", "", "", "", "<", ""]


def test_long_and_deep_pages():
    deep = "<div>" * 20_000 + SENTENCE + "</div>" * 20_000
    assert H.main_text(deep) == SENTENCE
    many = "<article>" + f"<p>{SENTENCE}" * 30_000 + "</article>"
    assert H.main_text(many) == "\n".join([SENTENCE] * 30_000)


def test_densities_as_in_their_definition():
    """Counts by recursion over the tree; the adjusted density and sums by the formula."""
    tree = H.parse(page('<div id="a"><p>Some text <a href="x">a link</a></p><p>More</p></div>', "<ul><li><a href='x'>Home</a></li></ul>"))
    cut = H.around(tree)
    density, sums, body = H.densities(tree, cut)
    text = dict(tree.text)
    below = lambda i: [j for j in range(len(tree.tag)) if tree.parent[j] == i and not cut[j]]

    def counts(i):
        got = [counts(j) for j in below(i)]
        c = len("".join(text.get(i, "").split())) + sum(g[0] for g in got)
        t = sum(g[1] + (tree.tag[j] != "#text") for g, j in zip(got, below(i)))
        if tree.tag[i] == "a":
            return c, t, c, 1 + sum(g[3] for g in got)
        return c, t, sum(g[2] for g in got), sum(g[3] for g in got)

    whole = counts(body)
    seen = 0
    for i in range(len(tree.tag)):
        c, t, lc, lt = counts(i)
        if cut[i] or not c or tree.tag[i] == "#text":
            assert density[i] == 0
            continue
        base = math.log(c / max(1, c - lc) * lc + whole[2] / whole[0] * c + math.e)
        want = c / max(1, t) * math.log(c / max(1, lc) * max(1, t) / max(1, lt)) / max(0.05, math.log(base))
        assert density[i] == pytest.approx(want)
        assert sums[i] == pytest.approx(sum(density[j] for j in below(i)))
        seen += 1
    assert seen >= 8


def test_query_rows(spark, tables):
    body = paragraphs(4, 3)
    article = page("<article>" + "".join(f"<p>{p}</p>" for p in body) + "</article>", AROUND["menu"], AROUND["footer"])
    rows = [(1, "u", article), (1, "u", article), (2, None, None), (None, "v", ""), (3, "w", "<p>ünï 😀</p>"), (4, "", "x" * 300_000)]
    wide = SCHEMA + ", text int, n_chars string, Text2 string"
    got = op12_main_text(spark, tables(pages=([(*r, 1, "n", "t") for r in rows], wide))).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(
        repr((i, u, t, len(t))) for i, u, t in ((r[0], r[1], H.main_text(r[2])) for r in rows)
    )
    assert [r["text"] for r in got if r["page_id"] == 1] == ["\n".join(body)] * 2
    assert op12_main_text(spark, tables(pages=([], SCHEMA))).collect() == []

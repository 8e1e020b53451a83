"""Main text of web pages by composite text density.

A page becomes a tree of its elements with their own text. Menus, forms, notices and the like are cut out of
the tree by what the page calls them. For each node that is left, the density is its characters per tag,
adjusted by its link characters and link tags; the sum of a node's child densities tells containers of text
from single paragraphs. The node of the largest sum is the seed. The smallest density on the path from it to
just below the body is the threshold: in each subtree that reaches it the node of the largest sum is content, too. An
`article` or `main` around the seed states the article's extent and is taken whole.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohorta.llm.common import schema_with, without

RESULT = "text string, n_chars bigint"

# Elements of HTML by how their text is treated.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr",
    "img", "picture", "source", "br",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: elements that are never text of an article
NO_TEXT = {
    "head", "script", "style", "template", "noscript", "iframe", "object", "svg", "math", "canvas", "audio", "video", "map",
    "nav", "aside", "footer", "form", "button", "select", "textarea", "fieldset", "input", "dialog", "menu", "title", "noembed", "noframes",
}
NO_TEXT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "toolbar", "alert", "alertdialog", "dialog"}
#: words of a class or id that name parts around the article
AROUND = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "advertising", "adsense", "banner", "sponsor", "sponsored",
    "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "notifications", "alert", "popup",
    "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "sidebar", "aside", "menu", "nav", "navbar", "navigation",
    "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "toolbar", "share", "sharing", "social", "related", "recommended",
    "widget", "pagination", "pager", "login", "search", "skip", "copyright", "disclaimer",
}
COMMENTS = {"comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "discussion"}
#: start tags that end an open element of the second set, up to a scope element
CLOSERS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
KEEPS_P = INLINE | VOID - {"hr"} | {"script", "style", "textarea", "select", "option", "button", "iframe", "noscript", "svg", "math"}
#: a paragraph's open tag ends only within these
SCOPES = {"table", "td", "th", "caption", "button", "object", "template", "html"}

LEAST_LOG = 0.05  # of the base of the adjustment, which is 1 on a page without links

TAG = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z/!?][^<]*\Z", re.S
)
LOOSE = re.compile(r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>[^>]*)>", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I | re.S)
WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


class Tree:
    """Elements of a page in page order, and the pieces of text with the element each lies in."""

    def __init__(self) -> None:
        self.tag = ["html"]
        self.parent = [-1]
        self.attributes = [""]
        self.text: list[tuple[int, str]] = []
        self.open = [0]
        self.held: Counter[str] = Counter()  # open elements by name: most questions end here
        self.body = False

    def start(self, name: str, attributes: str) -> None:
        if name == "html" or (name == "body" and self.body):
            return  # one of each; a second body's content belongs to the first
        self.body |= name == "body"
        if name == "body" or (name not in ("head", "meta", "link", "base", "title", "script", "style") and self.tag[self.open[-1]] == "head"):
            self._end_to(0)  # the head ends where content begins
        if name not in KEEPS_P and (at := self._within({"p"}, SCOPES)) is not None:
            self._end_to(at)
        if name in HEADINGS and self.tag[self.open[-1]] in HEADINGS:
            self._end_to(len(self.open) - 1)
        if name in CLOSERS:
            ends, scope = CLOSERS[name]
            while (at := self._within(ends, scope)) is not None:
                self._end_to(at)
        self.tag.append(name)
        self.parent.append(self.open[-1])
        self.attributes.append(attributes)
        if name not in VOID and not (attributes.endswith("/") and (name in ("svg", "math") or self.held["svg"] + self.held["math"])):
            self.open.append(len(self.tag) - 1)
            self.held[name] += 1

    def _within(self, names: set[str], scope: set[str]) -> int | None:
        """Depth of the innermost open element of these names, none beyond a scope element."""
        if not any(self.held[name] for name in names):
            return None
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[depth]]
            if tag in names:
                return depth
            if tag in scope:
                return None
        return None

    def _end_to(self, depth: int) -> None:
        """Close the open elements from this depth on; the outermost stays."""
        for i in self.open[max(1, depth) :]:
            self.held[self.tag[i]] -= 1
        del self.open[max(1, depth) :]

    def end(self, name: str) -> None:
        if name in ("html", "body"):
            return  # what follows still belongs to the body
        if name == "br":
            self.start("br", "")
            return
        if name in INLINE:  # a block that began inside it goes on
            at = self._within({name}, SCOPES)
            if at is not None and all(self.tag[i] in INLINE for i in self.open[at:]):
                self._end_to(at)
            return
        cells = {"td", "th"} if name in ("tr", "tbody", "thead", "tfoot", "table") else set()
        scope = set() if name == "table" else {"table", "td", "th"} - {name} - cells
        at = self._within(HEADINGS if name in HEADINGS else {name}, scope)
        if at is not None:
            self._end_to(at)

    def add(self, piece: str) -> None:
        if piece:
            if self.tag[self.open[-1]] == "head":
                if not piece.strip():
                    return
                self._end_to(0)
            self.text.append((len(self.tag), piece))
            self.tag.append("#text")
            self.parent.append(self.open[-1])
            self.attributes.append("")


def parse(page: str) -> Tree:
    """Tree of a page that may leave out, forget or misplace tags; anything that is no tag is text."""
    tree = Tree()
    at, low = 0, None
    while at < len(page):
        tag = page.find("<", at)
        if tag < 0:
            tree.add(html.unescape(page[at:]))
            break
        found = TAG.match(page, tag) or LOOSE.match(page, tag)
        if found is None:  # a bare <
            stop = page.find("<", tag + 1)
            stop = len(page) if stop < 0 else stop
            tree.add(html.unescape(page[at:stop]))
            at = stop
            continue
        tree.add(html.unescape(page[at:tag]))
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        name = name.lower()
        if found["end"]:
            tree.end(name)
            continue
        tree.start(name, found["rest"])
        if name in RAW:  # text up to its own end tag
            low = page.lower() if low is None else low
            stop = _end_of(low if len(low) == len(page) else page, name, at)
            at = stop
        elif name == "plaintext":
            tree.add(page[at:])
            break
    return tree


def _end_of(page: str, name: str, at: int) -> int:
    """Where the end tag of a raw element begins, or the page's end."""
    while (at := page.find(f"</{name}", at)) >= 0:
        after = page[at + 2 + len(name) : at + 3 + len(name)]
        if after in ("", ">", "/") or after.isspace():
            return at
        at += 1
    return len(page)


def _names(attributes: str) -> tuple[set[str], str]:
    """Words of class and id, and the role."""
    words, role = set(), ""
    for key, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        if key.lower() == "role":
            role = value.strip().lower()
        else:
            words |= {w.lower() for w in WORDS.findall(value)}
    return words, role


def around(tree: Tree) -> np.ndarray:
    """Which nodes lie in parts that are not the article, by element, role, class and id."""
    n = len(tree.tag)
    parent = tree.parent
    # what the article's own elements lie in is not cut out for a class name
    holds = [False] * n
    for i in range(n - 1, 0, -1):
        if tree.tag[i] in ("article", "main", "h1") or holds[i]:
            holds[parent[i]] = True
    inside = [False] * n  # an article or main
    above = [""] * n  # "header" below a header, up to its headings
    cut = np.zeros(n, bool)
    for i in range(1, n):
        tag, up = tree.tag[i], parent[i]
        inside[i] = inside[up] or tag in ("article", "main")
        if cut[up]:
            cut[i] = True
            continue
        above[i] = "" if tag in HEADINGS else "header" if tag == "header" else above[up]
        if tag == "#text":
            cut[i] = above[i] == "header"  # of an article's own header only the headings are text
            continue
        if tag in NO_TEXT or (tag == "header" and not inside[i]):
            cut[i] = True
        if cut[i] or not tree.attributes[i]:
            continue
        words, role = _names(tree.attributes[i])
        if role in NO_TEXT_ROLES or words & COMMENTS:
            cut[i] = tag not in ("body", "html", "main")
        elif words & AROUND or (words & {"header", "top"} and not inside[i]):
            cut[i] = not (holds[i] or tag in ("body", "html", "article", "main", *HEADINGS))
    return cut


def densities(tree: Tree, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Composite text density of every node, the sum over its children, and the body's number."""
    n = len(tree.tag)
    chars, tags, link_chars, link_tags = (np.zeros(n) for _ in range(4))
    for i, piece in tree.text:
        if not cut[i]:
            chars[i] = len("".join(piece.split()))
    for i in range(n - 1, -1, -1):
        up = tree.parent[i]
        if tree.tag[i] == "a":
            link_chars[i], link_tags[i] = chars[i], link_tags[i] + 1
        if up >= 0 and not cut[i]:
            chars[up] += chars[i]
            tags[up] += tags[i] + (tree.tag[i] != "#text")
            link_chars[up] += link_chars[i]
            link_tags[up] += link_tags[i]
    body = next((i for i, t in enumerate(tree.tag) if t == "body"), 0)
    share = link_chars[body] / max(1.0, chars[body])
    density = np.zeros(n)
    for i in range(n):
        c, lc = chars[i], link_chars[i]
        if cut[i] or not c or tree.tag[i] == "#text":
            continue
        base = math.log(c / max(1.0, c - lc) * lc + share * c + math.e)
        links = c / max(1.0, lc) * max(1.0, tags[i]) / max(1.0, link_tags[i])
        density[i] = c / max(1.0, tags[i]) * math.log(max(1.0, links)) / max(LEAST_LOG, math.log(base))
    sums = np.zeros(n)
    for i in range(1, n):
        sums[tree.parent[i]] += density[i]
    return density, sums, body


def content(tree: Tree, cut: np.ndarray) -> np.ndarray:
    """Which nodes are the article's."""
    n = len(tree.tag)
    density, sums, body = densities(tree, cut)
    best, top = np.arange(n), sums.copy()  # the node of the largest sum in each subtree; the first one, of equals
    for i in range(n - 1, 0, -1):
        up = tree.parent[i]
        if not cut[i] and (top[i] > top[up] or (top[i] == top[up] and best[up] != up and top[i] > 0)):
            top[up], best[up] = top[i], best[i]
    seed = int(best[body])
    threshold, at, stated = density[seed], seed, None
    while at >= 0:
        if tree.tag[at] in ("article", "main"):
            stated = at
        at = tree.parent[at]
        if at < 0 or at == body:
            break
        threshold = min(threshold, density[at])
    chosen = np.zeros(n, bool)
    if stated is not None:
        chosen[stated] = True
    else:
        chosen[seed] = True
        for i in range(n):
            if density[i] >= threshold and density[i] > 0 and not cut[i] and i != body:
                # a node without children of its own density is content itself
                chosen[best[i] if top[i] > 0 else i] = True
    for i in range(1, n):
        chosen[i] |= chosen[tree.parent[i]]
    return chosen & ~cut


def main_text(page: str | None) -> str:
    """The article's blocks, one a line, each with its white space as single spaces."""
    if not page:
        return ""
    tree = parse(page)
    cut = around(tree)
    chosen = content(tree, cut)
    # the innermost block element around each node; text of one block is joined
    block = list(range(len(tree.tag)))
    for i in range(1, len(tree.tag)):
        if tree.tag[i] in INLINE or tree.tag[i] == "#text":
            block[i] = block[tree.parent[i]]
    lines: list[str] = []
    pieces: list[str] = []
    last = -1

    def flush() -> None:
        line = " ".join("".join(pieces).split())
        if line:
            lines.append(line)
        pieces.clear()

    text = dict(tree.text)
    for i in range(1, len(tree.tag)):
        if not chosen[i]:
            continue
        if tree.tag[i] == "br":
            pieces.append(" ")
        elif i in text:
            if block[i] != last:
                flush()
                last = block[i]
            pieces.append(text[i])
        elif block[i] == i:  # a block begins: what comes after it in the outer block is a new line
            flush()
            last = i
    flush()
    return "\n".join(lines)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The rows with `text`, the main text of the whole page, and `n_chars`, its code points.

    Null, empty and blank pages and those without any text of their own have an empty text; a page without tags is its own
    text; equal pages have equal texts. White space is what Python's `str.split` takes for it. `br` is white space. Elements that
    are never closed end where HTML ends them. Columns of the result's names that the frame has already are replaced.
    Nothing is sent between tasks.
    """
    names = ("text", "n_chars")
    pages = without(pages, names, html_col)
    inner = pages.withColumnRenamed(html_col, "_html") if html_col in names else pages
    column = "_html" if html_col in names else html_col

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([main_text(page.as_py()) for page in batch.column(column)], pa.string())
            length = pa.array([len(t.as_py()) for t in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found, length], [*batch.schema.names, *names])

    return inner.mapInArrow(run, schema_with(inner, RESULT))

"""Main text of web pages: flat text blocks, features of each block and its neighbours, and a decision tree.

A page is cut into blocks at the borders of block-level elements.  Each block has its number of words and its link
density, and those of the blocks before and after.  Beside these, its kind: a heading or not, and what the page itself
marks as content or as set aside, where it does.  The tree is trained on the small labelled table below, half of whose
pages mark nothing, so that there the words and links of a block and its neighbours decide.
"""

from __future__ import annotations

import html as _html
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.bytesops import map_batches, slices

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(?:!|\?)[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|<", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
#: A private-use character that stands for a mark within training pages.
_MARK = "\ue000"
_SPACE = re.compile(r"\s+")
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "option", "button", "head", "object"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
_AWAY = {"nav", "aside", "footer", "form", "dialog", "menu"}
_CONTENT = {"article", "main"}
_AWAY_NAMES = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side|menu|nav\w*|breadcrumbs?|footer|foot|header|masthead|cookies?|consent|notice|popup|modal|newsletter|subscribe|share|social|related|recommend\w*|comments?|respond|replies|disqus|pagination|pager|widget|toolbar|login|search|tags?|legal|copyright)(?:$|[\s_-])", re.I)
_CONTENT_NAMES = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|main|content|body|text)(?:$|[\s_-])", re.I)
_STATE_NAMES = re.compile(r"(?:has|is|with|without|no)[_-]", re.I)
_HEADER = re.compile(r"(?<![^_-])header(?![^_-])", re.I)

FEATURES = ("words", "links", "away", "inside", "words_before", "links_before", "words_after", "links_after", "heading", "content")


def _away_name(given: str) -> bool:
    """Whether a class, id or role word sets an element away; part of a name counts less than all of it.

    Parts do not count in names of states (has-sidebar) and beside a whole name of content (post tag-news), nor does
    the header of a content name (entry-header).
    """
    names = given.split()
    content = any(_CONTENT_NAMES.fullmatch(n) for n in names)
    for n in names:
        if _AWAY_NAMES.fullmatch(n):
            return True
        own = _HEADER.sub("", n) if _CONTENT_NAMES.search(n) else n
        if not content and not _STATE_NAMES.match(n) and _AWAY_NAMES.search(own):
            return True
    return False


def blocks(page: str) -> list[tuple[str, list[float]]]:
    """The page's text blocks in order, each with its FEATURES.

    Unclosed elements end with an element around them or with the page; comments, raw elements and what has no end
    are left out up to the page's end; `<` that begins no tag is text.
    """
    found: list[list] = []
    text: list[str] = []
    chars = linked = 0
    stack: list[tuple[str, int]] = []  # open elements other than inline ones: name, and 1 (content), -1 (away) or 0
    away = inside = anchors = heads = 0

    def close() -> None:
        nonlocal text, chars, linked
        if text:
            t = _SPACE.sub(" ", _html.unescape("".join(text))).strip()
            if t:
                n = t.count(" ") + 1
                found.append([t, float(n), min(1.0, linked / max(1, chars)), float(away > 0), float(inside > 0), float(heads > 0)])
        text, chars, linked = [], 0, 0

    def add(s: str) -> None:
        nonlocal chars, linked
        if s:
            text.append(s)
            n = len(s) - s.count(" ")
            chars += n
            linked += n if anchors else 0

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            if m.group() == "<":
                add("<")
            continue
        name = name.lower()
        if not m.group(1) and name in _RAW and not m.group(3).endswith("/"):
            if name != "button":
                close() if name not in ("noscript", "svg", "template") else None
            if name == "head":
                continue
            shut = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = shut.end() if shut else end
            continue
        if name in _INLINE:
            if name == "a":
                anchors = 0 if m.group(1) else 1
            continue
        close()
        anchors = 0
        if name == "br" or name in _VOID:
            continue
        if m.group(1):
            names = [x[0] for x in stack]
            if name in names:
                while True:
                    popped, kind = stack.pop()
                    away -= kind < 0
                    inside -= kind > 0
                    heads -= popped in ("h1", "h2", "h3", "h4", "h5", "h6")
                    if popped == name:
                        break
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == name:
            popped, kind = stack.pop()
            away -= kind < 0
            inside -= kind > 0
        kind = -1 if name in _AWAY or (name == "header" and not inside) else 1 if name in _CONTENT else 0
        if m.group(3):
            given = " ".join("".join(x) for x in _NAMES.findall(m.group(3)))
            if given and kind >= 0 and name not in ("html", "body"):
                kind = -1 if name not in _CONTENT and _away_name(given) else 1 if kind or _CONTENT_NAMES.search(given) else 0
        stack.append((name, kind))
        away += kind < 0
        inside += kind > 0
        heads += name in ("h1", "h2", "h3", "h4", "h5", "h6")
    close()
    none = [None, 0.0, 0.0]
    content = float(any(b[4] and not b[3] for b in found))
    out = []
    for i, b in enumerate(found):
        p, n = found[i - 1] if i else none, found[i + 1] if i + 1 < len(found) else none
        out.append((b[0], [b[1], b[2], b[3], b[4], p[1], p[2], n[1], n[2], b[5], content]))
    return out


def _w(n: int) -> str:
    return " ".join(["word"] * (n - 1) + ["end."])


def _labelled_pages() -> list[str]:
    """Small pages, written for training, whose main text is in <m> marks."""
    link = lambda n, k: " ".join(f"<a href=x>{_w(k)}</a>" for _ in range(n))
    para = "<p><m>{}</m></p>"
    body = "".join(para.format(_w(n)) for n in (40, 3, 12, 80, 1, 25))
    sizes = (1, 2, 3, 5, 9, 14, 30, 70)
    varied = [f"<div>{_w(b)}</div><div>{_w(a)}</div><article><h2><m>{_w(b)}</m></h2><p><m>{_w(b)}</m></p><p><m>{link(1, a)}</m></p><p><m>{_w(b)}</m></p></article><div>{_w(a)}</div><div>{_w(b)}</div>" for a in sizes for b in sizes]
    varied += [f"<div class=ad>{_w(a)}</div><div><p><m>{_w(b + 20)}</m></p><p><m>{_w(b + 12)}</m></p></div><footer>{_w(a)}</footer>" for a in sizes for b in sizes]
    varied += [f"<aside>{_w(b)}</aside><article><p><m>{_w(a)}</m></p><div class=notice>{_w(b)}</div></article>" for a in sizes for b in sizes]
    return varied + [
        f"<nav><ul><li><a>one</a></li><li><a>two three</a></li></ul></nav><article><h1><m>{_w(6)}</m></h1>{body}</article><footer>{_w(7)}</footer>",
        f"<div class=ad>{_w(9)}</div><article><h1><m>{_w(8)}</m></h1><p><b><m>{_w(11)}</m><br><p><m>{_w(60)}</m></p></article><footer>{_w(9)} {link(1, 2)}</footer>",
        f"<header><h1>{_w(2)}</h1>{link(4, 1)}</header><main>{body}<div class=comments><p>{_w(30)}</p><p>{_w(12)}</p></div></main><aside>{link(5, 4)}<p>{_w(20)}</p></aside>",
        f"<div id=menu>{link(6, 2)}</div><div id=content><h2><m>{_w(4)}</m></h2>{body}<p><m>{_w(15)} {link(1, 3)} {_w(10)}</m></p></div><div id=sidebar><p>{_w(35)}</p></div>",
        f"<div>{link(7, 1)}</div><div><p><m>{_w(50)}</m></p><p><m>{_w(30)}</m></p><p><m>{_w(45)}</m></p></div><div>{link(3, 2)}</div>",
        f"<p>{link(5, 2)}</p><h1><m>{_w(7)}</m></h1><p><m>{_w(33)}</m></p><p><m>{_w(28)}</m></p><p>{link(4, 5)}</p><div class='cookie notice'>{_w(25)}</div>",
        f"<article><div class=share>{link(3, 1)}</div><p><m>{_w(2)}</m></p><p><m>{_w(22)}</m></p><form><p>{_w(14)}</p></form><section id=comments><p>{_w(40)}</p></section></article>",
        f"<article><h1><m>{_w(5)}</m></h1><ul><li><m>{_w(4)}</m></li><li><m>{_w(9)}</m></li></ul><p><m>{link(1, 3)}</m></p></article><div>{_w(5)}</div>",
        f"<article><p><m>{_w(1)}</m></p></article><div class=banner>{_w(15)}</div><div class=related>{link(5, 6)}</div><footer><p>{_w(30)}</p></footer>",
        f"<nav>{link(4, 1)}</nav><article><h1><m>{_w(3)}</m></h1>{body}</article>",
        f"<div>{link(4, 1)}</div><div><h1><m>{_w(3)}</m></h1>{body}<p><m>{_w(9)}</m></p></div>",
        f"<article><p><m>{_w(18)}</m></p><p><m>{_w(2)}</m></p></article>",
        f"<p><m>{_w(40)}</m></p><p><m>{_w(21)}</m></p>",
        f"<article class='post tag-news social'><div class='entry-header'><h1><m>{_w(6)}</m></h1></div>{body}</article><div class='site-footer'>{_w(9)}</div>",
        f"<main class='has-sidebar'><h1><m>{_w(4)}</m></h1>{body}</main><div class=sidebar><p>{_w(20)}</p></div>",
        f"<article><p><m>{_w(30)}</m></p><blockquote><m>{_w(12)}</m></blockquote></article><div>{_w(4)}</div>",
        f"<div>{_w(3)}</div><article><p><m>{_w(30)}</m></p><p><m>{link(1, 2)} {_w(2)}</m></p></article><p>{link(1, 2)}</p>",
    ]


def plain_page(seed: int) -> str:
    """A page of plain elements without a telling name: links, perhaps a notice, a story in <m> marks, links, a last line."""
    r = random.Random(seed)
    link = lambda a, b: f"<a href=x>{_w(r.randint(a, b))}</a>"
    menu = [link(1, 3) for _ in range(r.randint(3, 9))]
    parts = ["<ul>" + "".join(f"<li>{x}</li>" for x in menu) + "</ul>" if r.random() < 0.6 else f"<div>{' '.join(menu)}</div>"]
    if r.random() < 0.5:
        parts.append(f"<div>{_w(r.randint(4, 16))}</div>")
    if r.random() < 0.8:
        parts.append(f"<h{r.randint(1, 2)}><m>{_w(r.randint(3, 12))}</m></h1>")
    for _ in range(r.randint(3, 10)):
        n = r.randint(2, 9) if r.random() < 0.15 else r.randint(18, 110)
        parts.append(f"<p><m>{_w(n)}{' ' + link(1, 3) + ' ' + _w(r.randint(6, 20)) if n > 17 and r.random() < 0.2 else ''}</m></p>")
        if r.random() < 0.08:
            parts.append(f"<h3><m>{_w(r.randint(2, 8))}</m></h3>")
    if r.random() < 0.6:
        parts.append("<ul>" + "".join(f"<li>{link(3, 9)}</li>" for _ in range(r.randint(3, 6))) + "</ul>")
    parts.append(f"<div>{_w(r.randint(3, 12))} {' '.join(link(1, 2) for _ in range(r.randint(1, 4)))}</div>")
    return "".join(parts)


def labelled(pages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every block of the pages, and whether it lies in <m> marks."""
    x, y = [], []
    for page in pages:
        plain, marked = (blocks(page.replace("<m>", m).replace("</m>", "")) for m in ("", _MARK))
        x += [f for _, f in plain]
        y += [float(_MARK in text) for text, _ in marked]
    return np.array(x), np.array(y)


def training_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of every block of the pages written for training, and of as many that mark nothing."""
    pages = _labelled_pages()
    return labelled([*pages, *[plain_page(k) for k in range(len(pages))]])


class Tree:
    """A binary decision tree by Gini impurity; ties go to the earlier feature and lower threshold."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 1):
        self.feature, self.edge, self.low, self.high, self.value = [], [], [], [], []
        self._grow(x, y, depth, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        at = len(self.value)
        for part in (self.feature, self.low, self.high):
            part.append(-1)
        self.edge.append(0.0)
        self.value.append(float(y.mean()) if len(y) else 0.0)
        if depth == 0 or len(y) < 2 * least or y.min() == y.max():
            return at
        best = None
        gini = lambda v: 2 * v.mean() * (1 - v.mean()) * len(v)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for edge in (values[:-1] + values[1:]) / 2:
                left = x[:, f] <= edge
                if min(left.sum(), (~left).sum()) >= least:
                    cost = gini(y[left]) + gini(y[~left])
                    if best is None or cost < best[0] - 1e-12:
                        best = (cost, f, float(edge))
        if best is None or best[0] >= gini(y) - 1e-12:
            return at
        left = x[:, best[1]] <= best[2]
        self.feature[at], self.edge[at] = best[1], best[2]
        self.low[at] = self._grow(x[left], y[left], depth - 1, least)
        self.high[at] = self._grow(x[~left], y[~left], depth - 1, least)
        return at

    def predict(self, row: list[float]) -> float:
        at = 0
        while self.feature[at] >= 0:
            at = self.low[at] if row[self.feature[at]] <= self.edge[at] else self.high[at]
        return self.value[at]


@lru_cache
def default_tree() -> Tree:
    return Tree(*training_table())


def main_text(page: str | None, tree: Tree | None = None) -> str:
    """Blocks that the tree takes for main text, joined by line ends."""
    if not page:
        return ""
    tree = tree or default_tree()
    return "\n".join(t for t, f in blocks(page) if tree.predict(f) > 0.5)


def extract(df: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html", tree: Tree | None = None) -> DataFrame:
    """Return the kept columns with text and n_chars (code points) of every page.

    Nulls: null html gives the empty text, as does a page without main text; kept columns may be null.  Pages are read
    whole, however long; repeated rows give equal rows; empty tables give empty tables; other columns are ignored,
    whatever their names.
    """
    tree = tree or default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_html"):
                texts = [main_text(p, tree) for p in part.column("_html").to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [*keep, "text", "n_chars"])

    schema = ", ".join(f"`{c}` {k}" for c, k in df.select(*keep).dtypes)
    return map_batches(df.select(*keep, F.col(html_col).alias("_html")), run, f"{schema}, text string, n_chars long")

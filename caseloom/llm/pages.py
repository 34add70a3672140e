"""Main text of web pages by a tree-structured graphical model.

The block elements of a page form a tree; each is content or not. A node's
potential comes from its tag and those around it, the words in its class, id and
role, its share of link text, length and punctuation; an edge's potential from the states of parent and
child, for sectioning children apart from the others. Sum-product messages go up and down the tree
and give exact marginals; text under nodes whose marginal of content is above one
half is the page's main text. The weights are learned by gradient ascent on the
likelihood of labelled pages, whose gradient is observed minus expected features,
the latter from the same messages. No table has such labels, so the pages are
written here from templates with every kind of part labelled (``labelled_pages``).

Inline elements belong to the block around them. Scripts, styles, titles, templates,
controls and comments never become text; a head has nothing else, and ends without
its tag at the first text or element of the body. Formulas, drawings and what stands
in players and canvases for want of them are text like any other. End tags that HTML
lets authors omit are supplied; a control without an end tag loses its start tag
alone, and so does a tag without its ``>``, which ends where the next tag begins.
Quotes inside unquoted values are plain characters. Character references are
decoded, white space in a block becomes one space, blocks are joined in page order
by one space; a page cut off in a tag loses that tag alone.

Defined results: null or empty html gives an empty text of 0 characters; repeated
rows and ids each give a row; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

# Elements by their role in HTML, MathML and SVG.
MATH = set("math annotation menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
DRAWN = set("svg circle clippath defs desc ellipse filter foreignobject g line lineargradient marker mask path pattern polygon polyline radialgradient rect stop symbol text textpath tspan use".split())
INLINE = MATH | DRAWN | set("a abbr acronym audio b bdi bdo big canvas cite code data del dfn em font i ins kbd label map mark object picture q rp rt ruby s samp small span strike strong sub sup time tt u var video wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup: it runs to the end tag, or to the end of the page.
RAW = "script|style|iframe|noframes|noembed|xmp|textarea|title"
#: Dropped with all that they hold; without an end tag only the start tag goes.
DROPPED = "noscript|template|select|button"
#: An end tag does not reach past the cell or table that it stands in.
CELLS = set("td th caption table".split())
TABLE = CELLS | set("tr tbody thead tfoot".split())
SECTIONS = set("nav header footer aside form section article main div ul ol table dl figure".split())
KINDS = "html body article main section div p heading list item nav header footer aside form table quote other".split()
AROUND = frozenset("article main nav header footer aside form".split())
WORDS = {
    "advert": r"\bads?\b|advert|sponsor|promo|banner|\bad[-_]|[-_]ad\b",
    "menu": r"\bnav|menu|breadcrumb|pagination|toolbar|topbar|tabs\b",
    "footer": r"foot|copyright|legal|imprint",
    "header": r"header|masthead|\btop\b|logo|branding",
    "side": r"side|aside|related|widget|recommend|trending|popular|\brail\b|tag-?list",
    "comment": r"comment|reply|replies|discuss|disqus|respond|review",
    "notice": r"cookie|consent|notice|gdpr|newsletter|subscri|popup|modal|alert|overlay|paywall|sign-?up|login|share|social",
    "content": r"content|article|post\b|entry|story|\bmain\b|body|text|prose",
    "hidden": r"display:\s*none|visibility:\s*hidden|\bhidden\b",
}
_WORDS = [(k, re.compile(v, re.I)) for k, v in WORDS.items()]
# Attributes by HTML's rules: a name, and a value in quotes or up to the next blank. Groups are atomic, so that no page is read twice.
_ATTRS = r"""(?>(?:\s+|/|[^\s/><=][^\s/><=]*+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'><][^\s><]*+))?|=)*)"""
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<({RAW})(?=[\s>/]){_ATTRS}>.*?(?:</\1(?=[\s>/])[^>]*(?:>|\Z)|\Z)"
    rf"|<({DROPPED})(?=[\s>/]){_ATTRS}>.*?</\2\s*>"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)({_ATTRS})(?:>|(?=<)|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"""([^\s/><=][^\s/><=]*+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'><][^\s><]*+))?""")
_NAMING = re.compile(r"\b(?:class|id|role|style|hidden)\b", re.I)
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CLOSES |= {x: {"tr", "td", "th", "tbody", "thead", "tfoot", "caption", "colgroup"} for x in ("tbody", "thead", "tfoot")} | {f"h{i}": {f"h{j}" for j in range(1, 7)} for i in range(1, 7)}


def kind(tag: str) -> str:
    if tag in KINDS:
        return tag
    if re.fullmatch(r"h[1-6]|hgroup", tag):
        return "heading"
    return {"ul": "list", "ol": "list", "dl": "list", "li": "item", "dt": "item", "dd": "item", "blockquote": "quote", "pre": "quote"}.get(tag, "table" if tag in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "caption") else "other")


def _marks(attributes: str) -> str:
    """What an element's attributes say about its part of the page."""
    found = {}
    for name, value in _ATTR.findall(attributes):
        found.setdefault(name.lower(), value.strip("\"'"))
    return " ".join([*(found[k] for k in ("class", "id", "role", "style") if k in found), *(["hidden"] if "hidden" in found else [])])


class Page:
    """Block elements in page order, parents first, and the text runs with their owners."""

    def __init__(self, source: str):
        self.tags, self.marks, self.parent, self.linked = ["html"], [""], [-1], [0]
        self.runs: list[tuple[int, str]] = []
        stack, links, held = [0], 0, []

        def flush() -> None:
            nonlocal held
            if held:
                text = " ".join(html_lib.unescape("".join(held)).split())
                if text:
                    self.runs.append((stack[-1], text))
                held = []

        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                held.append(text := source[at : m.start()])
                if links:
                    self.linked[stack[-1]] += len(text)
            at = m.end()
            name = m[4]
            if name is None:
                continue
            name = name.lower()
            if name in INLINE:
                if name == "a":
                    links = 0 if m[3] else 1
                continue
            if name in VOID:
                held.append(" ")
                continue
            flush()
            links = 0
            if m[3]:
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[depth]] == name:
                        del stack[depth:]
                        break
                    if self.tags[stack[depth]] in CELLS and name not in TABLE:
                        break
                continue
            if name == "head":
                continue
            if name in ("html", "body") and any(self.tags[i] == name for i in stack):
                continue
            if self.tags[stack[-1]] == "p" and len(stack) > 1:
                stack.pop()
            closes = _CLOSES.get(name)
            while closes and len(stack) > 1 and self.tags[stack[-1]] in closes:
                stack.pop()
            self.tags.append(name)
            self.marks.append(_marks(m[5]) if _NAMING.search(m[5]) else "")
            self.parent.append(stack[-1])
            self.linked.append(0)
            stack.append(len(self.tags) - 1)
        if at < len(source):
            held.append(source[at:])
        flush()

    def features(self) -> list[list[str]]:
        """Per node the names of its features."""
        n = len(self.tags)
        size, links, stops, sign = [0] * n, list(self.linked), [0] * n, [0] * n
        for i, text in self.runs:
            size[i] += len(text)
            stops[i] += text.count(". ") + text.count(", ") + (text[-1] in ".!?\"")
            sign[i] += "©" in text
        own = list(size)
        named = [[k for k, p in _WORDS if p.search(mark)] if mark else [] for mark in self.marks]
        inside: list[frozenset[str]] = [frozenset()]
        for i in range(1, n):
            p = self.parent[i]
            new = {*named[p], *AROUND.intersection((kind(self.tags[p]),))} if p else set()
            inside.append(inside[p] | new if new else inside[p])

        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            size[p] += size[i]
            links[p] += links[i]
            stops[p] += stops[i]
        out = []
        for i in range(n):
            f = ["any", "tag:" + kind(self.tags[i])]
            f += ["word:" + k for k in named[i]]
            share = links[i] / size[i] if size[i] else 0
            f.append(f"links:{min(3, int(share * 4))}")
            f.append(f"size:{min(5, int(math.log(size[i] + 1, 6)))}")
            f.append(f"stops:{min(3, int(math.log2(stops[i] + 1)))}")
            if own[i]:
                f.append("own")
            if sign[i]:
                f.append("sign")
                f += ["in:" + a for a in sorted(inside[i])]
            f += ["in:" + a for a in sorted(inside[i])]
            out.append(f)
        return out


def edge(tag: str) -> str:
    return "section" if tag in SECTIONS else "leaf"


def marginals(page: Page, weights: dict, feats: list[list[str]] | None = None, pairs: bool = False):
    """Probability of content per node; with ``pairs`` also of (parent, child) states per edge."""
    feats = feats or page.features()
    n, get = len(feats), weights.get
    local = [math.exp(max(-30.0, min(30.0, sum([get(f, 0.0) for f in fs])))) for fs in feats]  # odds of content
    table_ = {e: [[math.exp(get(f"{e}:{a}{b}", 0.0)) for b in (0, 1)] for a in (0, 1)] for e in ("section", "leaf")}
    below = [[1.0, x] for x in local]
    up: list = [None] * n
    edges = [table_[edge(t)] for t in page.tags]
    for i in range(n - 1, 0, -1):  # to the root
        b0, b1 = below[i]
        t = edges[i]
        m0, m1 = t[0][0] * b0 + t[0][1] * b1, t[1][0] * b0 + t[1][1] * b1
        s = m0 + m1
        up[i] = (m0 / s, m1 / s)
        q = below[page.parent[i]]
        q[0] *= up[i][0]
        q[1] *= up[i][1]
        s = q[0] + q[1]
        q[0] /= s
        q[1] /= s
    belief: list = [None] * n
    joint: list = [None] * n
    s = below[0][0] + below[0][1]
    belief[0] = (below[0][0] / s, below[0][1] / s)
    for i in range(1, n):  # and back
        b, u, t, own = belief[page.parent[i]], up[i], edges[i], below[i]
        r0, r1 = b[0] / max(u[0], 1e-300), b[1] / max(u[1], 1e-300)
        j = (r0 * t[0][0] * own[0], r0 * t[0][1] * own[1], r1 * t[1][0] * own[0], r1 * t[1][1] * own[1])
        s = sum(j) or 1e-300
        joint[i] = tuple(x / s for x in j)
        belief[i] = (joint[i][0] + joint[i][2], joint[i][1] + joint[i][3])
    p = [b[1] for b in belief]
    return (p, joint) if pairs else p


def train(pages: list[str], rounds: int = 80, decay: float = 0.003) -> dict:
    """Weights from pages whose content elements carry the attribute data-y="1", others "0"; elements without one take their parent's."""
    seen = []
    for source in pages:
        page = Page(re.sub(r'\sdata-y="[01]"', "", source))
        seen.append((page, page.features(), _labels(source)))
    w: dict[str, float] = {}
    g2: dict[str, float] = {}
    for _ in range(rounds):
        grad: dict[str, float] = {}
        for page, feats, y in seen:
            p, joint = marginals(page, w, feats, True)
            for i, fs in enumerate(feats):
                d = y[i] - p[i]
                for f in fs:
                    grad[f] = grad.get(f, 0.0) + d
                if i:
                    e = edge(page.tags[i])
                    for k in range(4):
                        a, b = divmod(k, 2)
                        key = f"{e}:{a}{b}"
                        grad[key] = grad.get(key, 0.0) + ((y[page.parent[i]] == a and y[i] == b) - joint[i][k])
        for f, g in grad.items():
            g = g / len(seen) - decay * w.get(f, 0.0)
            g2[f] = g2.get(f, 0.0) + g * g
            w[f] = w.get(f, 0.0) + 0.5 * g / (math.sqrt(g2[f]) + 1e-8)
    return w


def _labels(source: str) -> list[int]:
    """States of a labelled page's nodes: data-y of the element, or its parent's."""
    page = Page(re.sub(r'data-y="([01])"', r'role="y\1"', source))
    y: list[int] = []
    for i, mark in enumerate(page.marks):
        own = re.search(r"\by([01])\b", mark)
        y.append(int(own[1]) if own else (y[page.parent[i]] if i else 1))
    return y


def labelled_pages(count: int = 240, seed: int = 5) -> list[str]:
    """Pages with every part labelled, from templates and made-up words."""
    r = random.Random(seed)
    letters = ["ka", "lo", "mi", "ren", "tas", "ul", "ver", "on", "sti", "pa", "que", "dor", "en", "is"]
    word = lambda: "".join(r.choice(letters) for _ in range(r.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))

    def said(a: int, b: int) -> str:
        if r.random() < 0.15:  # some authors write without marks, or the same word again and again
            return (word() + " ") * r.randint(5, 60) if r.random() < 0.4 else words(5, 40 * b)
        text = " ".join(words(3, 12).capitalize() + r.choice([".", ".", ",", "!", ""]) for _ in range(r.randint(a, b)))
        return f"{text} <b>{word()}</b> <a href='/x'>{word()}</a>" if r.random() < 0.3 else text

    def named(tag: str, names: list[str], inner: str, y: int, bare: float = 0.0) -> str:
        mark = "" if r.random() < bare else f' {r.choice(["class", "class", "id"])}="{r.choice(names)}"'
        return f'<{tag}{mark} data-y="{y}">{inner}</{tag}>'

    links = lambda: "<ul>" + "".join(f'<li><a href="/{word()}">{words(1, 2)}</a></li>' for _ in range(r.randint(2, 9))) + "</ul>"

    def article() -> str:
        parts = [f"<h1>{words(2, 10)}</h1>"]
        if r.random() < 0.12:  # many short lines
            parts += [f"<p>{words(1, 3)}</p>" for _ in range(r.randint(5, 60))]
        for _ in range(r.randint(1, 7)):
            x = r.random()
            parts.append(
                f"<p>{said(1, 6)}</p>" if x < 0.6 else f"<p><b>{said(1, 2)}<br><p>{said(1, 4)}</p>" if x < 0.68 else f"<h2>{words(1, 5)}</h2>" if x < 0.76
                else "<ul>" + "".join(f"<li>{said(1, 1)}</li>" for _ in range(r.randint(2, 5))) + "</ul>" if x < 0.82
                else f"<blockquote><p>{said(1, 3)}</p></blockquote>" if x < 0.87 else f"<table><tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr></table>" if x < 0.91
                else f"<pre>{words(3, 9)}</pre>" if x < 0.93 else f"<div>{said(1, 4)}</div>"
            )
            if r.random() < 0.15:  # a short block that is mostly links, as in sources and references
                block = r.choice(["div", "div", "p"])
                parts.append(f"<{block}>{words(1, 4)} <a href='/{word()}'>{words(1, 4)}</a> {words(1, 2) if r.random() < 0.5 else ''}</{block}>")
            if r.random() < 0.12:
                parts.append(advert())
        return "".join(parts)

    advert = lambda: named(r.choice(["div", "aside", "p", "div"]), ["ad", "ads", "advert", "ad-slot", "sponsored", "banner", "promo-box"], said(1, 2), 0)
    before = [
        lambda: named("nav", ["nav", "menu", "main-menu"], links(), 0, 0.6),
        lambda: named("header", ["header", "site-header", "masthead"], f"<div>{words(1, 3)}</div>" + (f"<nav>{links()}</nav>" if r.random() < 0.5 else ""), 0, 0.5),
        lambda: named("div", ["menu", "navbar", "topbar", "breadcrumbs", "header"], links() if r.random() < 0.7 else words(1, 4), 0),
        lambda: named(r.choice(["div", "section"]), ["cookie-notice", "consent", "notice", "alert", "popup"], f"<p>{said(1, 2)}</p>", 0),
        advert,
    ]
    after = [
        lambda: named("footer", ["footer", "site-footer"], f"&copy; {words(1, 2)} &middot; {said(1, 2)}", 0, 0.6),
        lambda: named("div", ["footer", "copyright", "legal"], f"<p>&copy; {said(1, 2)}</p>", 0),
        lambda: named("aside", ["sidebar", "related", "widget"], (f"<h3>{words(1, 3)}</h3>" if r.random() < 0.5 else "") + (links() if r.random() < 0.5 else f"<p>{said(1, 3)}</p>"), 0, 0.4),
        lambda: named("div", ["sidebar", "related", "widget", "recommended", "trending"], f"<h3>{words(1, 3)}</h3>" + (links() if r.random() < 0.6 else f"<p>{said(1, 3)}</p>"), 0),
        lambda: named(r.choice(["section", "div"]), ["comments", "comment-list", "replies", "discussion"], f"<h2>{words(1, 2)}</h2>" + "".join(f'<div class="comment"><p>{said(1, 4)}</p></div>' for _ in range(r.randint(1, 4))), 0),
        lambda: named("form", ["form", "newsletter", "search"], f"<label>{words(1, 4)}</label><input><p>{said(1, 1)}</p>", 0, 0.5),
        lambda: named("div", ["share", "social", "newsletter", "subscribe"], words(2, 6), 0),
        advert,
    ]
    out = []
    for _ in range(count):
        x = r.random()
        body = article()
        if x < 0.55:
            body = f'<article data-y="1">{body}{r.choice(after[4:])() if r.random() < 0.15 else ""}</article>'
        elif x < 0.75:
            body = f'<main data-y="1">{body}</main>'
        elif x < 0.92:
            body = named("div", ["content", "post", "article-body", "entry-content", "story", "main"], body, 1)
        else:
            body = f'<div data-y="1">{body}</div>'
        if r.random() < 0.2:
            body = f"<div>{body}</div>"
        page = "".join(r.choice(before)() for _ in range(r.randint(0, 4))) + body + "".join(r.choice(after)() for _ in range(r.randint(0, 4)))
        out.append(f"<html><body>{page}</body></html>")
    return out


_MODEL: dict = {}


def default_model() -> dict:
    """The model of the pages above, trained once per process."""
    if not _MODEL:
        _MODEL.update(train(labelled_pages()))
    return _MODEL


def main_text(source: str | None, model: dict) -> str:
    """The main text of one page."""
    if not source:
        return ""
    page = Page(source)
    p = marginals(page, model)
    return " ".join(t for i, t in page.runs if p[i] > 0.5)


def _extractor(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            texts = [main_text(h, model) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extracted(pages: DataFrame, model: dict | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return src.mapInArrow(_extractor(model or default_model()), "page_id long, url string, text string, n_chars long")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages."""
    return extracted(table(spark, sf_dir, "pages"))

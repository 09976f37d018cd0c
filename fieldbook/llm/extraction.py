"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text nodes, each under a root-to-leaf tag path.  Per path,
text length and punctuation are summed over its nodes and set against the number of nodes;
both ratios are smoothed along the page, fused, and compared with a threshold drawn from
the page itself.  Two signals are fused into the ratio: a path inside article or main gains,
a path with an element whose class, id or role names what is no article text (sidebars,
notices, adverts) loses.  Neither decides alone: text outside a marked article and
text in a named element is content if its ratio says so.  Elements whose tag itself is
that of a menu, header, footer, aside or form never become nodes, nor do readers' comments,
however long they are: an element named so is only passed over as layout if it is all that
stands between the page and its articles.

Paths are numbers in a trie of elements, and what lies in an element is added up along its
parents, so time and memory follow the page's length at any depth.

Defined results: a null, empty or markup-only page has the empty text; unclosed elements,
comments and scripts end with the page; nodes are never cut; pages stand alone, so repeated
ones have the same text.
"""

from __future__ import annotations

import html as html_references
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fieldbook.llm.store import shipped

# The HTML vocabulary and the words that mark what is no article text.
VOID = set(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rp "
    "rt s samp small span strike strong sub sup time tt u var wbr".split()
)
SKIPPED = set(
    "nav header footer aside form button select dialog menu canvas object video audio "
    "fieldset datalist map frameset noframes".split()
)
MARKED = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner banners "
    "breadcrumb breadcrumbs comment comments commentlist cookie cookies consent disqus "
    "footer gdpr header masthead menu menus nav navbar navigation newsletter notice notices "
    "pagination popup promo promos promotion related replies reply respond share sharing "
    "sidebar sidebars signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
# Those of them that name readers' comments.
DISCUSSION = set("comment comments commentlist disqus replies reply respond".split())
ARTICLE = {"article", "main"}
# What a path's ratio is multiplied by inside an article, and for each marked element.
INSIDE, PENALTY = 2.5, 0.1
# A marked element is layout, not penalised, if less than these shares of the page's text and
# of its punctuation lie outside.
TEXT_OUTSIDE, PUNCTUATION_OUTSIDE = 0.5, 0.2
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
CLOSE_A_PARAGRAPH = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr main menu nav ol p pre section table ul".split()
)
PUNCTUATION = re.compile(r"[.,;:!?、。，；！？]")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|math|xmp)\b"
    r"[^>]*(?:>.*?(?:</(?P=raw)\b[^>]*(?:>|\Z)|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)"
    r"(?P<rest>(?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+)>"
    r"|</?[a-z!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.I | re.S,
)
_MARKS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")


def _named(attributes: str) -> set[str]:
    """The words of class, id and role that mark what is no article text."""
    found: set[str] = set()
    for groups in _MARKS.findall(attributes):
        found |= MARKED.intersection(_WORDS.findall("".join(groups).lower()))
    return found


@dataclass
class Paths:
    """A trie of elements; number 0 is the page.  Parents have smaller numbers than children."""

    numbers: dict[tuple[int, str, bool, bool], int] = field(default_factory=dict)
    parent: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: [""])
    marked: list[bool] = field(default_factory=lambda: [False])
    discussion: list[bool] = field(default_factory=lambda: [False])

    def below(self, parent: int, tag: str, marked: bool, discussion: bool) -> int:
        key = (parent, tag, marked, discussion)
        if key not in self.numbers:
            self.numbers[key] = len(self.parent)
            for column, value in zip((self.parent, self.tag, self.marked, self.discussion), key, strict=True):
                column.append(value)
        return self.numbers[key]

    def added_up(self, values: list[float]) -> list[float]:
        """For each path, the values of all paths at and below it."""
        total = list(values)
        for k in range(len(total) - 1, 0, -1):
            total[self.parent[k]] += total[k]
        return total


def text_nodes(page: str) -> tuple[Paths, list[tuple[int, str]]]:
    """The page's paths, and (path, text) of each block of text in page order."""
    paths = Paths()
    nodes: list[tuple[int, str]] = []
    # Tag, whether its text is left out, whether marked, path.
    stack: list[tuple[str, bool, bool, int]] = []
    opened: Counter[str] = Counter()
    skipped = where = 0
    parts: list[str] = []

    def flush() -> None:
        text = " ".join(html_references.unescape("".join(parts)).split())
        if text:
            nodes.append((where, text))
        parts.clear()

    def drop(count: int) -> None:
        nonlocal skipped
        ended = stack[len(stack) - count :]
        if any(marked for _, _, marked, _ in ended):
            flush()
        for tag, leaves_out, _, _ in ended:
            skipped -= leaves_out
            opened[tag] -= 1
        del stack[len(stack) - count :]

    def close(tags: set[str], within: set[str]) -> None:
        """End the innermost open element of `tags`, unless one of `within` is nearer."""
        if not any(opened[tag] for tag in tags):
            return
        for depth, (tag, _, _, _) in enumerate(reversed(stack), 1):
            if tag in tags:
                drop(depth)
                return
            if tag in within:
                return

    for token in _TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            if not skipped:
                if not parts:
                    where = stack[-1][3] if stack else 0
                parts.append(text)
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        if token["end"]:
            close({tag}, ARTICLE - {tag} if tag in INLINE or tag == "p" else set())
            continue
        if tag in CLOSE_A_PARAGRAPH:
            close({"p"}, {"div", "article", "section", "main", "td", "li", "blockquote"})
        if tag in CLOSES:
            close(CLOSES[tag], {"ul", "ol", "dl", "table", "select"})
        if tag in VOID or token["rest"].endswith("/"):
            continue
        leaves_out = tag in SKIPPED
        words = _named(token["rest"]) if tag not in ("html", "body") else set()
        discussion = bool(words & DISCUSSION)
        # An article is marked by nothing but that it is a comment.
        marked = discussion if tag in ARTICLE else bool(words)
        if marked:
            flush()
        path = stack[-1][3] if stack else 0
        if marked or tag not in INLINE:
            path = paths.below(path, tag, marked, discussion)
        stack.append((tag, leaves_out, marked, path))
        skipped += leaves_out
        opened[tag] += 1
    flush()
    return paths, nodes


def _smoothed(values: list[float], radius: int) -> list[float]:
    """Gaussian mean over each value's neighbours, of a window of 2 * radius + 1."""
    weights = [math.exp(-(k * k) / (2.0 * max(radius, 1) ** 2)) for k in range(radius + 1)]
    out = []
    for i in range(len(values)):
        near = range(max(0, i - radius), min(len(values), i + radius + 1))
        total = sum(weights[abs(i - j)] for j in near)
        out.append(sum(weights[abs(i - j)] * values[j] for j in near) / total)
    return out


def _discussed(paths: Paths, size: list[float]) -> list[bool]:
    """Which paths lie in readers' comments.

    Where every article of the page stands in an element named for comments, the one
    such element around an article is layout.
    """
    within, last = [0] * len(size), [0] * len(size)
    for k in range(1, len(size)):
        above = paths.parent[k]
        within[k] = within[above] + paths.discussion[k]
        last[k] = k if paths.discussion[k] else last[above]
    filled = paths.added_up(size)
    articles = [k for k in range(len(size)) if paths.tag[k] in ARTICLE and filled[k] and not paths.discussion[k]]
    layout = set()
    if articles and all(within[k] for k in articles):
        layout = {last[k] for k in articles if within[k] == 1}
    found = [False] * len(size)
    for k in range(1, len(size)):
        found[k] = found[paths.parent[k]] or (paths.discussion[k] and k not in layout)
    return found


def _penalties(paths: Paths, size: list[float], points: list[float]) -> list[float]:
    """Per path the factor for its marked elements, of which those around the page's text
    are layout and count for nothing."""
    text, marks = paths.added_up(size), paths.added_up(points)
    factor = [1.0] * len(size)
    for k in range(1, len(size)):
        factor[k] = factor[paths.parent[k]]
        outside, points_outside = text[0] - text[k], marks[0] - marks[k]
        if paths.marked[k] and (
            outside >= TEXT_OUTSIDE * text[0] or points_outside >= PUNCTUATION_OUTSIDE * marks[0] > 0
        ):
            factor[k] *= PENALTY
    return factor


def content_blocks(page: str | None, radius: int = 1, share: float = 0.5) -> list[str]:
    """The page's article blocks.  `share` of the mean ratio is the threshold.

    The mean is that of the paths without penalty, however much text is penalised, or of all
    where none is without; it is taken before the gain of marked articles, so that their
    short blocks keep it.
    """
    paths, nodes = text_nodes(page) if page else (Paths(), [])
    size = [0.0] * len(paths.parent)
    for path, text in nodes:
        size[path] += len(text)
    discussed = _discussed(paths, size)
    nodes = [(path, text) for path, text in nodes if not discussed[path]]
    if not nodes:
        return []
    count, size, points, inside = ([0.0] * len(paths.parent) for _ in range(4))
    for k in range(1, len(inside)):
        inside[k] = inside[paths.parent[k]] or paths.tag[k] in ARTICLE
    for path, text in nodes:
        count[path] += 1
        size[path] += len(text)
        points[path] += len(PUNCTUATION.findall(text))
    penalty = _penalties(paths, size, points)
    length = _smoothed([size[path] / count[path] for path, _ in nodes], radius)
    marks = _smoothed([points[path] / count[path] for path, _ in nodes], radius)
    fused = [
        math.log1p(a) * (1.0 + b) * penalty[path]
        for a, b, (path, _) in zip(length, marks, nodes, strict=True)
    ]
    # The ratio of a path, not of a node, decides: its best smoothed node speaks for it.
    best: dict[int, float] = {}
    for (path, _), value in zip(nodes, fused, strict=True):
        best[path] = max(best.get(path, 0.0), value * (INSIDE if inside[path] else 1.0))
    plain = [value for value, (path, _) in zip(fused, nodes, strict=True) if penalty[path] == 1.0]
    threshold = share * (sum(plain) / len(plain) if plain else sum(fused) / len(fused))
    return [text for path, text in nodes if best[path] >= threshold]


@F.pandas_udf(StringType())
def _main_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield pd.Series([" ".join(content_blocks(page)) for page in batch], dtype=object)


def main_text(html: Column) -> Column:
    """Article text of `html`; blocks joined by one space, empty where there is none."""
    return _main_text(html)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """`pages` with the article text in column `text` instead of the markup."""
    shipped(pages.sparkSession)
    rest = [c for c in pages.columns if c not in (html, text)]
    return pages.select(*rest, main_text(F.col(html)).alias(text))

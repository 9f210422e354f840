"""Main text of web pages: blocks of text labelled content or boilerplate by a minimum cut.

A page is read into elements and blocks: a block is the text between two tags that break lines. Each block gets a cost for
either label from a classifier: what its elements say by tag, role, class and id, and a naive Bayes model of its shape (share
of link text, number of words, tag, end mark, symbols). The model is trained on all pages, from the blocks whose
elements speak for themselves. Costs are the terminal capacities; blocks that follow each other, and a block and the elements it
lies in, are joined by smoothness edges; the cut with the smallest sum tells content from boilerplate.

Whole pages. A null or empty page has an empty text. Markup that does not end (comments, tags, scripts, elements) runs to the end of the page, as
in browsers, except that an article ends menus and headers left open. White space is what `str.split` splits at, the
no-break space included. Copies of a page each keep their row; no key is needed; other columns are not read.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from profilespark.llm.mincut import source_side
from profilespark.llm.text import sliced

# Elements of HTML, and what names of elements, roles, classes and ids say about their text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BREAKING = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav noscript object ol optgroup option p pre section select summary "
    "svg table tbody td template tfoot th thead tr ul video audio canvas map".split()
)
CLOSED_BY = {
    "li": ("li", frozenset(("ul", "ol", "menu"))), "dt": ("dt dd", frozenset(("dl",))), "dd": ("dt dd", frozenset(("dl",))),
    "tr": ("tr", frozenset(("table", "tbody", "thead", "tfoot"))), "td": ("td th", frozenset(("tr", "table"))),
    "th": ("td th", frozenset(("tr", "table"))), "option": ("option", frozenset(("select",))),
    "tbody": ("tbody thead tfoot", frozenset(("table",))), "thead": ("tbody thead tfoot", frozenset(("table",))),
    "tfoot": ("tbody thead tfoot", frozenset(("table",))),
}
BARRIERS = frozenset("table td th caption template html".split())
TAG_COST = {
    "nav": -8, "footer": -8, "aside": -8, "header": -8, "form": -8, "menu": -8, "dialog": -8, "template": -12, "noscript": -12, "button": -8,
    "select": -8, "option": -8, "optgroup": -8, "label": -8, "legend": -8, "head": -12, "object": -8, "svg": -12, "video": -8, "audio": -8,
    "canvas": -12, "map": -8, "article": 6, "main": 6,
}
ROLE_COST = {
    "navigation": -8, "banner": -8, "contentinfo": -8, "complementary": -8, "search": -8, "dialog": -8, "alertdialog": -8, "alert": -8, "menu": -8,
    "menubar": -8, "toolbar": -8, "form": -8, "main": 6, "article": 6,
}
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner banners cookie cookies consent gdpr "
    "notice notices alert popup modal overlay paywall newsletter subscribe subscription signup signin login register sidebar sidebars aside rail widget widgets "
    "menu menus nav navbar navigation navigator breadcrumb breadcrumbs crumbs pagination pager toolbar topbar masthead header footer foot comment comments "
    "commentlist reply replies respond disqus discussion reactions share sharing social related recommended recommendations teaser teasers trending popular "
    "copyright legal disclaimer skip search tags tagcloud form hidden byline".split()
)
CONTENT_NAMES = frozenset("article articlebody content contents main maincontent post entry story body text page prose".split())
#: a class that says so is about the layout of the page
LAYOUT_NAMES = frozenset("has with no without is js wrapper wrap container layout".split())
NAME_COST = 6

#: pulls are counted in thousandths
UNIT = 1000
NEXT_EDGE = 1000
SIBLING_EDGE = 1000
ELEMENT_EDGE = 1200
PARENT_EDGE = 600
#: the shape of a block counts at most this much, and each of its features at most FEATURE_COST
SHAPE_COST = 3.0
FEATURE_COST = 1.5
#: a block whose elements say at least this much is an example for the shape model
EXAMPLE_COST = 6
#: what the shape model starts from: (feature, blocks of boilerplate, of content)
PRIOR = (
    ("link=0", 4, 8), ("link=1", 4, 8), ("link=2", 4, 4), ("link=3", 8, 2), ("link=4", 16, 1),
    ("words=0", 16, 1), ("words=1", 8, 2), ("words=2", 4, 4), ("words=3", 4, 8), ("words=4", 1, 16),
    ("end=True", 4, 8), ("end=False", 8, 4), ("symbol=True", 16, 1),
)

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME = re.compile(r"[^\W\d_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SYMBOL = re.compile("[©®™»«|•]")


@functools.lru_cache(maxsize=1 << 14)
def attribute_cost(attributes: str) -> int:
    """What role, class, id and visibility of an element say: below 0 boilerplate, above 0 content."""
    cost = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "role":
            said = ROLE_COST.get(value.strip().lower(), 0)
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            said = -12
        elif name in ("class", "id"):
            said = 0
            for token in value.split():
                parts = {p.lower() for p in _NAME.findall(_CAMEL.sub(" ", token))} | {token.lower()}
                if parts & BOILERPLATE_NAMES and not parts & LAYOUT_NAMES:
                    said = -NAME_COST
                    break
                if parts & CONTENT_NAMES and not parts & LAYOUT_NAMES:
                    said = NAME_COST
        else:
            said = 0
        cost = min(cost, said) if min(cost, said) < 0 else max(cost, said)
    return cost


class Page:
    """Elements and blocks of a page, in page order.

    Element e has the parent `parent[e]` and says `cost[e]`; block b lies in element `element[b]` and has the text
    `text[b]`, of which `linked[b]` characters are in links. Element 0 is the page.
    """

    def __init__(self, source: str) -> None:
        self.parent, self.cost, self.tag = [-1], [0], ["page"]
        self.text: list[str] = []
        self.linked: list[int] = []
        self.element: list[int] = []
        self._stack = [0]
        self._parts: list[str] = []
        self._linked = 0
        self._link_depth = 0  # elements open when the innermost link began; 0: no link
        self._named: set[int] = set()  # elements whose names, not tags, speak against them
        self._articles = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            found = _MARKUP.search(source, at)
            if not found:
                self._characters(source[at:])
                break
            if found.start() > at:
                self._characters(source[at:found.start()])
            at = found.end()
            closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                self._close(tag)
            elif tag in RAW:
                # their text is never shown as text of the page
                over = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = over.end() if over else end
                if tag not in ("script", "style"):
                    self._break()
            else:
                self._open(tag, attributes)
        self._break()

    def _characters(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self._parts.append(text)
        if self._link_depth:
            self._linked += len("".join(text.split()))

    def _break(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.text.append(text)
                self.linked.append(self._linked)
                self.element.append(self._stack[-1])
            self._parts.clear()
        self._linked = 0

    def _pop(self, depth: int) -> None:
        """Closes all elements from the given depth of the stack on."""
        self._break()
        del self._stack[depth:]
        if self._link_depth > len(self._stack):
            self._link_depth = 0

    def _close_nearest(self, tags: frozenset[str], barriers: frozenset[str]) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tag[self._stack[depth]]
            if tag in tags:
                self._pop(depth)
                return
            if tag in barriers:
                return

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._parts.append(" ")
            return
        said = attribute_cost(attributes) if attributes and not attributes.isspace() else 0
        if tag in ("html", "body"):
            said = 0
        if tag == "a":
            self._link_depth = len(self._stack)
        if tag not in BREAKING:
            if said >= 0 or tag in VOID:
                return  # part of the running text
        self._break()
        if tag in BREAKING:
            self._close_nearest(frozenset(("p",)), BARRIERS | {"button"})
        if tag in CLOSED_BY:
            closed, barriers = CLOSED_BY[tag]
            self._close_nearest(frozenset(closed.split()), barriers)
        if tag in ("article", "main"):
            self._article(said)
        if tag == "hr":
            return
        cost = TAG_COST.get(tag, 0)
        element = len(self.tag)
        if said < 0 and cost >= 0 and tag not in ("article", "main"):
            self._named.add(element)
        self.parent.append(self._stack[-1])
        self.cost.append(min(cost, said) if min(cost, said) < 0 else max(cost, said))
        self.tag.append(tag)
        self._stack.append(element)

    def _article(self, said: int) -> None:
        """Menus and headers end before an article; names around the first one that speak against it are about the layout."""
        for depth in range(1, len(self._stack)):
            if self.tag[self._stack[depth]] in ("nav", "menu", "header"):
                self._pop(depth)
                break
        if not self._articles and said >= 0:
            for element in self._stack:
                if element in self._named:
                    self.cost[element] = 0
        self._articles += 1

    def _close(self, tag: str) -> None:
        if tag == "a":
            self._link_depth = 0
        if tag in BREAKING:
            self._break()
        if tag in VOID:
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            open_tag = self.tag[self._stack[depth]]
            if open_tag == tag:
                self._pop(depth)
                return
            if open_tag in BARRIERS and tag not in ("body", "html", "table", "tr", "tbody", "thead", "tfoot"):
                return

    def said(self) -> list[int]:
        """Per block, what its elements say: anything against it outweighs all that is for it."""
        against, in_favour = [0] * len(self.tag), [0] * len(self.tag)
        for e in range(1, len(self.tag)):  # parents come first
            p = self.parent[e]
            against[e] = min(against[p], self.cost[e])
            in_favour[e] = max(in_favour[p], self.cost[e])
        return [against[e] or in_favour[e] for e in self.element]

    def shapes(self) -> list[tuple[str, ...]]:
        """Per block, its features for the shape model."""
        out = []
        for text, linked, element in zip(self.text, self.linked, self.element, strict=True):
            words = text.count(" ") + 1
            share = linked / max(1, len(text) - words + 1)
            out.append((
                f"link={0 if not linked else 1 + sum(share > s for s in (0.2, 0.5, 0.9))}",
                f"words={sum(words > w for w in (2, 6, 15, 40))}",
                f"tag={self.tag[element] if self.tag[element] in BREAKING else 'inline'}",
                f"end={text[-1] in '.!?…。:;'}",
                f"symbol={_SYMBOL.search(text) is not None}",
            ))
        return out

    def content(self, model: dict[str, float]) -> list[bool]:
        """Per block, whether the minimum cut leaves it on the side of the content."""
        blocks = len(self.text)
        pull = []
        for said, shape in zip(self.said(), self.shapes(), strict=True):
            looks = sum(model.get(feature, 0.0) for feature in shape)
            pull.append(round(UNIT * (said + max(-SHAPE_COST, min(SHAPE_COST, looks)))))
        edges = []
        for b in range(blocks - 1):
            siblings = self.parent[self.element[b]] == self.parent[self.element[b + 1]]
            edges.append((b, b + 1, NEXT_EDGE + (SIBLING_EDGE if siblings else 0)))
        # only elements that hold a block take part
        number: dict[int, int] = {}
        for b, e in enumerate(self.element):
            while e not in number:
                number[e] = blocks + len(number)
                if e == 0:
                    break
                e = self.parent[e]
            edges.append((b, number[self.element[b]], ELEMENT_EDGE))
        edges += [(n, number[self.parent[e]], PARENT_EDGE) for e, n in number.items() if e]
        return source_side(pull + [0] * len(number), edges)[:blocks]


def examples(source: str | None) -> Iterator[tuple[str, bool]]:
    """(feature, is content) of the blocks whose elements speak for themselves."""
    page = Page(source or "")
    for said, shape in zip(page.said(), page.shapes(), strict=True):
        if abs(said) >= EXAMPLE_COST:
            for feature in shape:
                yield feature, said > 0


def fit(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Log odds for content of each shape feature, counted over all pages: a few dozen numbers.

    Features that pages have too few examples of are held by the prior.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in sliced(batches, 0):
            for source in batch.column(0).to_pylist():
                total.update(examples(source))
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([f for f, _ in keys], pa.string()), pa.array([c for _, c in keys], pa.bool_()), pa.array([total[k] for k in keys], pa.int64())],
            ["feature", "content", "n"],
        )

    counted = pages.select(pages[html_col].alias("html")).mapInArrow(count, "feature string, content boolean, n bigint")
    seen = {(f, c): n for f, c, n in counted.groupBy("feature", "content").agg(F.sum("n").alias("n")).collect()}
    return log_odds(seen)


def log_odds(seen: dict[tuple[str, bool], int]) -> dict[str, float]:
    prior = {f: (against, in_favour) for f, against, in_favour in PRIOR}
    counts = {
        f: [n + seen.get((f, label), 0) for n, label in zip(prior.get(f, (4, 4)), (False, True), strict=True)]
        for f in {f for f, _ in seen} | set(prior)
    }
    # a feature's values share one group; each label's counts become shares of that group
    totals: Counter = Counter()
    for f, pair in counts.items():
        for label, n in zip((False, True), pair, strict=True):
            totals[f.split("=")[0], label] += n
    return {
        f: max(-FEATURE_COST, min(FEATURE_COST, math.log(pair[1] / totals[f.split("=")[0], True]) - math.log(pair[0] / totals[f.split("=")[0], False])))
        for f, pair in sorted(counts.items())
    }


def main_text(source: str | None, model: dict[str, float]) -> tuple[str, int, int]:
    """(text, blocks, blocks kept) of one page."""
    page = Page(source or "")
    kept = [text for text, is_content in zip(page.text, page.content(model), strict=True) if is_content]
    return " ".join(kept), len(page.text), len(kept)


def extract(
    pages: DataFrame, model: dict[str, float], keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html"
) -> DataFrame:
    """The columns `keep`, untouched, and `text`, `n_chars`, `n_blocks`, `n_kept_blocks` of every page."""
    added = StructType([
        StructField("text", StringType()), StructField("n_chars", LongType()), StructField("n_blocks", LongType()),
        StructField("n_kept_blocks", LongType()),
    ])
    if clash := set(keep) & set(added.fieldNames()):
        raise ValueError(f"Columns to keep have names of the result: {sorted(clash)}")
    rows = pages.select(*[pages[c] for c in keep], pages[html_col].alias("page source"))
    schema = StructType([*[rows.schema[c] for c in keep], *added.fields])
    types = [f.type for f in to_arrow_schema(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, len(keep)):
            if batch.num_rows:
                made = [main_text(source, model) for source in batch.column(len(keep)).to_pylist()]
                values = [[t for t, _, _ in made], [len(t) for t, _, _ in made], [n for _, n, _ in made], [n for _, _, n in made]]
                arrays = [pa.array(v, kind) for v, kind in zip(values, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *arrays], schema.fieldNames())

    return rows.mapInArrow(run, schema)

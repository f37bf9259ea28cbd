"""Main text of web pages by tag-path ratios.

Every text node stands at the end of a path of tags from the root. The nodes of a path
share their fate: per path, the length of text and the punctuation marks are counted per
node, both series are smoothed along the page, fused, and held against a threshold.
What passes shows where the article is: the innermost element that holds nearly all of it.
The result is its text, and what passes outside it with the sections that it stands in,
without the parts that their tags or names mark as something else.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from vitaria.llm.session import let_workers_import

# comment, declaration, element whose content is no markup, tag, or text
_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<raw>script|style|textarea|title|noscript|iframe|xmp|noembed)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_SPACE = re.compile(r"\s+")
_MARKS = re.compile(r"[.,;:!?。，、；：！？…]")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre search section select summary"
    " table tbody td tfoot th thead tr ul".split()
)
#: Elements that an opening tag ends, if they stand open inside the given bounds.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
_P_ENDERS = _BLOCKS - frozenset("br body html head li dd dt td th tr tbody thead tfoot caption option optgroup summary".split())
#: Elements that are never part of an article.
_OUTSIDE = frozenset("head nav footer aside form button select option input label menu dialog svg canvas object audio video template map".split())
#: Words in the name of an element that mark it as something beside the article.
_BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc"
    " header masthead topbar footer bottombar copyright legal"
    " sidebar sidebars aside widget widgets related recommended recommendations trending popular"
    " cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login"
    " comment comments commentlist disqus discussion replies reply respond share sharing social".split()
)
#: Elements that hold parts of a text.
_SECTIONS = frozenset("article main div section td body blockquote".split()) | {""}
#: Words in the name of an element whose header is the article's own.
_ARTICLE = frozenset("article post entry story".split())


@dataclass
class _Element:
    tag: str
    path: int  # number of its tag path from the root
    beside: bool
    parent: _Element | None
    number: int
    in_article: bool = False
    last: int = 0  # number of the last element inside
    section: _Element | None = None  # nearest that holds a part of a text, itself included

    def __post_init__(self) -> None:
        self.section = self if self.tag in _SECTIONS else self.parent.section


@dataclass
class _Node:
    text: str
    element: _Element
    block: int
    weight: int = 0
    marks: int = 0


@dataclass
class _Page:
    nodes: list[_Node] = field(default_factory=list)
    elements: list[_Element] = field(default_factory=list)


def _is_beside(tag: str, attributes: str, parent: _Element | None) -> bool:
    inside = parent is not None and parent.in_article
    if tag in _OUTSIDE or tag == "header" and not inside:
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    for found in _NAMES.finditer(attributes) if "=" in attributes else ():
        name = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", found[1] or found[2] or found[3] or "")
        words = set(re.split(r"[^a-z]+", name.lower()))
        if inside or not words.isdisjoint(_ARTICLE):
            words.discard("header")
        if not words.isdisjoint(_BESIDE):
            return True
    return "hidden" in attributes and re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes) is not None


def _read(html: str) -> _Page:
    """Text nodes with their elements, by a forgiving reading of the tags.

    The places of each tag on the stack are known and tag paths are numbered, so the time follows the length of
    the page, however deep its elements lie.
    """
    page, block = _Page(), 0
    root = _Element("", 0, False, None, 0)
    page.elements.append(root)
    stack, places, paths = [root], defaultdict(list), {}

    def close(to: int) -> None:
        while len(stack) > to:
            ended = stack.pop()
            ended.last = len(page.elements) - 1
            if places[ended.tag]:
                places[ended.tag].pop()

    def innermost(*tags: str) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def outermost(after: int, tags: tuple[str, ...]) -> int:
        found = (places[t][at] for t in tags if (at := bisect_right(places[t], after)) < len(places[t]))
        return min(found, default=0)

    for piece in _PIECE.finditer(html):
        if (text := piece["text"]) is not None:
            page.nodes.append(_Node(unescape(text), stack[-1], block))
            continue
        if piece["tag"] is None:
            continue
        tag, attributes = piece["tag"].lower(), piece["attributes"] or ""
        if tag in _BLOCKS:
            block += 1
        if piece["end"]:
            if (at := innermost(tag)) > 0:
                close(at)
            continue
        if tag in _VOID:
            continue
        if tag in _P_ENDERS and (at := innermost("p")) > 0:
            close(at)
        if tag in _CLOSES:
            ended, bounds = _CLOSES[tag]
            if (at := outermost(innermost(*bounds), ended)) > 0:
                close(at)
        parent = stack[-1]
        path = paths.setdefault((parent.path, tag), len(paths) + 1)
        beside = parent.beside or _is_beside(tag, attributes, parent)
        element = _Element(tag, path, beside, parent, len(page.elements), parent.in_article or tag == "article")
        page.elements.append(element)
        if not attributes.rstrip().endswith("/") or tag in _BLOCKS:
            places[tag].append(len(stack))
            stack.append(element)
        else:
            element.last = element.number
    close(0)
    return page


def _smoothed(values: np.ndarray, width: float) -> np.ndarray:
    """Weighted mean of the neighbours along the page."""
    reach = int(np.ceil(width))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / max(width, 1e-9)) ** 2)
    return np.convolve(np.pad(values, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def _content(nodes: list[_Node], width: float, level: float) -> list[_Node]:
    """Nodes whose paths pass: text per node times punctuation per node, both smoothed, above ``level`` deviations."""
    length, marks, count = Counter(), Counter(), Counter()
    for node in nodes:
        path = node.element.path
        length[path] += node.weight
        marks[path] += node.marks
        count[path] += 1
    text_ratio = np.array([length[n.element.path] / count[n.element.path] for n in nodes])
    mark_ratio = np.array([marks[n.element.path] / count[n.element.path] for n in nodes])
    fused = _smoothed(text_ratio, width) * (1 + _smoothed(mark_ratio, width))
    by_path: Counter = Counter()
    for node, value in zip(nodes, fused, strict=True):
        by_path[node.element.path] += value / count[node.element.path]
    least = level * float(np.std(fused))
    return [n for n in nodes if by_path[n.element.path] >= least] or nodes


def _holder(elements: list[_Element], content: list[_Node], share: float) -> _Element:
    """Innermost element that holds ``share`` of the content; the first ``article`` or ``main`` around it if there is one."""
    total, inside = sum(n.weight for n in content), [0] * len(elements)
    for node in content:
        inside[node.element.number] += node.weight
    for element in reversed(elements[1:]):  # those inside come after
        inside[element.parent.number] += inside[element.number]
    holder = elements[max(i for i, w in enumerate(inside) if w >= share * total)]
    around = holder
    while around:
        if around.tag in ("article", "main"):
            return around
        around = around.parent
    while holder.parent and holder.tag not in ("div", "section", "td", "body", "blockquote", ""):
        holder = holder.parent
    return holder


def _chosen(elements: list[_Element], content: list[_Node], holder: _Element) -> tuple[np.ndarray, set[int]]:
    """Elements whose text is the article's: the holder's and those of sections with content outside it; and single
    blocks of content, where the section around them holds the holder too."""
    chosen, blocks = np.zeros(len(elements), bool), set()
    chosen[holder.number : holder.last + 1] = True
    for node in content:
        section = node.element.section
        if chosen[node.element.number]:
            continue
        if section.number <= holder.number <= section.last:
            blocks.add(node.block)
        else:
            chosen[section.number : section.last + 1] = True
    return chosen, blocks


def main_text(html: str | None, *, width: float = 1.0, level: float = 0.5, share: float = 0.8) -> str:
    """Article of a page, a block to a line; empty for null, and for a page without text."""
    page = _read(html or "")
    nodes = [n for n in page.nodes if not n.element.beside]
    full = []
    for node in nodes:
        node.weight = len(_SPACE.sub(" ", node.text).strip())
        if node.weight:
            node.marks = len(_MARKS.findall(node.text))
            full.append(node)
    if not full:
        return ""
    content = _content(full, width, level)
    chosen, blocks = _chosen(page.elements, content, _holder(page.elements, content, share))
    lines, block = [], None
    for node in nodes:
        if chosen[node.element.number] or node.block in blocks:
            if node.block != block:
                lines.append([])
                block = node.block
            lines[-1].append(node.text)
    texts = (_SPACE.sub(" ", "".join(parts)).strip() for parts in lines)
    return "\n".join(t for t in texts if t)


def extract_main_text(pages: DataFrame, *, html: str = "html", width: float = 1.0, level: float = 0.5, share: float = 0.8) -> DataFrame:
    """Pages with ``main_text``.

    A null or empty page, and one without text outside menus, forms and the like, has an empty text.
    Broken markup is read as browsers do it roughly: unclosed paragraphs and list items end at the
    next, stray end tags are passed over. A page of any length is read whole, repeated rows are
    treated alike, other columns stay; ``main_text`` is replaced if there is one. An empty table gives an empty one.
    """
    let_workers_import(pages.sparkSession)

    @pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda h: main_text(h, width=width, level=level, share=share))

    return pages.drop("main_text").withColumn("main_text", run(F.coalesce(F.col(html), F.lit(""))))

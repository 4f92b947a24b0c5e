"""Main text of web pages by tag-path ratios.

A page is read as blocks of text, each at the end of a path of tags from the root. For every path
the length of its text (link text counts against it) and its punctuation are summed and divided by
its number of blocks. Both ratios are laid along the page, smoothed with a Gaussian, multiplied,
and averaged over the blocks of each path; paths above a share of the page's mean are content.
Length and punctuation count up to those of a plain paragraph, so very long ones don't raise the
bar. Everything in the deepest element that holds nearly all this text is content too, such as
lists, tables and verse between paragraphs.
Parts whose tag says that they are navigation, footer and so on never are. Forms, and parts whose
class, id or role says so, aren't as long as they hold little of the page's plain text, or
stand outside a main or article that has text.

Defined results: null and empty pages, and pages without text, give an empty text; unclosed and
misplaced tags are tolerated; whole pages are read, however long; repeated rows give the same text;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caregauge.llm.common import bounded_batches

#: Width of the smoothing in blocks, and the share of the page's mean that a path must reach.
SIGMA = 1.0
SHARE = 0.1
#: Characters and marks of a block beyond which a path's ratios don't grow.
FULL_TEXT, FULL_MARKS = 200.0, 4.0
#: Share of the passing paths' text that the content element holds.
HELD = 0.9
#: Share of the page's plain text that named parts of one path, and all named parts, may hold.
NAMED_PATH, NAMED_ALL = 0.25, 0.5
#: The same for a part of comments, consent or a sidebar where an h1, main or article stands outside
#: it, and where none does.
SIDE_MOST, SIDE_ALONE = 0.9, 0.5

# Fixed values of HTML: elements without an end tag, elements that are part of a line, elements
# whose content is not markup, and which open elements a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var".split()
)
RAW = "script|style|title|textarea|noscript|template|iframe|noembed|noframes|xmp|svg|math|object|canvas|audio|video|select"
CLOSES = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head"},
}

# What the names of parts beside the article say.
BESIDE_TAGS = frozenset("nav header footer aside button menu dialog head".split())
BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert sidebar widget widgets nav navbar navigation menu menubar breadcrumb breadcrumbs footer "
    "header masthead comment comments disqus reply replies share sharing social related recommended newsletter "
    "subscribe subscription signup login popup modal overlay pagination pager search toolbar complementary contentinfo".split()
)
# Names of readers' and the site's own matter, and words that tell a state of a wrapper.
SIDE_WORDS = frozenset("comment comments disqus replies cookie cookies consent gdpr sidebar".split())
STATE_WORDS = frozenset("has with no without open closed enabled disabled count left right full".split())
KEPT_TAGS = frozenset(("html", "body", "main", "article"))

_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*)(?P<rest>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)>|<(?P<odd>/?[a-zA-Z!?][^<>]*)>",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")


#: What an element's names say: nothing, one word of a name, a whole name, matter of readers or the site.
PLAIN, PART, WHOLE, SIDE = 0, 1, 2, 3


def _named(name: str, attributes: str) -> tuple[int, str]:
    """Do the element's names say that it holds something beside the article; its class names."""
    mark = PART if name == "form" else PLAIN
    if not attributes or name in KEPT_TAGS:
        return mark, ""
    named = " ".join(x for m in _NAMES.findall(attributes) for x in m if x)
    if any(w.lower() in BESIDE_WORDS for w in _WORDS.findall(named)):
        mark = WHOLE if any(x.lower() in BESIDE_WORDS for x in named.split()) else PART
        parts = ([w.lower() for w in _WORDS.findall(x)] for x in named.split())
        if any(SIDE_WORDS.intersection(p) and not STATE_WORDS.intersection(p) for p in parts):
            mark = SIDE
    return mark, named


class Elements:
    """Elements of a page in the order of their start tags; 0 is the page. Paths are numbers."""

    def __init__(self) -> None:
        self.name, self.path, self.parent, self.mark = [""], [0], [-1], [PLAIN]
        self.paths: dict[tuple[int, str, str], int] = {(-1, "", ""): 0}

    def add(self, name: str, named: str, parent: int, mark: int) -> int:
        self.name.append(name)
        self.path.append(self.paths.setdefault((self.path[parent], name, named), len(self.paths)))
        self.parent.append(parent)
        self.mark.append(mark)
        return len(self.name) - 1

    def totals(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sum of the values in each element and all within it."""
        out = np.bincount(at, weights=values, minlength=len(self.name)).tolist()
        for k in range(len(out) - 1, 0, -1):
            out[self.parent[k]] += out[k]
        return np.array(out)

    def within(self, chosen: set[int]) -> np.ndarray:
        """Is the element one of the chosen or within one."""
        out = [0 in chosen]
        for k in range(1, len(self.name)):
            out.append(out[self.parent[k]] or k in chosen)
        return np.array(out)


def blocks(page: str) -> tuple[list[tuple[int, str, int]], Elements]:
    """(element, text, characters of links) of every block outside the tags beside the article."""
    out: list[tuple[int, str, int]] = []
    elements = Elements()
    stack: list[tuple[str, int, bool]] = [("", 0, False)]  # name, element, beside
    open_: Counter[str] = Counter()  # names on the stack, so that stray end tags cost nothing
    words: list[str] = []
    link, linked, at = False, 0, 0

    def end_block() -> None:
        nonlocal linked
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                out.append((stack[-1][1], text, linked))
            words.clear()
        linked = 0

    for found in _TAG.finditer(page):
        if found.start() > at and not stack[-1][2]:
            piece = page[at : found.start()]
            words.append(piece)
            linked += len(piece) if link else 0
        at = found.end()
        name = found["name"]
        if name is None:
            odd = found["odd"]  # a tag with stray quotes
            if not odd or odd[0] in "!?":
                continue
            end, name, rest = ("/", odd[1:], "") if odd[0] == "/" else ("", *(odd.split(None, 1) + [""])[:2])
        else:
            end, rest = found["end"], found["rest"]
        name = name.lower()
        if name == "a":
            link = not end
        if name == "br":
            words.append(" ")
            continue
        if name in INLINE or name in VOID and name != "hr":
            continue
        end_block()
        if end:
            link = False
            while open_[name]:
                closed = stack.pop()[0]
                open_[closed] -= 1
                if closed == name:
                    break
            continue
        closes = CLOSES.get(name, {"p"})
        while len(stack) > 1 and stack[-1][0] in closes:
            open_[stack.pop()[0]] -= 1
        if name == "hr" or rest.endswith("/"):
            continue
        mark, named = _named(name, rest)
        _, parent, within = stack[-1]
        open_[name] += 1
        stack.append((name, elements.add(name, named, parent, mark), within or name in BESIDE_TAGS))
    if at < len(page) and not stack[-1][2]:
        words.append(page[at:])
    end_block()
    return out, elements


def _beside(elements: Elements, at: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """Elements that their names put beside the article, and those within them.

    A name counts where the parts of its path hold little of the page's plain text; together,
    smallest first, they take no more than half, so a wrapper or all of an article's sections stay.
    """
    marked = [k for k, mark in enumerate(elements.mark) if mark]
    if not marked:
        return np.zeros(len(elements.name), bool)
    text = elements.totals(at, plain)
    main = np.array([x in ("main", "article") for x in elements.name]) & (text > 0)
    mains = elements.totals(np.flatnonzero(main), np.ones(int(main.sum())))
    in_main = elements.within(set(np.flatnonzero(main).tolist()))
    share: dict[int, float] = {}
    for k in marked:
        share[elements.path[k]] = share.get(elements.path[k], 0.0) + text[k]
    head = np.array([x == "h1" for x in elements.name]) & (text > 0)
    heads = elements.totals(np.flatnonzero(head), np.ones(int(head.sum())))
    outright, little = set(), set()
    for k in marked:
        if elements.mark[k] == SIDE and not heads[k] and not mains[k]:
            # It goes whatever its size, where the page shows that its article is elsewhere.
            most = SIDE_MOST if heads[0] or mains[0] else SIDE_ALONE
            if text[k] <= most * text[0]:
                outright.add(k)
                continue
        if elements.mark[k] >= WHOLE and mains[0] and not mains[k] and not in_main[k]:
            outright.add(k)
        elif text[0] and share[elements.path[k]] <= NAMED_PATH * text[0]:
            little.add(k)
    gone = elements.within(outright)
    inner = elements.within(little)
    sizes: dict[int, float] = {}
    outer = [k for k in little if not gone[k] and not inner[elements.parent[k]]]
    for k in outer:
        sizes[elements.path[k]] = sizes.get(elements.path[k], 0.0) + text[k]
    taken, total = set(), 0.0
    for path, size in sorted(sizes.items(), key=lambda x: (x[1], x[0])):
        total += size
        if total > NAMED_ALL * text[0]:
            break
        taken.add(path)
    return elements.within(outright | {k for k in outer if elements.path[k] in taken})


def _smoothed(x: np.ndarray) -> np.ndarray:
    reach = np.arange(-3, 4)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    weight = np.convolve(np.ones(len(x) + 6), kernel, "valid") if len(x) else x
    padded = np.pad(x, 3, mode="edge")
    return np.convolve(padded, kernel, "valid") / weight


def main_text(page: str | None) -> str:
    """Text of the content blocks in page order, joined by one space."""
    found, elements = blocks(page or "")
    if not found:
        return ""
    at = np.array([k for k, _, _ in found])
    length = np.array([len(t) for _, t, _ in found], float)
    plain = np.maximum(length - [n for _, _, n in found], 0)
    keep = ~_beside(elements, at, plain)[at]
    found = [x for x, kept in zip(found, keep, strict=True) if kept]
    if not found:
        return ""
    at, length, plain = at[keep], length[keep], plain[keep]
    paths: dict[int, int] = {}
    of = np.array([paths.setdefault(elements.path[k], len(paths)) for k in at])
    marks = np.array([len(_PUNCTUATION.findall(t)) for _, t, _ in found], float)
    many = np.bincount(of)
    text_ratio = np.minimum(np.bincount(of, weights=plain) / many, FULL_TEXT)[of]
    mark_ratio = np.minimum(np.bincount(of, weights=marks) / many, FULL_MARKS)[of]
    fused = _smoothed(text_ratio) * (1 + _smoothed(mark_ratio))
    score = np.bincount(of, weights=fused) / many
    passing = score[of] >= SHARE * float(np.average(fused, weights=length))
    if plain.any():  # links alone score by their neighbours only
        passing &= np.bincount(of, weights=plain)[of] > 0
    held = elements.totals(at[passing], plain[passing])
    content = int(np.flatnonzero(held >= HELD * held[0])[-1]) if held[0] else 0
    inside = elements.within({content})[at]
    if elements.name[content] in ("", "html", "body"):  # no element of its own: lists of links stay out
        inside &= 2 * np.bincount(of, weights=plain)[of] >= np.bincount(of, weights=length)[of]
    return " ".join(t for (_, t, _), kept in zip(found, passing | inside, strict=True) if kept)


def extracted(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns and ``text`` of every page."""
    bounded_batches(pages.sparkSession)
    rows = pages.select(*keep, F.col("html").alias("_html"))
    schema = rows.drop("_html").withColumn("text", F.lit("")).schema
    names = schema.names

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [main_text(x) for x in part.column(part.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=names)

    return rows.mapInArrow(batches, schema)

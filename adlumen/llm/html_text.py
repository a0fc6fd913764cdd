"""Operator 9: main text of web pages by the maximum-scoring subsequence.

A page is a sequence of tags and words. Every tag of a block scores the logarithm of its probability
to stand inside the content, so tags score negative; every word scores the probability that words
under its enclosing elements are content, so words score positive; tags of in-line elements score
nothing. One linear scan finds the contiguous region with the largest sum. The region then becomes
whole: the page's article if it holds at least half of the region's words, else the smallest element
around the region that has no more than as many words again. Words of the region whose own
probability is low (a notice inside an article) are left out.

The probabilities are learned from all labelled pages: pages with exactly one ``article`` or
``main`` element label what stands inside it as content. Elements that too few of them show get a
probability by their meaning. Names alone never decide over an element that holds the page's article
or, on a page without one, most of its words.

Broken markup costs no more than linear time. An element that is never closed ends with its parent;
controls and players that are never closed hide nothing. A page that ends inside a tag or a comment
ends there, as in a browser.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adlumen.llm import common as c

# Features on fewer labelled pages are judged by their meaning; at most FEATURES are kept.
SEEN = 20
FEATURES = 5000
# Words with a lower probability are no content even inside the region.
WORD = 0.2
# Elements that label the content; the first that a page shows counts.
LABELS = ("article", "main")

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title".split())
UNSHOWN = frozenset("audio button canvas datalist iframe math noscript object select svg template textarea title video".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
LISTS = frozenset("ul ol menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
AROUND = frozenset("nav header footer aside form dialog menu head".split())
# Chosen by hand: words of class, id and role that name parts around the content.
AROUND_NAMES = re.compile(
    r"(?:ad|ads|advert\w*|banner|breadcrumbs?|byline-share|comments?(?:area|body|box|form|list|section|thread|wrap)?|consent|cookies?|disqus|footer|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|popup|promo\w*|related|replies|respond|search|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget)\d*",
    re.IGNORECASE,
)
# Words that only tell which part it is: "site-footer" and "sidebar-left" are parts, "has-sidebar" is none.
BESIDE = re.compile(
    r"(?:area|bar|block|bottom|box|container|form|global|inner|left|links?|lists?|main|page|posts?|primary|right|secondary|section|site|text|top|wrap|wrapper|\d*)",
    re.IGNORECASE,
)
# A longer name names no part.
NAME_CHARS = 100
_TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*+)|[!?/])")
# A value whose quote is never closed ends like one without quotes.
_ATTRIBUTE = re.compile(r"[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
_TAG_END = re.compile(r"[\s/]*+>")
_COMMENT_END = re.compile("--!?>")
_RAW_END = {name: re.compile(rf"</{name}[\s/>]", re.IGNORECASE) for name in RAW}


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest) with kind ``text``, ``open`` or ``close``; raw elements and comments are
    skipped with all they hold. ``rest``: the text, or the names in class, id and role."""
    at = 0
    unclosed: set[str] = set()  # raw elements that no tag closes from here on
    while found := _TAG.search(html, at):
        if found.start() > at:
            yield "text", "", html[at : found.start()]
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            if html.startswith("<!--", found.start()):
                end = _COMMENT_END.search(html, found.start() + 2)
                at = end.end() if end else len(html)
            else:
                at = html.find(">", at) + 1 or len(html)
            continue
        names = []
        while attribute := _ATTRIBUTE.match(html, at):
            at = attribute.end()
            if attribute[1].lower() in ("class", "id", "role"):
                names.append(attribute[2] or attribute[3] or attribute[4] or "")
        end = _TAG_END.match(html, at)
        if not end:
            return
        at = end.end()
        if found[1]:
            yield "close", name, ""
            continue
        if name in RAW and name not in unclosed and html[at - 2] != "/":
            closing = _RAW_END[name].search(html, at)
            if closing:
                at = html.find(">", closing.end() - 1) + 1 or len(html)
                continue
            unclosed.add(name)
            if name in ("script", "style"):
                return
        yield "open", name, " ".join(names)
    if at < len(html):
        yield "text", "", html[at:]


def names_around(names: str) -> bool:
    """Whether one of the names as a whole names a part around the content."""
    for one in names.split():
        if len(one) > NAME_CHARS:
            continue
        if AROUND_NAMES.fullmatch(one):
            return True
        parts = re.split("[-_]+", one)
        around = [bool(AROUND_NAMES.fullmatch(part)) for part in parts]
        if any(around) and all(x or BESIDE.fullmatch(part) for x, part in zip(around, parts)):
            return True
    return False


def feature(name: str, names: str) -> str:
    return f"{name}.{' '.join(sorted(names.lower().split()))}" if names else name


def in_line(kind: str, name: str, names: str) -> bool:
    """Whether a tag only dresses words: it ends no block, scores nothing and hides nothing."""
    return name in INLINE and (kind == "close" or not names or not names_around(names))


class Stack:
    """Open elements. Each knows the open paragraph and list item that a tag below it would end, so
    no tag has to look for them."""

    def __init__(self) -> None:
        self.open: list[tuple[str, int, int]] = []  # name, level of the paragraph, of the list item
        self.count: Counter = Counter()

    def _cut(self, level: int) -> None:
        for name, _, _ in self.open[level:]:
            self.count[name] -= 1
        del self.open[level:]

    def enter(self, name: str) -> int:
        """Opens an element, if it is not void, and returns the level below which all others ended."""
        if name in CLOSES_P and self.open and self.open[-1][1] >= 0:
            self._cut(self.open[-1][1])
        if name == "li" and self.open and self.open[-1][2] >= 0:
            self._cut(self.open[-1][2])
        level = len(self.open)
        if name not in VOID:
            _, p, li = self.open[-1] if self.open else ("", -1, -1)
            p = level if name == "p" else -1 if name in CLOSES_P else p
            li = level if name == "li" else -1 if name in LISTS else li
            self.open.append((name, p, li))
            self.count[name] += 1
        return level

    def leave(self, name: str) -> int:
        """Ends the innermost open element of this name and returns its level, or the number of open
        elements if there is none."""
        if self.count[name]:
            level = len(self.open) - 1
            while self.open[level][0] != name:
                level -= 1
            self._cut(level)
        return len(self.open)


def labelled_counts(html: str) -> Counter:
    """Counts of (feature, inside) on a page that labels its content; empty on another page."""
    found = [t for t in tokens(html) if t[0] == "text" or not in_line(*t)]
    for label in LABELS:
        if sum(k == "open" and n == label for k, n, _ in found) == 1 and any(k == "close" and n == label for k, n, _ in found):
            break
    else:
        return Counter()
    counts: Counter = Counter()
    stack = Stack()
    opened: list[str] = []  # features of the open elements
    times: Counter = Counter()
    since: dict[str, tuple[int, int]] = {}  # words outside and inside before the outermost of its feature
    words = [0, 0]
    inside = False

    def end(level: int) -> None:
        for feat in opened[level:]:
            times[feat] -= 1
            if not times[feat]:
                for side in (False, True):
                    if n := words[side] - since[feat][side]:
                        counts["w " + feat, side] += n
        del opened[level:]

    for kind, name, rest in found:
        if kind == "text":
            words[inside] += len(rest.split())
            continue
        if name == label and kind == "close":
            inside = False
        feat = feature(name, rest)
        counts[f"{'t' if kind == 'open' else 'e'} {feat}", inside] += 1
        if name == label and kind == "open":
            inside = True
        if kind == "close":
            end(stack.leave(name))
            continue
        end(stack.enter(name))
        if name not in VOID:
            if not times[feat]:
                since[feat] = words[0], words[1]
            times[feat] += 1
            opened.append(feat)
    end(0)
    return counts


class Weights:
    """Probabilities of features to be content."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        self.learned = {f: (i + 0.5) / (i + o + 1) for f, (i, o) in counts.items()}
        self.memory: dict[tuple[str, str, str], float] = {}

    def of(self, kind: str, name: str, names: str) -> float:
        key = kind, name, names
        known = self.memory.get(key)
        if known is None:
            known = self.learned.get(f"{kind} {feature(name, names)}")
            around = name in AROUND or names_around(names)
            if known is None:
                if around:
                    known = 0.05
                elif kind == "w":
                    known = 0.9
                else:
                    known = 0.7 if name == "div" else self.learned.get(f"{kind} {name}", 0.6)
            if around:
                known = max(known, 0.01) if kind != "w" else known
            elif kind == "w":  # paragraphs, lists and links mean what the elements around them mean
                known = 1.0 if name in INLINE else max(known, 0.5) if not names else known
            elif name not in LABELS:
                known = max(known, 0.3)
            if len(names) <= NAME_CHARS and len(self.memory) < 100_000:
                self.memory[key] = known
        return known


class Outline:
    """What the elements of a page hold, by the places of the tags that open them."""

    def __init__(self, found: list[tuple[str, str, str]]):
        self.found = found
        self.parent: dict[int, int] = {}
        self.end: dict[int, int] = {}  # place after the element
        self.within: list[int] = []  # of each token: the innermost element that holds it, or -1
        self.hidden: set[int] = set()  # closed elements that are not shown as text
        self.headed: set[int] = set()  # elements with a heading
        words: dict[int, int] = {}  # the words before an open element, then those in it
        beside: dict[int, bool] = {-1: False}  # whether it is no content by its tag, or in such an element
        below: dict[int, tuple[str, ...]] = {-1: ()}  # which labels are open around it
        stack = Stack()
        places: list[int] = []
        total = 0

        def close(level: int, at: int, last: bool = False) -> None:
            for place in places[level:]:
                words[place] = total - words[place]
                self.end[place] = at
            if last and found[places[level]][1] in UNSHOWN:
                self.hidden.add(places[level])
            del places[level:]

        for k, (kind, name, rest) in enumerate(found):
            if kind == "open":
                close(stack.enter(name), k)
            self.within.append(places[-1] if places else -1)
            if kind == "text":
                total += len(rest.split())
            elif kind == "close":
                level = stack.leave(name)
                if level < len(places):
                    close(level, k + 1, True)
            elif name not in VOID:
                up = self.within[k]
                self.parent[k] = up
                words[k] = total
                # A form may hold the whole page.
                beside[k] = beside[up] or (name in AROUND and name != "form")
                labels = below[up]
                below[k] = (*labels, name) if name in LABELS and name not in labels else labels
                if name in HEADINGS:
                    while up >= 0 and up not in self.headed:
                        self.headed.add(up)
                        up = self.parent[up]
                places.append(k)
        close(0, len(found))
        self.article = -1
        for label in reversed(LABELS):
            of = [k for k in words if found[k][1] == label and label not in below[self.parent[k]] and not beside[k] and words[k]]
            if of and 2 * words[best := max(of, key=lambda k: (words[k], -k))] >= sum(words[k] for k in of):
                self.article = best
        self.holders = {k for k, n in words.items() if 2 * n > total and not (found[k][1] in AROUND and found[k][1] != "form")}
        if self.article >= 0:
            self.holders, up = set(), self.article
            while up >= 0:
                self.holders.add(up)
                up = self.parent[up]

    def chance(self, k: int, above: float, weights: Weights) -> float:
        """Probability that words of an element are content, given that of the words around it."""
        _, name, names = self.found[k]
        if k in self.hidden:
            return 0.0
        own = weights.of("w", name, names)
        if k in self.holders or (self.article >= 0 and k in self.headed and self.article < k < self.end[self.article] and (name == "header" or "header" in names.lower())):
            own = max(own, 0.5)
        return min(above, own)


def best_region(scores: list[float]) -> tuple[int, int]:
    """From and to of the region with the largest positive sum: the one that ends first, and then
    the shortest. Without a positive score it is empty."""
    best, region = 0.0, (0, 0)
    total, first = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, first = 0.0, i
        total += score
        if total > best:
            best, region = total, (first, i + 1)
    return region


def whole(outline: Outline, region: tuple[int, int], kept: list[int]) -> tuple[int, int]:
    """The region as a whole: the article or the element that it is most of. ``kept`` are the sums of
    the words that count as content."""
    first, last = region
    words = kept[last] - kept[first]
    if outline.article >= 0:
        start, end = outline.article, outline.end[outline.article]
        if max(start, first) < min(end, last):
            return (start, end) if 2 * (kept[end] - kept[start]) >= words else (min(start, first), max(end, last))
    around = outline.within[first] if first < last else -1
    while around >= 0 and outline.end[around] < last:
        around = outline.parent[around]
    if around < 0 or outline.found[around][1] in ("html", "body") or 2 * words < kept[outline.end[around]] - kept[around]:
        return region
    return around, outline.end[around]


def main_text(html: str | None, weights: Weights) -> str:
    """The text of the page's best region, its blocks joined by one space."""
    found = [t for t in tokens(html or "") if t[0] == "text" or not in_line(*t)]
    outline = Outline(found)
    chance = {-1: 1.0}  # of the words in an element: the least likely element around them decides
    sure, scores, kept = [], [], [0]
    for k, (kind, name, rest) in enumerate(found):
        if k in outline.parent:
            chance[k] = outline.chance(k, chance[outline.parent[k]], weights)
        sure.append(chance[outline.within[k]])
        n = len(rest.split()) if kind == "text" else 0
        if kind == "text":
            scores.append(n * sure[k])
        else:
            scores.append(0.0 if name in INLINE else math.log(weights.of("t" if kind == "open" else "e", name, rest)))
        kept.append(kept[k] + (n if sure[k] >= WORD else 0))
    first, last = whole(outline, best_region(scores), kept)
    blocks, parts = [], []
    for k in range(first, last):
        kind, name, rest = found[k]
        if kind == "text":
            if sure[k] >= WORD:
                parts.append(unescape(rest))
        elif name not in INLINE:
            blocks.append("".join(parts))
            parts = []
    blocks.append("".join(parts))
    return " ".join(" ".join(block.split()) for block in blocks if block.strip())


COUNTED = pa.schema([("feature", pa.string()), ("inside", pa.bool_()), ("n", pa.int64()), ("pages", pa.int64())])


def fit(pages: DataFrame, html: str = "html") -> Weights:
    """Weights from all labelled pages; without any, all features are judged by their meaning."""
    rows = pages.where(F.col(html).isNotNull()).select(F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            counts: Counter = Counter()
            seen: Counter = Counter()
            for page in one.column("html").to_pylist():
                found = labelled_counts(page)
                counts.update(found)
                seen.update(found.keys())
            keys = list(counts)
            yield c.batch({"feature": [k[0] for k in keys], "inside": [k[1] for k in keys], "n": [counts[k] for k in keys], "pages": [seen[k] for k in keys]}, COUNTED)

    counted = rows.mapInArrow(run, "feature string, inside boolean, n long, pages long").groupBy("feature").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("i"), F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("o"), F.sum("pages").alias("pages"))
    kept = counted.where(F.col("pages") >= SEEN).orderBy(F.desc("pages"), "feature").limit(FEATURES).collect()
    return Weights({r["feature"]: (r["i"], r["o"]) for r in kept})


TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, weights: Weights, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars (long, its code points).

    White space inside a block becomes one space, blocks are joined by one space, character
    references are decoded. A null or empty page, or one without words, has an empty text. Rows
    repeated or without an id give rows of their own. An empty table gives an empty result; other
    columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(weights)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            texts = [main_text(page, shared.value) for page in one.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([one.column("page_id"), one.column("url").cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=TEXTS)

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")

"""Main text of web pages by a maximum-scoring subsequence.

A page is read as a sequence of words and tags. Words score positive, tags
negative, words in links and pieces of furniture (menus, adverts, forms,
comments ...) are worth what they were worth in labelled pages; the
contiguous run with the largest sum, found by one linear scan, is the content.

**Weights** are learned from labelled pages: pages that mark their content
themselves, with exactly one ``article`` or ``main`` element outside furniture. A feature (a kind
of word, or the name of a tag) weighs the logarithm of how often it occurs
inside over how often outside, with prior counts, limited to ``LIMIT``; tags
weigh ``TAG_MOST`` at most. Learning uses at most about ``LABELLED_PAGES``
pages, picked by a hash of their id, and its weights then apply to all pages,
marked or not. With no labelled page the prior counts decide.

**Furniture** is what stands between the tags of an element that holds no
article by its name (``nav``, ``form``, ...) or by a word of its class, id or
role (fixed lists below; what follows a ``has``, ``no`` or ``with`` tells of the
page and does not count). ``html``, ``body``, an element that is never closed,
and one around the page's main text (``Page._wrappers``), are none. An article
in furniture is a teaser. Furniture inside the region is left out.

**Text**: character references are decoded, white space within a block becomes
one space, blocks are trimmed and joined by a line feed, empty ones left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED_PAGES = 4_000
LIMIT = 4.0
TAG_MOST = -0.01
#: Prior counts inside and outside the content.
PRIOR = {"word": (8.0, 1.0), "link": (1.0, 2.0), "furniture": (1.0, 20.0), "tag": (1.0, 2.0)}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    # a tag whose quoted values hold no < and >, or the beginning of one
    r"|</?[a-zA-Z](?:(?:[^<>=]++|=\s*+(?:\"[^\"<>]*+\"|'[^'<>]*+'|(?![\"'])[^\s<>]*+))*+>)?",
    re.S,
)
#: What stands in a tag before the quote that opens a value (a quote opens one only after =), or before its end.
_UNQUOTED = re.compile(r"(?:[^<>=]++|=\s*+(?![\"'\s])[^\s<>]*+)*+(?:>|=\s*+([\"']))")
_BROKEN = re.compile(r"[^<>]*(?:>|\Z)")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s=<>/]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))")
_WORD = re.compile(r"[A-Za-z0-9]+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

# Elements and names of parts that are no article, elements that
# have no content, whose content is no markup, and that begin a block.
FURNITURE_ELEMENTS = frozenset(
    "head title nav header footer aside form menu button select option input textarea label fieldset dialog noscript template iframe object svg canvas audio video".split()
)
FURNITURE_NAMES = frozenset(
    """ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent
    contentinfo cookie cookies discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter
    notice notices notification pager pagination popup promo promotion related replies reply respond share sharing sidebar
    signup skip social sponsor sponsored subscribe subscription toolbar widget""".split()
)
#: Words after which a name tells what the page has or lacks, and furniture that is never laid around a main text.
NEGATORS = frozenset("has no not with without".split())
INERT = frozenset("head title button select option input textarea label noscript template iframe object svg canvas audio video".split())
#: An element of a furniture name is laid around the main text if its words outnumber those outside by this factor, or
#: without a first-level heading by the second, and are this many at least.
WRAPS, WRAPS_UNTITLED, LEAST_WORDS = 1, 4, 10
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
BLOCKS = frozenset(
    """address article aside blockquote body br caption center dd details dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead
    title tr ul""".split()
)
CONTENT = ("article", "main")


class Page:
    """A page as parallel lists: ``kind`` ("text" or a tag's name), ``raw``
    text, and for each whether it lies in a link, in furniture, in content."""

    __slots__ = ("content", "furniture", "kind", "link", "marked", "raw")

    def __init__(self, source: str):
        self.kind: list[str] = []
        self.raw: list[str] = []
        spans: list[tuple[str, int, int]] = []  # element, first and last token
        bad: list[tuple[int, int, bool]] = []  # first and last token, inert
        stack: list[tuple[str, int, bool]] = []
        open_names: Counter[str] = Counter()
        at, n = 0, len(source)
        seek = 0  # at, or behind a < in text that begins no tag
        unclosed: set[int] = set()
        while at < n:
            m = _TOKEN.search(source, seek)
            stop = m.end() if m else n
            if m and source[stop - 1] != ">" and source[m.start() + 1] not in "!?":
                stop = _tag_end(source, stop, unclosed)
                if stop < 0:  # no tag with whole values: up to the first >
                    broken = _BROKEN.match(source, m.end())
                    if not broken:
                        seek = m.end()
                        continue
                    stop = broken.end()
            end = m.start() if m else n
            if end > at:
                self.kind.append("text")
                self.raw.append(source[at:end])
            if not m:
                break
            token, at = source[m.start() : stop], stop
            seek = at
            name_at = _NAME.match(token)
            if not name_at:  # comment, doctype
                continue
            name = name_at.group(1).lower()
            if name in RAW and token[1] != "/":
                close = re.compile(rf"</{name}\b[^>]*>", re.I).search(source, at)
                seek = at = close.end() if close else n
                continue
            here = len(self.kind)
            self.kind.append(name)
            self.raw.append("")
            if token[1] == "/":
                if open_names[name]:
                    while stack:
                        own, begin, odd = stack.pop()
                        open_names[own] -= 1
                        if own == name:
                            spans.append((name, begin, here))
                            if odd:
                                bad.append((begin, here, name in INERT))
                            break
            elif name not in VOID and not token.endswith("/>"):
                stack.append((name, here, name in FURNITURE_ELEMENTS or name not in ("html", "body") and _odd_name(token)))
                open_names[name] += 1
        size = len(self.kind)
        self.link = _fill(size, [(b, e) for s, b, e in spans if s == "a"])
        bad.sort()
        wrappers = self._wrappers(bad, [x for x in spans if x[0] in CONTENT])
        self.furniture = _fill(size, [x[:2] for x in bad if x[:2] not in wrappers])
        marked = [(s, b, e) for s, b, e in spans if s in CONTENT and not self.furniture[b]]
        # an article inside a main is the content; nested articles are parts of the outer
        parts = [(b, e) for s, b, e in marked if s == "article"] or [(b, e) for _, b, e in marked]
        outer = [x for x in parts if not any(y[0] < x[0] and x[1] < y[1] for y in parts)]
        self.marked = len(outer) == 1
        self.content = _fill(size, outer)

    def _wrappers(self, bad: list[tuple[int, int, bool]], marks: list[tuple[str, int, int]]) -> set[tuple[int, int]]:
        """Elements of ``bad`` that are laid around the main text and so are no
        furniture. From the page down, the one that holds the main text is
        looked for among the elements at hand: one with a ``main``; one with an
        article, and else any, if more words stand together in it than outside.
        The search ends where an article or ``main`` stands in none of them."""
        if not bad:
            return set()
        nodes = [(-1, len(self.kind), False), *bad]
        heads = [("h1", i, i) for i, k in enumerate(self.kind) if k == "h1"]
        # innermost node around each node, and around each article, main and h1 (a node that is one holds it)
        inner: list[list[int]] = [[] for _ in nodes]
        up = [0] * len(nodes)
        homes: list[tuple[str, int]] = []
        path = [0]
        order = [(x[0], 0, v) for v, x in enumerate(bad, 1)] + [(x[1], 1, x[0]) for x in (*marks, *heads)]
        for begin, is_mark, what in sorted(order, key=lambda x: x[:2]):
            while nodes[path[-1]][1] < begin:
                path.pop()
            if is_mark:
                homes.append((what, path[-1]))
            else:
                up[what] = path[-1]
                inner[path[-1]].append(what)
                path.append(what)
        direct = {v for name, v in homes if name != "h1"}
        if 0 in direct:
            return set()
        holds: list[set[str]] = [set() for _ in nodes]
        for name, v in homes:
            while name not in holds[v]:
                holds[v].add(name)
                v = up[v]
        # words outside links: total; own: outside the inner nodes too; best: most that stand together
        upto = [0]
        for kind, raw, link in zip(self.kind, self.raw, self.link, strict=True):
            upto.append(upto[-1] + (len(raw.split()) if kind == "text" and not link else 0))
        total = [upto[-1], *(upto[e + 1] - upto[b] for b, e, _ in bad)]
        own = [n - sum(total[c] for c in kids) for n, kids in zip(total, inner, strict=True)]
        best = list(own)
        for v in reversed(range(len(nodes))):
            best[v] = -1 if nodes[v][2] else max(own[v], *(best[c] for c in inner[v]), 0)
        out: set[tuple[int, int]] = set()
        at, outside, marked = 0, own[0], bool(marks)
        while not (marked and at in direct):
            kids = [c for c in inner[at] if not nodes[c][2]]
            with_main = [c for c in kids if marked and "main" in holds[c]]
            with_article = [c for c in kids if marked and "article" in holds[c]]
            take = max(with_main or with_article, key=best.__getitem__, default=None)
            if take is None or not with_main and best[take] < outside:
                marked = False  # teasers
                take = max(kids, key=best.__getitem__, default=None)
                if take is None or best[take] < LEAST_WORDS:
                    break
                if best[take] <= outside * (WRAPS if "h1" in holds[take] else WRAPS_UNTITLED):
                    break
            out.add(nodes[take][:2])
            at, outside = take, outside + own[take]
        return out

    def features(self) -> Iterator[tuple[str, int]]:
        """Feature of each token and how often it counts: a text as often as
        it has words, a tag once, a run of furniture once at its beginning."""
        before = 0
        for kind, raw, link, odd in zip(self.kind, self.raw, self.link, self.furniture, strict=True):
            if odd:
                yield "furniture", 1 - before
            elif kind == "text":
                yield "link" if link else "word", len(raw.split())
            else:
                yield f"<{kind}>", 1
            before = odd


def _tag_end(source: str, at: int, unclosed: set[int]) -> int:
    """End of the tag that goes on at ``at``, or -1 if a < or the page's end
    comes first. Values whose tag does not end go to ``unclosed`` and are not
    read again for another tag, which keeps a page linear."""
    opened = []
    while m := _UNQUOTED.match(source, at):
        if not m.group(1):
            return m.end()
        if m.end() in unclosed:
            break
        opened.append(m.end())
        at = source.find(m.group(1), m.end()) + 1
        if not at:
            break
    unclosed.update(opened)
    return -1


def _odd_name(tag: str) -> bool:
    for attribute, *a in _ATTRIBUTE.findall(tag):
        if attribute.lower() not in ("class", "id", "role"):
            continue
        for name in "".join(a).split():
            for word in _WORD.findall(name):
                parts = [p.lower() for p in _PART.findall(word)]
                told = next((i for i, p in enumerate(parts) if p in NEGATORS), None)
                if told is None and word.lower() in FURNITURE_NAMES or any(p in FURNITURE_NAMES for p in parts[:told]):
                    return True
                if told is not None:
                    break
    return False


def _fill(size: int, spans: list[tuple[int, int]]) -> bytearray:
    out = bytearray(size)
    for b, e in spans:
        out[b : e + 1] = b"\1" * (e + 1 - b)
    return out


def _prior(feature: str) -> tuple[float, float]:
    return PRIOR.get(feature, PRIOR["tag"])


def weight(feature: str, inside: int, outside: int) -> float:
    a, b = _prior(feature)
    w = max(-LIMIT, min(LIMIT, math.log((inside + a) / (outside + b))))
    return max(0.1, w) if feature == "word" else w if feature == "link" else min(TAG_MOST, w)


class Weights(dict):
    """Weight of each feature; one that was never seen has its prior's."""

    def __missing__(self, feature: str) -> float:
        return weight(feature, 0, 0)


def region(scores: list[float]) -> tuple[int, int]:
    """First and last+1 index of the run with the largest sum, the first and
    shortest of equal ones; (0, 0) if no sum is positive."""
    top, span, now, begin = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if now <= 0:
            now, begin = 0.0, i
        now += s
        if now > top + 1e-9:
            top, span = now, (begin, i + 1)
    return span


def extract(source: str | None, weights: Weights) -> str:
    """Main text of a page; NULL and pages without words give ``""``."""
    page = Page(source or "")
    a, b = region([n * weights[f] for f, n in page.features()])
    blocks, own = [], []
    for i in range(a, b):
        if page.furniture[i]:
            if page.kind[i] in BLOCKS:
                blocks.append(own)
                own = []
        elif page.kind[i] == "text":
            own.append(page.raw[i])
        elif page.kind[i] in BLOCKS:
            blocks.append(own)
            own = []
    blocks.append(own)
    texts = (" ".join(html.unescape("".join(x)).split()) for x in blocks if x)
    return "\n".join(t for t in texts if t)


def hash_limit(n: int, labelled_pages: int) -> int:
    """Below it lie the 62-bit hashes of about ``labelled_pages`` of ``n`` pages,
    whatever their number."""
    return min(1 << 62, -(-(labelled_pages << 62) // max(1, n)))


def fit(pages: DataFrame, id_col: str, html_col: str, labelled_pages: int = LABELLED_PAGES) -> Weights:
    """Weights from labelled pages: about ``labelled_pages`` at most. What
    reaches the driver is a count for each feature of these pages."""
    marked = pages.where(F.lower(F.col(html_col)).rlike("<(article|main)[\\s>]"))
    n = marked.count()
    picked = marked.where(F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 2) < F.lit(hash_limit(n, labelled_pages)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside: Counter[str] = Counter()
        outside: Counter[str] = Counter()
        for b in batches:
            for source in b.column(0).to_pylist():
                page = Page(source)
                if page.marked:
                    for (f, k), own in zip(page.features(), page.content, strict=True):
                        (inside if own else outside)[f] += k
        names = sorted({*inside, *outside})
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([inside[f] for f in names], pa.int64()), pa.array([outside[f] for f in names], pa.int64())],
            ["feature", "inside", "outside"],
        )

    counted = picked.select(F.col(html_col).cast("string")).mapInArrow(run, "feature string, inside long, outside long")
    rows = counted.groupBy("feature").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o")).collect()
    return Weights({r["feature"]: weight(r["feature"], r["i"], r["o"]) for r in rows})


def extract_table(pages: DataFrame, keep: list[str], id_col: str = "page_id", html_col: str = "html", weights: Weights | None = None) -> DataFrame:
    """``keep`` and the main ``text`` of every row, from the whole html. NULL
    and empty pages give the empty text; repeated rows stay; weights are
    learned from ``pages`` unless given."""
    weights = fit(pages, id_col, html_col) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pa.array([extract(s, weights) for s in b.column(len(keep)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], text], [*keep, "text"])

    kinds = dict(pages.dtypes)
    ddl = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "text string"
    return pages.select(*keep, F.col(html_col).alias("__in")).mapInArrow(run, ddl)

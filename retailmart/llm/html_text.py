"""HTML extraction by nearest-URL page differencing.

A page is cut into lines: one per block of text, with the place it stands in. The pages of a host are laid out by URL
path, and each is paired with the neighbour whose path shares the longest beginning. The lines of a pair are aligned by
their longest common subsequence: what two pages share is the host's frame, and it is deleted. Lines of an ``article`` or
``main`` go only if the alignments of half of the host's pages find them shared; pages that are copies of each other keep
them. Elements that HTML itself names as frame (menus, headers, footers, sidebars, forms, scripts, styles) or that are
classed as adverts, cookie notices or comments are frame without a partner too.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retailmart.llm.texts import kept, slices
from retailmart.operators.joins import HOT_KEYS, hot_key_join

# Elements of HTML, and common words in classes and ids.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe title svg select xmp noembed noframes annotation annotation-xml".split())
#: Without a closing tag, only these go on to the page's end.
TO_THE_END = ("script", "style")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "object math semantics mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mtable mtr mtd mstyle mpadded menclose".split()
)
FRAME = frozenset("nav header footer aside form button dialog menu head fieldset".split())
OWN = frozenset("article main".split())
FRAME_CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies gdpr popup modal newsletter subscribe nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar footer masthead comment comments disqus pagination pager toolbar".split()
)
#: Of these, the names of readers' comments.
COMMENT_CLASSES = frozenset("comment comments disqus".split())
#: Start tags that end an open paragraph, and those that end open elements of their own kind, as HTML has it.
ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main "
    "menu nav ol p pre search section summary table ul".split()
)
ENDS_ALIKE = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"), "td": ("td", "th"), "th": ("td", "th"),
    "tr": ("tr",), "tbody": ("tbody", "thead", "tfoot"), "thead": ("tbody", "thead", "tfoot"), "tfoot": ("tbody", "thead", "tfoot"),
}
#: Open elements that such a tag does not look beyond.
P_LIMITS = ("table", "td", "th", "caption", "button", "object", "template")
LIST_LIMITS = (
    *("ul", "ol", "menu", "dl", "article", "section", "aside", "nav", "main", "header", "footer", "form", "fieldset", "blockquote", "figure", "details"),
    *P_LIMITS,
)
TABLE_LIMITS = ("table", "template")
#: Class names that begin so tell what an element has, not what it is.
MODIFIERS = frozenset("has no non not with without".split())
#: Never frame for a class or an attribute.
WHOLE = ("html", "body", "main")
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|=|[^>=]++)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"\s+")
CLASS_WORD = re.compile(r"[a-z]+")


class Line(NamedTuple):
    """A block of text; ``place`` is "own" inside an article, "frame" inside an element known as frame, "classed" inside one
    that only a class or id names so, else "open"."""

    text: str
    place: str


def is_frame(name: str, attributes: str) -> bool:
    """Whether an element is frame by its name, its role, or as it is hidden."""
    if name in FRAME:
        return True
    if name in WHOLE or not attributes or "=" not in attributes and "hidden" not in attributes:
        return False
    for key, value in _attributes(attributes):
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key == "role" and value in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu"):
            return True
    return False


def classed(name: str, attributes: str) -> str:
    """"comments" or "frame" if a class or id names an element so, else empty."""
    if name in WHOLE or "=" not in attributes:
        return ""
    found = ""
    for key, value in _attributes(attributes):
        if key in ("class", "id"):
            for word in value.split():
                if _frame_name(word):
                    if not COMMENT_CLASSES.isdisjoint(CLASS_WORD.findall(word)):
                        return "comments"
                    found = "frame"
    return found


def _attributes(attributes: str) -> Iterator[tuple[str, str]]:
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        yield key.lower(), html.unescape(a or b or c).lower()


def _frame_name(name: str) -> bool:
    """Whether the first or the last word of a class name is a frame word: ``ad-slot``, ``cookie_notice``, ``page-footer``."""
    words = CLASS_WORD.findall(name)
    return bool(words) and words[0] not in MODIFIERS and (words[0] in FRAME_CLASSES or words[-1] in FRAME_CLASSES)


class _Open(NamedTuple):
    """An open element; ``around`` is the number of the innermost element classed as frame around it, or -1."""

    name: str
    frame: bool
    around: int


class _Classed:
    """Elements classed as frame, numbered in order, each with the one around it."""

    def __init__(self) -> None:
        self.outer: list[int] = []
        self.comments: list[bool] = []
        self.holds_article: set[int] = set()

    def add(self, outer: int, comments: bool) -> int:
        self.outer.append(outer)
        self.comments.append(comments)
        return len(self.outer) - 1

    def mark(self, k: int) -> None:
        """Note that element ``k`` and all around it hold an article; what is noted is not walked again."""
        while k >= 0 and k not in self.holds_article:
            self.holds_article.add(k)
            k = self.outer[k]

    def hidden(self, blocks: list[tuple[str, str, int]]) -> list[bool]:
        """For each element whether its text is frame. Those that hold an article are not, unless the page has text of
        an article outside of all: a tenth as much at least, or any at all where comments are concerned."""
        outside = sum(len(t) for t, place, k in blocks if place == "own" and k < 0)
        inside = sum(len(t) for t, place, k in blocks if place == "own" and k in self.holds_article)
        out: list[bool] = []
        for k, around in enumerate(self.outer):
            kept = k in self.holds_article and (not outside if self.comments[k] else 10 * outside < inside)
            out.append(not kept or around >= 0 and out[around])
        return out


def lines_of(page: str) -> list[Line]:
    """The blocks of a page in order, character references decoded, white space folded; empty blocks are left out.

    Each tag is worked through in bounded time, whatever is open. End tags that HTML lets an author leave out are
    supplied. An element classed as frame is none if it holds the page's article.
    """
    blocks: list[tuple[str, str, int]] = []
    parts: list[str] = []
    stack: list[_Open] = []
    places: dict[str, list[int]] = {}  # by name, where in the stack it is open
    marked = _Classed()
    frames = own = 0
    around = -1
    unclosed: set[str] = set()

    def flush() -> None:
        text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            blocks.append((text, "frame" if frames else "own" if own else "open", around))
        parts.clear()

    def close(size: int) -> None:
        nonlocal frames, own, around
        while len(stack) > size:
            last = stack.pop()
            places[last.name].pop()
            frames -= last.frame
            own -= last.name in OWN
            around = last.around

    def innermost(names: Sequence[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    at, end = 0, len(page)
    while at < end:
        begin = page.find("<", at)
        if begin < 0:
            parts.append(page[at:])
            break
        parts.append(page[at:begin])
        tag = TAG.match(page, begin)
        if tag is None:
            parts.append("<")
            at = begin + 1
            continue
        at = tag.end()
        if tag[2] is None:
            if tag[0].startswith("<![CDATA["):
                parts.append(html.escape(tag[0][9:].removesuffix("]]>")))
            continue
        name = tag[2].lower()
        if name not in INLINE:
            flush()
        if tag[1]:
            if places.get(name):
                if name in INLINE:
                    flush()
                close(places[name][-1])
            continue
        self_closed = tag[3].rstrip().endswith("/")
        if name in RAW and not (self_closed and name == "svg"):
            found = None if name in unclosed else re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if found is None:
                unclosed.add(name)
            at = found.end() if found else end if name in TO_THE_END else at
            continue
        if name in ENDS_P and innermost(("p",)) > innermost(P_LIMITS):
            close(places["p"][-1])
        if name in ENDS_ALIKE:
            alike = innermost(ENDS_ALIKE[name])
            if alike > innermost(LIST_LIMITS if name in ("li", "dt", "dd") else TABLE_LIMITS):
                close(alike)
        if name in VOID or self_closed:
            continue
        frame, named = is_frame(name, tag[3]), classed(name, tag[3])
        if name in INLINE and not frame and not named or name == "p" and not tag[3]:
            continue  # often left open, and nothing hangs on them
        # Headings of an article may stand in a header of its own.
        frame = frame and not (name == "header" and own and not frames)
        if frame or named:
            flush()
        places.setdefault(name, []).append(len(stack))
        stack.append(_Open(name, frame, around))
        if named:
            around = marked.add(around, named == "comments")
        if name in OWN and not frame and not frames:
            marked.mark(around)
        frames += frame
        own += name in OWN
    flush()
    hidden = marked.hidden(blocks)
    return [Line(text, "classed" if place != "frame" and k >= 0 and hidden[k] else place) for text, place, k in blocks]


#: Bits of the table that an alignment holds; a larger one is cut in two.
TABLE_BITS = 1 << 26


def shared_lines(a: list[str], b: list[str]) -> tuple[set[int], set[int]]:
    """The places in ``a`` and in ``b`` of their longest common subsequence, repeated lines included.

    Bit-parallel: a row of the table is one whole number, its bit j unset where line j of ``b`` makes the subsequence longer.
    """
    in_both = set(a).intersection(b)
    at, to = ([i for i, x in enumerate(lines) if x in in_both] for lines in (a, b))
    pairs = _aligned([a[i] for i in at], [b[j] for j in to])
    return {at[i] for i, _ in pairs}, {to[j] for _, j in pairs}


def _rows(a: list[str], b: list[str]) -> Iterator[int]:
    places: dict[str, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    every = (1 << len(b)) - 1
    row = every
    for x in a:
        met = row & places.get(x, 0)
        row = (row + met | row - met) & every
        yield row


def _aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    pairs = [(k, k) for k in range(first)]
    a, b = a[first:], b[first:]
    if not a or not b:
        return pairs
    if len(a) > 1 and len(a) * len(b) > TABLE_BITS:  # Hirschberg: the best cut of b for a's halves
        half = len(a) // 2
        front = _lengths(a[:half], b)
        back = _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = max(range(len(b) + 1), key=lambda j: front[j] + back[j])
        found = _aligned(a[:half], b[:cut]) + [(i + half, j + cut) for i, j in _aligned(a[half:], b[cut:])]
    else:
        rows = list(_rows(a, b))
        found, i, j = [], len(a), len(b)
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
                continue
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                found.append((i, j))
        found.reverse()
    return pairs + [(i + first, j + first) for i, j in found]


def _lengths(a: list[str], b: list[str]) -> list[int]:
    """The length of the longest common subsequence of ``a`` and each beginning of ``b``."""
    *_, row = _rows(a, b)
    lengths = [0]
    for bit in reversed(format(row, f"0{len(b)}b")):
        lengths.append(lengths[-1] + (bit == "0"))
    return lengths


def _compared(lines: list[Line]) -> list[Line]:
    """What known frame leaves; if that is nothing, what only a class names as frame."""
    body = [x for x in lines if x.place in ("own", "open")]
    return body or [Line(x.text, "open") for x in lines if x.place == "classed"]


class Outline(NamedTuple):
    """The lines of a page by digest, whether they stand in an article, and their lengths."""

    digests: list[int]
    own: list[bool]
    sizes: list[int]


def outline(body: list[Line]) -> Outline:
    return Outline([xxhash.xxh3_64_intdigest(x.text.encode()) - (1 << 63) for x in body], [x.place == "own" for x in body], [len(x.text) for x in body])


def compared(page: Outline, partner: list[int] | None, other: list[int] | None) -> tuple[set[int], set[int]]:
    """What the alignments with the neighbours find shared: open lines, which go, and lines of an article, which go if the
    host's pages bear it out. The latter must be shared with both neighbours, where there are two."""
    shared, again = (shared_lines(page.digests, near)[0] if near else set() for near in (partner, other))
    gone = {i for i in shared if not page.own[i]}
    return gone, {i for i in shared - gone if not other or i in again}


def left_lines(page: Outline, gone: set[int] = frozenset(), borne_out: set[int] = frozenset()) -> list[int]:
    """The places of the lines that are left.

    If less than half of an article's text would be left, or nothing of a page without one, the pages are copies of each
    other, and their lines stay. Then the structure is looked at: beside an article, open lines are frame unless they hold
    more text than it.
    """

    def size(places: list[int]) -> int:
        return sum(page.sizes[i] for i in places)

    every = range(len(page.own))
    own = [i for i in every if page.own[i]]
    own_left = [i for i in own if i not in borne_out]
    if 2 * size(own_left) < size(own):
        borne_out, own_left = frozenset(), own
    left = [i for i in every if i not in gone and i not in borne_out]
    if own_left and size(left) <= 2 * size(own_left):
        left = own_left
    return left or list(every)


def main_text(page: str, left: list[int] | None = None) -> str:
    """The lines of a page at the places ``left``, or those left of it without a partner, joined by a space."""
    body = _compared(lines_of(page))
    return " ".join(body[i].text for i in (left_lines(outline(body)) if left is None else left))


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host in lower case, path without query and fragment); null urls have the empty host."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(text, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(text, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?[^/?#]*([^?#]*)", 1)
    return host, path


def _alike(a: str, b: str) -> int:
    """Length of the common beginning of two paths."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


#: Share of a host's pages, and their number, on which the alignment must find a line of an article shared.
COMMON_SHARE, COMMON_PAGES = 0.5, 3

OUTLINE = "digests array<long>, own array<boolean>, sizes array<int>"
PAGE = f"page_id long, url string, host string, path string, tie long, {OUTLINE}"
#: ``side`` is 0 for a page between its neighbours, 1 for the first page of a range, 2 for the last, 3 for the only one, whose
#: ``near_*`` is the neighbour inside the range. ``left`` is final; without it, ``gone`` and ``asked`` are the shared lines.
PAIRED = f"span int, side int, {PAGE}, near_path string, near_digests array<long>, gone array<int>, asked array<int>, left array<int>"
KEY = ("page_id", "url", "tie")
#: Rows after which a task passes on what it has.
PASSED = 2_000


class _Near(NamedTuple):
    """What is looked at of a neighbour."""

    host: str
    path: str
    digests: list[int]


class _Page(NamedTuple):
    page_id: int | None
    url: str | None
    host: str
    path: str
    tie: int
    lines: Outline

    def near(self) -> _Near:
        return _Near(self.host, self.path, self.lines.digests)

    def row(self, **more: object) -> dict:
        return {"side": 0, **self._asdict(), **self.lines._asdict(), **more}


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", ranges: int | None = None) -> DataFrame:
    """(page_id, url, text, n_chars), one row per input row; ``n_chars`` counts code points.

    Null or empty html gives an empty text. A first scan takes the outline of each page: digests and lengths of its
    lines. Outlines are sorted by host and path over ``ranges`` (default: the number of shuffle partitions) that Spark sets
    and aligned there; a host of any size is spread over tasks, and a task holds three outlines at a time. The first and
    the last page of each range are joined with their neighbours in other ranges, so the neighbours do not depend on the
    ranges. A second scan reads the texts; pages of which the alignment takes something are joined with what is left.

    Pages without a url are paired among themselves; pages without text are nobody's neighbour. Ties in the path are
    ordered by url, id and a hash of the html; of rows that repeat all three, all get the text of one. A page alone on
    its host has no partner and keeps its open lines. An empty table gives no rows. Other columns are not read.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")
    ).withColumn("tie", F.xxhash64("html"))
    host, path = url_parts(F.col("url"))
    outlines = rows.select("page_id", "url", host.alias("host"), path.alias("path"), "tie", "html").mapInArrow(_outlines, PAGE)
    outlines = kept(outlines, "page-outlines")
    order = ["host", "path", "url", "page_id", "tie"]
    ranges = ranges or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = outlines.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    paired = kept(dealt.mapInArrow(_pair, PAIRED), "page-pairs")
    edges = kept(_joined_edges(paired.where("side > 0")).mapInArrow(_settle_edges, PAIRED), "page-edges")
    settled = paired.where("side = 0").unionByName(edges)

    asking = settled.where("left is null")
    asked = F.array_distinct(F.transform("asked", lambda i: F.get("digests", i)))
    found = asking.select("host", F.explode(asked).alias("digest")).groupBy("host", "digest").agg(F.count("*").alias("n"))
    sizes = outlines.groupBy("host").agg(F.count("*").alias("pages"))
    enough = (F.col("n") >= COMMON_SHARE * F.col("pages")) & (F.col("n") >= COMMON_PAGES)
    common = found.join(sizes, "host").where(enough).groupBy("host").agg(F.collect_list("digest").alias("common"))
    hot = sizes.where(F.col("pages") * HOT_KEYS > sizes.agg(F.sum("pages")).scalar()).select("host")
    borne = hot_key_join(asking.select(*KEY, "host", "digests", "own", "sizes", "gone", "asked"), kept(common, "common-lines"), "host", "left", hot=hot)
    final = borne.mapInArrow(_borne_out, "page_id long, url string, tie long, left array<int>")
    left = settled.where("left is not null").select(*KEY, "left").unionByName(final)
    left = kept(left.groupBy(*KEY).agg(F.min("left").alias("left")), "page-left")

    named = left.withColumnsRenamed({c: f"_{c}" for c in KEY})
    same = rows["page_id"].eqNullSafe(named["_page_id"]) & rows["url"].eqNullSafe(named["_url"]) & (rows["tie"] == named["_tie"])
    return rows.join(named, same, "left").select("page_id", "url", "html", "left").mapInArrow(_texts, "page_id long, url string, text string, n_chars long")


def _dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for a in range(0, batch.num_rows, PASSED):
            yield from batch.slice(a, PASSED).to_pylist()


def _table(rows: Iterator[dict], schema: str) -> Iterator[pa.RecordBatch]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [c.split(" ") for c in schema.split(", ")]
    typed = pa.schema([(n, pa.list_(kinds[k[6:-1]]) if k.startswith("array<") else kinds[k]) for n, k in fields])
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == PASSED:
            yield pa.RecordBatch.from_pylist(held, typed)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, typed)


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages without text are left out."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            names = ("page_id", "url", "host", "path", "tie")
            for k in range(batch.num_rows):
                lines = outline(_compared(lines_of(batch.column("html")[k].as_py())))
                if lines.own:
                    yield {c: batch.column(c)[k].as_py() for c in names} | lines._asdict()

    return _table(rows(), PAGE)


def _page(r: dict) -> _Page:
    return _Page(r["page_id"], r["url"], r["host"], r["path"], r["tie"], Outline(r["digests"], r["own"], r["sizes"]))


def _nearest(page: _Page, before: _Near | None, after: _Near | None) -> tuple[list[int] | None, list[int] | None]:
    """The neighbours on the page's host: the one whose path is nearer, then the other. The one before wins a tie."""
    near = [p for p in (before, after) if p is not None and p.host == page.host]
    near.sort(key=lambda p: -_alike(p.path, page.path))
    return (*(p.digests for p in near), None, None)[:2]


def _settled(page: _Page, before: _Near | None, after: _Near | None) -> Iterator[dict]:
    """The row of a page whose neighbours are known, if they change anything."""
    gone, asked = compared(page.lines, *_nearest(page, before, after))
    left = left_lines(page.lines, gone)
    if asked:
        yield page.row(gone=sorted(gone), asked=sorted(asked))
    elif left != left_lines(page.lines):
        yield page.row(left=left)


def _edge(page: _Page, span: int, side: int, near: _Near | None) -> dict:
    inner = {"near_path": near.path, "near_digests": near.digests} if near and near.host == page.host else {}
    return page.row(span=span, side=side, **inner)


def _pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page of a range with its neighbours; the first and the last are left for those of other ranges."""
    span = TaskContext.get().partitionId()

    def rows() -> Iterator[dict]:
        before = page = None
        for after in map(_page, _dicts(batches)):
            if page is not None and before is None:
                yield _edge(page, span, 1, after.near())
            elif page is not None:
                yield from _settled(page, before.near(), after.near())
            before, page = page, after
        if page is not None:
            yield _edge(page, span, 2, before.near()) if before is not None else _edge(page, span, 3, None)

    return _table(rows(), PAIRED)


def _joined_edges(edges: DataFrame) -> DataFrame:
    """The edge pages with the pages before and after them in other ranges; only range numbers are looked at in one place."""
    spans = edges.select("span").distinct()
    ordered = Window.orderBy("span")
    spans = spans.select("span", F.lag("span").over(ordered).alias("_prev"), F.lead("span").over(ordered).alias("_next"))

    def looked(sides: str, name: str) -> DataFrame:
        return edges.where(sides).select(F.col("span").alias(f"_{name}"), F.struct("host", "path", "digests").alias(name))

    placed = edges.join(spans, "span")
    joined = placed.join(looked("side in (2, 3)", "prev"), "_prev", "left").join(looked("side in (1, 3)", "next"), "_next", "left")
    return joined.select(*edges.columns, F.when(F.col("side") != 2, F.col("prev")).alias("before"), F.when(F.col("side") != 1, F.col("next")).alias("after"))


def _settle_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for r in _dicts(batches):
            page = _page(r)
            before, after = (_Near(**r[c]) if r[c] else None for c in ("before", "after"))
            inner = _Near(page.host, r["near_path"], r["near_digests"]) if r["near_digests"] is not None else None
            yield from _settled(page, inner if r["side"] == 2 else before, inner if r["side"] == 1 else after)

    return _table(rows(), PAIRED)


def _borne_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for r in _dicts(batches):
            page, common = Outline(r["digests"], r["own"], r["sizes"]), set(r["common"] or ())
            left = left_lines(page, set(r["gone"]), {i for i in r["asked"] if page.digests[i] in common})
            if left != left_lines(page):
                yield {c: r[c] for c in KEY} | {"left": left}

    return _table(rows(), "page_id long, url string, tie long, left array<int>")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "html"):
            texts = [main_text(piece.column("html")[k].as_py(), piece.column("left")[k].as_py()) for k in range(piece.num_rows)]
            columns = [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

"""Main text of web pages by differencing each page against its nearest URL neighbour.

Pages are ordered by host and path; a page is paired with the neighbour whose path shares
more with its own. Their text lines are aligned by a longest common subsequence, and
lines both have are template text, not content. Mark-up then decides what differencing
cannot see: menus, notices or comments that differ from page to page.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.llm.common import saved, small_batches
from pulsemill.llm.list_join import host_of, path_of

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_BLANKS = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = frozenset(
    "nav footer aside form dialog menu select button svg canvas object audio video map".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter "
    "output progress q ruby rb rp rt rtc s samp small span strike strong sub sup time tt u var wbr "
    "input link meta br".split())
CUES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "banner sidebar sidenav menu submenu nav navbar navigation breadcrumb breadcrumbs topbar toolbar "
    "footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations "
    "trending comment comments commentlist disqus replies reply respond widget widgets pagination "
    "pager skip disclaimer copyright search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
CONTAINERS = ("article", "main")


@dataclass
class Line:
    """One block of text; ``place`` is what mark-up says of it."""

    text: str
    place: int


# boilerplate, undecided, inside an article, undecided beside one
TEMPLATE, OPEN, ARTICLE, BESIDE = 0, 1, 2, 3


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(raw)} if raw.strip(" /") else {}


def _drops(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether an element is boilerplate by its tag, role, class or id."""
    if tag in DROPPED or (tag == "header" and not inside):
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if attributes.get("role", "").lower() in ROLES or _HIDDEN.search(attributes.get("style", "")):
        return True
    if tag in ("html", "body"):
        return False
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    cues = CUES.intersection(re.split(r"[^a-z]+", named))
    if tag in CONTAINERS:
        return bool(cues & {"comment", "comments", "reply", "replies"})
    return bool(cues)


def lines_of(page: str) -> list[Line]:
    """Blocks of text in page order, white space folded, references decoded.

    Tags that are not in-line end a block. An element that is dropped ends with its own end
    tag, or where an article begins if it was left open.
    """
    out: list[Line] = []
    piece: list[str] = []
    dropped: list[str] = []  # open elements of the dropped one's name
    containers = 0
    any_container = False

    def flush() -> None:
        if piece:
            text = _BLANKS.sub(" ", html.unescape("".join(piece))).strip()
            if text:
                place = TEMPLATE if dropped else (ARTICLE if containers else OPEN)
                out.append(Line(text, place))
            piece.clear()

    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if found is None:
            piece.append(page[at:])
            break
        if found.start() > at:
            piece.append(page[at:found.start()])
        at = found.end()
        closing, tag = found[1], found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW:
            if not closing:
                flush()
                stop = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        if tag == "br":
            piece.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if closing:
            if dropped:
                if tag == dropped[0]:
                    flush()
                    dropped.pop()
            elif tag in CONTAINERS and containers:
                containers -= 1
            continue
        empty = tag in VOID or found[3].endswith("/")
        attributes = _attributes(found[3])
        if dropped:
            if tag == dropped[0] and not empty:
                dropped.append(tag)
            elif tag in CONTAINERS and not containers and not _drops(tag, attributes, False):
                dropped.clear()
                containers, any_container = 1, True
            continue
        if empty:
            continue
        if _drops(tag, attributes, containers > 0):
            flush()
            dropped.append(tag)
        elif tag in CONTAINERS:
            containers += 1
            any_container = True
    flush()
    if any_container:
        for line in out:
            if line.place == OPEN:
                line.place = BESIDE
    return out


def shared_lines(own: list[int], other: list[int]) -> list[int]:
    """Positions in ``own`` of a longest common subsequence (Hunt and Szymanski)."""
    head = 0
    while head < len(own) and head < len(other) and own[head] == other[head]:
        head += 1
    tail = 0
    while tail < min(len(own), len(other)) - head and own[-1 - tail] == other[-1 - tail]:
        tail += 1
    places = defaultdict(list)
    for j in range(len(other) - tail - 1, head - 1, -1):
        places[other[j]].append(j)
    ends: list[int] = []  # least end in ``other`` of a common subsequence of each length
    links: list = []
    for i in range(head, len(own) - tail):
        for j in places.get(own[i], ()):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k] = j
                links[k] = link
    middle = []
    link = links[-1] if links else None
    while link:
        middle.append(link[0])
        link = link[1]
    return [*range(head), *reversed(middle), *range(len(own) - tail, len(own))]


def _hashes(lines: list[Line]) -> list[int]:
    import xxhash

    return [xxhash.xxh64_intdigest(x.text.encode("utf-8", "replace")) - (1 << 63) for x in lines]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = [lines_of(x or "") for x in batch.column("html").to_pylist()]
        names = [n for n in batch.schema.names if n != "html"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in names] + [
                pa.array([_hashes(x) for x in pages], pa.list_(pa.int64())),
                pa.array([any(y.place == BESIDE for y in x) for x in pages], pa.bool_())],
            [*names, "lines", "beside"])


def _common(a: str, b: str) -> int:
    """Leading path segments two paths share."""
    n = 0
    for x, y in zip(a.split("/"), b.split("/"), strict=False):
        if x != y:
            break
        n += 1
    return n


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, cuts = [], []
        for r in batch.to_pylist():
            others = [(r[f"{w}_path"], r[f"{w}_lines"]) for w in ("before", "after")
                      if r[f"{w}_host"] == r["host"] and r[f"{w}_lines"] != r["lines"]
                      and r[f"{w}_lines"]]
            if not others or not r["lines"]:
                continue
            nearest = max(others, key=lambda x: _common(x[0], r["path"]))[1]
            cut = shared_lines(r["lines"], nearest)
            if cut or r["beside"]:  # an empty cut says that nothing is shared
                keys.append(r["page_key"])
                cuts.append(cut)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(cuts, pa.list_(pa.int32()))], ["page_key", "cut"])


def main_text(lines: list[Line], cut: list[int] | None) -> str:
    """Lines that are neither template by mark-up nor shared with the neighbour.

    Lines beside an article element stay if there was a neighbour that does not share
    them (``cut`` is null without one). Shared lines inside stay: there, neighbours repeat
    each other's content (a quoted passage, a copy of the article), not their template.
    """
    gone = set(cut or ())
    kept = (OPEN,) if cut is None else (OPEN, BESIDE)
    return "\n".join(
        x.text for i, x in enumerate(lines) if x.place == ARTICLE or (x.place in kept and i not in gone))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages, cuts = batch.column("html").to_pylist(), batch.column("cut").to_pylist()
        texts = [main_text(lines_of(p or ""), c) for p, c in zip(pages, cuts, strict=True)]
        yield pa.RecordBatch.from_arrays([
            batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
            pa.array(np.array([len(x) for x in texts], np.int64)),
        ], ["page_id", "url", "text", "n_chars"])


def neighbours(parsed: DataFrame) -> DataFrame:
    """Rows of (page_key, host, path, lines) with those before and after in URL order.

    The rows are sorted by range, so a frequent host spreads over partitions; their places
    are numbered through all partitions, and neighbours meet by number.
    """
    order = ["host", "path", "page_key"]
    ranged = saved(
        parsed.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()), "by_url")
    part = F.shiftrightunsigned("at", 33)
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by their number
    starts = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("first")).select(
        "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    numbered = saved(
        ranged.withColumn("part", part).join(F.broadcast(starts), "part")
        .withColumn("number", F.col("at") + F.col("shift")).drop("part", "at", "shift"), "numbered")

    def beside(name: str, step: int) -> DataFrame:
        return numbered.select(
            (F.col("number") + step).alias("number"),
            *[F.col(c).alias(f"{name}_{c}") for c in ("host", "path", "lines")])

    return numbered.join(beside("before", 1), "number", "left").join(beside("after", -1), "number", "left")


def extract(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per page.

    A null html is empty, its text too. Pages without a host have no neighbour to compare
    with, nor has one that is alone on its host or next to copies of itself; mark-up alone
    decides there. Repeated rows are compared once and each get their row. The page itself
    moves only if the list of cuts is too large to broadcast.
    """
    spark = pages.sparkSession
    small_batches(spark)
    key = F.xxhash64(F.col("page_id"), F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")))
    keyed = pages.select("page_id", "url", "html", key.alias("page_key"))
    url = F.coalesce("url", F.lit(""))
    located = keyed.select("page_key", "html", host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = located.where("host <> ''").mapInArrow(
        _parsed, "page_key long, host string, path string, lines array<long>, beside boolean").dropDuplicates(["page_key"])
    cuts = saved(neighbours(parsed).mapInArrow(_differenced, "page_key long, cut array<int>"), "cuts")
    return keyed.join(cuts, "page_key", "left").select("page_id", "url", "html", "cut").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long")

"""Main text of HTML pages: structure, and differencing against the page with the nearest URL.

A page is cut into blocks of text. Blocks inside an article or main element may be text; blocks inside
navigation, headers, footers, sidebars, forms and elements marked as notices, adverts or comments are
not. Differencing judges every page: a host's pages with different lines are sorted by path, each is paired
with its neighbour, the lines of both are aligned by their longest common subsequence, and shared lines are
what the site repeats. They go from pages without such an element; of several such elements those without a line of
their own go, but for the longest. Deleting lines that two articles share would delete text, so an element
goes or stays whole, and a page's only one always stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retrolane.llm.common import stage
from retrolane.llm.urls import split

# Element names by what they mean for the text.
CONTENT = frozenset({"article", "main"})
OUTSIDE = frozenset(
    {"nav", "header", "footer", "aside", "form", "button", "select", "textarea", "menu", "dialog", "figure", "iframe", "svg", "template"}
)
RAW = frozenset({"script", "style", "noscript", "title", "textarea", "iframe", "template", "xmp", "noframes"})
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})
INLINE = frozenset(
    {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd"}
    | {"label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
)
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|advertisement|adverts|banner|breadcrumb|breadcrumbs|comment|comments|cookie|cookies|consent"
    r"|disqus|footer|header|menu|modal|nav|navbar|navigation|newsletter|notice|notices|popup|promo|promoted|related|respond"
    r"|share|sharing|sidebar|skip|social|sponsor|sponsored|subscribe|toolbar|widget)(?:$|[\s_-])"
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|[^<]+|<",
    re.DOTALL,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
OPEN = 0  # of no content element; those are numbered from 1 on


def blocks(html: str) -> list[tuple[str, int]]:
    """The page's text blocks in order, each with the number of its outermost content element, or OPEN.

    Blocks outside the text are left out. White space inside a block becomes one space. Unclosed elements end with the element around them.
    """
    out: list[tuple[str, int]] = []
    words: list[str] = []
    stack: list[tuple[str, bool]] = []  # names, and whether the element is outside the text
    outside = content = elements = 0
    raw: str | None = None
    at, size = 0, len(html)

    def end_block() -> None:
        if words:
            text = " ".join("".join(words).split())
            words.clear()
            if text and not outside:
                out.append((text, elements if content else OPEN))

    while at < size:
        if raw:
            close = re.compile(rf"</{raw}(?=[\s/>]|\Z)", re.IGNORECASE).search(html, at)
            at = close.start() if close else size
            raw = None
            continue
        match = TOKEN.match(html, at)
        at = match.end()
        name = match.group(2)
        if name is None:
            piece = match.group()
            if not (piece.startswith("<") and len(piece) > 1) and not outside:
                words.append(unescape(piece))
            continue
        name = name.lower()
        if name not in INLINE and name not in RAW:
            end_block()
        elif name in ("br", "wbr", "img"):
            words.append(" " if name == "br" else "")
            continue
        if match.group(1):
            if any(open_ == name for open_, _ in stack):
                while True:
                    gone, out_of = stack.pop()
                    outside -= out_of
                    content -= gone in CONTENT
                    if gone == name:
                        break
            continue
        if name in VOID:
            continue
        attributes = match.group(3)
        if name in RAW:
            if not attributes.rstrip().endswith("/"):
                raw = name
            continue
        if name in ("p", "li", "dt", "dd", "option", "tr", "td", "th"):  # these end the one before, as HTML has it
            while stack and stack[-1][0] in INLINE | {"p"} and any(open_ == name for open_, _ in stack):
                gone, out_of = stack.pop()
                outside -= out_of
                if gone == name:
                    break
        marks = " ".join("".join(found) for found in NAMED.findall(attributes)).lower() if attributes.strip() else ""
        away = name in OUTSIDE or bool(marks and MARKED.search(marks)) or bool(attributes and HIDDEN.search(attributes))
        away = away and name not in ("html", "body") and not (name in CONTENT and name not in OUTSIDE)
        stack.append((name, away))
        outside += away
        elements += name in CONTENT and not content
        content += name in CONTENT
    end_block()
    return out


def shared_lines(mine: list[str], other: list[str]) -> set[int]:
    """Places in mine of a longest common subsequence with other."""
    table = [[0] * (len(other) + 1) for _ in range(len(mine) + 1)]
    for i in range(len(mine) - 1, -1, -1):
        row, below = table[i], table[i + 1]
        for j in range(len(other) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if mine[i] == other[j] else max(below[j], row[j + 1])
    found, i, j = set(), 0, 0
    while i < len(mine) and j < len(other):
        if mine[i] == other[j]:
            found.add(i)
            i, j = i + 1, j + 1
        elif table[i + 1][j] >= table[i][j + 1]:
            i += 1
        else:
            j += 1
    return found


MOST_CELLS = 4_000_000
MOST_TOLD = 1_000_000  # classes of pages that may be broadcast, after counting them


def _row(mine: list[str], other: list[str]) -> list[int]:
    """Lengths of the longest common subsequences of mine with every beginning of other, from bits of one integer."""
    places: dict[str, int] = {}
    for j, line in enumerate(other):
        places[line] = places.get(line, 0) | 1 << j
    mask = (1 << len(other)) - 1
    bits = mask
    for line in mine:
        hit = bits & places.get(line, 0)
        bits = ((bits + hit) | (bits - hit)) & mask
    ends = f"{bits:0{len(other)}b}"[::-1] if other else ""
    return [0, *accumulate(bit == "0" for bit in ends)]


def _aligned(mine: list[str], other: list[str]) -> set[int]:
    """Places in mine of a longest common subsequence with other; large tables are halved until they are small."""
    if len(mine) <= 1 or len(mine) * len(other) <= MOST_CELLS:
        return shared_lines(mine, other)
    half = len(mine) // 2
    above, below = _row(mine[:half], other), _row(mine[half:][::-1], other[::-1])
    cut = max(range(len(other) + 1), key=lambda j: above[j] + below[len(other) - j])
    return _aligned(mine[:half], other[:cut]) | {half + i for i in _aligned(mine[half:], other[cut:])}


def difference(mine: list[str], other: list[str]) -> set[int]:
    """Places of a longest common subsequence; equal ends and lines of one side only are cut off before the table."""
    found: set[int] = set()
    low = 0
    while low < min(len(mine), len(other)) and mine[low] == other[low]:
        found.add(low)
        low += 1
    high, end = len(mine), len(other)
    while high > low and end > low and mine[high - 1] == other[end - 1]:
        high, end = high - 1, end - 1
        found.add(high)
    theirs, ours = set(other[low:end]), set(mine[low:high])
    places = [at for at in range(low, high) if mine[at] in theirs]
    rest = [line for line in other[low:end] if line in ours]
    return found | {places[i] for i in _aligned([mine[at] for at in places], rest)}


def _main(parts: list[tuple[str, int]], shared: set[int] | None) -> str:
    """The text of a page's blocks, given the places that it shares with its neighbour (None: no neighbour).

    Without a content element, what is not shared is text. Of several content elements those are text that
    hold a line of their own, and the longest in any case, so that a near copy of a page keeps its article.
    A line that two pages share inside such an element is text: sharing it doesn't make it part of the site.
    """
    sizes: dict[int, int] = {}
    for text, element in parts:
        if element != OPEN:
            sizes[element] = sizes.get(element, 0) + len(text)
    if sizes:
        kept = {element for i, (_, element) in enumerate(parts) if element != OPEN and i not in (shared or ())}
        kept.add(max(sizes, key=lambda element: sizes[element]))
        return "\n".join(text for text, element in parts if element in kept)
    return "\n".join(text for i, (text, _) in enumerate(parts) if i not in (shared or ()))


def _mark(line: str) -> int:
    return int.from_bytes(blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _structured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, path, lines that may be text and their content elements, digests of each line and of all lines."""
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            part = whole.slice(start, 256)
            hosts, paths, texts, elements, marks, tags = ([] for _ in range(6))
            for link, html in zip(*(part.column(name).to_pylist() for name in ("url", "html")), strict=True):
                host, path = split(link)
                lines = blocks(html or "")
                plain = "\n".join(line for line, _ in lines)
                inside = any(element != OPEN for _, element in lines)
                hosts.append(host)
                paths.append(path.lower())
                texts.append("\n".join(line for line, element in lines if element != OPEN or not inside))
                elements.append([element for _, element in lines])
                marks.append([_mark(line) for line, _ in lines])
                tags.append(blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=16).digest() if lines else None)
            columns = [part.column("page_id").cast(pa.int64()), part.column("url").cast(pa.string())]
            columns += [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(texts, pa.string())]
            columns += [pa.array(elements, pa.list_(pa.int32())), pa.array(marks, pa.list_(pa.int64())), pa.array(tags, pa.binary())]
            names = ["page_id", "url", "host", "path", "text", "elements", "marks", "tag"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the lines (mine) that a class of pages shares with its neighbour (theirs)."""
    for batch in batches:
        both = zip(batch.column("mine").to_pylist(), batch.column("theirs").to_pylist(), strict=True)
        shared = pa.array([sorted(difference(mine, theirs)) for mine, theirs in both], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("tag"), shared], names=["host", "tag", "shared"])


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts that are left of the pages' lines by structure and differencing."""
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            texts = []
            for text, elements, shared in zip(*(batch.column(name).to_pylist() for name in ("text", "elements", "shared")), strict=True):
                lines = iter(text.split("\n"))
                inside = any(elements)
                parts = [(next(lines) if element != OPEN or not inside else "", element) for element in elements]
                texts.append(_main(parts, None if shared is None else set(shared)))
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])


def _told(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= MOST_TOLD else rows


def _neighbours(classes: DataFrame) -> DataFrame:
    """(host, tag, other): for each class (host, tag, first) the one before it on its host, or after the first.

    Classes are dealt in slices of the order, so that no host is sorted in one task; the borders of a host's
    slices, two rows each, tell what a slice can't see.
    """
    slices = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = classes.repartitionByRange(slices, "host", "first", "tag").withColumn("slice", F.spark_partition_id())
    dealt = stage(dealt, "classes")
    order = Window.partitionBy("host", "slice").orderBy("first", "tag")
    inside = dealt.select("host", "slice", "tag", F.lag("tag").over(order).alias("before"), F.lead("tag").over(order).alias("after"))
    place = F.struct("first", "tag")
    borders = dealt.groupBy("host", "slice").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    order = Window.partitionBy("host").orderBy("slice")
    borders = borders.select("host", "slice", F.lag("high.tag").over(order).alias("last"), F.lead("low.tag").over(order).alias("next"))
    other = F.coalesce("before", "last", "after", "next").alias("other")
    return inside.join(borders, ["host", "slice"]).select("host", "tag", other).where("other is not null")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages (page_id, url, html).

    text holds the main text's blocks joined by newlines, n_chars its code points; it is empty where
    there is none, as for null and empty pages. Pages of a host with equal lines are one, placed where the
    first of them stands in the order of path and page_id. Every such page is compared with the one before it in
    this order, or the next one if it is the host's first; all its copies are judged by the same shared lines.
    Pages without lines and pages without host are compared with none. Rows with null ids or URLs and repeated
    rows are treated like others. Other columns are ignored.
    """
    schema = "page_id long, url string, host string, path string, text string, elements array<int>, marks array<long>, tag binary"
    all_ = stage(pages.select("page_id", "url", "html").mapInArrow(_structured, schema), "pages")
    classes = all_.where("tag is not null and host <> ''").groupBy("host", "tag")
    classes = classes.agg(F.min(F.struct("path", "page_id")).alias("first"), F.min("marks").alias("marks"))
    classes = stage(classes, "lines")
    marks = classes.select("host", "tag", "marks")
    pairs = _neighbours(classes.select("host", "tag", "first")).join(marks.withColumnRenamed("marks", "mine"), ["host", "tag"])
    pairs = pairs.join(marks.select("host", F.col("tag").alias("other"), F.col("marks").alias("theirs")), ["host", "other"])
    shared = pairs.select("host", "tag", "mine", "theirs").mapInArrow(_differenced, "host string, tag binary, shared array<int>")
    shared = _told(stage(shared, "shared"))
    judged = all_.join(shared, ["host", "tag"], "left").select("page_id", "url", "text", "elements", "shared")
    out = judged.mapInArrow(_judged, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))

"""Main text of web pages: lines of each page differenced against the page with the nearest URL on its host."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffcast.llm.common import free_name, numbered, read_table
from staffcast.llm.url_trees import host_of, path_of
from staffcast.staging import stage

SENT_CELLS = 1_000_000  # numbers and flags broadcast at most

# Where a line stands: in an article, outside of any marked part, or in a part that is no main text.
ARTICLE, PLAIN, ASIDE = 2, 1, 0

DROPPED = {"script", "style", "noscript", "template", "svg", "iframe", "object", "head", "title", "select", "textarea", "button"}
ASIDE_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
ARTICLE_TAGS = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul br".split()
)
# Words of class, id and role attributes that mark a part as no main text.
ASIDE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|contentinfo|discussion|disclaimer|footer|header|masthead|menu|"
    r"modal|nav\w*|newsletter|notices?|popup|promo\w*|related|replies|reply|respond|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-]|\d)",
    re.I,
)
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
SPACE = re.compile(r"\s+")


def _kind(tag: str, attributes: str) -> int | None:
    """What a tag makes of its content; None: what surrounds it."""
    if tag in ASIDE_TAGS:
        return ASIDE
    if attributes and tag not in ("html", "body"):
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            value, name = a or b or c, name.lower()
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name not in ("hidden", "aria-hidden") and ASIDE_WORDS.search(value):
                return ASIDE
    return ARTICLE if tag in ARTICLE_TAGS else None


def lines_of(page: str) -> list[tuple[str, int]]:
    """(text, kind) of each line of a page: blocks and ``br`` part lines; references are decoded, white space is one space.

    Unclosed tags end with their parent, as a browser has it; a tag left open at the end reaches to the end.
    """
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = [("", PLAIN)]
    at = 0

    def close_line() -> None:
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                out.append((text, stack[-1][1]))

    size = len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in DROPPED:
            if not m[1]:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if tag in ("head", "button", "select"):
                    # What it holds is markup; without an end tag it ends where the body begins.
                    end = end or re.compile(r"(?=<body\b)", re.I).search(page, at)
                    at = end.end() if end else at
                else:
                    at = end.end() if end else size
            continue
        if tag in BLOCKS:
            close_line()
        if tag in VOID:
            continue
        if not m[1]:
            kind = _kind(tag, m[3])
            if kind is not None and not m[3].endswith("/"):
                above = stack[-1][1]
                stack.append((tag, above if above == ASIDE else kind))
            elif tag in ("div", "section", "article", "main", "table", "ul", "ol", "blockquote", "figure", "details", "span", "body"):
                if not m[3].endswith("/"):
                    stack.append((tag, stack[-1][1]))
        else:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
    close_line()
    return out


def common_lines(a: list, b: list) -> np.ndarray:
    """Which entries of ``a`` a longest common subsequence of both lists holds."""
    shared = np.zeros(len(a), bool)
    low, high_a, high_b = 0, len(a), len(b)
    while low < min(high_a, high_b) and a[low] == b[low]:
        shared[low] = True
        low += 1
    while high_a > low and high_b > low and a[high_a - 1] == b[high_b - 1]:
        high_a, high_b = high_a - 1, high_b - 1
        shared[high_a] = True
    among_b, among_a = set(b[low:high_b]), set(a[low:high_a])
    x = [i for i in range(low, high_a) if a[i] in among_b]
    y = [i for i in range(low, high_b) if b[i] in among_a]
    if not x or not y:
        return shared
    for i, _ in _matches([a[i] for i in x], [b[i] for i in y]):
        shared[x[i]] = True
    return shared


def _matches(a: list, b: list) -> Iterator[tuple[int, int]]:
    """Places in ``a`` and ``b`` of a longest common subsequence, last first.

    A row of the length table is one number: bit j is clear where the length grows at ``b[j]``. Only the first row of
    each block is kept, and the way back makes the rows of a block again, so memory doesn't follow the product of lengths.
    """
    places: dict = {}
    for j, v in enumerate(b):
        places.setdefault(v, []).append(j)
    whole, frequent = (1 << len(b)) - 1, {}

    def bits(v) -> int:
        if v in frequent:
            return frequent[v]
        own = places.get(v, ())
        out = bytearray(len(b) // 8 + 1)
        for j in own:
            out[j >> 3] |= 1 << (j & 7)
        found = int.from_bytes(out, "little")
        if len(own) > 64:
            frequent[v] = found
        return found

    def after(row: int, v) -> int:
        hit = row & bits(v)
        return (row + hit | row - hit) & whole

    step = math.isqrt(len(a)) + 1
    firsts, row = [], whole
    for i, v in enumerate(a):
        if i % step == 0:
            firsts.append(row)
        row = after(row, v)
    j = len(b)
    for block in reversed(range(len(firsts))):
        begin = block * step
        rows = [firsts.pop()]
        for v in a[begin : begin + step]:
            rows.append(after(rows[-1], v))
        for i in reversed(range(begin, begin + len(rows) - 1)):
            if not j:
                return
            below = (1 << j) - 1
            grows = ~rows[i - begin + 1] & below
            if grows.bit_count() > (~rows[i - begin] & below).bit_count():
                j = grows.bit_length() - 1
                yield i, j


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            pages = [lines_of(p or "") for p in part.column("html").to_pylist()]
            hashes = [[digest(t) - (1 << 63) for t, _ in lines] for lines in pages]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("kept"), part.column("host"), part.column("path"),
                    pa.array([[t for t, _ in lines] for lines in pages], pa.list_(pa.string())),
                    pa.array([[k for _, k in lines] for lines in pages], pa.list_(pa.int8())),
                    pa.array(hashes, pa.list_(pa.int64())),
                ],
                names=["kept", "host", "path", "lines", "kinds", "hashes"],
            )


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own, other, kinds = (batch.column(c).to_pylist() for c in ("hashes", "other", "kinds"))
        shared = [common_lines(a, b) for a, b in zip(own, other, strict=True)]
        deletes = [bool((s & (np.array(k, np.int8) == PLAIN)).any()) for s, k in zip(shared, kinds, strict=True)]
        columns = [batch.column("row"), pa.array([s.tolist() for s in shared], pa.list_(pa.bool_())), pa.array(deletes)]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "shared", "deletes"])


def neighbours(pages: DataFrame) -> DataFrame:
    """``row, hashes, kinds, other``: each page and the lines of the page of its host whose path shares the longest beginning with its own.

    Pages are sorted by host and path over all tasks and numbered; the nearest page is the one before or after, so
    two joins on the number find it. No task holds a host. Pages with the same lines are one page here: a copy
    says nothing about which lines are a frame's.
    """
    single = pages.groupBy("host", F.xxhash64("hashes").alias("lines")).agg(F.min(F.struct("path", "row")).alias("first"), F.first("hashes").alias("hashes"))
    order = stage(
        single.select("host", "lines", F.col("first.path").alias("path"), "hashes")
        .repartitionByRange("host", "path", "lines").sortWithinPartitions("host", "path", "lines")
        .withColumn("id", F.monotonically_increasing_id()), "sorted-pages",
    )
    # Numbers without gaps: the count of all rows in earlier partitions, plus the place in the partition.
    part, place = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = {r["part"]: r["n"] for r in order.groupBy(part.alias("part")).agg((F.max(place) + 1).alias("n")).collect()}
    before, total = [], 0
    for p in sorted(counts):
        before += [(p, total)]
        total += counts[p]
    starts = order.sparkSession.createDataFrame(before, "part long, before long")
    numbers = order.withColumn("part", part).join(F.broadcast(starts), "part").select((F.col("before") + place).alias("n"), "host", "path", "lines", "hashes")
    numbers = stage(numbers, "numbered-pages")
    near = numbers.select(F.explode(F.array(F.col("n") - 1, F.col("n") + 1)).alias("n"), F.struct(F.col("host"), F.col("path"), F.col("hashes"), F.col("n").alias("at")).alias("other"))
    both = numbers.join(near, "n").where(F.col("other.host") == F.col("host"))
    same = _same_beginning(F.col("path"), F.col("other.path"))
    best = both.groupBy("n").agg(F.max(F.struct(same.alias("same"), (-F.col("other.at")).alias("first"), F.col("other.hashes").alias("other"))).alias("best"))
    chosen = numbers.join(best, "n").select("host", "lines", F.col("best.other").alias("other"))
    return pages.withColumn("lines", F.xxhash64("hashes")).join(chosen, ["host", "lines"]).select("row", "hashes", "kinds", "other")


def _same_beginning(a: Column, b: Column) -> Column:
    """Number of leading path segments that two paths share."""
    pairs = F.arrays_zip(F.split(a, "/").alias("a"), F.split(b, "/").alias("b"))
    step = lambda s, x: F.when((s >= 0) & x["a"].eqNullSafe(x["b"]), s + 1).otherwise(F.when(s >= 0, -s - 1).otherwise(s))
    found = F.aggregate(pairs, F.lit(0), step)
    return F.when(found < 0, -found - 1).otherwise(found)


def main_text(pages: DataFrame, url_column: str, html_column: str, keep: list[str]) -> DataFrame:
    """``kept, text, n_chars``: the lines of each page's main text, joined by line breaks, beside the columns in ``keep``.

    Lines in menus, headers, footers, sidebars, notices, adverts, forms and comments go, as tags, classes, ids and roles show
    them; so do scripts, styles and markup. Lines in ``article`` or ``main`` stay. Of the lines that no such part
    holds, those go that a longest common subsequence shares with the nearest page of the host; where a page has
    no other beside it, all of these stay. Pages that hold the same lines are not compared with each other.

    Null and empty html give an empty text; null urls, and those without a host, count as one host. Repeated rows each have a
    row; other columns are ignored; an empty table gives an empty result. Extracted lines are written once; the pairing
    and the alignment move line hashes alone, and texts only where the alignment deletes lines of many pages.
    """
    row = free_name(pages, "_row")
    url = F.col(url_column).cast("string")
    rows = numbered(pages, row).select(
        F.struct(F.col(row).alias("row"), *[F.col(c).alias(f"keep_{c}") for c in keep]).alias("kept"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html_column).cast("string").alias("html")
    )
    kept_type = rows.schema["kept"].dataType.simpleString()
    lines = stage(
        rows.mapInArrow(_extract, f"kept {kept_type}, host string, path string, lines array<string>, kinds array<tinyint>, hashes array<long>"), "lines"
    )
    paired = neighbours(lines.select(F.col("kept.row").alias("row"), "host", "path", "hashes", "kinds"))
    shared = stage(paired.mapInArrow(_differences, "row long, shared array<boolean>, deletes boolean").where("deletes").drop("deletes"), "differences")
    # What the alignment deletes is joined to the lines; few pages of bounded length are sent to all tasks instead.
    size = shared.agg(F.count("row").alias("n"), F.sum(F.size("shared")).alias("cells")).first()
    few = size["n"] + (size["cells"] or 0) <= SENT_CELLS
    joined = lines.withColumn("row", F.col("kept.row")).join(F.broadcast(shared) if few else shared, "row", "left")
    stays = lambda x: (x["kinds"] == ARTICLE) | ((x["kinds"] == PLAIN) & ~F.coalesce(x["shared"], F.lit(False)))
    zipped = F.arrays_zip("lines", "kinds", F.coalesce("shared", F.transform("kinds", lambda k: F.lit(False))).alias("shared"))
    text = F.array_join(F.transform(F.filter(zipped, stays), lambda x: x["lines"]), "\n")
    return joined.select("kept", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))


def op6_page_lines(spark, sf_dir: str) -> DataFrame:
    found = main_text(read_table(spark, sf_dir, "pages"), "url", "html", ["page_id", "url"])
    return found.select(F.col("kept.keep_page_id").alias("page_id"), F.col("kept.keep_url").alias("url"), "text", "n_chars")

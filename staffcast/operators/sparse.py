"""Encoded rows as cells, for any number of columns: ``key, target, position, value``.

A column is known by ``source`` and ``value`` (a number column by its name, with an empty source) and has a position in a staged
table. Number columns have a cell in every row, NULL if missing; columns made from values, which count them, have cells only
where the count isn't 0. Statistics, scaling, correlations and the two feature filters are aggregates and joins over cells, so no
plan, task or driver has anything of the width of the table, save the vectors that a forest reads.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffcast.functions.wide import quoted
from staffcast.operators.quantiles import group_quantiles
from staffcast.staging import lookup_join, stage

# The functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_PAIRS = 2_000_000
TABLE_PAIRS = 4_000_000  # pairs of columns of a batch that are counted in a table; more are sorted


def numbered_in_order(df: DataFrame, order: Sequence[str | Column], name: str, first: int = 0) -> DataFrame:
    """``df`` with numbers from ``first`` on in the given order, counted over range partitions, so no task holds all rows."""
    sorted_rows = stage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["_part"]: r["n"] for r in sorted_rows.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).collect()}
    before, total = [], first
    for p in sorted(sizes):
        before.append((p, total))
        total += sizes[p]
    starts = df.sparkSession.createDataFrame(before, "_part long, _before long")
    joined = sorted_rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return stage(joined.select(*[quoted(c) for c in df.columns], (F.col("_before") + place).alias(name)), "numbered")


# ---- encoding ----------------------------------------------------------------------


def _pair(source: str, value: Column) -> Column:
    return F.struct(F.lit(source).alias("source"), value.cast("string").alias("value"))


def _entries(source: str, column: str) -> Column:
    return F.transform(F.coalesce(quoted(column), F.array().cast("array<string>")), lambda v: _pair(source, v))


def value_lists(columns: Sequence[str], lists: Mapping[str, str]) -> Column:
    """Array of (source, value) of a row: of text columns by their value, and of list columns (source -> column) by each entry."""
    own = [F.array(_pair(c, F.col(quoted(c)))) for c in columns] + [_entries(source, c) for source, c in lists.items()]
    every = F.concat(*own) if own else F.array().cast("array<struct<source:string,value:string>>")
    return F.filter(every, lambda p: p["value"].isNotNull())


def fit_positions(df: DataFrame, numbers: Sequence[str], values: Column) -> DataFrame:
    """Staged table ``source, value, position``: the number columns first, then all values in order."""
    base = df.sparkSession.createDataFrame([("", c, i) for i, c in enumerate(numbers)], "source string, value string, position long")
    found = df.select(F.inline(values)).distinct()
    return stage(base.unionByName(numbered_in_order(found, ["source", "value"], "position", len(numbers))), "positions")


def encode(df: DataFrame, key: str, target: str, numbers: Sequence[str], values: Column, positions: DataFrame) -> DataFrame:
    """Cells of the rows of ``df``; values that ``positions`` doesn't know have none."""
    places = {r["value"]: r["position"] for r in positions.filter("source = ''").collect()}
    dense = F.array(
        *[F.struct(F.lit(places[c]).cast("long").alias("position"), F.col(quoted(c)).cast("double").alias("value")) for c in numbers if c in places]
    )
    head = [F.col(quoted(key)), F.col(quoted(target))]
    base = df.select(*head, F.inline(dense))
    known = positions.filter("source <> ''").select("source", "value", "position")
    # Entries are counted before the shuffle, so it carries the different values of a row.
    counted = df.select(*head, F.inline(values)).groupBy(*head, "source", "value").agg(F.count("*").alias("n"))
    met = lookup_join(counted, known, ["source", "value"], how="inner")
    return base.unionByName(met.select(*head, "position", F.col("n").cast("double").alias("value")))


# ---- statistics and scaling -----------------------------------------------------------

def _finite() -> Column:
    """The value of a cell, NULL if it is missing or infinite."""
    return F.when(F.abs("value") < float("inf"), F.col("value"))


def column_stats(cells: DataFrame, rows: int, numbers: int) -> DataFrame:
    """Staged ``position, n, mean, least, greatest`` of all positions that have cells; an infinite value counts as missing.

    ``rows`` is the number of rows, ``numbers`` that of the number columns, which are the first positions.
    """
    value = _finite()
    sums = cells.groupBy("position").agg(
        F.count("*").alias("cells"), F.count(value).alias("present"), F.sum(value).alias("s"), F.min(value).alias("least"),
        F.max(value).alias("greatest"),
    )
    some_zero = (F.col("position") >= numbers) & (F.col("cells") < rows)
    n = F.when(F.col("position") >= numbers, F.lit(rows)).otherwise(F.col("present"))
    return stage(
        sums.select(
            "position", n.alias("n"), F.try_divide("s", n).alias("mean"),
            F.when(some_zero, F.least("least", F.lit(0.0))).otherwise(F.col("least")).alias("least"), "greatest",
        ),
        "cell_stats",
    )


def scaled_vectors(cells: DataFrame, key: str, target: str, selected: DataFrame, width: int) -> DataFrame:
    """``key, target, features``: a sparse vector of each row, staged.

    ``selected`` has ``position, place, least, greatest``: the cell's place in the vector and its bounds. A value becomes its part of the
    way between the bounds, 0 where they are equal; a missing or infinite one counts as 0.
    """
    met = lookup_join(cells, selected.select("position", "place", "least", "greatest"), ["position"], how="inner")
    span = F.col("greatest") - F.col("least")
    shifted = _finite() - F.col("least")
    scaled = F.when(span == 0, shifted).otherwise(shifted / span)
    entry = F.when(F.coalesce(scaled, F.lit(0.0)) != 0, F.struct(F.col("place").cast("int").alias("i"), scaled.alias("x")))
    head = cells.select(key, target).distinct()
    lists = met.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("_c"))
    none = F.array().cast("array<struct<i:int,x:double>>")
    filled = head.join(lists, key, "left").withColumn("_c", F.coalesce("_c", none))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(width).alias("size"),
        F.transform("_c", lambda c: c["i"]).alias("indices"), F.transform("_c", lambda c: c["x"]).alias("values"),
    )
    return as_vectors(filled.select(key, target, vector.alias("features")), "features")


def as_vectors(df: DataFrame, column: str) -> DataFrame:
    """A column of (type, size, indices, values) read back as vectors: these are stored in just that form."""
    fields = [T.StructField(f.name, VectorUDT()) if f.name == column else f for f in df.schema]
    return stage(df, "vectors", T.StructType(fields))


# ---- feature filters --------------------------------------------------------------------


def target_related(cells: DataFrame, target: str, numbers: int, stats: DataFrame, quantile: float) -> DataFrame:
    """Staged ``position, strength`` of the columns whose absolute correlation with the target reaches the quantile of all such values.

    Rows where a column is missing take no part in its correlation; the target's own 1.0 takes part in the quantile, constant columns don't.
    """
    t = F.col(target).cast("double")
    rows = cells.filter((F.col("position") == 0) & t.isNotNull()) if numbers else cells.select("position", target).limit(0)
    total = rows.agg(F.count("*").alias("n"), F.sum(t).alias("t"), F.sum(t * t).alias("tt")).first()
    if not total["n"]:
        return stage(cells.select("position", F.lit(0.0).alias("strength")).limit(0), "related")
    # Number columns are shifted by their mean, so that sums of squares keep their digits; the others are small counts.
    shift = F.when(F.col("position") < numbers, F.col("mean")).otherwise(0.0)
    shifted = lookup_join(cells.filter(t.isNotNull()), stats.select("position", "mean"), ["position"], how="inner")
    x = _finite() - shift
    absent = x.isNull()
    sums = shifted.groupBy("position").agg(
        F.sum(x).alias("x"), F.sum(x * x).alias("xx"), F.sum(x * t).alias("xt"), F.min(x).alias("least"), F.max(x).alias("greatest"),
        F.count_if(absent).alias("m"), F.sum(F.when(absent, t)).alias("mt"), F.sum(F.when(absent, t * t)).alias("mtt"), F.count("*").alias("cells"),
    )
    n = F.lit(float(total["n"])) - F.col("m")
    st, stt = total["t"] - F.coalesce("mt", F.lit(0.0)), total["tt"] - F.coalesce("mtt", F.lit(0.0))
    zeros = (F.col("position") >= numbers) & (F.col("cells") < total["n"])
    varies = F.when(zeros, F.greatest("greatest", F.lit(0.0)) > F.least("least", F.lit(0.0))).otherwise(F.col("greatest") > F.col("least"))
    cross = n * F.col("xt") - F.col("x") * st
    spread = (n * F.col("xx") - F.col("x") * F.col("x")) * (n * stt - st * st)
    r = F.when(varies & (spread > 0), F.abs(cross / F.sqrt(spread)))
    # Rounded, so that columns that are alike in all rows come out as equally strong.
    strength = stage(sums.select("position", F.round(r, 9).alias("strength")).filter("strength IS NOT NULL"), "strengths")
    constant = total["n"] * total["tt"] == total["t"] ** 2
    own = strength.sparkSession.createDataFrame([] if constant else [(-1, 1.0)], "position long, strength double")
    cut = group_quantiles(strength.unionByName(own).withColumn("g", F.lit(1)), ["g"], "strength", [quantile]).first()
    return stage(strength.filter(F.col("strength") >= (cut["q"][0] if cut else 2.0)), "related")


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), *[(c, pa.float64()) for c in ("xy", "ab", "aab", "ba", "bba", "mm")]])


def _may_reach(parts: dict, left: np.ndarray, right: np.ndarray, numbers: int, rows: float, cut: float) -> np.ndarray:
    """Whether the pairs of the columns at ``left`` and ``right``, the first not being the later one, can have a correlation of ``cut``."""
    both = parts["position"][left] >= numbers
    s, d, g = (parts[f] for f in ("s", "d", "g"))
    with np.errstate(all="ignore"):
        mean = s[left] * s[right] / rows
        top = np.minimum(g[left] * s[right], g[right] * s[left]) - mean
        reach = np.maximum(top, mean) / (d[left] * d[right])
    return ~both | (reach >= cut * (1 - 1e-9))


def _pair_sums(batches: Iterator[pa.RecordBatch], numbers: int, rows: float, cut: float) -> Iterator[pa.RecordBatch]:
    """Sums of products of a task's rows for all pairs of cells that a row holds and whose bound reaches ``cut``.

    Columns of counts have no missing cells and nothing below 0, so with sum S, deviation D and largest value G their sum of products
    lies between 0 and min(G * S', G' * S). Where neither end gives a correlation of ``cut``, the pair is left out.
    """
    for batch in batches:
        lists = batch.column("cells")
        flat = lists.flatten()
        counts = np.diff(np.asarray(lists.offsets))
        parts = {f: np.asarray(flat.field(f)) for f in ("position", "s", "d", "g")}
        x = np.asarray(flat.field("x").fill_null(0.0))
        missing = np.asarray(flat.field("x").is_null())
        ends = np.cumsum(counts)
        squares = np.cumsum(counts.astype(np.int64) ** 2)
        used, first, own_place = np.unique(parts["position"], return_index=True, return_inverse=True)
        # Bounds hang on the columns alone, so a batch of few columns needs each pair's once.
        table = len(used) ** 2 <= TABLE_PAIRS
        reaches = _may_reach({f: parts[f][first] for f in parts}, *(i.ravel() for i in np.indices((len(used),) * 2)), numbers, rows, cut) if table else None
        at = 0
        while at < len(counts):
            # Some rows at a time, so that their pairs stay few.
            before = squares[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(squares, before + BATCH_PAIRS, "right")))
            own = np.arange(ends[at] - counts[at], ends[to - 1])
            # Cells of a row lie in order of position; each is paired with those after it.
            after = np.repeat(ends[at:to], counts[at:to]) - own - 1
            left = np.repeat(own, after)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
            at = to
            keep = reaches[own_place[left] * len(used) + own_place[right]] if table else _may_reach(parts, left, right, numbers, rows, cut)
            left, right = left[keep], right[keep]
            which = own_place[left] * len(used) + own_place[right]
            if table and len(used) ** 2 <= 4 * len(which):
                # Counted in their places without being sorted.
                pairs, size = np.flatnonzero(np.bincount(which, minlength=len(used) ** 2)), len(used) ** 2
                held = pairs
            else:
                pairs, which = np.unique(which, return_inverse=True)
                size, held = len(pairs), slice(None)
            add = lambda v, at=slice(None), which=which, size=size, held=held: np.bincount(which[at], weights=v, minlength=size)[held]
            # Few cells are missing, so the sums over those pairs read only them.
            ma, mb = (np.flatnonzero(missing[side]) for side in (left, right))
            a, b, mm = x[left[mb]], x[right[ma]], ma[missing[right[ma]]]
            columns = [
                used[pairs // len(used)], used[pairs % len(used)], add(x[left] * x[right]), add(a, mb), add(a * a, mb),
                add(b, ma), add(b * b, ma), add(np.ones(len(mm)), mm),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PAIRS, strict=True)], schema=PAIRS)


def not_redundant(cells: DataFrame, key: str, related: DataFrame, stats: DataFrame, names: DataFrame, numbers: int, rows: int, cut: float) -> DataFrame:
    """Staged ``position, strength, source, value`` of the related columns without a correlation of ``cut`` to any earlier one, kept or not.

    Earlier means stronger, or as strong with a smaller name. Correlations are pairwise complete over all rows. Only pairs that can
    reach ``cut`` are added up: those that a row holds together, within bounds, in :func:`_pair_sums`; and those that no row
    does, whose sum of products is 0, where two counts are both frequent enough.
    """
    wanted = lookup_join(related, names.select("source", "value", "position"), ["position"], how="inner")
    wanted = stage(wanted.withColumn("name", F.concat_ws("_", F.when(F.col("source") != "", F.col("source")), "value")), "wanted")
    shift = F.when(F.col("position") < numbers, F.col("mean")).otherwise(0.0)
    used = lookup_join(wanted.select("position"), stats.select("position", shift.alias("shift"), "least", "greatest"), ["position"], how="inner")
    # Shifted and divided by their range, squares of very large and very small numbers add up alike.
    span = F.greatest("greatest", F.lit(0.0)) - F.when(F.col("position") < numbers, F.col("least")).otherwise(0.0)
    used = stage(used.select("position", "shift", F.when(span > 0, span).otherwise(1.0).alias("span")), "shifts")
    x = (_finite() - F.col("shift")) / F.col("span")
    mine = stage(lookup_join(cells, used, ["position"], how="inner").select(key, "position", x.alias("x")), "shifted")
    sums = mine.groupBy("position").agg(
        F.coalesce(F.sum("x"), F.lit(0.0)).alias("s"), F.coalesce(F.sum(F.col("x") * F.col("x")), F.lit(0.0)).alias("ss"),
        F.coalesce(F.max("x"), F.lit(0.0)).alias("g"), F.count_if(F.col("x").isNull()).cast("double").alias("m"),
    )
    total = float(rows)
    deviation = F.sqrt(F.greatest(F.col("ss") - F.col("s") * F.col("s") / (total - F.col("m")), F.lit(0.0)))
    sums = stage(sums.withColumn("d", F.when(F.col("m") < total, deviation).otherwise(0.0)), "sums")
    entry = F.struct("position", "x", "s", "d", "g")
    lists = lookup_join(mine, sums.select("position", "s", "d", "g"), ["position"], how="inner")
    lists = lists.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("cells"))
    made = lists.select("cells").mapInArrow(
        lambda b: _pair_sums(b, numbers, total, cut), "a long, b long, xy double, ab double, aab double, ba double, bba double, mm double"
    )
    added = ("xy", "ab", "aab", "ba", "bba", "mm")
    pairs = stage(made.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in added]), "pair_sums")
    # Two counts that never meet have a correlation of -u * u' with u = S / sqrt(n) / D; one of them needs u >= sqrt(cut).
    u = sums.filter(F.col("position") >= numbers).select("position", F.try_divide(F.col("s") / math.sqrt(total), "d").alias("u"))
    u = stage(u.filter("u > 0"), "apart")
    # A count with such a u is not 0 in a share of cut / (1 + cut) of the rows at least, so there are at most some twice as many as a
    # row holds cells on average.
    often = [F.struct(F.lit(r["position"]).alias("p"), F.lit(r["u"]).alias("v")) for r in u.filter(F.col("u") >= math.sqrt(cut) * (1 - 1e-9)).collect()]
    fits = lambda o: (F.col("u") * o["v"] >= cut * (1 - 1e-9)) & (F.col("position") != o["p"])
    frequent = F.array(*often) if often else F.array().cast("array<struct<p:bigint,v:double>>")
    apart = u.select("position", F.inline(F.filter(frequent, fits)))
    apart = apart.select(F.least("position", "p").alias("a"), F.greatest("position", "p").alias("b")).distinct()
    apart = apart.join(pairs, ["a", "b"], "left_anti")
    every = pairs.unionByName(apart.select("a", "b", *[F.lit(0.0).alias(c) for c in added]))

    facts = lookup_join(wanted.select("position", "strength", "name"), sums, ["position"], how="inner")
    facts = stage(facts, "facts")
    for side in ("a", "b"):
        fields = ("strength", "name", "s", "ss", "m")
        every = lookup_join(every, facts.select(F.col("position").alias(side), *[F.col(f).alias(f"{side}_{f}") for f in fields]), [side], how="inner")
    n = total - F.col("a_m") - F.col("b_m") + F.col("mm")
    sa, sb = F.col("a_s") - F.col("ab"), F.col("b_s") - F.col("ba")
    va, vb = F.col("a_ss") - F.col("aab") - sa * sa / n, F.col("b_ss") - F.col("bba") - sb * sb / n
    # What is left of a constant column after subtracting its mean is rounding, not spread.
    r = F.when((n > 1) & (va > 1e-13 * n) & (vb > 1e-13 * n), F.abs((F.col("xy") - sa * sb / n) / F.sqrt(va * vb)))
    a_first = (F.col("a_strength") > F.col("b_strength")) | ((F.col("a_strength") == F.col("b_strength")) & (F.col("a_name") < F.col("b_name")))
    dropped = every.filter(r >= cut).select(F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("position")).distinct()
    return stage(wanted.join(dropped, "position", "left_anti"), "not_redundant")

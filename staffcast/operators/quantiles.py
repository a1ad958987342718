"""Exact linear-interpolation quantiles that hold at any group size.

Groups up to ``state_rows`` rows are counted by value in the state of one aggregate. Larger ones are solved by narrowing: one mergeable
aggregate counts a group's values in :data:`BUCKETS` equal parts of its range, with the least and greatest value of each; the part that
holds a wanted rank is the next range, until it is a single value; a range of few rows is counted by value at once. Parts are taken of the order of all doubles, by their bits, so nine
passes are enough for any values, and three or four for most. Each pass narrows all groups and ranks at once and shuffles
counts, not rows; no step sorts or gathers a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffcast.staging import lookup_join, stage

STATE_ROWS = 100_000
BUCKETS = 1024
COUNTED_ROWS = 16_384  # in a range that is counted by value


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    state_rows: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Quantiles of ``value`` per group: columns ``keys``, ``n`` and ``q`` (array in order of ``probs``).

    Rows with a missing value are ignored; groups without any value do not appear. ``sizes``, if known, has ``keys`` and the rows ``n`` of
    each group, its least value ``low`` and greatest ``high``. ``df`` is read several times where a group is large.
    """
    state_rows = STATE_ROWS if state_rows is None else state_rows
    keys, probs = list(keys), [float(p) for p in probs]
    rows = df.select(*keys, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    if sizes is None:
        sizes = stage(rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high")), "sizes")
    large = sizes.filter(F.col("n") > state_rows)
    if large.isEmpty():
        return _in_state(rows, keys, probs)
    large = stage(large.select(*keys, "n", "low", "high"), "large")
    marked = lookup_join(rows, large.select(*keys, "n"), keys, null_safe=True)
    small = _in_state(marked.filter(F.col("n").isNull()), keys, probs)
    counted = min(COUNTED_ROWS, state_rows)
    return small.unionByName(_by_narrowing(marked.filter(F.col("n").isNotNull()).select(*keys, "_x"), large, keys, probs, counted))


def column_quantiles(
    df: DataFrame, probs: Mapping[str, Sequence[float]], state_rows: int | None = None
) -> dict[str, list[float] | None]:
    """Quantiles of whole columns: a few numbers per column, ``None`` for a column without values."""
    state_rows = STATE_ROWS if state_rows is None else state_rows
    columns = list(probs)
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    if max(counts) <= state_rows:
        row = df.agg(*[F.percentile(c, _prob_array(probs[c])).alias(c) for c in columns]).first()
        return {c: None if row[c] is None else list(row[c]) for c in columns}
    every = sorted({p for ps in probs.values() for p in ps})
    long = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    )
    found = {r["column"]: r["q"] for r in group_quantiles(long, ["column"], "value", every, state_rows).collect()}
    at = {p: i for i, p in enumerate(every)}
    return {c: [found[c][at[p]] for p in probs[c]] if c in found else None for c in columns}


def _prob_array(probs):
    return F.array(*[F.lit(float(p)) for p in probs])


def _between(low: Column, high: Column, position: Column) -> Column:
    """Linear interpolation between the values around a position."""
    weight = position - F.floor(position)
    return F.when(low == high, low).otherwise(low * (1 - weight) + high * weight)


def _in_state(rows: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Quantiles of groups of bounded size: values are counted before the shuffle and ranked in the state of one aggregate."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile("_x", _prob_array(probs)).alias("q"))


def _order(value: str) -> Column:
    """A whole number that rises with a number: its bits, those of negative ones turned round."""
    bits = f"CAST(java_method('java.lang.Double', 'doubleToLongBits', {value} + 0.0D) AS BIGINT)"
    return F.expr(f"CASE WHEN {bits} < 0 THEN {bits} ^ 9223372036854775807L ELSE {bits} END")


def _bucket() -> Column:
    """Part of the range ``from`` to ``to`` in which ``at`` lies: the first and last for the ends, equal steps between them."""
    # Halves, as the width of a range may be more than a whole number holds.
    step = f"((shiftright(to, 1) - shiftright(from, 1)) div {BUCKETS - 2} + 1)"
    inner = f"1 + least({BUCKETS - 3}, (shiftright(at, 1) - shiftright(from, 1)) div {step})"
    return F.expr(f"CAST(CASE WHEN at <= from THEN 0 WHEN at >= to THEN {BUCKETS - 1} ELSE {inner} END AS INT)")


def _by_narrowing(rows: DataFrame, whole: DataFrame, keys: list[str], probs: list[float], counted: int) -> DataFrame:
    """Quantiles of groups of any size; ``rows`` has ``keys`` and ``_x``, ``whole`` the size and ends of each group.

    The last pass counts the values of ranges of at most ``counted`` rows.
    """
    positions = F.transform(_prob_array(probs), lambda p: (F.col("n") - 1) * p)
    ranks = F.array_distinct(F.concat(F.transform(positions, lambda p: F.floor(p)), F.transform(positions, lambda p: F.ceil(p))))
    groups = stage(whole.withColumns({"positions": positions, "ranks": ranks}), "groups")
    # A range: its rows and those below it, and the ranks wanted from it.
    ranges = groups.select(*keys, "low", "high", "n", F.lit(0).cast("long").alias("before"), "ranks")
    found = []
    while True:
        single = ranges.filter("low <=> high")
        found.append(single.select(*keys, F.explode("ranks").alias("rank"), F.col("low").alias("value")))
        ranges = stage(ranges.filter("NOT (low <=> high)").withColumns({"from": _order("low"), "to": _order("high")}), "ranges")
        if ranges.isEmpty():
            break
        met = lookup_join(rows, ranges.drop("ranks", "before"), keys, how="inner", null_safe=True).filter("_x >= low AND _x <= high")
        placed = met.select(*keys, "_x", "from", "to", "n", _order("_x").alias("at"))
        bucket = F.when(F.col("n") <= counted, F.col("at")).otherwise(_bucket())
        cells = placed.groupBy(*keys, "from", bucket.alias("bucket")).agg(
            F.count("*").alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high")
        )
        cells = cells.groupBy(*keys, "from").agg(F.array_sort(F.collect_list(F.struct("bucket", "n", "low", "high"))).alias("cells"))
        asked = lookup_join(cells, ranges.select(*keys, "from", "before", "ranks"), [*keys, "from"], how="inner", null_safe=True)
        hit = F.transform("ranks", _cell_of_rank)
        picked = asked.select(*keys, F.explode(F.arrays_zip(F.col("ranks").alias("rank"), hit.alias("cell"))).alias("_p"))
        picked = picked.select(*keys, F.col("_p.rank").alias("rank"), "_p.cell.*")
        ranges = stage(picked.groupBy(*keys, "low", "high", "n", "before").agg(F.collect_list("rank").alias("ranks")), "narrowed")
    values = found[0]
    for more in found[1:]:
        values = values.unionByName(more)
    known = values.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))
    joined = lookup_join(groups.select(*keys, "n", "positions"), stage(known, "ranked"), keys, null_safe=True)
    at = lambda rank: F.element_at("at", rank)
    return joined.select(*keys, "n", F.transform("positions", lambda p: _between(at(F.floor(p)), at(F.ceil(p)), p)).alias("q"))


def _cell_of_rank(rank: Column) -> Column:
    """Of a range's cells, in order, the one that holds the rank: its least and greatest value, its rows and those before it."""
    cell = "struct<low:double,high:double,n:bigint,before:bigint>"
    start = F.struct(F.col("before").alias("seen"), F.lit(None).cast(cell).alias("hit"))

    def step(state: Column, c: Column) -> Column:
        here = state["hit"].isNull() & (state["seen"] + c["n"] > rank)
        hit = F.struct(c["low"].alias("low"), c["high"].alias("high"), c["n"].alias("n"), state["seen"].alias("before")).cast(cell)
        return F.struct((state["seen"] + c["n"]).alias("seen"), F.when(here, hit).otherwise(state["hit"]).alias("hit"))

    return F.aggregate("cells", start, step)["hit"]

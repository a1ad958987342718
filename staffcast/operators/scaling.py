"""Column statistics and min-max scaling with fitted bounds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffcast.functions.wide import long_form, quoted


@dataclass(frozen=True)
class ColumnStats:
    """Present values, mean and range of one column."""

    n: int
    mean: float | None
    least: float | None
    greatest: float | None


def column_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, ColumnStats]:
    """Statistics of all columns in one pass; the shuffle carries one row per task and column."""
    if not columns:
        return {}
    # An infinite value counts as missing: it would leave no bounds to scale by.
    finite = F.abs("value") < float("inf")
    per_column = long_form(df, columns).withColumn("value", F.when(finite, F.col("value"))).groupBy("pos").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"),
        F.min("value").alias("least"), F.max("value").alias("greatest"),
    )
    found = {r["pos"]: ColumnStats(r["n"], r["mean"], r["least"], r["greatest"]) for r in per_column.collect()}
    empty = ColumnStats(0, None, None, None)
    return {c: found.get(i, empty) for i, c in enumerate(columns)}


def fit_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Least and greatest value of every column."""
    return bounds_of(column_stats(df, columns))


def bounds_of(stats: Mapping[str, ColumnStats]) -> dict[str, tuple[float | None, float | None]]:
    return {c: (s.least, s.greatest) for c, s in stats.items()}


def scaled(column: str, bounds: tuple[float | None, float | None]) -> str:
    """SQL: position of a column within its bounds; 0 if it is constant, NULL for a missing or infinite value."""
    low, high = bounds
    name = quoted(column)
    if low is None:
        return f"CAST(NULL AS DOUBLE) AS {name}"
    value = f"CAST({name} AS DOUBLE)"
    shifted = f"CASE WHEN abs({value}) < double('infinity') THEN {value} - {_double(low)} END"
    if low == high:
        return f"{shifted} AS {name}"
    return f"({shifted}) / {_double(high - low)} AS {name}"


def scale_columns(df: DataFrame, keep: Sequence[str], bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    return df.selectExpr(*[quoted(k) for k in keep], *[scaled(c, b) for c, b in bounds.items()])


def _double(value: float) -> str:
    return f"{value!r}D"

"""Median fallback through key levels: the most specific level that has a median wins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffcast.operators.quantiles import group_quantiles
from staffcast.staging import lookup_join, stage


def level_medians(
    df: DataFrame, levels: Sequence[Sequence[str]], value: str, by: Sequence[str] = ()
) -> DataFrame:
    """Medians at every level: ``level``, keys (NULL when rolled up), ``median``. ``df`` is staged.

    The level number tells a rolled-up key from a missing one; rows missing a key that their level
    keeps are left out, as they can never match. Rows are counted once, at all keys together; the sizes and ends of all levels' groups
    follow from these counts, and no row is copied.
    """
    by, keys = list(by), list(dict.fromkeys(k for level in levels for k in level))
    known = df.filter(F.col(value).isNotNull())
    number = F.col(value).cast("double")
    ends = (F.min(number).alias("low"), F.max(number).alias("high"))
    counts = stage(known.groupBy(*by, *keys).agg(F.count("*").alias("n"), *ends), "level_counts")
    out = None
    for number, level in enumerate(levels):
        sizes = counts.na.drop(subset=list(level)).groupBy(*by, *level).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        medians = group_quantiles(known.na.drop(subset=list(level)), [*by, *level], value, [0.5], sizes=sizes)
        rolled = [F.col(k) if k in level else F.lit(None).cast(dict(df.dtypes)[k]).alias(k) for k in keys]
        part = medians.select(*by, F.lit(number).alias("level"), *rolled, F.col("q")[0].alias("median"))
        out = part if out is None else out.unionByName(part)
    return out


def fill_by_levels(
    df: DataFrame,
    table: DataFrame,
    levels: Sequence[Sequence[str]],
    fills: Mapping[str, tuple[Column, str]],
    renamed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add columns: the own value if known, else the first level median.

    ``fills`` maps each new column to (own value, median column of ``table``); ``renamed`` gives the
    expression of a key that the rows spell differently. ``table`` is a staged result of
    ``level_medians``.
    """
    renamed = dict(renamed or {})
    keys = list(dict.fromkeys(k for level in levels for k in level))
    out = df.withColumns({f"_at_{k}": renamed.get(k, F.col(k)) for k in keys})
    columns = sorted({column for _, column in fills.values()})
    for number, level in enumerate(levels):
        part = table.filter(F.col("level") == number).select(
            *[F.col(k).alias(f"_at_{k}") for k in level],
            *[F.col(c).alias(f"_{c}_{number}") for c in columns],
        )
        out = lookup_join(out, part, [f"_at_{k}" for k in level])
    out = out.withColumns(
        {
            name: F.coalesce(own, *[F.col(f"_{column}_{i}") for i in range(len(levels))])
            for name, (own, column) in fills.items()
        }
    )
    extra = [f"_{c}_{i}" for c in columns for i in range(len(levels))] + [f"_at_{k}" for k in keys]
    return out.drop(*extra)


def group_median(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Median per key, missing keys left out."""
    medians = group_quantiles(df.filter(F.col(key).isNotNull()), [key], value, [0.5])
    return medians.select(key, F.col("q")[0].alias(name))


def fill_default(df: DataFrame, table: DataFrame, key: str, column: str, median: str) -> DataFrame:
    """Fill missing ``column`` with the median of its group, 0 when the group has none."""
    joined = lookup_join(df, table, [key])
    return joined.withColumn(
        column, F.coalesce(F.col(column), F.col(median), F.lit(0.0))
    ).drop(median)

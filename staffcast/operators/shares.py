"""Value shares and grouping of rare values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffcast import settings as S


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of each value; missing values count neither way."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def frequent_values(df: DataFrame, percents: Mapping[str, float]) -> dict[str, list[str]]:
    """Values making up at least the given percent of their column.

    At most 100 / percent values of a column can do that, so the answer is small at any scale.
    """
    pairs = F.inline(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in percents])
    )
    counts = df.select(pairs).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    return frequent_of(counts, percents)


def frequent_of(counts: DataFrame, percents: Mapping[str, float]) -> dict[str, list[str]]:
    """Frequent values by their counts: ``column``, ``value``, ``n``."""
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    wanted = F.create_map(*[F.lit(x) for c, p in percents.items() for x in (c, float(p))])
    share = F.col("n") / F.col("total") * 100
    kept = counts.join(F.broadcast(totals), "column").filter(share >= wanted[F.col("column")])
    found: dict[str, list[str]] = {c: [] for c in percents}
    for row in kept.select("column", "value").collect():
        found[row["column"]].append(row["value"])
    return {c: sorted(values) for c, values in found.items()}


def group_rare(value: Column, frequent: Sequence[str]) -> Column:
    """The value if frequent, else (or when missing) "Other"."""
    if not frequent:
        return F.lit(S.OTHER)
    return F.when(value.isin(*frequent), value).otherwise(S.OTHER)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()

"""Success rates of groups and the flag of belonging to a favourable one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffcast.operators.quantiles import group_quantiles
from staffcast.staging import lookup_join, stage


def success_rates(df: DataFrame, columns: Sequence[str], target: str = "target", min_rows: int = 5) -> DataFrame:
    """Percent of successes by value, for several columns in one aggregation.

    Columns ``dimension``, ``value``, ``n``, ``rate``. Open rows count in ``n``. Groups below
    ``min_rows`` and groups without success are left out.
    """
    pairs = F.inline(
        F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    counted = (
        df.select(F.col(target).alias("_target"), pairs)
        .filter(F.col("value").isNotNull())
        .groupBy("dimension", "value")
        .agg(F.count("*").alias("n"), F.count_if(F.col("_target") == 1).alias("_hits"))
    )
    return rates_of(counted, min_rows)


def rates_of(counted: DataFrame, min_rows: int = 5) -> DataFrame:
    """Rates of counted values: ``dimension``, ``value``, ``n`` rows, ``_hits`` of them successes."""
    return counted.filter((F.col("n") >= min_rows) & (F.col("_hits") > 0)).select(
        "dimension", "value", "n", (F.col("_hits") / F.col("n") * 100).alias("rate")
    )


def favourable_values(rates: DataFrame, quantile: float = 0.75) -> DataFrame:
    """Values whose rate reaches the quantile of the rates of their dimension."""
    rates = stage(rates, "rates")
    cuts = group_quantiles(rates, ["dimension"], "rate", [quantile])
    cuts = stage(cuts.select("dimension", F.col("q")[0].alias("cut")), "rate_cuts")
    return lookup_join(rates, cuts, ["dimension"]).filter("rate >= cut").select("dimension", "value")


def add_favourable_flags(df: DataFrame, favourable: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Add one 0/1 column per entry of ``flags`` (source column -> flag name); ``favourable`` is staged."""
    for column, flag in flags.items():
        members = favourable.filter(F.col("dimension") == column).select(
            F.col("value").alias(column), F.lit(1).alias("_member")
        )
        df = lookup_join(df, members, [column]).withColumn(flag, F.coalesce("_member", F.lit(0))).drop("_member")
    return df

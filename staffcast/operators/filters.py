"""Row filters. Each states what happens to missing values, which differs from plain SQL at times."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffcast import settings as S


def _unless(condition: Column) -> Column:
    """True where ``condition`` is false or unknown."""
    return ~F.coalesce(condition, F.lit(False))


def recent(df: DataFrame, as_of: date, days: int, column: str = "request_creation_date") -> DataFrame:
    return df.filter(F.col(column) >= F.date_sub(F.lit(as_of), days))


def without_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Missing values stay."""
    return df.filter(_unless(F.col(column).isin(*values)))


def above(df: DataFrame, column: str, bound: float) -> DataFrame:
    """Missing values stay."""
    return df.filter(_unless(F.col(column) <= bound))


def outside_band(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Drop ``low <= value < high``; missing values stay."""
    return df.filter(is_outside_band(F.col(column), low, high))


def is_outside_band(value: Column, low: float, high: float) -> Column:
    """True unless ``low <= value < high``; true for a missing value."""
    return _unless((value >= low) & (value < high))


def only_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Missing values go."""
    return df.filter(F.col(column) == value)


def without_undated_closed(df: DataFrame) -> DataFrame:
    return df.filter(_unless((F.col("status") == S.CLOSED) & F.col("closure_date").isNull()))


def latest_rows(df: DataFrame, column: str = "insertion_date") -> DataFrame:
    """Rows of the latest value of ``column``."""
    return df.filter(F.col(column) == df.select(F.max(column)).scalar())


def split_by_target(df: DataFrame, column: str = "target") -> tuple[DataFrame, DataFrame]:
    """(open, closed) rows."""
    is_open = F.col(column).eqNullSafe(F.lit(-1))
    return df.filter(is_open), df.filter(~is_open)


def assert_unique(df: DataFrame, key: str) -> None:
    """Fail unless ``key`` identifies rows."""
    repeated = df.groupBy(key).count().filter("count > 1").limit(1)
    row = repeated.first()
    if row is not None:
        raise ValueError(f"{key} is not unique, for example {row[0]!r} occurs {row[1]} times")

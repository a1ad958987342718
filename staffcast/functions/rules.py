"""Business rules as column expressions. NULL means missing; NaN is never produced."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from staffcast import settings as S


def _coverage_cut(filled: Column, cuts: Mapping[int, float]) -> Column:
    """Coverage demanded for a number of filled positions; the highest key is open-ended."""
    top = max(cuts)
    cut = F.when(filled >= top, F.lit(cuts[top]))
    for positions, share in cuts.items():
        if positions != top:
            cut = cut.when(filled == positions, F.lit(share))
    return cut


def required_positions(required: Column, filled: Column) -> Column:
    """The larger of both; ``filled`` whenever one of them is missing."""
    return F.when(required > filled, required).otherwise(filled)


def coverage_rate(filled: Column, required: Column) -> Column:
    return F.try_divide(filled.cast("double"), required.cast("double"))


def clamp_negative(value: Column) -> Column:
    return F.when(value < 0, F.lit(0).cast("double")).otherwise(value)


def settled_status(status: Column, filled: Column, coverage: Column) -> Column:
    """Close open requests whose coverage suffices; NULL for any status the rules do not know."""
    cut = _coverage_cut(filled, S.CLOSING_COVERAGE)
    is_open = status == S.OPEN
    return (
        F.when(status == S.CLOSED, F.lit(S.CLOSED))
        .when(is_open & (coverage >= cut), F.lit(S.CLOSED))
        .when(is_open & ((coverage < cut) | (filled < 1)), F.lit(S.OPEN))
    )


def forced_closure(status: Column, created: Column, as_of: date, closing_days: int) -> Column:
    """Close requests that have been open longer than ``closing_days``; an undated open one is unknown."""
    age = F.datediff(F.lit(as_of), created)
    return F.when((status == S.OPEN) & (age > closing_days), F.lit(S.CLOSED)).when(
        (status == S.CLOSED) | age.isNotNull(), status
    )


def duration_days(status: Column, created: Column, closed: Column) -> Column:
    return F.when(status == S.CLOSED, F.datediff(closed, created))


def target_label(
    status: Column,
    filled: Column,
    duration: Column,
    coverage: Column,
    target_days: int = 90,
    large_request_rule: str = "as_coded",
) -> Column:
    """-1 open, 1 filled in time, 0 otherwise."""
    if large_request_rule not in ("as_coded", "as_documented"):
        raise ValueError(f"unknown rule: {large_request_rule}")
    met = (duration <= target_days) & (coverage >= _coverage_cut(filled, S.SUCCESS_COVERAGE))
    if large_request_rule == "as_coded":
        met = met & (filled < max(S.SUCCESS_COVERAGE))
    return F.when(status == S.OPEN, -1).when(met, 1).otherwise(0)


def job_level_band(level: Column) -> Column:
    return (
        F.when(level <= 5, "high_level")
        .when(level.between(6, 9), "senior")
        .when(level >= 10, "junior")
        .otherwise("0")
    )


def full_salary(desired: Column) -> Column:
    """Amounts from 5 up to 100 are given in thousands."""
    return F.when((desired >= 5) & (desired < 100), desired * 1000).otherwise(desired)


def remote_status(percentage: Column) -> Column:
    return (
        F.when(percentage == 100, S.FULL_REMOTE_SALARY)
        .when((percentage > 0) & (percentage < 100), "Hybrid")
        .otherwise("On-site")
    )


def request_remote_status(remote_work: Column) -> Column:
    """Request wording of remote work in the wording of the salary table."""
    return F.when(remote_work == S.FULL_REMOTE_REQUEST, S.FULL_REMOTE_SALARY).otherwise(remote_work)


def growth_flag(newcomer_salary: Column, usual_salary: Column) -> Column:
    return F.coalesce((F.try_divide(newcomer_salary, usual_salary) > 1).cast("int"), F.lit(0))


def probability_band(probability: Column) -> Column:
    return F.when(probability >= 75, 1).when(probability >= 40, 0).otherwise(-1)


def mixed_band(first: Column, second: Column) -> Column:
    high_a, high_b = first >= 75, second >= 75
    return (
        F.when(high_a & high_b, 2)
        .when(high_a | high_b, 1)
        .when((first <= 30) & (second <= 30), -1)
        .otherwise(0)
    )


def several_positions(required: Column) -> Column:
    return F.when(required > 1, 1).when(required == 1, 0).otherwise(-1)


def equals_flag(value: Column, wanted: str) -> Column:
    return value.eqNullSafe(F.lit(wanted)).cast("int")


def known_positive(value: Column) -> Column:
    """Salaries use zero for missing."""
    return F.when(value > 0, value)


def known_probability(value: Column) -> Column:
    return F.when(value >= 0, value)

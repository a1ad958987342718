"""Cleaning, status rules and outcome of raw requests; cleaning of the salary table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffcast import settings as S
from staffcast.functions import rules
from staffcast.functions.text import clean_profile
from staffcast.operators import filters
from staffcast.settings import Settings


def settle(df: DataFrame, conf: Settings) -> DataFrame:
    """Positions, coverage and status of recent requests."""
    rows = filters.without_values(filters.recent(df, conf.as_of, conf.model_days), "status", S.IGNORED_STATUSES)
    rows = rows.withColumn(
        "required_positions", rules.required_positions(F.col("required_positions"), F.col("positions_filled"))
    )
    rows = rows.withColumn(
        "coverage_rate", rules.coverage_rate(F.col("positions_filled"), F.col("required_positions"))
    )
    rows = rows.withColumn(
        "status", rules.settled_status(F.col("status"), F.col("positions_filled"), F.col("coverage_rate"))
    )
    return rows.withColumn(
        "status",
        rules.forced_closure(F.col("status"), F.col("request_creation_date"), conf.as_of, conf.closing_days),
    )


def clean_requests(df: DataFrame, conf: Settings) -> DataFrame:
    """Requests fit for modelling, with ``duration`` and ``target``. One pass, no shuffle."""
    rows = filters.without_undated_closed(settle(df, conf).filter(F.col("status").isNotNull()))
    rows = filters.without_values(rows, "region", [S.IGNORED_REGION])
    rows = filters.above(rows, "desired_salary", 5)
    rows = filters.only_value(rows, "request_type", S.KEPT_REQUEST_TYPE)
    if "tech_hours" in rows.columns:
        rows = rows.withColumn("tech_hours", rules.clamp_negative(F.col("tech_hours")))
    rows = rows.withColumn(
        "duration", rules.duration_days(F.col("status"), F.col("request_creation_date"), F.col("closure_date"))
    )
    target = rules.target_label(
        F.col("status"), F.col("positions_filled"), F.col("duration"), F.col("coverage_rate"),
        conf.target_days, conf.large_request_rule,
    )
    return rows.withColumn("target", target)


def clean_salary(df: DataFrame) -> DataFrame:
    """Salary rows of the latest delivery, with the keys of the median levels and a tenure band."""
    rows = filters.latest_rows(df).filter(F.col("salary") > 0).na.drop("any")
    return rows.select(
        "salary",
        clean_profile(F.col("profile")).alias("profile"),
        "job_level",
        rules.remote_status(F.col("remote_percentage")).alias("remote"),
        "region",
        F.when(F.col("tenure") <= 12, "new").when(F.col("tenure") <= 48, "settled").alias("band"),
    ).filter(F.col("band").isNotNull())

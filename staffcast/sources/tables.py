"""Readers: Parquet, CSV, JSON and JDBC tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffcast.functions.text import to_day, unread_day
from staffcast.sources.schemas import DATE_COLUMNS, REQUESTS


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


# Quotes inside quoted text are doubled, and text may hold line breaks; a row that doesn't fit the schema is an error.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Database table, read in parallel by ranges of a numeric ``column`` or by ``predicates``.

    Filters and column selection are pushed into the database by Spark.
    """
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties))
    if column and bounds:
        return spark.read.jdbc(
            url, table, column=column, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=partitions, properties=dict(properties),
        )
    return spark.read.jdbc(url, table, properties=dict(properties))


def parse_records(df: DataFrame, column: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON text to columns; fields a record lacks are NULL."""
    return df.select(*keep, F.from_json(F.col(column), schema).alias("_r")).select(*keep, "_r.*")


def parse_days(df: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Text columns to dates, where present."""
    return df.withColumns({c: to_day(F.col(c)) for c in columns if c in df.columns})


def unread_days(df: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """One row: of each date column, the number of texts that :func:`parse_days` would turn into NULL."""
    return df.agg(*[F.coalesce(F.sum(unread_day(F.col(c))), F.lit(0)).alias(c) for c in columns if c in df.columns])


def load_inputs(
    spark: SparkSession,
    source: str,
    requests: str,
    salary: str,
    salary_schema: str,
    requests_schema: str = REQUESTS,
    database: Mapping[str, object] | None = None,
    read: Callable[..., DataFrame] = read_jdbc,
) -> tuple[DataFrame, DataFrame]:
    """Requests and salaries from ``parquet`` tables, ``csv`` snapshots or tables of a ``jdbc`` database.

    ``database`` holds the arguments of :func:`read_jdbc` besides the table; ``column`` with ``bounds``, or
    ``predicates``, are needed there, as a database table would else be read by one task.
    """
    if source == "jdbc":
        options = dict(database or {})
        if not options.get("predicates") and not (options.get("column") and options.get("bounds")):
            raise ValueError("a database table needs predicates, or a column with bounds, to be read in parallel")
        return tuple(read(spark, table=table, **options) for table in (requests, salary))
    if source == "parquet":
        return read_parquet(spark, requests), read_parquet(spark, salary)
    if source == "csv":
        return read_csv(spark, requests, requests_schema), read_csv(spark, salary, salary_schema)
    raise ValueError(f"unknown source: {source!r}")

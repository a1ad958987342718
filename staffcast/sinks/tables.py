"""Writers: replacing one day of a table, JDBC append."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffcast.sources.snapshots import _list


# Table and column names that may go into a statement, with a schema before them perhaps.
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def replace_day(df: DataFrame, path: str, day: date, column: str = "insertion_date") -> None:
    """Make ``df`` the rows of ``day``; running it again gives the same table, also for an empty ``df``."""
    df.drop(column).write.mode("overwrite").parquet(f"{path}/{column}={day.isoformat()}")


def replace_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace exactly the partitions that ``df`` has rows for.

    Rows are dealt by partition first, so that a partition gets few files; adaptive execution splits large ones.
    """
    (
        df.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def has_day(spark: SparkSession, path: str, day: date, column: str = "insertion_date") -> bool:
    """True if the table has rows of ``day``; only that partition is opened."""
    if f"{column}={day.isoformat()}" not in _list(spark, path):
        return False
    return not spark.read.parquet(path).filter(F.col(column) == F.lit(day)).isEmpty()


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    df.write.mode("append").jdbc(url, table, properties=dict(properties))


def replace_day_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    day: date,
    connect: Callable[[], object],
    column: str = "insertion_date",
    append: Callable[..., None] = append_jdbc,
) -> int:
    """Replace the rows of ``day`` over a DB-API connection; returns the rows deleted.

    Spark appends to a staging table first. Then one transaction deletes the day, copies the staged rows and drops the
    staging table, so a failure at any point leaves the day as it was.
    """
    staged = f"{table}_{uuid.uuid4().hex[:8]}"
    for name in (table, column, *df.columns):
        if not IDENTIFIER.fullmatch(name):
            raise ValueError(f"not a plain identifier: {name!r}")
    append(df, url, staged, properties)
    columns = ", ".join(df.columns)
    connection = connect()
    try:
        cursor = connection.cursor()
        cursor.execute(f"DELETE FROM {table} WHERE {column} = %s", (day.isoformat(),))
        deleted = cursor.rowcount
        cursor.execute(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staged}", ())
        connection.commit()
        # Some databases commit when a table is dropped, so this comes last.
        cursor.execute(f"DROP TABLE {staged}", ())
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()
    return deleted

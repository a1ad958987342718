"""Fitted tables written to the shared folder, and size-checked lookup joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A lookup table is broadcast up to this many bytes of values; beyond it the join shuffles.
BROADCAST_BYTES = 16_000_000

# Paths staged in each open scope.
_scopes: list[list[str]] = []


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir``, or a temporary one in local mode only."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="staffcast-"))
    return context.getCheckpointDir()


def stage(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once and read it back, as ``schema`` if given (types that are stored alike).

    Later passes then read a file with known size and pruned columns instead of repeating the
    lineage, and a lost executor costs no more than the tasks it ran.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/staged/{name}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    # Staged tables are read few times; the stronger compression keeps the shared folder small.
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema if schema is None else schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt out by a unique key over all tasks, for rows that cost much each.

    A file of a few MB is read by one task, and joins with small tables keep it so, however many cores there are; adaptive execution
    makes tasks of what is dealt out by its bytes, so large tables get many.
    """
    return df.repartition(key)


@contextmanager
def staged_until_end(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged in this block when it ends; results must be written elsewhere by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def value_bytes(table: DataFrame) -> int:
    """Bytes of all values of ``table``: texts and lists by their length, other values as eight."""

    def width(name: str, kind: str):
        value = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(value), F.lit(0)) + 8
        if kind.startswith(("array", "map", "struct")):
            return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)) + 8
        return F.lit(8)

    total = sum((width(*c).cast("long") for c in table.dtypes), F.lit(0).cast("long"))
    return table.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0]


def broadcastable(table: DataFrame, limit: int | None = None) -> bool:
    """True if ``table`` (staged, so measuring it is cheap) is within the broadcast bound."""
    return value_bytes(table) <= (BROADCAST_BYTES if limit is None else limit)


def lookup_join(
    df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left", null_safe: bool = False, limit: int | None = None
) -> DataFrame:
    """Join ``df`` with a staged lookup table, unique on equally named keys.

    Small tables (measured, not guessed) are broadcast, so ``df`` is not shuffled. With a larger one it is a plain sort-merge
    join of ``df`` with a side that is unique: adaptive execution splits the rows of a hot key over many tasks, and
    no row of the table is repeated beyond that.
    """
    keys = list(on)
    payload = [c for c in table.columns if c not in keys]
    right = table.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *payload)
    right = F.broadcast(right) if broadcastable(table, limit) else right.hint("merge")
    pairs = [
        F.col(k).eqNullSafe(F.col(f"_k_{k}")) if null_safe else F.col(k) == F.col(f"_k_{k}") for k in keys
    ]
    joined = df.join(right, reduce(lambda a, b: a & b, pairs), how)
    return joined.drop(*[f"_k_{k}" for k in keys])

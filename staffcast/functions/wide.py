"""Many columns at once, as one SQL expression instead of hundreds of column objects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def double_array(columns: Sequence[str], missing: str = "") -> Column:
    """Array of the columns as doubles; ``missing`` is an SQL value put for NULL."""
    cells = [f"CAST({quoted(c)} AS DOUBLE)" for c in columns]
    if missing:
        cells = [f"coalesce({c}, {missing})" for c in cells]
    return F.expr(f"array({', '.join(cells)})")


def array_columns(array: str, columns: Sequence[str], kind: str = "double") -> list[str]:
    """SQL projections of array elements to named columns."""
    return [f"CAST({quoted(array)}[{i}] AS {kind}) AS {quoted(c)}" for i, c in enumerate(columns)]


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per cell: ``keep``, ``pos`` (index into ``columns``), ``value``."""
    return df.select(*keep, F.posexplode(double_array(columns)).alias("pos", "value"))

"""Correlations of many columns in one pass, and the two feature filters built on them.

Only products summed over rows are needed, so the rows are turned into vectors and Spark's
distributed Gram matrix does the rest. A column with missing values brings a mask column along,
which makes every pair use exactly the rows where both are present. The driver holds width x width
numbers, never rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffcast.functions.wide import double_array, long_form, quoted
from staffcast.operators.scaling import ColumnStats, column_stats


def correlation_matrix(
    df: DataFrame, columns: Sequence[str], stats: Mapping[str, ColumnStats] | None = None
) -> np.ndarray:
    """Pairwise-complete Pearson correlations; NaN where a column is constant on the common rows.

    ``stats`` (of these rows, or of rows containing them) saves a pass.
    """
    columns = list(columns)
    width = len(columns)
    result = np.full((width, width), np.nan)
    stats = column_stats(df, columns) if stats is None else stats
    used = [stats[c] for c in columns]
    total = max((s.n for s in used), default=0)
    if total == 0:
        return result
    masked = [i for i, s in enumerate(used) if s.n < total]
    spans = np.array([(s.greatest or 0.0) - (s.least or 0.0) for s in used])
    # Shifted by the mean and divided by the range, sums of squares lose no digits.
    shift = "array(" + ", ".join(f"{s.mean or 0.0!r}D" for s in used) + ")"
    scale = "array(" + ", ".join(f"{float(v) or 1.0!r}D" for v in spans) + ")"
    rows = df.select(double_array(columns).alias("x"))
    rows = rows.selectExpr(
        "x", f"zip_with(zip_with(x, {shift}, (a, b) -> coalesce(a - b, 0.0D)), {scale}, (a, b) -> a / b) AS z"
    )
    blocks = ["array(1.0D)", "z"]
    if masked:
        flags = ", ".join(f"CAST(x[{i}] IS NOT NULL AS DOUBLE)" for i in masked)
        blocks += [f"array({flags})", "transform(z, v -> v * v)"]
    vectors = rows.select(array_to_vector(F.expr(f"concat({', '.join(blocks)})")).alias("v"))
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v")).computeGramianMatrix().toArray()

    xs = np.arange(1, 1 + width)
    mask = np.zeros(width, dtype=int)
    mask[masked] = 1 + width + np.arange(len(masked))
    n = gram[np.ix_(mask, mask)]
    sum_x = gram[np.ix_(xs, mask)]
    cross = gram[np.ix_(xs, xs)]
    if masked:
        squares = gram[np.ix_(xs + width + len(masked), mask)]
    else:
        squares = np.repeat(np.diag(cross)[:, None], width, axis=1)
    with np.errstate(all="ignore"):
        covariance = cross - sum_x * sum_x.T / n
        spread = squares - sum_x * sum_x / n
        # What is left of a constant column after subtracting its mean is rounding, not spread.
        flat = ~(spread > 1e-13 * n) | (spans == 0)[:, None]
        result = covariance / np.sqrt(spread * spread.T)
    result[flat | flat.T | ~(n > 1)] = np.nan
    return np.clip(result, -1.0, 1.0)


def correlation_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form of the upper triangle: ``first``, ``second``, ``r`` (NULL for constant columns)."""
    matrix = correlation_matrix(df, columns)
    rows = [
        (columns[i], columns[j], None if np.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i in range(len(columns))
        for j in range(i + 1, len(columns))
    ]
    return df.sparkSession.createDataFrame(rows, "first string, second string, r double")


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, the target itself included: ``name``, ``r``.

    One long pass with a mergeable aggregate per column, on the rows where the column is present.
    """
    names = [*columns, target]
    cells = long_form(df, names, [F.col(quoted(target)).cast("double").alias("t")]).filter(
        "value IS NOT NULL AND t IS NOT NULL"
    )
    sums = cells.groupBy("pos").agg(
        F.covar_pop("value", "t").alias("c"), F.stddev_pop("value").alias("sx"), F.stddev_pop("t").alias("st"),
        F.min("value").alias("least"), F.max("value").alias("greatest"),
    )
    spread = F.when(F.col("least") < F.col("greatest"), F.col("sx") * F.col("st"))
    labels = F.array(*[F.lit(c) for c in names])
    return sums.select(labels[F.col("pos")].alias("name"), F.try_divide("c", spread).alias("r"))


def target_related(df: DataFrame, columns: Sequence[str], target: str, quantile: float) -> list[str]:
    """Columns whose absolute correlation with the target reaches the quantile of all such values.

    The target's own 1.0 takes part in the quantile. Order: strongest first, ties by name.
    """
    strength = {
        r["name"]: abs(r["r"]) for r in target_correlations(df, columns, target).collect() if r["r"] is not None
    }
    if not strength:
        return []
    cut = float(np.quantile(list(strength.values()), quantile))
    kept = [c for c in columns if strength.get(c, -1.0) >= cut]
    return sorted(kept, key=lambda c: (-strength[c], c))


def not_redundant(
    df: DataFrame, columns: Sequence[str], cut: float, stats: Mapping[str, ColumnStats] | None = None
) -> list[str]:
    """Columns without a strong correlation to any earlier column, kept or not."""
    strength = np.nan_to_num(np.abs(correlation_matrix(df, columns, stats)))
    return [c for j, c in enumerate(columns) if not (strength[:j, j] >= cut).any()]

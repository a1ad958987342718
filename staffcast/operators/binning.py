"""Equal-frequency bins that keep ties together: bin i holds edge[i] < x <= edge[i+1]."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffcast.operators.quantiles import column_quantiles


def bin_probs(parts: int) -> list[float]:
    """Evenly spaced probabilities, multiples of one step."""
    return [i * (1.0 / parts) for i in range(parts)] + [1.0]


def fit_edges(
    df: DataFrame, parts: Mapping[str, Sequence[int]], on_duplicates: str = "drop"
) -> dict[str, dict[int, list[float]]]:
    """Bin edges of several columns and numbers of parts in one pass.

    Equal edges are merged, or refused with ``on_duplicates="raise"``.
    """
    if on_duplicates not in ("drop", "raise"):
        raise ValueError(f"on_duplicates must be drop or raise, not {on_duplicates!r}")
    probs = {c: sorted({p for n in ns for p in bin_probs(n)}) for c, ns in parts.items()}
    values = column_quantiles(df, probs)
    edges: dict[str, dict[int, list[float]]] = {}
    for column, numbers in parts.items():
        by_prob = {} if values[column] is None else dict(zip(probs[column], values[column]))
        edges[column] = {}
        for n in numbers:
            found = [by_prob[p] for p in bin_probs(n)] if by_prob else []
            distinct = sorted(set(found))
            if on_duplicates == "raise" and len(distinct) < len(found):
                raise ValueError(f"bin edges of {column} are not unique: {found}")
            edges[column][n] = distinct
    return edges


def bin_index(value: Column, edges: Sequence[float]) -> Column:
    """Bin number of a value; NULL when missing or when the column has a single distinct edge.

    Only inner edges are compared, so values outside the fitted range fall into the end bins.
    """
    if len(edges) < 2:
        return F.lit(None).cast("int")
    index = F.when(value.isNotNull(), F.lit(0))
    for edge in edges[1:-1]:
        index = index + (value > F.lit(float(edge))).cast("int")
    return index

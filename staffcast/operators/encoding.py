"""Data-dependent columns: languages, keywords, one-hot categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import CountVectorizerModel, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffcast import settings as S
from staffcast.functions.text import split_values, tokens
from staffcast.functions.wide import quoted
from staffcast.operators.sparse import numbered_in_order
from staffcast.staging import lookup_join

def distinct_names(names: Sequence[str]) -> list[str]:
    """The names, with a number after each that is taken already; Spark tells names apart without regard to case."""
    taken: set[str] = {n.lower() for n in names}
    seen: set[str] = set()
    out = []
    for name in names:
        unique, n = name, 2
        while unique.lower() in seen or (unique != name and unique.lower() in taken):
            unique, n = f"{name}_{n}", n + 1
        seen.add(unique.lower())
        out.append(unique)
    return out


# ---- multi-value lists ---------------------------------------------------------


def explode_values(df: DataFrame, key: str, column: str, name: str, missing: str | None = None) -> DataFrame:
    """One row per key and slot of a delimited list."""
    return df.select(key, F.explode(split_values(F.col(column), missing)).alias(name))


def value_counts_by_key(df: DataFrame, key: str, column: str, name: str, missing: str | None = None) -> DataFrame:
    """Long form of the cross table: key, value, count."""
    return explode_values(df, key, column, name, missing).groupBy(key, name).agg(F.count("*").alias("n"))


def fit_values(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct slots of a delimited list column, for wide forms; :mod:`staffcast.operators.sparse` needs no such list."""
    slots = df.select(F.explode(split_values(F.col(column))).alias("v"))
    return sorted(r["v"] for r in slots.filter("v is not null").distinct().collect())


def value_columns(column: str, values: Sequence[str], prefix: str) -> dict[str, Column]:
    """Count of each value within the row's own list; no shuffle."""
    slots = split_values(F.col(column))

    def count(wanted: str) -> Column:
        return F.coalesce(F.size(F.filter(slots, lambda s: s == wanted)), F.lit(0))

    return {name: count(v) for name, v in zip(distinct_names([f"{prefix}{v}" for v in values]), values)}


# ---- keywords ------------------------------------------------------------------


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def document_terms(df: DataFrame, key: str, text: Column, stop_words: Sequence[str]) -> DataFrame:
    """One row per token of each text."""
    # The outer form, as Spark would else find the tokens a second time to drop rows without any first.
    return df.select(key, F.explode_outer(tokens(text, stop_words)).alias("term")).filter("term IS NOT NULL")


def frequent_terms(df: DataFrame, text: Column, stop_words: Sequence[str], min_share: float) -> DataFrame:
    """Terms found in at least ``min_share`` of all rows: ``term``, ``n_docs``."""
    per_doc = df.select(F.explode_outer(F.array_distinct(tokens(text, stop_words))).alias("term")).filter("term IS NOT NULL")
    counts = per_doc.groupBy("term").agg(F.count("*").alias("n_docs"))
    total = df.select(F.count("*")).scalar()
    return counts.filter(F.col("n_docs") >= total * F.lit(float(min_share)))


def fit_terms(df: DataFrame, text: Column, stop_words: Sequence[str], min_share: float) -> list[str]:
    """Sorted vocabulary; its size is bounded by the mean number of distinct terms / ``min_share``."""
    return sorted(r["term"] for r in frequent_terms(df, text, stop_words, min_share).select("term").collect())


def term_counts(df: DataFrame, key: str, text: Column, stop_words: Sequence[str], terms: Sequence[str]) -> DataFrame:
    """Long form: key, term, count for the vocabulary's terms."""
    found = document_terms(df, key, text, stop_words)
    if not terms:
        return found.filter(F.lit(False)).withColumn("n", F.lit(0).cast("long"))
    return found.filter(F.col("term").isin(*terms)).groupBy(key, "term").agg(F.count("*").alias("n"))


def merge_terms(terms: Sequence[str]) -> dict[str, list[str]]:
    """Output name -> vocabulary terms it sums: groups whose terms all occur, then the other terms."""
    grouped = {name: list(group) for name, group in S.TERM_GROUPS.items() if set(group) <= set(terms)}
    used = {t for group in grouped.values() for t in group}
    return {**{t: [t] for t in sorted(terms) if t not in used}, **grouped}


def merged_terms(text: Column, stop_words: Sequence[str], terms: Sequence[str]) -> Column:
    """List of the vocabulary's terms in a text, each as often as it occurs, under the name of its group if it has one."""
    if not terms:
        return F.array().cast("array<string>")
    names = {t: name for name, group in merge_terms(terms).items() if name not in terms or len(group) > 1 for t in group}
    known = F.filter(tokens(text, stop_words), lambda t: t.isin(*terms))
    if not names:
        return known
    renamed = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.transform(known, lambda t: F.coalesce(F.try_element_at(renamed, t), t))


def add_term_columns(
    df: DataFrame, text: Column, stop_words: Sequence[str], terms: Sequence[str], prefix: str = "kw_"
) -> DataFrame:
    """Add a count column per merged term. Counting is a hash lookup per token within the row."""
    if not terms:
        return df
    counter = CountVectorizerModel.from_vocabulary(list(terms), inputCol="_tokens", outputCol="_counts")
    counted = counter.transform(df.withColumn("_tokens", tokens(text, stop_words))).withColumn(
        "_counts", vector_to_array("_counts")
    )
    at = {t: i for i, t in enumerate(terms)}
    merged = merge_terms(terms)
    names = distinct_names([prefix + name for name in merged])
    columns = [
        f"CAST({' + '.join(f'_counts[{at[m]}]' for m in members)} AS INT) AS {quoted(name)}"
        for name, members in zip(names, merged.values())
    ]
    return counted.selectExpr(*[quoted(c) for c in df.columns], *columns)


# ---- one-hot -------------------------------------------------------------------


def fit_categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct values of several columns in one aggregation, for wide forms; see :mod:`staffcast.operators.sparse`."""
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in df.select(pairs).filter("value is not null").distinct().collect():
        found[row["column"]].append(row["value"])
    return {c: sorted(values) for c, values in found.items()}


def one_hot_columns(categories: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """0/1 column per category; a missing value gives zeros."""
    pairs = [(c, v) for c, values in categories.items() for v in values]
    names = distinct_names([f"{c}_{v}" for c, v in pairs])
    return {name: F.col(c).eqNullSafe(F.lit(v)).cast("int") for name, (c, v) in zip(names, pairs)}


def one_hot_long(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Long form for any number of categories: key, column, value of the cells that are 1."""
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(key, pairs).filter("value is not null")


def fit_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Table ``column, value, position`` of all values of several columns, for any number of them.

    Positions follow column and value, counted over range partitions, so no task holds all values.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    return numbered_in_order(df.select(pairs).filter("value IS NOT NULL").distinct(), ["column", "value"], "position")


def one_hot_sparse(df: DataFrame, key: str, index: DataFrame) -> DataFrame:
    """Key and ``positions``: of each row the ascending positions of its values in a staged :func:`fit_index`.

    The sparse form of one-hot columns: cost follows the cells that are 1, not the number of values.
    """
    columns = [r["column"] for r in index.select("column").distinct().collect()]
    cells = one_hot_long(df, key, columns) if columns else None
    if cells is None:
        return df.select(key, F.array().cast("array<long>").alias("positions"))
    met = lookup_join(cells, index, ["column", "value"], how="inner")
    lists = met.groupBy(key).agg(F.array_sort(F.collect_list("position")).alias("positions"))
    return df.select(key).join(lists, key, "left").withColumn("positions", F.coalesce("positions", F.array().cast("array<long>")))


def align_columns(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The saved columns in the saved order; a column that is absent is 0."""
    present = set(df.columns)
    return df.selectExpr(
        *[quoted(k) for k in key],
        *[quoted(c) if c in present else f"0.0D AS {quoted(c)}" for c in columns],
    )

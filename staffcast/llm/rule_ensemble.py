"""Text quality by a sparse rule ensemble: tree paths as rules over statistics, weighted by lasso logistic regression."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffcast.llm.common import UNSPACED, WordHash, chunks, free_name, mix, numbered, read_table, word_spans
from staffcast.staging import stage

TRAIN_ROWS = 20_000  # trees and weights are fitted on about so many labelled rows at most
TREES, DEPTH, LASSO = 10, 3, 0.001

WORDS = WordHash(4)


def _bytes(*codes: int) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(codes)] = 1
    return table


def _marks(text: str) -> np.ndarray:
    return _bytes(*text.encode())


KINDS = {
    "upper": _bytes(*range(0x41, 0x5B)),
    "lower": _bytes(*range(0x61, 0x7B)),
    "digit": _bytes(*range(0x30, 0x3A)),
    "beyond": _bytes(*range(0x80, 0x100)),
    "stops": _marks(".,;:?"),
    "shouts": _marks("!"),
    "bars": _marks("|"),
    "symbols": _marks("#$%&*@^~=+<>{}[]\\_`/"),
    "breaks": _bytes(0x0A),
}
LINES = np.ones(256, bool)
LINES[0x0A] = False

STATISTICS = (
    "log_words", "mean_word", "longest_word", "upper_share", "digit_share", "beyond_share", "stops_per_word", "shouts_per_word",
    "bars_per_word", "symbols_per_word", "words_per_line", "different_words", "same_as_before", "most_common", "different_lines",
)


def _distinct(document: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each document the number of different hashes and the count of the most common one."""
    _, sample, count = np.unique(mix(hashes + document.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
    different, most = np.bincount(document[sample], minlength=n), np.zeros(n, np.int64)
    np.maximum.at(most, document[sample], count)
    return different, most


def statistics(at: np.ndarray, raw: np.ndarray) -> list[np.ndarray]:
    """The values of ``STATISTICS`` of each document of a piece; all are 0 for one without words."""
    n = len(at) - 1
    starts, ends, first = word_spans(at, raw, UNSPACED)
    words = np.diff(first)
    document = np.repeat(np.arange(n), words)
    lengths = ends - starts
    hashes = WORDS(raw, starts, ends)
    counts = {}
    for kind, table in KINDS.items():
        sums = np.concatenate([[0], np.cumsum(table[raw])])
        counts[kind] = sums[at[1:]] - sums[at[:-1]]
    different, most = _distinct(document, hashes, n)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (document[1:] == document[:-1])
    line_starts, line_ends, line_first = word_spans(at, raw, LINES)
    lines = np.diff(line_first)
    different_lines, _ = _distinct(np.repeat(np.arange(n), lines), WORDS(raw, line_starts, line_ends), n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, document, lengths)
    letters = counts["upper"] + counts["lower"] + counts["beyond"]
    of = lambda a, b: np.where(words > 0, a / np.maximum(b, 1), 0.0)
    return [
        np.log1p(words), of(np.bincount(document, lengths, n), words), longest.astype(float), of(counts["upper"], letters),
        of(counts["digit"], letters + counts["digit"]), of(counts["beyond"], letters), of(counts["stops"], words),
        of(counts["shouts"], words), of(counts["bars"], words), of(counts["symbols"], words), of(words, lines),
        of(different, words), of(np.bincount(document, again, n), words), of(most, words), of(different_lines, lines),
    ]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, at, raw in chunks(batch.column("text")):
            columns = [batch.column("kept").slice(first, end - first), *[pa.array(c, pa.float64()) for c in statistics(at, raw)]]
            yield pa.RecordBatch.from_arrays(columns, names=["kept", *STATISTICS])


@dataclass(frozen=True)
class Rule:
    """All of ``(statistic, above, threshold)`` hold: over the threshold, or else at most it."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        tests = [F.col(name) > value if above else F.col(name) <= value for name, above, value in self.terms]
        return reduce(lambda a, b: a & b, tests)

    def __str__(self) -> str:
        return " and ".join(f"{name} {'>' if above else '<='} {value:.4g}" for name, above, value in self.terms)


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules; ``score`` is one column expression."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        margin = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            margin = margin + F.when(rule.column(), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-margin))


def paths(model, names: Sequence[str]) -> list[Rule]:
    """Every path of every tree, from its root to each inner node and leaf, once; bounds on one statistic are merged."""
    found: dict[Rule, None] = {}

    def walk(node, bounds: dict[tuple[str, bool], float]) -> None:
        if bounds:
            found[Rule(tuple((n, above, v) for (n, above), v in sorted(bounds.items())))] = None
        if node.getClass().getSimpleName() == "LeafNode":
            return
        name, value = names[node.split().featureIndex()], float(node.split().threshold())
        left, right = (name, False), (name, True)
        walk(node.leftChild(), bounds | {left: min(value, bounds.get(left, value))})
        walk(node.rightChild(), bounds | {right: max(value, bounds.get(right, value))})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


def fit(rows: DataFrame, label: str, names: Sequence[str] = STATISTICS) -> Ensemble:
    """Rules and lasso weights for a 0/1 label. Without rows every score is 0.5; if all labels agree, near that label."""
    seen = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    if len(seen) < 2:
        return Ensemble((), 0.0 if not seen else 5.0 if 1.0 in seen else -5.0)
    vectors = VectorAssembler(inputCols=list(names), outputCol="_features").transform(rows)
    trees = GBTClassifier(featuresCol="_features", labelCol=label, maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=11).fit(vectors)
    rules = paths(trees, names)
    if not rules:
        share = seen.get(1.0, 0) / sum(seen.values())
        return Ensemble((), float(np.log(share / (1 - share))))
    held = F.array(*[F.when(r.column(), 1.0).otherwise(0.0) for r in rules])
    table = rows.select(label, array_to_vector(held).alias("_rules"))
    lasso = LogisticRegression(featuresCol="_rules", labelCol=label, elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=100)
    model = lasso.fit(table)
    weights = [(r, float(w)) for r, w in zip(rules, model.coefficients.toArray(), strict=True) if w]
    return Ensemble(tuple(weights), float(model.intercept))


def measured(docs: DataFrame, id_column: str, text_column: str, keep: Sequence[str] = (), row: str | None = None) -> DataFrame:
    """Statistics of each whole text beside ``kept``: the row's number, its id and the columns of ``keep``; a written table.

    ``row`` may name a column of written numbers that differ between rows; else rows are numbered here.
    """
    if row is None:
        row = free_name(docs, "_row")
        docs = numbered(docs, row)
    kept = F.struct(F.col(row).alias("row"), F.col(id_column).alias("id"), *[F.col(c).alias(f"keep_{c}") for c in keep])
    rows = docs.select(kept.alias("kept"), F.col(text_column).cast("string").alias("text"))
    schema = f"kept {rows.schema['kept'].dataType.simpleString()}, " + ", ".join(f"{n} double" for n in STATISTICS)
    return stage(rows.mapInArrow(_statistics, schema), "statistics")


def held_out(id_column: Column) -> Column:
    """Rows kept out of training: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_quality(
    docs: DataFrame, id_column: str, text_column: str, labels: DataFrame, label_id: str, label: str, keep: Sequence[str] = (),
    train_rows: int = TRAIN_ROWS, row: str | None = None,
) -> tuple[DataFrame, Ensemble]:
    """Rows ``kept`` (see :func:`measured`), statistics, ``held_out``, ``score`` (0 to 1) and ``predicted``, and the ensemble.

    Labels of an id that is labelled more than once count by majority (1 if even); rows without id or label, and
    held-out ones, aren't learned from. About ``train_rows`` labelled rows, picked by the hash of their row number,
    fit trees and weights. Null and empty texts have statistics of 0 and are scored like any others. Repeated rows
    each have a row; an empty table gives an empty result, and without labels all scores are 0.5.
    """
    rows = measured(docs, id_column, text_column, keep, row)
    marks = labels.where(F.col(label_id).isNotNull() & F.col(label).isNotNull())
    marks = marks.groupBy(F.col(label_id).alias("_id")).agg((F.avg(label) >= 0.5).cast("double").alias("_label"))
    marked = rows.where(~held_out(F.col("kept.id"))).join(marks, F.col("kept.id") == F.col("_id")).select("kept.row", "_label", *STATISTICS)
    marked = stage(marked, "labelled")
    n = marked.count()
    picked = F.pmod(F.xxhash64("row"), F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, train_rows / max(1, n))))
    ensemble = fit(marked.where(picked), "_label")
    scored = rows.withColumns({"held_out": held_out(F.col("kept.id")), "score": ensemble.score()})
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), ensemble


def op1_rule_ensemble(spark, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored, _ = score_quality(docs, "doc_id", "text", labels, "doc_id", "quality")
    return scored.select(F.col("kept.id").alias("doc_id"), "held_out", "score", "predicted")

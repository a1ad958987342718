"""Statistics, rules and scores of text quality."""

import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from staffcast.llm import rule_ensemble as quality
from staffcast.llm.common import text_column
from tests.llm.helpers import ODD_TEXTS, frame, words

DATA = "/root/testdata/sf0.01"


def test_statistics_of_whole_texts():
    texts = [t or "" for t in ODD_TEXTS] + ["A b B! one|two\nA b B! one|two\n99 é"]
    found = dict(zip(quality.STATISTICS, quality.statistics(*text_column(pa.array(texts))), strict=True))
    for i, t in enumerate(texts):
        own = words(t)
        n = len(own)
        assert found["mean_word"][i] == pytest.approx(sum(len(w.encode()) for w in own) / n if n else 0)
        assert found["different_words"][i] == pytest.approx(len(set(own)) / n if n else 0)
        assert found["most_common"][i] == pytest.approx(max(map(own.count, set(own))) / n if n else 0)
        assert found["same_as_before"][i] == pytest.approx(sum(a == b for a, b in zip(own, own[1:], strict=False)) / n if n else 0)
        lines = [x for x in t.split("\n") if x]
        assert found["different_lines"][i] == pytest.approx(len(set(lines)) / len(lines) if n else 0)
        assert found["bars_per_word"][i] == pytest.approx(t.count("|") / n if n else 0)


def test_rules_are_columns(spark):
    rule = quality.Rule((("a", True, 1.0), ("b", False, 2.0)))
    ensemble = quality.Ensemble(((rule, 2.0), (quality.Rule((("a", False, 0.0),)), -3.0)), 0.5)
    df = spark.createDataFrame([(2.0, 2.0), (1.0, 0.0), (0.0, 9.0)], "a double, b double")
    assert [round(r[0], 6) for r in df.select(ensemble.score()).collect()] == [0.924142, 0.622459, 0.075858]
    assert str(rule) == "a > 1 and b <= 2"


def test_held_out_rows_and_scores(spark):
    out = entry.queries()["op1_rule_ensemble"](spark, DATA).toPandas()
    labels = spark.read.parquet(f"{DATA}/labels.parquet").toPandas()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.doc_id]).all()
    assert out.score.between(0, 1).all() and ((out.score >= 0.5) == (out.predicted == 1)).all() and len(out) == 1000
    judged = out.merge(labels, on="doc_id")
    judged = judged[judged.held_out]
    assert len(judged) > 100 and (judged.predicted == judged.quality).mean() > 0.95


def test_odd_rows_and_labels(spark):
    good = [f"some quiet words number {i} here" for i in range(40)]
    bad = ["$$$ ### %%% " * (i + 1) for i in range(40)]
    docs = frame(spark, good + bad + ODD_TEXTS)
    docs = docs.union(docs.where("doc_id = 3")).union(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)] + [(1, 1), (None, 0), (2, None), (999, 0)], "doc_id long, quality int")
    scored, ensemble = quality.score_quality(docs, "doc_id", "text", labels, "doc_id", "quality", keep=docs.columns)
    rows = scored.collect()
    assert len(rows) == docs.count() and ensemble.rules
    found = [(r.kept.id, r.predicted) for r in rows if r.kept.id is not None and r.kept.id < 80]
    assert sum(p == (i < 40) for i, p in found) >= 0.95 * len(found)
    assert sorted(r.kept.keep_text for r in rows if r.kept.keep_text) == sorted(t.text for t in docs.collect() if t.text)


def test_without_labels_or_rows(spark):
    docs, labels = frame(spark, ["a b", ""]), spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    none, _ = quality.score_quality(docs, "doc_id", "text", labels.limit(0), "doc_id", "quality")
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.5, 1)}
    one, _ = quality.score_quality(docs, "doc_id", "text", labels, "doc_id", "quality")
    assert {r.predicted for r in one.collect()} == {1}
    assert quality.score_quality(docs.limit(0), "doc_id", "text", labels, "doc_id", "quality")[0].count() == 0

"""Vector search and phrase search against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from staffcast.llm import max_score, positional
from tests.llm.helpers import ODD_TEXTS, contamination, frame, plain_words


def best(rows, k):
    usable = [(n, i, [math.floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows) if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in usable:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, w, strict=False)), j, m) for m, j, w in usable if m != n)[:k]
            out += [(i, rank + 1, j, -s) for rank, (s, j, _) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("shard,queries", [(4096, 512), (7, 2)])
def test_best_vectors(spark, monkeypatch, shard, queries):
    monkeypatch.setattr(max_score, "SHARD_ROWS", shard)
    monkeypatch.setattr(max_score, "QUERY_ROWS", queries)
    r = random.Random(1)
    rows = [(i, [r.choice([r.uniform(-1, 1), 0.0, 0.25]) for _ in range(12)]) for i in range(160)]
    rows += [(i, list(v)) for i, v in rows[:60:3]]  # repeated rows
    rows += [(200, [0.5] * 12), (250, []), (201, None), (202, [1.0, None]), (203, [float("nan")] * 12), (204, [float("inf")] + [0.0] * 11), (None, [9.0] * 12), (205, [0.5, 0.5]), (300, [1.0] * 14)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, v array<double>, block int").repartition(4)
    got = sorted(map(tuple, max_score.top_k(df, "vec_id", "v", F.col("vec_id") % 50 == 0).collect()))
    assert got == best(rows, 5)


def test_pairs_of_blocks_are_neither_broadcast_nor_shuffled(spark, monkeypatch):
    """The driver would hold a query block for each shard, and the disk a shard for each query block."""
    monkeypatch.setattr(max_score, "SHARD_ROWS", 20)
    monkeypatch.setattr(max_score, "QUERY_ROWS", 3)
    df = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(500)], "vec_id long, v array<double>")
    found = max_score.top_k(df, "vec_id", "v", F.col("vec_id") % 50 == 0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "explode" not in plan
    assert found.count() == 50


def test_search_without_rows_or_queries(spark):
    df = spark.createDataFrame([(1, [0.5])], "vec_id long, v array<float>")
    assert max_score.top_k(df, "vec_id", "v", F.col("vec_id") % 50 == 0).count() == 0
    assert max_score.top_k(df.limit(0), "vec_id", "v", F.col("vec_id") % 50 == 0).count() == 0


def test_large_components_stay_exact():
    q, x = np.array([[3_000_000_001, 7]]), np.array([[3_000_000_000, 1], [3_000_000_000, 2], [-5, 0]])
    [(rows, scores)] = list(max_score.search_block(q, x, np.array([-1]), np.arange(3), np.arange(3), 2))
    assert rows.tolist() == [1, 0] and scores.tolist() == [9_000_000_003_000_000_014, 9_000_000_003_000_000_007]


def texts_and_items(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["The", "of", "né", "x1", "Zwei", "and", "rare" + str(r.randrange(30))])
    items = [(i, r.choice([" ", ", ", "\n"]).join(word() for _ in range(r.randrange(1, 25)))) for i in range(30)]
    items += [(40, None), (41, ""), (42, "..."), (None, "The of and"), (43, "Single"), (5, "another text of the same item five words more than ten here")]
    texts = []
    for _ in range(60):
        parts = [" ".join(word() for _ in range(r.randrange(0, 30)))]
        for _ in range(r.randrange(0, 3)):
            own = (r.choice(items)[1] or "").split()
            a = r.randrange(len(own) + 1)
            parts.append("-".join(own[a : a + 14]).upper())
        texts.append(" ".join(parts))
    return texts + ODD_TEXTS, items


@pytest.mark.parametrize("shard,held,rounds", [(4 << 20, 1 << 20, 2_000_000), (200, 40, 40)])
def test_phrases(spark, monkeypatch, shard, held, rounds):
    for name, value in (("SHARD_BYTES", shard), ("HELD_PLACES", held), ("ITEM_WORDS", rounds)):
        monkeypatch.setattr(positional, name, value)
    texts, items = texts_and_items(4)
    docs = frame(spark, texts)
    counts, matches = positional.find_items(docs, "_row", "text", spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")
    n_words = {r.row: r.n_words for r in counts.collect()}
    found = {r.row: (r.n_hit, set(r["items"])) for r in positional.hits(matches).collect()}
    for i, (n, hit, ids) in enumerate(contamination(texts, items)):
        assert n_words[i] == n and found.get(i, (0, set())) == (hit, ids), i


def test_words_near_each_other(spark):
    docs = spark.createDataFrame([(0, "alpha x x beta x gamma"), (1, "alpha beta x x x x x x gamma"), (2, "gamma beta alpha"), (3, "alpha beta")], "n long, text string")
    items = spark.createDataFrame([(9, "Alpha beta gamma")], "i long, text string")
    _, matches = positional.find_items(docs, "n", "text", items, "i", "text", slop=5)
    assert {(r.row, r.kind) for r in matches.collect()} == {(0, "near"), (2, "near")}


def test_empty_tables(spark):
    docs, items = frame(spark, ["a b"]), spark.createDataFrame([(1, "a b")], "i long, text string")
    assert positional.find_items(docs.limit(0), "_row", "text", items, "i", "text")[1].count() == 0
    counts, matches = positional.find_items(docs, "_row", "text", items.limit(0), "i", "text")
    assert matches.count() == 0 and [r.n_words for r in counts.collect()] == [len(plain_words("a b"))]

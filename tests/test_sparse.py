"""Cells against the wide forms of the same columns."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staffcast.operators import correlation, sparse
from staffcast.staging import stage

NUMBERS, TEXTS, LISTS = ["a", "b", "c c", "flat", "twin"], ["s", "t"], {"kw": "words"}


def table(spark, seed, n=240):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a = r.gauss(50_000, 9_000) if r.random() < 0.8 else None
        b = a * 2 + r.gauss(0, 2_000) if a and r.random() < 0.9 else r.choice([None, -3.0, 0.0, float("inf")])
        s = r.choice(["x", "y", "Y", None]) if r.random() < 0.9 else f"rare{r.randrange(9)}"
        words = [r.choice(["api", "java", "go", "c"]) for _ in range(r.randrange(5))]
        if "go" in words:
            words.append("golang")  # follows another word
        t = "p" if i % 2 else "q"  # two values that are never in one row
        rows.append((f"k{i}", r.choice([0, 1, 1, -1]), a, b, float(r.randrange(-2, 3)), 7.0, (a or 0) > 50_000 and 1.0 or 0.0, s, t, words if r.random() < 0.9 else None))
    kind = "k string, target int, a double, b double, `c c` double, flat double, twin double, s string, t string, words array<string>"
    return stage(spark.createDataFrame(rows, kind).repartition(5), "rows"), rows


def encoded(df):
    values = sparse.value_lists(TEXTS, LISTS)
    positions = sparse.fit_positions(df, NUMBERS, values)
    return stage(sparse.encode(df, "k", "target", NUMBERS, values, positions), "cells"), positions


def names_of(positions):
    return {r.position: f"{r.source}_{r.value}" if r.source else r.value for r in positions.collect()}


def wide(rows):
    """The same columns as a pandas table."""
    out = pd.DataFrame([dict(zip(["k", "target", *NUMBERS, *TEXTS, "words"], row, strict=True)) for row in rows]).set_index("k")
    for c in TEXTS:
        for v in sorted({v for v in out[c] if v is not None}):
            out[f"{c}_{v}"] = (out[c] == v).astype(float)
    for w in ["api", "c", "go", "golang", "java"]:
        out[f"kw_{w}"] = [float((x or []).count(w)) for x in out["words"]]
    return out.drop(columns=[*TEXTS, "words"]).replace([np.inf], np.nan)


def test_cells_equal_the_wide_table(spark):
    df, rows = table(spark, 1)
    cells, positions = encoded(df)
    names, expected = names_of(positions), wide(rows)
    assert sorted(names) == list(range(len(names))) and set(names.values()) == set(expected.columns) - {"target"}
    got = {(r.k, names[r.position]): r.value for r in cells.collect()}
    for name in set(names.values()):
        for k, value in expected[name].items():
            have = got.get((k, name), 0.0)
            assert (have is None or have == float("inf")) if np.isnan(value) else have == value, (k, name)
    assert cells.groupBy("k", "position").count().filter("count > 1").isEmpty()
    stats = {names[r.position]: r for r in sparse.column_stats(cells, len(rows), len(NUMBERS)).collect()}
    for name, s in stats.items():
        column = expected[name].dropna()
        assert (s.n, s.least, s.greatest) == (len(column), column.min(), column.max()), name
        assert s.mean == pytest.approx(column.mean())


def chosen(df, rows, cut=0.85, quantile=0.25):
    cells, positions = encoded(df)
    stats = sparse.column_stats(cells, len(rows), len(NUMBERS))
    related = sparse.target_related(cells.filter("target <> -1"), "target", len(NUMBERS), stats, quantile)
    kept = sparse.not_redundant(cells, "k", related, stats, positions, len(NUMBERS), len(rows), cut)
    return cells, stats, related, kept, names_of(positions)


@pytest.mark.parametrize("seed,cut,quantile", [(1, 0.85, 0.0), (2, 0.3, 0.25), (3, 0.6, 0.25), (4, 0.1, 0.25)])
def test_filters_equal_the_wide_ones(spark, monkeypatch, seed, cut, quantile):
    monkeypatch.setattr(sparse, "BATCH_PAIRS", 500)
    df, rows = table(spark, seed)
    _, _, related, kept, names = chosen(df, rows, cut, quantile)
    expected = wide(rows)
    closed = expected[expected["target"] != -1]
    strength = closed.drop(columns="target").corrwith(closed["target"]).abs().dropna().drop("flat", errors="ignore").round(9)
    limit = np.quantile([*strength, 1.0], quantile)
    assert {names[r.position]: r.strength for r in related.collect()} == pytest.approx({c: v for c, v in strength.items() if v >= limit}, abs=1e-9)
    order = sorted((c for c in strength.index if strength[c] >= limit), key=lambda c: (-strength[c], c))
    matrix = expected[order].corr().abs().fillna(0).to_numpy()
    want = [c for j, c in enumerate(order) if not (matrix[:j, j] >= cut).any()]
    assert sorted(r.name for r in kept.collect()) == sorted(want)
    if seed == 1:  # never in one row, and each the other's complement
        assert {"t_p", "t_q"} <= set(order) and len({"t_p", "t_q"} & set(want)) == 1


def test_the_wide_operators_agree(spark):
    df, rows = table(spark, 5)
    _, _, related, kept, names = chosen(df, rows, quantile=0.0)
    cells_of = lambda r: [None if np.isnan(v) else float(v) for v in r]
    # Names that Spark tells apart, in the same order.
    columns = sorted(c for c in wide(rows).columns if c != "target")
    plain = {c: f"c{i:02}" for i, c in enumerate(columns)}
    data = [(k, int(r["target"]), *cells_of(r[columns])) for k, r in wide(rows).iterrows()]
    frame = spark.createDataFrame(data, "k string, target int, " + ", ".join(f"{plain[c]} double" for c in columns))
    order = correlation.target_related(frame.filter("target <> -1"), list(plain.values()), "target", 0.0)
    assert set(order) == {plain[names[r.position]] for r in related.collect()}
    order = [plain[names[r.position]] for r in related.join(related.sparkSession.createDataFrame(list(names.items()), "position long, name string"), "position").orderBy(F.desc("strength"), "name").collect()]
    assert sorted(correlation.not_redundant(frame, order, 0.85)) == sorted(plain[r.name] for r in kept.collect())


def test_vectors_hold_scaled_values(spark):
    df, rows = table(spark, 6)
    cells, stats, _, kept, names = chosen(df, rows)
    places = sparse.numbered_in_order(kept.select("position", "strength", "name"), [F.desc("strength"), "name"], "place")
    selected = places.join(stats, "position")
    made = sparse.scaled_vectors(cells, "k", "target", selected, places.count())
    order = [r.name for r in places.orderBy("place").collect()]
    expected = wide(rows)[order]
    low, span = expected.min(), expected.max() - expected.min()
    scaled = ((expected - low) / span.where(span > 0, 1)).fillna(0)
    got = {r.k: r.x for r in made.select("k", vector_to_array("features").alias("x")).collect()}
    assert set(got) == set(expected.index)
    for k, x in got.items():
        np.testing.assert_allclose(x, scaled.loc[k].to_numpy(), atol=1e-12)


def test_fifty_thousand_categories(spark):
    n = 50_000
    df = spark.range(n).select(
        F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 2).cast("int").alias("target"), (F.col("id") % 7).cast("double").alias("a"),
        F.concat(F.lit("v"), "id").alias("s"), F.concat(F.lit("half"), (F.col("id") % 2).cast("string")).alias("t"),
    )
    values = sparse.value_lists(["s", "t"], {})
    positions = sparse.fit_positions(df, ["a"], values)
    assert positions.count() == n + 3
    cells = stage(sparse.encode(df, "k", "target", ["a"], values, positions), "cells")
    stats = sparse.column_stats(cells, n, 1)
    related = sparse.target_related(cells, "target", 1, stats, 0.25)
    kept = sparse.not_redundant(cells, "k", related, stats, positions, 1, n, 0.85)
    # Of the two halves, each the other's complement and the target itself, one stays.
    assert kept.filter("source = 't'").count() == 1 and kept.count() == related.count() - 1
    places = sparse.numbered_in_order(kept.select("position", "strength", "name"), [F.desc("strength"), "name"], "place")
    made = sparse.scaled_vectors(cells, "k", "target", places.join(stats, "position"), places.count())
    first = made.orderBy("k").first()
    assert made.count() == n and first.features.size == kept.count() and first.features.numNonzeros() <= 3


def test_no_rows_and_no_values(spark):
    df, rows = table(spark, 7)
    empty = df.limit(0)
    cells, positions = encoded(empty)
    assert positions.count() == len(NUMBERS) and cells.count() == 0
    stats = sparse.column_stats(cells, 0, len(NUMBERS))
    related = sparse.target_related(cells, "target", len(NUMBERS), stats, 0.25)
    assert related.count() == 0
    assert sparse.not_redundant(cells, "k", related, stats, positions, len(NUMBERS), 0, 0.85).count() == 0
    assert sparse.scaled_vectors(cells, "k", "target", stats.withColumn("place", F.lit(0)), 1).count() == 0


@pytest.mark.parametrize("limit", [0, sparse.TABLE_PAIRS])
def test_sums_of_pairs_equal_plain_ones_and_pairs_are_not_sorted(monkeypatch, limit):
    """Of few columns the pairs of cells are counted in their places; all of them were sorted before."""
    monkeypatch.setattr(sparse, "TABLE_PAIRS", limit)
    rng = np.random.default_rng(2)
    numbers, n, width = 3, 200, 12
    x = np.where(rng.random((n, width)) < 0.1, np.nan, rng.integers(1, 4, (n, width)))
    # Counts, which come after the numbers, have no missing cells: what is missing there isn't in the row.
    lists = [[{"position": p, "x": None if np.isnan(v) else v, "s": float(np.nansum(x[:, p])), "d": 1.0, "g": 3.0} for p, v in enumerate(r) if p < numbers or not np.isnan(v)] for r in x]
    kind = pa.list_(pa.struct([("position", pa.int64()), *[(c, pa.float64()) for c in "xsdg"]]))
    sorted_, unique = [], np.unique
    monkeypatch.setattr(sparse.np, "unique", lambda a, **kw: sorted_.append(len(a)) or unique(a, **kw))
    (out,) = sparse._pair_sums(iter([pa.RecordBatch.from_arrays([pa.array(lists, kind)], ["cells"])]), numbers, float(n), 0.5)
    cells = sum(map(len, lists))
    assert max(sorted_) == cells if limit else max(sorted_) > cells
    seen = {(r["a"], r["b"]): r for r in out.to_pylist()}
    assert len(seen) == width * (width - 1) // 2
    for (i, j), r in seen.items():
        a, b = x[:, i], x[:, j]
        ma, mb = np.isnan(a), np.isnan(b)
        there = (i < numbers or ~ma) & (j < numbers or ~mb)  # the row holds both cells
        assert r["xy"] == np.nansum(a * b)
        assert (r["ab"], r["aab"]) == (np.nansum(a[there & mb]), np.nansum(a[there & mb] ** 2))
        assert (r["ba"], r["bba"]) == (np.nansum(b[there & ma]), np.nansum(b[there & ma] ** 2))
        assert r["mm"] == (there & ma & mb).sum()

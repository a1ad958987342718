import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from staffcast.functions.wide import double_array
from staffcast.operators import binning, correlation, fallback, outliers, quantiles, scaling
from staffcast.staging import broadcastable, lookup_join, stage, value_bytes


def hot_groups():
    """One key with most rows, one with a single value repeated, one small, one missing key."""
    rng = np.random.default_rng(5)
    parts = [
        pd.DataFrame({"g": "hot", "x": rng.normal(0, 100, 4000)}),
        pd.DataFrame({"g": "same", "x": np.repeat(7.0, 900)}),
        pd.DataFrame({"g": "ties", "x": rng.integers(0, 4, 1500).astype(float)}),
        pd.DataFrame({"g": "few", "x": [3.0, 1.0, None, 2.0]}),
        pd.DataFrame({"g": None, "x": rng.exponential(5, 800)}, dtype=object),
        pd.DataFrame({"g": "none", "x": [None]}, dtype=object),
    ]
    return pd.concat(parts).astype({"x": float})


@pytest.mark.parametrize("state_rows,buckets", [(10**6, 1024), (500, 1024), (1, 64)])
def test_group_quantiles_are_exact_on_every_path(spark, monkeypatch, state_rows, buckets):
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    pdf = hot_groups()
    df = spark.createDataFrame(list(pdf.itertuples(index=False, name=None)), "g string, x double").replace(float("nan"), None)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.group_quantiles(df, ["g"], "x", probs, state_rows).collect()
    assert {r["g"] for r in got} == {"hot", "same", "ties", "few", None}
    for row in got:
        values = pdf[pdf["g"].isna() if row["g"] is None else pdf["g"] == row["g"]]["x"].dropna()
        assert row["n"] == len(values)
        np.testing.assert_allclose(row["q"], values.quantile(probs).to_numpy(), rtol=1e-12)


def test_narrowing_holds_at_the_ends_of_numbers(spark, monkeypatch):
    """Equal to sorting for very large, very small, infinite and crowded values, and no plan sorts or numbers rows."""
    monkeypatch.setattr(quantiles, "BUCKETS", 130)
    rng = np.random.default_rng(6)
    crowded = [1.0 + k * 2.0**-52 for k in range(40)]
    groups = {
        "huge": [-1.7e308, 1.7e308, 1.6e308, -1.0, 0.0, 3.0], "tiny": [5e-324, 1e-323, 0.0, -5e-324, 1.5e-323], "crowded": [*crowded, 9.0],
        "mixed": [*(10.0 ** rng.uniform(-300, 300, 50) * rng.choice([-1, 1], 50))], "infinite": [float("-inf"), float("inf"), 1.0, 2.0, 3.0, 4.0, 5.0],
    }
    df = spark.createDataFrame([(g, float(v)) for g, values in groups.items() for v in values], "g string, x double").repartition(3)
    probs = [0.0, 0.2, 0.5, 0.75, 1.0]
    made = quantiles.group_quantiles(df, ["g"], "x", probs, 1)
    assert "Window" not in made._jdf.queryExecution().optimizedPlan().toString()
    for row in made.collect():
        values = sorted(groups[row["g"]])
        for p, q in zip(probs, row["q"], strict=True):
            at = (len(values) - 1) * p
            low, high = values[math.floor(at)], values[math.ceil(at)]
            assert q == (low if low == high else low * (1 - at % 1) + high * (at % 1)), (row["g"], p)


def test_column_quantiles_of_large_columns(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.normal(size=3000), "b": rng.integers(0, 5, 3000).astype(float)})
    df = spark.createDataFrame(pdf).withColumn("c", F.lit(None).cast("double"))
    for state_rows in (10**6, 100):
        got = quantiles.column_quantiles(df, {"a": [0.3, 0.5], "b": [0.75], "c": [0.5]}, state_rows)
        np.testing.assert_allclose(got["a"], pdf["a"].quantile([0.3, 0.5]))
        assert got["b"] == [pdf["b"].quantile(0.75)] and got["c"] is None


@pytest.mark.parametrize("parts", [4, 10])
@pytest.mark.parametrize("kind", ["continuous", "ties", "constant", "missing", "tiny"])
def test_bins_equal_pandas(spark, parts, kind):
    rng = np.random.default_rng(parts)
    values = {
        "continuous": rng.normal(size=301),
        "ties": rng.integers(0, 6, 400).astype(float),
        "constant": np.repeat(2.0, 20),
        "missing": np.where(rng.random(200) < 0.3, np.nan, rng.integers(0, 50, 200)),
        "tiny": np.array([1.0, 2.0, 3.0]),
    }[kind]
    expected = pd.qcut(pd.Series(values), parts, labels=False, duplicates="drop")
    rows = [(i, None if np.isnan(v) else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x double")
    edges = binning.fit_edges(df, {"x": [parts]})["x"][parts]
    got = [r[0] for r in df.orderBy("i").select(binning.bin_index(F.col("x"), edges)).collect()]
    assert got == [None if np.isnan(e) else int(e) for e in expected]


def test_bins_refuse_equal_edges_on_request_and_clamp_new_values(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 1, 2]], "x double")
    with pytest.raises(ValueError, match="not unique"):
        binning.fit_edges(df, {"x": [4]}, "raise")
    new = spark.createDataFrame([(-9.0,), (99.0,)], "x double")
    got = [r[0] for r in new.select(binning.bin_index(F.col("x"), [0.0, 1.0, 2.0])).collect()]
    assert got == [0, 1]


def test_lookup_join_with_one_hot_key(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    table = stage(df.select("k").distinct().withColumn("w", F.length("k")), "lengths")
    for limit in (None, 0):
        found = lookup_join(df, table, ["k"], limit=limit)
        assert found.count() == 2000 and found.filter("w <> length(k)").isEmpty()


def test_broadcast_bound_counts_bytes(spark):
    table = stage(spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.sequence(F.lit(1), F.lit(200)).alias("list")), "wide")
    assert 10 * (1000 + 400) < value_bytes(table) < 10 * 2500
    assert broadcastable(table) and not broadcastable(table, 1000)


def test_infinite_values_leave_finite_bounds(spark):
    df = spark.createDataFrame([(1, float("inf")), (2, 1.0), (3, 3.0), (4, float("-inf")), (5, None)], "i int, x double")
    bounds = scaling.fit_bounds(df, ["x"])
    assert bounds == {"x": (1.0, 3.0)}
    assert [r.x for r in scaling.scale_columns(df, ["i"], bounds).orderBy("i").collect()] == [None, 0.0, 1.0, None, None]


def test_lookup_join_gives_the_same_rows_broadcast_and_shuffled(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), (None, 2), ("z", 3)], "k string, v int")
    table = stage(spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 3.0)], "k string, w double"), "table")
    for null_safe in (False, True):
        for how in ("left", "inner", "left_semi"):
            one = lookup_join(df, table, ["k"], how, null_safe)
            two = lookup_join(df, table, ["k"], how, null_safe, limit=0)
            assert one.columns == two.columns
            assert sorted(one.collect(), key=str) == sorted(two.collect(), key=str)


LEVELS = (("p", "r"), ("r",))


def test_fallback_uses_the_most_specific_level_and_never_a_missing_key(spark):
    source = spark.createDataFrame(
        [("dev", "N", 10.0), ("dev", "N", 20.0), ("qa", "N", 99.0), (None, "N", 1.0), ("dev", None, 500.0), ("dev", "S", None)],
        "p string, r string, v double",
    )
    table = stage(fallback.level_medians(source, LEVELS, "v"), "levels")
    found = {(r["level"], r["p"], r["r"]): r["median"] for r in table.collect()}
    assert found == {(0, "dev", "N"): 15.0, (0, "qa", "N"): 99.0, (1, None, "N"): 15.0}
    rows = spark.createDataFrame(
        [(1, "dev", "N", 7.0), (2, "dev", "N", None), (3, "ux", "N", None), (4, None, "N", None), (5, "dev", "S", None), (6, "dev", None, None)],
        "i int, p string, r string, own double",
    )
    filled = fallback.fill_by_levels(rows, table, LEVELS, {"out": (F.col("own"), "median")})
    assert filled.columns == ["i", "p", "r", "own", "out"]
    assert {r["i"]: r["out"] for r in filled.collect()} == {1: 7.0, 2: 15.0, 3: 15.0, 4: 15.0, 5: None, 6: None}


def test_scaling(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0, None), (2, 4.0, 5.0, None), (3, None, 5.0, None)], "i int, a double, b double, c double")
    bounds = scaling.fit_bounds(df, ["a", "b", "c"])
    rows = scaling.scale_columns(df, ["i"], bounds).orderBy("i").collect()
    assert [tuple(r) for r in rows] == [(1, 0.0, 0.0, None), (2, 1.0, 0.0, None), (3, None, 0.0, None)]
    assert scaling.column_stats(df, ["a"])["a"] == scaling.ColumnStats(2, 2.0, 0.0, 4.0)


def wide_frame():
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame(rng.normal(size=(400, 4)), columns=["a", "b", "c c", "d"])
    pdf["e"] = pdf["a"] * 2 + rng.normal(scale=0.1, size=400)
    pdf["f"] = pdf["b"] + 1e6
    pdf["k"] = 3.7
    pdf.loc[rng.random(400) < 0.3, "b"] = None
    pdf.loc[rng.random(400) < 0.5, "d"] = None
    pdf["y"] = (rng.random(400) < 0.4).astype(float)
    return pdf


def test_correlations_equal_pandas_with_missing_and_constant_columns(spark):
    pdf = wide_frame()
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    names = list(pdf.columns)
    expected = pdf.corr().to_numpy()
    expected[names.index("k")] = expected[:, names.index("k")] = np.nan
    np.testing.assert_allclose(correlation.correlation_matrix(df, names), expected, atol=1e-9)
    found = {r["name"]: r["r"] for r in correlation.target_correlations(df, names[:-1], "y").collect()}
    for name in names:
        want = expected[names.index(name), -1]
        assert (found[name] is None) if np.isnan(want) else found[name] == pytest.approx(want, abs=1e-9)


def test_feature_filters(spark):
    pdf = wide_frame()
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    strength = pdf.drop(columns="k").corr()["y"].abs()
    cut = strength.quantile(0.25)
    names = [c for c in pdf.columns if c != "y"]
    expected = sorted((c for c in names if c != "k" and strength[c] >= cut), key=lambda c: -strength[c])
    assert correlation.target_related(df, names, "y", 0.25) == expected
    # "e" follows "a"; a column dropped for redundancy still removes its own followers.
    assert correlation.not_redundant(df, ["a", "e", "c c"], 0.85) == ["a", "c c"]
    chain = spark.createDataFrame(pd.DataFrame({"p": pdf["a"], "q": pdf["a"], "r": pdf["a"], "s": pdf["c c"]}))
    assert correlation.not_redundant(chain, ["p", "q", "r", "s"], 0.85) == ["p", "s"]


def brute_lof(ids, points, k):
    """Every pair, neighbours in order of distance and key."""
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    near = []
    for i in range(len(points)):
        order = sorted((j for j in range(len(points)) if j != i), key=lambda j: (d[i, j], ids[j]))[:k]
        near.append(order)
    kdist = np.array([d[i, near[i][-1]] for i in range(len(points))])
    lrd = np.array([1 / (np.mean([max(kdist[j], d[i, j]) for j in near[i]]) + 1e-10) for i in range(len(points))])
    return {ids[i]: np.mean(lrd[near[i]]) / lrd[i] for i in range(len(points))}


@pytest.mark.parametrize("cell_rows,block_rows", [(10**6, 10**6), (15, 10**6), (15, 7), (10**6, 11)])
def test_outlier_factor_equals_brute_force(spark, cell_rows, block_rows):
    rng = np.random.default_rng(1)
    points = np.concatenate([
        rng.normal(size=(60, 3)),
        np.repeat(rng.normal(size=(1, 3)), 30, axis=0),  # a vector with many copies
        np.repeat(rng.normal(size=(5, 3)), 3, axis=0),  # vectors with fewer copies than neighbours
        rng.integers(0, 2, (25, 3)).astype(float),  # a lattice, full of ties
        [[40.0, 40.0, 40.0]],
    ])
    ids = [int(i) for i in rng.permutation(len(points))]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in zip(ids, points)], "id long, a double, b double, c double")
    found = outliers.local_outlier_factor(df, "id", double_array(["a", "b", "c"]), 7, cell_rows, block_rows)
    got = {r["id"]: r["lof"] for r in found.collect()}
    expected = brute_lof(ids, points, 7)
    assert got.keys() == expected.keys()
    np.testing.assert_allclose([got[i] for i in ids], [expected[i] for i in ids], rtol=1e-6)
    kept = outliers.inliers(df, "id", found, 1.5)
    assert ids[-1] not in {r["id"] for r in kept.select("id").collect()}


def test_ranges_of_few_rows_are_counted_in_one_pass(spark, monkeypatch):
    """Two passes over the rows of a large group: one that finds the range of a rank, one that counts its values."""
    staged = []
    monkeypatch.setattr(quantiles, "BUCKETS", 16)
    monkeypatch.setattr(quantiles, "stage", lambda df, name, *rest: staged.append(name) or stage(df, name, *rest))
    values = np.random.default_rng(9).permutation(np.concatenate([1 + np.arange(3000) / 3000, np.full(60, 1.25)]))
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, x double")
    probs = [i / 10 for i in range(11)]
    row = quantiles.group_quantiles(df, ["g"], "x", probs, 2000).first()
    np.testing.assert_allclose(row["q"], np.quantile(values, probs), rtol=1e-12)
    assert row["n"] == len(values) and staged.count("narrowed") <= 2 and "sizes" in staged

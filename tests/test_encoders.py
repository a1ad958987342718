from datetime import date

import pytest
from pyspark.sql import functions as F

from staffcast.operators import encoding, filters, profile, rates, sampling, shares, training
from staffcast.staging import stage


def test_filters_keep_or_drop_missing_values(spark):
    df = spark.createDataFrame(
        [(1, "a", 4.0), (2, None, 50.0), (3, "b", None), (4, "a", 7.0)], "i int, s string, x double"
    )

    def ids(rows):
        return sorted(r["i"] for r in rows.collect())

    assert ids(filters.without_values(df, "s", ["a"])) == [2, 3]
    assert ids(filters.above(df, "x", 5)) == [2, 3, 4]
    assert ids(filters.outside_band(df, "x", 5, 50)) == [1, 2, 3]
    assert ids(filters.only_value(df, "s", "a")) == [1, 4]
    assert ids(filters.latest_rows(df, "x")) == [2]
    days = spark.createDataFrame([(1, date(2001, 1, 1)), (2, date(2001, 1, 3)), (3, None)], "i int, request_creation_date date")
    assert ids(filters.recent(days, date(2001, 1, 12), 10)) == [2]
    closed = spark.createDataFrame([(1, "Closed", None), (2, "Open", None), (3, None, None), (4, "Closed", "d")], "i int, status string, closure_date string")
    assert ids(filters.without_undated_closed(closed)) == [2, 3, 4]
    targets = spark.createDataFrame([(1, -1), (2, 0), (3, None)], "i int, target int")
    opened, rest = filters.split_by_target(targets)
    assert ids(opened) == [1] and ids(rest) == [2, 3]


def test_unique_keys_are_enforced(spark):
    filters.assert_unique(spark.range(5), "id")
    with pytest.raises(ValueError, match="not unique"):
        filters.assert_unique(spark.range(5).union(spark.range(1)), "id")


def test_rare_values_become_other(spark):
    df = spark.createDataFrame([("a",)] * 97 + [("b",)] * 2 + [("c",)] + [(None,)] * 50, "v string")
    kept = shares.frequent_values(df, {"v": 2.0})
    assert kept == {"v": ["a", "b"]}
    got = {r["v"]: r["g"] for r in df.withColumn("g", shares.group_rare(F.col("v"), kept["v"])).distinct().collect()}
    assert got == {"a": "a", "b": "b", "c": "Other", None: "Other"}
    total = {r["v"]: (r["n"], r["share"]) for r in shares.value_shares(df, "v").collect()}
    assert total["a"] == (97, 0.97) and None not in total


def test_favourable_values(spark):
    def group(name, wins, losses, still_open=0):
        return [(name, 1)] * wins + [(name, 0)] * losses + [(name, -1)] * still_open

    rows = group("best", 5, 0) + group("good", 4, 1) + group("poor", 1, 4) + group("never", 0, 9) + group("small", 4, 0)
    rows += group("waiting", 2, 0, 8) + group(None, 6, 0)
    df = spark.createDataFrame(rows, "c string, target int")
    found = {r["value"]: (r["n"], r["rate"]) for r in rates.success_rates(df, ["c"]).collect()}
    assert found == {"best": (5, 100.0), "good": (5, 80.0), "poor": (5, 20.0), "waiting": (10, 20.0)}
    best = stage(rates.favourable_values(rates.success_rates(df, ["c"]), 0.75), "best")
    assert {r["value"] for r in best.collect()} == {"best"}  # the cut is 85
    flags = {r["c"]: r["f"] for r in rates.add_favourable_flags(df, best, {"c": "f"}).collect()}
    assert flags["best"] == 1 and flags["good"] == 0 and flags[None] == 0
    none = stage(rates.favourable_values(rates.success_rates(df.filter("target = 0"), ["c"])), "none")
    assert none.count() == 0


def test_languages(spark):
    df = spark.createDataFrame([("r1", "English|Spanish"), ("r2", " French |English|English"), ("r3", None)], "k string, l string")
    assert encoding.fit_values(df, "l") == ["English", "French", "Spanish"]
    columns = encoding.value_columns("l", ["English", "French"], "lang_")
    got = {r["k"]: (r["lang_English"], r["lang_French"]) for r in df.withColumns(columns).collect()}
    assert got == {"r1": (1, 0), "r2": (2, 1), "r3": (0, 0)}
    long = {(r["k"], r["v"]): r["n"] for r in encoding.value_counts_by_key(df, "k", "l", "v", "No").collect()}
    assert long[("r2", "English")] == 2 and long[("r3", "No")] == 1


def test_keywords(spark):
    docs = [(i, "python api") for i in range(2)] + [(2, "apis apis gestion"), (3, "the rare word")] + [(4, None)]
    df = spark.createDataFrame(docs, "i int, t string")
    folded = F.coalesce("t", F.lit(""))
    terms = encoding.fit_terms(df, folded, ["the"], 0.2)
    assert terms == ["api", "apis", "gestion", "python", "rare", "word"]
    assert encoding.fit_terms(df, folded, ["the"], 0.4) == ["api", "python"]
    made = {r["i"]: r for r in encoding.add_term_columns(df, folded, ["the"], terms).collect()}
    assert [made[i]["kw_api_group"] for i in range(5)] == [1, 1, 2, 0, 0]
    assert "kw_api" not in made[0].asDict() and made[2]["kw_gestion"] == 1
    assert encoding.merge_terms(["api"]) == {"api": ["api"]}
    assert encoding.add_term_columns(df, folded, [], []).columns == df.columns


def test_names_that_differ_in_case_alone(spark):
    df = spark.createDataFrame([(1, "High", "English|english", "c"), (2, "high", "english", "b_c"), (3, "HIGH", None, "x")], "i int, a string, l string, a_b string")
    made = df.withColumns(encoding.value_columns("l", encoding.fit_values(df, "l"), "lang_"))
    made = made.withColumns(encoding.one_hot_columns(encoding.fit_categories(df, ["a", "a_b"])))
    got = {r["i"]: r.asDict() for r in made.collect()}
    assert got[1]["lang_English"] == 1 and got[1]["lang_english_2"] == 1 and got[2]["lang_english_2"] == 1 and got[2]["lang_English"] == 0
    assert [[got[i][c] for c in ("a_HIGH", "a_High_2", "a_high_3")] for i in (1, 2, 3)] == [[0, 1, 0], [0, 0, 1], [1, 0, 0]]
    assert encoding.distinct_names(["x_2", "x", "X"]) == ["x_2", "x", "X_3"]


def test_sparse_one_hot_has_no_limit(spark):
    df = spark.range(30_000).select("id", F.concat(F.lit("v"), "id").alias("wide"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("few"))
    index = encoding.fit_index(df, ["few", "wide"])
    assert index.count() == 30_002
    made = encoding.one_hot_sparse(df, "id", index)
    at = {(r["column"], r["value"]): r["position"] for r in index.collect()}
    assert sorted(at.values()) == list(range(30_002)) and at[("few", "1")] == 0
    rows = made.filter("id IN (0, 4)").orderBy("id").collect()
    assert [r["positions"] for r in rows] == [[at[("wide", "v0")]], [at[("few", "1")], at[("wide", "v4")]]]


def test_one_hot_and_alignment(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y z"), (3, None)], "i int, s string")
    categories = encoding.fit_categories(df, ["s"])
    assert categories == {"s": ["x", "y z"]}
    hot = df.withColumns(encoding.one_hot_columns(categories))
    aligned = encoding.align_columns(hot, ["i"], ["s_y z", "s_gone"])
    assert sorted(map(tuple, aligned.collect())) == [(1, 0, 0.0), (2, 1, 0.0), (3, 0, 0.0)]


def test_negative_salary_effect(spark):
    rows = [("a", 0, 10.0), ("a", 1, 5.0), ("b", 0, 1.0), ("b", 1, 5.0), ("c", 1, 5.0), ("d", -1, 5.0), (None, 0, 1.0)]
    df = spark.createDataFrame(rows, "g string, target int, v double")
    got = {r["g"]: r["neg_corr"] for r in profile.negative_salary_effect(df, "g", "v").collect()}
    assert got == {"a": 1, "b": 0, "c": 0}


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_folds_equal_a_single_numbering(spark, digits):
    df = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    got = {r["k"]: r["fold"] for r in sampling.stratified_folds(df.repartition(7), "k", "y", 5, digits).collect()}
    import hashlib

    for y in (0, 1):
        keys = sorted((f"k{i}" for i in range(500) if int(i % 3 == 0) == y), key=lambda k: hashlib.md5(k.encode()).hexdigest())
        assert [got[k] for k in keys] == [n % 5 for n in range(len(keys))]


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    one = {r[0] for r in sampling.hash_split(df, "id", 85)[0].collect()}
    two = {r[0] for r in sampling.hash_split(df.repartition(9), "id", 85)[0].collect()}
    assert one == two and 800 < len(one) < 900


def test_class_weights_and_auc(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (0, 0.4), (1, 0.4), (1, 0.9)], "y int, s double")
    weights = {r["y"]: r["weight"] for r in sampling.with_class_weights(df, "y").collect()}
    assert weights == {0: 5 / 6, 1: 5 / 4}
    assert training.exact_auc(df, "y", "s") == pytest.approx((1 + 0.5 + 0.5 + 3) / 6)


def test_top_features():
    ranked = [("a", 0.6), ("b", 0.2), ("c", 0.1), ("d", 0.1)]
    assert training.top_features(ranked) == ["a"]

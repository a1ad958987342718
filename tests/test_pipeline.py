"""The whole run on the smallest test tables."""

from dataclasses import replace
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import views as V
from staffcast.plans.cleaning import clean_requests
from staffcast.plans.features import KEY, FeatureModel, fit_features
from staffcast.plans.scoring import load_models, save_run, train_and_score
from staffcast.settings import Settings
from staffcast.sinks.runs import find_run, published_days, read_output
from staffcast.staging import stage
from staffcast.streaming.scoring import refit_scorer, score_rows
from staffcast.streaming.store import RequestStore

DATA = "/root/testdata/sf0.001"
CONF = Settings(as_of=V.AS_OF, folds=2, trees=5, min_word_share=0.3)
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def inputs(spark):
    return stage(V.requests(spark, DATA), "requests"), stage(V.salary(spark, DATA), "salary")


@pytest.fixture(scope="module")
def run(inputs):
    return train_and_score(*inputs, CONF, {"maxDepth": [3]})


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def test_applying_the_model_to_its_fitting_data_gives_the_fitted_rows(spark, inputs, run, tmp_path):
    final, model = run.features.final, run.features.model
    assert model.feature_names() and len(model.feature_names()) == model.width
    again = model.transform(clean_requests(inputs[0], CONF))
    assert again.columns == final.columns and rows(again) == rows(final)
    model.save(str(tmp_path / "model"))
    loaded = FeatureModel.load(spark, str(tmp_path / "model"))
    assert loaded.feature_names() == model.feature_names() and loaded.edges == model.edges
    assert rows(loaded.transform(clean_requests(inputs[0], CONF))) == rows(final)


def test_features_are_complete_and_scaled(run):
    encoded, final, columns = run.features.encoded, run.features.final, run.features.model.tables["columns"]
    names = {f"{r['source']}_{r['value']}" if r["source"] else r["value"] for r in columns.collect()}
    for name in (
        "FavorableClient", "CommercialFavorable", "ResponsibleFavorable", "MultiResponsible", "NumLanguages", "lang_English",
        "ProfileAvgSalary", "ProfileAvgSalary12", "SalaryGrowthFlag", "MixedProbCategory", "MultipleResources",
        "is_NegotiatedRate", "is_FullRemote", "EarlyRequest", "DaysDiffCategory", "TechHoursQuartile", "tech_hours",
        "TechTenureDecile", "JobLevelCategory_senior", "GroupedRegion_NATION_1", "month_created_January",
    ):
        assert name in names, name
    for name in ("RequestSalary", "SalaryQuartile", "neg_corr", "minimum_requirements", "lang_No"):
        assert name not in names, name
    assert encoded.select(KEY).distinct().count() == final.count() == final.select(KEY).distinct().count()
    assert encoded.groupBy(KEY, "position").count().filter("count > 1").isEmpty()
    x = vector_to_array("features")
    assert final.filter(F.size(x) != run.features.model.width).isEmpty()
    assert final.filter(F.exists(x, lambda v: (v < -1e-9) | (v > 1 + 1e-9))).isEmpty()


def test_predictions_cover_the_open_requests(run):
    made = run.predictions
    opened = run.features.final.filter("target = -1")
    assert rows(made.select(KEY)) == rows(opened.select(KEY)) and not opened.isEmpty()
    assert made.filter("probability < 0 OR probability > 1 OR prediction NOT IN (0, 1)").isEmpty()
    assert made.filter("region IS NULL OR relevant_features IS NULL OR pending_update").isEmpty()
    assert sum(v for _, v in run.importances) == pytest.approx(1.0)


def test_saved_run_scores_like_the_fresh_one(spark, inputs, run, tmp_path):
    path = str(tmp_path)
    saved = [save_run(run, *inputs, CONF, path) for _ in range(2)]
    assert [s.version for s in saved] == [1, 2] and find_run(spark, path) == saved[1]
    assert published_days(spark, path) == [V.AS_OF]
    assert read_output(spark, path, "predictions").count() == run.predictions.count()
    assert read_output(spark, path, "requests").count() == inputs[0].filter("request_creation_date >= '2000-02-09'").count()
    model, forest = load_models(spark, path, V.AS_OF)
    scores = score_rows(inputs[0], model, forest)
    kept = run.predictions.select(KEY, F.col("prediction").alias("pred"), F.col("probability").alias("proba"))
    assert set(rows(kept)) <= set(rows(scores))


def test_refitting_on_the_same_rows_scores_the_same(spark, inputs, run, tmp_path):
    store = RequestStore(spark, str(tmp_path / "store"), buckets=4)
    store.create(inputs[0].withColumn("change_date", F.lit(None).cast("date")))
    some = inputs[0].filter("request_creation_date >= '2001-03-01'")
    score = refit_scorer(store, inputs[1], run.features.model, run.forest, CONF)
    assert rows(score(some, V.AS_OF)) == rows(score_rows(some, run.features.model, run.forest))


def test_the_day_of_scoring_decides(inputs, run):
    """Four months later other requests are recent, and some open ones count as closed."""
    later = V.AS_OF + timedelta(days=122)
    now, then = (clean_requests(inputs[0], replace(CONF, as_of=day)) for day in (V.AS_OF, later))
    scored = score_rows(inputs[0], run.features.model, run.forest, later)
    eligible = run.features.model.eligible(then)
    assert rows(scored.select(KEY)) == rows(eligible.select(KEY))
    assert now.filter("target = -1").count() != then.filter("target = -1").count()


def test_area_of_the_chosen_parameters(run):
    assert 0 <= run.auc <= 1 and run.auc == round(run.auc, 4)
    assert {r["roc_auc"] for r in run.predictions.select("roc_auc").distinct().collect()} == {round(run.auc, 2)}


def test_repeated_keys_are_refused(inputs):
    with pytest.raises(ValueError, match="not unique"):
        fit_features(inputs[0].union(inputs[0]), inputs[1], CONF)

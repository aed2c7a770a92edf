"""Models on the view: what must hold whatever the fitted values are."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfcast import catalog
from shelfcast.catalog.modelling import FOOD, PROFILE_SETTINGS
from shelfcast.functions import metrics
from shelfcast.operators import models as M
from shelfcast.plans.profile import run_profile
from shelfcast.plans.race import run_race
from shelfcast.sources.retail_view import FOLDS, PREFIX_CATEGORY, retail_view
from shelfcast.sources.schema import VIEW_ROLES

QUERIES, CHECKS = catalog.QUERIES, catalog.CHECKS
UNCHECKED = sorted(set(QUERIES) - set(CHECKS))


@pytest.mark.parametrize("name", [n for n in UNCHECKED if n not in {"profile_plan", "race_plan"}])
def test_query_gives_rows(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    assert rows
    for column in ("rmse", "prediction"):
        if column in df.columns:
            assert all(np.isfinite(r[column]) for r in rows)
    if name == "ensemble_plan":
        scored_once(spark, sf_dir, df)


def scored_once(spark, sf_dir, predictions):
    """Every unlabelled row has one non-negative prediction."""
    test = retail_view(spark, sf_dir, "item_id", "outlet_id", "source").filter("source = 'test'").drop("source")
    found = predictions.filter("sales >= 0").select("item_id", "outlet_id")
    assert found.exceptAll(test).count() == 0 and test.exceptAll(found).count() == 0


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(400, 3))
    y = 3.0 * x[:, 0] - 2.0 * x[:, 1] + 5.0 + r.normal(size=400) * 0.1
    data = [(Vectors.dense(a), float(b), i % 4) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, ["features", "label", "fold"]).cache(), x, y


def test_ridge_is_the_closed_form(table):
    df, x, y = table
    alpha = 7.0
    model = M.ridge(df, alpha, tolerance=1e-10).fit(df).stages[-1]
    xc, yc = x - x.mean(0), y - y.mean()
    expected = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    assert model.coefficients.toArray() == pytest.approx(expected, rel=1e-4)


def test_lasso_drops_the_idle_feature(table):
    df, _, _ = table
    model = M.lasso(0.2).fit(df).stages[-1]
    assert model.coefficients[2] == 0.0 and model.coefficients[0] > 2


def test_failed_candidate_scores_infinity_and_says_why(table):
    df, _, _ = table
    bad = M.Candidate("bad", {}, lambda part: M.gbt({"max_depth": 99}))
    good = M.Candidate("good", {}, lambda part: M.lasso(0.01))
    scores = M.cross_validate(df, [bad, good], 4)
    assert scores[0] == float("inf") and scores[1] < 0.2 and "maxDepth" in bad.error
    assert M.best_of([bad, good], scores) == 1
    with pytest.raises(RuntimeError, match="maxDepth"):
        M.search(df, "bad", [{"max_depth": 99}, {"max_depth": 98}], lambda part, s: M.gbt(s), 4)


def test_other_failures_end_the_search(table):
    def broken(part):
        raise OSError("lost")

    with pytest.raises(OSError):
        M.cross_validate(table[0], [M.Candidate("broken", {}, broken)], 4)


def test_unknown_settings_are_refused():
    with pytest.raises(ValueError, match="reg_lambda"):
        M.gbt({"reg_lambda": 1.0})


def test_ridge_with_more_terms_than_the_normal_solver_takes(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 92))
    y = x[:, 0] * x[:, 1] + 2.0 * x[:, 2] + r.normal(size=300) * 0.1
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"]).cache()
    model = M.ridge(df, 50.0, degree=2, tolerance=1e-10).fit(df)
    terms = np.array([row["_terms"].toArray() for row in model.transform(df).select("_terms").collect()])
    assert terms.shape[1] > 4096
    tc, yc = terms - terms.mean(0), y - y.mean()
    dual = np.linalg.solve(tc @ tc.T + 50.0 * np.eye(300), yc)
    expected = tc @ (tc.T @ dual) + y.mean()
    found = np.array([row["prediction"] for row in model.transform(df).select("prediction").collect()])
    assert found == pytest.approx(expected, abs=1e-3)


def test_indicator_terms_are_those_of_the_full_expansion(spark):
    r = np.random.default_rng(5)
    x, which = r.normal(size=(200, 2)), r.integers(0, 4, 200)
    hot = np.eye(4)[which][:, 1:]
    y = x[:, 0] * hot[:, 0] - x[:, 1] + 3 * hot[:, 2] + r.normal(size=200) * 0.1
    rows = [(*map(float, a), *map(float, h), float(b)) for a, h, b in zip(x, hot, y)]
    df = spark.createDataFrame(rows, ["a", "b", "h0", "h1", "h2", "label"])
    for name, columns in (("features", ["a", "b"]), ("hot", ["h0", "h1", "h2"]), ("both", ["a", "b", "h0", "h1", "h2"])):
        df = VectorAssembler(inputCols=columns, outputCol=name).transform(df)
    df = df.select("features", "hot", "both", "label").cache()
    short = M.ridge(df, 5.0, 2, indicators="hot", tolerance=1e-10).fit(df).transform(df)
    full_df = df.drop("features").withColumnRenamed("both", "features")
    full = M.ridge(full_df, 5.0, 2, tolerance=1e-10).fit(full_df).transform(full_df)
    a = [row["prediction"] for row in short.select("prediction").collect()]
    b = [row["prediction"] for row in full.select("prediction").collect()]
    assert a == pytest.approx(b, abs=1e-4)


def test_scaling_uses_the_population_deviation(table):
    df, x, y = table
    model = M.lasso(0.0, scaled=df).fit(df)
    z = np.array([r["_scaled"].toArray() for r in model.transform(df).select("_scaled").collect()])
    assert z.std(axis=0) == pytest.approx([1.0] * 3)


def test_forward_selection_finds_the_informative_features(table):
    df, _, _ = table
    chosen, best, board = M.forward_selection(df, ["a", "b", "c"], ["a"], lambda part: M.lasso(0.001), 4)
    assert chosen[:2] == ["a", "b"] and best < 0.2
    assert board.filter("added").count() == len(chosen)


def test_oof_covers_every_row_once(table):
    df, _, _ = table
    oof = M.oof_predict(df, lambda part: M.lasso(0.001), 4)
    assert oof.count() == 400
    assert oof.agg(metrics.rmse("label", "prediction")).first()[0] < 0.2


def test_patience_finds_rounds_that_a_tolerance_gives_up(table):
    """With small steps each round helps by less than Spark's tolerance; the best round is still far out."""
    df, _, _ = table
    params = {"n_estimators": 40, "learning_rate": 0.005, "max_depth": 1}
    booster = M.gbt(params)
    booster.set(booster.validationIndicatorCol, "held")
    booster.set(booster.validationTol, 0.1)
    assert booster.fit(df.withColumn("held", F.col("fold") == 0)).getNumTrees < 40
    assert M.early_stopped(df, params, 0, patience=20).getNumTrees == 40


def test_scores_are_those_of_the_best_round(table):
    df, _, _ = table
    params = {"n_estimators": 10, "learning_rate": 1.0, "max_depth": 4}
    curve = M.rounds_curve(df, params, 2, patience=30)
    _, _, score = M.search(df, "gbt", [params], lambda part, s: M.gbt(s), 2, patience=30)
    assert score == pytest.approx(min(curve)) and len(curve) == 10


def test_best_rounds_curve_has_a_value_per_round(table):
    df, _, _ = table
    curve = M.rounds_curve(df, {"n_estimators": 6}, 4)
    assert len(curve) == 6 and curve[-1] < curve[0]


def test_bias_factor_does_not_raise_the_error(spark, sf_dir):
    result = run_profile(retail_view(spark, sf_dir), VIEW_ROLES, PREFIX_CATEGORY, FOLDS, **PROFILE_SETTINGS)
    report = result.report().first()
    assert report["rmse_after"] <= report["rmse_before"] + 1e-9
    assert report["n_features"] == 15 and result.trials.count() == 2
    spread = result.oof.agg(F.stddev_pop("label")).first()[0]
    assert report["rmse_before"] < spread
    scored_once(spark, sf_dir, result.predictions)


def test_race_winner_has_the_lowest_error(spark, sf_dir):
    boosting = {"n_estimators": [3], "max_depth": [3]}
    result = run_race(
        retail_view(spark, sf_dir), VIEW_ROLES, FOOD, FOLDS, (0.1,), (0.5,), degrees=(1,), boosting=boosting
    )
    assert 0 < result.report().first()["holdout_rmse"] < float("inf")
    board = {r["model"]: r["rmse"] for r in result.board.collect()}
    assert result.winner == min(board, key=board.get) and result.score == min(board.values())
    scored_once(spark, sf_dir, result.predictions)

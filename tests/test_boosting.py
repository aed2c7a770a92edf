"""Models boosted side by side: the trees are those of Spark's own fits, whatever the number of folds and settings."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfcast import catalog
from shelfcast.operators import boosting as B
from shelfcast.operators import models as M
from shelfcast.operators.moments import penalised_scores
from shelfcast.plans.profile import settled


@pytest.fixture(scope="module")
def table(spark):
    """More rows than thresholds are drawn from, with zeros, a constant, rows without a fold, and an outlet as a 0/1 vector."""
    r = np.random.default_rng(7)
    n = 13_000
    x = np.column_stack([r.normal(size=n), r.integers(0, 4, n), r.integers(0, 2, n) * r.random(n), np.ones(n)])
    outlet = r.integers(0, 6, n)
    y = 3.0 * x[:, 0] + x[:, 1] * x[:, 2] + (outlet == 2) * 4.0 + r.normal(size=n)
    folds = [None if i % 997 == 0 else i % 3 for i in range(n)]
    hot = [Vectors.sparse(5, [int(o)], [1.0]) if o < 5 else Vectors.sparse(5, [], []) for o in outlet]
    rows = [(Vectors.dense(a), float(b), f, h, i) for i, (a, b, f, h) in enumerate(zip(x, y, folds, hot))]
    df = spark.createDataFrame(rows, ["features", "label", "fold", "hot", "id"])
    return df.repartition(3, "id").cache()


def of(predictions):
    return np.array([r["prediction"] for r in predictions.orderBy("id").select("prediction").collect()])


SETTINGS = {
    "plain": (M.gbt, {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3}),
    "samples": (M.gbt, {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.3, "subsample": 0.7}),
    "features": (M.gbt, {"n_estimators": 3, "max_depth": 5, "subsample": 0.6, "colsample": 0.6, "min_child_weight": 40, "gamma": 0.05}),
    "absolute": (M.gbt_second, {"n_estimators": 3, "max_depth": 3, "subsample": 0.8}),
}


@pytest.mark.parametrize("name", list(SETTINGS))
def test_trees_are_those_of_spark(table, name):
    """With samples of rows and features, and for a tenth round, which starts from written predictions."""
    make, settings = SETTINGS[name]
    booster = make(settings)
    with M.Boosting(table, 3, whole=True) as boosts:
        out, whole = M.boosted_models(boosts, [B.Spec.of(booster, 1), B.Spec.of(booster, None)])
    fit_part, held_out = M.fold_parts(table, 1)
    assert of(out.transform(held_out)) == pytest.approx(of(booster.fit(fit_part).transform(held_out)), rel=1e-9)
    assert of(whole.transform(table)) == pytest.approx(of(booster.fit(table).transform(table)), rel=1e-9)


def test_indicator_columns_are_those_of_the_wide_vector(table):
    wide = VectorAssembler(inputCols=["features", "hot"], outputCol="_wide")
    pipeline = Pipeline(stages=[wide, M.gbt({"n_estimators": 3, "max_depth": 3, "subsample": 0.6, "colsample": 0.8}).setFeaturesCol("_wide")])
    fit_part, held_out = M.fold_parts(table, 0)
    candidate = M.Candidate("GBT", {}, lambda part: pipeline)
    (score,) = M.fold_scores(table, [(candidate, 0)], 3)
    own = pipeline.fit(fit_part).transform(held_out)
    assert of(candidate.models[0].transform(held_out)) == pytest.approx(of(own), rel=1e-9)
    assert score == pytest.approx(M.rmse_evaluator().evaluate(own), rel=1e-9)


def test_a_search_needs_no_fit_per_fold_and_setting(table, monkeypatch):
    """every fold of every setting was a fit of Spark's, with its own reading, binning and caching of the rows."""

    def refused(*_):
        raise AssertionError("a fit of its own")

    settings = [{"n_estimators": 2, "max_depth": d, "subsample": 0.8} for d in (2, 3)]
    expected = []
    for s in settings:
        parts = [M.fold_parts(table, f) for f in range(3)]
        expected.append(np.mean([min(M._held_out_curve(M.gbt(s).fit(a), b, None)) for a, b in parts]))
    monkeypatch.setattr(GBTRegressor, "_fit", refused)
    board, _, score = M.search(table, "gbt", settings, lambda part, s: M.gbt(s), 3, patience=2)
    assert [r["rmse"] for r in board.orderBy("trial").collect()] == pytest.approx(expected)
    assert score == pytest.approx(min(expected))


def test_draws_are_those_of_the_generator():
    one = B.XorShift(-3)
    drawn = np.array([one.double() for _ in range(900)])
    assert (B.uniforms(-3, 0, 900) == drawn).all() and (B.uniforms(-3, 333, 500) == drawn[333:833]).all()
    assert 0.45 < drawn.mean() < 0.55


def test_labels_must_be_there(table):
    broken = table.withColumn("label", F.when(F.col("id") != 5, F.col("label")))
    with pytest.raises(Exception, match="Labels MUST NOT be Null"):
        M.rounds_curve(broken, {"n_estimators": 2}, 3)


def test_penalised_errors_are_those_of_fits_with_indicators(table):
    """errors of Lasso and Ridge, with and without the 0/1 vector, from moments instead of a fit per fold."""
    some = table.filter("id < 900").drop("hot").join(table.select("id", "hot"), "id").cache()
    wanted = [("l1", 0.05), ("l2", 2.0)]
    for hot in (None, "hot"):
        found = iter(penalised_scores(some, [(kind, alpha, f) for kind, alpha in wanted for f in range(3)], hot))
        for kind, alpha in wanted:
            for f in range(3):
                fit_part, held_out = M.fold_parts(some, f)
                make = M.lasso(alpha, indicators=hot, tolerance=1e-12) if kind == "l1" else M.ridge(fit_part, alpha, indicators=hot, tolerance=1e-12)
                assert next(found) == pytest.approx(M.rmse_evaluator().evaluate(make.fit(fit_part).transform(held_out)), rel=1e-5)


def test_joined_rows_keep_a_ratio_and_not_the_sums_per_fold(spark):
    """the sums without each fold of items were moved by every later join of the rows."""
    rows = spark.createDataFrame([("train", 0), ("train", 1), ("test", 0)], ["source", "_fold"])
    sums = {"_iy_sum": F.lit(30.0), "_iy_n": F.lit(3), "_iy_sums": F.array(F.lit(20.0), F.lit(10.0)), "_iy_ns": F.array(F.lit(2), F.lit(1))}
    sums |= {"_ip_sum": F.lit(6.0), "_ip_n": F.lit(3), "_ip_sums": F.array(F.lit(4.0), F.lit(0.0)), "_ip_ns": F.array(F.lit(2), F.lit(0))}
    found = settled(rows.withColumns(sums), "items", F.col("source") == "train")
    assert found.columns == ["source", "_fold", "_i_ratio"]
    ratios = [r["_i_ratio"] for r in found.collect()]
    assert ratios[0] == pytest.approx(5.0, rel=1e-5) and ratios[1] is None and ratios[2] == pytest.approx(5.0, rel=1e-5)


@pytest.mark.parametrize("name", ["forward_selection", "grid_search", "oof_predict", "random_search", "best_rounds_cv", "early_stopping"])
def test_queries_need_no_fit_per_fold(spark, sf_dir, name, monkeypatch):
    """F6 to F10 and F12."""

    def refused(*_):
        raise AssertionError("a fit of its own")

    monkeypatch.setattr(GBTRegressor, "_fit", refused)
    assert catalog.QUERIES[name](spark, sf_dir).collect()

"""Ridge from moments against Spark ML and the normal equation, section search, staged errors, bounded selection, KMeans starts."""

import itertools
import math
from functools import reduce

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfcast.operators import distrib as D
from shelfcast.operators import models as M
from shelfcast.operators.impute import best_clusters
from shelfcast.operators.knn import coded_blocks, fill_knn
from shelfcast.operators.moments import Moments, fold_moments, held_out_rmse, ridge_path, ridge_solution


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(300, 3)) * [1, 10, 0.1] + [5, 1000, 0]
    y = 3.0 * x[:, 0] - 0.2 * x[:, 1] + x[:, 0] * x[:, 2] + 5.0 + r.normal(size=300) * 0.3
    data = [(Vectors.dense(a), float(b), i % 4) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, ["features", "label", "fold"]).repartition(6).cache(), x, y


def test_moments_add_up():
    x = np.random.default_rng(1).normal(size=(50, 4)) + 1000
    whole, parts = Moments.of(x), Moments.none(4) + Moments.of(x[:13]) + Moments.none(4) + Moments.of(x[13:])
    assert parts.n == 50 and np.allclose(parts.mean, whole.mean) and np.allclose(parts.products, whole.products, atol=1e-8)
    again = Moments.unpack(whole.pack())
    assert again.n == 50 and (again.products == whole.products).all() and (again.mean == whole.mean).all()


@pytest.mark.parametrize("degree", [1, 2])
def test_path_is_that_of_a_fit_per_fold_and_penalty(table, degree):
    df, _, _ = table
    alphas = (0.1, 5.0, 200.0)
    board, best, score = ridge_path(df, alphas, (degree,))
    fits = [M.Candidate("Ridge", {}, lambda part, a=a: M.ridge(part, a, degree, tolerance=1e-12)) for a in alphas]
    expected = M.cross_validate(df, fits, 4)
    assert [r["rmse"] for r in board.orderBy("trial").collect()] == pytest.approx(expected, rel=1e-6)
    assert score == min(r["rmse"] for r in board.collect()) and best["degree"] == degree


def test_terms_stand_in_the_order_of_the_expansion(table):
    df, _, _ = table
    moments = list(fold_moments(df, 2).values())
    whole = moments[0] + moments[1] + moments[2] + moments[3]
    w, intercept = ridge_solution(whole, 1.0)
    model = M.ridge(df, 1.0, 2, tolerance=1e-12).fit(df).stages[-1]
    assert w == pytest.approx(model.coefficients.toArray(), rel=1e-5, abs=1e-6) and intercept == pytest.approx(model.intercept, rel=1e-5)
    fitted = M.ridge(df, 1.0, 2, tolerance=1e-12).fit(df).transform(df)
    assert held_out_rmse(whole, w, intercept) == pytest.approx(M.rmse_evaluator().evaluate(fitted), rel=1e-6)


def test_moments_of_awkward_tables(spark, table):
    df, _, _ = table
    assert fold_moments(df.limit(0)) == {}
    with pytest.raises(RuntimeError, match="no rows outside"):
        ridge_path(df.filter("fold = 1"), (1.0,))
    gaps = df.withColumn("label", F.when(F.col("fold") != 2, F.col("label")))
    assert set(fold_moments(gaps)) == {0, 1, 3}
    wide = spark.createDataFrame([(Vectors.dense(range(60)), 1.0, 0)], ["features", "label", "fold"])
    with pytest.raises(ValueError, match="fit by iterations"):
        fold_moments(wide, 2)


def test_linear_models_agree_with_iterations_over_rows(table):
    df, _, _ = table
    for make in (M.lasso(0.05, 2, tolerance=1e-12), M.ridge(df, 3.0, 2, tolerance=1e-12)):
        fast = make.fit(df).stages[-1]
        slow = make.copy()
        slow.getStages()[-1].setSolver("l-bfgs").setMaxIter(2000)
        assert make.getStages()[-1].getSolver() in ("auto", "l-bfgs")
        rows = slow.fit(df).stages[-1]
        assert fast.coefficients.toArray() == pytest.approx(rows.coefficients.toArray(), abs=2e-3)


# --- Box-Cox -----------------------------------------------------------------------


def brute_power(x, low, high):
    def likelihood(p):
        z = x / np.exp(np.log(x).mean())  # relative to the geometric mean the other term is constant
        return -len(x) / 2 * np.log((np.log(z) if p == 0 else (z**p - 1) / p).var())

    for _ in range(40):
        grid = np.linspace(low, high, 9)
        k = int(np.argmax([likelihood(p) for p in grid]))
        low, high = grid[max(k - 1, 0)], grid[min(k + 1, 8)]
        if high - low < 1e-7:
            break
    return (low + high) / 2


@pytest.mark.parametrize("power", [-3.5, 0.0, 0.4, 4.0])
def test_fitted_power_is_the_peak_wherever_it_is(spark, power):
    normal = np.random.default_rng(2).normal(size=400)
    x = np.exp(0.3 * normal) if power == 0 else (10 + normal) ** (1 / power)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    found = D.fit_box_cox(df, "x", shift=0.0)
    assert found == pytest.approx(brute_power(x, -10, 10), abs=1e-4)
    assert found > 2 if power == 4.0 else found < -2 if power == -3.5 else abs(found) < 2


def test_power_of_awkward_columns(spark):
    make = lambda values: spark.createDataFrame([(v,) for v in values], "x double")
    assert D.fit_box_cox(make([3.0, 3.0]), "x") == 1.0 and D.fit_box_cox(make([None]), "x") == 1.0
    with pytest.raises(ValueError, match="positive"):
        D.fit_box_cox(make([0.0, 1.0]), "x", shift=0.0)
    passes = []
    assert D.best_power(lambda g: passes.append(len(g)) or [-((p - 37.25) ** 2) for p in g]) == pytest.approx(37.25, abs=1e-6)
    assert len(passes) < 16
    assert D.best_power(lambda g: list(g)) == 1e3


# --- staged errors, selection, clusters, neighbours ---------------------------------


def test_staged_errors_on_another_scale_are_those_of_shorter_models(table, spark):
    df, _, _ = table
    logs = df.withColumn("label", F.log1p(F.col("label") - df.agg(F.min("label")).scalar())).cache()
    model = GBTRegressor(maxIter=12, maxDepth=3, seed=4, featuresCol="features", labelCol="label").fit(logs)
    curve = M.staged_rmse(model, logs, np.expm1)
    trees = model.trees
    y = np.array([r["label"] for r in logs.select("label").collect()])
    total = np.zeros(len(y))
    for tree, weight, error in zip(trees, model.treeWeights, curve, strict=True):
        total += weight * np.array([r["prediction"] for r in tree.transform(logs).select("prediction").collect()])
        assert error == pytest.approx(math.sqrt(((np.expm1(total) - np.expm1(y)) ** 2).mean()), rel=1e-9)
    plain = M.staged_rmse(model, logs, lambda v: v)
    assert plain == pytest.approx([math.sqrt(v) for v in model.evaluateEachIteration(logs, "squared")], rel=1e-9)
    assert M._held_out_curve(model, logs, M.OriginalScaleRmse()) == curve


def test_evaluator_undoes_the_logarithm(spark):
    rows = spark.createDataFrame([(math.log1p(3.0), math.log1p(5.0)), (math.log1p(10.0), math.log1p(9.0)), (0.0, 0.0)], "label double, prediction double")
    evaluator = M.OriginalScaleRmse()
    assert evaluator.evaluate(rows) == pytest.approx(math.sqrt((4 + 1 + 0) / 3)) and not evaluator.isLargerBetter()


@pytest.mark.parametrize("seed", range(6))
def test_bounded_search_chooses_as_the_full_loop(seed):
    r = np.random.default_rng(seed)
    scores = np.round(r.random((12, 5)) + r.random((12, 1)), 1 if seed % 2 else 6)
    calls = []
    for bound in (5.0, float(np.sort(scores.mean(axis=1))[3]), 0.0):
        calls.clear()
        winner, means = M.lowest_mean(lambda c, f: calls.append((c, f)) or float(scores[c, f]), 12, 5, bound, 3)
        full = [reduce(lambda a, b: a + b, map(float, row), 0.0) for row in scores]  # added up as the search does
        best = min(range(12), key=full.__getitem__)
        assert winner == (best if full[best] < bound * 5 else None)
        assert all(m is None or m == pytest.approx(scores[c].mean()) for c, m in enumerate(means))
        assert len(set(calls)) == len(calls) <= 60
    assert not calls  # nothing can beat a bound of 0


def test_selection_fits_less_and_chooses_the_same(table):
    df, x, _ = table
    fits = []

    def estimator(part):
        fits.append(1)
        return M.lasso(0.001)

    rows = VectorAssembler(inputCols=["features", "n1", "n2"], outputCol="all").transform(
        df.withColumns({"n1": F.rand(1), "n2": F.rand(2)})).drop("features").withColumnRenamed("all", "features").cache()
    names = ["a", "b", "c", "n1", "n2"]
    chosen, best, board = M.forward_selection(rows, names, ["a"], estimator, 4, parallelism=1)
    assert chosen[:2] == ["a", "b"] and best < 1.0
    steps = board.agg(F.max("step")).first()[0]
    everything = 4 * (1 + sum(len(names) - 1 - k for k in range(steps)))
    assert len(fits) < everything
    assert board.filter("rmse IS NULL").count() > 0 and board.filter("added").count() == len(chosen)


def test_best_of_several_starts(spark):
    points = [(0.0, 0.0, 5.0), (0.0, 1.0, 1.0), (1.0, 3.0, 2.0), (2.0, 3.0, 9.0), (2.0, 0.0, 1.0), (1.0, 1.0, 4.0)]
    df = spark.createDataFrame(points, "a double, b double, w double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="p").transform(df).coalesce(1).cache()
    model, costs = best_clusters(df, "p", "w", 3)
    assert len(costs) == 10 and model.summary.trainingCost == min(costs)

    def cost(which):
        total = 0.0
        for c in set(which):
            own = np.array([p for p, k in zip(points, which) if k == c])
            mean = np.average(own[:, :2], axis=0, weights=own[:, 2])
            total += (((own[:, :2] - mean) ** 2).sum(axis=1) * own[:, 2]).sum()
        return total

    assert min(costs) == pytest.approx(min(cost(w) for w in itertools.product(range(3), repeat=6)))


def test_any_value_reaches_the_neighbours(spark):
    rows = [("Tier 1", "Shop", 10.0, "Small"), ("Tier 9", "Kiosk", 10.0, "High"), ("Tier 9", "Kiosk", 11.0, None), ("Tier 1", "Shop", 9.0, None), (None, "Shop", 1.0, None)]
    df = coded_blocks(spark.createDataFrame(rows, "loc string, kind string, x double, size string"), {"l": "loc", "t": "kind"})
    filled = fill_knn(df, {"l": F.col("l"), "t": F.col("t")}, "x", "size", 1).collect()
    assert {(r["loc"], r["x"]): r["size"] for r in filled}[("Tier 9", 11.0)] == "High"
    assert {(r["loc"], r["x"]): r["size"] for r in filled}[("Tier 1", 9.0)] == "Small"
    assert all(r["size"] for r in filled)

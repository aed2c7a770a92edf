"""Regressors, cross-validation, search and out-of-fold predictions on Spark ML.

Input tables hold a feature vector, a label and a fold number. Every fit is a
distributed Spark ML job; the driver only keeps scores and parameters.
"""

from __future__ import annotations

import json
import math
import random
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.errors import ArithmeticException, IllegalArgumentException
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.feature import (
    ElementwiseProduct,
    Interaction,
    PolynomialExpansion,
    StandardScaler,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.metrics import rmse
from shelfcast.operators.boosting import Boosted, Coded, Fitting, Spec, predictions
from shelfcast.operators.moments import penalised_scores
from shelfcast.operators.shape import unique_names
from shelfcast.session import Table, materialise

FEATURES, LABEL, FOLD, PREDICTION = "features", "label", "fold", "prediction"

#: Spark solves up to so many terms from moments.
NORMAL_TERMS = 4096

# Boosting parameter names users know -> Spark ML parameters.
BOOSTING_PARAMS = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "subsample": "subsamplingRate",
    "min_child_weight": "minInstancesPerNode",
    "gamma": "minInfoGain",
    "colsample": "featureSubsetStrategy",
}


def vectors(df: DataFrame, features: list[str], label: str | None, keep: list[str]) -> Table:
    """Feature vectors written once, so that every later fit reads a narrow table."""
    assembler = VectorAssembler(inputCols=unique_names(features), outputCol=FEATURES, handleInvalid="error")
    table = assembler.transform(df)
    extra = [F.col(label).cast("double").alias(LABEL)] if label else []
    return materialise(table.select(*keep, *extra, FEATURES), "vectors")


# --- learners ---------------------------------------------------------------------


def gbt(params: Mapping | None = None, seed: int = 4, **shape) -> GBTRegressor:
    """Boosted trees on squared error; a setting that Spark has no counterpart for is an error."""
    params = dict(params or {})
    if unknown := sorted(set(params) - set(BOOSTING_PARAMS)):
        raise ValueError(f"unknown boosting settings: {', '.join(unknown)}")
    kwargs = {"maxIter": 100, "seed": seed, **shape}
    for name, value in params.items():
        target = BOOSTING_PARAMS[name]
        if target == "featureSubsetStrategy":
            kwargs[target] = str(float(value)) if float(value) < 1 else "all"
        else:
            kwargs[target] = value
    return GBTRegressor(featuresCol=FEATURES, labelCol=LABEL, predictionCol=PREDICTION, **kwargs)


def gbt_second(params: Mapping | None = None, seed: int = 4) -> GBTRegressor:
    """The second boosted learner: absolute error, finer bins, other samples; every searched setting acts."""
    return gbt(params, seed + 1, lossType="absolute", maxBins=64)


def linear(
    reg_param: float, l1: bool, degree: int = 1, scaled: DataFrame | None = None, indicators: str | None = None,
    tolerance: float = 1e-6, iterations: int = 1000,
) -> Pipeline:
    """Penalised linear model on polynomial terms: any number of them, up to 4,096 from a single pass over the rows.

    ``scaled`` is the part that the pipeline is fitted on, if its features are to be scaled (by population deviations).
    ``indicators`` names a 0/1 vector with at most one 1; with degree 2 it adds itself, its squares and its products with the
    features. Products of two indicators are 0 in every row and left out, so terms grow with their number, not its square.
    """
    column, stages = FEATURES, []
    if scaled is not None:
        stages.append(StandardScaler(inputCol=column, outputCol="_sample", withMean=True, withStd=True))
        rows, size = scaled.count(), scaled.select(FEATURES).first()[0].size
        factor = math.sqrt(rows / (rows - 1)) if rows > 1 else 1.0
        stages.append(ElementwiseProduct(inputCol="_sample", outputCol="_scaled", scalingVec=Vectors.dense([factor] * size)))
        column = "_scaled"
    parts = [column]
    if degree > 1:
        stages.append(PolynomialExpansion(degree=degree, inputCol=column, outputCol="_terms"))
        parts = ["_terms"]
    if indicators:
        parts.append(indicators)
        if degree == 2:
            stages.append(Interaction(inputCols=[indicators, column], outputCol="_crossed"))
            parts += [indicators, "_crossed"]
        elif degree > 2:
            raise ValueError("indicators are for degrees 1 and 2")
    if len(parts) > 1:
        stages.append(VectorAssembler(inputCols=parts, outputCol="_all"))
        parts = ["_all"]
    stages.append(
        LinearRegression(
            featuresCol=parts[0],
            labelCol=LABEL,
            predictionCol=PREDICTION,
            regParam=reg_param,
            elasticNetParam=1.0 if l1 else 0.0,
            standardization=False,
            # Up to 4,096 terms come from one pass of moments; more, and sparse ones, from iterations over the rows.
            solver="l-bfgs" if indicators else "auto",
            maxIter=iterations,
            tol=tolerance,
        )
    )
    return Pipeline(stages=stages)


def lasso(
    alpha: float, degree: int = 1, scaled: DataFrame | None = None, indicators: str | None = None, tolerance: float = 1e-6
) -> Pipeline:
    """Minimises residual / (2n) + alpha * |w|."""
    return linear(alpha, True, degree, scaled, indicators, tolerance)


def ridge(
    train: DataFrame, alpha: float, degree: int = 1, scaled: bool = False, indicators: str | None = None, tolerance: float = 1e-6
) -> Pipeline:
    """Minimises residual + alpha * |w|^2; Spark's penalty is relative to row count and to the label's deviation.

    The deviation is that of the population where moments are solved, and that of a sample where rows are iterated over.
    """
    row = train.agg(F.stddev(LABEL).alias("sample"), F.stddev_pop(LABEL).alias("whole"), F.count(F.lit(1)).alias("n")).first()
    first = train.select(FEATURES).first()
    terms = math.comb(first[0].size + degree, degree) - 1 if first else 0
    spread = row["sample"] if indicators or terms > NORMAL_TERMS else row["whole"]
    return linear(alpha * (spread or 1.0) / max(row["n"], 1), False, degree, train if scaled else None, indicators, tolerance)


# --- evaluation -------------------------------------------------------------------


class OriginalScaleRmse(Evaluator):
    """RMSE after undoing log1p on label and prediction."""

    def _evaluate(self, dataset: DataFrame) -> float:
        back = dataset.select(F.expm1(LABEL).alias("y"), F.expm1(PREDICTION).alias("p"))
        return back.agg(rmse("y", "p")).first()[0]

    def isLargerBetter(self) -> bool:
        return False


def rmse_evaluator() -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=LABEL, predictionCol=PREDICTION, metricName="rmse")


def fold_parts(table: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    return table.filter(F.col(FOLD) != fold), table.filter(F.col(FOLD) == fold)


@dataclass
class Candidate:
    """A model to try. With ``patience`` its params are boosting settings, scored at their best round.

    ``penalty`` (``"l1"`` or ``"l2"``, and alpha) tells that it is ``lasso`` or ``ridge`` of degree 1, with ``indicators`` if any: its errors
    then come from moments, which are worked out once for all such candidates and folds.
    """

    name: str
    params: dict
    estimator: Callable[[DataFrame], Estimator]
    columns: list[int] | None = None
    patience: int | None = None
    penalty: tuple[str, float] | None = None
    indicators: str | None = None
    error: str | None = None
    rounds: int | None = None
    models: dict[int, Boosted] = field(default_factory=dict)  # by the fold left out, if they were boosted side by side
    curve: list[float] | None = None


def sliced(table: DataFrame, columns: list[int] | None) -> DataFrame:
    if columns is None:
        return table
    slicer = VectorSlicer(inputCol=FEATURES, outputCol="_slice", indices=columns)
    return slicer.transform(table).drop(FEATURES).withColumnRenamed("_slice", FEATURES)


def boosted_form(estimator: Estimator) -> tuple[GBTRegressor, str | None] | None:
    """The boosting in an estimator, and the 0/1 vector that it reads beside the features; None for other estimators."""
    booster, read, hot = estimator, FEATURES, None
    if isinstance(estimator, Pipeline) and len(estimator.getStages()) == 2:
        assembler, booster = estimator.getStages()
        if not isinstance(assembler, VectorAssembler) or len(assembler.getInputCols()) != 2 or assembler.getInputCols()[0] != FEATURES:
            return None
        read, hot = assembler.getOutputCol(), assembler.getInputCols()[1]
    if not isinstance(booster, GBTRegressor):
        return None
    named = (booster.getFeaturesCol(), booster.getLabelCol(), booster.getPredictionCol()) == (read, LABEL, PREDICTION)
    return (booster, hot) if named else None


class Boosting:
    """Boosted models of one table, fitted side by side. The rows are coded once for all folds, and for the fit on all rows if ``whole``."""

    def __init__(self, table: DataFrame, folds: int, whole: bool = False):
        self.table, self.folds, self.whole = table, folds, whole
        self.held: dict[tuple[frozenset, str | None], Coded] = {}

    def fitting(self, specs: Sequence[Spec], hot: str | None = None) -> Fitting:
        kinds = frozenset((s.seed, s.max_bins) for s in specs)
        coded = next((c for (have, h), c in self.held.items() if kinds <= have and h == hot), None)
        if coded is None:
            folds = [*range(self.folds), *([None] if self.whole else [])]
            coded = self.held[kinds, hot] = Coded(self.table, kinds, folds, hot)
        return Fitting(coded, specs)

    def __enter__(self) -> Boosting:
        return self

    def __exit__(self, *_) -> None:
        for coded in self.held.values():
            coded.close()


def _original(evaluator: Evaluator | None) -> bool | None:
    """Whether errors are those on the scale before log1p; None for evaluators that only Spark's models serve."""
    if isinstance(evaluator, OriginalScaleRmse):
        return True
    plain = evaluator is None or (isinstance(evaluator, RegressionEvaluator) and evaluator.getMetricName() == "rmse" and evaluator.getLabelCol() == LABEL)
    return False if plain else None


def fold_scores(
    table: DataFrame,
    jobs: Sequence[tuple[Candidate, int]],
    folds: int,
    evaluator: Evaluator | None = None,
    parallelism: int = 4,
    boosting: Boosting | None = None,
) -> list[float]:
    """Error of each candidate on its fold, from a fit on the others; with ``patience`` its mean error over all folds at the best round.

    Infinity if it cannot be fitted. All boosted models are fitted side by side (see ``operators/boosting.py``), the others one by one.
    """
    scores: list[float | None] = [None] * len(jobs)
    together: dict[str | None, list[tuple[int, list[Spec]]]] = {}
    rest: list[tuple[int, Estimator]] = []
    penalised: dict[str | None, list[int]] = {}
    for k, (candidate, fold) in enumerate(jobs):
        if candidate.penalty and candidate.columns is None and _original(evaluator) is False:
            penalised.setdefault(candidate.indicators, []).append(k)
            continue
        try:
            if candidate.patience is not None:
                estimator, left = gbt(candidate.params), list(range(folds))
            else:
                estimator, left = candidate.estimator(fold_parts(sliced(table, candidate.columns), fold)[0]), [fold]
            form = boosted_form(estimator)
            served = form and (candidate.patience is not None or _original(evaluator) is not None)
            specs = [Spec.of(form[0], f, candidate.columns) for f in left] if served else [None]
            if None in specs or (form[1] and candidate.columns is not None):
                rest.append((k, estimator))
            else:
                together.setdefault(form[1], []).append((k, specs))
        except (ArithmeticException, IllegalArgumentException, ValueError) as error:
            scores[k] = _failed(candidate, error)

    for hot, found in penalised.items():
        wanted = [(*jobs[k][0].penalty, jobs[k][1]) for k in found]
        for k, value in zip(found, penalised_scores(table, wanted, hot), strict=True):
            scores[k] = value

    def alone(job: tuple[int, Estimator]) -> float:
        candidate, fold = jobs[job[0]]
        try:
            if candidate.patience is not None:
                rows = sliced(table, candidate.columns)
                candidate.curve = _rounds_curve_alone(rows, candidate.params, folds, candidate.patience, parallelism, evaluator)
                candidate.rounds = best_rounds(candidate.curve, candidate.patience)
                return candidate.curve[candidate.rounds - 1]
            fit_part, held_out = fold_parts(sliced(table, candidate.columns), fold)
            return (evaluator or rmse_evaluator()).evaluate(job[1].fit(fit_part).transform(held_out))
        except (ArithmeticException, IllegalArgumentException, ValueError) as error:
            return _failed(candidate, error)

    with ThreadPoolExecutor(parallelism) as pool:
        for (k, _), value in zip(rest, pool.map(alone, rest), strict=True):
            scores[k] = value
    if together:
        with Boosting(table, folds) as own:
            for hot, found in together.items():
                for k, value in _boosted_scores(boosting or own, hot, [(k, *jobs[k], specs) for k, specs in found], bool(_original(evaluator))):
                    scores[k] = value
    return scores


def _failed(candidate: Candidate, error: Exception) -> float:
    candidate.error = f"{type(error).__name__}: {error}"[:500]
    return math.inf


def _boosted_scores(
    boosting: Boosting, hot: str | None, jobs: Sequence[tuple[int, Candidate, int, list[Spec]]], original: bool
) -> Iterator[tuple[int, float]]:
    try:
        fitting = boosting.fitting([s for job in jobs for s in job[3]], hot)
    except ValueError as error:
        yield from ((k, _failed(candidate, error)) for k, candidate, *_ in jobs)
        return
    places, at = {}, 0
    for k, _, _, specs in jobs:
        places[k] = list(range(at, at + len(specs)))
        at += len(specs)
    fixed = [i for k, candidate, *_ in jobs if candidate.patience is None for i in places[k]]
    fitting.grow(max((fitting.models[i].spec.rounds for i in fixed), default=0), fixed)
    _grow_patiently(fitting, [(places[k], candidate.patience) for k, candidate, *_ in jobs if candidate.patience is not None], original)
    fitting.curves(original)
    models = fitting.result()
    fitting.close()
    for k, candidate, fold, _ in jobs:
        if candidate.patience is None:
            (model,) = [models[i] for i in places[k]]
            candidate.models[fold] = model
            yield k, model.curve[-1] if model.curve else math.inf
            continue
        candidate.models = dict(enumerate(models[i] for i in places[k]))
        candidate.curve = _mean_curve([m.curve for m in candidate.models.values()])
        candidate.rounds = best_rounds(candidate.curve, candidate.patience)
        yield k, candidate.curve[candidate.rounds - 1]


def cross_validate(
    table: DataFrame,
    candidates: Sequence[Candidate],
    folds: int,
    evaluator: Evaluator | None = None,
    parallelism: int = 4,
    boosting: Boosting | None = None,
) -> list[float]:
    """Mean score of each candidate over the folds of the fold column.

    A candidate whose settings are refused or whose numbers break down scores infinity, keeps the message in
    ``error`` and is never chosen. Any other failure, such as a lost executor, ends the search.
    """
    jobs = [(c, f) for c in candidates for f in range(1 if c.patience is not None else folds)]
    scores = fold_scores(table, jobs, folds, evaluator, parallelism, boosting)
    found: dict[int, list[float]] = {}
    for (candidate, _), value in zip(jobs, scores):
        found.setdefault(id(candidate), []).append(value)
    return [sum(found[id(c)]) / len(found[id(c)]) for c in candidates]


def best_of(candidates: Sequence[Candidate], scores: Sequence[float]) -> int:
    """Place of the lowest finite score; if there is none, an error that says why."""
    finite = [i for i, v in enumerate(scores) if math.isfinite(v)]
    if not finite:
        raise RuntimeError("no model could be fitted: " + "; ".join(f"{c.name}: {c.error}" for c in candidates))
    return min(finite, key=scores.__getitem__)


# --- search -----------------------------------------------------------------------


def grid(space: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the listed values, repeated values once."""
    names = list(space)
    return [dict(zip(names, values)) for values in product(*[unique_names(list(space[n])) for n in names])]


def draws(space: Mapping[str, tuple], trials: int, seed: int) -> list[dict]:
    """Seeded random settings from ``("uniform"|"log", low, high)``, ``("int", low, high)``
    (both ends included) or ``("choice", values)``."""
    source = random.Random(seed)

    def one(kind, *args):
        if kind == "uniform":
            return source.uniform(*args)
        if kind == "log":
            return math.exp(source.uniform(math.log(args[0]), math.log(args[1])))
        if kind == "int":
            return source.randint(*args)
        return source.choice(args[0])

    return [{name: one(*rule) for name, rule in space.items()} for _ in range(trials)]


def leaderboard(table: DataFrame, candidates: Sequence[Candidate], scores: Sequence[float]) -> DataFrame:
    """``(trial, model, params, rmse, error)``: one row per candidate tried."""
    rows = [
        (i, c.name, json.dumps(c.params, sort_keys=True), float(s), c.error)
        for i, (c, s) in enumerate(zip(candidates, scores))
    ]
    return table.sparkSession.createDataFrame(rows, "trial int, model string, params string, rmse double, error string")


def search(
    table: DataFrame,
    name: str,
    settings: Sequence[Mapping],
    estimator: Callable[[DataFrame, Mapping], Estimator],
    folds: int,
    evaluator: Evaluator | None = None,
    parallelism: int = 4,
    patience: int | None = None,
    boosting: Boosting | None = None,
    winner: list[Candidate] | None = None,
) -> tuple[DataFrame, dict, float]:
    """Cross-validates every setting: the leaderboard, the best setting and its score. The best candidate is added to ``winner``.

    With ``patience`` the settings are those of ``gbt``, each scored at its best round.
    """
    candidates = [Candidate(name, dict(s), lambda part, s=s: estimator(part, s), patience=patience) for s in settings]
    scores = cross_validate(table, candidates, folds, evaluator, parallelism, boosting)
    best = best_of(candidates, scores)
    if winner is not None:
        winner.append(candidates[best])
    return leaderboard(table, candidates, scores), candidates[best].params, scores[best]


def lowest_mean(
    score: Callable[[int, int], float],
    candidates: int,
    folds: int,
    bound: float,
    parallelism: int = 4,
    together: Callable[[Sequence[tuple[int, int]]], Sequence[float]] | None = None,
) -> tuple[int | None, list[float | None]]:
    """The first candidate with the lowest mean of ``score(candidate, fold)`` below ``bound``, and the means that were worked out.

    Branch and bound: scores are not negative, so a candidate whose scores so far add up to more than the best total cannot
    win and is not scored further (None). All candidates are scored on the first fold; then those that look best go first, so that the
    bound falls early. The choice is that of scoring everything. ``together`` scores a batch of pairs at once, in the place of ``score``.
    """
    total, done = [0.0] * candidates, [0] * candidates
    best, limit = None, bound * folds
    with ThreadPoolExecutor(parallelism) as pool:
        while True:
            def hopeful(c: int) -> bool:
                return done[c] < folds and (total[c] < limit or (best is not None and total[c] == limit and c < best))

            ready = sorted((c for c in range(candidates) if hopeful(c)), key=lambda c: (done[c] > 0, -done[c], total[c], c))
            if not ready:
                break
            batch = ready if done[ready[0]] == 0 else ready[:parallelism]
            found = together([(c, done[c]) for c in batch]) if together else pool.map(lambda c: score(c, done[c]), batch)
            for c, value in zip(batch, found, strict=True):
                total[c] += value
                done[c] += 1
                if done[c] == folds and (total[c] < limit or (best is not None and total[c] == limit and c < best)):
                    best, limit = c, total[c]
    return best, [t / folds if d == folds else None for t, d in zip(total, done)]


def forward_selection(
    table: DataFrame,
    features: list[str],
    base: list[str],
    estimator: Callable[[DataFrame], Estimator],
    folds: int,
    parallelism: int = 4,
    boosting: Mapping | None = None,
    patience: int | None = None,
) -> tuple[list[str], float, DataFrame]:
    """Adds the feature that lowers the error most until none does.

    With ``boosting`` settings and ``patience`` every choice is scored at its best round.

    ``features`` names the slots of the vector; a candidate reads its slots from the
    one written vector table. Returns the choice, its error and every evaluation. Without ``patience`` a candidate that cannot win any more is
    left before its last fold (see ``lowest_mean``); its error is then null.
    """
    place = {name: i for i, name in enumerate(features)}
    chosen, log = unique_names(base), []

    def candidate(names: list[str]) -> Candidate:
        return Candidate("+".join(names), dict(boosting or {}), estimator, [place[x] for x in names], patience)

    def lowest(lists: list[list[str]], bound: float, boosts: Boosting) -> tuple[int | None, list[float | None]]:
        tried = [candidate(names) for names in lists]

        def score(pairs: Sequence[tuple[int, int]]) -> list[float]:
            return fold_scores(table, [(tried[c], f) for c, f in pairs], folds, None, parallelism, boosts)

        if patience is None:
            return lowest_mean(lambda c, f: score([(c, f)])[0], len(lists), folds, bound, parallelism, score)
        scores = cross_validate(table, tried, folds, parallelism=parallelism, boosting=boosts)
        winner = best_of(tried, scores)
        return (winner if scores[winner] < bound else None), list(scores)

    with Boosting(table, folds) as boosts:
        first = candidate(chosen)
        (best,) = cross_validate(table, [first], folds, parallelism=parallelism, boosting=boosts)
        best_of([first], [best])
        log.append((0, "(base)", best, True))
        left = [f for f in features if f not in chosen]
        step = 0
        while left:
            step += 1
            winner, scores = lowest([chosen + [f] for f in left], best, boosts)
            log.extend((step, f, s, i == winner) for i, (f, s) in enumerate(zip(left, scores)))
            if winner is None:
                break
            best = scores[winner]
            chosen.append(left.pop(winner))
    board = table.sparkSession.createDataFrame(log, "step int, feature string, rmse double, added boolean")
    return chosen, best, board


# --- boosting rounds --------------------------------------------------------------


FIRST_ROUNDS = 25


def rounds_curve(
    table: DataFrame, params: Mapping, folds: int, patience: int = 100, parallelism: int = 4, evaluator: Evaluator | None = None
) -> list[float]:
    """Mean held-out error after each boosting round (root mean square error, or the evaluator's).

    Rounds grow (25, 50, 100, ...) until the best one lies ``patience`` rounds behind or the ``n_estimators`` of the settings is
    reached, so the data end the search. A model with more rounds and the same seed begins with the same trees, so the folds' models grow
    on, side by side.
    """
    booster = gbt(params)
    if Spec.of(booster, 0) is None:
        return _rounds_curve_alone(table, params, folds, patience, parallelism, evaluator)
    original = isinstance(evaluator, OriginalScaleRmse)
    with Boosting(table, folds) as boosts:
        fitting = boosts.fitting([Spec.of(booster, f) for f in range(folds)])
        _grow_patiently(fitting, [(list(range(folds)), patience)], original)
        fitting.curves(original)
        fitting.close()
        return _mean_curve([m.curve for m in fitting.models])


def _mean_curve(curves: Sequence[Sequence[float]]) -> list[float]:
    return [sum(values) / len(curves) for values in zip(*curves)]


def _grow_patiently(fitting: Fitting, groups: Sequence[tuple[list[int], int]], original: bool) -> None:
    """Grows groups of models (their places, and the patience) until the best round of their mean error lies that far behind."""
    left, rounds = list(groups), FIRST_ROUNDS
    while left:
        fitting.grow(rounds, [i for places, _ in left for i in places])
        left = [(places, patience) for places, patience in left if rounds < fitting.models[places[0]].spec.rounds]
        if left:
            fitting.curves(original)
            left = [(places, patience) for places, patience in left if not _settled(_mean_curve([fitting.models[i].curve for i in places]), patience)]
        rounds *= 2


def _settled(curve: Sequence[float], patience: int) -> bool:
    return len(curve) - 1 - curve.index(min(curve)) >= patience


def _rounds_curve_alone(
    table: DataFrame, params: Mapping, folds: int, patience: int, parallelism: int, evaluator: Evaluator | None
) -> list[float]:
    """The curve from Spark's own fits, one by one."""
    most = int(params.get("n_estimators", 100))
    rounds = min(FIRST_ROUNDS, most)

    def one(fold: int) -> list[float]:
        fit_part, held_out = fold_parts(table, fold)
        return _held_out_curve(gbt({**params, "n_estimators": rounds}).fit(fit_part), held_out, evaluator)

    while True:
        with ThreadPoolExecutor(parallelism) as pool:
            curves = list(pool.map(one, range(folds)))
        mean = _mean_curve(curves)
        if rounds >= most or _settled(mean, patience):
            return mean
        rounds = min(2 * rounds, most)


def _held_out_curve(model: Model, held_out: DataFrame, evaluator: Evaluator | None) -> list[float]:
    if not isinstance(evaluator, OriginalScaleRmse):
        return [math.sqrt(v) for v in model.evaluateEachIteration(held_out, "squared")]
    return staged_rmse(model, held_out, np.expm1)


def leaf_values(model: Model) -> list[np.ndarray]:
    """Per tree the predictions of its leaves, from left to right, times the tree's weight."""
    found = [re.findall(r"Predict: (\S+)", tree.toDebugString) for tree in model.trees]
    return [np.array([float(v) for v in values]) * w for values, w in zip(found, model.treeWeights)]


def staged_rmse(model: Model, rows: DataFrame, back: Callable[[np.ndarray], np.ndarray]) -> list[float]:
    """Error after every round, label and prediction taken ``back`` to another scale first; rows without a label are left out.

    A row's leaves in all trees come as one vector, and the predictions of all rounds are the running sums of their values, so
    neither the plan nor the passes grow with the rounds. A task sends one row of sums.
    """
    values = leaf_values(model)
    marked = model.copy()
    marked.setLeafCol("_leaves")
    leaves = marked.transform(rows).dropna(subset=[LABEL]).select(vector_to_array("_leaves", "float32").alias("leaves"), F.col(LABEL).cast("double").alias("y"))

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(len(values)), 0
        for batch in batches:
            if batch.num_rows:
                place = batch.column("leaves").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.int64)
                staged = np.cumsum(np.column_stack([v[place[:, t]] for t, v in enumerate(values)]), axis=1)
                y = back(batch.column("y").to_numpy(zero_copy_only=False))
                total += ((y[:, None] - back(staged)) ** 2).sum(axis=0)
                count += batch.num_rows
        if count:
            rounds = pa.array(np.arange(len(values), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([rounds, pa.array(total), pa.array(np.full(len(values), count))], names=["round", "squares", "n"])

    sums = leaves.mapInArrow(errors, "round int, squares double, n long").groupBy("round")
    found = sums.agg(F.sqrt(F.sum("squares") / F.sum("n")).alias("rmse")).orderBy("round").collect()
    return [r["rmse"] for r in found]


def best_rounds(curve: Sequence[float], patience: int) -> int:
    """Rounds up to the lowest error, looking no further than ``patience`` rounds past a best one."""
    best = 0
    for i, value in enumerate(curve):
        if value < curve[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def early_stopped(table: DataFrame, params: Mapping, fold: int, patience: int = 100, seed: int = 4) -> Boosted:
    """Boosting with as many rounds as serve the held-out fold best, looked for with patience."""
    spec = Spec.of(gbt(params, seed), fold)
    if spec is None:
        raise ValueError(f"settings that only Spark's own fit takes: {dict(params)}")
    coded = Coded(table, [(spec.seed, spec.max_bins)], [fold])
    fitting = Fitting(coded, [spec])
    _grow_patiently(fitting, [([0], patience)], False)
    fitting.curves()
    (model,) = fitting.result()
    fitting.close()
    coded.close()
    return model.first(best_rounds(model.curve, patience))


# --- out-of-fold and final predictions --------------------------------------------


def oof_predict(
    table: DataFrame, estimator: Callable[[DataFrame], Estimator], folds: int, parallelism: int = 4
) -> DataFrame:
    """Every row predicted by a model that never saw its fold; keys stay in the row."""

    keep = [c for c in table.columns if c != FEATURES]
    estimators = [estimator(fold_parts(table, f)[0]) for f in range(folds)]
    forms = [boosted_form(e) for e in estimators]
    specs = [Spec.of(form[0], f) if form and form[1] is None else None for f, form in enumerate(forms)]
    if specs and None not in specs:
        with Boosting(table, folds) as boosts:
            models = boosted_models(boosts, specs)
        return predictions(table, {PREDICTION: dict(enumerate(models))}, FOLD).select(*keep, PREDICTION)

    def one(fold: int) -> DataFrame:
        fit_part, held_out = fold_parts(table, fold)
        return estimators[fold].fit(fit_part).transform(held_out)

    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(one, range(folds)))
    return reduce(DataFrame.unionByName, [p.select(*keep, PREDICTION) for p in parts])


def searched_enough(curve: Sequence[float] | None, params: Mapping, patience: int) -> bool:
    """Whether a search has followed the curve as far as this patience asks."""
    return curve is not None and (len(curve) >= int(params.get("n_estimators", 100)) or _settled(curve, patience))


def models_by_fold(boosting: Boosting, searched: Candidate, booster: GBTRegressor, rounds: int) -> dict[int, Boosted] | None:
    """The models of a setting that leave out each fold: those of the search where they begin with the same trees, else fitted anew.

    None if only Spark's own fit takes the setting.
    """
    specs = [Spec.of(booster, f) for f in range(boosting.folds)]
    if None in specs:
        return None
    found = {f: m.first(rounds) for f, m in searched.models.items()}
    if set(found) == set(range(boosting.folds)) and all(len(m.trees) == rounds and m.seed == booster.getSeed() for m in found.values()):
        return found
    return dict(enumerate(boosted_models(boosting, specs)))


def fitted_whole(boosting: Boosting, estimator: Estimator) -> Boosted | Model:
    """The estimator fitted on all rows of the table."""
    form = boosted_form(estimator)
    spec = Spec.of(form[0], None) if form else None
    if spec is None:
        return estimator.fit(boosting.table)
    return boosted_models(boosting, [spec], form[1])[0]


def boosted_models(boosting: Boosting, specs: Sequence[Spec], hot: str | None = None) -> list[Boosted]:
    """Models with all their rounds, fitted side by side."""
    fitting = boosting.fitting(specs, hot)
    fitting.grow(max(s.rounds for s in specs))
    models = fitting.result()
    fitting.close()
    return models


def ensemble_average(df: DataFrame, predictions: Sequence[str], out: str) -> DataFrame:
    """Mean of log-scale predictions, brought back and floored at zero."""
    mean = reduce(lambda a, b: a + b, [F.col(p) for p in predictions]) / len(predictions)
    back = F.expm1(mean)
    return df.withColumn(out, F.when(back < 0, 0.0).otherwise(back))

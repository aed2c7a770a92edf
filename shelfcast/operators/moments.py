"""Ridge regression from moments: one pass over the rows serves every penalty, every fold and the held-out errors.

A pass yields, per fold, the number of rows, the mean of every term and the centred sums of products of all
terms and the label. The moments outside a fold are combined from those of the other folds, a fit is the solution of its normal
equation, and the error on the fold left out follows from that fold's own moments. Nothing is read twice.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.boosting import slot_of

FEATURES, LABEL, FOLD = "features", "label", "fold"

#: Beyond this many terms the products of all pairs are too many to hold; fit by iterations instead.
MAX_TERMS = 1024
#: Partial results that one task adds up before the last round.
_TEAMS = 32


@dataclass(frozen=True)
class Moments:
    """Rows, means and centred products of the terms and, in the last place, the label."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, step = self.n + other.n, other.mean - self.mean
        shift = np.outer(step, step) * (self.n * (other.n / n))
        return Moments(n, self.mean + step * (other.n / n), self.products + other.products + shift)

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        centred = rows - mean
        return cls(len(rows), mean, centred.T @ centred)

    @classmethod
    def none(cls, size: int) -> Moments:
        return cls(0, np.zeros(size), np.zeros((size, size)))

    def pack(self) -> bytes:
        return np.concatenate([[float(self.n)], self.mean, self.products.ravel()]).tobytes()

    @classmethod
    def unpack(cls, raw: bytes) -> Moments:
        values = np.frombuffer(raw)
        size = int(round((-1 + math.sqrt(1 + 4 * (len(values) - 1))) / 2))
        return cls(int(values[0]), values[1 : 1 + size], values[1 + size :].reshape(size, size))


def n_terms(features: int, degree: int) -> int:
    return features if degree == 1 else features + features * (features + 1) // 2


def expanded(x: np.ndarray, degree: int) -> np.ndarray:
    """Terms in the order of Spark's polynomial expansion: each feature, then its products with the ones up to it."""
    if degree == 1:
        return x
    if degree != 2:
        raise ValueError("moments are for degrees 1 and 2")
    return np.concatenate([np.column_stack([x[:, j : j + 1], x[:, : j + 1] * x[:, j : j + 1]]) for j in range(x.shape[1])], axis=1)


def fold_moments(table: DataFrame, degree: int = 1, features: str = FEATURES, label: str = LABEL, fold: str = FOLD) -> dict[int, Moments]:
    """Moments of the terms and the label of each fold, from a single pass; rows without a label or fold are left out.

    A task sends one partial result per fold; they are added up in two rounds.
    """
    first = table.select(features).first()
    if first is None:
        return {}
    size = n_terms(first[0].size, degree)
    if size > MAX_TERMS:
        raise ValueError(f"{size} terms: fit by iterations")
    rows = table.dropna(subset=[label, fold]).select(
        F.col(fold).cast("int").alias("fold"), vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")
    )

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            both = np.column_stack([expanded(x, degree), batch.column("y").to_numpy(zero_copy_only=False)])
            which = batch.column("fold").to_numpy(zero_copy_only=False)
            for f in np.unique(which).tolist():
                held[f] = held.get(f, Moments.none(size + 1)) + Moments.of(both[which == f])
        for f, moments in held.items():
            yield _packed(f, moments)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            for f, raw in zip(batch.column("fold").to_pylist(), batch.column("moments").to_pylist(), strict=True):
                part = Moments.unpack(raw)
                if f == key:
                    held = held + part
                    continue
                if key is not None:
                    yield _packed(key, held)
                key, held = f, part
        if key is not None:
            yield _packed(key, held)

    schema = "fold int, moments binary"
    parts = rows.mapInArrow(own, schema).withColumn("team", F.spark_partition_id() % _TEAMS)
    some = parts.repartition("fold", "team").sortWithinPartitions("fold").drop("team").mapInArrow(added, schema)
    whole = some.repartition("fold").sortWithinPartitions("fold").mapInArrow(added, schema)
    return {r["fold"]: Moments.unpack(r["moments"]) for r in whole.collect()}


def _packed(fold: int, moments: Moments) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([fold], pa.int32()), pa.array([moments.pack()], pa.binary())], names=["fold", "moments"])


def ridge_solution(moments: Moments, alpha: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept that minimise residual + alpha * |w|^2."""
    xx, xy = moments.products[:-1, :-1], moments.products[:-1, -1]
    penalised = xx + alpha * np.eye(len(xy))
    try:
        w = np.linalg.solve(penalised, xy)
    except np.linalg.LinAlgError:  # repeated terms and no penalty: the shortest solution
        w = np.linalg.lstsq(penalised, xy, rcond=None)[0]
    return w, float(moments.mean[-1] - w @ moments.mean[:-1])


def held_out_rmse(moments: Moments, w: np.ndarray, intercept: float) -> float:
    """Root mean square error of a linear model on the rows the moments are of."""
    v = np.append(-w, 1.0)
    miss = moments.mean[-1] - intercept - w @ moments.mean[:-1]
    return math.sqrt(max(float(v @ moments.products @ v), 0.0) / moments.n + miss * miss)


def ridge_path(table: DataFrame, alphas: Sequence[float], degrees: Sequence[int] = (1,)) -> tuple[DataFrame, dict, float]:
    """Cross-validated error of every penalty and degree: the leaderboard, the best setting and its score.

    Reads the rows once per degree, whatever the number of penalties and folds. The scores are those of a fit per fold and
    penalty; a fold that holds all rows leaves nothing to fit and scores infinity.
    """
    board = []
    for degree in degrees:
        folds = fold_moments(table, degree)
        for alpha in alphas:
            errors = []
            for f, own in folds.items():
                others = [m for g, m in folds.items() if g != f]
                if others:
                    errors.append(held_out_rmse(own, *ridge_solution(reduce(Moments.__add__, others), alpha)))
            score = sum(errors) / len(errors) if errors else math.inf
            board.append(({"alpha": float(alpha), "degree": degree}, score))
    return _ranked(table, board)


def _ranked(table: DataFrame, board: list[tuple[Mapping, float]]) -> tuple[DataFrame, dict, float]:
    rows = [(i, "Ridge", json.dumps(s, sort_keys=True), e) for i, (s, e) in enumerate(board)]
    found = table.sparkSession.createDataFrame(rows, "trial int, model string, params string, rmse double")
    finite = [(e, i) for i, (_, e) in enumerate(board) if math.isfinite(e)]
    if not finite:
        raise RuntimeError("no model could be fitted: there are no rows outside a fold")
    error, best = min(finite)
    return found, dict(board[best][0]), error


# --- one indicator vector beside the features -----------------------------------------------


@dataclass(frozen=True)
class SlotMoments:
    """Moments of the features and the label, and per slot of a 0/1 vector its rows and the sums of features and label, about zero."""

    dense: Moments
    n: np.ndarray
    sums: np.ndarray  # (slots, features + 1)

    def __add__(self, other: SlotMoments) -> SlotMoments:
        return SlotMoments(self.dense + other.dense, self.n + other.n, self.sums + other.sums)

    def about(self, centre: np.ndarray) -> np.ndarray:
        return self.sums - np.outer(self.n, centre)


def slot_moments(table: DataFrame, hot: str | None, slots: int) -> dict[int, SlotMoments]:
    """The moments of each fold: one pass for the features, and one aggregation by slot."""
    dense = fold_moments(table)
    size = len(next(iter(dense.values())).mean) if dense else 1
    found = {f: SlotMoments(m, np.zeros(slots), np.zeros((slots, size))) for f, m in dense.items()}
    if hot is None:
        return found
    rows = table.dropna(subset=[LABEL, FOLD]).select(F.col(FOLD).cast("int").alias("f"), slot_of(hot).alias("s"), vector_to_array(FEATURES).alias("x"), F.col(LABEL).cast("double").alias("y"))
    sums = [*[F.sum(F.col("x")[i]).alias(f"x{i}") for i in range(size - 1)], F.sum("y").alias("y")]
    for r in rows.filter("s >= 0").groupBy("f", "s").agg(F.count(F.lit(1)).alias("n"), *sums).toLocalIterator():
        found[r["f"]].n[r["s"]] = r["n"]
        found[r["f"]].sums[r["s"]] = r[3:]
    return found


@dataclass(frozen=True)
class Linear:
    intercept: float
    w: np.ndarray
    b: np.ndarray

    def rmse(self, own: SlotMoments) -> float:
        """Error on the rows that the moments are of."""
        centre, n = own.dense.mean, own.dense.n
        v = np.append(-self.w, 1.0)
        miss = centre @ v - self.intercept
        cross = own.about(centre) @ v + own.n * miss
        total = float(v @ own.dense.products @ v) + n * miss * miss - 2.0 * float(self.b @ cross) + float(own.n @ (self.b * self.b))
        return math.sqrt(max(total, 0.0) / n)


def slot_ridge(m: SlotMoments, alpha: float) -> Linear:
    """Minimises residual + alpha * |coefficients|^2; the slots' coefficients are eliminated, since no row has two of them."""
    sums, n = m.about(m.dense.mean), m.n
    p = sums.shape[1] - 1
    left = np.column_stack([n, sums[:, :p]])
    share = np.divide(1.0, n + alpha, out=np.zeros_like(n), where=n + alpha > 0)
    a = np.zeros((p + 1, p + 1))
    a[0, 0], a[1:, 1:] = m.dense.n, m.dense.products[:p, :p] + alpha * np.eye(p)
    a -= left.T @ (left * share[:, None])
    c = np.append(0.0, m.dense.products[:p, p]) - left.T @ (sums[:, p] * share)
    found = np.linalg.lstsq(a, c, rcond=None)[0]
    b = (sums[:, p] - left @ found) * share
    return Linear(float(found[0] + m.dense.mean[p] - found[1:] @ m.dense.mean[:p]), found[1:], b)


def slot_lasso(m: SlotMoments, alpha: float, tolerance: float = 1e-10, most: int = 20_000) -> Linear:
    """Minimises residual / (2n) + alpha * |coefficients| by descent over the moments: slots all at once, features one by one."""
    sums, count = m.about(m.dense.mean), m.dense.n
    p = sums.shape[1] - 1
    x, y, n = sums[:, :p], sums[:, p], m.n
    gram, target = m.dense.products[:p, :p], m.dense.products[:p, p]
    w, b, start, bound = np.zeros(p), np.zeros(len(n)), 0.0, count * alpha
    scale = math.sqrt(max(float(m.dense.products[p, p]), 0.0) / count) or 1.0
    spread = np.sqrt(np.maximum(np.diag(gram), 0.0) / count)

    def shrunk(v, by):
        return np.sign(v) * np.maximum(np.abs(v) - by, 0.0)

    for _ in range(most):
        moved = 0.0
        if len(n):
            new = np.divide(shrunk(y - n * start - x @ w, bound), n, out=np.zeros_like(b), where=n > 0)
            moved, b = float(np.abs(new - b).max()), new
        left = target - gram @ w - x.T @ b
        for j in range(p):
            if gram[j, j] <= 0:
                continue
            new = float(shrunk(left[j] + gram[j, j] * w[j], bound)) / gram[j, j]
            if new != w[j]:
                left -= gram[:, j] * (new - w[j])
                moved, w[j] = max(moved, abs(new - w[j]) * spread[j]), new
        new = -float(n @ b) / count
        moved, start = max(moved, abs(new - start)), new
        if moved <= tolerance * scale:
            break
    return Linear(float(start + m.dense.mean[p] - w @ m.dense.mean[:p]), w, b)


def penalised_scores(table: DataFrame, wanted: Sequence[tuple[str, float, int]], hot: str | None = None) -> list[float]:
    """Held-out error of each ``("l1" or "l2", alpha, fold left out)``, from one reading of the rows for all of them; infinity without rows to fit or to score."""
    slots = 0
    if hot is not None:
        first = table.select(hot).first()
        slots = first[0].size if first else 0
    found = slot_moments(table, hot, slots)
    scores = []
    for kind, alpha, fold in wanted:
        others = [m for f, m in found.items() if f != fold]
        if fold not in found or not others:
            scores.append(math.inf)
            continue
        solve = slot_lasso if kind == "l1" else slot_ridge
        scores.append(solve(reduce(SlotMoments.__add__, others), alpha).rmse(found[fold]))
    return scores

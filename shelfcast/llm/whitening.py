"""Whitening of embeddings from an eigendecomposition that is kept up to date row by row.

Each partition holds the spectrum of the scatter of its rows: eigenvalues and eigenvectors. A row, centred, is a rank-one
update: the new eigenvalues are the roots of the secular equation, and components of the update that are zero or belong to
equal eigenvalues are deflated. Spectra are combined by applying the directions of one to the other, again one by one. The spectrum
of all rows is refined by a Rayleigh-Ritz pass over the rows, which gives the eigenpairs of their covariance to double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.runs import map_runs
from shelfcast.session import materialise

_EPS = np.finfo(np.float64).eps
#: Entries beyond this (in steps) count as this, so that they and their sums stay whole numbers.
_MOST = 1 << 52
#: Rows that are turned into at most one row per dimension before they are applied.
BLOCK_ROWS = 4096
#: Spectra that one task combines in a round.
FAN_IN = 8
_HALVINGS = 60


@dataclass(frozen=True)
class Grid:
    """An entry c becomes the whole number floor(scale * c) + shift."""

    scale: int = 1024
    shift: int = 100_000


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + z z' for rising, distinct d and z without zeros, and (eigenvalue i) - d[j].

    Root i lies between d[i] and d[i + 1]. It is looked for as a distance from the nearer of the two, so that
    its small differences from the poles keep their digits.
    """
    z2 = z * z
    gap = np.append(d[1:], d[-1] + z2.sum()) - d
    middle = 1 + (z2 / (d - (d + gap / 2)[:, None])).sum(axis=1)
    right = middle <= 0
    right[-1] = False
    origin = np.where(right, np.append(d[1:], 0.0), d)
    delta = d - origin[:, None]
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, gap)
    high[:-1] = np.where(right[:-1], 0.0, gap[:-1] / 2)
    for _ in range(_HALVINGS):
        t = (low + high) / 2
        above = 1 + (z2 / (delta - t[:, None])).sum(axis=1) > 0
        low, high = np.where(above, low, t), np.where(above, t, high)
    t = np.where(right, low, high)  # never the pole itself
    return origin + t, t[:, None] - delta


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum (rising eigenvalues, eigenvectors in columns) after adding u u'."""
    z = vectors.T @ u
    norm = float(z @ z)
    if not norm:
        return values, vectors
    tiny = 8 * _EPS * max(float(np.abs(values).max()), norm)
    vectors = vectors.copy()
    for i in np.flatnonzero(np.diff(values) <= tiny):  # equal eigenvalues: turn their plane until one has all of z
        r = np.hypot(z[i], z[i + 1])
        if r:
            c, s = z[i + 1] / r, z[i] / r
            a, b = vectors[:, i].copy(), vectors[:, i + 1]
            vectors[:, i], vectors[:, i + 1] = c * a - s * b, s * a + c * b
            z[i], z[i + 1] = 0.0, r
    touched = np.abs(z) * np.sqrt(norm) > tiny
    d, z = values[touched], z[touched]
    if len(d):
        new, differences = secular_roots(d, z)
        far = np.abs(differences)
        apart = np.abs(d[:, None] - d) + np.eye(len(d))
        # The z for which the computed roots are exact; eigenvectors made from it are orthogonal to the last digits.
        z = np.copysign(np.exp((np.log(far).sum(axis=0) - np.log(apart).sum(axis=0)) / 2), z)
        turn = -z[:, None] / differences.T
        turn /= np.linalg.norm(turn, axis=0)
        values = values.copy()
        values[touched] = new
        vectors[:, touched] = vectors[:, touched] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Rows seen so far: their number, exact sums, mean, and the spectrum of their centred scatter."""

    def __init__(self, size: int):
        self.n, self.sums = 0, [0] * size
        self.mean, self.values, self.vectors = np.zeros(size), np.zeros(size), np.eye(size)

    def add(self, x: np.ndarray) -> None:
        """Whole-number rows, a block at a time."""
        for at in range(0, len(x), BLOCK_ROWS):
            block = x[at : at + BLOCK_ROWS]
            self.sums = [a + b for a, b in zip(self.sums, exact_sums(block), strict=True)]
            mean = block.mean(axis=0, dtype=np.float64)
            centred = block - mean
            if len(block) > block.shape[1]:  # an orthogonal turn leaves the scatter as it is, with fewer rows
                centred = np.linalg.qr(centred, mode="r")
            self._combine(len(block), mean, centred)

    def join(self, n: int, sums: list[int], mean: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> None:
        """The rows of another spectrum."""
        self.sums = [a + b for a, b in zip(self.sums, sums, strict=True)]
        if not self.n:
            self.n, self.mean, self.values, self.vectors = n, mean, values, vectors
            return
        self._combine(n, mean, (vectors * np.sqrt(np.maximum(values, 0.0))).T)

    def _combine(self, n: int, mean: np.ndarray, rows: np.ndarray) -> None:
        step = mean - self.mean
        for u in rows:
            self.values, self.vectors = rank_one(self.values, self.vectors, u)
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, step * np.sqrt(self.n * (n / (self.n + n))))
        self.n += n
        self.mean = self.mean + step * (n / self.n)

    def row(self, part: int) -> pa.RecordBatch:
        low = [s & ((1 << 32) - 1) for s in self.sums]
        high = [s >> 32 for s in self.sums]
        cells = [part, self.n, low, high, self.mean.tolist(), self.values.tolist(), self.vectors.ravel().tolist()]
        return pa.RecordBatch.from_arrays([pa.array([c]) for c in cells], names=_ROW_NAMES)


_ROW = "part long, n long, low array<long>, high array<long>, mean array<double>, vals array<double>, vectors array<double>"
_ROW_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def exact_sums(x: np.ndarray) -> list[int]:
    """Sums of the columns of whole numbers below 2^53, without overflow."""
    low = (x & ((1 << 26) - 1)).sum(axis=0)
    return [(int(h) << 26) + int(l) for h, l in zip((x >> 26).sum(axis=0), low, strict=True)]


def whole_rows(batch: pa.RecordBatch, column: str, size: int, grid: Grid) -> tuple[np.ndarray, np.ndarray]:
    """(places of the usable rows, their entries as whole numbers)."""
    lists = batch.column(column)
    at = np.flatnonzero(pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False) == size)
    flat = lists.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), size)
    good = np.isfinite(flat).all(axis=1)
    steps = np.clip(np.floor(flat[good] * grid.scale), -_MOST, _MOST).astype(np.int64) + grid.shift
    return at[good], steps


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: rows, exact sums, the leading eigenvalues and eigenvectors (columns), trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    grid: Grid
    column: str

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact."""
        sums = np.array(self.sums, dtype=object)
        bound = self.n * max(int(np.abs(x).max(initial=0)), 1) + max(abs(s) for s in self.sums)
        if bound < 1 << 62:
            return self.n * x - sums.astype(np.int64)
        return self.n * x.astype(object) - sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.offsets(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - sums)^2 of each row; None where it is beyond 64 bits."""
        off = self.offsets(x)
        most = int(np.abs(off).max(initial=0))
        if most * most * off.shape[1] < 1 << 62:
            return (off * off).sum(axis=1).tolist()
        return [s if s < 1 << 63 else None for s in (sum(int(v) ** 2 for v in r) for r in off)]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Unit-variance components; NaN where the eigenvalue is zero."""
        flat = ~self.positive()
        with np.errstate(divide="ignore", invalid="ignore"):
            out = self.centred(x) @ self.vectors / np.sqrt(np.maximum(self.values, 0.0))
        out[:, flat] = np.nan
        return out

    def positive(self) -> np.ndarray:
        return self.values > len(self.sums) * _EPS * self.trace

    def explained(self) -> np.ndarray:
        return np.maximum(self.values, 0.0) / self.trace if self.trace else np.zeros(len(self.values))


def _spectrum(rows: DataFrame, column: str, size: int, grid: Grid) -> Spectrum | None:
    """The spectrum of all usable rows: one per partition, then combined eight by eight."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part, waiting, count = Spectrum(size), 0, [], 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
                waiting.append(whole_rows(batch, column, size, grid)[1])
                count += len(waiting[-1])
                if count >= BLOCK_ROWS:
                    held.add(np.concatenate(waiting))
                    waiting, count = [], 0
        if count:
            held.add(np.concatenate(waiting))
        if held.n:
            yield held.row(part)

    def together(table: pa.Table) -> Iterator[pa.RecordBatch]:
        held = Spectrum(size)
        for r in table.to_pylist():
            sums = [(h << 32) + l for h, l in zip(r["high"], r["low"], strict=True)]
            held.join(r["n"], sums, np.array(r["mean"]), np.array(r["vals"]), np.array(r["vectors"]).reshape(size, size))
        yield held.row(table.column("team")[0].as_py())

    parts = materialise(rows.select(column).withColumn("part", F.spark_partition_id()).mapInArrow(own, _ROW), "spectra")
    while parts.rows > 1:
        teams = parts.df.withColumn("team", F.floor(F.col("part") / FAN_IN).cast("long"))
        parts = materialise(map_runs(teams, ["team"], ["part"], together, _ROW), "spectra")
    found = parts.df.collect()  # one row of about as many numbers as the covariance has
    if not found:
        return None
    out = Spectrum(size)
    r = found[0]
    sums = [(h << 32) + l for h, l in zip(r["high"], r["low"], strict=True)]
    out.join(r["n"], sums, np.array(r["mean"]), np.array(r["vals"]), np.array(r["vectors"]).reshape(size, size))
    return out


def _products(rows: DataFrame, column: str, size: int, grid: Grid, project) -> np.ndarray:
    """Sum over all usable rows of y y', where y is ``project`` of the row; one matrix per task is shuffled."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = whole_rows(batch, column, size, grid)[1] if batch.num_rows else ()
            if len(x):
                y = project(x)
                total = y.T @ y + (0.0 if total is None else total)
        if total is not None:
            cells = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "amount"])

    made = rows.select(column).mapInArrow(own, "cell long, amount double")
    cells = sorted((r["cell"], r["total"]) for r in made.groupBy("cell").agg(F.sum("amount").alias("total")).collect())
    side = int(round(len(cells) ** 0.5))
    return np.array([v for _, v in cells]).reshape(side, side)


def fit(rows: DataFrame, components: int = 8, column: str = "embedding", grid: Grid = Grid()) -> Whitening | None:
    """Leading eigenpairs of the covariance of all usable rows; None if there are none.

    Usable rows have a vector without null or non-finite entries that is as long as most vectors are (on a tie the longer).
    Four passes: lengths, spectra, Rayleigh-Ritz, and none of them brings rows together. The driver holds a few
    matrices of dimension times dimension.
    """
    lengths = rows.filter(F.size(F.col(f"`{column}`")) > 0).groupBy(F.size(F.col(f"`{column}`")).alias("size"))
    usual = lengths.agg(F.count(F.lit(1)).alias("times")).orderBy(F.desc("times"), F.desc("size")).first()
    if usual is None:
        return None
    size = usual["size"]
    spectrum = _spectrum(rows, column, size, grid)
    if spectrum is None:
        return None
    whole = Whitening(spectrum.n, tuple(spectrum.sums), np.zeros(size), spectrum.vectors, 0.0, grid, column)
    held = _products(rows, column, size, grid, lambda x: whole.centred(x) @ whole.vectors) / spectrum.n
    values, turn = np.linalg.eigh((held + held.T) / 2)
    top = np.argsort(values)[::-1][: min(components, size)]
    vectors = spectrum.vectors @ turn[:, top]
    vectors /= np.linalg.norm(vectors, axis=0)
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), range(len(top))])
    return Whitening(spectrum.n, tuple(spectrum.sums), np.maximum(values[top], 0.0), vectors, float(np.trace(held)), grid, column)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, measured on the rows."""
    keep = np.flatnonzero(model.positive())
    if not len(keep):
        return 0.0

    def with_one(x: np.ndarray) -> np.ndarray:
        return np.column_stack([model.whiten(x)[:, keep], np.ones(len(x))])

    held = _products(rows, model.column, len(model.sums), model.grid, with_one) / model.n
    mean = held[-1, :-1]
    return float(np.abs(held[:-1, :-1] - np.outer(mean, mean) - np.eye(len(keep))).max())


def whiten(
    vectors: DataFrame, components: int = 8, id_column: str = "vec_id", column: str = "embedding", grid: Grid = Grid()
) -> DataFrame:
    """One row per usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Entries are put on a grid of whole numbers (see Grid), means are exact, and rows are centred before they are multiplied. Components
    are numbered from 1 by falling eigenvalue; there are no more than dimensions. An eigenvector's largest entry is positive.
    ``deviation`` is the sum over dimensions of (n * x - sum)^2, null beyond 64 bits.

    Vectors that are null or empty, hold null or non-finite entries, or have another length than most have no rows. Entries are
    cut at 2^52 steps. Repeated rows, and rows with equal or null ids, count and are returned each. Where all vectors are equal, or
    there are fewer than components, the directions without variance have null ``whitened`` and no share in ``identity_error``. An empty table
    gives an empty table. Other columns are left out.
    """
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{column}`").alias("vector"))
    schema = f"vec_id {rows.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [c.split()[0] for c in schema.split(", ")]
    model = fit(rows, components, "vector", grid)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error, share, size = identity_error(rows, model), model.explained(), len(model.sums)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = whole_rows(batch, "vector", size, grid) if batch.num_rows else ((), ())
            if not len(at):
                continue
            k = len(share)
            white, each = model.whiten(x).ravel(), np.repeat(at, k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(each), model.n, np.int64)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                    pa.array(white, mask=np.isnan(white)),
                    pa.array(np.tile(share, len(at))),
                    pa.array(np.full(len(each), error)),
                ],
                names=names,
            )

    return rows.mapInArrow(score, schema)

"""Boosted regression trees for many folds and settings at once: a pass over the rows grows a level of every model.

Spark ML's ``GBTRegressor`` fits one model at a time: each fold and each setting reads, bins and keeps the rows for itself. Here the rows are
coded once, by the thresholds of all models together, and a task adds up the histograms of all models from the same chunk of rows. Thresholds,
samples, feature choices, gains and the order of additions to a prediction follow Spark's, so the trees are those of ``GBTRegressor``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import discard, materialise, written_here

#: Rows of a chunk, which is one row of the coded table.
CHUNK = 32_768
#: Rounds after which the predictions so far are written, so that a pass reads few trees.
KEEP_EVERY = 8
#: Bins of a joint histogram of several features.
JOINT_BINS = 1_024
#: Models whose histograms a task holds at a time.
TOGETHER = 40
_NO_FOLD = -(2**31)
_EPSILON = 2.220446049250313e-16
_MASK = (1 << 64) - 1


# --- random numbers as Spark draws them ------------------------------------------------


def _murmur(data: bytes, seed: int) -> int:
    h = seed & 0xFFFFFFFF
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = ((k << 15) | (k >> 17)) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = ((h << 13) | (h >> 19)) & 0xFFFFFFFF
        h = (h * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ (h >> 16)) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ (h >> 16)


def _signed(x: int, bits: int) -> int:
    return x - (1 << bits) if x >> (bits - 1) else x


class XorShift:
    """Spark's XORShiftRandom."""

    def __init__(self, seed: int):
        data = (seed & _MASK).to_bytes(8, "big")
        low = _murmur(data, 0x3C074A61)
        self.state = _murmur(data, low) << 32 | low

    def next(self, bits: int) -> int:
        x = self.state
        x ^= x << 21 & _MASK
        x ^= x >> 35
        x ^= x << 4 & _MASK
        self.state = x
        return x & ((1 << bits) - 1)

    def double(self) -> float:
        high = self.next(26)
        return ((high << 27) + self.next(27)) * 2.0**-53


class JavaRandom:
    """java.util.Random."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next32(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return _signed(self.state >> 16, 32)

    def long(self) -> int:
        high = self._next32()
        return _signed(((high << 32) + self._next32()) & _MASK, 64)


def _stepped(s: np.ndarray) -> np.ndarray:
    s = s ^ (s << np.uint64(21))
    s = s ^ (s >> np.uint64(35))
    return s ^ (s << np.uint64(4))


def _powers() -> list[np.ndarray]:
    """Images of the 64 bits under 1, 2, 4, ... steps of the generator, which is linear over bits."""
    images = [_stepped(np.uint64(1) << np.arange(64, dtype=np.uint64))]
    while len(images) < 48:
        images.append(_applied(images[-1], images[-1]))
    return images


def _applied(images: np.ndarray, states: np.ndarray) -> np.ndarray:
    out = np.zeros_like(states)
    for bit in range(64):
        out ^= np.where((states >> np.uint64(bit)) & np.uint64(1), images[bit], np.uint64(0))
    return out


_POWERS: list[np.ndarray] = []


def uniforms(seed: int, start: int, n: int) -> np.ndarray:
    """Draws ``start`` to ``start + n`` of the generator with this seed, as doubles."""
    if not _POWERS:
        _POWERS.extend(_powers())
    state = np.array([XorShift(seed).state], dtype=np.uint64)
    for k in range(48):
        if 2 * start >> k & 1:
            state = _applied(_POWERS[k], state)
    lanes = max(1, 1 << max(0, (n - 1).bit_length() - 5))
    steps = -(-n // lanes)
    steps = 1 << (steps - 1).bit_length()  # a power of two, so that lanes start at known powers
    width, k = 1, (2 * steps).bit_length() - 1
    while width < lanes:
        state = np.concatenate([state, _applied(_POWERS[k], state)])
        width, k = 2 * width, k + 1
    out = np.empty((steps, lanes))
    for i in range(steps):
        state = _stepped(state)
        high = state & np.uint64((1 << 26) - 1)
        state = _stepped(state)
        out[i] = ((high << np.uint64(27)) + (state & np.uint64((1 << 27) - 1))).astype(np.float64) * 2.0**-53
    return out.T.ravel()[:n]


def sampled_places(seed: int, partitions: Sequence[int], fraction: float) -> list[np.ndarray]:
    """Places of the rows that ``RDD.sample`` takes from each partition of so many rows."""
    if fraction >= 1:
        return [np.arange(n) for n in partitions]
    source = JavaRandom(_signed(XorShift(seed).next(32), 32))
    found = []
    for n in partitions:
        rng, own = XorShift(source.long()), []
        if fraction > 0.4:
            own = [i for i in range(n) if rng.double() <= fraction]
        else:
            log, at = math.log1p(-fraction), -1
            while True:
                at += 1 + int(math.log(max(rng.double(), 5e-11)) / log)
                if at >= n:
                    break
                own.append(at)
        found.append(np.array(own, dtype=np.int64))
    return found


# --- settings and trees -----------------------------------------------------------------


@dataclass(frozen=True)
class Spec:
    """A model to fit: its settings, the columns that it reads and the fold that it must not see."""

    rounds: int
    depth: int
    rate: float
    subsample: float
    min_rows: int
    min_gain: float
    strategy: str
    absolute: bool
    max_bins: int
    seed: int
    fold: int | None = None
    columns: tuple[int, ...] | None = None

    @classmethod
    def of(cls, booster: GBTRegressor, fold: int | None, columns: Sequence[int] | None = None) -> Spec | None:
        """The settings of an estimator; None if it asks for something that only Spark's own fit does."""
        booster._transfer_params_to_java()  # refuses values outside their ranges
        get = booster.getOrDefault
        plain = (
            get(booster.impurity) == "variance" and get(booster.minWeightFractionPerNode) == 0.0 and not booster.isDefined(booster.weightCol)
            and not booster.isDefined(booster.validationIndicatorCol) and not get(booster.leafCol)
        )
        strategy = get(booster.featureSubsetStrategy)
        if not plain or not (strategy == "all" or _fraction(strategy) is not None):
            return None
        return cls(
            get(booster.maxIter), get(booster.maxDepth), get(booster.stepSize), get(booster.subsamplingRate), get(booster.minInstancesPerNode),
            get(booster.minInfoGain), strategy, get(booster.lossType) == "absolute", get(booster.maxBins), get(booster.seed), fold,
            None if columns is None else tuple(columns),
        )

    def chosen(self, features: int) -> int:
        """Features that a node looks at."""
        share = _fraction(self.strategy)
        return features if self.strategy == "all" else max(1, min(features, math.ceil(share * features)))


def _fraction(strategy: str) -> float | None:
    try:
        share = float(strategy)
    except ValueError:
        return None
    return share if 0 < share <= 1 and "." in strategy else None


@dataclass
class Tree:
    """A tree in heap order without place 0: the root is 1, children of ``i`` are ``2i`` and ``2i + 1``. A leaf keeps its place to the deepest level, on the left."""

    depth: int
    splits: dict[int, tuple[int, float]] = field(default_factory=dict)  # place -> (feature, threshold); a value up to the threshold goes left
    values: dict[int, float] = field(default_factory=dict)  # leaves

    def levels(self) -> list[list[tuple[int, int, float]]]:
        out: list[list[tuple[int, int, float]]] = [[] for _ in range(self.depth)]
        for place, (feature, threshold) in sorted(self.splits.items()):
            out[place.bit_length() - 1].append((place, feature, threshold))
        return out

    def leaves(self, default: float = 0.0) -> np.ndarray:
        """Value by place on the deepest level, counted from 0."""
        out = np.full(1 << self.depth, default)
        for place, value in self.values.items():
            down = self.depth - place.bit_length() + 1
            out[(place << down) - (1 << self.depth)] = value
        return out


Columns = Callable[[int, float], np.ndarray]


def _places(levels: Sequence[Sequence[tuple[int, int, float]]], n: int, right: Columns) -> np.ndarray:
    """Place of every row on the level below the given ones, counted from 0. ``right(feature, threshold)`` tells which rows go right."""
    kind = np.uint8 if len(levels) < 8 else np.uint16 if len(levels) < 16 else np.uint32
    node = np.zeros(n, dtype=kind)
    for depth, level in enumerate(levels):
        turn = None
        for place, feature, threshold in level:
            goes = right(feature, threshold)
            if depth:
                goes &= node == kind(place - (1 << depth))
            turn = goes if turn is None else np.logical_or(turn, goes, out=turn)
        node <<= kind(1)
        if turn is not None:
            node |= turn.view(np.uint8)
    return node


@dataclass
class Boosted:
    """A fitted model."""

    trees: list[Tree]
    rate: float
    seed: int
    columns: tuple[int, ...] | None = None
    hot: str | None = None  # the 0/1 vector that it reads beside the features
    curve: list[float] = field(default_factory=list)  # held-out error after each round

    @property
    def getNumTrees(self) -> int:  # the name of Spark's model
        return len(self.trees)

    def first(self, rounds: int) -> Boosted:
        """The model after so many rounds."""
        return replace(self, trees=self.trees[:rounds], curve=self.curve[:rounds])

    def predicted(self, n: int, right: Columns) -> np.ndarray:
        total = np.zeros(n)
        for i, tree in enumerate(self.trees):
            total += tree.leaves().take(_places(tree.levels(), n, right)) * (1.0 if i == 0 else self.rate)
        return total

    def transform(self, rows: DataFrame) -> DataFrame:
        return predictions(rows, {"prediction": {None: self}})


def predictions(rows: DataFrame, wanted: dict[str, dict[int | None, Boosted]], by: str = "fold") -> DataFrame:
    """``rows`` without their vectors and with the predictions that are ``wanted``: per column the model of the row's ``by``, or one model (None) for all rows.

    Rows for which there is no model are left out.
    """
    hot = next((m.hot for models in wanted.values() for m in models.values()), None)
    wanted = {out: {k: replace(m, curve=[]) for k, m in models.items()} for out, models in wanted.items()}
    inner = ["_x"] + ([] if hot is None else ["_slots"])
    extra = [vector_to_array("features").alias("_x")] + ([] if hot is None else [slot_of(hot).alias("_slots")])
    kept = [c for c in rows.columns if c not in ("features", hot, *wanted)]
    plain = rows.select(*kept, *extra)
    names = [c for c in plain.columns if c not in inner]
    schema = T.StructType([*[plain.schema[c] for c in names], *[T.StructField(out, T.DoubleType()) for out in wanted]])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.ascontiguousarray(_matrix(batch, "_x").T)
            slots = None if hot is None else batch.column("_slots").to_numpy(zero_copy_only=False)
            columns = []
            for models in wanted.values():
                found = np.full(batch.num_rows, np.nan)
                for key, model in models.items():
                    at = np.arange(batch.num_rows) if key is None else np.flatnonzero(batch.column(by).to_numpy(zero_copy_only=False) == key)
                    if len(at):
                        found[at] = model.predicted(len(at), _raw(x[:, at], None if slots is None else slots[at], model.columns))
                columns.append(pa.array(found))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *columns], names=[*names, *wanted])

    for models in wanted.values():
        if None not in models:
            plain = plain.filter(F.col(by).isin(list(models)))
    return plain.mapInArrow(scored, schema)


def _raw(x: np.ndarray, slots: np.ndarray | None, columns: Sequence[int] | None) -> Columns:
    own = len(x) if columns is None else len(columns)

    def right(feature: int, threshold: float) -> np.ndarray:
        if feature >= own:
            return slots == feature - own
        return x[feature if columns is None else columns[feature]] > threshold

    return right


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def slot_of(hot: str) -> Column:
    """Place of the only 1 of a sparse 0/1 vector, -1 if it has none."""
    indices = F.unwrap_udt(F.col(hot)).getField("indices")
    values = F.unwrap_udt(F.col(hot)).getField("values")
    sparse = F.coalesce(F.get(indices, F.lit(0)), F.lit(-1))
    dense = F.coalesce(F.array_position(values, F.lit(1.0)).cast("int"), F.lit(0)) - 1
    return F.when(F.unwrap_udt(F.col(hot)).getField("type") == 0, sparse).otherwise(dense).cast("int")


# --- thresholds ---------------------------------------------------------------------------


def thresholds(values: np.ndarray, expected: float, splits: int) -> np.ndarray:
    """Spark's candidate splits of a continuous feature: as many as possible, else about equal counts. Zeros are what the sample lacks of the expected rows."""
    values = values[values != 0]
    if not len(values):
        return np.empty(0)
    found, counts = np.unique(values, return_counts=True)
    counts = counts.astype(np.float64)
    if expected - len(values) > _EPSILON * len(values) * 100:
        at = int(np.searchsorted(found, 0.0))
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, expected - len(values))
    if len(found) - 1 <= splits:
        return (found[:-1] + found[1:]) / 2.0
    stride = expected / (splits + 1)
    out, current, target = [], counts[0], stride
    for i in range(1, len(found)):
        before, current = current, current + counts[i]
        if abs(before - target) < abs(current - target):
            out.append((found[i - 1] + found[i]) / 2.0)
            target += stride
    return np.array(out)


# --- the coded table ----------------------------------------------------------------------


@dataclass(frozen=True)
class Part:
    """Thresholds of the models that leave out one fold: per feature, and the slots of the 0/1 vector that the sample has seen on and off."""

    rows: int
    edges: list[np.ndarray]
    hot: np.ndarray


class Coded:
    """The rows of a table of vectors in chunks, with features coded by the thresholds of all parts."""

    def __init__(self, table: DataFrame, kinds: Iterable[tuple[int, int]], folds: Iterable[int | None], hot: str | None = None):
        """``kinds`` are the seeds and numbers of bins of the models, ``folds`` those that models leave out (None: they see all rows)."""
        self.spark = table.sparkSession
        self.hot = hot
        broken = F.col("label").isNull() | F.isnan("label")
        label = F.when(broken, F.raise_error(F.lit("Labels MUST NOT be Null or NaN")).cast("double")).otherwise(F.col("label"))
        fold = F.coalesce(F.col("fold").cast("int"), F.lit(_NO_FOLD)) if "fold" in table.columns else F.lit(_NO_FOLD)
        named = [vector_to_array("features").alias("x"), *([] if hot is None else [slot_of(hot).alias("slot")])]
        rows = table.select(*named, label.cast("double").alias("y"), fold.alias("fold"))
        self.sizes = self._sizes(rows)
        first = table.select("features", *([hot] if hot else [])).first()
        self.features = first[0].size if first else 0
        self.slots = first[1].size if first and hot else 0
        self.parts: dict[tuple[int, int, int | None], Part] = self._parts(rows, kinds, folds) if first else {}
        self.union = [
            np.unique(np.concatenate([p.edges[j] for p in self.parts.values()] or [np.empty(0)])) for j in range(self.features)
        ]
        with written_here() as self.made:
            self.df = materialise(rows.mapInArrow(_coding(self.union, hot is not None), CODED), "coded").df

    def _sizes(self, rows: DataFrame) -> list[dict[int, int]]:
        """Rows of each fold, by partition."""

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, int] = {}
            for batch in batches:
                for f, n in zip(*np.unique(batch.column("fold").to_numpy(zero_copy_only=False), return_counts=True), strict=True):
                    held[int(f)] = held.get(int(f), 0) + int(n)
            part = TaskContext.get().partitionId()
            if held:
                yield pa.RecordBatch.from_pydict({"part": [part] * len(held), "fold": list(held), "n": list(held.values())}, schema=pa.schema([("part", pa.int32()), ("fold", pa.int32()), ("n", pa.int64())]))

        found = rows.select("fold", "y").mapInArrow(counted, "part int, fold int, n long").collect()
        sizes: list[dict[int, int]] = [{} for _ in range(1 + max((r["part"] for r in found), default=-1))]
        for r in found:
            sizes[r["part"]][r["fold"]] = r["n"]
        return sizes

    def rows_of(self, fold: int | None) -> list[int]:
        """Rows of each partition that models without the fold are fitted on."""
        return [sum(n for f, n in own.items() if fold is None or f not in (fold, _NO_FOLD)) for own in self.sizes]

    def _parts(self, rows: DataFrame, kinds: Iterable[tuple[int, int]], folds: Iterable[int | None]) -> dict[tuple[int, int, int | None], Part]:
        wanted, places, plans = [(s, b, f) for s, b in dict.fromkeys(kinds) for f in dict.fromkeys(folds)], {}, {}
        for seed, bins, fold in wanted:
            sizes = self.rows_of(fold)
            n = sum(sizes)
            most = min(bins, n)
            needed = max(most * most, 10_000)
            share = needed / n if needed < n else 1.0
            plans[seed, bins, fold] = (n, share * n, most - 1)
            if (seed, share, fold) not in places:
                places[seed, share, fold] = sampled_places(seed, sizes, share)
            plans[seed, bins, fold] += ((seed, share, fold),)
        names = list(places)
        by_part = [[places[k][p] for k in names] for p in range(len(self.sizes))]
        sent = self.spark.sparkContext.broadcast(by_part)
        left = [k[2] for k in names]

        def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine = sent.value[TaskContext.get().partitionId()]
            at = [0] * len(left)
            for batch in batches:
                own = batch.column("fold").to_numpy(zero_copy_only=False)
                for i, fold in enumerate(left):
                    inside = np.arange(len(own)) if fold is None else np.flatnonzero((own != fold) & (own != _NO_FOLD))
                    low, high = np.searchsorted(mine[i], [at[i], at[i] + len(inside)])
                    rows = inside[mine[i][low:high] - at[i]]
                    at[i] += len(inside)
                    if len(rows):
                        x = np.ascontiguousarray(_matrix(batch, "x")[rows])
                        slots = batch.column("slot").to_numpy(zero_copy_only=False)[rows] if "slot" in batch.schema.names else np.empty(0)
                        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([x.tobytes()]), pa.array([slots.astype(np.int32).tobytes()])], names=["k", "x", "slots"])

        samples: dict[int, list] = {}
        for r in rows.drop("y").mapInArrow(taken, "k int, x binary, slots binary").collect():
            samples.setdefault(r["k"], []).append((np.frombuffer(r["x"]).reshape(-1, self.features), np.frombuffer(r["slots"], dtype=np.int32)))
        sent.unpersist()
        found = {}
        for key, (n, expected, splits, name) in plans.items():
            own = samples.get(names.index(name), [])
            x = np.concatenate([a for a, _ in own]) if own else np.empty((0, self.features))
            slots = np.concatenate([b for _, b in own]) if own else np.empty(0, dtype=np.int32)
            on = np.bincount(slots[slots >= 0], minlength=self.slots)
            # A slot that the sample has only off, or only on, is a constant.
            seen = np.flatnonzero((on > 0) & (expected - on > _EPSILON * on * 100)) if splits > 0 else np.empty(0, dtype=np.int64)
            found[key] = Part(n, [thresholds(x[:, j], expected, splits) for j in range(self.features)], seen)
        return found

    def close(self) -> None:
        discard(self.spark, self.made)


def _code_type(union: list[np.ndarray]) -> type:
    most = max(map(len, union), default=0)
    return np.uint8 if most < 256 else np.uint16 if most < 65_536 else np.uint32


CODED = "part int, n int, before binary, codes binary, slots binary, y binary, fold binary, kept binary"


def _coding(union: list[np.ndarray], hot: bool) -> Callable:
    """Rows to chunks. ``before`` tells how many rows of each fold the partition has before the chunk."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size, before = TaskContext.get().partitionId(), [], 0, {}

        def chunk() -> pa.RecordBatch:
            codes, slots, y, fold = ([a[i] for a in held] for i in range(4))
            codes, fold = np.concatenate(codes, axis=1), np.concatenate(fold)
            start = np.array([v for kv in before.items() for v in kv], dtype=np.int64)
            for f, n in zip(*np.unique(fold, return_counts=True), strict=True):
                before[int(f)] = before.get(int(f), 0) + int(n)
            bits = [start, codes, np.concatenate(slots), np.concatenate(y), fold, np.empty(0)]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([len(fold)], pa.int32()), *(pa.array([b.tobytes()], pa.binary()) for b in bits)],
                names=["part", "n", "before", "codes", "slots", "y", "fold", "kept"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch, "x")
            codes = np.empty((len(union), len(x)), dtype=_code_type(union))
            for j, edges in enumerate(union):
                codes[j] = np.searchsorted(edges, x[:, j], side="left")
            slots = batch.column("slot").to_numpy(zero_copy_only=False).astype(np.int32) if hot else np.empty(0, dtype=np.int32)
            held.append((codes, slots, batch.column("y").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy(zero_copy_only=False).astype(np.int32)))
            size += len(x)
            if size >= CHUNK - 2_000:
                yield chunk()
                held, size = [], 0
        if held:
            yield chunk()

    return coded


# --- growing ------------------------------------------------------------------------------


@dataclass
class _Growing:
    """A model on the way. Splits in ``trees`` and ``tree`` are by codes of the union of thresholds."""

    spec: Spec
    part: Part
    columns: list[int]
    trees: list[tuple[list, np.ndarray]] = field(default_factory=list)
    fitted: list[Tree] = field(default_factory=list)
    curve: list[float] = field(default_factory=list)
    tree: Tree | None = None
    coded: list[list[tuple[int, int, int]]] = field(default_factory=list)  # levels of the tree on the way
    order: list[int] = field(default_factory=list)  # nodes to split next, as Spark takes them from its stack
    random: JavaRandom | None = None


class Fitting:
    """Models grown side by side over one coded table."""

    def __init__(self, coded: Coded, specs: Sequence[Spec]):
        self.coded, self.made = coded, []
        self.models = []
        for s in specs:
            part = coded.parts[s.seed, s.max_bins, s.fold]
            if part.rows == 0:
                raise ValueError("no rows to fit a model on")
            self.models.append(_Growing(s, part, list(s.columns) if s.columns is not None else list(range(coded.features))))
        self.table, self.kept = coded.df, 0  # predictions after ``kept`` rounds are in the table

    def grow(self, rounds: int, which: Sequence[int] | None = None) -> None:
        """Goes on until the models (all, or those at ``which``) have so many rounds, or as many as they may have. A model that was left out stays as it is."""
        while True:
            active = [i for i, m in enumerate(self.models) if (which is None or i in which) and len(m.fitted) < min(rounds, m.spec.rounds)]
            if not active:
                break
            at = max(len(m.fitted) for m in self.models)
            if at - self.kept >= KEEP_EVERY:
                self._keep(at)
            for i in active:
                m = self.models[i]
                t = len(m.fitted)
                m.tree, m.coded, m.order, m.random = Tree(m.spec.depth), [], [1], JavaRandom(m.spec.seed + t)
            while busy := [i for i in active if self.models[i].order]:
                for some in (busy[k : k + TOGETHER] for k in range(0, len(busy), TOGETHER)):
                    sums = self._pass(some)
                    for i in some:
                        self._split(self.models[i], sums[i])
            for i in active:
                m = self.models[i]
                levels = [*m.coded, *[[] for _ in range(m.spec.depth - len(m.coded))]]
                m.trees.append((levels, m.tree.leaves() * (1.0 if not m.fitted else m.spec.rate)))
                m.fitted.append(m.tree)
                m.tree = None

    def curves(self, original: bool = False) -> None:
        """Held-out errors of all rounds, in one pass; ``original`` takes labels and predictions back from log1p first."""
        models = [(i, m.spec.fold, m.trees) for i, m in enumerate(self.models) if m.spec.fold is not None and len(m.curve) < len(m.fitted)]
        if not models:
            return
        features, kind = self.coded.features, _code_type(self.coded.union)

        def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for chunk in _chunks(batches, kind, features):
                own: dict[int, _Chunk] = {}
                for i, fold, trees in models:
                    if fold not in own:
                        own[fold] = chunk.taken(np.flatnonzero(chunk.fold == fold))
                    rows, total = own[fold], held.setdefault(i, np.zeros((2, len(trees))))
                    y, f = np.expm1(rows.y) if original else rows.y, np.zeros(rows.n)
                    for t, (levels, values) in enumerate(trees):
                        f += values.take(_places(levels, rows.n, rows.right))
                        total[0, t] += ((y - (np.expm1(f) if original else f)) ** 2).sum()
                        total[1, t] += rows.n
            for i, total in held.items():
                yield _sums(i, total.ravel())

        for i, total in self._added(errors, self.coded.df).items():
            squares, n = total.reshape(2, -1)
            self.models[i].curve = [math.sqrt(a / c) if c else math.nan for a, c in zip(squares.tolist(), n.tolist(), strict=True)]

    def result(self) -> list[Boosted]:
        return [Boosted(list(m.fitted), m.spec.rate, m.spec.seed, m.spec.columns, self.coded.hot, list(m.curve)) for m in self.models]

    def close(self) -> None:
        discard(self.coded.spark, self.made)

    def _added(self, task: Callable, table: DataFrame) -> dict[int, np.ndarray]:
        """Sums of what the tasks give, by model."""

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, held = None, None
            for batch in batches:
                for k, raw in zip(batch.column("model").to_pylist(), batch.column("sums"), strict=True):
                    part = np.frombuffer(raw.as_buffer())
                    if k == key:
                        held += part
                        continue
                    if key is not None:
                        yield _sums(key, held)
                    key, held = k, part.copy()
            if key is not None:
                yield _sums(key, held)

        schema = "model int, sums binary"
        parts = table.mapInArrow(task, schema)
        whole = parts.repartition("model").sortWithinPartitions("model").mapInArrow(added, schema)
        return {r["model"]: np.frombuffer(r["sums"]) for r in whole.collect()}

    def _keep(self, at: int) -> None:
        """Writes the predictions of all models, so that later passes read the trees after them only."""
        before, models = self.kept, [m.trees[self.kept : at] for m in self.models]
        features, kind = self.coded.features, _code_type(self.coded.union)

        def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    row = batch.slice(k, 1)
                    chunk = next(_chunks([row], kind, features))
                    found = np.empty((len(models), chunk.n))
                    for i, trees in enumerate(models):
                        found[i] = chunk.kept(i) if before else 0.0
                        for levels, values in trees:
                            found[i] += values.take(_places(levels, chunk.n, chunk.right))
                    names = row.schema.names
                    yield pa.RecordBatch.from_arrays([*(row.column(c) for c in names[:-1]), pa.array([found.tobytes()], pa.binary())], names=names)

        with written_here() as made:
            self.table = materialise(self.table.mapInArrow(kept, CODED), "boosted").df
        discard(self.coded.spark, self.made)
        self.made, self.kept = made, at

    def _pass(self, some: Sequence[int]) -> dict[int, np.ndarray]:
        """Per model the histograms of the nodes to split: rows, sums and, last, the sums of squares of each node."""
        union, features, kept, slots = self.coded.union, self.coded.features, self.kept, self.coded.slots
        kind = _code_type(union)
        groups, jobs = {}, []
        for i in some:
            m = self.models[i]
            s = m.spec
            key = (s.seed, s.max_bins, s.fold, tuple(m.columns))
            if key not in groups:
                groups[key] = _joint(m.part.edges, m.columns, union)
            depth = len(m.coded)
            spot = np.full(2 << depth, len(m.order), dtype=np.int64)  # other nodes, and rows that are not in, share a place that is left out
            for k, place in enumerate(m.order):
                spot[place - (1 << depth)] = k
            t = len(m.fitted)
            jobs.append((i, key, s.fold, m.trees[kept:], list(m.coded), spot, len(m.order), s.absolute, s.subsample, s.seed + t, t))
        hot = self.coded.hot is not None

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for chunk in _chunks(batches, kind, features):
                draws, places, streams = {}, {}, {}

                def drawn(seed: int, fold: int | None, chunk: _Chunk = chunk, streams: dict = streams) -> _Stream:
                    """The draws of the partition around this chunk; models that leave out a fold have nearly the same places in them."""
                    key = seed, fold is None
                    if key not in streams:
                        starts = [chunk.start(f) for f in ({j[2] for j in jobs} - {None} if fold is not None else [None])]
                        streams[key] = _Stream(min(starts), uniforms(seed + chunk.part + 1, min(starts), max(starts) - min(starts) + chunk.n))
                    return streams[key]

                joints = {key: [(width, _joint_codes(chunk.codes, maps)) for width, maps in groups[key]] for key in groups}
                for i, key, fold, trees, levels, spot, nodes, absolute, share, seed, t in jobs:
                    f = chunk.kept(i) if kept else 0.0
                    for past, values in trees:
                        f = f + values.take(_places(past, chunk.n, chunk.right))
                    if not t:
                        r = chunk.y
                    elif absolute:
                        r = np.where(chunk.y - f < 0, -1.0, 1.0)
                    else:
                        r = 2.0 * (chunk.y - f)
                    if fold not in places:
                        inside = np.ones(chunk.n, dtype=bool) if fold is None else (chunk.fold != fold) & (chunk.fold != _NO_FOLD)
                        places[fold] = inside, chunk.start(fold), np.cumsum(inside) - 1
                    inside, start, place = places[fold]
                    if share < 1:
                        if (fold, seed) not in draws:
                            draws[fold, seed] = drawn(seed, fold)[np.maximum(place, 0) + start]
                        inside = inside & (draws[fold, seed] < share)
                    depth = len(levels)
                    spots = _places(levels, chunk.n, chunk.right).astype(np.uint8 if depth < 8 else np.uint16 if depth < 16 else np.uint32, copy=False)
                    spots |= np.logical_not(inside).view(np.uint8).astype(spots.dtype, copy=False) << spots.dtype.type(depth)
                    node = spot.take(spots)
                    out = []
                    for width, joint in joints[key]:
                        at = node * width
                        at += joint
                        size = (nodes + 1) * width
                        out.append(np.bincount(at, minlength=size)[: nodes * width].astype(np.float64))
                        out.append(np.bincount(at, weights=r, minlength=size)[: nodes * width])
                    if hot:
                        at = node * (slots + 1)
                        at += chunk.slots
                        at += 1
                        size = (nodes + 1) * (slots + 1)
                        out.append(np.bincount(at, minlength=size)[: nodes * (slots + 1)].astype(np.float64))
                        out.append(np.bincount(at, weights=r, minlength=size)[: nodes * (slots + 1)])
                    if not joints[key]:
                        out.append(np.bincount(node, minlength=nodes + 1)[:nodes].astype(np.float64))
                        out.append(np.bincount(node, weights=r, minlength=nodes + 1)[:nodes])
                    out.append(np.bincount(node, weights=r * r, minlength=nodes + 1)[:nodes])
                    found = np.concatenate(out)
                    if i in held:
                        held[i] += found
                    else:
                        held[i] = found
            for i, found in held.items():
                yield _sums(i, found)

        return self._added(histograms, self.table)

    def _split(self, m: _Growing, sums: np.ndarray) -> None:
        """The best split of each node, from the histograms; what is not split is a leaf."""
        nodes, spec, union = len(m.order), m.spec, self.coded.union
        at = 0

        def cut(width: int) -> np.ndarray:
            nonlocal at
            found = sums[at : at + nodes * width].reshape(nodes, width)
            at += nodes * width
            return found

        counts: dict[int, np.ndarray] = {}
        totals: dict[int, np.ndarray] = {}
        for sizes, members in _packs(m.part.edges, m.columns):
            width = int(np.prod(sizes))
            n, s = cut(width).reshape(nodes, *sizes), cut(width).reshape(nodes, *sizes)
            for axis, j in enumerate(members, 1):
                others = tuple(a for a in range(1, len(sizes) + 1) if a != axis)
                counts[j], totals[j] = n.sum(axis=others), s.sum(axis=others)
        hot_n = hot_s = None
        if self.coded.hot is not None:
            hot_n, hot_s = (cut(self.coded.slots + 1)[:, 1:][:, m.part.hot] for _ in range(2))
        if counts:
            first = next(iter(counts))
            n, total = counts[first].sum(axis=1), totals[first].sum(axis=1)
        else:
            n, total = cut(1)[:, 0], cut(1)[:, 0]
        squares = cut(1)[:, 0]
        with np.errstate(all="ignore"):
            impurity = np.where(n > 0, (squares - total * total / n) / n, 0.0)
            means = np.where(n > 0, total / n, 0.0)
        features = len(m.columns) + self.coded.slots
        wide = spec.chosen(features)
        level, order = [], []
        for k, place in enumerate(m.order):
            if place > 1 and abs(impurity[k]) < _EPSILON:  # such a child never gets on Spark's stack
                m.tree.values[place] = float(means[k])
                continue
            chosen = None if wide == features else set(_reservoir(features, wide, m.random.long()))
            best = (0.0, -1, 0.0, 0)
            for f, j in enumerate(m.columns):
                edges = m.part.edges[j]
                if not len(edges) or (chosen is not None and f not in chosen):
                    continue
                left_n, left_s = np.cumsum(counts[j][k])[:-1], np.cumsum(totals[j][k])[:-1]
                gain, place_of = _best(left_n, left_s, n[k], total[k], spec)
                if gain > best[0]:
                    best = (gain, f, float(edges[place_of]), int(np.searchsorted(union[j], edges[place_of])))
            if hot_n is not None and len(m.part.hot):
                slots = np.arange(len(m.part.hot))
                if chosen is not None:
                    slots = np.array([i for i, v in enumerate(m.part.hot) if len(m.columns) + int(v) in chosen], dtype=np.int64)
                if len(slots):
                    gain, found = _best(n[k] - hot_n[k][slots], total[k] - hot_s[k][slots], n[k], total[k], spec)
                    if gain > best[0]:
                        slot = int(m.part.hot[slots[found]])
                        best = (gain, len(m.columns) + slot, 0.5, -1 - slot)
            if best[1] < 0:
                m.tree.values[place] = float(means[k])
                continue
            _, f, edge, code = best
            m.tree.splits[place] = (f, edge)
            level.append((place, m.columns[f] if code >= 0 else f, code))
            order += [2 * place, 2 * place + 1]
            if place.bit_length() == spec.depth:
                if code >= 0:
                    left = np.searchsorted(m.part.edges[m.columns[f]], edge) + 1
                    a, b = counts[m.columns[f]][k][:left].sum(), totals[m.columns[f]][k][:left].sum()
                else:
                    spot = int(np.searchsorted(m.part.hot, -1 - code))
                    a, b = n[k] - hot_n[k][spot], total[k] - hot_s[k][spot]
                m.tree.values[2 * place] = float(b / a)
                m.tree.values[2 * place + 1] = float((total[k] - b) / (n[k] - a))
        m.coded.append(level)
        # Children are pushed left then right, so the last node's right child comes first.
        m.order = order[::-1] if len(m.coded) < spec.depth else []
        if spec.depth == 0:
            m.order = []


def _best(left_n: np.ndarray, left_s: np.ndarray, n: float, total: float, spec: Spec) -> tuple[float, int]:
    """Largest gain in variance and the first place that has it; 0 if no split is allowed."""
    right_n, right_s = n - left_n, total - left_s
    with np.errstate(all="ignore"):
        gain = (left_s * left_s / left_n + right_s * right_s / right_n - total * total / n) / n
    least = max(spec.min_rows, 1)
    gain = np.where((left_n >= least) & (right_n >= least) & (gain >= spec.min_gain), gain, 0.0)
    at = int(np.argmax(gain))
    return float(gain[at]), at


def _reservoir(n: int, k: int, seed: int) -> list[int]:
    """Spark's reservoir sample of k of the first n numbers."""
    held, rng = list(range(k)), XorShift(seed)
    for i in range(k, n):
        at = int(rng.double() * (i + 1))
        if at < k:
            held[at] = i
    return held


def _packs(edges: list[np.ndarray], columns: Sequence[int]) -> list[tuple[list[int], list[int]]]:
    """Features whose bins are counted together: numbers of bins, and features. Constant features are left out."""
    packs: list[tuple[list[int], list[int]]] = []
    for j in sorted((j for j in columns if len(edges[j])), key=lambda j: -len(edges[j])):
        bins = len(edges[j]) + 1
        room = next((p for p in packs if int(np.prod(p[0])) * bins <= JOINT_BINS), None)
        if room is None:
            packs.append(([bins], [j]))
        else:
            room[0].append(bins)
            room[1].append(j)
    return packs


def _joint(edges: list[np.ndarray], columns: Sequence[int], union: list[np.ndarray]) -> list[tuple[int, list[tuple[int, np.ndarray]]]]:
    """Per pack its width, and per feature what a code adds to the place in the joint histogram."""
    out = []
    for sizes, members in _packs(edges, columns):
        width, maps = int(np.prod(sizes)), []
        stride = width
        for bins, j in zip(sizes, members, strict=True):
            stride //= bins
            below = np.concatenate([[0], np.searchsorted(edges[j], union[j], side="right")])
            maps.append((j, below.astype(np.int32) * stride))
        out.append((width, maps))
    return out


def _joint_codes(codes: np.ndarray, maps: list[tuple[int, np.ndarray]]) -> np.ndarray:
    total = None
    for j, table in maps:
        part = table.take(codes[j])
        total = part if total is None else total + part
    return total


def _sums(model: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([model], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["model", "sums"])


@dataclass(frozen=True)
class _Stream:
    """Draws of a generator from the one at ``start`` on."""

    start: int
    values: np.ndarray

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        return self.values[places - self.start]


@dataclass
class _Chunk:
    part: int
    n: int
    before: dict[int, int]
    codes: np.ndarray
    slots: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    held: np.ndarray

    def right(self, feature: int, code: int) -> np.ndarray:
        return self.codes[feature] > code if code >= 0 else self.slots == -1 - code

    def kept(self, model: int) -> np.ndarray:
        return self.held[model]

    def start(self, fold: int | None) -> int:
        """Rows of models without the fold that the partition has before this chunk."""
        return sum(n for f, n in self.before.items() if fold is None or f not in (fold, _NO_FOLD))

    def taken(self, at: np.ndarray) -> _Chunk:
        slots = self.slots[at] if len(self.slots) else self.slots
        return _Chunk(self.part, len(at), {}, self.codes[:, at], slots, self.y[at], self.fold[at], self.held)


def _chunks(batches: Iterator[pa.RecordBatch], coded: type, features: int) -> Iterator[_Chunk]:
    for batch in batches:
        for k in range(batch.num_rows):
            n = batch.column("n")[k].as_py()

            def raw(name: str, kind: type, k: int = k, batch: pa.RecordBatch = batch) -> np.ndarray:
                return np.frombuffer(batch.column(name)[k].as_buffer(), dtype=kind)

            before = raw("before", np.int64).reshape(-1, 2)
            yield _Chunk(
                batch.column("part")[k].as_py(), n, {int(f): int(c) for f, c in before}, raw("codes", coded).reshape(features, n),
                raw("slots", np.int32), raw("y", np.float64), raw("fold", np.int32), raw("kept", np.float64).reshape(-1, n),
            )

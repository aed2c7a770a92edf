"""Near-duplicate vectors by lattice hashing.

A table projects unit vectors at random to two groups of eight dimensions and decodes each to the
nearest point of the lattice E8; the two points are the vector's cell. A vector is stored in its own cell and
looks into the neighbouring cells too, those whose lattice points are next nearest. Vectors that meet in a cell
of any table are compared by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.graph import components
from shelfcast.llm.queues import fresh
from shelfcast.llm.runs import block_pairs, map_runs, matrix, numbers
from shelfcast.llm.text import mix
from shelfcast.session import materialise

_GROUPS = 2


@dataclass(frozen=True)
class Lattice:
    """Number of tables and of neighbouring cells looked into; lattice steps per unit of distance."""

    tables: int = 8
    probes: int = 6
    scale: float = 0.8
    block: int = 512
    seed: int = 8


@lru_cache(maxsize=1)
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a in (-1.0, 1.0):
            for b in (-1.0, 1.0):
                v = np.zeros(8)
                v[i], v[j] = a, b
                out.append(v)
    for signs in range(256):
        v = np.array([0.5 if signs >> k & 1 else -0.5 for k in range(8)])
        if int((v < 0).sum()) % 2 == 0:
            out.append(v)
    return np.array(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and where the sum is odd move the worst one."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    if len(odd):
        gap = x[odd] - r[odd]
        worst = np.abs(gap).argmax(axis=1)
        k = np.arange(len(odd))
        r[odd, worst] += np.where(gap[k, worst] >= 0, 1.0, -1.0)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: E8 is D8 and D8 moved by one half in every dimension."""
    whole = _nearest_d8(x)
    half = _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(nearer[:, None], half, whole)


@lru_cache(maxsize=8)
def _projections(size: int, lattice: Lattice) -> np.ndarray:
    rng = np.random.default_rng((lattice.seed, size))
    return rng.standard_normal((lattice.tables, _GROUPS, size, 8)) * lattice.scale


def _cell(points: np.ndarray, salt: int) -> np.ndarray:
    """64-bit name of one group's lattice point (points doubled, so that all are whole)."""
    h = np.full(len(points), (salt * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1), np.uint64)
    for k in range(8):
        h = mix(h ^ (np.rint(points[:, k] * 2).astype(np.int64).astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)))
    return h


def cells(unit: np.ndarray, lattice: Lattice) -> np.ndarray:
    """Names of the own cell (first) and the neighbouring cells: vectors x tables x (1 + probes)."""
    n, size = unit.shape
    out = np.zeros((n, lattice.tables, 1 + lattice.probes), np.int64)
    r = roots()
    for t in range(lattice.tables):
        own, near, gain = [], [], []
        for g in range(_GROUPS):
            x = unit @ _projections(size, lattice)[t, g]
            home = nearest_e8(x)
            salt = (t * _GROUPS + g) * 65536 + size
            own.append(_cell(home, salt))
            # |x - home - root|^2 = |x - home|^2 + 2 - 2 (x - home).root: the nearest next have the largest product.
            towards = (x - home) @ r.T
            best = np.argpartition(-towards, lattice.probes, axis=1)[:, : lattice.probes]
            gain.append(np.take_along_axis(towards, best, axis=1))
            near.append(np.stack([_cell(home + r[best[:, p]], salt) for p in range(lattice.probes)], axis=1))
        out[:, t, 0] = mix(own[0] + mix(own[1])).view(np.int64)
        # A neighbouring cell changes one group; the best of both groups' candidates are looked into.
        names = np.concatenate([mix(near[0] + mix(own[1])[:, None]), mix(own[0][:, None] + mix(near[1]))], axis=1)
        order = np.argsort(-np.concatenate(gain, axis=1), axis=1, kind="stable")[:, : lattice.probes]
        out[:, t, 1:] = np.take_along_axis(names, order, axis=1).view(np.int64)
    return out


def near_links(
    vectors: DataFrame, threshold: float = 0.95, lattice: Lattice = Lattice(), id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Every row of ``vectors`` with ``n_links, component_id, kept``.

    n_links counts the other rows whose cosine with this one is at least ``threshold``, as far as they met in
    a cell; component_id is the smallest id reachable over links; kept is whether that is the row's own id. Cosines are
    taken in double precision and no link is below the threshold. Equal vectors are compared once and
    counted as often as they occur. Large cells are cut into blocks that meet in pairs, so every two vectors of a
    cell are compared and no task holds more than two blocks; only counts and spanning links leave a task.

    A vector that is null, empty, zero or holds null, NaN or infinite components has no links and is kept;
    vectors of different lengths are never linked. Repeated rows count as rows; a null id is ignored when
    the smallest is taken (null if all are). Empty tables give an empty table; added names that are taken get
    an underscore; other columns pass through.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))
    links, component, kept = fresh(vectors.columns, "n_links", "component_id", "kept")
    key, good = fresh([*vectors.columns, links, component, kept], "vector_key", "vector_good")
    # Equal vectors have equal texts; -0.0 and 0.0 differ, and then meet in the same cells.
    rows = vectors.withColumns({good: usable, key: F.when(usable, F.sha2(F.to_json(v), 256))})
    distinct = (
        rows.filter(good)
        .groupBy(F.col(key).alias("key"))
        .agg(F.min(f"`{id_column}`").alias("least"), F.count(F.lit(1)).alias("copies"), F.first(v).alias("vector"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = materialise(distinct, "vectors").df

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                x = flat[starts[rows][:, None] + np.arange(size)]
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                for at in range(0, len(rows), 2048):
                    part = slice(at, at + 2048)
                    names = cells(x[part], lattice)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("node").take(pa.array(rows[part])),
                            batch.column("copies").take(pa.array(rows[part])),
                            pa.array([r.tobytes() for r in x[part]], pa.binary()),
                            pa.array([r.tobytes() for r in names], pa.binary()),
                            pa.array(list(names.reshape(len(names), -1)), pa.list_(pa.int64())),
                        ],
                        names=["node", "copies", "unit", "codes", "cells"],
                    )

    schema = "node long, copies long, unit binary, codes binary, cells array<long>"
    coded = materialise(nodes.select("node", "copies", "vector").mapInArrow(hashed, schema), "lattice").df
    wide = 1 + lattice.probes
    met = coded.select("node", F.posexplode("cells").alias("place", "cell")).select(
        "node",
        "cell",
        F.floor(F.col("place") / wide).cast("long").alias("lattice_table"),
        (F.col("place") % wide == 0).alias("home"),
    )
    # Only cells in which somebody lives and somebody else looks are of use.
    used = met.groupBy("cell").agg(
        F.max(F.col("home").cast("int")).alias("lived"), F.min("node").alias("low"), F.max("node").alias("high")
    )
    used = used.filter("lived = 1 AND low < high").select("cell")
    dealt = block_pairs(met.join(used, "cell"), ["cell", "lattice_table"], "node", lattice.block)
    dealt = dealt.join(coded.select("node", "copies", "unit", "codes"), "node")
    found = map_runs(
        dealt,
        ["cell", "block_low", "block_high"],
        ["node"],
        lambda table: _compare(table, threshold, lattice),
        "node long, other long, linked long",
    )
    found = materialise(found, "vector-links").df
    counts = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    groups = components(found.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = (
        nodes.select("key", "node", "least", "copies")
        .join(counts, "node", "left")
        .join(groups, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = named.groupBy("component").agg(F.min("least").alias("smallest"))
    named = named.join(least, "component").select(
        F.col("key").alias(key), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias(links), F.col("smallest").alias(component)
    )
    own = F.col(f"`{id_column}`")
    out = rows.join(named, key, "left").withColumns(
        {
            links: F.coalesce(links, F.lit(0).cast("long")),
            component: F.when(F.col(good), F.col(component)).otherwise(own),
        }
    )
    return out.withColumn(kept, own.eqNullSafe(F.col(component))).drop(key, good)


def _compare(table: pa.Table, threshold: float, lattice: Lattice) -> Iterator[pa.RecordBatch]:
    """Counts and spanning links of the pairs of one cell, or of two blocks of it."""
    node = numbers(table, "node")
    home = numbers(table, "home").astype(bool)
    own = numbers(table, "block_own")
    unit = table.column("unit").to_pylist()
    size = len(unit[0])
    if any(len(u) != size for u in unit):  # two lengths share a cell name by chance only
        same = [i for i, u in enumerate(unit) if len(u) == size]
        rest = [i for i, u in enumerate(unit) if len(u) != size]
        yield from _compare(table.take(same), threshold, lattice)
        yield from _compare(table.take(rest), threshold, lattice)
        return
    x = matrix(table, "unit", size // 8, "<f8")
    a, b = np.nonzero(np.triu(x @ x.T >= threshold, 1))
    keep = (home[a] | home[b]) & (node[a] != node[b])
    low, high = numbers(table, "block_low")[0], numbers(table, "block_high")[0]
    if low != high:
        keep &= own[a] != own[b]
    a, b = a[keep], b[keep]
    if not len(a):
        return
    codes = matrix(table, "codes", lattice.tables * (1 + lattice.probes), "<i8").reshape(len(node), lattice.tables, -1)
    here = int(numbers(table, "lattice_table")[0])
    cell = numbers(table, "cell")[0]
    linked = np.zeros(len(node), np.int64)
    copies = numbers(table, "copies")
    for at in range(0, len(a), 1 << 16):
        p, q = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
        first = _first_meeting(codes, p, q, here, cell)
        np.add.at(linked, p[first], copies[q[first]])
        np.add.at(linked, q[first], copies[p[first]])
    label = np.arange(len(node))
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        if (label == before).all():
            break
    rows = np.flatnonzero((linked > 0) | (label != np.arange(len(node))))
    other = pa.array(node[label[rows]], mask=label[rows] == rows)
    yield pa.RecordBatch.from_arrays([pa.array(node[rows]), other, pa.array(linked[rows])], names=["node", "other", "linked"])


def _first_meeting(codes: np.ndarray, p: np.ndarray, q: np.ndarray, table: int, cell: int) -> np.ndarray:
    """Whether this cell is where each pair is counted: the least cell of the first table in which they meet."""
    ours = np.ones(len(p), bool)
    for t in range(table + 1):
        x, y = codes[p, t], codes[q, t]
        together = x[:, 0] == y[:, 0]
        x_lives = (y[:, 1:] == x[:, :1]).any(axis=1)
        y_lives = (x[:, 1:] == y[:, :1]).any(axis=1)
        if t < table:
            ours &= ~(together | x_lives | y_lives)
        else:
            highest = np.int64(np.iinfo(np.int64).max)
            places = np.minimum(
                np.where(together | x_lives, x[:, 0], highest), np.where(together | y_lives, y[:, 0], highest)
            )
            ours &= places == cell
    return ours

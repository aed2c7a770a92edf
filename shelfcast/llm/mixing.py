"""Mixing sources to target weights by Pfair scheduling of blocks.

A source's documents form blocks of equal count. Let a source be given blocks at its weight without breaks; used-up
sources leave and the rest go on in proportion. Its i-th block (from 0) is released at the slot in which that flow reaches i
and due before the flow has passed i + 1; of the released blocks the one due earliest takes the slot. On one
line of slots that keeps every deadline, so after any number of slots a source has had what the flow gave it (w*t while all
sources last), give or take less than one block. Weights and flow are exact integers, at any length of the stream.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.queues import fresh, queue_totals, source_names, with_offsets, with_queue
from shelfcast.session import materialise

#: Slots between two kept states of the schedule (more where there are many queues), from which tasks plan on.
PERIOD = 4096


class Flow:
    """Blocks that flow at their weights, in exact integers; a used-up queue leaves and the rest share its slots.

    Time by weight, v, runs alike for all queues: queue q has had min(blocks, weight * v) and leaves at v = blocks / weight.
    """

    def __init__(self, blocks: list[int], weights: list[float]):
        ratio = [w.as_integer_ratio() if n else (0, 1) for n, w in zip(blocks, weights, strict=True)]
        scale = max((d for _, d in ratio), default=1)  # all are powers of two
        self.blocks, self.weights = list(blocks), [n * (scale // d) for n, d in ratio]
        leave = sorted((q for q, n in enumerate(blocks) if n), key=lambda q: blocks[q] / self.weights[q])
        # What leaves in one place of the float order may be a hair out of the exact one: settled by exact comparison.
        for k in range(1, len(leave)):
            while k and blocks[leave[k]] * self.weights[leave[k - 1]] < blocks[leave[k - 1]] * self.weights[leave[k]]:
                leave[k - 1], leave[k] = leave[k], leave[k - 1]
                k -= 1
        self.leave, self.total = leave, sum(blocks)
        self.gone, self.rate = [0], [sum(self.weights)]  # before the k-th has left: blocks of the gone, weight of the rest
        for q in leave[:-1]:
            self.gone.append(self.gone[-1] + blocks[q])
            self.rate.append(self.rate[-1] - self.weights[q])
        self.at_v = [blocks[q] / self.weights[q] for q in leave]
        self.at_slot = [g + blocks[q] * r / self.weights[q] for q, g, r in zip(leave, self.gone, self.rate, strict=False)]

    def window(self, queue: int, block: int) -> tuple[int, int]:
        """Release slot and deadline of a block: it has to run in release <= slot < deadline."""
        w = self.weights[queue]
        k = self._phase(block, w)
        release = self.gone[k] + block * self.rate[k] // w
        k = self._phase(block + 1, w)
        return release, self.gone[k] - (-(block + 1) * self.rate[k] // w)

    def _phase(self, n: int, w: int) -> int:
        """How many queues have left before v = n / w."""
        last = len(self.leave) - 1
        k = min(bisect_right(self.at_v, n / w), last)
        while k and n * self.weights[self.leave[k - 1]] < self.blocks[self.leave[k - 1]] * w:
            k -= 1
        while k < last and n * self.weights[self.leave[k]] > self.blocks[self.leave[k]] * w:
            k += 1
        return k

    def whole(self, slot: int) -> list[int]:
        """Whole blocks of each queue that have flowed before ``slot``."""
        last = len(self.leave) - 1
        k = min(bisect_right(self.at_slot, slot), last)
        ends = lambda j: (self.blocks[self.leave[j]] * self.rate[j], self.weights[self.leave[j]])
        while k and (slot - self.gone[k - 1]) * ends(k - 1)[1] < ends(k - 1)[0]:
            k -= 1
        while k < last and (slot - self.gone[k]) * ends(k)[1] > ends(k)[0]:
            k += 1
        passed, rate = slot - self.gone[k], self.rate[k]
        return [min(n, w * passed // rate) for n, w in zip(self.blocks, self.weights, strict=True)]

    def serve(self, given: list[int], slot: int) -> Iterator[int]:
        """The queue of each slot from ``slot`` on, where queues have had ``given`` blocks before: earliest deadline first."""
        ready: list[tuple[int, int, int]] = []
        waiting = [(*self.window(q, i), q, i) for q, (i, n) in enumerate(zip(given, self.blocks, strict=True)) if i < n]
        heapq.heapify(waiting)
        while waiting or ready:
            while waiting and waiting[0][0] <= slot:
                _, deadline, q, i = heapq.heappop(waiting)
                heapq.heappush(ready, (deadline, q, i))
            deadline, q, i = heapq.heappop(ready)
            if slot >= deadline:
                raise AssertionError("a deadline was missed")
            yield q
            slot += 1
            if i + 1 < self.blocks[q]:
                release, deadline = self.window(q, i + 1)
                heapq.heappush(waiting, (release, deadline, q, i + 1))


class Timetable:
    """Slot, release and deadline of every block.

    The driver serves all slots once and keeps the state before every ``period``-th: one bit per queue, whether it has had
    the block that the flow is in. Tasks serve again the periods that their rows fall in.
    """

    def __init__(self, blocks: list[int], weights: list[float], period: int = PERIOD):
        if any(n and not w > 0 for n, w in zip(blocks, weights, strict=True)):
            raise ValueError("a queue with blocks needs a positive weight")
        self.flow = Flow(blocks, [float(w) for w in weights])
        self.period = max(period, 16 * len(blocks))
        self.states: list[bytes] = []
        given, served = [0] * len(blocks), self.flow.serve([0] * len(blocks), 0) if any(blocks) else iter(())
        for slot, q in enumerate(served):
            if slot % self.period == 0:
                ahead = np.array(given, np.int64) - np.array(self.flow.whole(slot), np.int64)
                self.states.append(np.packbits(ahead.astype(bool)).tobytes())
            given[q] += 1
        self._make_caches()

    def _make_caches(self) -> None:
        self._given, self._slots = lru_cache(1024)(self._find_given), lru_cache(256)(self._find_slots)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_given", "_slots")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._make_caches()

    def _find_given(self, k: int) -> np.ndarray:
        """Blocks that each queue has had before period ``k``."""
        n = len(self.flow.blocks)
        if k >= len(self.states):
            return np.array(self.flow.blocks, np.int64)
        ahead = np.unpackbits(np.frombuffer(self.states[k], np.uint8), count=n)
        return np.array(self.flow.whole(k * self.period), np.int64) + ahead

    def _find_slots(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The slots of period ``k`` by queue, and where each queue's begin."""
        size = min(self.period, self.flow.total - k * self.period)
        served = self.flow.serve(self._given(k).tolist(), k * self.period)
        queues = np.fromiter((q for q, _ in zip(served, range(size))), np.int64, size)
        begins = np.searchsorted(np.sort(queues), np.arange(len(self.flow.blocks)))
        return np.argsort(queues, kind="stable"), begins

    def _slot(self, queue: int, block: int, release: int, deadline: int) -> int:
        low, high = release // self.period, (deadline - 1) // self.period
        while low < high:  # the last period before which the queue has had at most this many
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self._given(middle)[queue] <= block else (low, middle - 1)
        slots, begins = self._slots(low)
        return low * self.period + int(slots[begins[queue] + block - self._given(low)[queue]])

    def find(self, queue: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(release, deadline, slot) of blocks."""
        pairs, which = np.unique(np.stack([queue, block]), axis=1, return_inverse=True)
        found = np.zeros((3, pairs.shape[1]), np.int64)
        for i, (q, b) in enumerate(pairs.T.tolist()):
            release, deadline = self.flow.window(q, b)
            found[:, i] = release, deadline, self._slot(q, b, release, deadline)
        return tuple(found[:, which.ravel()])


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    block_docs: int = 16,
    source: str = "source",
    period: int = PERIOD,
    temperature: float = 1.0,
) -> tuple[DataFrame, dict[str, str]]:
    """Every row once, with its place in the mixed stream; and the names of the added columns.

    Adds queue (name; null for the shared one), block, block_offset, release, deadline and slot: the stream is
    the order of (slot, block_offset). With weights, the sources that have none share a queue with null and empty ones, with the
    weight under ``""`` (else the mean). Without weights every source has a queue, at any number of them, and its weight is its number of rows to the power of
    ``temperature``: at 1 all sources last to the end of the stream, below 1 large sources are held back. A used-up source
    leaves and the rest go on in proportion: no row is dropped or repeated. The last block of a queue can be short.

    Null or empty texts are rows like others; repeated rows are placed each by itself; an empty
    table gives an empty table; an added name that is taken gets an underscore.
    """
    if weights is not None:
        names = sorted(n for n in weights if n != "")
    else:
        names = source_names(docs, source)
    extra = fresh(docs.columns, "queue", "block", "block_offset", "release", "deadline", "slot")
    _, block, offset, release, deadline, slot = extra
    queue, part, before = fresh([*docs.columns, *extra], "queue_no", "part_no", "before_in_part")
    (base,) = fresh([*docs.columns, *extra, queue, part, before], "before_part")
    named = with_queue(docs, names, source, queue).withColumn(part, F.spark_partition_id())
    queues = len(names) + 1

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(queues, np.int64)
        for batch in batches:
            q = batch.column(batch.num_columns - 2).to_numpy()
            seen = np.zeros(len(q), np.int64)
            for x in np.unique(q):
                own = q == x
                seen[own] = held[x] + np.arange(own.sum())
                held[x] += own.sum()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seen)], names=[*batch.schema.names, before])

    counted = T.StructType([*named.schema.fields, T.StructField(before, T.LongType())])
    placed = materialise(named.mapInArrow(number, counted), "mixing-rows").df
    rows = queue_totals(placed, queue, F.lit(1), queues)
    if weights is None:
        wanted = [float(n) ** temperature if n else 0.0 for n in rows]
    else:
        rest = weights.get("", sum(weights.values()) / max(1, len(weights)) or 1.0)
        wanted = [*(float(weights[n]) for n in names), float(rest)]
    if any(n and w <= 0 for n, w in zip(rows, wanted, strict=True)):
        raise ValueError("a source that has rows needs a positive weight")
    table = Timetable([-(-n // block_docs) for n in rows], wanted, period)
    ready = with_offsets(placed, queue, part, F.lit(1), base)
    columns = list(docs.columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            q = batch.column(at[queue]).to_numpy().astype(np.int64)
            rank = batch.column(at[before]).to_numpy() + batch.column(at[base]).to_numpy()
            which = rank // block_docs
            found = table.find(q, which)
            kept = [batch.column(at[c]) for c in columns]
            label = pa.array([*names, None], pa.string()).take(pa.array(q))
            added = [label, pa.array(which), pa.array(rank % block_docs), *map(pa.array, found)]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=[*columns, *extra])

    schema = T.StructType([
        *docs.schema.fields,
        T.StructField(extra[0], T.StringType()),
        *(T.StructField(n, T.LongType()) for n in (block, offset, release, deadline, slot)),
    ])
    keys = ["queue", "block", "block_offset", "release", "deadline", "slot"]
    return ready.mapInArrow(place, schema), dict(zip(keys, extra, strict=True))


def in_order(mixed: DataFrame, names: dict[str, str]) -> DataFrame:
    """The rows written in the order of the stream, without the added columns."""
    return mixed.orderBy(names["slot"], names["block_offset"]).drop(*names.values())

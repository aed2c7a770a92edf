"""Mixture-controlled packing: deficit round-robin over source queues into token windows.

Every document is tokenised once. Each source is a queue of tokens. In each round the
queues are visited in order, and each is given the tokens of its target share that are due by
then; the fraction of a token that is due but not given is its deficit, carried into the next round.
A round is one window. Since credit grows linearly, the deficit before any round
is known in closed form, so each task cuts its own documents without
knowing what other tasks do, and deficits carry across windows and across partitions alike.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache
from math import gcd

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.queues import fresh, queue_totals, source_names, with_offsets, with_queue
from shelfcast.llm.text import slices
from shelfcast.session import materialise

#: Shares are whole multiples of this, so that deficits are exact integers at any length.
UNITS = 1 << 24
#: In every task one text in so many, the first included, is also encoded by the library and compared whole.
CHECK_EVERY = 200


class Tokens:
    """Ids of a byte-level BPE file of the tokenizers library, as its encoder gives them with ``add_special_tokens=False``.

    The merges of the file are run by tiktoken, several times faster; added tokens of the file (such as an end mark inside a text) stand for
    themselves there as they do in the library. Texts that tiktoken's splitter cannot take, such as a million blanks in a row, are
    encoded by the library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self._library.get_added_tokens_decoder().items()}
        letters = {c: b for b, c in _byte_letters().items()}
        ranks = {
            bytes(letters[c] for c in word): i for word, i in self._library.get_vocab().items() if word not in added
        }
        self._fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def library_ids(self, text: str) -> np.ndarray:
        return np.array([*self._library.encode(text, add_special_tokens=False).ids, 0], dtype=np.uint32)

    def ids(self, text: str) -> np.ndarray:
        """Ids of the text, then id 0."""
        try:
            return np.append(self._fast.encode_to_numpy(text, allowed_special="all"), np.uint32(0))
        except ValueError:
            return self.library_ids(text)

    def checked(self, text: str) -> np.ndarray:
        """As ``ids``, compared with the library's own encoder."""
        ids = self.ids(text)
        if not np.array_equal(self.library_ids(text), ids):
            raise ValueError("the tokenizer file is not the byte-level BPE that is expected")
        return ids


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself if visible, else one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


@dataclass(frozen=True)
class Phase:
    """Rounds during which the same queues take part; the last round gives what a queue still has."""

    start: int
    rounds: int
    low: np.ndarray
    high: np.ndarray
    base: np.ndarray
    last: np.ndarray


class Schedule:
    """Where each token of each queue goes: a list of phases, at most one per queue."""

    def __init__(self, totals: list[int], weights: list[float], window: int):
        if any(w < 0 for w in weights) or any(t and not w for t, w in zip(totals, weights, strict=True)):
            raise ValueError("a queue that holds tokens needs a positive target")
        self.window, self.phases = window, []
        left, given, at = np.array(totals, np.int64), np.zeros(len(totals), np.int64), 0
        weights = np.array(weights, np.float64)
        while left.any():
            share = self._shares(np.where(left > 0, weights, 0.0))
            high = np.cumsum(share)
            low = high - share
            due = lambda r: self._due(high, np.int64(r)) - self._due(low, np.int64(r))  # noqa: B023, E731
            rounds = self._fits(lambda r: bool((due(r) <= left).all()), int(left.sum()) // window + 1)  # noqa: B023
            taken = due(rounds)
            last = np.minimum(left - taken, due(rounds + 1) - taken)
            self.phases.append(Phase(at, rounds, low, high, given.copy(), last))
            at += rounds * window + int(last.sum())
            given, left = given + taken + last, left - taken - last
        self.total = at

    @staticmethod
    def _shares(weights: np.ndarray) -> np.ndarray:
        """Whole shares that add up to UNITS; at least one for each queue with a weight."""
        exact = weights / weights.sum() * UNITS
        share = np.maximum(np.floor(exact).astype(np.int64), weights > 0)
        rest = UNITS - int(share.sum())
        share[np.argsort(share - exact, kind="stable")[: max(rest, 0)]] += 1  # largest remainders first
        share[int(np.argmax(weights))] += min(rest, 0)
        return share

    @staticmethod
    def _fits(holds, most: int) -> int:
        low, high = 0, most
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if holds(middle) else (low, middle - 1)
        return low

    def _due(self, bound: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        common = gcd(self.window, UNITS)  # divided out first, so that 64 bits are enough
        return rounds * bound * (self.window // common) // (UNITS // common)

    def pieces(self, queue: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(row, start in the row, length, place in the packed stream) of every piece, rows in order.

        ``start`` is the place of a row's first token in its queue.
        """
        for phase in self.phases:
            given = self._due(phase.high[queue], np.int64(phase.rounds)) - self._due(phase.low[queue], np.int64(phase.rounds))
            active = phase.high[queue] > phase.low[queue]
            base = phase.base[queue]
            stop = np.where(active, base + given + phase.last[queue], base)
            a, b = np.maximum(start, base), np.minimum(start + size, stop)
            rows = np.flatnonzero(active & (a < b))
            if not len(rows):
                continue
            low, high, base = phase.low[queue[rows]], phase.high[queue[rows]], base[rows]
            first = self._round(low, high, a[rows] - base, phase.rounds)
            final = self._round(low, high, b[rows] - base - 1, phase.rounds)
            steps = final - first + 1
            done = 0
            while done < len(rows):  # about a million rounds at a time, or one row
                upto = max(done + 1, int(np.searchsorted(np.cumsum(steps[done:]), 1 << 20, side="right")) + done)
                k = np.repeat(np.arange(done, upto), steps[done:upto])
                r = first[k] + np.arange(len(k)) - np.repeat(np.cumsum(steps[done:upto]) - steps[done:upto], steps[done:upto])
                lo, hi = self._due(low[k], r), self._due(high[k], r)
                held = hi - lo
                short = r == phase.rounds
                q = queue[rows[k]]
                ahead = np.cumsum(phase.last) - phase.last
                ends = np.where(short, phase.last[q], self._due(high[k], r + 1) - self._due(low[k], r + 1) - held)
                before = np.where(short, ahead[q], self._due(low[k], r + 1) - lo)
                begin, end = np.maximum(a[rows[k]], base[k] + held), np.minimum(b[rows[k]], base[k] + held + ends)
                place = phase.start + r * self.window + before + begin - base[k] - held
                keep = begin < end
                yield rows[k][keep], (begin - start[rows[k]])[keep], (end - begin)[keep], place[keep]
                done = upto

    def _round(self, low: np.ndarray, high: np.ndarray, j: np.ndarray, rounds: int) -> np.ndarray:
        """The round that gives token ``j`` of a phase: the last one before which at most j were given."""
        a, b = np.zeros(len(j), np.int64), np.full(len(j), rounds, np.int64)
        while (a < b).any():
            middle = (a + b + 1) // 2
            fits = self._due(high, middle) - self._due(low, middle) <= j
            a, b = np.where(fits, middle, a), np.where(fits, b, middle - 1)
        return a


class Groups:
    """A schedule of any number of queues.

    One round of Schedule has to give each queue a token at least, else what is due would go back by one at times. So queues of
    a smaller share are paired, level by level, until the pairs are large enough. A pair has the tokens and the weight
    of both and takes turns token by token, so each keeps its own proportion. Paired are neighbours in the order in
    which queues are used up, so that the pair's weight holds for both nearly to the end.
    """

    def __init__(self, totals: list[int], weights: list[float], window: int):
        if any(w < 0 for w in weights) or any(t and not w for t, w in zip(totals, weights, strict=True)):
            raise ValueError("a queue that holds tokens needs a positive target")
        total, weight = np.array(totals, np.int64), np.array(weights, np.float64)
        self.levels: list[tuple[np.ndarray, np.ndarray, list[Schedule | None]]] = []
        while True:
            weight = np.where(total > 0, weight, 0.0)
            tiny = (total > 0) & (weight * window < 1.01 * weight.sum())
            lasts = np.divide(total, weight, out=np.zeros(len(total)), where=weight > 0)
            order = [int(q) for q in np.argsort(lasts, kind="stable") if total[q]]
            if len(order) < 2 or not tiny.any():
                break
            sets, at = [], 0
            while at < len(order):
                sets.append(order[at : at + (2 if tiny[order[at]] else 1)])
                at += len(sets[-1])
            if len(sets[-1]) == 1 and tiny[sets[-1][0]] and len(sets[-2]) == 1:
                sets[-2:] = [sets[-2] + sets[-1]]
            above, member = np.zeros(len(total), np.int64), np.zeros(len(total), np.int64)
            for g, own in enumerate(sets):
                above[own], member[own] = g, range(len(own))
            pairs = [Schedule(total[own].tolist(), weight[own].tolist(), 1) if len(own) > 1 else None for own in sets]
            self.levels.append((above, member, pairs))
            total, weight = np.array([total[own].sum() for own in sets]), np.array([weight[own].sum() for own in sets])
        self.top = Schedule(total.tolist(), weight.tolist(), window)

    def pieces(self, queue: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(row, start in the row, length, place in the packed stream) of every piece."""
        some = np.flatnonzero(size > 0)
        row, begin, queue, start, size = some, np.zeros(len(some), np.int64), queue[some], start[some], size[some]
        for above, member, pairs in self.levels:
            order = np.argsort(above[queue], kind="stable")
            groups, firsts = np.unique(above[queue][order], return_index=True)
            found = [[row[:0], begin[:0], size[:0], start[:0], queue[:0]]]
            for g, own in zip(groups.tolist(), np.split(order, firsts[1:]), strict=True):
                if pairs[g] is None:
                    found.append([row[own], begin[own], size[own], start[own], np.full(len(own), g)])
                    continue
                for r, b, n, at in pairs[g].pieces(member[queue[own]], start[own], size[own]):
                    found.append([row[own[r]], begin[own[r]] + b, n, at, np.full(len(r), g)])
            row, begin, size, start, queue = (np.concatenate(x) for x in zip(*found, strict=True))
        for r, b, n, at in self.top.pieces(queue, start, size):
            yield row[r], begin[r] + b, n, at


def pack(
    docs: DataFrame,
    targets: Mapping[str, float] | None = None,
    window: int = 1024,
    tokenizer: str | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    position: str | None = None,
) -> DataFrame:
    """Pieces of all documents in windows of ``window`` tokens, mixed to target shares.

    ``targets`` gives a weight per source; sources that it does not name and null share one
    queue with the weight under the key ``""`` (their mean weight if there is none). Without targets
    every source's share is its share of all tokens, so all queues last to the end and
    every window has the target mixture. When a queue is used up, the rest go on in proportion. Only the last window
    can be short. Every source has its own queue, at any number of them: those of a very small share are scheduled in pairs (see Groups).

    Returns one row per piece: ``doc_id, start, length, ids`` (little-endian unsigned 32-bit),
    ``doc_tokens, sequence_id, offset, source_queue``. A null or empty text is the closing id 0
    alone; a null source is the shared queue; repeated rows are packed each by itself (documents are told apart by
    their rows, not their ids); other columns are left out; an empty table gives none.
    A text of any length is cut where windows end.

    A queue's documents come in the order of ``position``, a column of distinct numbers that rise within a split of the input; without
    it in the order in which they are read.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    names = sorted(n for n in targets if n != "") if targets is not None else source_names(docs, source)
    queues = len(names) + 1
    narrow = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
        F.col(f"`{source}`").alias("source"),
        (F.spark_partition_id() if position is None else F.col(f"`{position}`")).cast("long").alias("part"),
    )
    narrow = with_queue(narrow, names, "source", "queue").drop("source")
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen, run, last = np.zeros(queues, np.int64), 0, None, None
        for batch in runs(slices(batches, "text")):
            tokens = _tokens(path)
            texts = [x or "" for x in batch.column("text").to_pylist()]
            ids = [tokens.ids(x) if (seen + k) % CHECK_EVERY else tokens.checked(x) for k, x in enumerate(texts)]
            seen += len(texts)
            size = np.array([len(x) for x in ids], dtype=np.int64)
            queue, at = batch.column("queue").to_numpy(), batch.column("part").to_numpy()
            if position is not None and (last is None or at[0] != last + 1):  # another stretch of the input begins
                held, run = np.zeros(queues, np.int64), int(at[0])
            run, last = at[0] if position is None else run, at[-1]
            before = np.zeros(len(ids), np.int64)
            for q in np.unique(queue):
                own = queue == q
                before[own] = held[q] + np.cumsum(size[own]) - size[own]
                held[q] += size[own].sum()
            small = [x.astype("<u2" if x.max() < 1 << 16 else "<u4").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("queue"), pa.array(np.full(len(ids), run, np.int64)), pa.array(before), pa.array(size), pa.array(small, pa.binary())],
                names=["doc_id", "queue", "part", "before_in_part", "size", "ids"],
            )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The batches, cut where positions do not go on one by one."""
        for batch in batches:
            at = batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(at) != 1) + 1).tolist(), len(at)] if position is not None else [0, len(at)]
            yield from (batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True))

    schema = f"doc_id {id_type}, queue int, part long, before_in_part long, size long, ids binary"
    placed = materialise(narrow.mapInArrow(encode, schema), "packing-tokens").df
    totals = queue_totals(placed, "queue", F.col("size"), queues)
    if targets is None:
        weights = [float(t) for t in totals]
    else:
        rest = targets.get("", sum(targets.values()) / max(1, len(targets)) or 1.0)
        weights = [float(targets[n]) for n in names] + [float(rest)]
    schedule = Groups(totals, weights, window)
    ready = with_offsets(placed, "queue", "part", F.col("size"), "before_part")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids", 1 << 20):
            queue = batch.column("queue").to_numpy().astype(np.int64)
            start = batch.column("before_part").to_numpy() + batch.column("before_in_part").to_numpy()
            size = batch.column("size").to_numpy()
            raw = [as32(x, n) for x, n in zip(batch.column("ids").to_pylist(), size.tolist(), strict=True)]
            for row, begin, length, place in schedule.pieces(queue, start, size):
                yield from windows(batch, raw, size, queue, row, begin, length, place)

    def windows(batch, raw, size, queue, row, begin, length, place):
        room = window - place % window
        over = length > room  # a piece is at most a window long, so it crosses at most one end
        row = np.concatenate([row, row[over]])
        begin, place, length = (
            np.concatenate([begin, begin[over] + room[over]]),
            np.concatenate([place, place[over] + room[over]]),
            np.concatenate([np.minimum(length, room), length[over] - room[over]]),
        )
        for at in range(0, len(row), 1 << 15):
            k = slice(at, at + (1 << 15))
            cuts = [raw[r][4 * s : 4 * (s + n)] for r, s, n in zip(row[k].tolist(), begin[k].tolist(), length[k].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row[k])), pa.array(begin[k]), pa.array(length[k]), pa.array(cuts, pa.binary()),
                 pa.array(size[row[k]]), pa.array(place[k] // window), pa.array(place[k] % window), pa.array(queue[row[k]].astype(np.int32))],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "source_queue"],
            )

    pieces = f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, source_queue int"
    return ready.mapInArrow(cut, pieces)


def as32(ids: bytes, size: int) -> bytes:
    return ids if len(ids) == 4 * size else np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes()


def with_checksum(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of the ids."""
    (name,) = fresh(pieces.columns, "ids_crc32")
    return pieces.withColumn(name, F.crc32("ids")).drop("ids")


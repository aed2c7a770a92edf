"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + sum over i < j of <v_i, v_j> x_i x_j). The pair sum is taken in linear time as half of
(sum v_i x_i)^2 - sum v_i^2 x_i^2, dimension by dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.queues import fresh
from shelfcast.llm.text import Texts, Words, by_text, covered, lines, repeats, slices

STATISTICS = (
    "log_words", "word_chars", "distinct_words", "repeated_windows", "doubled_words", "symbols", "full_stops",
    "exclamations", "pipes", "capitals", "digits", "line_words", "repeated_lines", "log_n_chars",
)


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows that the model is fitted on; scoring covers all rows."""

    sample_rows: int = 8000
    bits: int = 14
    factors: int = 8
    rounds: int = 8
    batch: int = 128
    step: float = 0.05
    weight_decay: float = 1e-4
    seed: int = 3


def _byte_flags(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_FLAGS = {
    "symbols": _byte_flags(b"#*$%&|<>@^~="),
    "full_stops": _byte_flags(b"."),
    "exclamations": _byte_flags(b"!"),
    "pipes": _byte_flags(b"|"),
    "capitals": _byte_flags(bytes(range(65, 91))),
    "digits": _byte_flags(bytes(range(48, 58))),
}


def features(texts: Texts, n_chars: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bounds, bucket, value) of the hashed words, each text's values of length one, and the statistics."""
    words = Words(texts)
    rows = texts.rows
    bucket = (words.hash() >> np.uint64(64 - bits)).astype(np.int64)
    key = np.sort(words.doc * (1 << bits) + bucket)
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(head, len(key)))
    key = key[head]
    doc, bucket = key >> bits, key & ((1 << bits) - 1)
    bounds = np.searchsorted(doc, np.arange(rows + 1))
    value = np.log1p(times)
    length = np.sqrt(np.bincount(doc, weights=value * value, minlength=rows))
    value = (value / length[doc]).astype(np.float32)

    n = np.maximum(words.counts, 1)
    size = np.maximum(np.diff(texts.offsets), 1)
    stats = {"log_words": np.log1p(words.counts), "word_chars": by_text(words.chars(), words.first) / n, "distinct_words": np.diff(bounds) / n}
    at, gram = words.grams(3)
    again, later = repeats(gram, words.doc[at])
    stats["repeated_windows"] = by_text(covered(len(words), at[later], 3), words.first) / n
    same = np.zeros(len(words), bool)
    h = words.hash()
    same[1:] = (h[1:] == h[:-1]) & (words.doc[1:] == words.doc[:-1])
    stats["doubled_words"] = by_text(same, words.first) / n
    for name, flags in _FLAGS.items():
        found = texts.count(flags[texts.bytes])
        stats[name] = found / (size if name in ("capitals", "digits") else n)
    begins, ends, whose = lines(texts)
    filled = ends > begins
    begins, ends, whose = begins[filled], ends[filled], whose[filled]
    per_text = np.maximum(np.bincount(whose, minlength=rows), 1)
    stats["line_words"] = np.log1p(words.counts / per_text)
    _, later = repeats(texts.spans_hash(begins, ends), whose)
    stats["repeated_lines"] = np.bincount(whose[later], minlength=rows) / per_text
    stats["log_n_chars"] = np.log1p(np.maximum(n_chars, 0))
    return bounds, bucket, value, np.stack([stats[s] for s in STATISTICS], axis=1).astype(np.float32)


@dataclass
class FactorisationMachine:
    """Weights of the buckets, then of the statistics; the statistics' mean and spread in the sample."""

    bits: int
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    @classmethod
    def empty(cls, settings: Settings) -> FactorisationMachine:
        n = (1 << settings.bits) + len(STATISTICS)
        start = np.random.default_rng(settings.seed).normal(0, 0.02, (n, settings.factors)).astype(np.float32)
        k = len(STATISTICS)
        return cls(settings.bits, 0.0, np.zeros(n, np.float32), start, np.zeros(k, np.float32), np.ones(k, np.float32))

    def scaled(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.spread, -4, 4) / 4

    def _sums(self, bounds: np.ndarray, bucket: np.ndarray, value: np.ndarray, stats: np.ndarray):
        """Linear sums, factor sums and sums of squares over buckets and statistics."""
        rows, words = len(bounds) - 1, len(self.linear) - len(STATISTICS)
        v, u = self.factors[bucket] * value[:, None], self.factors[words:]
        totals = np.zeros((rows, 1 + 2 * v.shape[1]), np.float32)
        some = np.flatnonzero(bounds[1:] > bounds[:-1])
        if len(some):
            each = np.concatenate([(self.linear[bucket] * value)[:, None], v, v * v], axis=1)
            totals[some] = np.add.reduceat(each, bounds[some], axis=0)
        k = v.shape[1]
        line = totals[:, 0] + stats @ self.linear[words:]
        first = totals[:, 1 : 1 + k] + stats @ u
        second = totals[:, 1 + k :] + (stats * stats) @ (u * u)
        return line, first, second

    def score(self, bounds: np.ndarray, bucket: np.ndarray, value: np.ndarray, stats: np.ndarray) -> np.ndarray:
        line, first, second = self._sums(bounds, bucket, value, self.scaled(stats))
        margin = self.bias + line + 0.5 * (first * first - second).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin.astype(np.float64), -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], stats: np.ndarray, labels: np.ndarray, settings: Settings) -> None:
        """Adaptive gradient steps over mini-batches of (buckets, values), in an order fixed by the seed."""
        if not len(labels):
            return
        self.mean, self.spread = stats.mean(axis=0), stats.std(axis=0) + 1e-6
        scaled = self.scaled(stats)
        share = (labels.sum() + 1) / (len(labels) + 2)
        self.bias = float(np.log(share / (1 - share)))
        words = len(self.linear) - len(STATISTICS)
        seen = [np.full_like(self.linear, 1e-6), np.full_like(self.factors, 1e-6), np.full(1, 1e-6)]
        rng = np.random.default_rng(settings.seed)

        def step(values: np.ndarray, memory: np.ndarray, grad: np.ndarray) -> None:
            memory += grad * grad
            values -= settings.step * grad / np.sqrt(memory)

        for _ in range(settings.rounds):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), settings.batch):
                own = order[at : at + settings.batch]
                sizes = np.array([len(rows[i][0]) for i in own])
                bounds = np.append(0, np.cumsum(sizes))
                bucket = np.concatenate([rows[i][0] for i in own]).astype(np.int64)
                value = np.concatenate([rows[i][1] for i in own])
                z = scaled[own]
                line, first, second = self._sums(bounds, bucket, value, z)
                margin = self.bias + line + 0.5 * (first * first - second).sum(axis=1)
                error = ((1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[own]) / len(own)).astype(np.float32)
                doc = np.repeat(np.arange(len(own)), sizes)
                pull = error[doc] * value
                touched, place = np.unique(bucket, return_inverse=True)
                grad = np.bincount(place, weights=pull, minlength=len(touched)).astype(np.float32)
                each = pull[:, None] * (first[doc] - self.factors[bucket] * value[:, None])
                by = np.argsort(place, kind="stable")
                each = np.add.reduceat(each[by], np.searchsorted(place[by], np.arange(len(touched))), axis=0) if len(touched) else each
                u = self.factors[words:]
                stat_grad = z.T @ error
                stat_each = (error[:, None] * z).T @ first - ((z * z).T @ error)[:, None] * u
                both = np.concatenate([touched, np.arange(words, words + len(STATISTICS))])
                for values, memory, g in (
                    (self.linear, seen[0], np.concatenate([grad, stat_grad]) + settings.weight_decay * self.linear[both]),
                    (self.factors, seen[1], np.concatenate([each, stat_each]) + settings.weight_decay * self.factors[both]),
                ):
                    v, m = values[both], memory[both]
                    step(v, m, g)
                    values[both], memory[both] = v, m
                bias, grad_bias = np.array([self.bias]), np.array([float(error.sum())])
                step(bias, seen[2], grad_bias)
                self.bias = float(bias[0])


def held_out(id_column: str, folds: int = 5) -> Column:
    """Whether a row is kept from learning: CRC-32 of the id's text is a multiple of ``folds`` (null: of the empty text)."""
    return F.crc32(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))) % folds == 0


def _featurised(docs: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            chars = batch.column("n_chars").fill_null(0).to_numpy()
            bounds, bucket, value, stats = features(Texts(batch.column("text")), chars, bits)
            parts = list(zip(bounds[:-1], bounds[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("quality"),
                    pa.array([bucket[a:b].astype("<i4").tobytes() for a, b in parts], pa.binary()),
                    pa.array([value[a:b].astype("<f4").tobytes() for a, b in parts], pa.binary()),
                    pa.array([s.astype("<f4").tobytes() for s in stats], pa.binary()),
                ],
                names=["quality", "buckets", "values", "stats"],
            )

    return docs.mapInArrow(run, "quality double, buckets binary, values binary, stats binary")


def train(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text: str = "text", n_chars: str = "n_chars"
) -> FactorisationMachine:
    """Fits the machine on at most ``sample_rows`` labelled documents that are not held out.

    The sample is the labelled ids with the smallest hashes, so it does not depend on the order of rows. Several labels of an id
    count as their majority (ties as 1), null labels as none; of several texts of an id the smallest is taken. Without any labelled
    document the machine scores a half.
    """
    ids = labels.select(F.col(f"`{id_column}`").alias("id"), F.col("quality").cast("double").alias("quality")).dropna()
    ids = ids.groupBy("id").agg(F.when(F.avg("quality") >= 0.5, 1.0).otherwise(0.0).alias("quality"))
    sample = ids.filter(~held_out("id")).orderBy(F.xxhash64("id"), "id").limit(settings.sample_rows)
    chars = F.col(f"`{n_chars}`").cast("long") if n_chars in docs.columns else F.lit(None).cast("long")
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), chars.alias("n_chars"))
    # At most sample_rows ids, so the broadcast is bounded by that parameter.
    rows = rows.join(F.broadcast(sample), "id").groupBy("id").agg(
        F.min("text").alias("text"), F.max("n_chars").alias("n_chars"), F.first("quality").alias("quality")
    )
    found = _featurised(rows, settings.bits).toArrow()
    buckets = [np.frombuffer(x, "<i4") for x in found.column("buckets").to_pylist()]
    values = [np.frombuffer(x, "<f4") for x in found.column("values").to_pylist()]
    stats = np.array([np.frombuffer(x, "<f4") for x in found.column("stats").to_pylist()], np.float32).reshape(-1, len(STATISTICS))
    quality = found.column("quality").to_numpy()
    machine = FactorisationMachine.empty(settings)
    order = sorted(range(len(quality)), key=lambda i: (stats[i].tobytes(), buckets[i].tobytes()))
    machine.fit([(buckets[i], values[i]) for i in order], stats[order], quality[order], settings)
    return machine


def score(docs: DataFrame, machine: FactorisationMachine, threshold: float = 0.3, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Every row of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    Only the text and n_chars are looked at. Null and empty texts have no words and a score like others; a null or absent
    n_chars counts as 0; long texts are used whole; repeated rows score alike; an empty table gives an empty one; other
    columns pass through; added names that are taken get an underscore. One pass, no shuffle.
    """
    score_name, predicted = fresh(docs.columns, "score", "predicted")
    columns = list(docs.columns)
    body, chars_at = columns.index(text), columns.index(n_chars) if n_chars in columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, columns[body]):
            chars = np.zeros(batch.num_rows)
            if chars_at is not None:
                chars = batch.column(chars_at).cast(pa.float64()).fill_null(0).to_numpy()
            found = machine.score(*features(Texts(batch.column(body)), chars, machine.bits))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, score_name])

    schema = T.StructType([*docs.schema.fields, T.StructField(score_name, T.DoubleType())])
    return docs.mapInArrow(run, schema).withColumn(predicted, (F.col(score_name) >= threshold).cast("int"))

"""Near-duplicate texts by Order MinHash and banded alignment.

A text is the sequence of its five-word windows, each labelled with how often it occurred before. A sketch takes the
windows with the smallest hashes and keeps them in the order of the text, so two texts agree in a sketch if
the same windows are sampled and stand in the same order. Texts that agree in a sketch are
compared by aligning their windows inside a band: similarity is aligned windows / (windows of both - aligned).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.graph import components
from shelfcast.llm.queues import fresh
from shelfcast.llm.runs import block_pairs, map_runs, matrix, numbers
from shelfcast.llm.text import Texts, Words, mix, slices
from shelfcast.operators.joins import attach
from shelfcast.session import Table, materialise


@dataclass(frozen=True)
class OrderSketch:
    """Words per window, sketches per text, windows per sketch; the hashes that tell whether to look closer at all.

    Two texts of similarity 0.8 agree in 256 of 320 samples on average. The first rounds align pairs that agree in ``needed``. The last one,
    which decides, looks at all that agree in ``enough``, more than seven deviations below the mean, and rules out by an exact bound (``may_reach``).
    The first 64 samples settle most pairs: such texts agree there in 51 on average, the limit is six deviations below.
    """

    words: int = 5
    sketches: int = 16
    sampled: int = 3
    samples: int = 320
    needed: int = 235
    enough: int = 205
    glance: tuple[int, int] = (64, 32)
    block: int = 1024
    seed: int = 5


def window_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, bounds) of all n-word windows; a text with fewer words is one window of them all."""
    texts = words.texts
    at, key = words.grams(n)
    doc = words.doc[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = words.counts[short] > k
            own = np.zeros(len(short), np.uint64)
            own[has] = words.hash()[words.first[short[has]] + k]
            whole = mix(whole ^ (own + np.uint64(k + 1)))
        doc = np.concatenate([doc, short])
        key = np.concatenate([key, whole])
        order = np.argsort(doc, kind="stable")
        doc, key = doc[order], key[order]
    return key, doc, np.searchsorted(doc, np.arange(texts.rows + 1))


def occurrence(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How often each window's hash occurred before in its text."""
    order = np.lexsort((np.arange(len(key)), mix(key ^ mix(doc.astype(np.uint64) + np.uint64(7)))))
    ordered, whose = key[order], doc[order]
    head = np.append(True, (ordered[1:] != ordered[:-1]) | (whose[1:] != whose[:-1])) if len(key) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(head, np.arange(len(key)), 0)) if len(key) else np.zeros(0, int)
    out = np.zeros(len(key), np.int64)
    out[order] = np.arange(len(key)) - begin
    return out


def sketch(words: Words, rule: OrderSketch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names of the sketches, samples as 16-bit values, number of windows) of each text."""
    key, doc, bounds = window_hashes(words, rule.words)
    rows, size = words.texts.rows, np.diff(bounds)
    names = np.zeros((rows, rule.sketches), np.int64)
    samples = np.zeros((rows, rule.samples), np.uint16)
    full = np.flatnonzero(size > 0)
    if not len(full):
        return names, samples, size
    labelled = mix(key + mix(occurrence(key, doc).astype(np.uint64)))
    starts, counts = bounds[full], size[full]
    where = np.arange(len(key))
    seeds = np.random.default_rng(rule.seed).integers(1, 1 << 63, rule.sketches + rule.samples, dtype=np.uint64) | np.uint64(1)
    top = np.uint64(2**64 - 1)
    for s in range(rule.sketches):
        h = labelled * seeds[s]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        picked = np.full((len(full), rule.sampled), len(key))
        for k in range(rule.sampled):
            least = np.minimum.reduceat(h, starts)
            hit = np.where(h == np.repeat(least, counts), where, len(key))
            place = np.minimum.reduceat(hit, starts)
            some = counts > k
            picked[some, k] = place[some]
            h[place[some]] = top
        picked.sort(axis=1)
        name = np.full(len(full), s + 1, np.uint64)
        padded = np.append(labelled, np.uint64(0))
        for k in range(rule.sampled):
            name = mix(name ^ padded[picked[:, k]])
        names[full, s] = name.view(np.int64)
    for s in range(0, rule.samples, 2):  # both halves of a mixed hash are hashes of their own
        h = labelled * seeds[rule.sketches + s]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        for half, part in ((0, h.astype(np.uint32)), (1, (h >> np.uint64(32)).astype(np.uint32))):
            if s + half < rule.samples:
                least = np.minimum.reduceat(part, starts).astype(np.uint64)
                samples[full, s + half] = (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return names, samples, size


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Most windows of two sequences that can be aligned in order, none further than ``band`` from the diagonal.

    A row of the alignment table is one number with a bit per window of ``b``, cleared where the row steps up. Only the
    ``2 * band + 1`` bits around the diagonal are kept: bits before them cannot change any more and are counted as they
    leave, bits beyond them are still set. So a step costs the width of the band, whatever the length of the texts.
    """
    low = min(len(a), len(b))
    same = a[:low] != b[:low]
    head = int(np.argmax(same)) if same.any() else low
    a, b = a[head:], b[head:]
    low = min(len(a), len(b))
    tail = 0
    if low:
        same = a[len(a) - low :][::-1] != b[len(b) - low :][::-1]
        tail = int(np.argmax(same)) if same.any() else low
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    other, last = b.tolist(), len(b) - 1
    places: dict[int, int] = {}  # where each window stands inside the band, as bits from ``base`` on
    base, row, low, top, found = 0, 0, 0, -1, 0
    for i, x in enumerate(a.tolist()):
        while top < last and top < i + band:
            top += 1
            y = other[top]
            places[y] = places.get(y, 0) | 1 << top - base
            row |= 1 << top - low
        if i - band > low:
            if low > last:
                break
            found += 1 - (row & 1)
            row >>= 1
            low += 1
            if low - base > 2 * band + 64:
                places = {y: kept for y, p in places.items() if (kept := p >> low - base)}
                base = low
        if (match := places.get(x)) and (u := row & match >> low - base):
            row = (row + u | row - u) & (1 << top - low + 1) - 1
    width = max(0, top - low + 1)
    return head + tail + found + width - row.bit_count()


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether aligned / (windows of both - aligned) reaches the threshold.

    Fewer than ``need`` aligned windows cannot reach it, and aligning that many leaves no pair further from the
    diagonal than the windows left over, so the band loses nothing.
    """
    need = int(np.ceil(threshold * (len(a) + len(b)) / (1 + threshold) - 1e-9))
    if min(len(a), len(b)) < need:
        return False
    found = aligned(a, b, max(len(a), len(b)) - need)
    return found >= threshold * (len(a) + len(b) - found) - 1e-9


def window_marks(seq: np.ndarray) -> np.ndarray:
    """The windows of a sequence as sorted distinct numbers: the hash, and how often it occurred before."""
    ordered = np.sort(seq).astype(np.uint64)
    head = np.append(True, ordered[1:] != ordered[:-1]) if len(ordered) else np.zeros(0, bool)
    at = np.arange(len(ordered))
    return ordered << np.uint64(32) | (at - np.maximum.accumulate(np.where(head, at, 0))).astype(np.uint64)


def may_reach(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether two texts (their ``window_marks``) have enough windows in common to be similar, in whatever order.

    Aligned windows are common windows, so a pair that is ruled out here cannot be a link.
    """
    need = int(np.ceil(threshold * (len(a) + len(b)) / (1 + threshold) - 1e-9))
    if min(len(a), len(b)) < need:
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) >= need


def near_classes(
    docs: DataFrame, threshold: float = 0.8, rule: OrderSketch = OrderSketch(), id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with ``class_id, n_class, kept``.

    class_id is the smallest id among the rows reachable over links; n_class the rows of the class; kept is true for one row of each class, the one with the smallest id (ties by the text's digest; rows
    with equal ids and texts are kept together, see ``one_per_class``). Equal texts are aligned once.

    Three rounds find the classes. First every text of a sketch is aligned with the sketch's best-connected text; then, in
    sketches that still hold several classes, with the text of another class that agrees with it in most samples; last, every two
    texts of different classes that share a sketch and have enough windows in common are aligned. Large sketches are cut into
    blocks that meet in pairs, and a pair is taken up in the first sketch that it shares. Only pairs inside a known class are left out.

    Null texts and texts without words are in no class: class_id is their own id, and they are kept. A text of fewer words than a window
    is one window of all its words. Texts of any length are used whole. Repeated rows are one class; a null id is ignored
    when the smallest is taken. An empty table gives an empty table; other columns pass through; added names
    that are taken get an underscore.
    """
    class_id, n_class, kept = fresh(docs.columns, "class_id", "n_class", "kept")
    (key,) = fresh([*docs.columns, class_id, n_class, kept], "text_key")
    own, body = F.col(f"`{id_column}`"), F.col(f"`{text}`")
    narrow = docs.select(own.alias("id"), body.alias("text"))
    copies = narrow.dropna(subset=["text"]).groupBy(F.sha2("text", 256).alias("key")).agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")
    )

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(Texts(batch.column("text")))
            names, samples, size = sketch(words, rule)
            some = np.flatnonzero(size > 0)
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(pa.array(some)),
                        pa.array(list(names[some]), pa.list_(pa.int64())),
                        pa.array([r.tobytes() for r in samples[some]], pa.binary()),
                        pa.array(size[some]),
                    ],
                    names=["key", "names", "samples", "windows"],
                )

    texts = narrow.dropna(subset=["text"]).select(F.sha2("text", 256).alias("key"), "text")
    per_row = texts.mapInArrow(sketched, "key string, names array<long>, samples binary, windows long")
    one = per_row.dropDuplicates(["key"]).join(copies, "key").withColumn("node", F.monotonically_increasing_id())
    nodes = materialise(one, "sketches").df

    entries = nodes.select("node", "windows", F.posexplode("names").alias("sketch", "name"))
    sizes = entries.groupBy("name").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    shared = materialise(entries.join(sizes, "name"), "shared-sketches").df
    popular = shared.groupBy("node").agg(F.sum("texts").alias("weight"))
    centres = shared.join(popular, "node").groupBy("name").agg(F.max(F.struct("weight", "node")).alias("centre"))
    stars = shared.join(centres.select("name", F.col("centre.node").alias("centre")), "name").filter("node <> centre")
    stars = stars.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    sequences = _sequences(shared.select("node").distinct().join(nodes.select("node", "key"), "node"), narrow, rule)
    tried = materialise(stars, "text-pairs")
    links = _aligned_links(tried, sequences, threshold)
    known = components(links.df)
    for every in (False, True):
        labelled = shared.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
        ends = labelled.groupBy("name").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        open_sketches = ends.filter("low < high").select("name")
        mixed = labelled.join(open_sketches, "name").select("name", "sketch", "node", "component", "windows", "texts")
        dealt = block_pairs(mixed, ["name"], "node", rule.block, "texts")
        dealt = dealt.join(nodes.select("node", F.col("names").alias("all_names"), "samples"), "node")
        if every:
            dealt = dealt.join(sequences, "node")
        more = map_runs(
            dealt,
            ["name", "block_low", "block_high"],
            ["node"],
            lambda t, every=every: _unlike_classes(t, threshold, rule, every),
            "a long, b long",
        )
        more = materialise(more.distinct().join(tried.df, ["a", "b"], "left_anti"), "text-pairs")
        if not more.rows:
            continue
        tried = Table(tried.df.unionByName(more.df), tried.rows + more.rows, tried.bytes + more.bytes)
        new = _aligned_links(more, sequences, threshold)
        if new.rows:
            links = Table(links.df.unionByName(new.df), links.rows + new.rows, links.bytes + new.bytes)
            known = components(links.df)
    named = nodes.select("key", "node", "least", "copies").join(known, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    first = F.min(F.struct(F.col("least").isNull().alias("no_id"), "least", "key"))
    sizes = named.groupBy("component").agg(first.alias("head"), F.sum("copies").alias("members"))
    named = named.join(sizes, "component").select(
        F.col("key").alias(key),
        F.col("head.least").alias(class_id),
        (F.col("key") == F.col("head.key")).alias(kept),
        F.col("members").alias(n_class),
    )
    out = docs.withColumn(key, F.sha2(body, 256)).join(named, key, "left")
    in_class = F.col(n_class).isNotNull()
    return out.withColumns(
        {
            kept: ~in_class | (F.col(kept) & own.eqNullSafe(F.col(class_id))),
            class_id: F.when(in_class, F.col(class_id)).otherwise(own),
            n_class: F.coalesce(n_class, F.lit(1).cast("long")),
        }
    ).drop(key)


def one_per_class(classes: DataFrame, names: tuple[str, str] = ("kept", "n_class"), same: tuple[str, str] = ("doc_id", "text")) -> DataFrame:
    """The kept rows of ``near_classes``; of repeated kept rows of a class one stays."""
    kept, size = names
    rows = classes.filter(F.col(kept))
    return rows.filter(F.col(size) == 1).unionByName(rows.filter(F.col(size) > 1).dropDuplicates(list(same)))


def _sequences(wanted: DataFrame, docs: DataFrame, rule: OrderSketch) -> DataFrame:
    """(node, seq): the windows of each wanted text, as 32-bit hashes in order."""
    texts = attach(docs.select("text").dropna().withColumn("key", F.sha2("text", 256)), wanted, ["key"], "inner")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            key, _, bounds = window_hashes(Words(Texts(batch.column("text"))), rule.words)
            key = (key >> np.uint64(32)).astype("<u4")
            raw = [key[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(raw, pa.binary())], names=["node", "seq"])

    made = texts.dropDuplicates(["node"]).select("node", "text").mapInArrow(windows, "node long, seq binary")
    return materialise(made, "windows").df


def _aligned_links(pairs: Table, sequences: DataFrame, threshold: float) -> Table:
    """The pairs (a, b) whose texts are similar."""
    narrow = Table(pairs.df.select("a", "b"), pairs.rows, pairs.bytes)
    first = attach(sequences.toDF("a", "seq_a"), narrow, ["a"], "inner")
    second = attach(sequences.toDF("b", "seq_b"), narrow, ["b"], "inner")
    short, long = (f(F.length("seq_a"), F.length("seq_b")) for f in (F.least, F.greatest))
    both = first.join(second, ["a", "b"]).filter(short >= F.lit(threshold) * long)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "seq_a"):
            a, b = batch.column("seq_a").to_pylist(), batch.column("seq_b").to_pylist()
            good = [similar(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), threshold) for x, y in zip(a, b, strict=True)]
            rows = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(rows), batch.column("b").take(rows)], names=["a", "b"])

    return materialise(both.select("a", "b", "seq_a", "seq_b").mapInArrow(align, "a long, b long"), "aligned")


def _unlike_classes(table: pa.Table, threshold: float, rule: OrderSketch, every: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of one sketch (or of two blocks of it) that are in different classes and may be similar.

    All that the exact bound leaves, or for each text the one that it agrees with most. A pair belongs to the first sketch that it shares.
    """
    node, component, windows = (numbers(table, c) for c in ("node", "component", "windows"))
    own, low, high = (numbers(table, c) for c in ("block_own", "block_low", "block_high"))
    sketch_no = int(numbers(table, "sketch")[0])
    samples = matrix(table, "samples", rule.samples, "<u2")
    names = table.column("all_names").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)[:, :sketch_no]
    marks = lru_cache(None)(lambda k: window_marks(np.frombuffer(table.column("seq")[k].as_py(), "<u4")))
    for i in range(len(node)):
        rest = slice(i + 1, None) if every else slice(None)
        maybe = component[rest] != component[i]
        maybe &= np.minimum(windows[rest], windows[i]) >= threshold * np.maximum(windows[rest], windows[i])
        if low[0] != high[0]:
            maybe &= own[rest] != own[i]
        j = np.flatnonzero(maybe) + (i + 1 if every else 0)
        if sketch_no and len(j):
            j = j[~(names[j] == names[i]).any(axis=1)]
        if not len(j):
            continue
        few, enough = rule.glance
        j = j[(samples[j, :few] == samples[i, :few]).sum(axis=1) >= enough]
        if not len(j):
            continue
        agree = (samples[j] == samples[i]).sum(axis=1)
        if not every:
            j, agree = j[[agree.argmax()]], agree[[agree.argmax()]]
        j = j[agree >= (rule.enough if every else rule.needed)]
        if every:
            j = j[[may_reach(marks(i), marks(k), threshold) for k in j.tolist()]] if len(j) else j
        if len(j):
            a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

"""Pfair mixing and mixture-controlled packing."""

import math
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm.mixing import Timetable, in_order, mix
from shelfcast.llm.packing import UNITS, Groups, Schedule, Tokens, pack, with_checksum
from shelfcast.llm.queries import QUERIES
from shelfcast.llm.queues import offsets


def test_used_up_sources_leave_and_slots_have_no_gaps():
    blocks = [50, 7, 0, 21]
    table = Timetable(blocks, [5.0, 2.0, 1.0, 1.0], 64)
    taken = []
    for q, n in enumerate(blocks):
        release, deadline, slot = table.find(np.full(n, q), np.arange(n))
        assert (release <= slot).all() and (slot < deadline).all() and (np.diff(slot) > 0).all()
        taken += slot.tolist()
    assert sorted(taken) == list(range(sum(blocks)))


@pytest.mark.parametrize("weights", [[1 / 20] * 20, [0.36] + [0.64 / 19] * 19, [1.0, 1e-4, 3e-5], [3.0, 2.0, 1.3, 2**0.5]])
def test_lag_stays_below_one_over_many_periods(weights):
    period, n = 64, 40_000
    w = np.array(weights) / sum(weights)
    blocks = [int(n * x) + 1 for x in w]
    table = Timetable(blocks, weights, period)
    taken = []
    for q, most in enumerate(blocks):
        release, deadline, slot = table.find(np.full(most, q), np.arange(most))
        assert (release <= slot).all() and (slot < deadline).all() and (np.diff(slot) > 0).all()
        taken += slot.tolist()
        t = np.arange(n)
        assert np.abs(np.searchsorted(slot, t) - w[q] * t).max() < 1
    assert sorted(taken) == list(range(sum(blocks)))


def test_mixing_keeps_every_row_once(spark, awkward, no_docs):
    taken = awkward.withColumns({"slot": F.lit(1), "queue": F.lit("q")})
    mixed, names = mix(taken, block_docs=2, temperature=0.5)
    rows = mixed.collect()
    assert names["slot"] == "slot_" and names["queue"] == "queue_"
    as_bag = lambda rs: Counter((r["doc_id"], r["text"], r["source"], r["slot"]) for r in rs)
    assert as_bag(rows) == as_bag(taken.collect())
    by_slot = defaultdict(list)
    for r in rows:
        by_slot[r["slot_"]].append((r["queue_"], r["block_offset"]))
    assert sorted(by_slot) == list(range(len(by_slot)))
    for inside in by_slot.values():
        assert len({q for q, _ in inside}) == 1 and sorted(o for _, o in inside) == list(range(len(inside)))
    assert {r["queue_"] for r in rows if not r["source"]} == {None}
    assert mix(no_docs)[0].count() == 0
    ordered = in_order(mixed, names)
    assert ordered.columns == taken.columns and ordered.count() == taken.count()


def test_target_weights_hold_in_every_prefix(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("source"))
    mixed, _ = mix(docs.repartition(7), {"x": 0.25, "y": 0.75}, block_docs=4)
    slots = sorted((r["slot"], r["queue"]) for r in mixed.filter("block_offset = 0").collect())
    x = np.cumsum([q == "x" for _, q in slots])
    both = max(i for i, (_, q) in enumerate(slots) if q == "y")
    assert np.abs(x[:both] - 0.25 * np.arange(1, both + 1)).max() < 1
    with pytest.raises(ValueError):
        mix(docs, {"x": 0.0, "y": 1.0})


def test_prefix_sums_over_many_partitions(spark):
    rows = spark.range(5000).select((F.col("id") % 2).cast("int").alias("q"), (F.col("id") % 2500).cast("int").alias("p"), F.lit(3).alias("n"))
    for r in offsets(rows, "q", "p", F.col("n")).collect():
        assert r["before"] == 6 * len(range(r["q"], r["p"], 2))


@pytest.mark.parametrize("window", [64, 100, 1024])
def test_schedule_covers_every_token_once_in_proportion(window):
    rng = np.random.default_rng(window)
    docs = [rng.integers(1, 300, n) for n in (70, 31, 0, 9, 1)]
    totals = [int(d.sum()) for d in docs]
    for weights, exact in (([float(t) for t in totals], True), ([1.0, 5.0, 1.0, 2.0, 0.3], False)):
        plan = Schedule(totals, weights, window)
        queue = np.concatenate([np.full(len(d), q) for q, d in enumerate(docs)])
        start = np.concatenate([np.cumsum(d) - d for d in docs])
        owner = np.full(sum(totals), -1)
        for row, begin, length, place in plan.pieces(queue, start, np.concatenate(docs)):
            for r, n, at in zip(row, length, place, strict=True):
                assert (owner[at : at + n] == -1).all()
                owner[at : at + n] = queue[r]
        assert (owner >= 0).all()
        # The deficit: tokens due and not given stay below one per queue while all queues last.
        lasts = min(int(np.flatnonzero(owner == q).max()) for q, t in enumerate(totals) if t) if not exact else len(owner)
        share = np.array([w if t else 0 for w, t in zip(weights, totals, strict=True)])
        share = share / share.sum()
        for end in range(window, lasts - 2 * window, window):
            got = np.bincount(owner[:end], minlength=len(docs))
            assert np.abs(got - share * end).max() < 1 + 1e-3 * len(docs)


def brute_ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_are_those_of_the_tokenizer_file():
    tokens = Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["", " ", "a  b", "x 's don't", "a\n b　c", "<|endoftext|> 12 %%%", "日本語 été \x1c \x85", "z" * 3000, "a<|endoftext|><|endoftext|> b <|endoftext"]:
        assert tokens.checked(text).tolist() == brute_ids(text)
    assert tokens.ids("a <|endoftext|> b").tolist().count(50256) == 1
    for blanks in (" " * 2_000_000, "\n" * 1_000_000 + "x"):
        assert tokens.ids(blanks).tolist() == brute_ids(blanks)


def deficit_rounds(totals, weights, window):
    """(queue, token of the queue) in packed order, by a loop over rounds that carries the credit of every run of queues from the first."""
    left, taken, out = list(totals), [0] * len(totals), []
    while any(left):
        share = [int(x) for x in Schedule._shares(np.array([w if n else 0.0 for w, n in zip(weights, left, strict=True)]))]
        credit, given = [0] * len(left), [0] * len(left)
        while True:
            served, ahead = [], 0
            for q in range(len(left)):
                credit[q] += sum(share[: q + 1]) * window
                upto = credit[q] // UNITS
                served.append(upto - ahead - given[q])
                ahead = upto
            short = any(n > have for n, have in zip(served, left, strict=True))
            for q, n in enumerate(served):
                for _ in range(min(n, left[q])):
                    out.append((q, taken[q]))
                    taken[q] += 1
                    left[q] -= 1
                given[q] += n
            if short or not any(left):
                break
    return out


@pytest.mark.parametrize(("totals", "weights", "window"), [
    ([50, 30, 20], [5.0, 3.0, 2.0], 10), ([7, 200, 90], [1.0, 1.0, 1.0], 16), ([0, 13, 5, 400], [0.3, 0.2, 0.25, 0.25], 32), ([33], [1.0], 8),
])
def test_schedule_is_that_of_the_round_by_round_loop(totals, weights, window):
    schedule = Schedule(totals, weights, window)
    queue, size = np.arange(len(totals)), np.array(totals, np.int64)
    place = {}
    for row, start, length, at in schedule.pieces(queue[size > 0], np.zeros((size > 0).sum(), np.int64), size[size > 0]):
        for r, s, n, p in zip(queue[size > 0][row].tolist(), start.tolist(), length.tolist(), at.tolist(), strict=True):
            place.update(((p + k), (r, s + k)) for k in range(n))
    assert [place[p] for p in range(len(place))] == deficit_rounds(totals, weights, window)


@pytest.mark.parametrize("targets", [None, {"a": 0.7, "b": 0.2, "": 0.1}])
def test_packing_gives_every_id_back(spark, awkward, targets):
    docs = awkward.withColumns({"start": F.lit(1), "queue": F.lit("x")}).repartition(3)
    rows = pack(docs, targets, window=128).collect()
    places = sorted((r["sequence_id"] * 128 + r["offset"], r["length"]) for r in rows)
    assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
    assert all(0 < r["length"] <= 128 - r["offset"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    whole = Counter(tuple(brute_ids(r["text"])) for r in awkward.collect())
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    back = Counter()
    for pieces in by_doc.values():
        open_docs = []  # rows with equal ids: pieces continue the one whose end they meet
        for p in sorted(pieces, key=lambda p: (p["start"], p["sequence_id"], p["offset"])):
            ids = np.frombuffer(p["ids"], "<u4").tolist()
            if p["start"] == 0:
                open_docs.append(([p["source_queue"], p["doc_tokens"]], list(ids)))
            else:
                doc = next(d for d in open_docs if len(d[1]) == p["start"] and d[0] == [p["source_queue"], p["doc_tokens"]])
                doc[1].extend(ids)
        back.update(tuple(ids) for _, ids in open_docs)
    assert back == whole


def test_packing_checksums_and_empty_table(spark, tiny, no_docs):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    pieces = pack(docs)
    for r in with_checksum(pieces).join(pieces.select("doc_id", "start", "ids"), ["doc_id", "start"]).limit(50).collect():
        assert r["ids_crc32"] == zlib.crc32(r["ids"])
    assert pack(no_docs).count() == 0


@pytest.mark.parametrize("temperature", [1.0, 0.5])
@pytest.mark.parametrize("small", [[1], [5, 7, 1, 1, 30], [*range(300, 400)] * 7])
def test_packing_keeps_the_proportion_of_many_and_of_tiny_queues(temperature, small):
    totals = [0, 90_000, 20_000, *small]
    weights, n = [float(t) ** temperature for t in totals], len(totals)
    plan = Groups(totals, weights, 1024)
    owner = np.full(sum(totals), -1)
    for row, begin, length, place in plan.pieces(np.arange(n), np.zeros(n, np.int64), np.array(totals)):
        for r, m, at in zip(row, length, place, strict=True):
            assert (owner[at : at + m] == -1).all()
            owner[at : at + m] = r
    assert np.bincount(owner, minlength=n).tolist() == totals
    lasts = min(int(np.flatnonzero(owner == q).max()) for q, t in enumerate(totals) if t)
    share = np.array(weights) / sum(weights)
    for end in range(1024, lasts - 2 * 1024, 1024):
        assert np.abs(np.bincount(owner[:end], minlength=n) - share * end).max() < 3
    assert lasts > 20 * 1024 or len(small) < 100


def test_mixing_and_packing_keep_every_source_apart(spark):
    docs = spark.range(8 * 600).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 600).alias("source"), F.lit("a b c").alias("text")
    )
    rows = mix(docs, block_docs=4, temperature=0.5)[0].collect()
    assert all(r["queue"] == r["source"] for r in rows)
    by_slot = Counter(r["queue"] for r in rows if r["slot"] < 600)
    assert len(by_slot) == 600 and set(by_slot.values()) == {4}
    pieces = pack(docs).collect()
    assert {r["source_queue"] for r in pieces} == set(range(600))
    assert sum(r["length"] for r in pieces) == sum(r["doc_tokens"] for r in pieces if r["start"] == 0)


def brute_pfair(blocks, weights):
    """Slot, release and deadline of every (queue, block), slot by slot in exact fractions."""
    weights = [Fraction(w) for w in weights]

    def reached(q, x):
        """Slots gone when queue q has had x blocks of the flow."""
        v = x / weights[q]
        return sum((min(Fraction(n), w * v) for n, w in zip(blocks, weights, strict=True) if n), Fraction(0))

    given, out = [0] * len(blocks), {}
    for slot in range(sum(blocks)):
        ready = []
        for q, i in enumerate(given):
            if i < blocks[q] and math.floor(reached(q, i)) <= slot:
                ready.append((math.ceil(reached(q, i + 1)), q, i))
        deadline, q, i = min(ready)
        out[q, i] = (math.floor(reached(q, i)), deadline, slot)
        given[q] += 1
    return out


def test_mixing_query_is_that_of_the_slot_by_slot_loop(spark, tiny):
    rows = QUERIES["op4_pfair_mixing"](spark, tiny).collect()
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("source").collect()
    sizes = Counter(r["source"] or None for r in docs)
    names = [*sorted(n for n in sizes if n), None]
    want = brute_pfair([-(-sizes[n] // 16) for n in names], [float(sizes[n]) ** 0.5 if sizes[n] else 1.0 for n in names])
    assert len(rows) == len(docs) and {(names.index(r["queue"]), r["block"]) for r in rows} == set(want)
    for r in rows:
        assert (r["release"], r["deadline"], r["slot"]) == want[names.index(r["queue"]), r["block"]]
    places = sorted((r["slot"], r["block_offset"]) for r in rows)
    assert len(set(places)) == len(places)
    assert all(Counter(r["queue"] for r in rows)[n] == k for n, k in sizes.items())

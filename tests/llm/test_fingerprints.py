"""Order MinHash fingerprints against a version that follows the definition text by text."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from shelfcast.llm.fingerprints import OrderRule, fingerprints, likeness, order_sketches, sketch_text
from shelfcast.llm.queries import QUERIES

M64, M32 = (1 << 64) - 1, (1 << 32) - 1
LOW = (1 << 24) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def of_long(x, seed):
    return xxhash.xxh64((x & M64).to_bytes(8, "little"), seed).intdigest()


def of_int(x, seed):
    return xxhash.xxh64((x & M32).to_bytes(4, "little"), seed).intdigest()


def murmur(longs, seed=42):
    h = seed
    rot = lambda x, r: ((x << r) | (x >> (32 - r))) & M32
    for x in longs:
        for part in (x & M32, (x >> 32) & M32):
            k = rot(part * 0xCC9E2D51 & M32, 15) * 0x1B873593 & M32
            h = (rot(h ^ k, 13) * 5 + 0xE6546B64) & M32
        h ^= 8
        h = (h ^ (h >> 16)) * 0x85EBCA6B & M32
        h = (h ^ (h >> 13)) * 0xC2B2AE35 & M32
        h ^= h >> 16
    return h


def brute_sketches(text, k=2, chosen=2, sketches=64):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, points = defaultdict(int), []
    for i in range(len(words)):
        h = 42
        for w in words[i : i + k]:
            h = xxhash.xxh64(w.encode(), h).intdigest()
        label = (h << 24) & M64
        seen[label] += 1
        if seen[label] > 1:
            label = of_int(seen[label] - 1, of_long(label, 42)) & ~LOW & M64
        points.append((label | (i & LOW), i))
    if not points:
        return [0] * sketches
    out = []
    for s in range(sketches):
        anchor = ((s - sketches // 2) << (64 - sketches.bit_length() + 1)) & M64
        ordered = sorted(points, key=lambda p: (p[0] - anchor) & M64)
        picked = [ordered[j % len(ordered)] for j in range(chosen)]
        picked.sort(key=lambda p: p[1])
        out.append(murmur([p[0] & ~LOW & M64 for p in picked]))
    return out


def hexed(sketch):
    return "".join(f"{x:08x}" for x in sketch)


def brute(docs):
    """Rows by the contract, for docs without equal (id, text) pairs."""
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, signed(xxhash.xxh64((d[1] or "").encode(), 42).intdigest())), reverse=True)
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (brute_sketches(t) for t in (text, edited, after))
        near = lambda x, y: (sum(p == q for p, q in zip(x, y, strict=True)) / 64) ** 0.5
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(a), hexed(b), round(near(a, b), 12), round(near(a, c), 12)))
    return Counter(out)


def found(df):
    return Counter((*r[:5], round(r[5], 12), round(r[6], 12)) for r in df.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect())


def test_query_follows_the_definition(spark, tiny):
    docs = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    df = QUERIES["op11_order_fingerprints"](spark, tiny)
    want = brute(docs)
    assert found(df) == want
    ranks = [(r["near_edited"], r["near_next"]) for r in df.collect()]
    assert sum(a > b for a, b in ranks) > 0.9 * len(ranks)


@pytest.mark.parametrize("range_rows", [1, 3, 1000])
def test_order_does_not_depend_on_the_ranges(spark, awkward, range_rows):
    docs = awkward.dropDuplicates(["doc_id", "text"]).withColumn("edited_sha256", F.lit("clash")).withColumn("key", F.lit(3))
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert found(fingerprints(docs, range_rows=range_rows)) == want


def test_repeated_rows_and_hot_ids(spark, awkward, monkeypatch):
    got = fingerprints(awkward).collect()
    assert len(got) == awkward.count()
    twins = [r for r in got if r["doc_id"] == 1]
    assert sorted(r["near_next"] == 1.0 for r in twins) == [False, True] and len({r["fingerprint"] for r in twins}) == 1
    hot = [(5, "one two three four five six")] * 9000 + [(5, f"other text {i}") for i in range(500)] + [(None, "x")] * 70 + [(9, "the last one")]
    rows = fingerprints(spark.createDataFrame(hot, "doc_id long, text string").repartition(5))
    assert rows.groupBy("doc_id").count().collect() and Counter(r[0] for r in rows.select("doc_id").collect()) == Counter(d for d, _ in hot)
    same = rows.filter("doc_id = 5 AND n_chars = 27").groupBy("edited_sha256").count().collect()
    twice = hashlib.sha256(b"one two three one two three").hexdigest()
    assert {r["edited_sha256"]: r["count"] for r in same}.pop(hashlib.sha256(b"one two three " + b"one two three"[:13]).hexdigest()) in (8999, 9000)
    assert sum(r["count"] for r in same) == 9000 and twice


def test_edges(spark, no_docs):
    assert fingerprints(no_docs).count() == 0
    (one,) = fingerprints(spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and one["near_next"] == 1.0
    (null,) = fingerprints(spark.createDataFrame([(None, None)], "doc_id long, text string")).collect()
    assert null["n_chars"] == 0 and null["near_edited"] == 1.0 and set(null["fingerprint"]) == {"0"}


def test_order_counts_and_tuples_of_any_length(spark):
    words = [f"w{i}" for i in range(200)]
    turned = words[100:] + words[:100]
    df = spark.createDataFrame([(" ".join(words), " ".join(turned))], "a string, b string")
    for rule in (OrderRule(), OrderRule(words=1, selected=3, sketches=32)):
        near = df.select(likeness(order_sketches(F.col("a"), rule), order_sketches(F.col("b"), rule), rule)).first()[0]
        assert 0.3 < near < 0.95  # the same words, in another order
    text = df.select(sketch_text(order_sketches(F.col("a"), OrderRule(sketches=32)))).first()[0]
    assert len(text) == 256


def test_main_path_is_native(spark, tiny):
    plan = QUERIES["op11_order_fingerprints"](spark, tiny)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|RDD", plan)

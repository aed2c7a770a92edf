"""WARC archive, bounded ring, filter cascade and perspectives."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from glob import glob

import pytest
import xxhash
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfcast.llm.archive import read_archive, write_archive, write_warc
from shelfcast.llm.perspectives import mask_text, rotate
from shelfcast.llm.sharding import Ring, Settlement, shard_documents
from shelfcast.llm.url_filter import Cascade, judge_urls, parse_rules

BIG = "<p>" + "x" * 1200 + "</p>"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a/", BIG), (2, "http://b/\r\nX: y", BIG), (3, "http://c/", BIG), (3, "http://c/", BIG),
        (4, None, None), (5, "http://e/", ""), (6, "http://f/", "small"), (7, "http://g/", "small"),
        (None, "http://h/", BIG), (None, "http://i/", "z" * 3000), (8, "http://j/", "été\r\n\r\nWARC/1.1\r\n" * 100),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_archive_round_trip(spark, pages):
    found = read_archive(spark, write_archive(pages.withColumn("id", F.lit("clash")))).collect()
    back = Counter((r["id"], r["payload"]) for r in found)
    assert back == Counter((r["page_id"], r["html"] or "") for r in pages.collect())
    for r in found:
        raw = r["payload"].encode()
        assert r["payload_digest"] == hashlib.sha1(raw).hexdigest() and r["payload_bytes"] == len(raw)
        big = r["payload"] == BIG
        assert (r["record_type"] == "revisit") == (big and r["id"] != 3)
        assert r["refers_to"] == ("3" if big and r["id"] != 3 else None)
        assert "\r" not in r["target"]


def test_records_are_readable_warc_files(spark, pages, tmp_path):
    folder = write_archive(pages)
    records = read_archive(spark, folder)
    write_warc(records.coalesce(1), str(tmp_path / "warc"))
    (name,) = glob(os.path.join(tmp_path, "warc", "part-*"))
    raw = open(name, "rb").read()
    at, seen = 0, []
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at) + 4
        head = raw[at:end].decode()
        size = int(re.search(r"\r\nContent-Length: (\d+)\r\n", head)[1])
        assert head.startswith("WARC/1.1\r\n") and raw[end + size : end + size + 4] == b"\r\n\r\n"
        seen.append((re.search(r"WARC-Type: (\w+)", head)[1], raw[end : end + size].partition(b"\r\n\r\n")[2].decode()))
        at = end + size + 4
    want = Counter((r["record_type"], "" if r["record_type"] == "revisit" else r["payload"]) for r in records.collect())
    assert Counter(seen) == want
    payloads = spark.read.parquet(f"{folder}/payloads")
    assert payloads.count() == payloads.select("payload").distinct().count()


def test_damaged_payloads_are_noticed(spark, pages):
    folder = write_archive(pages.limit(0))
    assert read_archive(spark, folder).count() == 0
    folder = write_archive(pages)
    spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.concat("payload", F.lit("!"))).write.parquet(f"{folder}/x/payloads")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{folder}/x/headers")
    with pytest.raises(PySparkException):
        read_archive(spark, f"{folder}/x").collect()


def check_shards(rows, docs, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (d["doc_id"], len((d["text"] or "").encode()) + 8, zlib.crc32((d["text"] or "").encode())) for d in docs
    )
    loads, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [loads[s] for s in range(shards)]


def test_shards_have_near_equal_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    loads = check_shards(shard_documents(docs).collect(), docs.collect(), 24)
    mean = sum(loads) / 24
    assert max(loads) < 1.02 * mean and min(loads) > 0.9 * mean


def test_placement_is_that_of_a_walk_round_the_ring(spark):
    rng, ring = random.Random(4), Ring(shards=5, nodes=16, bits=8)
    docs = [(i, "x" * rng.choice([rng.randrange(400), rng.randrange(400), 60_000 + i])) for i in range(1500)]
    got = {r["doc_id"]: r["shard"] for r in shard_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), ring).collect()}
    place = lambda i: xxhash.xxh64(i.to_bytes(8, "little"), xxhash.xxh64((8).to_bytes(4, "little"), 42).intdigest()).intdigest() >> 56
    taken = {}
    for shard in range(5):
        for k in range(16):
            p = int.from_bytes(hashlib.blake2b(f"{shard}:{k}".encode(), digest_size=8).digest(), "big") % 256
            while p in taken:
                p = (p + 1) % 256
            taken[p] = shard
    size = {i: len(t) + 8 for i, t in docs}
    total = sum(size.values())
    bound, least, loads = math.ceil(total * 1.002 / 5), int(total * 0.01 / 5) + 1, [0] * 5

    def walk(at):
        return list(dict.fromkeys(taken[(at + d) % 256] for d in range(256) if (at + d) % 256 in taken))

    for i in sorted((i for i in size if size[i] >= least), key=lambda i: (-size[i], place(i))):
        fits = [s for s in walk(place(i)) if loads[s] + size[i] <= bound]
        shard = fits[0] if fits else min(walk(place(i)), key=loads.__getitem__)
        loads[shard] += size[i]
        assert got[i] == shard
    small, home = defaultdict(list), 0
    for i in size:
        if size[i] < least:
            small[place(i)].append(i)
    for p in sorted(small):
        left, shards = sum(size[i] for i in small[p]), []
        for s in walk(p):
            part = min(left, max(0, bound - loads[s]))
            if part:
                shards.append(s)
                loads[s] += part
                left -= part
        assert {got[i] for i in small[p]} <= set(shards) and (len(shards) > 1 or not left)
        home += shards[0] == walk(p)[0]
    assert home > 0.5 * len(small)


def test_one_id_with_most_rows_is_spread(spark):
    rows = [(7, "same text")] * 3000 + [(None, "x" * (i % 50)) for i in range(2000)] + [(i, "y" * (i % 90)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    loads = check_shards(shard_documents(docs, Ring(shards=5, nodes=16)).collect(), docs.collect(), 5)
    assert max(loads) < 1.03 * sum(loads) / 5


def test_shards_of_awkward_rows(awkward, no_docs):
    docs = awkward.withColumn("size", F.lit("clash"))
    check_shards(shard_documents(docs, Ring(shards=3)).collect(), awkward.collect(), 3)
    assert shard_documents(no_docs).count() == 0


def test_a_shard_more_moves_few_keys():
    """With room to spare, hardly a place moves between old shards when one is added."""
    settle = lambda n: Settlement(Ring(shards=n, slack=0.5), 65536)
    a, b = settle(8), settle(9)
    moved = sum(x != y and y != 8 for x, y in ((a.whole(p, 1), b.whole(p, 1)) for p in range(0, 65536, 16)))
    assert moved < 0.02 * 4096


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = universe.filter("crc32(key) % 4 = 0")
    cascade = Cascade(listed, universe.union(universe))
    assert len(cascade.levels) > 2
    want = {r["key"] for r in listed.collect()}
    assert {r["key"] for r in universe.filter(cascade.holds(F.col("key"))).collect()} == want
    none = Cascade(listed.limit(0), universe)
    assert universe.filter(none.holds(F.col("key"))).count() == 0


RULES = parse_rules(("net/", "example.com/de/"), ("example.net/en/", "org/fr/"))


def brute_url(url, hosts):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    under = lambda h: host == h or host.endswith("." + h)
    fits = [r for r in RULES if under(r.host) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: (len(r.key), len(r.host)))
        return host, path, best.key, best.verdict
    return host, path, None, "block" if any(map(under, hosts)) else "allow"


def test_urls_match_brute_force(spark):
    urls = [
        None, "", "no scheme", "http://", "http://net", "http://net/", "http://NET/x", "https://a.Example.NET/en/x?y#z", "http://example.net/en",
        "http://xexample.com/de/", "http://www.example.com/de/", "http://example.com/DE/", "http://é.org/fr/ü", "http://org/fr/",
        "http://org?/fr/", "http://u:p@a.org/fr/1", "http://bad.host/x", "http://x.bad.host", "http://notbad.host", "http://.../de/", "a://b://net/",
        "http://" + "a." * 3000 + "net/" + "p/" * 3000, "http://a.org/fr/\nb?c", "http://a b.net/", "HTTP://A.NET/",
    ]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls + urls[:5])], "page_id long, url string").withColumn("rule", F.lit(1))
    hosts = ["bad.host", "Evil.example.com"]
    got = {(r["page_id"], r["host"], r["path"], r["rule_"], r["verdict"]) for r in judge_urls(frame, RULES, hosts).collect()}
    assert got == {(i, *brute_url(u, [h.lower() for h in hosts])) for i, u in enumerate(urls + urls[:5])}
    assert judge_urls(frame.limit(0), RULES, hosts).count() == 0
    assert {r["verdict"] for r in judge_urls(frame, []).collect()} == {"allow"}


def brute_render(turns, me):
    text, spans = "", []
    for who, said in turns:
        head = "<|assistant|>\n" if who == me else "<|system|>\n" if who == "system" else f"<|user name={who}|>\n"
        body = said.replace("<|", "<\\|") + "<|end|>\n"
        if who == me:
            spans.append(f"{len(text) + len(head)}-{len(text) + len(head) + len(body)}")
        text += head + body
    return text, ",".join(spans)


def test_every_participant_gets_a_view(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|> 日本"), (1, 2, "bob", "\U0001f600 yes"), (1, 3, "ann", None), (1, 3, "ann", None),
        (1, None, None, "first"), (2, 0, "system", "alone"), (None, 0, "ann", "lost"), (None, 1, "", "found"), (3, 0, "eve", "x" * 100_000),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit("c"))
    found = {(r["conv_id"], r["assistant"]): r for r in rotate(frame).withColumn("m", mask_text()).collect()}
    dialogues = {
        1: [("unknown", "first"), ("system", "be kind"), ("ann", "hi <|end|> 日本"), ("bob", "\U0001f600 yes"), ("ann", "")],
        None: [("ann", "lost"), ("unknown", "found")],
        3: [("eve", "x" * 100_000)],
    }
    assert set(found) == {(c, w) for c, turns in dialogues.items() for w, _ in turns if w != "system"}
    for (c, me), r in found.items():
        assert (r["text"], r["m"]) == brute_render(dialogues[c], me)
        assert r["n_turns"] == len(dialogues[c]) and r["n_masked"] == sum(w == me for w, _ in dialogues[c])
    assert rotate(frame.limit(0)).count() == 0


def test_long_and_crowded_dialogues_come_in_small_segments(spark):
    rows = [(1, i, "ab"[i % 2], f"t{i}") for i in range(500)] + [(2, 5, "a", f"u{i}") for i in range(900)] + [(2, 6, "b", "end"), (2, 1, "b", "go")]
    found = rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), segment_turns=32).collect()
    assert max(r["n_turns"] for r in found) < 100
    for conv, total in ((1, 500), (2, 902)):
        own = [r for r in found if r["conv_id"] == conv]
        assert sum(r["n_turns"] for r in own if r["assistant"] == "a") == total
        assert sum(r["n_masked"] for r in own) == total
    first = sorted((r["segment"], r["text"]) for r in found if r["conv_id"] == 1 and r["assistant"] == "a")
    assert [int(t) for t in re.findall(r"\nt(\d+)", "".join(t for _, t in first))] == list(range(500))


def test_speakers_of_a_conversation_are_never_gathered_in_a_row(spark):
    from shelfcast.llm.perspectives import rotate

    made = [("c", i, f"s{i % 300}", "x") for i in range(600)]
    out = rotate(spark.createDataFrame(made, "conv_id string, turn int, role string, text string"))
    assert "collect_set" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.select("assistant").distinct().count() == 300 and out.count() == 300 * 10

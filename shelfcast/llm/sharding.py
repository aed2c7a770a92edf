"""Consistent-hash sharding with virtual nodes and bounded loads.

The ring has a fixed number of places. Every shard stands at many of them, and a document belongs to the next shard
clockwise of its own place. A shard takes bytes up to a bound a little over the mean; what finds it full goes on
clockwise to the next shard with room. Loads are settled on the ring, whose size is a parameter: bytes are summed
per place first, and only those sums, and the few documents that are large against a shard, are seen by the driver.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.session import materialise

_SALTS = 1024


@dataclass(frozen=True)
class Ring:
    """Shards, virtual nodes of each, places on the ring, and how far a load may exceed the mean."""

    shards: int = 24
    nodes: int = 128
    bits: int = 16
    slack: float = 0.002
    #: A document of more than this part of a shard's mean is settled by itself; there are fewer than shards / large of them.
    large: float = 0.01

    @property
    def places(self) -> int:
        return 1 << self.bits

    def owners(self) -> list[tuple[int, int]]:
        """(place, shard) of the virtual nodes, clockwise; a taken place moves a node to the next free one."""
        if self.shards * self.nodes > self.places:
            raise ValueError("more virtual nodes than places")
        taken: dict[int, int] = {}
        for shard in range(self.shards):
            for k in range(self.nodes):
                digest = hashlib.blake2b(f"{shard}:{k}".encode(), digest_size=8).digest()
                place = int.from_bytes(digest, "big") % self.places
                while place in taken:
                    place = (place + 1) % self.places
                taken[place] = shard
        return sorted(taken.items())


class Settlement:
    """Loads of the shards while what hashes to each place is handed round the ring."""

    def __init__(self, ring: Ring, total: int):
        self._nodes = ring.owners()
        self._at = [place for place, _ in self._nodes]
        self.loads = [0] * ring.shards
        self.bound = int(-(-total * (1 + ring.slack) // ring.shards))

    def _clockwise(self, place: int) -> Iterable[int]:
        first = bisect_left(self._at, place)
        seen: set[int] = set()
        for k in range(len(self._nodes)):
            shard = self._nodes[(first + k) % len(self._nodes)][1]
            if shard not in seen:
                seen.add(shard)
                yield shard
                if len(seen) == len(self.loads):
                    return

    def whole(self, place: int, size: int) -> int:
        """The first shard clockwise with room for all of it; if there is none, the least loaded."""
        for shard in self._clockwise(place):
            if self.loads[shard] + size <= self.bound:
                break
        else:
            shard = min(self._clockwise(place), key=self.loads.__getitem__)
        self.loads[shard] += size
        return shard

    def parts(self, place: int, size: int) -> list[tuple[int, int]]:
        """(first byte, shard) of the parts of a place's load, each filling a shard on the way."""
        out, done = [], 0
        for shard in self._clockwise(place):
            room = self.bound - self.loads[shard]
            if room > 0:
                out.append((done, shard))
                taken = min(room, size - done)
                self.loads[shard] += taken
                done += taken
                if done == size:
                    return out
        shard = min(range(len(self.loads)), key=self.loads.__getitem__)
        self.loads[shard] += size - done
        return [*out, (done, shard)]


def _listed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table from driver values, as a literal that any executor can rebuild."""
    names = [part.split()[0] for part in schema.split(",")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{', '.join(': '.join(p.split()) for p in schema.split(','))}>>")))


def shard_documents(docs: DataFrame, ring: Ring = Ring(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Size is the text's UTF-8 bytes and 8 more; the law is ``bytes``: no shard's bytes exceed the mean by more than the
    slack and about one percent (or one document that is larger than that). Slots number a shard's documents without
    gaps. A document's place comes from its id; rows with equal or null ids share a place, and a place that is too much for its
    shard is cut between rows, so a hot id is spread. A null or empty text counts 8 bytes and has checksum 0.
    Repeated rows are placed each by itself; an empty table gives none; other columns are left out.

    Texts are read once and never shuffled. Tasks see at most a 1,024th of a shard (or of a cut place) at once.
    """
    spark = docs.sparkSession
    body = F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")
    place = F.shiftrightunsigned(F.xxhash64(F.lit(ring.bits), F.col(f"`{id_column}`")), 64 - ring.bits)
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        place.cast("int").alias("place"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialise(rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(_SALTS)).cast("int")), "shard-rows").df
    total = int(rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    least = int(total * ring.large / ring.shards) + 1
    settled = Settlement(ring, total)
    large = rows.filter(F.col("size") >= least).select("row", "place", "size").collect()
    alone = [(r["row"], settled.whole(r["place"], r["size"])) for r in sorted(large, key=lambda r: (-r["size"], r["place"], r["row"]))]
    sums = rows.filter(F.col("size") < least).groupBy("place").agg(F.sum("size").alias("size")).collect()
    kept, cut = [], []
    for r in sorted(sums):
        parts = settled.parts(r["place"], r["size"])
        if len(parts) == 1:
            kept.append((r["place"], parts[0][1]))
        else:
            ends = [*(first for first, _ in parts[1:]), None]
            cut += [(r["place"], first, end if end is not None else (1 << 62), s) for (first, s), end in zip(parts, ends, strict=True)]
    by_row = F.broadcast(_listed(spark, alone, "row bigint, alone_shard int"))
    by_place = F.broadcast(_listed(spark, kept, "place int, kept_shard int"))
    by_part = F.broadcast(_listed(spark, cut, "place int, first bigint, beyond bigint, shard int"))
    named = rows.join(by_row, "row", "left").join(by_place, "place", "left")
    shard = F.coalesce("alone_shard", "kept_shard")
    done = named.filter(shard.isNotNull()).withColumn("shard", shard)
    if cut:
        split = named.filter(shard.isNull())
        sizes = split.groupBy("place", "salt").agg(F.sum("size").alias("held"))
        ahead = Window.partitionBy("place").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.withColumn("ahead", F.coalesce(F.sum("held").over(ahead), F.lit(0))).drop("held")
        inside = Window.partitionBy("place", "salt").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
        split = split.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(sizes, ["place", "salt"])
        at = F.col("ahead") + F.col("inside")
        split = split.withColumn("at", at).join(by_part, "place").filter("at >= first AND at < beyond")
        done = done.select("doc_id", "size", "text_crc32", "shard", "salt", "row").unionByName(
            split.select("doc_id", "size", "text_crc32", "shard", "salt", "row")
        )
    done = done.select("doc_id", "size", "text_crc32", "shard", "salt", "row")
    counts = done.groupBy("shard", "salt").agg(F.count(F.lit(1)).alias("rows"))
    ahead = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("ahead", F.coalesce(F.sum("rows").over(ahead), F.lit(0))).drop("rows")
    inside = Window.partitionBy("shard", "salt").orderBy("row")
    placed = done.withColumn("inside", F.row_number().over(inside) - 1).join(counts, ["shard", "salt"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("ahead") + F.col("inside")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

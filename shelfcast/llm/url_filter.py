"""Host and path rules by Bloom filter cascades.

A cascade answers exactly whether a key is listed, for every key of a known universe. Level 1 is a Bloom filter of the
listed keys; level 2 holds the unlisted keys of the universe that level 1 lets through; level 3 the listed keys that level 2 wrongly
lets through, and so on until nothing is wrong. Rows are then judged by a few bit lookups each, without a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.queues import fresh
from shelfcast.session import materialise

#: A level's bits travel with the query; beyond this many bytes a list is refused, not broadcast.
MAX_LEVEL_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the host, its subdomains, and paths that begin with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


def parse_rules(block: Iterable[str], allow: Iterable[str]) -> list[Rule]:
    """Rules from texts like ``example.net/en/``: the host up to the first slash, then the path."""
    out = []
    for verdict, texts in (("block", block), ("allow", allow)):
        for text in texts:
            host, slash, path = text.partition("/")
            out.append(Rule(host.lower(), slash + path, verdict))
    if len({r.key for r in out}) != len(out):
        raise ValueError("a rule is listed twice")
    return out


@dataclass(frozen=True)
class Level:
    salt: int
    words: int
    hashes: int
    table: DataFrame

    def holds(self, key: Column) -> Column:
        """Whether all the key's bits are set; the bits are one array, made once per query."""
        bits = self.table.scalar()
        return reduce(
            lambda a, b: a & b,
            [F.getbit(F.element_at(bits, (p / 64).cast("int") + 1), (p % 64).cast("int")) == 1 for p in _positions(key, self.salt, self.words, self.hashes)],
        )


def _positions(key: Column, salt: int, words: int, hashes: int) -> list[Column]:
    """Bit positions by double hashing, other ones at every level; 32-bit halves keep the sums whole."""
    first = F.pmod(F.xxhash64(F.lit(2 * salt), key), F.lit(1 << 31))
    step = F.pmod(F.xxhash64(F.lit(2 * salt + 1), key), F.lit(1 << 31)) * 2 + 1
    return [F.pmod(first + step * k, F.lit(words * 64)) for k in range(hashes)]


def _level(keys: DataFrame, salt: int, count: int, fpr: float) -> Level:
    """A Bloom filter of ``keys`` (column ``key``), at least one word of 64 bits."""
    bits = max(64, math.ceil(max(1, count) * -math.log(fpr) / math.log(2) ** 2))
    words = -(-bits // 64)
    if words * 8 > MAX_LEVEL_BYTES:
        raise ValueError(f"a filter level of {words * 8} bytes is too large to go with the query")
    hashes = max(1, min(16, round(-math.log2(fpr))))
    spark = keys.sparkSession
    places = F.array(*_positions(F.col("key"), salt, words, hashes))
    set_bits = keys.select(F.explode(places).alias("at")).groupBy((F.col("at") / 64).cast("long").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS int))")).alias("bits")
    )
    filled = spark.range(words).withColumnRenamed("id", "word").join(set_bits, "word", "left")
    pairs = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    row = materialise(filled.agg(F.transform(pairs, lambda x: x["bits"]).alias("bits")), "filter").df
    return Level(salt, words, hashes, row)


class Cascade:
    """Exact membership of ``listed`` (column ``key``) among all keys of ``universe`` (column ``key``)."""

    def __init__(self, listed: DataFrame, universe: DataFrame):
        listed = materialise(listed.select("key").dropna().distinct(), "listed")
        total = universe.count()
        self.levels: list[Level] = []
        inside, count, outside = listed.df, listed.rows, None
        # The first level lets about as many strangers through as there are listed keys; later levels halve what is wrong.
        fpr = min(0.5, max(2.0**-16, listed.rows / (math.sqrt(2) * max(1, total))))
        if not listed.rows:
            return
        while True:
            level = _level(inside, len(self.levels), count, fpr)
            self.levels.append(level)
            fpr = 0.5
            if outside is None:  # level 1: all unlisted keys of the corpus
                others = universe.filter(level.holds(F.col("key"))).distinct().join(inside, "key", "left_anti")
            else:
                others = outside.filter(level.holds(F.col("key")))
            wrong = materialise(others.select("key"), "wrong")
            if not wrong.rows:
                return
            if len(self.levels) > 64:
                raise RuntimeError("the cascade does not end")
            inside, count, outside = wrong.df, wrong.rows, inside

    def holds(self, key: Column) -> Column:
        """Whether the key is listed (right for all keys of the universe)."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels) - 1, -1, -1):
            # Passing level k means what the levels above say; not passing an odd level means unlisted.
            answer = F.when(self.levels[k].holds(key), answer).otherwise(F.lit(k % 2 == 1))
        return F.coalesce(answer, F.lit(False))


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/ ? #``, A-Z in lower case; then up to ``?`` or ``#``; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), upper, lower)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    listed_hosts: DataFrame | Iterable[str] = (),
    default: str = "allow",
    url: str = "url",
) -> DataFrame:
    """Every row with ``host, path, rule, verdict``.

    A rule fits if its host is the url's host or a parent domain of it and its path begins the url's path; of the rules
    that fit, the longest wins (by characters; then the longer host). Where none fits, the url is blocked if its host or a parent domain is
    among ``listed_hosts``, else it has the default verdict. Both memberships come from cascades over all keys that occur in
    ``pages``: for each url the ends of its host and beginnings of its path as long as some listed key's.

    A null url and one without ``://`` have empty host and path, which no rule fits. Repeated rows are judged each by itself; an
    empty table gives an empty table; other columns pass through; added names that are taken get an underscore.
    """
    spark = pages.sparkSession
    names = fresh(pages.columns, "host", "path", "rule", "verdict")
    host_name, path_name, rule_name, verdict_name = names
    address = F.col(f"`{url}`").cast("string")
    (raw,) = fresh([*pages.columns, *names], "url_text")
    staged = pages.withColumn(raw, address)
    host, path = split_url(F.col(raw))
    staged = staged.withColumns({host_name: host, path_name: path}).drop(raw)
    host, path = F.col(host_name), F.col(path_name)

    hosts = listed_hosts if isinstance(listed_hosts, DataFrame) else _texts(spark, [h.lower() for h in listed_hosts])
    hosts = materialise(hosts.toDF("key"), "hosts")
    depths = [r[0] for r in hosts.df.select(F.size(F.split("key", r"\.")).alias("n")).distinct().orderBy("n").collect()]
    ends = {d: _end(host, d) for d in depths}
    shapes = sorted({(r.host.count(".") + 1, len(r.path)) for r in rules})
    keys = {s: F.concat(_end(host, s[0]), _begin(path, s[1])) for s in shapes}

    def universe(columns: list[Column]) -> DataFrame:
        if not columns:
            return _texts(spark, []).toDF("key")
        return staged.select(F.explode(F.array(*columns)).alias("key")).dropna()

    of_rules = universe(list(keys.values()))
    cascades = {v: Cascade(_texts(spark, [r.key for r in rules if r.verdict == v]).toDF("key"), of_rules) for v in ("block", "allow")}
    of_hosts = Cascade(hosts.df, universe(list(ends.values())))
    hits = []
    for shape, key in keys.items():
        for verdict, cascade in cascades.items():
            if any((r.host.count(".") + 1, len(r.path)) == shape and r.verdict == verdict for r in rules):
                hit = F.struct(F.length(key).alias("size"), F.length(_end(host, shape[0])).alias("host"), key.alias("rule"), F.lit(verdict).alias("verdict"))
                hits.append(F.when(key.isNotNull() & cascade.holds(key), hit))
    best = F.greatest(*hits, F.lit(None).cast("struct<size:int,host:int,rule:string,verdict:string>")) if hits else None
    (won,) = fresh(staged.columns, "best_rule")
    if best is not None:
        staged = staged.withColumn(won, best)
        rule, verdict = F.col(won)["rule"], F.col(won)["verdict"]
    else:
        rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    listed = reduce(lambda a, b: a | b, [e.isNotNull() & of_hosts.holds(e) for e in ends.values()], F.lit(False))
    out = staged.withColumns({rule_name: rule, verdict_name: F.coalesce(verdict, F.when(listed, "block").otherwise(default))})
    return out.drop(won)


def _end(host: Column, labels: int) -> Column:
    """The last ``labels`` labels of a host; null if it has fewer or is empty."""
    enough = (F.length(host) - F.length(F.translate(host, ".", ""))) >= labels - 1
    return F.when((host != "") & enough, F.substring_index(host, ".", -labels))


def _begin(path: Column, size: int) -> Column:
    return F.when(F.length(path) >= size, F.substring(path, 1, size))


def _texts(spark: SparkSession, values: list[str]) -> DataFrame:
    """A column of listed texts."""
    if not values:
        return spark.range(0).select(F.lit("").alias("key"))
    return spark.range(1).select(F.explode(F.array(*map(F.lit, values))).alias("key"))

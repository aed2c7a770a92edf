"""The prefix trie of conversations against one that counts every prefix of every conversation."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfcast.llm.prefix_trie import TernaryTree, family_trie, median_order
from shelfcast.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows, family=20):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def brute(rows, family=20):
    convs = rebuilt(rows, family)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own) - 1) * words
    return Counter(
        (min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(own) if len(convs[c]) == len(p)).encode()).hexdigest())
        for p, own in members.items()
    )


def nodes(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def talk(seed, convs=60, longest=9, said=3):
    """Conversations that share openings, whole copies among them."""
    rng, rows, made = random.Random(seed), [], {}
    for c in rng.sample(range(-30, 400), convs):
        made[c] = list(made[rng.choice(list(made))]) if made and rng.random() < 0.4 else []
        del made[c][rng.randrange(0, len(made[c]) + 1) + 2 :]
        while len(made[c]) < rng.randrange(1, longest):
            made[c].append((rng.choice(["user", "bot"]), " ".join(["word"] * rng.randrange(said))))
        rows += [(c, t, *x) for t, x in enumerate(made[c])]
    rng.shuffle(rows)
    return rows


def test_tree_and_median_order():
    assert sorted(median_order(9)) == list(range(9)) and next(median_order(9)) == 4
    tree = TernaryTree()
    sequences = [[i, j] for i in range(31) for j in range(3)]
    for k in median_order(len(sequences)):
        tree.insert(sequences[k])
    assert len(tree) == 1 + 31 + 93

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.down[0]) <= 7  # 31 siblings
    assert tree.insert([4, 1]) == tree.insert([4, 1]) and all(u < n for n, u in enumerate(tree.up))


@pytest.mark.parametrize(("segment", "shard"), [(64, 4096), (2, 3), (3, 1)])
def test_any_cut_gives_the_same_nodes(spark, segment, shard):
    rows = talk(segment)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert nodes(family_trie(df, segment_turns=segment, shard_rows=shard)) == brute(rows)


def test_query_matches_sql_and_brute_force(spark, tiny):
    got = nodes(QUERIES["op13_prefix_trie"](spark, tiny))
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tiny}/conversations.parquet'")
    assert got == Counter(connection.sql(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op13_prefix_trie']})").fetchall())
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == brute(rows)


def test_hot_first_turn_and_a_very_long_conversation(spark):
    rows = [(c, 0, "user", "hello there") for c in range(1000, 1400)] + [(c, 1, "bot", f"reply {c % 7}") for c in range(1000, 1400, 3)]
    rows += [(c, t, "user", f"turn {t}") for c in (1, 2, 21) for t in range(700)] + [(2, 700, "user", "one more")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert nodes(family_trie(df, shard_rows=50)) == brute(rows)


def test_awkward_turns(spark):
    rows = [
        (None, 0, "user", "x"), (7, None, "user", "first"), (7, 0, None, None), (7, 0, "", ""), (7, 1, "user", "same"), (7, 1, "user", "same"),
        (0, 3, "user", "b"), (0, 1, "user", "a"), (40, 0, "user", None), (5, 0, "ab", "c"), (6, 0, "a", "bc"), (5, 2, "x", " \t "), (8, 1, "u", "w " * 5000),
    ] + [(11, 4, "user", "again")] * 30
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"code": F.lit("clash"), "pos": F.lit(1)}).repartition(3)
    assert nodes(family_trie(df, segment_turns=4)) == brute(rows)
    assert family_trie(df.limit(0)).count() == 0
    (root,) = family_trie(spark.createDataFrame([(3, 0, "a", "b")], SCHEMA)).filter("depth = 0").collect()
    assert root["n_convs"] == 1 and root["parent_conv_id"] is None

"""Prefix trie of conversations: ternary search trees over coded turns, one per range shard, and their boundary nodes merged.

Turns are coded by a dictionary. A conversation is the sequence of its codes, cut into segments of a fixed number of turns;
a segment belongs to the trie of the prefix before it. Segments are range-partitioned by (prefix, codes), so a shard holds a
stretch of neighbouring sequences. It inserts them into a ternary search tree, medians first, so that the siblings of every node
form a balanced tree. Only nodes on the first and the last path of a shard can go on in other shards. They leave as partial sums and are
merged; all other nodes are final where they are built.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.joins import attach
from shelfcast.operators.order_stats import ordered_counts, running_totals
from shelfcast.session import materialise

SEGMENT_TURNS = 64
#: Sequences of one shard; a partition holds as many shards as it needs.
SHARD_ROWS = 4096
NO_MEMBERS = hashlib.sha256(b"").hexdigest()
_LANES = 4


# ---- turns in order, coded ------------------------------------------------------------------------------------


def coded_turns(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text"
) -> DataFrame:
    """``conv, pos, turns, code, words``: every turn with its place from 0, the turns of its conversation, its code and its words.

    Turns are ordered by turn number, null first, and where numbers are equal by a digest of speaker and text. Equal (speaker, text)
    have equal codes; null counts as empty. Places come from range-partitioned running counts, so no conversation has to fit in one
    task. Repeated rows are turns of their own. Rows without a conversation id are left out.
    """
    who, said = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (speaker, text))
    words = F.size(F.array_remove(F.split(said, r"[\x20\x09-\x0D]+"), ""))
    rows = turns.filter(F.col(f"`{conversation}`").isNotNull()).select(
        F.col(f"`{conversation}`").cast("long").alias("conv"),
        F.struct(
            F.col(f"`{turn}`").cast("long").alias("turn"),
            F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256).alias("digest"),
        ).alias("at"),
        words.alias("words"),
    )
    rows = materialise(rows, "turns").df
    found = rows.groupBy("at.digest").agg(F.first("words").alias("words"))
    codes = materialise(found.withColumn("code", F.monotonically_increasing_id()), "turn-codes")
    placed = ordered_counts(rows.select("conv", "at"), ["conv"], "at").select(
        "conv",
        F.col("at.digest").alias("digest"),
        F.explode(F.sequence(F.col("_before"), F.col("_before") + F.col("_n") - 1)).alias("pos"),
        F.col("_total").cast("long").alias("turns"),
    )
    return materialise(attach(placed, codes, ["digest"]).select("conv", "pos", "turns", "code", "words"), "coded-turns").df


def as_families(turns: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Coded turns of conversations that open as the first of their family does, and all conversations (``conv, turns``).

    Conversation c takes the first h turns of conversation c - c % family in place of its own first h, where h is crc32 of its decimal
    id, modulo ``most``. If that one has fewer, all of them are taken; if it does not exist, none.
    """
    convs = turns.groupBy("conv").agg(F.first("turns").alias("turns"))
    convs = convs.withColumns({"base": F.col("conv") - F.col("conv") % family, "h": F.crc32(F.col("conv").cast("string").cast("binary")) % most})
    convs = materialise(convs, "conversations").df
    heads = convs.select(F.col("conv").alias("base"), F.col("turns").alias("base_turns"))
    taken = F.least("h", F.coalesce("base_turns", F.lit(0).cast("long")))
    convs = materialise(convs.join(heads, "base", "left").withColumn("taken", taken).drop("base_turns"), "conversations")
    own = attach(turns.drop("turns"), materialise(convs.df.select("conv", "h", "taken")), ["conv"]).filter("pos >= h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "code", "words")
    opening = turns.filter(F.col("pos") < most - 1).select(F.col("conv").alias("base"), "pos", "code", "words")
    opening = opening.join(convs.df.select("conv", "base", "taken"), "base").filter("pos < taken").select("conv", "pos", "code", "words")
    length = F.col("taken") + F.greatest(F.col("turns") - F.col("h"), F.lit(0).cast("long"))
    return own.unionByName(opening), convs.df.select("conv", length.alias("turns"))


# ---- segments ---------------------------------------------------------------------------------------------------


def _segments(turns: DataFrame, convs: DataFrame, size: int) -> DataFrame:
    """``conv, seg, codes, words, ends``: the conversations in pieces of ``size`` turns; one without turns is an empty piece."""
    seg = F.floor(F.col("pos") / size).cast("long")
    cells = F.array_sort(F.collect_list(F.struct("pos", "code", "words")))
    pieces = turns.withColumn("seg", seg).groupBy("conv", "seg").agg(cells.alias("cells"))
    pieces = pieces.select("conv", "seg", F.col("cells.code").alias("codes"), F.col("cells.words").cast("array<long>").alias("words"))
    last = convs.select("conv", F.floor(F.greatest(F.col("turns") - 1, F.lit(0).cast("long")) / size).cast("long").alias("last"))
    empty = F.array().cast("array<long>")
    bare = convs.filter("turns = 0").select("conv", F.lit(0).cast("long").alias("seg"), empty.alias("codes"), empty.alias("words"))
    return attach(pieces.unionByName(bare), materialise(last), ["conv"]).withColumn("ends", F.col("seg") == F.col("last")).drop("last")


def _with_prefixes(pieces: DataFrame, size: int) -> DataFrame:
    """Adds ``start`` and ``beyond``, names of the prefixes before and after a full piece, and ``lone, lone_next, first_lone``.

    A name is the sums, in four lanes, of hashes of (place, codes) of all pieces before, which range-partitioned running totals
    give. A piece is lone if no other conversation has its prefix; from there on it is a chain that needs no trie.
    """
    lanes = {f"lane{k}": F.shiftrightunsigned(F.xxhash64(F.lit(k), "seg", "codes"), 24) for k in range(_LANES)}
    hashed = materialise(pieces.withColumns(lanes), "pieces").df
    before = running_totals(hashed, ["conv"], ["seg"], {f"sum{k}": f"lane{k}" for k in range(_LANES)})

    def name(sums: list[Column]) -> Column:
        return F.concat_ws("-", *(F.hex(s) for s in sums))

    named = before.withColumns(
        {
            "start": F.when(F.col("seg") == 0, F.lit("")).otherwise(name([F.col(f"sum{k}") for k in range(_LANES)])),
            "beyond": F.when(F.size("codes") == size, name([F.col(f"sum{k}") + F.col(f"lane{k}") for k in range(_LANES)])),
        }
    ).drop(*lanes, *(f"sum{k}" for k in range(_LANES)))
    named = materialise(named, "named-pieces").df
    tails = named.filter("seg > 0")
    single = tails.groupBy("seg", "start").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).filter("n = 1")
    single = materialise(single.select("conv", "seg"), "lone-pieces").df
    from_seg = materialise(single.groupBy("conv").agg(F.min("seg").alias("from_seg")), "lone-tails")
    return attach(named, from_seg, ["conv"]).select(
        "*",
        F.coalesce(F.col("seg") >= F.col("from_seg"), F.lit(False)).alias("lone"),
        F.coalesce(F.col("seg") + 1 == F.col("from_seg"), F.lit(False)).alias("lone_next"),
    ).drop("from_seg")


# ---- one shard --------------------------------------------------------------------------------------------------


def median_order(n: int) -> Iterator[int]:
    """0 to n - 1 so that every stretch's median comes before the rest of the stretch."""
    stretches = [(0, n)]
    while stretches:
        low, high = stretches.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            stretches += [(middle + 1, high), (low, middle)]


class TernaryTree:
    """A trie whose siblings are linked as binary search trees (``low``, ``high``); ``down`` is the tree of a node's children.

    Node 0 is the root of the trie. A node's number is larger than its parent's.
    """

    def __init__(self):
        self.code, self.low, self.high, self.down, self.up, self.depth = [-1], [-1], [-1], [-1], [-1], [0]

    def insert(self, codes: list[int]) -> list[int]:
        """Nodes on the path of a sequence, the root first."""
        path, at = [0], 0
        for code in codes:
            node, last, side = self.down[at], at, self.down
            while node >= 0 and self.code[node] != code:
                last, side = node, self.low if code < self.code[node] else self.high
                node = side[node]
            if node < 0:
                node = len(self.code)
                side[last] = node
                self.code.append(code)
                self.depth.append(self.depth[at] + 1)
                self.up.append(at)
                for links in (self.low, self.high, self.down):
                    links.append(-1)
            path.append(node)
            at = node
        return path

    def __len__(self) -> int:
        return len(self.code)


_NODE_SCHEMA = (
    "seg long, start string, path array<long>, up_seg long, up_start string, up_path array<long>, depth long, conv long, "
    "parent long, n_convs long, n_children long, n_leaves long, saved long, words long, ends string, part long, shard long"
)
_NODE_TYPES = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
_NODE = pa.schema([(n, _NODE_TYPES[t]) for n, t in (c.split(" ") for c in _NODE_SCHEMA.split(", "))])


def _shard_nodes(rows: list[dict], size: int, part: int, shard: int) -> list[dict]:
    """Nodes of the trie of one prefix, from sorted pieces: final ones, and partial ones (with ``path``) on the boundary.

    Of a partial node, children, leaves and savings count what hangs on it by final children.
    """
    groups: list[list[dict]] = []
    for r in rows:
        if groups and groups[-1][0]["codes"] == r["codes"]:
            groups[-1].append(r)
        else:
            groups.append([r])
    seg, start = rows[0]["seg"], rows[0]["start"]
    tree, open_nodes, ends, words, chained, beyond, open_path = TernaryTree(), {0}, {}, {0: 0}, set(), {}, {0: []}
    for k in median_order(len(groups)):
        group, codes = groups[k], groups[k][0]["codes"]
        path = tree.insert(codes)
        words.update(zip(path[1:], group[0]["words"], strict=True))
        ends[path[-1]] = [r["conv"] for r in group]
        if any(r["lone_next"] for r in group):
            chained.add(path[-1])
        shared_next = any(not r["ends"] and not r["lone_next"] for r in group)
        if len(codes) == size and group[0]["beyond"] is not None:
            beyond[path[-1]] = group[0]["beyond"]
        if k in (0, len(groups) - 1) or shared_next:
            open_nodes.update(path)
            open_path.update((node, codes[:d]) for d, node in enumerate(path))
    ending = {path: [r for r in convs] for path, convs in ends.items()}
    finished = {r["conv"] for g in groups for r in g if r["ends"]}
    n = len(tree)
    members, least, children, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    for node in reversed(range(n)):  # children before parents
        own = ends.get(node, ())
        members[node] += len(own)
        if own and (least[node] is None or own[0] < least[node]):
            least[node] = own[0]
        if node in chained:
            children[node] += 1
            leaves[node] += 1
        up = tree.up[node]
        if node not in open_nodes:
            leaves[node] = leaves[node] or 1
            saved[node] += (members[node] - 1) * words[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
        if node:
            members[up] += members[node]
            if least[up] is None or least[node] < least[up]:
                least[up] = least[node]
    out = []
    for node in range(n):
        closing = ",".join(str(c) for c in ending.get(node, ()) if c in finished)
        row = dict.fromkeys(_NODE.names) | {
            "depth": seg * size + tree.depth[node], "conv": least[node], "n_convs": members[node], "n_children": children[node],
            "n_leaves": leaves[node], "saved": saved[node], "words": words[node], "part": part, "shard": shard,
        }
        up = tree.up[node]
        if node and up in open_nodes:
            row |= {"up_seg": seg, "up_start": start, "up_path": open_path[up]}
        if node not in open_nodes:
            row |= {"ends": hashlib.sha256(closing.encode()).hexdigest(), "parent": least[up]}
        else:
            row |= {"seg": seg, "start": start, "path": open_path[node], "ends": closing}
            if node in beyond:  # the root of the next pieces' trie
                row |= {"seg": seg + 1, "start": beyond[node], "path": []}
            if seg and not node:  # its members are counted as the end of the pieces before
                row |= {"n_convs": 0, "conv": None, "words": None, "ends": ""}
        out.append(row)
    return out


def _build(pieces: DataFrame, size: int, shard_rows: int) -> DataFrame:
    """Nodes of all tries, final and partial."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, shard
            at = 0
            while at < len(held):
                end = at
                while end < len(held) and (held[end]["seg"], held[end]["start"]) == (held[at]["seg"], held[at]["start"]):
                    end += 1
                nodes = _shard_nodes(held[at:end], size, held[at]["part"], shard)
                for k in range(0, len(nodes), 8192):
                    yield pa.RecordBatch.from_pylist(nodes[k : k + 8192], schema=_NODE)
                shard, at = shard + 1, end
            held = []

        for batch in batches:
            for r in batch.to_pylist():
                held.append(r)
                if len(held) >= shard_rows:
                    yield from flush()
        yield from flush()

    keys = ["seg", "start", "codes", "conv"]
    placed = pieces.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id().cast("long"))
    return placed.mapInArrow(work, _NODE_SCHEMA)


# ---- merging ------------------------------------------------------------------------------------------------------

_KEY = ["seg", "start", "path"]
_UP = ["up_seg", "up_start", "up_path"]


def _digests(parts: DataFrame) -> DataFrame:
    """``seg, start, path, ends_sha256`` of the members that end at partial nodes, read in order and never held together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def done() -> pa.RecordBatch:
            row = dict(zip(_KEY, key, strict=True)) | {"ends_sha256": state.hexdigest()}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([*(_NODE.field(c) for c in _KEY), ("ends_sha256", pa.string())]))

        for batch in batches:
            for r in batch.to_pylist():
                own = (r["seg"], r["start"], r["path"])
                if own != key:
                    if key is not None:
                        yield done()
                    key, state = own, hashlib.sha256()
                    state.update(r["ends"].encode())
                else:
                    state.update(b"," + r["ends"].encode())
        if key is not None:
            yield done()

    near = parts.filter("ends <> ''").select(*_KEY, "part", "shard", "ends")
    near = near.repartition(*_KEY).sortWithinPartitions(*_KEY, "part", "shard")
    return near.mapInArrow(work, "seg long, start string, path array<long>, ends_sha256 string")


def _totals(own: DataFrame, deepest: int) -> DataFrame:
    """``seg, start, path, n_leaves, saved`` of partial nodes: their own and those of all partial nodes below, deepest pieces first."""
    out, carried = None, None
    for seg in range(deepest, -1, -1):
        here = own.filter(F.col("seg") == seg).select("start", "path", "own_leaves", "own_saved")
        if carried is not None:
            here = here.unionByName(carried)
        steps = here.withColumn("k", F.explode(F.sequence(F.lit(0), F.size("path")))).withColumn("path", F.slice("path", F.lit(1), F.col("k")))
        sums = steps.groupBy("start", "path").agg(F.sum("own_leaves").alias("n_leaves"), F.sum("own_saved").alias("saved"))
        sums = sums.withColumn("seg", F.lit(seg).cast("long"))
        if seg:
            sums = materialise(sums, "trie-sums").df
            ways = own.filter((F.col("seg") == seg) & (F.size("path") == 0)).select("start", *_UP)
            carried = sums.filter(F.size("path") == 0).join(ways, "start")
            carried = carried.select(F.col("up_start").alias("start"), F.col("up_path").alias("path"), F.col("n_leaves").alias("own_leaves"), F.col("saved").alias("own_saved"))
        out = sums if out is None else out.unionByName(sums)
    return out


def prefix_trie(turns: DataFrame, convs: DataFrame, segment_turns: int = SEGMENT_TURNS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Nodes of the trie of coded turns (``conv, pos, code, words``) of the conversations ``convs`` (``conv, turns``).

    Returns ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``, one row per distinct
    sequence of first turns; the root, of depth 0, has all conversations, also those without turns. ``saved_tokens`` sums (members - 1) * words
    over the node and all below; ``ends_sha256`` is SHA-256 of the ids of the members that end there, rising, with commas.

    Conversations of any length are cut into pieces, and members that are alone from some piece on become chains without a trie. A task holds one
    shard of ``shard_rows`` pieces. The number of jobs grows with the longest prefix, in pieces, that two conversations share. The members that end
    at one node are hashed in one task, since the digest is sequential, but are streamed. An empty table has no nodes.
    """
    pieces = _segments(turns, convs, segment_turns)
    longest = convs.agg(F.max("turns")).first()[0]
    cut = (longest or 0) > segment_turns
    no = F.lit(False)
    if cut:
        pieces = materialise(_with_prefixes(pieces, segment_turns), "trie-pieces").df
        owners = pieces.filter("beyond IS NOT NULL").groupBy((F.col("seg") + 1).alias("seg"), F.col("beyond").alias("start")).agg(F.min("conv").alias("owner"))
        tails = pieces.filter("lone").join(owners, ["seg", "start"])
        pieces = pieces.filter("NOT lone").drop("lone")
    else:
        pieces = pieces.withColumns({"start": F.lit(""), "beyond": F.lit(None).cast("string"), "lone_next": no})
    nodes = materialise(_build(pieces, segment_turns, shard_rows), "trie-nodes").df
    final = nodes.filter("path IS NULL")
    partial = nodes.filter("path IS NOT NULL")
    merged = partial.groupBy(*_KEY).agg(
        F.max("depth").alias("depth"),
        F.min("conv").alias("conv"),
        F.max("words").alias("words"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
        F.max(F.when(F.col("up_path").isNotNull(), F.struct(*_UP))).alias("up"),
    )
    merged = materialise(merged.select("*", "up.*").drop("up"), "trie-boundary").df
    kids = merged.groupBy(*_UP).agg(F.count(F.lit(1)).alias("open_children")).toDF(*_KEY, "open_children").filter("path IS NOT NULL")
    merged = merged.join(kids, _KEY, "left").withColumn("n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0)))
    merged = merged.withColumns(
        {
            "own_leaves": F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("long"),
            "own_saved": F.col("saved") + (F.col("n_convs") - 1) * F.coalesce("words", F.lit(0)),
        }
    ).drop("n_leaves", "saved", "open_children")
    merged = materialise(merged, "trie-boundary").df
    deepest = merged.agg(F.max("seg")).first()[0]
    names = materialise(merged.select(F.col("seg").alias("up_seg"), F.col("start").alias("up_start"), F.col("path").alias("up_path"), F.col("conv").alias("parent")), "trie-parents")
    boundary = merged.join(_totals(merged, deepest or 0), _KEY).join(_digests(partial), _KEY, "left")
    boundary = attach(boundary, names, _UP)
    under = attach(final.filter("up_path IS NOT NULL").drop("parent"), names, _UP)
    whole = [
        final.filter("up_path IS NULL").withColumnRenamed("ends", "ends_sha256"),
        under.withColumnRenamed("ends", "ends_sha256"),
        boundary.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_MEMBERS))),
    ]
    if cut:
        whole.append(_chains(tails, segment_turns))
    parts = [
        df.select(
            F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
            F.col("saved").alias("saved_tokens"), "ends_sha256",
        )
        for df in whole
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _chains(tails: DataFrame, size: int) -> DataFrame:
    """Nodes of pieces that a conversation shares with no other; ``owner`` is the smallest member of the node that a piece hangs on."""
    one = F.lit(1).cast("long")
    rows = tails.select("conv", "owner", "seg", "ends", F.size("codes").alias("n"), F.explode(F.sequence(one, F.size("codes").cast("long"))).alias("k"))
    last = F.col("ends") & (F.col("k") == F.col("n"))
    return rows.select(
        "conv",
        (F.col("seg") * size + F.col("k")).alias("depth"),
        F.when(F.col("k") == 1, F.col("owner")).otherwise(F.col("conv")).alias("parent"),
        one.alias("n_convs"),
        F.when(last, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("n_children"),
        one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved"),
        F.when(last, F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(NO_MEMBERS)).alias("ends_sha256"),
    )


def family_trie(turns: DataFrame, family: int = 20, segment_turns: int = SEGMENT_TURNS, shard_rows: int = SHARD_ROWS, **names: str) -> DataFrame:
    """The prefix trie of conversations rebuilt as families (see ``as_families`` and ``prefix_trie``).

    Rows with a null conversation id are left out; null roles and texts are empty; null turns come first; equal turns are ordered by a digest;
    repeated rows are turns of their own; texts of any length count all their words. Other columns are left out, whatever their names.
    """
    rebuilt, convs = as_families(coded_turns(turns, **names), family)
    return prefix_trie(materialise(rebuilt, "rebuilt-turns").df, materialise(convs, "conversations").df, segment_turns, shard_rows)

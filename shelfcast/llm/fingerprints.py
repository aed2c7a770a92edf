"""Order MinHash fingerprints of texts, in DataFrame functions alone.

A text is the sequence of its k-mers (windows of k words; the last ones are cut short by the end), each numbered by how
often it occurred before. One hash places the numbered k-mers on a circle of 64-bit values. Every sketch has an anchor on
that circle and orders all k-mers by their distance clockwise from it; it selects the first few, puts them back
into the order of the text and hashes them as a tuple. Two texts agree in a sketch if the same k-mers were selected and
stand in the same order, so moved text counts as an edit. One sort serves all sketches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.queues import fresh
from shelfcast.operators.joins import attach
from shelfcast.operators.order_stats import ordered_counts
from shelfcast.session import materialise

_BLANKS = " \t\n\x0b\f\r"
_PLACE_BITS = 24
_PLACES = (1 << _PLACE_BITS) - 1


@dataclass(frozen=True)
class OrderRule:
    """Words per k-mer, k-mers per tuple, tuples (a power of two) per fingerprint."""

    words: int = 2
    selected: int = 2
    sketches: int = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _clear(x: Column) -> Column:
    return x.bitwiseAND(F.lit(~_PLACES).cast("long"))


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_PLACES).cast("long"))


def _kmers(text: Column, rule: OrderRule) -> Column:
    """Sorted longs: the upper bits are the k-mer's hash, the lower ones its place in the text."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")

    def one(w: Column, i: Column, all_words: Column) -> Column:
        rest = [F.get(all_words, i + k) for k in range(1, rule.words)]
        return F.shiftleft(F.xxhash64(w, *rest), _PLACE_BITS).bitwiseOR(_place(i.cast("long")))

    return F.sort_array(_let(words, lambda ws: F.transform(ws, lambda w, i: one(w, i, ws))))


def _numbered(kmers: Column) -> Column:
    """The sorted k-mers with the hash of every later occurrence replaced by one of hash and occurrence."""

    def again(x: Column, i: Column, xs: Column) -> Column:
        return (i > 0) & (_clear(x) == _clear(F.get(xs, i - 1)))

    def labelled(xs: Column, late: Column) -> Column:
        heads = F.filter(
            F.transform(late, lambda x, i: F.when((i > 0) & (_clear(x) == _clear(F.get(late, i - 1))), F.lit(-1)).otherwise(i)), lambda i: i >= 0
        )

        def runs(hs: Column) -> Column:
            ends = F.concat(F.slice(hs, F.lit(2), F.size(hs)), F.array(F.size(late)))
            return F.flatten(F.zip_with(hs, ends, lambda h, e: F.sequence(F.lit(1), e - h)))

        later = F.zip_with(late, _let(heads, runs), lambda x, n: _clear(F.xxhash64(_clear(x), n)).bitwiseOR(_place(x)))
        return F.sort_array(F.concat(F.filter(xs, lambda x, i: ~again(x, i, xs)), later))

    def number(xs: Column) -> Column:
        late = F.filter(xs, lambda x, i: again(x, i, xs))
        return _let(late, lambda l: F.when(F.size(l) == 0, xs).otherwise(labelled(xs, l)))

    return _let(kmers, number)


def _tuples(kmers: Column, rule: OrderRule) -> Column:
    """One 32-bit hash per sketch, from the sorted numbered k-mers."""
    shift = 64 - (rule.sketches.bit_length() - 1)
    half = rule.sketches // 2

    def cell(x: Column) -> Column:
        """Which stretch between two anchors a k-mer lies in; signed order is the order of the circle."""
        return F.shiftright(x, shift).cast("int") + half

    def firsts(xs: Column) -> Column:
        heads = F.filter(
            F.transform(xs, lambda x, i: F.when((i == 0) | (cell(x) != cell(F.get(xs, i - 1))), i).otherwise(F.lit(-1))), lambda i: i >= 0
        )

        def spread(hs: Column) -> Column:
            before = F.transform(hs, lambda h, j: F.when(j == 0, F.lit(-1)).otherwise(cell(F.get(xs, F.get(hs, j - 1)))))
            own = F.flatten(F.zip_with(hs, before, lambda h, b: F.array_repeat(h, cell(F.get(xs, h)) - b)))
            beyond = F.array_repeat(F.lit(0), F.lit(rule.sketches - 1) - cell(F.element_at(xs, -1)))
            return F.concat(own, beyond)

        return _let(heads, spread)

    def chosen(xs: Column, first: Column) -> Column:
        size = F.size(xs)
        own = [F.get(xs, (first + k) % size) for k in range(rule.selected)]
        if rule.selected == 2:
            a, b = own
            in_order = _place(a) <= _place(b)
            return F.hash(_clear(F.when(in_order, a).otherwise(b)), _clear(F.when(in_order, b).otherwise(a)))
        ordered = F.array_sort(F.array(*(F.struct(_place(x).alias("at"), _clear(x).alias("label")) for x in own)))
        return F.hash(F.transform(ordered, lambda x: x["label"]))

    def all_tuples(xs: Column) -> Column:
        some = F.transform(firsts(xs), lambda first: chosen(xs, first))
        return F.when(F.size(xs) == 0, F.array_repeat(F.lit(0), rule.sketches)).otherwise(some)

    return _let(kmers, all_tuples)


def order_sketches(text: Column, rule: OrderRule = OrderRule()) -> Column:
    """The sketches of a text as 32-bit integers; a text without words (or null) has only zeros.

    A text of fewer k-mers than a tuple takes repeats them. Places count modulo 2^24 words.
    """
    return _tuples(_numbered(_kmers(F.coalesce(text, F.lit("")), rule)), rule)


def sketch_text(sketches: Column) -> Column:
    """Sketches as eight hexadecimal digits each."""
    digits = F.transform(sketches, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column, rule: OrderRule = OrderRule()) -> Column:
    """Estimated share of k-mers that two texts have in common and in the same order, 0 to 1.

    A tuple agrees if all its k-mers do, so the share of tuples that agree is brought back by that root.
    """
    same = F.zip_with(a, b, lambda x, y: F.when(x == y, F.lit(1)).otherwise(F.lit(0)))
    share = F.aggregate(same, F.lit(0), lambda n, x: n + x) / F.lit(float(rule.sketches))
    return share if rule.selected == 1 else F.sqrt(share) if rule.selected == 2 else F.pow(share, F.lit(1.0 / rule.selected))


#: Rows that are put in order together; the most ranges of them, which bounds the table of edges that every task holds.
RANGE_ROWS, MOST_RANGES = 256, 1 << 16
#: Rows with equal id and text beyond this many are sent on as one row and a number.
_FEW_COPIES = 64


def _edges(keys: DataFrame, range_rows: int) -> Column:
    """First and last key of every range of neighbouring rows, as one sorted array (a scalar subquery)."""
    step = F.greatest(F.lit(range_rows), F.ceil(F.col("_total") / MOST_RANGES))
    ranges = keys.groupBy(F.floor(F.col("_before") / step)).agg(F.min("key").alias("first"), F.max("key").alias("last"))
    held = materialise(ranges.select("first", "last"), "text-ranges").df
    return held.agg(F.array_sort(F.collect_list(F.struct("first", "last")))).scalar()


def _range_of(key: Column, edges: Column) -> Column:
    """Place of the last range that begins at or before the key, by halving."""

    def halve(at: Column, edges: Column) -> Column:
        middle = F.shiftright(at["low"] + at["high"], 1)
        low = F.struct(middle.alias("low"), at["high"].alias("high"))
        high = F.struct(at["low"].alias("low"), middle.alias("high"))
        return F.when(F.get(edges, middle)["first"] <= key, low).otherwise(high)

    steps = F.sequence(F.lit(1), F.lit(MOST_RANGES.bit_length()))

    def search(edges: Column) -> Column:
        whole = F.struct(F.lit(0).alias("low"), F.size(edges).alias("high"))
        return F.aggregate(steps, whole, lambda at, _: halve(at, edges), lambda at: at["low"])

    return _let(edges, search)


def _with_next(rows: DataFrame, keys: DataFrame, range_rows: int) -> DataFrame:
    """``rows`` (key, text, sketches, copies) with the text and sketches of the next row by descending key, the first after the last.

    Rows are dealt to ranges of keys, so every text is shuffled once, and the last row of a range is
    also sent to the range above it. Of rows with equal keys the last in order is followed by another key.
    """
    edges = _edges(keys, range_rows)
    dealt = rows.withColumn("edges", edges).withColumn("range", _range_of(F.col("key"), F.col("edges")))
    last = F.get("edges", F.col("range"))["last"] == F.col("key")
    above = F.struct(((F.col("range") + 1) % F.size("edges")).alias("range"), F.lit(True).alias("guest"))
    home = F.struct("range", F.lit(False).alias("guest"))
    dealt = dealt.withColumn("seat", F.explode(F.when(last, F.array(home, above)).otherwise(F.array(home))))
    order = Window.partitionBy("range").orderBy(F.desc("guest"), "key")
    return (
        dealt.select("key", "text", "sketches", "copies", "seat.*")
        .withColumns({"next_text": F.lag("text").over(order), "next_sketches": F.lag("sketches").over(order)})
        .filter(~F.col("guest"))
    )


def fingerprints(
    docs: DataFrame, rule: OrderRule = OrderRule(), id_column: str = "doc_id", text: str = "text", range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Fingerprint of every text, and how far it tells an edited text and the next text apart.

    Returns ``doc_id, n_chars`` (code points), ``edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The edited text is
    the text with its last n_chars // 2 code points replaced by the first as many (or all) of the next document's text. The next
    document is the one with the next smaller id (null last), and after the last one the first; among equal ids texts stand
    in the order of a hash. ``near_...`` are likenesses of the fingerprint to those of the edited and of the next text.

    A null text is empty; a text without words has the fingerprint of zeros; a single character is its own edited text; a table of one
    row has itself as next document. Equal texts have equal fingerprints. Repeated rows are rows of their own: all but one of them are
    followed by an equal one. Texts of any length are used whole, and one text has to fit in a task. An empty table gives
    an empty table; other columns are left out.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.select(F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("key"), "text")
    keys = materialise(ordered_counts(rows.select("key"), [], "key"), "text-order").df
    copies = materialise(keys.filter(F.col("_n") > _FEW_COPIES).select("key", F.col("_n").alias("copies")), "text-copies")
    if copies.rows:
        rows = attach(rows, copies, ["key"])
        alone = rows.filter(F.col("copies").isNull()).select("key", "text", F.lit(1).cast("long").alias("copies"))
        rows = alone.unionByName(rows.dropna(subset=["copies"]).groupBy("key").agg(F.first("text").alias("text"), F.first("copies").alias("copies")))
    else:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    placed = _with_next(rows.withColumn("sketches", order_sketches(F.col("text"), rule)), keys, range_rows)
    if copies.rows:
        other = F.struct(F.lit(1).cast("long").alias("rows"), "next_text", "next_sketches")
        equal = F.struct((F.col("copies") - 1).alias("rows"), F.col("text").alias("next_text"), F.col("sketches").alias("next_sketches"))
        cases = F.filter(F.array(other, equal), lambda c: c["rows"] > 0)
        placed = placed.withColumn("case", F.explode(cases)).select("key", "text", "sketches", "case.*")
    else:
        placed = placed.withColumn("rows", F.lit(1).cast("long"))
    n_chars = F.length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = placed.withColumns(
        {"n_chars": n_chars.cast("long"), "edited": F.concat(F.left("text", n_chars - half), F.left("next_text", half))}
    ).withColumn("edited_sketches", order_sketches(F.col("edited"), rule))
    out = edited.select(
        "rows",
        F.col("key.doc_id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        sketch_text(F.col("sketches")).alias("fingerprint"),
        sketch_text(F.col("edited_sketches")).alias("edited_fingerprint"),
        likeness(F.col("sketches"), F.col("edited_sketches"), rule).alias("near_edited"),
        likeness(F.col("sketches"), F.col("next_sketches"), rule).alias("near_next"),
    )
    if copies.rows:
        out = _repeated(out)
    return out.drop("rows")


def _repeated(out: DataFrame, at_once: int = 4096) -> DataFrame:
    """Every row as often as ``rows`` says, the many copies of one row spread over the tasks."""
    shares = F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / at_once).cast("long"))
    spread = out.withColumn("share", F.explode(shares)).repartition(F.col("doc_id"), F.col("share"))
    own = F.least(F.lit(at_once).cast("long"), F.col("rows") - F.col("share") * at_once)
    return spread.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), own))).drop("share", "copy")

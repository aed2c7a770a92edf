"""Rows placed in source queues: which queue, and how much of the queue lies before each row.

A queue's order is the order of the written partitions and the rows inside them. Each task
counts as it goes, so no queue is ever gathered, and only one total per queue and
partition is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.joins import attach
from shelfcast.operators.order_stats import running_totals
from shelfcast.session import materialise

#: Names that are looked up in a map inside the plan; more are joined, with the same result.
MAP_NAMES = 512
_BLOCK = 1024


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, lengthened where a column is already called so (in any case)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def by_case(names: list[str], key: Column) -> Column:
    """Place of ``key`` among ``names``; the number of names for any other and for null."""
    if not names:
        return F.lit(0)
    places = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    return F.coalesce(places[key], F.lit(len(names)))


def source_names(docs: DataFrame, source: str) -> list[str]:
    """Names of all sources but null and empty, by name; the driver holds them all."""
    name = F.col(f"`{source}`").cast("string").alias("name")
    return sorted(r["name"] for r in docs.select(name).distinct().collect() if r["name"])


def with_queue(docs: DataFrame, names: list[str], source: str, queue: str) -> DataFrame:
    """``docs`` with the place of the source among ``names`` as ``queue``; the number of names for any other and for null."""
    key = F.col(f"`{source}`").cast("string")
    if len(names) <= MAP_NAMES:
        return docs.withColumn(queue, by_case(names, key).cast("int"))
    (name,) = fresh([*docs.columns, queue], "queue_name")
    places = pa.table({name: pa.array(names, pa.string()), queue: pa.array(range(len(names)), pa.int32())})
    found = attach(docs.withColumn(name, key), docs.sparkSession.createDataFrame(places), [name])
    place = F.coalesce(F.col(queue), F.lit(len(names))).cast("int")
    return found.select(*(F.col(f"`{c}`") for c in docs.columns), place.alias(queue))


def mixture_weights(docs: DataFrame, source: str, temperature: float) -> dict[str, float]:
    """Rows of each source to the power of ``temperature``; null and empty sources together under ``""``."""
    name = F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(""))
    sizes = docs.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("size"))
    return {r["name"]: float(r["size"]) ** temperature for r in sizes.collect()}


def offsets(placed: DataFrame, queue: str, part: str, amount: Column) -> DataFrame:
    """(queue, part, before): what the queue holds in earlier partitions.

    Totals are added up in blocks of 1,024 partitions and then over the blocks, so
    that no task sees more rows than one or the other.
    """
    totals = placed.groupBy(queue, part).agg(F.sum(amount).cast("long").alias("held"))
    totals = totals.withColumn("block", F.floor(F.col(part) / _BLOCK))
    blocks = totals.groupBy(queue, "block").agg(F.sum("held").alias("block_held"))
    earlier = Window.partitionBy(queue).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("block_before", F.coalesce(F.sum("block_held").over(earlier), F.lit(0)))
    inside = Window.partitionBy(queue, "block").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("inside", F.coalesce(F.sum("held").over(inside), F.lit(0)))
    return totals.join(blocks, [queue, "block"]).select(
        queue, part, (F.col("block_before") + F.col("inside")).alias("before")
    )


def with_offsets(placed: DataFrame, queue: str, part: str, amount: Column, name: str) -> DataFrame:
    """``placed`` with a column ``name``: what its queue holds in earlier partitions."""
    return attach(placed, offsets(placed, queue, part, amount).withColumnRenamed("before", name), [queue, part])


def queue_totals(placed: DataFrame, queue: str, amount: Column, queues: int) -> list[int]:
    """Total of each queue, on the driver: one number per queue."""
    found = {r[0]: r[1] for r in placed.groupBy(queue).agg(F.sum(amount).cast("long")).collect()}
    return [int(found.get(q) or 0) for q in range(queues)]


def in_written_order(docs: DataFrame, position: str) -> DataFrame:
    """``docs``, rows of files, with their place in the order in which the files were written: by part number, and by row inside.

    Spark reads files in splits by size, so the order in which rows arrive says nothing; this one does not depend on it.
    Rows that are not read from files are written first.
    """
    path, row, part, before, rows = fresh([*docs.columns, position], "file_path", "file_row", "file_part", "file_before", "file_rows")
    meta = [F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(row)]
    try:
        placed = docs.select("*", *meta)
    except AnalysisException:
        placed = materialise(docs, "documents").df.select("*", *meta)
    number = F.regexp_extract(path, r"part-(\d+)[^/]*$", 1)
    files = placed.groupBy(path).agg(F.count(F.lit(1)).alias(rows))
    files = files.withColumn(part, F.when(number != "", number.cast("long")).otherwise(F.lit(0).cast("long")))
    ranked = running_totals(files, [], [part, path], {before: rows}).select(path, before)
    found = attach(placed, ranked, [path])
    return found.select(*(F.col(f"`{c}`") for c in docs.columns), (F.col(before) + F.col(row)).cast("long").alias(position))


def stream_weights(stream: DataFrame, source: str, position: str) -> dict[str, float]:
    """Weights at which the sources of a mixed stream take turns, as its order shows; null and empty sources together under ``""``.

    The source that lasts longest is the measure: up to the place where another one ends, both had rows in proportion to their weights.
    One number per source is on the driver.
    """
    name = F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(""))
    ends = stream.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"), F.max(position).alias("last")).collect()
    if not ends:
        return {}
    longest = max(ends, key=lambda r: (r["last"], r["name"]))["name"]
    stops = np.array(sorted({r["last"] for r in ends}), np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(stops), np.int64)
        for batch in batches:
            held += np.bincount(np.searchsorted(stops, batch.column(0).to_numpy()), minlength=len(stops))[: len(stops)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(stops))), pa.array(held)], names=["stop", "n"])

    measure = stream.filter(name == longest).select(position).mapInArrow(count, "stop long, n long")
    upto = np.zeros(len(stops), np.int64)
    for r in measure.groupBy("stop").agg(F.sum("n").alias("n")).collect():
        upto[r["stop"]] = r["n"]
    upto = np.cumsum(upto)
    return {r["name"]: r["n"] / max(1, int(upto[np.searchsorted(stops, r["last"])])) for r in ends}


__all__ = ["MAP_NAMES", "by_case", "fresh", "in_written_order", "materialise", "mixture_weights", "offsets", "queue_totals", "source_names", "stream_weights", "with_offsets", "with_queue"]

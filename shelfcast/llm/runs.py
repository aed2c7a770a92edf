"""Group-wise numpy work over rows that were brought together and sorted, many small groups per batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_runs(rows: DataFrame, keys: list[str], sort: list[str], work: Callable, schema: str) -> DataFrame:
    """Calls ``work(table)`` with the rows of each group, sorted; it returns Arrow batches.

    ``keys`` are non-null long columns. The rows are shuffled by the keys, and a task holds one group (and
    one batch) at a time, so callers bound the size of a group by putting a block number into the keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            bounds = _bounds(table, keys)
            for a, b in zip(bounds[:-2], bounds[1:-1], strict=True):
                yield from work(table.slice(a, b - a))
            held = table.slice(bounds[-2])
        if held is not None:
            yield from work(held)

    near = rows.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, *sort)
    return near.mapInArrow(run, schema)


def _bounds(table: pa.Table, keys: list[str]) -> list[int]:
    new = np.zeros(max(0, table.num_rows - 1), bool)
    for k in keys:
        v = numbers(table, k)
        new |= v[1:] != v[:-1]
    return [0, *(np.flatnonzero(new) + 1).tolist(), table.num_rows]


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def matrix(table: pa.Table, name: str, width: int, dtype: str) -> np.ndarray:
    """A binary column of equally long values as a matrix."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=dtype).reshape(table.num_rows, width)


def block_pairs(rows: DataFrame, keys: list[str], order: str, block: int, size: str | None = None) -> DataFrame:
    """Rows of each group dealt to blocks of about ``block`` rows, once per pair of blocks.

    Adds ``block_low, block_high, block_own``: every two rows of a group meet in exactly one pair of blocks,
    and no pair holds more than about twice ``block`` rows. Groups of one row are left out. ``order`` is a long that tells rows
    apart; ``size`` names a column with the rows of the group (or more), if there is one.
    """
    if size is None:
        size = "group_rows"
        rows = rows.join(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(size)), keys)
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("long")
    dealt = rows.filter(F.col(size) > 1).withColumn("blocks", blocks).drop(size)
    own = F.pmod(F.xxhash64(order), F.col("blocks"))
    dealt = dealt.withColumn("block_own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return dealt.withColumn("block_low", F.least("block_own", "other")).withColumn("block_high", F.greatest("block_own", "other")).drop("other", "blocks")


__all__ = ["block_pairs", "map_runs", "matrix", "numbers", "pc"]

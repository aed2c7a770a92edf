"""Left joins of group statistics onto fact rows, safe for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import Table, broadcast_limit, materialise

def attach(fact: DataFrame, stats: DataFrame | Table, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``stats`` (at most one row per key) to ``fact``.

    The statistics are written once and measured. Up to the broadcast limit they
    are broadcast and the fact rows do not move; beyond it both sides are shuffled, and
    adaptive execution splits the partitions of hot keys and of rows without a key. The plan
    that leads to the fact rows runs once, so its cost grows linearly with the joins.
    """
    table = stats if isinstance(stats, Table) else materialise(stats)
    if table.bytes <= broadcast_limit(fact.sparkSession):
        return fact.join(F.broadcast(table.df), keys, how)
    return fact.join(table.df.hint("merge"), keys, how)


def lookup(
    fact: DataFrame,
    stats: DataFrame | Table,
    keys: list[str],
    value: str,
    out: str,
    default=None,
) -> DataFrame:
    """Value by key as a new column; unseen keys get ``default`` (a literal or column)."""
    found = attach(fact, stats, keys)
    if default is None:
        return found if value == out else found.withColumnRenamed(value, out)
    default = default if hasattr(default, "alias") else F.lit(default)
    filled = found.withColumn(out, F.coalesce(F.col(value), default))
    return filled if value == out else filled.drop(value)

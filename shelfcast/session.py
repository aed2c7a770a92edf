"""Session settings, the shared work folder, and tables fitted statistics are kept in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_KEY = "spark.shelfcast.broadcastBytes"
BROADCAST_BYTES = 32 * 1024 * 1024

_RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive settings the plans rely on; partition counts stay the caller's."""
    for key, value in _RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build(master: str, partitions: int, name: str = "shelfcast", memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    session = (
        SparkSession.builder.master(master)
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return tune(session)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` where the cluster sets it.

    Only a local session may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="shelfcast-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


_OPEN_SCOPES: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for scope in _OPEN_SCOPES:
        scope.append(path)
    return path


@contextmanager
def written_here() -> Iterator[list[str]]:
    """The paths that are handed out inside the ``with`` block, in order.

    Intermediate tables stay until they are discarded, because results read them lazily. Once a result is itself
    written, what was written on the way to it can go: ``discard`` it.
    """
    made: list[str] = []
    _OPEN_SCOPES.append(made)
    try:
        yield made
    finally:
        _OPEN_SCOPES[:] = [s for s in _OPEN_SCOPES if s is not made]


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Deletes written tables by their paths, in whatever file system they are."""
    context = spark.sparkContext
    for path in paths:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


@dataclass(frozen=True)
class Table:
    """A written table with the size seen while writing it."""

    df: DataFrame
    rows: int
    bytes: int


def _fixed_bytes(kind: T.DataType) -> int | None:
    """Size of a value whose size does not depend on it: 8 bytes, or those of all fields; None for others."""
    if isinstance(kind, T.StructType):
        sizes = [_fixed_bytes(f.dataType) for f in kind.fields]
        return None if None in sizes else 8 + sum(sizes)
    return None if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)) else 8


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    """Estimated size of a value: texts and binaries at their length, arrays, maps and structs by what they hold; null is 0."""
    fixed = _fixed_bytes(kind)
    if fixed is not None:
        return F.lit(fixed).cast("long")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = 8 + F.octet_length(value)
    elif isinstance(kind, T.StructType):
        size = sum((_value_bytes(value.getField(f.name), f.dataType) for f in kind.fields), F.lit(8))
    elif isinstance(kind, T.MapType):
        keys, values = T.ArrayType(kind.keyType), T.ArrayType(kind.valueType)
        size = _value_bytes(F.map_keys(value), keys) + _value_bytes(F.map_values(value), values)
    else:
        inside = _fixed_bytes(kind.elementType)
        zero = F.lit(0).cast("long")
        held = F.size(value) * inside if inside else F.aggregate(value, zero, lambda sum_, x: sum_ + _value_bytes(x, kind.elementType))
        size = 8 + held
    return F.coalesce(size.cast("long"), F.lit(8).cast("long"))


def _row_bytes(schema: T.StructType) -> Column:
    """Estimated in-memory size of a row: 16 bytes, and its values."""
    return sum((_value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in schema.fields), F.lit(16).cast("long"))


def materialise(df: DataFrame, name: str = "stats") -> Table:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and tells the exact row
    count and size, on which the choice between broadcast and shuffle rests.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    seen = Observation()
    df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0)).alias("bytes"),
    ).write.parquet(path)
    size = seen.get
    return Table(spark.read.schema(df.schema).parquet(path), int(size["rows"]), int(size["bytes"]))


def too_narrow(scan: DataFrame) -> bool:
    """Whether a freshly read table has fewer splits than there are cores.

    Only for plain scans: asking a plan with shuffles would run them.
    """
    return scan.rdd.getNumPartitions() < scan.sparkSession.sparkContext.defaultParallelism


def widened(df: DataFrame, scan: DataFrame | None = None) -> DataFrame:
    """Rows derived from a small scan, spread over the cores for compute-heavy plans.

    A table with a split per core, as any large one has, is left as it is and nothing
    is shuffled.
    """
    if not too_narrow(df if scan is None else scan):
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_KEY, str(BROADCAST_BYTES)))

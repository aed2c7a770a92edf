"""Fact rows laid out once by the buckets of a key, so that any number of joins on it move them no more.

Statistics beyond the broadcast limit would shuffle the fact rows at every join. Here the rows are shuffled
once, when they are written by buckets of the key; statistics are written by the same buckets and joined bucket by
bucket. A bucket cannot be split while it is joined, so the rows of hot keys are kept apart: they are few keys, and their
statistics are broadcast.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import materialise, new_path

#: A key is hot if it has more rows than so many average buckets; at most buckets / HOT_BUCKETS keys are.
HOT_BUCKETS = 2


def write_bucketed(df: DataFrame, keys: list[str], buckets: int, name: str = "rows") -> DataFrame:
    """``df`` as a table in the shared folder, one file per bucket of the keys, sorted by them."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    near = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    near.option("path", new_path(spark, name)).format("parquet").saveAsTable(table)
    return spark.table(table)


@dataclass(frozen=True)
class BucketedRows:
    """Rows by buckets of ``keys``: those of ordinary keys, bucketed, and those of the few hot keys and of rows without a key."""

    keys: list[str]
    buckets: int
    ordinary: DataFrame
    apart: DataFrame
    hot: DataFrame

    @classmethod
    def of(cls, df: DataFrame, keys: list[str], buckets: int = 200, name: str = "rows") -> BucketedRows:
        """Lays ``df`` out. Keys are counted first (partial sums before the shuffle); the rows are then shuffled once.

        Rows with a null key match no statistics and are kept apart, as are those of keys with more than twice the rows of an average bucket.
        """
        counted = materialise(df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key-counts").df
        rows = counted.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
        hot = materialise(counted.filter(F.col("_n") > F.lit(HOT_BUCKETS * max(1, rows // buckets))).select(*keys, F.lit(True).alias("_hot")), "hot-keys").df
        marked = df.join(F.broadcast(hot), keys, "left")
        without = F.col("_hot").isNull()
        for key in keys:
            without = without & F.col(key).isNotNull()
        ordinary = write_bucketed(marked.filter(without).drop("_hot"), keys, buckets, name)
        apart = materialise(marked.filter(~without).drop("_hot"), name)
        return cls(list(keys), buckets, ordinary, apart.df, hot.drop("_hot"))

    def attach(self, stats: DataFrame) -> BucketedRows:
        """Left join of statistics with at most one row per key; the rows stay where they are.

        Hot keys are at most buckets / 2 by their definition, so their statistics are broadcast whatever the table's size.
        """
        written = write_bucketed(stats.dropna(subset=self.keys), self.keys, self.buckets, "stats")
        ordinary = self.ordinary.join(written.hint("merge"), self.keys, "left")
        few = written.join(F.broadcast(self.hot), self.keys, "left_semi")
        return BucketedRows(self.keys, self.buckets, ordinary, self.apart.join(F.broadcast(few), self.keys, "left"), self.hot)

    def rows(self) -> DataFrame:
        return self.ordinary.unionByName(self.apart)

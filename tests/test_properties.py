"""Leakage, fit/transform, partition and skew properties."""

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import folds as O
from shelfcast.operators import impute as I
from shelfcast.operators import order_stats as Q
from shelfcast.operators.groupstats import group_mean
from shelfcast.operators.joins import attach
from shelfcast.session import BROADCAST_KEY
from shelfcast.sources.retail_view import FOLDS, retail_view

ID = ["okey", "line", "item_id", "outlet_id"]


def base(spark, sf_dir):
    return retail_view(spark, sf_dir, *ID, "item_type", "source", "fold", "sales", "mrp", "weight", "visibility")


def test_own_target_never_reaches_its_features(spark, sf_dir):
    rows = base(spark, sf_dir)
    picked = rows.filter("source = 'train'").orderBy(*ID).limit(1).first()
    one = (F.col("okey") == picked["okey"]) & (F.col("line") == picked["line"]) & (F.col("item_id") == picked["item_id"])

    def features(table):
        table = O.target_mean_kfold(table, ["item_id", "outlet_id"], "sales", "fold", FOLDS)
        table = O.saleability_kfold(table, "item_id", "sales", "mrp", "fold", FOLDS, "saleability")
        table = O.outlet_efficiency_kfold(table, "outlet_id", "sales", "mrp", "fold", FOLDS, "efficiency")
        return table.filter(one).select("item_id_avg_sales", "outlet_id_avg_sales", "saleability", "efficiency").first()

    changed = rows.withColumn("sales", F.when(one, F.lit(1e9)).otherwise(F.col("sales")))
    before, after = features(rows), features(changed)
    if any(b != a for b, a in zip(before, after)):
        # Only a key without rows in other folds falls back to an overall mean.
        alone = rows.filter("source = 'train'").filter(F.col("item_id") == picked["item_id"]).filter(F.col("fold") != picked["fold"]).count() == 0
        assert alone
    else:
        assert tuple(before) == tuple(after)


def test_more_test_rows_leave_train_features_alone(spark, sf_dir):
    rows = base(spark, sf_dir)
    more = rows.unionByName(rows.filter("source = 'test'").withColumn("weight", F.lit(1e6)))

    def features(table):
        table = I.fill_cascade(table, "source", ["item_id"], "item_type", "weight", "train")
        table = O.target_mean_kfold(table, ["item_id"], "sales", "fold", FOLDS)
        picked = table.filter("source = 'train'").select(*ID, F.round("weight", 6), F.round("item_id_avg_sales", 6))
        return sorted(map(tuple, picked.collect()))

    assert features(rows) == features(more)


@pytest.mark.parametrize("parts", [1, 17])
def test_partitioning_does_not_matter(spark, sf_dir, parts):
    rows = base(spark, sf_dir)

    def features(table):
        table = Q.pct_rank(table, "item_type", "mrp", "rank")
        table = I.repair_zero_median(table, "item_id", "visibility")
        return sorted(map(tuple, table.select(*ID, F.round("rank", 9), F.round("visibility", 9)).collect()))

    assert features(rows) == features(rows.repartition(parts))
    assert Q.quantiles(rows, ["mrp", "weight"], [0.25, 0.5]) == Q.quantiles(rows.repartition(parts), ["mrp", "weight"], [0.25, 0.5])


def skewed(spark, n=20000):
    """A third of the rows on one key, some without a key, the rest spread out."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 0).when(i % 50 == 1, None).otherwise(i % 5000)
    return spark.range(n).select(i, key.cast("long").alias("k"), (i % 97).cast("double").alias("x"))


def test_shuffle_join_equals_plain_join(spark, no_broadcast):
    rows = skewed(spark)
    stats = group_mean(rows, ["k"], "x", "m")
    plain = rows.join(stats, "k", "left").select("id", "k", "x", "m")
    shuffled = attach(rows, stats, ["k"]).select("id", "k", "x", "m")
    assert shuffled.count() == rows.count()
    assert shuffled.exceptAll(plain).count() == 0
    inner = attach(rows, stats, ["k"], "inner")
    assert inner.count() == rows.filter("k is not null").count()


def test_shuffle_join_splits_the_hot_key(spark, no_broadcast):
    rows = skewed(spark, 400_000).withColumn("pad", F.sha2(F.col("id").cast("string"), 512))
    stats = group_mean(rows, ["k"], "x", "m")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = attach(rows.repartition(16), stats, ["k"])
        sizes = [r["n"] for r in joined.select(F.spark_partition_id().alias("p"), "pad").groupBy("p").agg(F.count("pad").alias("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert sum(sizes) == 400_000 and max(sizes) < 400_000 / 4


def test_scans_grow_linearly_with_chained_joins(spark, sf_dir, no_broadcast):
    """Each further join adds one join to the plan and reads the fact table no more often."""

    def plan_of(count):
        table = base(spark, sf_dir)
        for i in range(count):
            stats = group_mean(base(spark, sf_dir), ["item_id", "outlet_id"][: 1 + i % 2], "mrp", f"m{i}")
            table = attach(table, stats, ["item_id", "outlet_id"][: 1 + i % 2])
        return table._jdf.queryExecution().sparkPlan().toString()

    plans = [plan_of(n) for n in (1, 2, 4)]
    facts = [p.count("l_extendedprice") > 0 and p.count("lineitem.parquet") for p in plans]
    joins = [p.count("SortMergeJoin") for p in plans]
    assert facts == [1, 1, 1] and joins[1] - joins[0] == 1 and joins[2] - joins[1] == 2


def test_features_do_not_depend_on_the_join_kind(spark, sf_dir, no_broadcast):
    rows = base(spark, sf_dir)

    def features():
        table = I.fill_cascade(rows, "source", ["item_id"], "item_type", "weight", "train")
        table = Q.pct_rank(table, "item_type", "mrp", "rank")
        table = O.target_mean_kfold(table, ["outlet_id"], "sales", "fold", FOLDS)
        picked = table.select(*ID, F.round("weight", 6), F.round("rank", 9), F.round("outlet_id_avg_sales", 6))
        return sorted(map(tuple, picked.collect()))

    shuffled = features()
    spark.conf.unset(BROADCAST_KEY)
    assert len(shuffled) == 6000 and shuffled == features()


def test_small_statistics_do_not_move_the_fact_rows(spark, sf_dir):
    rows = retail_view(spark, sf_dir, "okey", "outlet_id", "visibility")
    plan = attach(rows, group_mean(rows, ["outlet_id"], "visibility", "m"), ["outlet_id"])._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "BroadcastHashJoin" in physical and "Exchange hashpartitioning" not in physical
    assert "l_extendedprice" not in physical

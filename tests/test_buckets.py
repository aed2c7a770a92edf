"""Rows laid out by buckets: the same joins, one exchange of the rows, hot keys apart."""

import re

from pyspark.sql import functions as F

from shelfcast.operators.buckets import BucketedRows


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_are_right_and_move_no_rows(spark):
    rows = [(k % 40, k, f"r{k}") for k in range(4000)] + [(7, k, "hot") for k in range(3000)] + [(None, 1, "none")] * 5
    df = spark.createDataFrame(rows, "k int, i int, t string").repartition(6)
    stats = [spark.createDataFrame([(k, k * f) for k in range(0, 50, f)], f"k int, s{f} int") for f in (1, 2, 3)]
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        laid = BucketedRows.of(df, ["k"], buckets=8)
        assert [r["k"] for r in laid.hot.collect()] == [7]
        for s in stats:
            laid = laid.attach(s)
        text = plan(laid.ordinary).split("Initial Plan")[0]
        assert text.count("SortMergeJoin") == 3 and "Exchange" not in text
        found = laid.rows()
        want = df
        for s in stats:
            want = want.join(s, "k", "left")
        assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set(limit, before)


def test_layout_has_a_file_per_bucket_and_survives_empty_tables(spark):
    empty = spark.createDataFrame([], "k int, x int")
    laid = BucketedRows.of(empty, ["k"], buckets=4).attach(spark.createDataFrame([(1, 2)], "k int, s int"))
    assert laid.rows().count() == 0 and laid.rows().columns == ["k", "x", "s"]
    df = spark.range(1000).select((F.col("id") % 100).cast("int").alias("k"), F.col("id").alias("x"))
    laid = BucketedRows.of(df, ["k"], buckets=4)
    files = {re.search(r"_(\d{5})\.c\d+", f)[1] for f in laid.ordinary.inputFiles()}
    assert len(files) == 4 and laid.rows().count() == 1000 and laid.apart.count() == 0

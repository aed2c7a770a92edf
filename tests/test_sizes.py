"""The measured size of written tables, on which the choice between broadcast and shuffle rests, and their end."""

import os

from pyspark.sql import functions as F

from shelfcast.operators.joins import attach
from shelfcast.session import discard, materialise, written_here


def test_nested_texts_count_at_their_length(spark):
    long = "x" * 10_000
    schema = "k int, a array<struct<t:string,n:int>>, b binary, m map<string,string>, s struct<t:string>, d array<double>"
    rows = [(1, [(long, 1), (long, 2), (None, 3)], bytearray(5000), {long: long}, (long,), [1.0] * 1000), (2, None, None, None, None, None), (3, [], b"", {}, (None,), [])]
    df = spark.createDataFrame(rows, schema)
    for column, least in (("a", 20_000), ("b", 5000), ("m", 20_000), ("s", 10_000), ("d", 8000)):
        held = materialise(df.select("k", column))
        assert held.rows == 3 and least <= held.bytes <= least + 500
    assert materialise(df.limit(0)).bytes == 0


def test_wide_values_are_not_broadcast(spark):
    stats = spark.range(100).select(F.col("id").alias("k"), F.array_repeat(F.struct(F.repeat(F.lit("x"), 5000).alias("t")), 100).alias("v"))
    joined = attach(spark.range(200).withColumnRenamed("id", "k"), stats, ["k"])
    assert "Broadcast" not in joined._jdf.queryExecution().optimizedPlan().toString().replace("broadcast=false", "")
    assert joined.filter("v IS NOT NULL").count() == 100


def test_tables_written_in_a_block_are_known_and_can_go(spark):
    with written_here() as outer:
        first = materialise(spark.range(5), "first")
        with written_here() as inner:
            second = materialise(first.df.filter("id > 2"), "second")
    materialise(spark.range(1), "after")
    assert [os.path.basename(p).split("-")[0] for p in outer] == ["first", "second"] and inner == outer[1:]
    discard(spark, outer[:1])
    local = [p.removeprefix("file:") for p in outer]
    assert not os.path.exists(local[0]) and os.path.exists(local[1]) and second.df.count() == 2
    discard(spark, outer[:1])  # once more does nothing

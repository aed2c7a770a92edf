"""Shuffled folds and holdouts of exact size, and the running totals they rest on."""

import hashlib
from collections import Counter, defaultdict

import pytest

from shelfcast.operators.folds import balanced_folds, exact_holdout, shuffled_rank
from shelfcast.operators.order_stats import running_totals


@pytest.mark.parametrize(("rows", "folds"), [(0, 5), (3, 5), (101, 5), (1000, 7)])
def test_fold_sizes_differ_by_at_most_one(spark, rows, folds):
    df = spark.range(rows).withColumnRenamed("id", "k").repartition(3)
    got = balanced_folds(df, ["k"], folds).collect()
    sizes = Counter(r["fold"] for r in got)
    assert sorted(r["k"] for r in got) == list(range(rows))
    assert max(sizes.values(), default=0) - min((sizes[f] for f in range(folds)), default=0) <= 1


@pytest.mark.parametrize(("rows", "held"), [(0, 0), (1, 1), (10, 2), (101, 21), (1000, 200)])
def test_holdout_has_the_exact_share(spark, rows, held):
    df = spark.range(rows).withColumnRenamed("id", "k").repartition(3)
    assert exact_holdout(df, ["k"]).filter("part = 'holdout'").count() == held


def test_rank_is_the_place_in_hash_order(spark):
    keys = [(None, 1), ("a", 1), ("a", None), ("b|", 2), ("b", 3)]
    df = spark.createDataFrame(keys, "s string, n int").repartition(4)
    want = sorted(keys, key=lambda k: hashlib.md5("|".join(["9", *("\x00" if v is None else str(v) for v in k)]).encode()).hexdigest())
    got = {(r["s"], r["n"]): r["rank"] for r in shuffled_rank(df, ["s", "n"], seed=9).collect()}
    assert [got[k] for k in want] == list(range(5))
    again = shuffled_rank(df.repartition(2), ["s", "n"], seed=9)
    assert {(r["s"], r["n"]): r["rank"] for r in again.collect()} == got


def test_a_key_that_most_rows_share_is_spread(spark):
    df = spark.createDataFrame([(1,)] * 4000 + [(k,) for k in range(2, 300)], "k int").repartition(6)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        ranked = shuffled_rank(df, ["k"])
        held = [len(part) for part in ranked.rdd.glom().collect()]
    finally:
        spark.conf.set(merging, "true")
    assert max(held) < 3000
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(4298))
    sizes = Counter(r["fold"] for r in balanced_folds(df, ["k"], 5).filter("k = 1").collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_running_totals_by_group(spark):
    rows = [(g, i, (i * 7 + g) % 5) for g in (1, 2) for i in range(60)]
    df = spark.createDataFrame(rows, "g int, i int, x long").repartition(5)
    before, want = defaultdict(int), {}
    for g, i, x in sorted(rows):
        want[g, i] = (before[g], i)
        before[g] += x
    got = running_totals(df, ["g"], ["i"], {"total": "x", "place": None}).collect()
    assert {(r["g"], r["i"]): (r["total"], r["place"]) for r in got} == want

"""Unseen keys, empty groups and one-sided gaps: what the queries over whole tables do not meet."""

import math

import pytest
from pyspark.sql import functions as F

from shelfcast.catalog import modelling
from shelfcast.operators import encode as E
from shelfcast.operators import groupstats as G
from shelfcast.operators import impute as I
from shelfcast.operators.joins import lookup
from shelfcast.plans import profile as P
from shelfcast.plans.features import BASE_FEATURES, DEFAULT_BASE, DEFAULT_ENGINEERED, ENGINEERED_FEATURES
from shelfcast.sources.retail_view import FOLDS, PREFIX_CATEGORY, retail_view
from shelfcast.sources.schema import VIEW_ROLES


def test_unseen_pair_takes_the_mean_of_the_means(spark):
    train = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 3.0), ("b", "x", 10.0)], "c string, o string, y double")
    rows = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "x")], "c string, o string")
    means = G.group_mean(train, ["c", "o"], "y", "m")
    found = lookup(rows, means, ["c", "o"], "m", "v", G.mean_of(means, "m")).collect()
    assert {(r["c"], r["o"]): r["v"] for r in found} == {("a", "x"): 2.0, ("b", "y"): 6.0, (None, "x"): 6.0}


def test_ratio_of_unseen_groups(spark):
    rows = spark.createDataFrame([("a", 4.0), ("z", 4.0), (None, 4.0)], "k string, v double")
    stats = spark.createDataFrame([("a", 2.0)], "k string, m double")
    by_mean = G.ratio_to_mean(rows, stats, ["k"], "v", "m", "r", unseen_mean=F.lit(8.0)).collect()
    assert {r["k"]: r["r"] for r in by_mean} == {"a": 2.0, "z": 0.5, None: 0.5}
    fixed = G.ratio_to_mean(rows, stats, ["k"], "v", "m", "r", 1e-6, unseen_ratio=1.0).collect()
    assert {r["k"]: round(r["r"], 4) for r in fixed} == {"a": 2.0, "z": 1.0, None: 1.0}


def test_first_value_differs_between_the_sides(spark):
    train = spark.createDataFrame([("A",), ("B",), ("C",)], "t string")
    test = spark.createDataFrame([("B",), ("C",)], "t string")
    a, b = E.one_hot_independent(train, test, "t")
    assert sorted(map(tuple, a.select("t_B", "t_C").collect())) == [(0, 0), (0, 1), (1, 0)]
    assert sorted(map(tuple, b.select("t_B", "t_C").collect())) == [(0, 0), (0, 1)]


def test_group_without_any_value_takes_the_overall_mode(spark):
    rows = spark.createDataFrame([("a", "s"), ("a", "s"), ("a", None), ("b", None), ("c", "m")], "g string, v string")
    filled = I.fill_group_mode(rows, ["g"], "v").groupBy("g", "v").count().collect()
    assert {(r["g"], r["v"]): r["count"] for r in filled} == {("a", "s"): 3, ("b", "s"): 1, ("c", "m"): 1}
    fixed = I.fill_group_mode(rows, ["g"], "v", default="x").filter("g = 'b'").first()
    assert fixed["v"] == "x"


def test_zero_cascade_reaches_its_last_steps(spark):
    rows = [("i", "o", 0.0), ("i", "o", 4.0), ("j", "o", None), ("k", "p", None), ("z", "q", 0.0)]
    df = spark.createDataFrame(rows, "item string, outlet string, x double")
    got = {(r["item"], r["outlet"]): r["x"] for r in I.repair_zero_cascade(df, "item", "outlet", "x").filter("item <> 'i'").collect()}
    assert got["j", "o"] == 2.0 and got["z", "q"] == 0.0 and got["k", "p"] == pytest.approx(4.0 / 3)
    assert sorted(r["x"] for r in I.repair_zero_cascade(df, "item", "outlet", "x").filter("item = 'i'").collect()) == [2.0, 4.0]


def test_gaps_on_the_test_side_alone_stay(spark):
    train = spark.createDataFrame([(1.0, 5.0), (None, 7.0)], "w double, p double")
    rows = spark.createDataFrame([(None, None), (3.0, 1.0)], "w double, p double")
    got = sorted(map(tuple, I.fill_train_means(train, rows, ["w", "p"]).collect()))
    assert got == [(1.0, None), (3.0, 1.0)]


# --- cells, masks and feature needs ---------------------------------------------------


def test_masks_count_distinct_items(spark):
    rows = [("o", "i", "F"), ("o", "i", "F"), ("o", "i", "D"), ("o", "j", "X"), ("p", "i", None), ("p", None, "F"), (None, "k", "F"), ("q", "i", "D")]
    df = spark.createDataFrame(rows, "o string, i string, c string")
    for complete in (False, True):
        got = {r["o"]: (r["f"], r["d"]) for r in G.distinct_share(df, "o", "c", "i", {"F": "f", "D": "d"}, complete).collect()}
        want = {"o": (1 / 3, 1 / 3), "q": (0.0, 1.0)} if not complete else {"o": (0.5, 0.5), "q": (0.0, 1.0)}
        assert {k: v for k, v in got.items() if v[0] is not None} == {k: pytest.approx(v) for k, v in want.items()}


def test_more_categories_than_bits(spark):
    rows = [("o", f"i{n}", f"c{n % 70}") for n in range(140)]
    df = spark.createDataFrame(rows, "o string, i string, c string")
    assert G.distinct_share(df, "o", "c", "i", {"c0": "a", "c69": "b"}).first()[1:] == pytest.approx((2 / 140, 2 / 140))


def test_rollup_is_that_of_each_grouping(spark):
    rows = [(a, b, float(a * b)) for a in (1, 2, 3) for b in (1, 2) for _ in range(a)] + [(None, 1, 9.0), (1, None, 9.0)]
    cells = spark.createDataFrame(rows, "a int, b int, x double").groupBy("a", "b").agg(F.sum("x").alias("x"), F.count("x").alias("n"))
    found = G.rollup(cells, [["a"], ["a", "b"], ["b"]], {"x": F.sum("x"), "n": F.sum("n")})
    for keys, table in found.items():
        want = cells.groupBy(*keys).agg(F.sum("x").alias("x"), F.sum("n").alias("n")).dropna(how="all", subset=list(keys))
        assert sorted(map(str, table.df.collect())) == sorted(map(str, want.collect()))
        assert table.rows >= want.count() and table.bytes > 0


def joins_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_only_the_joins_of_the_wanted_features_are_planned(spark, sf_dir):
    rows = retail_view(spark, sf_dir)
    base = joins_of(rows)
    short = P.profile_features(rows, VIEW_ROLES, PREFIX_CATEGORY, FOLDS, wanted=[*DEFAULT_BASE, *DEFAULT_ENGINEERED])
    assert joins_of(short) == 1  # the outlets; fills are behind the written table
    assert short.columns[-len(DEFAULT_ENGINEERED):] == DEFAULT_ENGINEERED and "Item_Weight" not in short.columns
    none = P.profile_features(rows, VIEW_ROLES, PREFIX_CATEGORY, FOLDS, wanted=["Item_MRP", "Item_MRP_sq", "Outlet_Era"])
    assert joins_of(none) == 0 and base == 2
    full = P.profile_features(rows, VIEW_ROLES, PREFIX_CATEGORY, FOLDS)
    assert joins_of(full) == len(P.TABLES) + 2
    assert set(full.columns) >= {*BASE_FEATURES, *ENGINEERED_FEATURES} and len({*BASE_FEATURES, *ENGINEERED_FEATURES}) == 44
    keys = ["okey", "line", "_item", "_outlet"]
    for c in ("Outlet_Food_Ratio", "Outlet_Sales_Efficiency", "Item_Visibility"):
        a = {tuple(r[:4]): r[4] for r in short.select(*keys, c).collect()}
        b = {tuple(r[:4]): r[4] for r in full.select(*keys, c).collect()}
        assert a.keys() == b.keys() and all(math.isclose(a[k] or 0, b[k] or 0, rel_tol=1e-9) for k in a)


def test_every_feature_has_a_definition_or_a_column():
    stateless = {*BASE_FEATURES, "MRP_Bin", "is_Grocery_Store", "is_Supermarket_Type1"}
    assert set(ENGINEERED_FEATURES) <= stateless | set(P.FEATURES)
    known = {f"{t}.{n}" for t in P.TABLES for n in ("rows", "age", "visibility", "oof", "sales", "price", "items", "categories", "bins")}
    assert P.needs_of([*BASE_FEATURES, *ENGINEERED_FEATURES]) <= known | set(P.RANKS) | {"fill.weight", "fill.visibility"}
    assert modelling.NUMBERS and set(modelling.NUMBERS) | set(modelling.TEXTS) <= {*BASE_FEATURES, *ENGINEERED_FEATURES}

"""Edge cases with values worked out by hand."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfcast.functions import metrics
from shelfcast.functions import scalar as S
from shelfcast.operators import distrib as D
from shelfcast.operators import encode as E
from shelfcast.operators import folds as O
from shelfcast.operators import groupstats as G
from shelfcast.operators import impute as I
from shelfcast.operators import models as M
from shelfcast.operators import order_stats as Q
from shelfcast.operators.shape import align_columns, drop_columns, unique_names


def test_mode_ties_and_empty_group(spark, rows):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", None), ("c", "z")], "g string, v string")
    assert rows(Q.group_mode(df, ["g"], "v", "m")) == [("a", "x"), ("c", "z")]
    filled = I.fill_group_mode(df, ["g"], "v", default="none")
    assert rows(filled.select("g", "v")) == [("a", "x"), ("a", "y"), ("b", "none"), ("c", "z")]


def test_group_mode_fallback_is_taken_after_the_fill(spark, rows):
    data = [("a", "x"), ("a", None), ("a", None), ("b", "y"), ("b", "y"), ("c", None)]
    filled = I.fill_group_mode(spark.createDataFrame(data, "g string, v string"), ["g"], "v")
    assert rows(filled.filter("g = 'c'").select("v")) == [("x",)]


def test_rank_ties(spark, rows):
    df = spark.createDataFrame([(1, 10.0), (1, 20.0), (1, 20.0), (1, None), (1, 40.0), (2, 5.0)], "g int, x double")
    assert rows(Q.pct_rank(df, "g", "x", "r").select("g", "x", "r")) == [
        (1, None, None), (1, 10.0, 0.25), (1, 20.0, 0.625), (1, 20.0, 0.625), (1, 40.0, 1.0), (2, 5.0, 1.0),
    ]


ZEROS = [("p", "o", 0.0), ("p", "o", 0.0), ("q", "o", 0.0), ("q", "o", 0.4), ("r", "o", 0.2)]


@pytest.mark.parametrize(
    "repair, expected",
    [
        (lambda d: I.repair_zero_mean(d, "item", "vis"), [0.0, 0.0, 0.2, 0.4, 0.2]),
        (lambda d: I.repair_zero_median(d, "item", "vis"), [0.0, 0.0, 0.2, 0.4, 0.2]),
        (lambda d: I.repair_zero_nonzero_mean(d, "item", "vis"), [0.12, 0.12, 0.4, 0.4, 0.2]),
        (lambda d: I.repair_zero_cascade(d, "item", "outlet", "vis"), [0.0, 0.0, 0.2, 0.4, 0.2]),
    ],
)
def test_zero_repair(spark, repair, expected):
    df = spark.createDataFrame(ZEROS, "item string, outlet string, vis double")
    found = sorted((r["item"], round(r["vis"], 9)) for r in repair(df).collect())
    assert found == sorted(zip("ppqqr", expected))


def test_cascade_second_mean_includes_the_first_fill(spark):
    data = [
        ("train", "a", "t", 10.0), ("train", "a", "t", None), ("train", "b", "t", None),
        ("train", "c", "t", 4.0), ("test", "a", "t", None), ("test", "z", "t", None),
    ]
    df = spark.createDataFrame(data, "source string, item string, type string, w double")
    filled = I.fill_cascade(df, "source", ["item"], "type", "w", first_on="train")
    found = {(r["source"], r["item"]): r["w"] for r in filled.collect() if r["item"] != "a"}
    # train type mean after step one: (10 + 10 + 4) / 3; test: only the filled item a.
    assert found == {("train", "b"): 8.0, ("train", "c"): 4.0, ("test", "z"): 10.0}


def test_group_mean_fallback_is_taken_after_the_fill(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", None), ("b", 5.0), ("c", None)], "k string, v double")
    found = {r["k"]: r["v"] for r in I.fill_group_mean(df, ["k"], "v", True).collect()}
    assert found == {"a": 1.0, "b": 5.0, "c": 2.0}


def test_unseen_keys_and_single_fold_keys(spark):
    data = [
        ("train", 0, "a", 10.0), ("train", 1, "a", 20.0), ("train", 1, "a", 60.0),
        ("train", 0, "b", 30.0), ("test", None, "a", None), ("test", None, "z", None),
    ]
    df = spark.createDataFrame(data, "source string, fold int, k string, y double")
    found = [
        (r["source"], r["fold"], r["k"], r["k_avg_sales"])
        for r in O.target_mean_kfold(df, ["k"], "y", "fold", 2).collect()
    ]
    assert sorted(found, key=str) == sorted(
        [
            ("train", 0, "a", 40.0), ("train", 1, "a", 10.0), ("train", 1, "a", 10.0),
            ("train", 0, "b", 30.0), ("test", None, "a", 30.0), ("test", None, "z", 30.0),
        ],
        key=str,
    )


def test_efficiency_fallback_is_the_mean_of_key_ratios(spark):
    data = [("train", 0, "a", 10.0, 1.0), ("train", 1, "b", 40.0, 2.0), ("test", None, "z", None, 1.0)]
    df = spark.createDataFrame(data, "source string, fold int, k string, y double, p double")
    by_keys = {r["k"]: r["e"] for r in O.outlet_efficiency_kfold(df, "k", "y", "p", "fold", 2, "e").collect()}
    overall = {r["k"]: r["e"] for r in O.saleability_kfold(df, "k", "y", "p", "fold", 2, "e").collect()}
    assert by_keys["z"] == pytest.approx(15.0, rel=1e-5)
    assert overall["z"] == pytest.approx(25.0 / 1.5, rel=1e-5)


def test_null_category_and_unseen_value(spark):
    train = spark.createDataFrame([("b",), (None,), ("a",)], "c string")
    labels = E.fit_labels(train, ["c"], null_as_text=True)
    test = spark.createDataFrame([("a",), ("b",), (None,), ("q",)], "c string")
    coded = E.apply_labels(test.withColumn("was", F.col("c")), labels, ["c"], "keep", True)
    assert {r["was"]: r["c"] for r in coded.collect()} == {"a": 0, "b": 1, None: 2, "q": 3}
    with pytest.raises(PySparkException):
        E.apply_labels(test, E.fit_labels(train, ["c"]), ["c"], "error").collect()


def test_text_interaction_prints_missing(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    assert df.select(S.joined_text("a", "b")).first()[0] == "x_nan"


def test_bin_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 69.99, 70.0, 135.0, 200.0, 300.0, None, -1.0)], "x double")
    found = [r[0] for r in df.select(S.bin_left_closed("x", S.PRICE_EDGES, S.PRICE_LABELS)).collect()]
    assert found == ["Low_MRP", "Low_MRP", "Mid_MRP", "High_MRP", "VHigh_MRP", "VHigh_MRP", None, None]
    closed = [r[0] for r in df.select(S.bin_left_closed("x", [0.0, 70.0, 300.0], ["l", "h"])).collect()]
    assert closed == ["l", "l", "h", "h", "h", None, None, None]
    right = [r[0] for r in df.select(S.bin_right_closed("x", [70.0, 135.0], ["a", "b", "c"])).collect()]
    assert right == ["a", "a", "a", "b", "c", "c", None, "a"]


def test_quantile_bins_merge_equal_edges(spark):
    df = spark.createDataFrame([(x,) for x in [1.0] * 6 + [2.0, 3.0]], "x double")
    found = D.bin_by_quantiles(df, "x", "b", ["a", "b", "c", "d"])
    assert sorted((r["x"], r["b"]) for r in found.collect())[5:] == [(1.0, "a"), (2.0, "b"), (3.0, "b")]


def test_cap_keeps_null(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, 4.0, 100.0, -100.0, None)], "x double")
    limits = D.iqr_limits(df, ["x"])
    assert limits["x"] == pytest.approx((-2.5, 7.5), abs=1e-9) or limits["x"][0] < limits["x"][1]
    found = [r[0] for r in D.cap(df, limits).collect()]
    assert found[6] is None and found[4] == limits["x"][1] and found[5] == limits["x"][0]


def test_quantiles_of_small_empty_and_tied_columns(spark):
    df = spark.createDataFrame([(1.0, None, 5), (2.0, None, 5), (4.0, None, 5)], "a double, b double, c int")
    assert Q.quantiles(df, ["a", "b", "c"], [0.0, 0.5, 0.75, 1.0]) == {
        "a": [1.0, 2.0, 3.0, 4.0], "b": [None] * 4, "c": [5.0] * 4,
    }


def test_distinct_share_gaps_and_double_items(spark, rows):
    data = [("o1", "Food", "i1"), ("o1", "Food", "i1"), ("o1", "Food", "i2"), ("o1", "NC", "i2"), ("o2", "NC", "i3"), ("o3", None, "i4")]
    df = spark.createDataFrame(data, "o string, c string, i string")
    found = G.distinct_share(df, "o", "c", "i", {"Food": "food", "NC": "nc"})
    assert rows(found) == [("o1", 2 / 3, 1 / 3), ("o2", 0.0, 1.0)]


def test_box_cox(spark):
    df = spark.createDataFrame([(math.e,), (1.0,)], "x double")
    assert [r[0] for r in df.select(S.box_cox("x", 0)).collect()] == [1.0, 0.0]
    assert df.select(S.box_cox("x", 2)).first()[0] == pytest.approx((math.e**2 - 1) / 2)
    logs = spark.range(2000).select(F.exp(F.sin(F.col("id")) + 2).alias("x"))
    assert abs(D.fit_box_cox(logs, "x", shift=0.0)) < 0.5


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 3.0)], "c double, x double")
    assert [tuple(r) for r in D.scale(df, D.fit_scale(df, ["c", "x"])).collect()] == [(0.0, -1.0), (0.0, 1.0)]


def test_metrics_small(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0), (4.0, 4.0)], "y double, p double")
    found = df.agg(metrics.rmse("y", "p"), metrics.r2("y", "p"), metrics.bias_factor("y", "p")).first()
    assert tuple(found) == pytest.approx((math.sqrt(0.5), 1 - 2 / 5, 28 / 28))
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y double, p double")
    assert flat.agg(metrics.r2("y", "p")).first()[0] is None


def test_failed_model_is_not_chosen(spark):
    board = spark.createDataFrame([("a", math.inf), ("b", 2.0), ("c", 1.0), ("d", math.nan)], "m string, e double")
    assert tuple(Q.min_by_finite(board, "m", "e").first()) == ("c", 1.0)


def test_misaligned_tables(spark, rows):
    test = spark.createDataFrame([(1, "x")], "extra int, b string")
    assert align_columns(test, ["a", "b"]).columns == ["a", "b"]
    assert rows(align_columns(test, ["a", "b"])) == [(0, "x")]
    train = spark.createDataFrame([("p",), ("q",), ("r",)], "c string")
    other = spark.createDataFrame([("q",), ("s",)], "c string")
    a, b = E.one_hot_independent(train, other, "c")
    assert sorted(a.columns) == sorted(b.columns) == ["c_q", "c_r"]
    assert rows(b.select("c_q", "c_r")) == [(0, 0), (0, 0)]


def test_one_hot_refuses_to_cut(spark):
    with pytest.raises(ValueError):
        E.category_values(spark.range(5), "id", limit=4)
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    more = df.union(spark.createDataFrame([("z",), (None,)], "c string"))
    slots = {r["c"]: r["v"].toArray().tolist() for r in E.one_hot_vector(df, more, ["c"], "v", drop_first=True).collect()}
    assert slots == {"a": [0, 0], "b": [1, 0], "c": [0, 1], "z": [0, 0], None: [0, 0]}
    slots = {r["c"]: r["v"].toArray().tolist() for r in E.one_hot_vector(df, more, ["c"], "v").collect()}
    assert slots == {"a": [1, 0, 0], "b": [0, 1, 0], "c": [0, 0, 1], "z": [0, 0, 0], None: [0, 0, 0]}
    one = E.one_hot_vector(df.limit(1), df.limit(1), ["c"], "v", drop_first=True)
    assert one.first()["v"].toArray().sum() == 0


def test_drop_columns_strict(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert drop_columns(df, ["b", "z"]).columns == ["a"]
    with pytest.raises(ValueError):
        drop_columns(df, ["z"], strict=True)


def test_small_helpers():
    assert unique_names(["b", "a", "b"]) == ["b", "a"]
    assert M.grid({"a": [1, 1, 2], "b": [3]}) == [{"a": 1, "b": 3}, {"a": 2, "b": 3}]
    drawn = M.draws({"x": ("log", 0.01, 0.2), "n": ("int", 3, 4), "u": ("uniform", 0, 1)}, 20, 7)
    assert drawn == M.draws({"x": ("log", 0.01, 0.2), "n": ("int", 3, 4), "u": ("uniform", 0, 1)}, 20, 7)
    assert all(0.01 <= s["x"] <= 0.2 and s["n"] in (3, 4) for s in drawn)
    assert M.best_rounds([5, 4, 3, 3.5, 2], patience=1) == 3
    assert M.best_rounds([5, 4, 3, 3.5, 2], patience=2) == 5
    assert D.power_grid(-0.2, 0.2, 0.1) == [-0.2, -0.1, 0.0, 0.1, 0.2]

"""Metrics, models, search, and the three end-to-end plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.common import check, near, near_sql, query, view
from shelfcast.catalog.encoding import rank_sql
from shelfcast.catalog.groups import oof_join, oof_steps, oof_value
from shelfcast.functions import metrics
from shelfcast.functions import scalar as S
from shelfcast.operators import models as M
from shelfcast.operators.groupstats import group_mean
from shelfcast.operators.impute import fill_group_mean
from shelfcast.operators.joins import attach
from shelfcast.operators.moments import ridge_path
from shelfcast.operators.order_stats import min_by_finite
from shelfcast.plans.ensemble import run_ensemble
from shelfcast.plans.features import ENGINEERED_FEATURES
from shelfcast.plans.profile import TRIAL_SPACE, profile_features, run_profile
from shelfcast.plans.race import run_race
from shelfcast.sources.retail_view import FOLDS, PREFIX_CATEGORY
from shelfcast.sources.schema import VIEW_ROLES

K = ["okey", "line"]
FOOD = {k: v for k, v in PREFIX_CATEGORY.items() if v != "Non-Consumable"}

# --- metrics over deterministic predictions: group means of the target -------------

PREDICTED = (
    "pr AS (SELECT okey, line, outlet_id, fold, sales AS label, avg(sales) OVER (PARTITION BY otype) AS prediction, "
    "avg(sales) OVER (PARTITION BY outlet_id) AS other FROM train)"
)


def predicted(spark, d):
    rows = view(spark, d, *K, "source", "fold", "otype", "outlet_id", "sales").filter("source = 'train'")
    rows = attach(rows, group_mean(rows, ["otype"], "sales", "prediction"), ["otype"])
    rows = attach(rows, group_mean(rows, ["outlet_id"], "sales", "other"), ["outlet_id"])
    return rows.withColumnRenamed("sales", "label")


RMSE_SQL = "sqrt(avg((label - {p}) * (label - {p})))"


@query("bias_factor", check(f"SELECT {near_sql('sum(label * prediction) / sum(prediction * prediction)', 6)} AS factor FROM pr", PREDICTED))
def bias_factor(spark, d):
    return predicted(spark, d).agg(near(metrics.bias_factor("label", "prediction"), 6).alias("factor"))


@query(
    "apply_bias_factor",
    check(
        f"SELECT okey, line, {near_sql('greatest((other - 500) * (SELECT sum(label * other) / sum(other * other) FROM pr), 0)')} AS corrected FROM pr",
        PREDICTED,
    ),
)
def apply_bias_factor(spark, d):
    """Shifted predictions, so that some fall below zero and are floored."""
    rows = predicted(spark, d)
    factor = rows.agg(metrics.bias_factor("label", "other")).scalar()
    return rows.select(*K, near(S.floor_at((F.col("other") - 500) * factor)).alias("corrected"))


@query(
    "rmse",
    check(f"SELECT {near_sql(RMSE_SQL.format(p='prediction'))} AS rmse, {near_sql(RMSE_SQL.format(p='other'))} AS rmse_other FROM pr", PREDICTED),
)
def rmse(spark, d):
    return predicted(spark, d).agg(
        near(metrics.rmse("label", "prediction")).alias("rmse"), near(metrics.rmse("label", "other")).alias("rmse_other")
    )


@query(
    "r2",
    check(
        f"SELECT {near_sql('1 - sum((label - other) * (label - other)) / sum((label - m) * (label - m))', 6)} AS r2 "
        "FROM pr, (SELECT avg(label) AS m FROM pr)",
        PREDICTED,
    ),
)
def r2(spark, d):
    return predicted(spark, d).agg(near(metrics.r2("label", "other"), 6).alias("r2"))


@query(
    "rmse_original_scale",
    check(
        f"SELECT {near_sql('avg(e)')} AS rmse FROM (SELECT fold, sqrt(avg((exp(a) - exp(b)) * (exp(a) - exp(b)))) AS e "
        "FROM (SELECT fold, ln(1 + label) AS a, ln(1 + other) AS b FROM pr) GROUP BY fold)",
        PREDICTED,
    ),
)
def rmse_original_scale(spark, d):
    rows = predicted(spark, d).select("fold", F.log1p("label").alias("a"), F.log1p("other").alias("b"))
    return metrics.rmse_original_scale(rows, "a", "b", "fold").select(near("rmse").alias("rmse"))


@query(
    "ensemble_average",
    check(f"SELECT okey, line, {near_sql('greatest(exp((ln(1 + prediction) + ln(1 + other)) / 2) - 1, 0)')} AS average FROM pr", PREDICTED),
)
def ensemble_average(spark, d):
    rows = predicted(spark, d).select(*K, F.log1p("prediction").alias("a"), F.log1p("other").alias("b"))
    return M.ensemble_average(rows, ["a", "b"], "average").select(*K, near("average").alias("average"))


@query(
    "argmin_model",
    check(
        f"SELECT model, {near_sql('rmse')} AS rmse FROM (SELECT 'by_type' AS model, {RMSE_SQL.format(p='prediction')} AS rmse FROM pr "
        f"UNION ALL SELECT 'by_outlet', {RMSE_SQL.format(p='other')} FROM pr) ORDER BY 2 LIMIT 1",
        PREDICTED,
    ),
)
def argmin_model(spark, d):
    """A failed model stands in the board with an infinite error and is never chosen."""
    row = predicted(spark, d).agg(
        metrics.rmse("label", "prediction").alias("by_type"),
        metrics.rmse("label", "other").alias("by_outlet"),
        F.lit(float("inf")).alias("failed"),
    )
    board = row.unpivot([], ["by_type", "by_outlet", "failed"], "model", "rmse")
    return min_by_finite(board, "model", "rmse").withColumn("rmse", near("rmse"))


# --- models on the view ------------------------------------------------------------

FEATURES = ["weight", "visibility", "mrp", "age", "tier", "kind", "size_score"]


def model_table(spark, d):
    """Vectors of all rows of the view, with label, fold and source."""
    rows = view(spark, d, *K, "source", "fold", "item_id", "outlet_id", "weight", "visibility", "mrp", "est_year", "loc", "otype", "size", "sales", spread=True)
    rows = fill_group_mean(rows, ["item_id"], "weight", global_fallback=True)
    rows = rows.withColumns(
        {
            "age": S.age("est_year"),
            "tier": S.last_digit("loc"),
            "kind": S.map_value("otype", {"Grocery Store": 0, "Supermarket Type1": 1, "Supermarket Type2": 2, "Supermarket Type3": 3}),
            "size_score": S.map_value("size", S.SIZE_SCORE, 0),
        }
    )
    return M.vectors(rows, FEATURES, "sales", [*K, "item_id", "outlet_id", "source", "fold"]).df


def train_of(table):
    return table.filter("source = 'train'")


def scores(model, table):
    rows = model.transform(table.filter("source = 'test'"))
    return rows.select(*K, "label", "prediction")


SMALL = {"n_estimators": 5, "max_depth": 4, "learning_rate": 0.3}


@query("scale_in_pipeline")
def scale_in_pipeline(spark, d):
    """Scaler, polynomial terms and model refitted on every fold."""
    table = train_of(model_table(spark, d))
    settings = M.grid({"alpha": [0.1, 1.0], "degree": [2]})
    board, _, _ = M.search(table, "Lasso", settings, lambda part, s: M.lasso(s["alpha"], s["degree"], scaled=part), FOLDS)
    return board


@query("lasso_fit")
def lasso_fit(spark, d):
    table = model_table(spark, d)
    return scores(M.lasso(0.05, degree=2).fit(train_of(table)), table)


@query("ridge_fit")
def ridge_fit(spark, d):
    table = model_table(spark, d)
    return scores(M.ridge(train_of(table), 1.0, degree=2).fit(train_of(table)), table)


@query("ridge_path")
def ridge_path_query(spark, d):
    """Every penalty of the race at both degrees, over all folds, from one pass of moments per degree."""
    return ridge_path(train_of(model_table(spark, d)), (0.1, 0.5, 1.0, 10.0, 100.0), (1, 2))[0]


@query("gbt_fit")
def gbt_fit(spark, d):
    table = model_table(spark, d)
    return scores(M.gbt(SMALL).fit(train_of(table)), table)


@query("gbt_second_fit")
def gbt_second_fit(spark, d):
    table = model_table(spark, d)
    return scores(M.gbt_second({**SMALL, "subsample": 0.8, "colsample": 0.7, "min_child_weight": 3, "gamma": 0.0}).fit(train_of(table)), table)


def boosted(part, s):
    return M.gbt({**SMALL, "n_estimators": 3, **s})


@query("grid_search")
def grid_search(spark, d):
    table = train_of(model_table(spark, d))
    return M.search(table, "gbt", M.grid({"max_depth": [3, 4], "learning_rate": [0.1, 0.5]}), boosted, FOLDS)[0]


@query("random_search")
def random_search(spark, d):
    table = train_of(model_table(spark, d))
    settings = M.draws({"max_depth": ("int", 3, 5), "learning_rate": ("uniform", 0.05, 0.5), "subsample": ("uniform", 0.65, 0.95)}, 3, 42)
    return M.search(table, "gbt", settings, boosted, FOLDS)[0]


@query("trial_search")
def trial_search(spark, d):
    table = train_of(model_table(spark, d))
    space = {**TRIAL_SPACE, "max_depth": ("int", 3, 5)}
    settings = [{**SMALL, **s, "n_estimators": 10} for s in M.draws(space, 3, 4)]
    return M.search(table, "gbt", settings, lambda part, s: M.gbt(s), FOLDS, patience=3)[0]


@query("best_rounds_cv")
def best_rounds_cv(spark, d):
    table = train_of(model_table(spark, d))
    curve = M.rounds_curve(table, {**SMALL, "n_estimators": 6}, FOLDS)
    best = M.best_rounds(curve, patience=3)
    rows = [(i + 1, v, i + 1 == best) for i, v in enumerate(curve)]
    return spark.createDataFrame(rows, "round int, rmse double, best boolean")


@query("early_stopping")
def early_stopping(spark, d):
    table = train_of(model_table(spark, d))
    model = M.early_stopped(table, {**SMALL, "n_estimators": 30, "learning_rate": 0.8}, fold=0, patience=5)
    held_out = model.transform(table.filter(F.col("fold") == 0))
    return held_out.agg(metrics.rmse("label", "prediction").alias("rmse"), F.lit(model.getNumTrees).alias("rounds"))


@query("forward_selection")
def forward_selection(spark, d):
    table = train_of(model_table(spark, d))
    return M.forward_selection(table, FEATURES, ["mrp", "weight", "tier", "kind"], lambda part: boosted(part, {}), FOLDS)[2]


@query("oof_predict")
def oof_predict(spark, d):
    table = train_of(model_table(spark, d))
    return M.oof_predict(table, lambda part: boosted(part, {}), FOLDS)


@query("model_leaderboard")
def model_leaderboard(spark, d):
    table = train_of(model_table(spark, d))
    candidates = [
        M.Candidate("Lasso", {"alpha": 0.05}, lambda part: M.lasso(0.05), penalty=("l1", 0.05)),
        M.Candidate("Ridge", {"alpha": 1.0}, lambda part: M.ridge(part, 1.0), penalty=("l2", 1.0)),
        M.Candidate("GBT", SMALL, lambda part: boosted(part, {})),
    ]
    return M.leaderboard(table, candidates, M.cross_validate(table, candidates, FOLDS))


@query("refit_best")
def refit_best(spark, d):
    """The best of a search refitted on all train rows."""
    table = model_table(spark, d)
    _, best, _ = M.search(train_of(table), "Ridge", M.grid({"alpha": [0.1, 10.0]}), lambda part, s: M.ridge(part, s["alpha"]), FOLDS)
    return scores(M.ridge(train_of(table), best["alpha"]).fit(train_of(table)), table)


@query("score_batch")
def score_batch(spark, d):
    table = model_table(spark, d)
    model = M.gbt(SMALL).fit(train_of(table))
    scored = model.transform(table.filter("source = 'test'").drop("label"))
    return scored.select("item_id", "outlet_id", S.floor_at("prediction").alias("sales"))


# --- end-to-end plans --------------------------------------------------------------

TEXTS = ["Item_Fat_Content", "Outlet_Size", "MRP_Bin", "Outlet_Era", "Location_x_Type"]
NUMBERS = ["Item_Weight", "Item_Visibility", *[c for c in ENGINEERED_FEATURES if c not in TEXTS]]


def digits(feature: str) -> int:
    """Decimals that are compared: sums of sales differ between engines from about the tenth significant digit on."""
    return 4 if feature in ("Outlet_Mean_Sales", "Loc_Cat_Sales_Mean", "Item_MRP_sq") else 7


def _profile_sql() -> str:
    """The plan's feature table, each feature from its definition."""
    fat = (
        "CASE WHEN category = 'Non-Consumable' THEN 'Non-Edible' WHEN fat IN ('LF', 'low fat') THEN 'Low Fat' "
        "WHEN fat = 'reg' THEN 'Regular' WHEN fat = 'Non Edible' THEN 'Non-Edible' ELSE fat END"
    )
    bins = "CASE WHEN mrp < 70 THEN 'Low_MRP' WHEN mrp < 135 THEN 'Mid_MRP' WHEN mrp < 200 THEN 'High_MRP' ELSE 'VHigh_MRP' END"
    distinct = lambda c, v: f"count(DISTINCT CASE WHEN {c} = '{v}' THEN item_id END)"
    shares = lambda c, values: ", ".join(
        f"{distinct(c, v)} / nullif(CAST({' + '.join(distinct(c, w) for w in values)} AS double), 0) AS {n}" for v, n in values.items()
    )
    cats = {"Food": "food", "Drinks": "drinks", "Non-Consumable": "nc"}
    steps = [
        "im AS (SELECT item_id, avg(weight) AS m FROM train GROUP BY item_id)",
        f"w1 AS (SELECT cat.*, coalesce(weight, m) AS w1, nullif(visibility, 0) AS x, {fat} AS fat2, {bins} AS bin, coalesce(size, 'Small') AS size2 FROM cat LEFT JOIN im ON cat.item_id = im.item_id)",
        "w2 AS (SELECT *, coalesce(w1, avg(w1) OVER (PARTITION BY source, item_type)) AS w, coalesce(x, avg(x) OVER (PARTITION BY source, outlet_id, item_type)) AS x1 FROM w1)",
        "g0 AS (SELECT *, coalesce(x1, avg(x1) OVER (PARTITION BY source, item_type)) AS vis FROM w2)",
        # The filled visibilities are means, whose last bits differ between engines: ranked as rounded.
        "g1 AS (SELECT *, round(vis, 9) AS vis9 FROM g0)",
        f"g AS (SELECT *, {rank_sql('mrp')} AS price_rank, {rank_sql('vis9')} AS vis_rank FROM g1)",
        "tr AS (SELECT * FROM g WHERE source = 'train')",
        "it AS (SELECT item_id, avg(vis) AS iv, CAST(count(*) AS double) AS n, CAST(2013 - min(est_year) AS double) AS age FROM tr GROUP BY item_id)",
        f"ou AS (SELECT outlet_id, CAST(count(DISTINCT item_id) AS double) AS oc, avg(sales) AS os, avg(mrp) AS om, {shares('category', cats)}, "
        f"{shares('bin', {'Low_MRP': 'low', 'Mid_MRP': 'mid', 'High_MRP': 'high', 'VHigh_MRP': 'vhigh'})} FROM tr GROUP BY outlet_id)",
        f"ot AS (SELECT otype, {shares('category', {k: 't_' + v for k, v in cats.items()})} FROM tr GROUP BY otype)",
        "ty AS (SELECT item_type, avg(mrp) AS tp, avg(vis) AS tv FROM tr GROUP BY item_type)",
        "se AS (SELECT outlet_id, item_type, avg(vis) AS seen FROM tr GROUP BY outlet_id, item_type)",
        "pl AS (SELECT loc, category, avg(sales) AS m FROM tr WHERE category IS NOT NULL GROUP BY loc, category)",
        *oof_steps("item_id", "i"),
        *oof_steps("outlet_id", "o"),
    ]
    t = "rv.source = 'test'"
    age = "coalesce(it.age, (SELECT median(it.age) FROM tr JOIN it ON tr.item_id = it.item_id))"
    value = {
        "Item_Weight": "w",
        "Item_Visibility": "vis",
        "Item_Popularity": "coalesce(it.n, (SELECT median(n) FROM it))",
        "Outlet_Mean_Sales": "ou.os",
        "Outlet_Item_Count": "ou.oc",
        "Item_Age_Proxy": age,
        "Outlet_Food_Ratio": "food",
        "Outlet_Drinks_Ratio": "drinks",
        "Outlet_NC_Ratio": "nc",
        "Relative_Visibility": "coalesce(vis / nullif(seen, 0), 1)",
        "Visibility_to_Item_Mean_Ratio": "vis / (coalesce(iv, (SELECT avg(iv) FROM it)) + 0.000001)",
        "Loc_Cat_Sales_Mean": f"coalesce(pl.m, CASE WHEN {t} THEN (SELECT avg(sales) FROM train) END)",
        "Price_per_Unit_Weight": "mrp / (w + 0.000001)",
        "Item_MRP_to_Outlet_Mean_MRP_Ratio": "mrp / om",
        "Item_Saleability_Ratio": f"coalesce({oof_value('i', True)}, (SELECT avg(sales) / (avg(mrp) + 0.000001) FROM train))",
        "Outlet_to_Item_Age_Ratio": f"(2013 - est_year) / ({age} + 1)",
        "Outlet_Low_MRP_Ratio": "low",
        "Outlet_Mid_MRP_Ratio": "mid",
        "Outlet_High_MRP_Ratio": "high",
        "Outlet_VHigh_MRP_Ratio": "vhigh",
        "Outlet_Type_Food_Ratio": "t_food",
        "Outlet_Type_Drinks_Ratio": "t_drinks",
        "Outlet_Type_NC_Ratio": "t_nc",
        "is_Grocery_Store": "CAST(rv.otype = 'Grocery Store' AS int)",
        "is_Supermarket_Type1": "CAST(rv.otype = 'Supermarket Type1' AS int)",
        "High_Visibility_Flag": "CAST(vis > 0.19 AS int)",
        "Visibility_per_MRP": "vis / (mrp + 0.000001)",
        "Price_per_Category_Mean": "mrp / (tp + 0.000001)",
        "Vis_per_Category_Mean": "vis / (tv + 0.000001)",
        "Item_MRP_sq": "mrp * mrp",
        "Outlet_Sales_Efficiency": f"coalesce({oof_value('o', True)}, (SELECT avg(s / (p + 0.000001)) FROM o_t))",
        "Price_Rank_in_Category": "price_rank",
        "Visibility_Rank_in_Category": "vis_rank",
    }
    text = {
        "Item_Fat_Content": "fat2",
        "Outlet_Size": "size2",
        "MRP_Bin": "bin",
        "Outlet_Era": "CASE WHEN est_year < 1990 THEN '1980s' WHEN est_year < 2000 THEN '1990s' ELSE '2000s' END",
        "Location_x_Type": "rv.loc || '_' || rv.otype",
    }
    columns = ["rv.okey", "rv.line", "rv.source"]
    columns += [f"{near_sql(e, digits(n))} AS {n}" for n, e in value.items()] + [f"{e} AS {n}" for n, e in text.items()]
    joins = (
        "LEFT JOIN it ON rv.item_id = it.item_id LEFT JOIN ou ON rv.outlet_id = ou.outlet_id LEFT JOIN ot ON rv.otype = ot.otype "
        "LEFT JOIN ty ON rv.item_type = ty.item_type LEFT JOIN se ON rv.outlet_id = se.outlet_id AND rv.item_type = se.item_type "
        f"LEFT JOIN pl ON rv.loc = pl.loc AND rv.category = pl.category {oof_join('item_id', 'i')} {oof_join('outlet_id', 'o')}"
    )
    return check(f"SELECT {', '.join(columns)} FROM g AS rv {joins}", *steps)



@query("profile_features", _profile_sql())
def profile_feature_table(spark, d):
    """All features of the profile plan before encoding."""
    table = profile_features(view(spark, d, spread=True), VIEW_ROLES, PREFIX_CATEGORY, FOLDS)
    return table.select(*K, F.col("_source").alias("source"), *[near(F.col(c).cast("double"), digits(c)).alias(c) for c in NUMBERS], *TEXTS)


PROFILE_SETTINGS = {"trials": 2, "rounds": 6, "patience": 3, "search_patience": 3, "space": {**TRIAL_SPACE, "max_depth": ("int", 3, 4)}}


@query("profile_plan")
def profile_plan(spark, d):
    """Tuned, bias-corrected predictions of the profile plan for the unlabelled rows."""
    return run_profile(view(spark, d, spread=True), VIEW_ROLES, PREFIX_CATEGORY, FOLDS, **PROFILE_SETTINGS).predictions


@query("race_plan")
def race_plan(spark, d):
    """The predictions of the race's winner for the unlabelled rows."""
    boosting = {"n_estimators": [3], "max_depth": [3, 4], "learning_rate": [0.3], "subsample": [0.6]}
    result = run_race(
        view(spark, d, spread=True), VIEW_ROLES, FOOD, FOLDS, lasso_alphas=(0.05, 0.1), ridge_alphas=(0.5,), degrees=(1,), boosting=boosting
    )
    return result.predictions


@query("ensemble_plan")
def ensemble_plan(spark, d):
    """The averaged log-scale predictions of two searched learners for the unlabelled rows."""
    space = {"n_estimators": ("int", 3, 4), "max_depth": ("int", 3, 4), "learning_rate": ("uniform", 0.2, 0.4), "subsample": ("uniform", 0.65, 0.95)}
    return run_ensemble(view(spark, d, spread=True), VIEW_ROLES, FOOD, FOLDS, draws=2, space=space).predictions

"""Fits small enough for SQL: the learners, searches and predictions against their closed forms.

The full-size fits of ``modelling`` use the same functions on all features.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.common import check, near, near_sql, query, view
from shelfcast.functions import metrics
from shelfcast.functions import scalar as S
from shelfcast.operators import models as M
from shelfcast.operators.moments import ridge_path
from shelfcast.sources.retail_view import FOLDS

ALPHAS = (1000.0, 1_000_000.0, 100_000_000.0)
EXACT = 1e-9
TWO_PENALTY, LASSO_PENALTY = 50_000.0, 2000.0


def table_of(spark, d, *features):
    rows = view(spark, d, "mrp", "est_year", "otype", "source", "fold", "sales", spread=True)
    rows = rows.withColumns(
        {"mrp": F.col("mrp").cast("double"), "year": (F.col("est_year") - 2000).cast("double"), "kind": (F.col("otype") == "Supermarket Type1").cast("double")}
    )
    return M.vectors(rows, list(features), "sales", ["source", "fold", "kind"]).df


def train_of(table):
    return table.filter("source = 'train'")


def moments_sql(name: str, where: str, by: str = "") -> str:
    """Centred sums of price, year and sales."""
    keys = f"{by}, " if by else ""
    return (
        f"{name} AS (SELECT {keys}CAST(count(*) AS double) AS n, avg(mrp) AS mx, avg(year) AS mz, avg(sales) AS my, "
        "var_pop(mrp) * count(*) AS xx, var_pop(year) * count(*) AS zz, covar_pop(mrp, year) * count(*) AS xz, "
        f"covar_pop(mrp, sales) * count(*) AS xy, covar_pop(year, sales) * count(*) AS zy FROM {where}{f' GROUP BY {by}' if by else ''})"
    )


TRAIN = "tr AS (SELECT CAST(mrp AS double) AS mrp, CAST(est_year - 2000 AS double) AS year, sales, fold FROM train)"


def coefficients(spark, model, *names):
    fitted = model.stages[-1]
    values = [*map(float, fitted.coefficients.toArray()), float(fitted.intercept)]
    row = spark.createDataFrame([tuple(values)], ", ".join(f"{n} double" for n in (*names, "intercept")))
    return row.select(*[near(c, 5).alias(c) for c in row.columns])


@query(
    "ridge_closed_form",
    check(
        f"SELECT {near_sql('wx', 5)} AS price, {near_sql('wz', 5)} AS year, {near_sql('my - wx * mx - wz * mz', 5)} AS intercept FROM w",
        TRAIN,
        moments_sql("m", "tr"),
        f"w AS (SELECT *, ((zz + {TWO_PENALTY}) * xy - xz * zy) / ((xx + {TWO_PENALTY}) * (zz + {TWO_PENALTY}) - xz * xz) AS wx, "
        f"((xx + {TWO_PENALTY}) * zy - xz * xy) / ((xx + {TWO_PENALTY}) * (zz + {TWO_PENALTY}) - xz * xz) AS wz FROM m)",
    ),
)
def ridge_closed_form(spark, d):
    """Two features: the penalised normal equation."""
    train = train_of(table_of(spark, d, "mrp", "year"))
    return coefficients(spark, M.ridge(train, TWO_PENALTY, tolerance=EXACT).fit(train), "price", "year")


@query(
    "lasso_soft_threshold",
    check(
        f"SELECT {near_sql('w', 5)} AS price, {near_sql('my - w * mx', 5)} AS intercept "
        f"FROM (SELECT *, sign(xy) * greatest(abs(xy) / n - {LASSO_PENALTY}, 0) / (xx / n) AS w FROM m)",
        TRAIN,
        moments_sql("m", "tr"),
    ),
)
def lasso_soft_threshold(spark, d):
    """One feature: its covariance, moved towards zero by the penalty."""
    train = train_of(table_of(spark, d, "mrp"))
    return coefficients(spark, M.lasso(LASSO_PENALTY, tolerance=EXACT).fit(train), "price")


def fold_steps(alphas) -> list[str]:
    """Ridge on the price outside each fold, and its predictions inside."""
    values = ", ".join(f"(CAST({a} AS double))" for a in alphas)
    sums = "SELECT f.fold AS held, tr.* FROM tr JOIN (SELECT DISTINCT fold FROM tr) f ON tr.fold <> f.fold"
    return [
        TRAIN,
        f"outside AS ({sums})",
        moments_sql("m", "outside", "held"),
        f"w AS (SELECT alpha, held, my, mx, xy / (xx + alpha) AS w FROM m CROSS JOIN (VALUES {values}) a(alpha))",
        "pr AS (SELECT alpha, fold, sales, my + w * (mrp - mx) AS p FROM tr JOIN w ON fold = held)",
        "scores AS (SELECT alpha, fold, sqrt(avg((sales - p) * (sales - p))) AS e, avg(p) AS p FROM pr GROUP BY alpha, fold)",
        "board AS (SELECT alpha, avg(e) AS rmse FROM scores GROUP BY alpha)",
    ]


def ridge_search(train):
    return M.search(train, "Ridge", M.grid({"alpha": ALPHAS}), lambda part, s: M.ridge(part, s["alpha"], tolerance=EXACT), FOLDS)


@query("ridge_grid_search", check(f"SELECT alpha, {near_sql('rmse')} AS rmse FROM board", *fold_steps(ALPHAS)))
def ridge_grid_search(spark, d):
    """The leaderboard of a search over penalties."""
    board, _, _ = ridge_search(train_of(table_of(spark, d, "mrp")))
    return board.select(F.get_json_object("params", "$.alpha").cast("double").alias("alpha"), near("rmse").alias("rmse"))


@query("ridge_path_closed_form", check(f"SELECT alpha, {near_sql('rmse')} AS rmse FROM board", *fold_steps(ALPHAS)))
def ridge_path_closed_form(spark, d):
    """The leaderboard of all penalties from the moments of the folds."""
    board, _, _ = ridge_path(train_of(table_of(spark, d, "mrp")), ALPHAS)
    return board.select(F.get_json_object("params", "$.alpha").cast("double").alias("alpha"), near("rmse").alias("rmse"))


@query(
    "ridge_out_of_fold",
    check(f"SELECT CAST(fold AS int) AS fold, {near_sql('e')} AS rmse, {near_sql('p')} AS mean FROM scores", *fold_steps(ALPHAS[1:2])),
)
def ridge_out_of_fold(spark, d):
    """Out-of-fold predictions, by fold."""
    found = M.oof_predict(train_of(table_of(spark, d, "mrp")), lambda part: M.ridge(part, ALPHAS[1], tolerance=EXACT), FOLDS)
    return found.groupBy("fold").agg(
        near(metrics.rmse("label", "prediction")).alias("rmse"), near(F.avg("prediction")).alias("mean")
    )


@query(
    "ridge_refit_best",
    check(
        f"SELECT best AS alpha, {near_sql('xy / (xx + best)', 5)} AS price, {near_sql('my - xy / (xx + best) * mx', 5)} AS intercept "
        "FROM whole CROSS JOIN (SELECT min_by(alpha, rmse) AS best FROM board)",
        *fold_steps(ALPHAS),
        moments_sql("whole", "tr"),
    ),
)
def ridge_refit_best(spark, d):
    """The best penalty of the search, fitted on all train rows."""
    train = train_of(table_of(spark, d, "mrp"))
    _, best, _ = ridge_search(train)
    model = M.ridge(train, best["alpha"], tolerance=EXACT).fit(train)
    return coefficients(spark, model, "price").select(F.lit(best["alpha"]).alias("alpha"), "*")


KIND = "CAST(otype = 'Supermarket Type1' AS int)"
ONE_SPLIT = {"n_estimators": 1, "max_depth": 1}


@query("gbt_one_split", check(f"SELECT CAST({KIND} AS double) AS kind, {near_sql('avg(sales)')} AS prediction FROM train GROUP BY 1"))
def gbt_one_split(spark, d):
    """One boosting round on a 0/1 feature predicts the group means."""
    train = train_of(table_of(spark, d, "kind"))
    return M.gbt(ONE_SPLIT).fit(train).transform(train).select("kind", near("prediction").alias("prediction")).distinct()


@query(
    "gbt_one_split_second",
    check(f"SELECT CAST({KIND} AS double) AS kind, {near_sql('avg(sales)')} AS prediction FROM train GROUP BY 1"),
)
def gbt_one_split_second(spark, d):
    """The second learner begins with the same tree: its own loss only shapes later rounds."""
    train = train_of(table_of(spark, d, "kind"))
    return M.gbt_second(ONE_SPLIT).fit(train).transform(train).select("kind", near("prediction").alias("prediction")).distinct()


@query(
    "gbt_score_batch",
    check(
        f"SELECT CAST({KIND} AS double) AS kind, count(*) AS n, {near_sql('max(m)')} AS sales FROM test "
        f"JOIN (SELECT {KIND} AS k, avg(sales) AS m FROM train GROUP BY 1) ON {KIND} = k GROUP BY 1"
    ),
)
def gbt_score_batch(spark, d):
    """A fitted booster on the unlabelled rows, floored at zero."""
    table = table_of(spark, d, "kind")
    scored = M.gbt(ONE_SPLIT).fit(train_of(table)).transform(table.filter("source = 'test'").drop("label"))
    return scored.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), near(F.max(S.floor_at("prediction"))).alias("sales"))


@query(
    "leaderboard_of_three",
    check(
        f"SELECT * FROM (SELECT 'Ridge' AS model, {near_sql('rmse')} AS rmse FROM board UNION ALL "
        f"SELECT 'GBT', {near_sql('avg(e)')} FROM (SELECT g.fold, sqrt(avg((sales - m) * (sales - m))) AS e FROM kinds g JOIN "
        "(SELECT held, k, avg(sales) AS m FROM (SELECT f.fold AS held, t.k, t.sales FROM kinds t JOIN (SELECT DISTINCT fold FROM kinds) f ON t.fold <> f.fold) "
        "GROUP BY held, k) o ON g.fold = o.held AND g.k = o.k GROUP BY g.fold))",
        *fold_steps(ALPHAS[:1]),
        f"kinds AS (SELECT {KIND} AS k, sales, fold FROM train)",
    ),
)
def leaderboard_of_three(spark, d):
    """Two model families on one board (each on its own slot of the vector)."""
    train = train_of(table_of(spark, d, "mrp", "kind"))
    candidates = [
        M.Candidate("Ridge", {}, lambda part: M.ridge(part, ALPHAS[0], tolerance=EXACT), [0]),
        M.Candidate("GBT", {}, lambda part: M.gbt(ONE_SPLIT), [1]),
    ]
    board = M.leaderboard(train, candidates, M.cross_validate(train, candidates, FOLDS))
    return board.select("model", near("rmse").alias("rmse"))

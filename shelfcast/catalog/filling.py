"""Imputation and zero repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.common import check, near, near_sql, query, view
from shelfcast.functions import scalar as S
from shelfcast.operators import impute as I
from shelfcast.operators.groupstats import group_stats, mean_of, median_of
from shelfcast.operators.knn import coded_blocks, fill_knn, neighbours
from shelfcast.session import materialise

K = ["okey", "line"]


@query("fill_constant", check("SELECT okey, line, coalesce(size, 'Small') AS size FROM rv"))
def fill_constant(spark, d):
    return I.fill_constant(view(spark, d, *K, "size"), {"size": "Small"})


MODE_STEP = """counts AS (SELECT source, size, count(*) AS n FROM rv WHERE size IS NOT NULL GROUP BY source, size),
modes AS (SELECT source, size AS m FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, size) AS k FROM counts) WHERE k = 1)"""


@query(
    "fill_global_mean_mode",
    check(
        f"SELECT okey, line, rv.source, coalesce(size, m) AS size, {near_sql('coalesce(weight, avg(weight) OVER (PARTITION BY rv.source))')} AS weight "
        "FROM rv JOIN modes ON rv.source = modes.source",
        MODE_STEP,
    ),
)
def fill_global_mean_mode(spark, d):
    rows = I.fill_own_mean_mode(view(spark, d, *K, "source", "size", "weight"), "source", "weight", "size")
    return rows.select(*K, "source", "size", near("weight").alias("weight"))


@query(
    "fill_group_mean",
    check(
        f"SELECT okey, line, {near_sql('own')} AS weight, {near_sql('coalesce(own, avg(own) OVER ())')} AS weight_global FROM f",
        "f AS (SELECT *, coalesce(weight, avg(weight) OVER (PARTITION BY item_id)) AS own FROM rv)",
    ),
)
def fill_group_mean(spark, d):
    rows = view(spark, d, *K, "item_id", "weight").withColumn("weight_global", F.col("weight"))
    rows = I.fill_group_mean(rows, ["item_id"], "weight")
    rows = I.fill_group_mean(rows, ["item_id"], "weight_global", global_fallback=True)
    return rows.select(*K, near("weight").alias("weight"), near("weight_global").alias("weight_global"))


@query(
    "fill_train_group_cascade",
    check(
        f"SELECT okey, line, source, {near_sql('coalesce(w1, avg(w1) OVER (PARTITION BY source, item_type))')} AS weight FROM f",
        "im AS (SELECT item_id, avg(weight) AS m FROM train GROUP BY item_id)",
        "f AS (SELECT rv.*, coalesce(weight, m) AS w1 FROM rv LEFT JOIN im ON rv.item_id = im.item_id)",
    ),
)
def fill_train_group_cascade(spark, d):
    rows = view(spark, d, *K, "source", "item_id", "item_type", "weight")
    filled = I.fill_cascade(rows, "source", ["item_id"], "item_type", "weight", first_on="train")
    return filled.select(*K, "source", near("weight").alias("weight"))


VISIBILITY_STEPS = (
    "v0 AS (SELECT *, nullif(visibility, 0) AS x FROM rv)",
    "v1 AS (SELECT *, coalesce(x, avg(x) OVER (PARTITION BY source, outlet_id, item_type)) AS x1 FROM v0)",
    "v2 AS (SELECT *, coalesce(x1, avg(x1) OVER (PARTITION BY source, item_type)) AS x2 FROM v1)",
)


@query(
    "fill_visibility_cascade",
    check(f"SELECT okey, line, source, {near_sql('x2', 6)} AS visibility FROM v2", *VISIBILITY_STEPS),
)
def fill_visibility_cascade(spark, d):
    rows = view(spark, d, *K, "source", "outlet_id", "item_type", "visibility")
    filled = I.fill_cascade(
        rows, "source", ["outlet_id", "item_type"], "item_type", "visibility", zero_is_missing=True
    )
    return filled.select(*K, "source", near("visibility", 6).alias("visibility"))


def mode_steps(size: str) -> tuple[str, str]:
    """The most frequent value of a size column per (location, type)."""
    return (
        f"{size}_n AS (SELECT loc, otype, {size} AS v, count(*) AS n FROM b WHERE {size} IS NOT NULL GROUP BY loc, otype, {size})",
        f"""{size}_m AS (SELECT loc, otype, v AS m FROM (
      SELECT *, row_number() OVER (PARTITION BY loc, otype ORDER BY n DESC, v) AS k FROM {size}_n) WHERE k = 1)""",
    )


# The sizes as they are, and without those of one (location, type) group, so that the fallbacks have work to do.
MODE_SQL = (
    "b AS (SELECT okey, line, loc, otype, size, CASE WHEN loc = 'Tier 1' AND otype = 'Grocery Store' THEN NULL ELSE size END AS gaps FROM rv)",
    *mode_steps("size"),
    *mode_steps("gaps"),
    """bf AS (SELECT b.okey, b.line, coalesce(b.size, s.m) AS s, coalesce(b.gaps, g.m) AS g FROM b
      LEFT JOIN size_m s ON b.loc = s.loc AND b.otype = s.otype LEFT JOIN gaps_m g ON b.loc = g.loc AND b.otype = g.otype)""",
    "sg AS (SELECT s AS v FROM bf WHERE s IS NOT NULL GROUP BY s ORDER BY count(*) DESC, s LIMIT 1)",
    "gg AS (SELECT g AS v FROM bf WHERE g IS NOT NULL GROUP BY g ORDER BY count(*) DESC, g LIMIT 1)",
)


@query(
    "fill_group_mode",
    check(
        "SELECT okey, line, coalesce(s, (SELECT v FROM sg)) AS size, coalesce(s, 'Medium') AS size_medium, "
        "coalesce(g, (SELECT v FROM gg)) AS gaps, coalesce(g, 'Medium') AS gaps_medium FROM bf",
        *MODE_SQL,
    ),
)
def fill_group_mode(spark, d):
    """The sizes, and the same without those of one group: no group of the tables lacks all its sizes."""
    rows = view(spark, d, *K, "loc", "otype", "size")
    blank = (F.col("loc") == "Tier 1") & (F.col("otype") == "Grocery Store")
    rows = rows.withColumn("gaps", F.when(blank, None).otherwise(F.col("size")))
    rows = rows.withColumns({"size_medium": F.col("size"), "gaps_medium": F.col("gaps")})
    filled = rows
    for value, default in (("size", None), ("size_medium", "Medium"), ("gaps", None), ("gaps_medium", "Medium")):
        filled = I.fill_group_mode(filled, ["loc", "otype"], value, default, fit_on=rows)
    return filled.select(*K, "size", "size_medium", "gaps", "gaps_medium")


@query("fill_cluster_mode")
def fill_cluster_mode(spark, d):
    rows = view(spark, d, *K, "loc", "otype", "size")
    filled = I.fill_cluster_mode(rows, "loc", "otype", "size", empty_group="Small", unknown="Medium")
    return filled.select(*K, "loc", "otype", "size")


@query(
    "fill_rule_lookup",
    check(
        "SELECT okey, line, coalesce(size, CASE otype WHEN 'Grocery Store' THEN 'Small' ELSE 'Medium' END) AS size, "
        "coalesce(size, CASE WHEN otype IN ('Grocery Store', 'Supermarket Type1') THEN 'Small' ELSE 'Medium' END) AS size_alt FROM rv"
    ),
)
def fill_rule_lookup(spark, d):
    rows = view(spark, d, *K, "otype", "size").withColumn("size_alt", F.col("size"))
    rows = I.fill_rule(rows, "otype", "size", S.SIZE_BY_TYPE, "Medium")
    return I.fill_rule(rows, "otype", "size_alt", S.SIZE_BY_TYPE_SMALL_FIRST, "Medium").drop("otype")


def repaired(spark, d, repair):
    rows = repair(view(spark, d, *K, "item_id", "outlet_id", "visibility"))
    return rows.select(*K, near("visibility", 6).alias("visibility"))


def repair_sql(value):
    return check(
        f"SELECT okey, line, {near_sql(f'CASE WHEN visibility = 0 THEN {value} ELSE visibility END', 6)} AS visibility FROM rv"
    )


@query("repair_zero_item_mean", repair_sql("avg(visibility) OVER (PARTITION BY item_id)"))
def repair_zero_item_mean(spark, d):
    return repaired(spark, d, lambda rows: I.repair_zero_mean(rows, "item_id", "visibility", 0.0))


@query("repair_zero_item_median", repair_sql("median(visibility) OVER (PARTITION BY item_id)"))
def repair_zero_item_median(spark, d):
    return repaired(spark, d, lambda rows: I.repair_zero_median(rows, "item_id", "visibility"))


@query(
    "repair_zero_nonzero_mean",
    repair_sql("coalesce(avg(nullif(visibility, 0)) OVER (PARTITION BY item_id), avg(visibility) OVER ())"),
)
def repair_zero_nonzero_mean(spark, d):
    return repaired(spark, d, lambda rows: I.repair_zero_nonzero_mean(rows, "item_id", "visibility"))


def cascade_sql(x):
    means = (f"avg({x}) OVER ({keys})" for keys in ("PARTITION BY item_id", "PARTITION BY outlet_id", ""))
    return near_sql("coalesce(CASE WHEN {0} = 0 THEN {1} ELSE {0} END, {2}, {3})".format(x, *means), 6)


@query(
    "repair_zero_cascade",
    check(
        f"SELECT okey, line, {cascade_sql('visibility')} AS visibility, {cascade_sql('x')} AS gaps FROM h",
        "h AS (SELECT *, CASE WHEN okey % 11 = 0 THEN NULL ELSE visibility END AS x FROM rv)",
    ),
)
def repair_zero_cascade(spark, d):
    """The visibilities, and the same with some blanked: the tables hold no nulls, which the later steps fill."""
    rows = view(spark, d, *K, "item_id", "outlet_id", "visibility")
    rows = rows.withColumn("gaps", F.when(F.col("okey") % 11 == 0, None).otherwise(F.col("visibility")))
    fixed = I.repair_zero_cascade(rows, "item_id", "outlet_id", "visibility", "gaps")
    return fixed.select(*K, near("visibility", 6).alias("visibility"), near("gaps", 6).alias("gaps"))


@query(
    "fill_leftover_train_mean",
    check(
        f"SELECT okey, line, source, {near_sql('coalesce(weight, (SELECT avg(weight) FROM train))')} AS weight, mrp, "
        "CASE WHEN source = 'test' AND okey % 3 = 0 THEN NULL ELSE mrp END AS gaps FROM rv"
    ),
)
def fill_leftover_train_mean(spark, d):
    """The price has no gaps; with gaps on the test side alone it is left alone as well."""
    rows = view(spark, d, *K, "source", "weight", "mrp")
    blank = (F.col("source") == "test") & (F.col("okey") % 3 == 0)
    rows = rows.withColumn("gaps", F.when(blank, None).otherwise(F.col("mrp")))
    filled = I.fill_train_means(rows.filter("source = 'train'"), rows, ["weight", "mrp", "gaps"])
    return filled.withColumn("weight", near("weight"))


@query(
    "fill_cold_start",
    check(
        f"SELECT okey, line, {near_sql('coalesce(popularity, (SELECT median(popularity) FROM st))')} AS popularity, "
        f"{near_sql('coalesce(mean_visibility, (SELECT avg(mean_visibility) FROM st))', 6)} AS mean_visibility, "
        f"{near_sql('coalesce(mean_sales, (SELECT avg(sales) FROM train))')} AS mean_sales "
        "FROM test LEFT JOIN st USING (item_id)",
        "st AS (SELECT item_id, count(*) AS popularity, avg(visibility) AS mean_visibility, avg(sales) AS mean_sales FROM train GROUP BY item_id)",
    ),
)
def fill_cold_start(spark, d):
    rows = view(spark, d, *K, "source", "item_id", "visibility", "sales")
    train, test = rows.filter("source = 'train'"), rows.filter("source = 'test'")
    stats = I.materialise(
        group_stats(
            train,
            ["item_id"],
            popularity=F.count(F.lit(1)),
            mean_visibility=F.avg("visibility"),
            mean_sales=F.avg("sales"),
        )
    )
    filled = I.fill_unseen(
        test,
        stats,
        ["item_id"],
        {
            "popularity": median_of(stats.df, "popularity"),
            "mean_visibility": mean_of(stats.df, "mean_visibility"),
            "mean_sales": mean_of(train, "sales"),
        },
    )
    return filled.select(
        *K,
        near("popularity").alias("popularity"),
        near("mean_visibility", 6).alias("mean_visibility"),
        near("mean_sales").alias("mean_sales"),
    )


def knn_rows(spark, d):
    """Codes of location and type (alphabetical), outlet age and price, as the neighbours see them."""
    rows = materialise(view(spark, d, *K, "loc", "otype", "est_year", "mrp", "size", spread=True), "rows").df
    codes = {"l": F.col("l"), "t": F.col("t"), "y": S.age("est_year")}
    return coded_blocks(rows, {"l": "loc", "t": "otype"}), codes


KNN_STEPS = (
    "pt AS (SELECT okey, line, size, CAST(right(loc, 1) AS int) - 1 AS l, "
    "CASE otype WHEN 'Grocery Store' THEN 0 ELSE CAST(right(otype, 1) AS int) END AS t, 2013 - est_year AS y, mrp AS p FROM rv)",
    "nq AS (SELECT DISTINCT l, t, y, p FROM pt WHERE size IS NULL)",
    "nr AS (SELECT l, t, y, p, size FROM pt WHERE size IS NOT NULL)",
    "nd AS (SELECT nq.l, nq.t, nq.y, nq.p, nr.size, "
    "sqrt(CAST((nr.l - nq.l) * (nr.l - nq.l) + (nr.t - nq.t) * (nr.t - nq.t) + (nr.y - nq.y) * (nr.y - nq.y) AS double) "
    "+ (nr.p - nq.p) * (nr.p - nq.p)) AS dist FROM nq, nr)",
    "nn AS (SELECT l, t, y, p, unnest(min({'d': dist, 's': size}, 5)) AS m FROM nd GROUP BY l, t, y, p)",
)


@query(
    "knn_top_k",
    check(
        f"SELECT l, t, y, p AS mrp, m.s AS size, {near_sql('m.d', 6)} AS distance, count(*) AS used FROM nn GROUP BY l, t, y, p, m.s, m.d",
        *KNN_STEPS,
    ),
)
def knn_top_k(spark, d):
    rows, codes = knn_rows(spark, d)
    near_points = neighbours(rows.withColumns(codes), ["l", "t", "y"], "mrp", "size", 5)
    merged = near_points.groupBy("l", "t", "y", "mrp", "size", "distance").agg(F.sum("used").alias("used"))
    return merged.withColumn("distance", near("distance", 6))


@query(
    "fill_knn",
    check(
        "SELECT okey, line, coalesce(size, v) AS size FROM pt LEFT JOIN best ON pt.l = best.l AND pt.t = best.t AND pt.y = best.y AND pt.p = best.p",
        *KNN_STEPS,
        "nz AS (SELECT *, min(m.d) OVER (PARTITION BY l, t, y, p) AS nearest FROM nn)",
        "wt AS (SELECT l, t, y, p, m.s AS s, sum(CASE WHEN nearest = 0 THEN CAST(m.d = 0 AS int) ELSE 1 / m.d END) AS w FROM nz GROUP BY l, t, y, p, m.s)",
        "best AS (SELECT l, t, y, p, s AS v FROM (SELECT *, row_number() OVER (PARTITION BY l, t, y, p ORDER BY w DESC, s) AS k FROM wt) WHERE k = 1)",
    ),
)
def fill_knn_query(spark, d):
    rows, codes = knn_rows(spark, d)
    return fill_knn(rows, codes, "mrp", "size", 5).select(*K, "size")

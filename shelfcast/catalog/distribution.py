"""Capping, power transform, scaling and bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.common import check, near, near_sql, query, view
from shelfcast.functions import scalar as S
from shelfcast.operators import distrib as D

K = ["okey", "line"]
COLUMNS = ["weight", "visibility", "mrp", "sales"]


def limits_sql(column, k="1.5", table="train"):
    q = [f"quantile_cont({column}, {p})" for p in (0.25, 0.75)]
    return f"SELECT '{column}' AS \"column\", {q[0]} - {k} * ({q[1]} - {q[0]}) AS lo, {q[1]} + {k} * ({q[1]} - {q[0]}) AS hi FROM {table}"


LIMITS = "lim AS (" + " UNION ALL ".join(limits_sql(c, "0.3") for c in COLUMNS) + ")"


@query(
    "iqr_limits",
    check(
        f"SELECT \"column\", {near_sql('lo')} AS lo, {near_sql('hi')} AS hi FROM lim15",
        "lim15 AS (" + " UNION ALL ".join(limits_sql(c) for c in COLUMNS) + ")",
    ),
)
def iqr_limits(spark, d):
    train = view(spark, d, *COLUMNS, "source").filter("source = 'train'")
    rows = [(c, lo, hi) for c, (lo, hi) in D.iqr_limits(train, COLUMNS).items()]
    return spark.createDataFrame(rows, "column string, lo double, hi double").withColumns(
        {"lo": near("lo"), "hi": near("hi")}
    )


def capped_sql(column):
    pick = f"(SELECT {{}} FROM lim WHERE \"column\" = '{column}')"
    return (
        f"CASE WHEN {column} < {pick.format('lo')} THEN {pick.format('lo')} "
        f"WHEN {column} > {pick.format('hi')} THEN {pick.format('hi')} ELSE {column} END"
    )


@query(
    "iqr_cap",
    check(
        "SELECT okey, line, source, " + ", ".join(f"{near_sql(capped_sql(c))} AS {c}" for c in COLUMNS[:3]) + " FROM rv",
        LIMITS,
    ),
)
def iqr_cap(spark, d):
    """Limits of the train rows on all rows; a narrow k so that many rows are capped."""
    rows = view(spark, d, *K, "source", *COLUMNS[:3])
    limits = D.iqr_limits(rows.filter("source = 'train'"), COLUMNS[:3], k=0.3)
    limits["not_there"] = (0.0, 1.0)
    return D.cap(rows, limits).withColumns({c: near(c) for c in COLUMNS[:3]})


@query("cap_target", check(f"SELECT okey, line, {near_sql(capped_sql('sales'))} AS sales FROM train", LIMITS))
def cap_target(spark, d):
    train = view(spark, d, *K, "sales", "source").filter("source = 'train'").drop("source")
    return D.cap(train, D.iqr_limits(train, ["sales"], k=0.3)).withColumn("sales", near("sales"))


def likelihood_sql(name, grid):
    """Log-likelihood of every power of ``grid`` from the counted values."""
    y = "CASE WHEN power = 0 THEN lx ELSE (exp(power * lx) - 1) / power END"
    return (
        f"{name} AS (SELECT power, (power - 1) * sum(n * lx) - sum(n) / 2.0 * ln(sum(n * y * y) / sum(n) - pow(sum(n * y) / sum(n), 2)) "
        f"AS log_likelihood FROM (SELECT power, lx, n, {y} AS y FROM ({grid}), counted) GROUP BY power)"
    )


def section_steps(levels=7):
    """The bracket around the best of 17 powers, narrowed eight times a level."""
    steps = ["counted AS (SELECT ln(visibility + 0.000001::double) AS lx, CAST(count(*) AS double) AS n FROM rv GROUP BY visibility)"]
    centre = "0.0::double"
    for level in range(levels):
        width = 0.25 / 8**level
        steps.append(likelihood_sql(f"s{level}", f"SELECT {centre} + (i - 8) * {width!r}::double AS power FROM range(17) t(i)"))
        centre = f"(SELECT max_by(power, log_likelihood) FROM s{level})"
    return [*steps, f"fitted AS (SELECT {centre} AS best)"]


@query(
    "boxcox_fit",
    check(
        f"SELECT power, {near_sql('log_likelihood', 2)} AS log_likelihood, {near_sql('best')} AS best FROM coarse, fitted",
        *section_steps(),
        likelihood_sql("coarse", "SELECT round(-2.0::double + i * 0.1::double, 10) AS power FROM range(41) t(i)"),
    ),
)
def boxcox_fit(spark, d):
    """The likelihood of a grid of powers, and the fitted power."""
    counted = D.counted_logs(view(spark, d, "visibility", spread=True), "visibility")
    best, grid = D.best_power(counted.likelihoods), D.power_grid(-2.0, 2.0, 0.1)
    rows = list(zip(grid, counted.likelihoods(grid), strict=True))
    found = spark.createDataFrame(rows, "power double, log_likelihood double")
    return found.select("power", near("log_likelihood", 2).alias("log_likelihood"), near(F.lit(best)).alias("best"))


@query(
    "boxcox_apply",
    check(
        f"SELECT okey, line, {near_sql('(pow(mrp, 0.3) - 1) / 0.3')} AS transformed, {near_sql('ln(mrp)')} AS logged FROM rv"
    ),
)
def boxcox_apply(spark, d):
    return view(spark, d, *K, "mrp").select(
        *K, near(S.box_cox("mrp", 0.3)).alias("transformed"), near(S.box_cox("mrp", 0)).alias("logged")
    )


@query(
    "standard_scale",
    check(
        "SELECT okey, line, source, "
        + ", ".join(
            f"{near_sql(f'({c} - (SELECT avg({c}) FROM train)) / (SELECT stddev_pop({c}) FROM train)')} AS {c}"
            for c in ("weight", "visibility", "mrp")
        )
        + ", 0.0::double AS constant FROM rv"
    ),
)
def standard_scale(spark, d):
    rows = view(spark, d, *K, "source", "weight", "visibility", "mrp").withColumn("constant", F.lit(7.0))
    columns = ["weight", "visibility", "mrp", "constant"]
    scaled = D.scale(rows, D.fit_scale(rows.filter("source = 'train'"), columns))
    return scaled.withColumns({c: near(c) for c in columns[:3]})


@query(
    "bin_fixed",
    check(
        "SELECT okey, line, CASE WHEN mrp < 70 THEN 'Low_MRP' WHEN mrp < 135 THEN 'Mid_MRP' WHEN mrp < 200 THEN 'High_MRP' "
        "ELSE 'VHigh_MRP' END AS bin, CASE WHEN mrp < 70 THEN 'Low' WHEN mrp < 140 THEN 'Medium' WHEN mrp < 210 THEN 'High' "
        "WHEN mrp < (SELECT max(mrp) FROM rv) THEN 'Very High' END AS bin_max FROM rv"
    ),
)
def bin_fixed(spark, d):
    """Open top edge, and the maximum as top edge (its own row then falls outside)."""
    rows = view(spark, d, *K, "mrp")
    top = rows.agg(F.max("mrp")).scalar()
    return rows.select(
        *K,
        S.bin_left_closed("mrp", S.PRICE_EDGES, S.PRICE_LABELS).alias("bin"),
        S.bin_left_closed("mrp", [*S.PRICE_EDGES_WIDE, top], S.PRICE_LABELS_WIDE).alias("bin_max"),
    )


QUARTER = "CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= q[1] THEN {l[0]} WHEN {x} <= q[2] THEN {l[1]} WHEN {x} <= q[3] THEN {l[2]} ELSE {l[3]} END"


@query(
    "bin_train_quartile",
    check(
        "SELECT okey, line, source, coalesce(b, (SELECT m FROM top)) AS quartile FROM binned",
        "edges AS (SELECT quantile_cont(weight, [0.25, 0.5, 0.75]) AS q FROM train)",
        "binned AS (SELECT okey, line, source, " + QUARTER.format(x="weight", l=["'Q1'", "'Q2'", "'Q3'", "'Q4'"]) + " AS b FROM rv, edges)",
        "top AS (SELECT b AS m FROM binned WHERE source = 'train' AND b IS NOT NULL GROUP BY b ORDER BY count(*) DESC, b LIMIT 1)",
    ),
)
def bin_train_quartile(spark, d):
    """On the weight, which has gaps to be filled with the train rows' most frequent bin."""
    rows = view(spark, d, *K, "source", "weight")
    binned = D.bin_by_quartiles(
        rows.filter("source = 'train'"), rows, "weight", "quartile", ["Q1", "Q2", "Q3", "Q4"], fill_with_mode=True
    )
    return binned.drop("weight")


@query(
    "bin_quantile",
    check(
        "SELECT okey, line, " + QUARTER.format(x="mrp", l=["'Low'", "'Medium'", "'High'", "'Very High'"]) + " AS tier FROM rv, edges",
        "edges AS (SELECT quantile_cont(mrp, [0.25, 0.5, 0.75]) AS q FROM rv)",
    ),
)
def bin_quantile(spark, d):
    return D.bin_by_quantiles(view(spark, d, *K, "mrp"), "mrp", "tier", S.PRICE_LABELS_WIDE).drop("mrp")

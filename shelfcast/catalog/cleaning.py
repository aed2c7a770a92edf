"""Cleaning and scalar derivations: one projection each, no shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.common import check, near, near_sql, query, view
from shelfcast.functions import scalar as S
from shelfcast.operators.distrib import fill_non_finite
from shelfcast.sources.retail_view import PREFIX_CATEGORY

K = ["okey", "line"]
FAT_SQL = (
    "CASE fat WHEN 'LF' THEN 'Low Fat' WHEN 'low fat' THEN 'Low Fat' WHEN 'reg' THEN 'Regular' "
    "WHEN 'Non Edible' THEN 'Non-Edible' ELSE fat END"
)


@query("remap_values", check(f"SELECT okey, line, {FAT_SQL} AS fat FROM rv"))
def remap_values(spark, d):
    return view(spark, d, *K, "fat").withColumn("fat", S.remap("fat", S.FAT_CONTENT))


@query("prefix_category", check("SELECT okey, line, coalesce(category, 'Non-Consumable') AS category FROM cat"))
def prefix_category(spark, d):
    """Known food and drink prefixes, everything else non-consumable."""
    known = {k: v for k, v in PREFIX_CATEGORY.items() if v != "Non-Consumable"}
    return view(spark, d, *K, "item_id").select(*K, S.prefix_category("item_id", known, "Non-Consumable").alias("category"))


@query("prefix_category_strict", check("SELECT okey, line, category FROM cat"))
def prefix_category_strict(spark, d):
    return view(spark, d, *K, "item_id").select(*K, S.prefix_category("item_id", PREFIX_CATEGORY).alias("category"))


@query(
    "prefix_category_enum",
    check(
        "SELECT okey, line, CASE WHEN right(p, 1) IN ('0', '1') AND left(p, 2) IN ('BL', 'CO', 'HO') THEN 'Food' "
        "WHEN right(p, 1) = '0' AND left(p, 2) = 'LA' THEN 'Drinks' ELSE p END AS category "
        "FROM (SELECT *, left(item_id, 3) AS p FROM rv)"
    ),
)
def prefix_category_enum(spark, d):
    """Only listed three-character prefixes are translated; LA0 is, NE0 and RE0 are not."""
    mapping = {"BL0": "Food", "BL1": "Food", "CO0": "Food", "CO1": "Food", "HO0": "Food", "HO1": "Food", "LA0": "Drinks"}
    return view(spark, d, *K, "item_id").select(*K, S.prefix_category_enum("item_id", mapping).alias("category"))


@query("prefix_raw", check("SELECT okey, line, left(item_id, 2) AS prefix FROM rv"))
def prefix_raw(spark, d):
    return view(spark, d, *K, "item_id").select(*K, S.prefix("item_id").alias("prefix"))


@query(
    "conditional_override",
    check(f"SELECT okey, line, CASE WHEN category = 'Non-Consumable' THEN 'Non-Edible' ELSE {FAT_SQL} END AS fat FROM cat"),
)
def conditional_override(spark, d):
    nonfood = S.prefix_category("item_id", PREFIX_CATEGORY) == "Non-Consumable"
    rows = view(spark, d, *K, "item_id", "fat")
    return rows.select(*K, S.override_where(S.remap("fat", S.FAT_CONTENT), nonfood, "Non-Edible").alias("fat"))


@query("age_from_year", check("SELECT okey, line, CAST(2013 - est_year AS int) AS age, CAST(2025 - est_year AS int) AS age_2025 FROM rv"))
def age_from_year(spark, d):
    return view(spark, d, *K, "est_year").select(*K, S.age("est_year").alias("age"), S.age("est_year", 2025).alias("age_2025"))


@query(
    "era_bucket",
    check(
        "SELECT okey, line, CASE WHEN est_year < 1990 THEN '1980s' WHEN est_year < 2000 THEN '1990s' ELSE '2000s' END AS era FROM rv"
    ),
)
def era_bucket(spark, d):
    year = F.lit(S.REFERENCE_YEAR) - S.age("est_year")
    return view(spark, d, *K, "est_year").select(*K, S.era(year).alias("era"))


@query(
    "binary_flag",
    check(
        "SELECT okey, line, CAST(otype = 'Grocery Store' AS int) AS is_grocery, CAST(otype = 'Supermarket Type1' AS int) AS is_type1, "
        "CAST(visibility > 0.09 AS int) AS high_visibility, CAST(coalesce(size = 'High', false) AS int) AS is_high FROM rv"
    ),
)
def binary_flag(spark, d):
    return view(spark, d, *K, "otype", "visibility", "size").select(
        *K,
        S.flag(F.col("otype") == "Grocery Store").alias("is_grocery"),
        S.flag(F.col("otype") == "Supermarket Type1").alias("is_type1"),
        S.flag(F.col("visibility") > 0.09).alias("high_visibility"),
        S.flag(F.col("size") == "High").alias("is_high"),
    )


@query("string_interaction", check("SELECT okey, line, loc || '_' || coalesce(size, 'nan') AS loc_x_size FROM rv"))
def string_interaction(spark, d):
    return view(spark, d, *K, "loc", "size").select(*K, S.joined_text("loc", "size").alias("loc_x_size"))


@query("last_char_int", check("SELECT okey, line, CAST(right(loc, 1) AS int) AS tier FROM rv"))
def last_char_int(spark, d):
    return view(spark, d, *K, "loc").select(*K, S.last_digit("loc").alias("tier"))


SIZE_SQL = "CASE size WHEN 'Small' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 ELSE 0 END"
TIER_SQL = "CASE loc WHEN 'Tier 1' THEN 3 WHEN 'Tier 2' THEN 2 WHEN 'Tier 3' THEN 1 ELSE 0 END"


@query("ordinal_map", check(f"SELECT okey, line, {SIZE_SQL} AS size_score, {TIER_SQL} AS tier_score FROM rv"))
def ordinal_map(spark, d):
    return view(spark, d, *K, "size", "loc").select(
        *K,
        S.map_value("size", S.SIZE_SCORE, 0).alias("size_score"),
        S.map_value("loc", S.TIER_SCORE, 0).alias("tier_score"),
    )


@query("interaction_score", check(f"SELECT okey, line, ({SIZE_SQL}) * ({TIER_SQL}) AS score FROM rv"))
def interaction_score(spark, d):
    score = S.map_value("size", S.SIZE_SCORE, 0) * S.map_value("loc", S.TIER_SCORE, 0)
    return view(spark, d, *K, "size", "loc").select(*K, score.alias("score"))


@query(
    "numeric_interactions",
    check(
        f"SELECT okey, line, {near_sql('mrp / (weight + 0.00001)')} AS price_per_weight, "
        f"{near_sql('mrp / (visibility + 0.00001)')} AS price_to_visibility, {near_sql('weight * mrp')} AS weight_x_price, "
        f"{near_sql('CASE WHEN size IS NULL THEN NULL ELSE (' + SIZE_SQL + ') * visibility END')} AS size_x_visibility FROM rv"
    ),
)
def numeric_interactions(spark, d):
    rows = view(spark, d, *K, "mrp", "weight", "visibility", "size")
    return rows.select(
        *K,
        near(S.ratio("mrp", "weight", 1e-5)).alias("price_per_weight"),
        near(S.ratio("mrp", "visibility", 1e-5)).alias("price_to_visibility"),
        near(F.col("weight") * F.col("mrp")).alias("weight_x_price"),
        near(S.map_value("size", S.SIZE_SCORE) * F.col("visibility")).alias("size_x_visibility"),
    )


@query(
    "price_per_unit",
    check(
        f"SELECT okey, line, {near_sql('mrp / CASE WHEN weight = 0 THEN 0.000001 ELSE weight END')} AS per_unit, "
        f"{near_sql('mrp / (weight + 0.000001)')} AS per_unit_shifted FROM rv"
    ),
)
def price_per_unit(spark, d):
    return view(spark, d, *K, "mrp", "weight").select(
        *K,
        near(S.price_per_unit("mrp", "weight")).alias("per_unit"),
        near(S.ratio("mrp", "weight", 1e-6)).alias("per_unit_shifted"),
    )


@query("visibility_per_price", check(f"SELECT okey, line, {near_sql('visibility / (mrp + 0.000001)', 7)} AS v FROM rv"))
def visibility_per_price(spark, d):
    return view(spark, d, *K, "mrp", "visibility").select(*K, near(S.ratio("visibility", "mrp", 1e-6), 7).alias("v"))


@query("square_term", check(f"SELECT okey, line, {near_sql('mrp * mrp')} AS mrp_sq FROM rv"))
def square_term(spark, d):
    return view(spark, d, *K, "mrp").select(*K, near(F.pow("mrp", F.lit(2))).alias("mrp_sq"))


@query("log_target", check(f"SELECT okey, line, {near_sql('ln(1 + sales)')} AS log_sales FROM train"))
def log_target(spark, d):
    return view(spark, d, *K, "sales", "source").filter("source = 'train'").select(*K, near(F.log1p("sales")).alias("log_sales"))


@query("exp_prediction", check(f"SELECT okey, line, {near_sql('exp(mrp / 40) - 1', 3)} AS prediction FROM rv"))
def exp_prediction(spark, d):
    return view(spark, d, *K, "mrp").select(*K, near(F.expm1(F.col("mrp") / 40), 3).alias("prediction"))


@query("clip_floor", check(f"SELECT okey, line, {near_sql('greatest(mrp - 100, 0)')} AS clipped FROM rv"))
def clip_floor(spark, d):
    return view(spark, d, *K, "mrp").select(*K, near(S.floor_at(F.col("mrp") - 100)).alias("clipped"))


@query(
    "inf_to_null_fill",
    check(
        f"SELECT okey, line, {near_sql('coalesce(mrp / nullif(visibility, 0), 0)')} AS zero_filled, "
        f"{near_sql('coalesce(mrp / nullif(visibility, 0), (SELECT avg(mrp / nullif(visibility, 0)) FROM rv))')} AS mean_filled FROM rv"
    ),
)
def inf_to_null_fill(spark, d):
    rows = view(spark, d, *K, "mrp", "visibility").withColumn(
        "zero_filled",
        F.when(F.col("visibility") == 0, F.lit(float("inf"))).otherwise(S.ratio("mrp", "visibility")),
    )
    rows = rows.withColumn("mean_filled", F.col("zero_filled")).select(*K, "zero_filled", "mean_filled")
    filled = fill_non_finite(fill_non_finite(rows, ["zero_filled"]), ["mean_filled"], with_mean=True)
    return filled.withColumns({c: near(c) for c in ("zero_filled", "mean_filled")})

"""Group statistics joined back as features, and their leak-safe variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.common import check, near, near_sql, query, view
from shelfcast.functions import scalar as S
from shelfcast.operators import folds as O
from shelfcast.operators import groupstats as G
from shelfcast.operators.buckets import BucketedRows
from shelfcast.operators.joins import attach, lookup
from shelfcast.operators.order_stats import group_mode
from shelfcast.session import materialise
from shelfcast.sources.retail_view import FOLDS, PREFIX_CATEGORY

K = ["okey", "line"]


def category():
    return S.prefix_category("item_id", PREFIX_CATEGORY)


def split(rows):
    return rows.filter("source = 'train'"), rows.filter("source = 'test'")


@query(
    "left_join_stats",
    check(
        f"SELECT okey, line, {near_sql('m', 6)} AS mean_visibility FROM rv LEFT JOIN s ON rv.outlet_id = s.outlet_id AND rv.item_type = s.item_type",
        "s AS (SELECT outlet_id, item_type, avg(visibility) AS m FROM train GROUP BY outlet_id, item_type)",
    ),
)
def left_join_stats(spark, d):
    rows = view(spark, d, *K, "source", "outlet_id", "item_type", "visibility")
    keys = ["outlet_id", "item_type"]
    joined = attach(rows, G.group_mean(split(rows)[0], keys, "visibility", "m"), keys)
    return joined.select(*K, near("m", 6).alias("mean_visibility"))


ITEM_SALES = "s AS (SELECT item_id, avg(sales) AS m FROM train GROUP BY item_id)"


@query(
    "map_lookup",
    check(f"SELECT okey, line, {near_sql('coalesce(m, -1)')} AS v FROM rv LEFT JOIN s ON rv.item_id = s.item_id", ITEM_SALES),
)
def map_lookup(spark, d):
    rows = view(spark, d, *K, "source", "item_id", "sales")
    means = G.group_mean(split(rows)[0], ["item_id"], "sales", "m")
    return lookup(rows, means, ["item_id"], "m", "v", default=-1.0).select(*K, near("v").alias("v"))


PAIRS = "p AS (SELECT category, otype, avg(ln(1 + sales)) AS m FROM train WHERE category IS NOT NULL GROUP BY category, otype)"


@query(
    "composite_key_lookup",
    check(
        f"SELECT okey, line, {near_sql('coalesce(m, (SELECT avg(m) FROM p))', 6)} AS v "
        "FROM cat LEFT JOIN p ON cat.category = p.category AND cat.otype = p.otype",
        PAIRS,
    ),
)
def composite_key_lookup(spark, d):
    rows = view(spark, d, *K, "source", "item_id", "otype", "sales").withColumn("category", category())
    means = materialise(G.group_mean(split(rows)[0], ["category", "otype"], F.log1p("sales"), "m"))
    default = G.mean_of(means.df, "m")
    return lookup(rows, means, ["category", "otype"], "m", "v", default).select(*K, near("v", 6).alias("v"))


@query(
    "group_mean",
    check(
        f"SELECT outlet_id, item_type, {near_sql('avg(sales)')} AS mean_sales, {near_sql('avg(weight)')} AS mean_weight "
        "FROM train GROUP BY outlet_id, item_type"
    ),
)
def group_mean(spark, d):
    train = split(view(spark, d, "source", "outlet_id", "item_type", "sales", "weight"))[0]
    stats = G.group_stats(train, ["outlet_id", "item_type"], mean_sales=F.avg("sales"), mean_weight=F.avg("weight"))
    return stats.withColumns({"mean_sales": near("mean_sales"), "mean_weight": near("mean_weight")})


@query(
    "group_broadcast_mean",
    check(f"SELECT okey, line, {near_sql('avg(visibility) OVER (PARTITION BY outlet_id)', 6)} AS m FROM rv"),
)
def group_broadcast_mean(spark, d):
    rows = view(spark, d, *K, "outlet_id", "visibility")
    return G.broadcast_mean(rows, ["outlet_id"], "visibility", "m").select(*K, near("m", 6).alias("m"))


@query(
    "group_mode",
    check(
        "SELECT a.outlet_id, coalesce(t.item_type, 'none') AS item_type, coalesce(z.size, 'Small') AS size FROM a "
        "LEFT JOIN t ON a.outlet_id = t.outlet_id AND t.k = 1 LEFT JOIN z ON a.outlet_id = z.outlet_id AND z.k = 1",
        "a AS (SELECT DISTINCT outlet_id FROM rv)",
        "t AS (SELECT outlet_id, item_type, row_number() OVER (PARTITION BY outlet_id ORDER BY count(*) DESC, item_type) AS k FROM rv GROUP BY outlet_id, item_type)",
        "z AS (SELECT outlet_id, size, row_number() OVER (PARTITION BY outlet_id ORDER BY count(*) DESC, size) AS k FROM rv WHERE size IS NOT NULL GROUP BY outlet_id, size)",
    ),
)
def group_mode_query(spark, d):
    """Outlets without any size get the fallback."""
    rows = view(spark, d, "outlet_id", "item_type", "size")
    outlets = rows.select("outlet_id").distinct()
    found = attach(outlets, group_mode(rows, ["outlet_id"], "item_type", "item_type"), ["outlet_id"])
    found = attach(found, group_mode(rows, ["outlet_id"], "size", "size"), ["outlet_id"])
    return found.fillna({"item_type": "none", "size": "Small"})


@query(
    "group_min_first_seen",
    check(
        "SELECT okey, line, source, CAST(coalesce(a, CASE WHEN source = 'test' THEN (SELECT median(a) FROM tr) END) AS double) AS item_age "
        "FROM rv LEFT JOIN s ON rv.item_id = s.item_id",
        "s AS (SELECT item_id, 2013 - min(est_year) AS a FROM train GROUP BY item_id)",
        "tr AS (SELECT a FROM train JOIN s ON train.item_id = s.item_id)",
    ),
)
def group_min_first_seen(spark, d):
    """The median runs over train rows; the item table weighted by its rows stands for them."""
    rows = view(spark, d, *K, "source", "item_id", "est_year")
    stats = materialise(
        G.group_stats(
            split(rows)[0],
            ["item_id"],
            item_age=(F.lit(S.REFERENCE_YEAR) - F.min("est_year")).cast("double"),
            n=F.count(F.lit(1)),
        )
    )
    default = G.median_of(stats.df, "item_age", "n")
    joined = attach(rows, stats, ["item_id"])
    age = F.coalesce(F.col("item_age"), F.when(F.col("source") == "test", default))
    return joined.select(*K, "source", age.alias("item_age"))


@query("item_frequency", check("SELECT okey, line, count(*) OVER (PARTITION BY item_id) AS frequency FROM rv"))
def item_frequency(spark, d):
    rows = view(spark, d, *K, "item_id")
    counts = G.group_stats(rows, ["item_id"], frequency=F.count(F.lit(1)))
    return attach(rows, counts, ["item_id"]).drop("item_id")


@query(
    "item_popularity",
    check(
        "SELECT okey, line, source, CAST(coalesce(n, (SELECT median(n) FROM s)) AS double) AS popularity FROM rv LEFT JOIN s ON rv.item_id = s.item_id",
        "s AS (SELECT item_id, count(*) AS n FROM train GROUP BY item_id)",
    ),
)
def item_popularity(spark, d):
    rows = view(spark, d, *K, "source", "item_id")
    counts = materialise(G.group_stats(split(rows)[0], ["item_id"], n=F.count(F.lit(1)).cast("double")))
    found = lookup(rows, counts, ["item_id"], "n", "popularity", G.median_of(counts.df, "n"))
    return found.drop("item_id")


@query(
    "outlet_stats",
    check(f"SELECT outlet_id, count(DISTINCT item_id) AS item_count, {near_sql('avg(sales)')} AS mean_sales FROM train GROUP BY outlet_id"),
)
def outlet_stats(spark, d):
    train = split(view(spark, d, "source", "outlet_id", "item_id", "sales"))[0]
    return G.outlet_stats(train, "outlet_id", "item_id", "sales").withColumn("mean_sales", near("mean_sales"))


def share_sql(key, category, outputs):
    counts = ", ".join(f"count(DISTINCT CASE WHEN {category} = '{v}' THEN item_id END) AS n{i}" for i, v in enumerate(outputs))
    total = " + ".join(f"n{i}" for i in range(len(outputs)))
    shares = ", ".join(near_sql(f"n{i} / CAST({total} AS double)", 6) + f" AS {name}" for i, name in enumerate(outputs.values()))
    return check(
        f"SELECT {key}, {shares} FROM c WHERE {total} > 0",
        "b AS (SELECT *, CASE WHEN mrp < 70 THEN 'Low_MRP' WHEN mrp < 135 THEN 'Mid_MRP' WHEN mrp < 200 THEN 'High_MRP' ELSE 'VHigh_MRP' END AS bin FROM train)",
        f"c AS (SELECT {key}, {counts} FROM b GROUP BY {key})",
    )


CATEGORY_SHARES = {"Food": "food_ratio", "Drinks": "drinks_ratio", "Non-Consumable": "nc_ratio"}
BIN_SHARES = {"Low_MRP": "low_ratio", "Mid_MRP": "mid_ratio", "High_MRP": "high_ratio", "VHigh_MRP": "vhigh_ratio"}


def share(spark, d, key, by_bin):
    rows = split(view(spark, d, "source", key, "item_id", *(["mrp"] if by_bin else [])))[0]
    value = S.bin_left_closed("mrp", S.PRICE_EDGES, S.PRICE_LABELS) if by_bin else category()
    outputs = BIN_SHARES if by_bin else CATEGORY_SHARES
    shares = G.distinct_share(rows.withColumn("c", value), key, "c", "item_id", outputs, complete=True)
    return shares.withColumns({c: near(c, 6) for c in outputs.values()})


@query("pivot_distinct_ratio_outlet", share_sql("outlet_id", "category", CATEGORY_SHARES))
def pivot_distinct_ratio_outlet(spark, d):
    return share(spark, d, "outlet_id", False)


@query("pivot_distinct_ratio_price_bin", share_sql("outlet_id", "bin", BIN_SHARES))
def pivot_distinct_ratio_price_bin(spark, d):
    return share(spark, d, "outlet_id", True)


@query("pivot_distinct_ratio_outlet_type", share_sql("otype", "category", CATEGORY_SHARES))
def pivot_distinct_ratio_outlet_type(spark, d):
    return share(spark, d, "otype", False)


@query(
    "ratio_to_item_mean",
    check(
        f"SELECT okey, line, {near_sql('visibility / (coalesce(m, (SELECT avg(m) FROM s)) + 0.000001)')} AS ratio FROM rv LEFT JOIN s ON rv.item_id = s.item_id",
        "s AS (SELECT item_id, avg(visibility) AS m FROM train GROUP BY item_id)",
    ),
)
def ratio_to_item_mean(spark, d):
    rows = view(spark, d, *K, "source", "item_id", "visibility")
    stats = materialise(G.group_mean(split(rows)[0], ["item_id"], "visibility", "m"))
    found = G.ratio_to_mean(
        rows, stats, ["item_id"], "visibility", "m", "ratio", 1e-6, unseen_mean=G.mean_of(stats.df, "m")
    )
    return found.select(*K, near("ratio").alias("ratio"))


@query(
    "ratio_to_group_mean",
    check(
        f"SELECT okey, line, {near_sql('coalesce(visibility / nullif(m, 0), 1)')} AS ratio FROM rv LEFT JOIN s ON rv.outlet_id = s.outlet_id AND rv.item_type = s.item_type",
        "s AS (SELECT outlet_id, item_type, avg(visibility) AS m FROM train GROUP BY outlet_id, item_type)",
    ),
)
def ratio_to_group_mean(spark, d):
    rows = view(spark, d, *K, "source", "outlet_id", "item_type", "visibility")
    keys = ["outlet_id", "item_type"]
    stats = G.group_mean(split(rows)[0], keys, "visibility", "m")
    found = G.ratio_to_mean(rows, stats, keys, "visibility", "m", "ratio", unseen_ratio=1.0)
    return found.select(*K, near("ratio").alias("ratio"))


@query(
    "ratio_to_outlet_mean",
    check(f"SELECT okey, line, {near_sql('visibility / avg(visibility) OVER (PARTITION BY outlet_id)')} AS ratio FROM rv"),
)
def ratio_to_outlet_mean(spark, d):
    rows = view(spark, d, *K, "outlet_id", "visibility")
    stats = G.group_mean(rows, ["outlet_id"], "visibility", "m")
    return G.ratio_to_mean(rows, stats, ["outlet_id"], "visibility", "m", "ratio").select(*K, near("ratio").alias("ratio"))


@query(
    "ratio_to_global_mean",
    check(f"SELECT okey, line, {near_sql('coalesce(weight / nullif((SELECT avg(weight) FROM train), 0), 0)')} AS ratio FROM rv"),
)
def ratio_to_global_mean(spark, d):
    rows = view(spark, d, *K, "source", "weight")
    ratio = F.coalesce(S.ratio("weight", G.mean_of(split(rows)[0], "weight")), F.lit(0.0))
    return rows.select(*K, near(ratio).alias("ratio"))


@query(
    "price_to_outlet_mean_ratio",
    check(
        f"SELECT okey, line, {near_sql('mrp / coalesce(m, (SELECT median(m) FROM tr))')} AS ratio FROM rv LEFT JOIN s ON rv.outlet_id = s.outlet_id",
        "s AS (SELECT outlet_id, avg(mrp) AS m FROM train GROUP BY outlet_id)",
        "tr AS (SELECT m FROM train JOIN s ON train.outlet_id = s.outlet_id)",
    ),
)
def price_to_outlet_mean_ratio(spark, d):
    rows = view(spark, d, *K, "source", "outlet_id", "mrp")
    stats = materialise(G.group_stats(split(rows)[0], ["outlet_id"], m=F.avg("mrp"), n=F.count(F.lit(1))))
    default = G.median_of(stats.df, "m", "n")
    found = G.ratio_to_mean(rows, stats.df.drop("n"), ["outlet_id"], "mrp", "m", "ratio", unseen_mean=default)
    return found.select(*K, near("ratio").alias("ratio"))


def type_ratio(spark, d, value):
    rows = view(spark, d, *K, "source", "item_type", value)
    stats = G.group_mean(split(rows)[0], ["item_type"], value, "m")
    found = G.ratio_to_mean(rows, stats, ["item_type"], value, "m", "ratio", 1e-6, unseen_ratio=1.0)
    return found.select(*K, near("ratio").alias("ratio"))


def type_ratio_sql(value):
    return check(
        f"SELECT okey, line, {near_sql(f'coalesce({value} / (m + 0.000001), 1)')} AS ratio FROM rv LEFT JOIN s ON rv.item_type = s.item_type",
        f"s AS (SELECT item_type, avg({value}) AS m FROM train GROUP BY item_type)",
    )


@query("price_to_category_mean_ratio", type_ratio_sql("mrp"))
def price_to_category_mean_ratio(spark, d):
    return type_ratio(spark, d, "mrp")


@query("visibility_to_category_mean_ratio", type_ratio_sql("visibility"))
def visibility_to_category_mean_ratio(spark, d):
    return type_ratio(spark, d, "visibility")


@query(
    "age_ratio",
    check(
        f"SELECT okey, line, {near_sql('(2013 - est_year) / CAST(a + 1 AS double)')} AS ratio FROM rv LEFT JOIN s ON rv.item_id = s.item_id",
        "s AS (SELECT item_id, 2013 - min(est_year) AS a FROM train GROUP BY item_id)",
    ),
)
def age_ratio(spark, d):
    rows = view(spark, d, *K, "source", "item_id", "est_year")
    ages = G.item_first_year(split(rows)[0], "item_id", "est_year", S.REFERENCE_YEAR, "item_age")
    joined = attach(rows, ages, ["item_id"])
    return joined.select(*K, near(S.ratio(S.age("est_year"), "item_age", 1.0)).alias("ratio"))


@query(
    "target_mean_two_key",
    check(
        f"SELECT okey, line, {near_sql('coalesce(p.m, (SELECT avg(m) FROM p))', 6)} AS by_type, "
        f"{near_sql('coalesce(o.m, (SELECT avg(m) FROM o))', 6)} AS by_outlet FROM cat "
        "LEFT JOIN p ON cat.category = p.category AND cat.otype = p.otype "
        "LEFT JOIN o ON cat.category = o.category AND cat.outlet_id = o.outlet_id",
        "p AS (SELECT category, otype, avg(ln(1 + sales)) AS m FROM train WHERE category IS NOT NULL GROUP BY category, otype)",
        "o AS (SELECT category, outlet_id, avg(ln(1 + sales)) AS m FROM train WHERE category IS NOT NULL GROUP BY category, outlet_id)",
    ),
)
def target_mean_two_key(spark, d):
    rows = view(spark, d, *K, "source", "item_id", "otype", "outlet_id", "sales").withColumn("category", category())
    train = split(rows)[0]
    found = G.target_mean_of_means(train, rows, ["category", "otype"], F.log1p("sales"), "by_type")
    found = G.target_mean_of_means(train, found, ["category", "outlet_id"], F.log1p("sales"), "by_outlet")
    return found.select(*K, near("by_type", 6).alias("by_type"), near("by_outlet", 6).alias("by_outlet"))


@query(
    "target_mean_location_category",
    check(
        f"SELECT okey, line, source, {near_sql('''coalesce(m, CASE WHEN source = 'test' THEN (SELECT avg(sales) FROM train) END)''')} AS mean_sales "
        "FROM cat LEFT JOIN s ON cat.loc = s.loc AND cat.category = s.category",
        "s AS (SELECT loc, category, avg(sales) AS m FROM train WHERE category IS NOT NULL GROUP BY loc, category)",
    ),
)
def target_mean_location_category(spark, d):
    rows = view(spark, d, *K, "source", "item_id", "loc", "sales").withColumn("category", category())
    train = split(rows)[0]
    default = F.when(F.col("source") == "test", G.mean_of(train, "sales"))
    found = G.target_mean(train, rows, ["loc", "category"], "sales", "mean_sales", default)
    return found.select(*K, "source", near("mean_sales").alias("mean_sales"))


@query(
    "target_mean_naive",
    check(
        f"SELECT okey, line, {near_sql('coalesce(m, (SELECT avg(sales) FROM train))')} AS mean_sales FROM rv LEFT JOIN s ON rv.item_id = s.item_id",
        ITEM_SALES,
    ),
)
def target_mean_naive(spark, d):
    rows = view(spark, d, *K, "source", "item_id", "sales")
    train = split(rows)[0]
    found = G.target_mean(train, rows, ["item_id"], "sales", "mean_sales", G.mean_of(train, "sales"))
    return found.select(*K, near("mean_sales").alias("mean_sales"))


def oof_steps(key, name):
    """Per fold the means of the other folds, taken directly, and of all folds for test rows."""
    return (
        f"{name}_f AS (SELECT f.fold, {key}, avg(sales) AS s, avg(mrp) AS p FROM train, "
        f"(SELECT DISTINCT fold FROM rv) f WHERE train.fold <> f.fold GROUP BY f.fold, {key})",
        f"{name}_t AS (SELECT {key}, avg(sales) AS s, avg(mrp) AS p FROM train GROUP BY {key})",
    )


def oof_join(key, name):
    return (
        f"LEFT JOIN {name}_f ON rv.source = 'train' AND rv.fold = {name}_f.fold AND rv.{key} = {name}_f.{key} "
        f"LEFT JOIN {name}_t ON rv.source = 'test' AND rv.{key} = {name}_t.{key}"
    )


def oof_value(name, ratio=False):
    if ratio:
        return f"CASE WHEN rv.source = 'train' THEN {name}_f.s / ({name}_f.p + 0.000001) ELSE {name}_t.s / ({name}_t.p + 0.000001) END"
    return f"CASE WHEN rv.source = 'train' THEN {name}_f.s ELSE {name}_t.s END"


GLOBAL_SALES = "(SELECT avg(sales) FROM train)"


@query(
    "target_mean_kfold",
    check(
        f"SELECT okey, line, rv.source, {near_sql(f'coalesce({oof_value("i")}, {GLOBAL_SALES})')} AS item_id_avg_sales, "
        f"{near_sql(f'coalesce({oof_value("o")}, {GLOBAL_SALES})')} AS outlet_id_avg_sales "
        f"FROM rv {oof_join('item_id', 'i')} {oof_join('outlet_id', 'o')}",
        *oof_steps("item_id", "i"),
        *oof_steps("outlet_id", "o"),
    ),
)
def target_mean_kfold(spark, d):
    rows = view(spark, d, *K, "source", "fold", "item_id", "outlet_id", "sales")
    found = O.target_mean_kfold(rows, ["item_id", "outlet_id"], "sales", "fold", FOLDS)
    return found.select(
        *K, "source", near("item_id_avg_sales").alias("item_id_avg_sales"), near("outlet_id_avg_sales").alias("outlet_id_avg_sales")
    )


@query(
    "saleability_kfold",
    check(
        f"SELECT okey, line, rv.source, {near_sql(f'coalesce({oof_value("i", True)}, (SELECT avg(sales) / (avg(mrp) + 0.000001) FROM train))')} AS saleability "
        f"FROM rv {oof_join('item_id', 'i')}",
        *oof_steps("item_id", "i"),
    ),
)
def saleability_kfold(spark, d):
    rows = view(spark, d, *K, "source", "fold", "item_id", "mrp", "sales")
    found = O.saleability_kfold(rows, "item_id", "sales", "mrp", "fold", FOLDS, "saleability")
    return found.select(*K, "source", near("saleability").alias("saleability"))


@query(
    "outlet_efficiency_kfold",
    check(
        f"SELECT okey, line, rv.source, {near_sql(f'coalesce({oof_value("o", True)}, (SELECT avg(s / (p + 0.000001)) FROM o_t))')} AS efficiency "
        f"FROM rv {oof_join('outlet_id', 'o')}",
        *oof_steps("outlet_id", "o"),
    ),
)
def outlet_efficiency_kfold(spark, d):
    rows = view(spark, d, *K, "source", "fold", "outlet_id", "mrp", "sales")
    found = O.outlet_efficiency_kfold(rows, "outlet_id", "sales", "mrp", "fold", FOLDS, "efficiency")
    return found.select(*K, "source", near("efficiency").alias("efficiency"))


@query(
    "flagship",
    check(
        f"SELECT okey, line, rv.source, {near_sql('coalesce(weight, avg(weight) OVER (PARTITION BY rv.item_id))')} AS weight, "
        f"{near_sql('visibility / avg(visibility) OVER (PARTITION BY rv.outlet_id)')} AS visibility_ratio, "
        f"{near_sql(f'coalesce({oof_value("i")}, {GLOBAL_SALES})')} AS item_id_avg_sales, "
        f"{near_sql(f'coalesce({oof_value("o")}, {GLOBAL_SALES})')} AS outlet_id_avg_sales "
        f"FROM rv {oof_join('item_id', 'i')} {oof_join('outlet_id', 'o')}",
        *oof_steps("item_id", "i"),
        *oof_steps("outlet_id", "o"),
    ),
)
def flagship(spark, d):
    """Weight filled per item, visibility against the outlet mean, out-of-fold mean sales.

    All that is keyed by item comes from one aggregation, and so does all keyed by outlet.
    """
    rows = view(spark, d, *K, "source", "fold", "item_id", "outlet_id", "weight", "visibility", "sales")
    in_train = F.col("source") == "train"
    target = F.when(in_train, F.col("sales"))
    items = materialise(
        G.group_stats(rows, ["item_id"], _weight=F.avg("weight"), **O.other_fold_aggregates("fold", FOLDS, {"_i": target}))
    )
    outlets = materialise(
        G.group_stats(rows, ["outlet_id"], _seen=F.avg("visibility"), **O.other_fold_aggregates("fold", FOLDS, {"_o": target}))
    )
    overall = outlets.df.agg(F.try_divide(F.sum("_o_sum"), F.sum("_o_n"))).scalar()
    rows = attach(attach(rows, items, ["item_id"]), outlets, ["outlet_id"])
    return rows.select(
        *K,
        "source",
        near(F.coalesce("weight", "_weight")).alias("weight"),
        near(S.ratio("visibility", "_seen")).alias("visibility_ratio"),
        near(F.coalesce(O.other_folds_mean("_i", "fold", in_train), overall)).alias("item_id_avg_sales"),
        near(F.coalesce(O.other_folds_mean("_o", "fold", in_train), overall)).alias("outlet_id_avg_sales"),
    )


# --- all statistics of an item on rows that are laid out once ------------------------


@query(
    "bucketed_item_joins",
    check(
        f"SELECT rv.okey, rv.line, rv.item_id, n AS frequency, {near_sql('w')} AS mean_weight, {near_sql('m')} AS mean_sales, CAST(2013 - y AS int) AS item_age "
        "FROM rv LEFT JOIN a ON rv.item_id = a.item_id LEFT JOIN s ON rv.item_id = s.item_id",
        "a AS (SELECT item_id, count(*) AS n, avg(weight) AS w FROM rv GROUP BY item_id)",
        "s AS (SELECT item_id, avg(sales) AS m, min(est_year) AS y FROM train GROUP BY item_id)",
    ),
)
def bucketed_item_joins(spark, d):
    """Three tables of item statistics joined to rows that are shuffled by item once."""
    rows = view(spark, d, *K, "item_id", "source", "weight", "sales", "est_year", spread=True)
    laid = BucketedRows.of(rows, ["item_id"], buckets=spark.sparkContext.defaultParallelism)
    train = split(rows)[0]
    laid = laid.attach(G.group_stats(rows, ["item_id"], frequency=F.count(F.lit(1)), mean_weight=F.avg("weight")))
    laid = laid.attach(G.group_mean(train, ["item_id"], "sales", "mean_sales"))
    laid = laid.attach(G.item_first_year(train, "item_id", "est_year", S.REFERENCE_YEAR, "item_age"))
    found = laid.rows()
    return found.select(*K, "item_id", "frequency", near("mean_weight").alias("mean_weight"), near("mean_sales").alias("mean_sales"), F.col("item_age").cast("int").alias("item_age"))

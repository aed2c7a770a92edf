"""The retail schema over the order tables (part, lineitem, supplier)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.scalar import map_value
from shelfcast.operators.folds import fold_by_keys
from shelfcast.session import widened

FOLDS = 5
KEYS = ["okey", "line"]
# How the item prefixes and flags of these tables map to the retail values.
PREFIX_CATEGORY = {
    "BL": "Food", "CO": "Food", "HO": "Food",
    "LA": "Drinks", "NE": "Drinks",
    "RE": "Non-Consumable", "OL": "Non-Consumable",
}
FLAG_FAT = {"AF": "Low Fat", "AO": "LF", "NF": "low fat", "NO": "Regular", "RF": "reg", "RO": "Non Edible"}
FOLD_FACTORS = {"l_orderkey": 7, "l_linenumber": 3, "l_partkey": 1}

_FROM_PART = {"item_id", "item_type"}
_FROM_SUPPLIER = {"size", "loc"}


def retail_view(spark: SparkSession, sf_dir: str, *columns: str, spread: bool = False) -> DataFrame:
    """The named columns (all when none are named), joining only the tables they need.

    The joins carry no hints: their sizes come from the files, so small dimensions are
    broadcast and large ones shuffled with adaptive skew splitting. ``spread`` lets a
    compute-heavy plan use all cores on a small table that is a single split.
    """
    made = {
        "okey": F.col("l_orderkey"),
        "line": F.col("l_linenumber"),
        "item_id": F.concat(
            F.upper(F.substring("p_name", 1, 2)), F.lpad(F.col("l_partkey").cast("string"), 6, "0")
        ),
        "weight": F.when(
            ((F.col("l_orderkey") + F.col("l_linenumber")) % 6 == 0) | (F.col("l_partkey") % 97 == 0), None
        ).otherwise(F.col("l_quantity")),
        "fat": map_value(F.concat("l_returnflag", "l_linestatus"), FLAG_FAT),
        "visibility": F.col("l_discount"),
        "item_type": F.col("p_type"),
        "mrp": F.col("l_extendedprice") / F.lit(400.0),
        "outlet_id": F.concat(F.lit("OUT"), F.lpad(F.col("l_suppkey").cast("string"), 4, "0")),
        "est_year": (F.lit(1985) + F.col("l_suppkey") % 25).cast("int"),
        "size": F.when(F.col("l_suppkey") % 5 == 0, None)
        .when(F.col("s_acctbal") < 3000, "Small")
        .when(F.col("s_acctbal") < 7000, "Medium")
        .otherwise("High"),
        "loc": F.concat(F.lit("Tier "), (F.lit(1) + F.col("s_nationkey") % 3).cast("string")),
        "otype": F.when(F.col("l_suppkey") % 4 == 0, "Grocery Store").otherwise(
            F.concat(F.lit("Supermarket Type"), (F.col("l_suppkey") % 4).cast("string"))
        ),
        "sales": F.col("l_extendedprice")
        * (F.lit(1.0) - F.col("l_discount"))
        * (F.lit(1.0) + F.col("l_tax"))
        / F.lit(25.0),
        "source": F.when((F.col("l_orderkey") % 4 == 0) | (F.col("l_partkey") % 53 == 0), "test").otherwise("train"),
        "fold": fold_by_keys(FOLD_FACTORS, FOLDS),
    }
    wanted = list(columns) or list(made)
    scan = rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if _FROM_PART & set(wanted):
        part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_type")
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"))
    if _FROM_SUPPLIER & set(wanted):
        supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_acctbal", "s_nationkey")
        rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    result = rows.select(*[made[c].alias(c) for c in wanted])
    return widened(result, scan) if spread else result

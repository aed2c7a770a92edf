"""Sources, sinks, projection, union, split and alignment."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.catalog.common import check, near, near_sql, query, view
from shelfcast.operators.groupstats import group_mean
from shelfcast.operators.joins import attach
from shelfcast.operators.shape import (
    align_columns,
    columns_of_type,
    distinct_values,
    drop_columns,
    null_profile,
    numeric_matrix,
    shape_profile,
    split_source,
    tag_source,
    unique_names,
    union_by_name,
)
from shelfcast.session import new_path
from shelfcast.sources.files import head, load_combined, load_pair, submission, write_csv
from shelfcast.sources.schema import ddl

RAW = ["item_id", "weight", "fat", "visibility", "item_type", "mrp", "outlet_id", "est_year", "size", "loc", "otype"]
RAW_TYPES = {"weight": "double", "visibility": "double", "mrp": "double", "est_year": "int", "sales": "double"}
RAW_SCHEMA = ddl([(c, RAW_TYPES.get(c, "string")) for c in RAW])
LABELLED_SCHEMA = RAW_SCHEMA + ", " + ddl([("sales", "double")])
RAW_LIST = ", ".join(RAW)


def csv_pair(spark, sf_dir):
    """The view written as the two CSV tables the job starts from."""
    folder = new_path(spark, "csv")
    train, test = split_source(view(spark, sf_dir, *RAW, "sales", "source"))
    write_csv(train.drop("source"), f"{folder}/train.csv")
    write_csv(test.drop("source", "sales"), f"{folder}/test.csv")
    return load_pair(spark, folder, "train.csv", "test.csv", LABELLED_SCHEMA, RAW_SCHEMA)


@query("scan_csv_pair", check(f"SELECT {RAW_LIST}, CASE WHEN source = 'train' THEN sales END AS sales FROM rv"))
def scan_csv_pair(spark, sf_dir):
    train, test = csv_pair(spark, sf_dir)
    return union_by_name(train, test)


@query("scan_uri", check(f"SELECT count(*) AS n, {near_sql('avg(mrp)')} AS mean_mrp FROM rv"))
def scan_uri(spark, sf_dir):
    """Any file system URI Spark knows serves as the path."""
    path = sf_dir if "://" in sf_dir else f"file://{sf_dir}"
    return view(spark, path, "mrp").agg(F.count(F.lit(1)).alias("n"), near(F.avg("mrp")).alias("mean_mrp"))


@query(
    "scan_split_target",
    check(
        "SELECT item_id, outlet_id, source, CASE WHEN source = 'train' THEN sales END AS sales, "
        f"CASE WHEN source = 'train' THEN {near_sql('ln(1 + sales)')} END AS log_sales FROM rv"
    ),
)
def scan_split_target(spark, sf_dir):
    train, test = csv_pair(spark, sf_dir)
    rows = load_combined(train, test, "sales", "log_sales")
    return rows.select("item_id", "outlet_id", "source", "sales", near("log_sales").alias("log_sales"))


TYPE_MEANS = "tm AS (SELECT item_type, avg(sales) AS p FROM train GROUP BY item_type)"


def type_mean_predictions(spark, sf_dir):
    train, test = split_source(view(spark, sf_dir, "item_id", "outlet_id", "item_type", "sales", "source"))
    return attach(test, group_mean(train, ["item_type"], "sales", "prediction"), ["item_type"])


@query(
    "sink_csv",
    check(
        f"SELECT item_id, outlet_id, {near_sql('p')} AS sales FROM test JOIN tm USING (item_type)", TYPE_MEANS
    ),
)
def sink_csv(spark, sf_dir):
    """Predictions written as CSV and read back."""
    result = submission(type_mean_predictions(spark, sf_dir), ["item_id", "outlet_id"], "prediction", "sales")
    path = write_csv(result, new_path(spark, "submission"))
    written = spark.read.schema("item_id string, outlet_id string, sales double").option("header", True).csv(path)
    return written.withColumn("sales", near("sales"))


@query(
    "submission_assemble",
    check(
        f"SELECT item_id, outlet_id, {near_sql('p')} AS sales FROM test JOIN tm USING (item_type)", TYPE_MEANS
    ),
)
def submission_assemble(spark, sf_dir):
    rows = submission(type_mean_predictions(spark, sf_dir), ["item_id", "outlet_id"], "prediction", "sales")
    return rows.withColumn("sales", near("sales"))


@query("null_profile", check(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM rv" for c in RAW)))
def nulls(spark, sf_dir):
    return null_profile(view(spark, sf_dir, *RAW), RAW)


@query(
    "shape_profile",
    check(
        "SELECT 'train' AS name, count(*) AS n_rows, CAST(12 AS int) AS n_cols FROM train "
        "UNION ALL SELECT 'test', count(*), CAST(11 AS int) FROM test "
        "UNION ALL SELECT 'combined', count(*), CAST(13 AS int) FROM rv"
    ),
)
def shapes(spark, sf_dir):
    rows = view(spark, sf_dir, *RAW, "sales", "source")
    train, test = split_source(rows)
    return shape_profile({"train": train.drop("source"), "test": test.drop("source", "sales"), "combined": rows})


@query("project_ids", check("SELECT item_id, outlet_id FROM test"))
def project_ids(spark, sf_dir):
    return split_source(view(spark, sf_dir, "item_id", "outlet_id", "source"))[1].select("item_id", "outlet_id")


@query("drop_columns", check("SELECT okey, line, item_id, mrp FROM rv"))
def dropped(spark, sf_dir):
    rows = view(spark, sf_dir, "okey", "line", "item_id", "mrp", "est_year", "item_type")
    return drop_columns(drop_columns(rows, ["est_year"], strict=True), ["item_type", "not_there"])


@query(
    "tag_source",
    check("SELECT item_id, outlet_id, 'train' AS source FROM train UNION ALL SELECT item_id, outlet_id, 'test' FROM test"),
)
def tagged(spark, sf_dir):
    train, test = split_source(view(spark, sf_dir, "item_id", "outlet_id", "source"))
    return tag_source(train.drop("source"), "train").unionByName(tag_source(test.drop("source"), "test"))


@query(
    "union_by_name",
    check(
        "SELECT item_id, outlet_id, mrp, sales FROM train UNION ALL SELECT item_id, outlet_id, mrp, NULL FROM test"
    ),
)
def united(spark, sf_dir):
    train, test = split_source(view(spark, sf_dir, "item_id", "outlet_id", "mrp", "sales", "source"))
    return union_by_name(train.drop("source"), test.drop("source", "sales"))


@query(
    "split_back",
    check("SELECT source, count(*) AS n, count(DISTINCT item_id) AS items FROM rv GROUP BY source"),
)
def split_back(spark, sf_dir):
    parts = split_source(view(spark, sf_dir, "item_id", "source"))
    counted = [
        p.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("item_id").alias("items")) for p in parts
    ]
    return counted[0].unionByName(counted[1])


@query(
    "filter_predicate",
    check("SELECT okey, line, size, visibility FROM rv WHERE source = 'train' AND size IS NULL AND visibility = 0"),
)
def filtered(spark, sf_dir):
    rows = view(spark, sf_dir, "okey", "line", "size", "visibility", "source")
    return rows.filter((F.col("source") == "train") & F.col("size").isNull() & (F.col("visibility") == 0)).drop("source")


@query(
    "select_by_type",
    check("SELECT fat, item_type, size, loc, otype, count(*) AS n FROM rv GROUP BY fat, item_type, size, loc, otype"),
)
def by_type(spark, sf_dir):
    """All text columns but the ids, profiled together."""
    rows = view(spark, sf_dir, *RAW, "source")
    names = columns_of_type(rows, T.StringType, ["source", "item_id", "outlet_id"])
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


@query(
    "distinct_values",
    check("SELECT DISTINCT fat FROM rv"),
)
def distinct(spark, sf_dir):
    return distinct_values(list(split_source(view(spark, sf_dir, "fat", "source"))), "fat")


@query(
    "align_columns",
    check("SELECT 0 AS absent, mrp, item_id, visibility FROM test"),
)
def aligned(spark, sf_dir):
    test = split_source(view(spark, sf_dir, "item_id", "visibility", "mrp", "weight", "source"))[1]
    return align_columns(test, ["absent", "mrp", "item_id", "visibility"])


@query(
    "cast_numeric_matrix",
    check(
        "SELECT okey, line, CAST(est_year AS double) AS est_year, CAST(fold AS double) AS fold, weight, mrp, "
        "CAST(right(loc, 1) AS double) AS tier, TRY_CAST(size AS double) AS size FROM rv"
    ),
)
def matrix(spark, sf_dir):
    rows = view(spark, sf_dir, "okey", "line", "est_year", "fold", "weight", "mrp", "loc", "size")
    rows = rows.withColumn("tier", F.substring("loc", -1, 1)).drop("loc")
    return numeric_matrix(numeric_matrix(rows, ["est_year", "fold", "weight", "mrp", "tier"]), ["size"], lenient=True)


@query("dedupe_features", check("SELECT okey, line, mrp, visibility, weight FROM rv"))
def deduped(spark, sf_dir):
    names = unique_names(["mrp", "visibility", "mrp", "weight", "visibility"])
    return view(spark, sf_dir, "okey", "line", *names)


@query(
    "preview",
    check(f"SELECT item_id, outlet_id, {near_sql('sales')} AS sales FROM rv ORDER BY item_id, outlet_id, okey, line LIMIT 5"),
)
@query(
    "head_preview",
    check(f"SELECT item_id, outlet_id, {near_sql('sales')} AS sales FROM rv ORDER BY item_id, outlet_id, okey, line LIMIT 5"),
)
def preview(spark, sf_dir):
    rows = head(view(spark, sf_dir, "item_id", "outlet_id", "okey", "line", "sales"), ["item_id", "outlet_id", "okey", "line"])
    return rows.select("item_id", "outlet_id", near("sales").alias("sales"))

"""Registry of queries with their check SQL, and what both sides share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import tune
from shelfcast.sources.retail_view import retail_view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

# The retail view in SQL; every check builds on it.
VIEW_SQL = """rv AS (
  SELECT l_orderkey AS okey, l_linenumber AS line,
    upper(substring(p_name, 1, 2)) || lpad(CAST(l_partkey AS varchar), 6, '0') AS item_id,
    CASE WHEN (l_orderkey + l_linenumber) % 6 = 0 OR l_partkey % 97 = 0 THEN NULL ELSE l_quantity END AS weight,
    CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'Low Fat' WHEN 'AO' THEN 'LF' WHEN 'NF' THEN 'low fat'
      WHEN 'NO' THEN 'Regular' WHEN 'RF' THEN 'reg' WHEN 'RO' THEN 'Non Edible' END AS fat,
    l_discount AS visibility, p_type AS item_type, l_extendedprice / 400.0 AS mrp,
    'OUT' || lpad(CAST(l_suppkey AS varchar), 4, '0') AS outlet_id,
    CAST(1985 + l_suppkey % 25 AS int) AS est_year,
    CASE WHEN l_suppkey % 5 = 0 THEN NULL WHEN s_acctbal < 3000 THEN 'Small'
      WHEN s_acctbal < 7000 THEN 'Medium' ELSE 'High' END AS size,
    'Tier ' || CAST(1 + s_nationkey % 3 AS varchar) AS loc,
    CASE WHEN l_suppkey % 4 = 0 THEN 'Grocery Store'
      ELSE 'Supermarket Type' || CAST(l_suppkey % 4 AS varchar) END AS otype,
    CAST(l_extendedprice AS double) * (CAST(1 AS double) - l_discount) * (CAST(1 AS double) + l_tax)
      / CAST(25 AS double) AS sales,
    CASE WHEN l_orderkey % 4 = 0 OR l_partkey % 53 = 0 THEN 'test' ELSE 'train' END AS source,
    CAST((l_orderkey * 7 + l_linenumber * 3 + l_partkey) % 5 AS int) AS fold
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
), cat AS (
  SELECT *, CASE WHEN left(item_id, 2) IN ('BL', 'CO', 'HO') THEN 'Food'
    WHEN left(item_id, 2) IN ('LA', 'NE') THEN 'Drinks'
    WHEN left(item_id, 2) IN ('RE', 'OL') THEN 'Non-Consumable' END AS category
  FROM rv
), train AS (SELECT * FROM cat WHERE source = 'train'), test AS (SELECT * FROM cat WHERE source = 'test')"""


def near(c: Column | str, digits: int = 4) -> Column:
    """Rounded for comparison, nudged so that exact halves fall the same way in every engine."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1.3 * 10.0 ** -(digits + 2)), digits)


def near_sql(expression: str, digits: int = 4) -> str:
    return f"round(CAST({expression} AS double) + {1.3 * 10.0 ** -(digits + 2)!r}, {digits})"


def check(select: str, *steps: str) -> str:
    """A check query: the view, further ``name AS (...)`` steps, and the final select."""
    return "WITH " + ",\n".join([VIEW_SQL, *steps]) + "\n" + select


def query(name: str, sql: str | None = None):
    """Registers a query under its name, with its check SQL where SQL can express it."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return function

    return register


def view(spark: SparkSession, sf_dir: str, *columns: str, spread: bool = False) -> DataFrame:
    return retail_view(spark, sf_dir, *columns, spread=spread)

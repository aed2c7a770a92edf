"""The last steps of the fills have rows to fill in the registered queries, beside the tables as they are."""

import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfcast import catalog
from shelfcast.sources.retail_view import retail_view


def test_group_mode_fills_a_group_without_any_size(spark, sf_dir, tmp_path):
    """Grocery stores of tier 1 are small and all others high, so each way to fill gives another size."""
    grocery = (F.col("s_suppkey") % 4 == 0) & (F.col("s_nationkey") % 3 == 0)
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    supplier.withColumn("s_acctbal", F.when(grocery, 1000.0).otherwise(8000.0)).write.parquet(f"{tmp_path}/supplier.parquet")
    os.symlink(f"{sf_dir}/lineitem.parquet", tmp_path / "lineitem.parquet")
    found = catalog.QUERIES["fill_group_mode"](spark, str(tmp_path)).select("size", "size_medium", "gaps", "gaps_medium").collect()
    assert Counter(map(tuple, found)) == {("Small", "Small", "High", "Medium"): 1133, ("High", "High", "High", "High"): 4867}


def test_zero_cascade_fills_nulls(spark, sf_dir):
    """Every 11th order is blanked and takes the mean of what its outlet has left."""
    view = retail_view(spark, sf_dir, "okey", "line", "outlet_id", "visibility")
    outlets = defaultdict(list)
    for r in view.filter("okey % 11 <> 0").collect():
        outlets[r["outlet_id"]].append(r["visibility"])
    means = {k: sum(v) / len(v) for k, v in outlets.items()}
    blanked = sorted((r["okey"], r["line"], means[r["outlet_id"]]) for r in view.filter("okey % 11 = 0").collect())
    found = catalog.QUERIES["repair_zero_cascade"](spark, sf_dir).select("okey", "line", "gaps", "visibility").collect()
    got = sorted(tuple(r)[:3] for r in found if r["okey"] % 11 == 0)
    assert len(found) == 6000 and len(got) == 575
    assert [g[2] for g in got] == pytest.approx([b[2] for b in blanked], abs=1e-6)
    assert not any(r["visibility"] is None or r["visibility"] == 0 for r in found)


def test_price_gaps_of_the_test_side_stay(spark, sf_dir):
    """The weight has gaps among the train rows and is filled everywhere; the price has them in test rows alone."""
    found = catalog.QUERIES["fill_leftover_train_mean"](spark, sf_dir).collect()
    empty = [r for r in found if r["gaps"] is None]
    assert len(found) == 6000 and empty and all(r["source"] == "test" and r["okey"] % 3 == 0 for r in empty)
    assert len(empty) == sum(r["source"] == "test" and r["okey"] % 3 == 0 for r in found)
    assert all(r["gaps"] in (None, r["mrp"]) and r["mrp"] is not None and r["weight"] is not None for r in found)

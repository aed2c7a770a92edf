"""Filling missing values and repairing zeros.

``fit_on`` names the rows to learn from where they are not the filled table itself: a
chain of fills can so learn each step from the table it started with instead of
repeating the joins of the steps before.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.scalar import map_value
from shelfcast.operators.groupstats import group_mean, group_stats, mean_of
from shelfcast.operators.joins import attach
from shelfcast.operators.order_stats import global_mode, group_mode, group_quantile
from shelfcast.session import materialise


def fill_constant(df: DataFrame, values: Mapping) -> DataFrame:
    return df.fillna(dict(values))


def fill_own_mean_mode(df: DataFrame, source: str, mean_column: str, mode_column: str) -> DataFrame:
    """Mean and mode of each data set fill its own gaps; two tiny tables keyed by the tag."""
    means = group_mean(df, [source], mean_column, "_mean")
    modes = group_mode(df, [source], mode_column, "_mode")
    filled = attach(df, means.join(modes, source, "left"), [source])
    return filled.withColumns(
        {
            mean_column: F.coalesce(mean_column, "_mean"),
            mode_column: F.coalesce(mode_column, "_mode"),
        }
    ).drop("_mean", "_mode")


def fill_group_mean(
    df: DataFrame, keys: list[str], value: str, global_fallback: bool = False, fit_on: DataFrame | None = None
) -> DataFrame:
    """Gaps take the group's mean, and if asked the mean of the column after that fill.

    A filled group's values sum to mean * rows, so the later mean needs no second pass.
    """
    stats = materialise(group_stats(fit_on or df, keys, _mean=F.avg(value), _n=F.count(F.lit(1))))
    choices = [F.col(value), F.col("_mean")]
    if global_fallback:
        known = stats.df.filter("_mean is not null")
        choices.append(known.agg(F.try_divide(F.sum(F.col("_mean") * F.col("_n")), F.sum("_n"))).scalar())
    return attach(df, stats, keys).withColumn(value, F.coalesce(*choices)).drop("_mean", "_n")


def fit_fill_cascade(
    df: DataFrame,
    source: str,
    first: list[str],
    second: str,
    value: str | Column,
    first_on: str | None,
) -> tuple[DataFrame, DataFrame]:
    """Means for a two-step fill, both from one pass over the rows.

    Step one uses the mean per ``first`` (learned on the ``first_on`` data set, or on
    each one's own rows when None), step two the mean per data set and ``second``
    taken *after* step one. That mean follows from sums and gaps per
    (source, second, first), so the rows need not be filled to learn it.
    """
    x = F.col(value) if isinstance(value, str) else value
    keys = [k for k in first if k != second]
    cells = materialise(
        df.groupBy(source, second, *keys).agg(
            F.sum(x).alias("_sum"), F.count(x).alias("_known"), F.count_if(x.isNull()).alias("_gaps")
        ),
        "cells",
    ).df
    learned = cells if first_on is None else cells.filter(F.col(source) == first_on)
    step_keys = first if first_on else [source, *first]
    step_one = (
        learned.dropna(subset=first)
        .groupBy(*step_keys)
        .agg(F.try_divide(F.sum("_sum"), F.sum("_known")).alias("_mean_1"))
    )
    filled = cells.join(step_one, step_keys, "left")
    step_two = (
        filled.dropna(subset=[second])
        .groupBy(source, second)
        .agg(
            F.try_divide(
                F.sum(F.coalesce("_sum", F.lit(0.0)) + F.coalesce(F.col("_gaps") * F.col("_mean_1"), F.lit(0.0))),
                F.sum(F.col("_known") + F.when(F.col("_mean_1").isNotNull(), F.col("_gaps")).otherwise(0)),
            ).alias("_mean_2")
        )
    )
    return step_one, step_two


def fill_cascade(
    df: DataFrame,
    source: str,
    first: list[str],
    second: str,
    value: str,
    first_on: str | None = None,
    zero_is_missing: bool = False,
) -> DataFrame:
    """Fill from the ``first`` mean, then from the mean of ``second`` after that fill."""
    if zero_is_missing:
        df = df.withColumn(value, F.nullif(F.col(value), F.lit(0.0)))
    step_one, step_two = fit_fill_cascade(df, source, first, second, value, first_on)
    filled = attach(df, step_one, first if first_on else [source, *first])
    filled = attach(filled, step_two, [source, second])
    return filled.withColumn(value, F.coalesce(value, "_mean_1", "_mean_2")).drop("_mean_1", "_mean_2")


def fill_group_mode(
    df: DataFrame, keys: list[str], value: str, default: str | None = None, fit_on: DataFrame | None = None
) -> DataFrame:
    """Mode of the group; then ``default`` or the mode of the column after that fill."""
    cells = materialise((fit_on or df).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))).df
    best = F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col("_n")).alias("rank"), F.col(value).alias("v"))))
    modes = materialise(cells.dropna(subset=keys).groupBy(*keys).agg(best.getField("v").alias("_mode")))
    if default is None:
        after = attach(cells, modes, keys).groupBy(F.coalesce(value, "_mode").alias("v")).agg(F.sum("_n").alias("n"))
        top = F.min(F.when(F.col("v").isNotNull(), F.struct((-F.col("n")).alias("rank"), F.col("v").alias("v"))))
        last = after.agg(top.getField("v")).scalar()
    else:
        last = F.lit(default)
    return attach(df, modes, keys).withColumn(value, F.coalesce(F.col(value), F.col("_mode"), last)).drop("_mode")


def fill_rule(df: DataFrame, by: str, value: str, rule: Mapping[str, str], default: str | None) -> DataFrame:
    """A fixed rule by another column; where it is silent ``default``, or without one the mode."""
    ruled = df.withColumn(value, F.coalesce(F.col(value), map_value(by, rule, default)))
    if default is not None:
        return ruled
    return ruled.withColumn(value, F.coalesce(F.col(value), global_mode(ruled, value)))


def best_clusters(points: DataFrame, features: str, weight: str, clusters: int, starts: int = 10, seed: int = 42) -> tuple[KMeansModel, list[float]]:
    """The KMeans model of lowest weighted cost among ``starts`` seeded starts, and the cost of every start."""

    def one(start: int) -> KMeansModel:
        return KMeans(k=clusters, seed=seed + start, featuresCol=features, predictionCol="_cluster", weightCol=weight).fit(points)

    with ThreadPoolExecutor(4) as pool:
        models = list(pool.map(one, range(starts)))
    costs = [m.summary.trainingCost for m in models]
    return models[min(range(starts), key=costs.__getitem__)], costs


def fill_cluster_mode(
    df: DataFrame,
    location: str,
    outlet_type: str,
    value: str,
    empty_group: str,
    unknown: str,
    clusters: int = 3,
    seed: int = 42,
    starts: int = 10,
) -> DataFrame:
    """Mode per (cluster of location and type, type).

    Clusters are learned on the distinct pairs weighted by their rows, which has the
    same optimum as clustering every row. The pairs are counted and written once, and the best of several starts counts.
    """
    pairs = df.dropna(subset=[location, outlet_type]).groupBy(location, outlet_type).agg(
        F.count(F.lit(1)).cast("double").alias("_rows")
    )
    pairs = materialise(pairs, "pairs").df
    codes = [
        StringIndexer(inputCol=c, outputCol=f"_code_{i}", stringOrderType="alphabetAsc")
        for i, c in enumerate((location, outlet_type))
    ]
    steps = [*codes, VectorAssembler(inputCols=["_code_0", "_code_1"], outputCol="_point")]
    points = Pipeline(stages=steps).fit(pairs).transform(pairs)
    model, _ = best_clusters(points, "_point", "_rows", clusters, starts, seed)
    clustered = model.transform(points).select(location, outlet_type, "_cluster")
    sizes = df.groupBy(location, outlet_type, value).agg(F.count(F.lit(1)).alias("_n"))
    cells = sizes.join(clustered, [location, outlet_type]).groupBy("_cluster", outlet_type, value).agg(
        F.sum("_n").alias("_n")
    )
    best = F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col("_n")).alias("rank"), F.col(value).alias("v"))))
    modes = cells.groupBy("_cluster", outlet_type).agg(
        F.coalesce(best.getField("v"), F.lit(empty_group)).alias("_mode")
    )
    by_pair = clustered.join(modes, ["_cluster", outlet_type]).select(location, outlet_type, "_mode")
    filled = attach(df, by_pair, [location, outlet_type])
    return filled.withColumn(value, F.coalesce(F.col(value), F.col("_mode"), F.lit(unknown))).drop("_mode")


def repair_zero_mean(
    df: DataFrame, item: str, value: str, default: float | None = None
) -> DataFrame:
    """Zero becomes the item's mean, zeros included."""
    repaired = attach(df, group_mean(df, [item], value, "_mean"), [item])
    mean = F.col("_mean") if default is None else F.coalesce("_mean", F.lit(default))
    return repaired.withColumn(value, F.when(F.col(value) == 0, mean).otherwise(F.col(value))).drop("_mean")


def repair_zero_median(df: DataFrame, item: str, value: str) -> DataFrame:
    """Zero becomes the item's exact median, zeros included."""
    repaired = attach(df, group_quantile(df, [item], value, 0.5, "_median"), [item])
    return repaired.withColumn(
        value, F.when(F.col(value) == 0, F.col("_median")).otherwise(F.col(value))
    ).drop("_median")


def repair_zero_nonzero_mean(df: DataFrame, item: str, value: str) -> DataFrame:
    """Zero becomes the mean of the item's non-zero values, else the mean of the column."""
    stats = materialise(
        group_stats(
            df,
            [item],
            _mean=F.avg(F.nullif(F.col(value), F.lit(0.0))),
            _sum=F.sum(value),
            _n=F.count(value),
        )
    )
    fallback = stats.df.agg(F.try_divide(F.sum("_sum"), F.sum("_n"))).scalar()
    return (
        attach(df, stats, [item])
        .withColumn(value, F.when(F.col(value) == 0, F.coalesce(F.col("_mean"), fallback)).otherwise(F.col(value)))
        .drop("_mean", "_sum", "_n")
    )


def repair_zero_cascade(df: DataFrame, item: str, outlet: str, *values: str) -> DataFrame:
    """Zero becomes the item mean; nulls then take the outlet mean and the overall mean.

    An item with nothing but zeros has the mean 0 and keeps it. Several columns are repaired each by itself, their
    means learned and joined together.
    """
    means = {key: {f"_{key}_{i}": F.avg(v) for i, v in enumerate(values)} for key in ("item", "outlet")}
    repaired = attach(df, group_stats(df, [item], **means["item"]), [item])
    repaired = attach(repaired, group_stats(df, [outlet], **means["outlet"]), [outlet])
    filled = {
        v: F.coalesce(F.when(F.col(v) == 0, F.col(f"_item_{i}")).otherwise(F.col(v)), F.col(f"_outlet_{i}"), mean_of(df, v))
        for i, v in enumerate(values)
    }
    return repaired.withColumns(filled).drop(*means["item"], *means["outlet"])


def fill_train_means(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean of ``train`` for gaps of ``df``, only in columns where ``train`` itself has gaps."""
    row = train.agg(
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)],
        *[F.count_if(F.col(c).isNull()).alias(f"g_{i}") for i, c in enumerate(columns)],
    ).first()
    means = {c: row[f"m_{i}"] for i, c in enumerate(columns) if row[f"g_{i}"] and row[f"m_{i}"] is not None}
    return df.fillna(means) if means else df


def fill_unseen(
    df: DataFrame, stats: DataFrame, keys: list[str], defaults: Mapping[str, Column]
) -> DataFrame:
    """Join group features and give keys without statistics the stated defaults."""
    joined = attach(df, stats, keys)
    return joined.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})

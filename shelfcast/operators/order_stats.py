"""Exact order statistics without sorting any group in one task.

Everything here rests on ``ordered_counts``: values are counted first, the counts
are range-partitioned, and running totals are taken inside the partitions and then
shifted by the totals of the partitions before.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.joins import attach
from shelfcast.session import Table, materialise

SKETCH_ACCURACY = 10_000


def ordered_counts(df: DataFrame, groups: list[str], value: str, weight: str | None = None) -> DataFrame:
    """``(groups, value, _n, _before, _total)``: rows with the value, below it, and in the group.

    Null values and null group keys are left out. With ``weight`` the rows count
    that much instead of one.
    """
    keys = groups or ["_all"]
    if not groups:
        df = df.withColumn("_all", F.lit(0))
    amount = F.sum(weight).cast("long") if weight else F.count(F.lit(1))
    counted = df.dropna(subset=[*keys, value]).groupBy(*keys, value).agg(amount.alias("_n"))
    # Adaptive execution may merge neighbouring ranges; the order of the partitions stays.
    placed = materialise(
        counted.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()),
        "ordered",
    ).df
    # One row per group and range partition: a group has at most as many as there are shuffle partitions.
    shares = placed.groupBy(*keys, "_part").agg(F.sum("_n").alias("_share"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shares.select(
        *keys,
        "_part",
        F.coalesce(F.sum("_share").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_share").over(whole).alias("_total"),
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    # The window above already holds the rows by these keys, so this join moves only the offsets.
    return running.join(offsets, [*keys, "_part"]).select(
        *groups, value, "_n", (F.col("_offset") + F.col("_inside")).alias("_before"), "_total"
    )


def running_totals(df: DataFrame, groups: list[str], order: list[str], amounts: dict[str, str | None]) -> DataFrame:
    """``df`` with, per name in ``amounts``, the sum of that column (None: of ones) over the rows of the group that come before.

    Rows are range-partitioned by (groups, order) and written; sums are taken inside the partitions and shifted by those of
    the partitions before, so neither a group nor the whole table has to be in one task. Group columns and amounts are not null.
    Rows that are equal in ``order`` come one after another in some order.
    """
    keys = groups or ["_all"]
    if not groups:
        df = df.withColumn("_all", F.lit(0))
    placed = materialise(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "ordered").df
    one = {name: F.lit(1).cast("long") if column is None else F.col(column) for name, column in amounts.items()}
    shares = placed.groupBy(*keys, "_part").agg(*(F.sum(c).alias(name) for name, c in one.items()))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shares.select(
        *keys, "_part", *(F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_offset_{name}") for name in amounts)
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumns({f"_inside_{name}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for name, c in one.items()})
    totals = [(F.col(f"_offset_{name}") + F.col(f"_inside_{name}")).alias(name) for name in amounts]
    return running.join(offsets, [*keys, "_part"]).select(*(c for c in df.columns if c != "_all"), *totals)


def group_quantile(
    df: DataFrame, groups: list[str], value: str, p: float, out: str, weight: str | None = None
) -> DataFrame:
    """Linearly interpolated quantile of each group, exact."""
    ordered = ordered_counts(df, groups, value, weight)
    place = (F.col("_total") - 1) * F.lit(float(p))
    low, high = F.floor(place), F.ceil(place)
    end = F.col("_before") + F.col("_n")

    def at(position):
        return F.max(F.when((F.col("_before") <= position) & (position < end), F.col(value)))

    picked = ordered.groupBy(*groups).agg(
        at(low).alias("_low"), at(high).alias("_high"), F.max(place - low).alias("_part")
    )
    return picked.select(
        *groups, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias(out)
    )


def medians(requests: dict[str, tuple[DataFrame, str, str | None]]) -> dict[str, Column]:
    """Exact medians of several (weighted) columns of group tables from one ordering.

    ``requests`` maps a name to (table, column, weight column or None); the answer holds
    one value per name.
    """
    parts = [
        df.select(
            F.lit(name).alias("_name"),
            F.col(column).cast("double").alias("_value"),
            (F.col(weight) if weight else F.lit(1)).cast("long").alias("_weight"),
        )
        for name, (df, column, weight) in requests.items()
    ]
    found = group_quantile(reduce(DataFrame.unionAll, parts), ["_name"], "_value", 0.5, "median", "_weight")
    values = {r["_name"]: r["median"] for r in found.collect()}
    return {name: F.lit(values.get(name)).cast("double") for name in requests}


def quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, list[float | None]]:
    """Exact interpolated quantiles of whole columns, as driver values (the fitted edges).

    A sketch brackets each quantile first; only the values inside a bracket are
    counted and ordered, so hardly anything is shuffled. Should a bracket miss its
    quantile the column is ordered in full.
    """
    slack = 2.0 / SKETCH_ACCURACY
    sketch = df.agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[
            F.percentile_approx(
                c,
                [e for p in probabilities for e in (max(0.0, p - slack), min(1.0, p + slack))],
                SKETCH_ACCURACY,
            ).alias(f"q_{i}")
            for i, c in enumerate(columns)
        ],
    ).first()
    brackets = {}
    for i in range(len(columns)):
        for j, p in enumerate(probabilities):
            if sketch[f"n_{i}"]:
                place = p * (sketch[f"n_{i}"] - 1)
                edges = sketch[f"q_{i}"]
                brackets[i * len(probabilities) + j] = (
                    columns[i], math.floor(place), math.ceil(place), edges[2 * j], edges[2 * j + 1],
                )
    found = _pick(df, brackets)
    missed = {k: (b[0], b[1], b[2], None, None) for k, b in brackets.items() if None in found[k]}
    if missed:
        found.update(_pick(df, missed))
    result = {}
    for i, column in enumerate(columns):
        values = []
        for j, p in enumerate(probabilities):
            key = i * len(probabilities) + j
            if key not in brackets:
                values.append(None)
                continue
            place = p * (sketch[f"n_{i}"] - 1)
            low, high = found[key]
            values.append(low + (high - low) * (place - math.floor(place)))
        result[column] = values
    return result


def _pick(df: DataFrame, brackets: dict) -> dict[int, tuple]:
    """The two order statistics of each bracket: ``{id: (low, high)}``, None where outside."""
    if not brackets:
        return {}
    marks = []
    for key, (column, _, _, a, b) in brackets.items():
        x = F.col(column).cast("double")
        inside = F.lit(True) if a is None else (x >= F.lit(float(a))) & (x <= F.lit(float(b)))
        below = F.lit(False) if a is None else x < F.lit(float(a))
        marks.append(
            F.when(
                x.isNotNull() & (inside | below),
                F.struct(F.lit(key).alias("id"), F.when(inside, x).alias("x")),
            )
        )
    counted = (
        df.select(F.explode(F.array_compact(F.array(*marks))).alias("m"))
        .groupBy("m.id", "m.x")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    counted = materialise(counted, "bracket").df
    below = {r["id"]: r["rows"] for r in counted.filter("x is null").select("id", "rows").collect()}
    ordered = ordered_counts(counted.filter("x is not null"), ["id"], "x", "rows")
    wanted = F.lit(False)
    for key, (_, low, high, _, _) in brackets.items():
        for position in (low - below.get(key, 0), high - below.get(key, 0)):
            wanted = wanted | (
                (F.col("id") == key) & (F.col("_before") <= position) & (position < F.col("_before") + F.col("_n"))
            )
    # At most two rows per bracket come back.
    rows = ordered.filter(wanted).select("id", "x", "_n", "_before").collect()
    found = {}
    for key, (_, low, high, _, _) in brackets.items():
        pair = []
        for position in (low - below.get(key, 0), high - below.get(key, 0)):
            hit = [r["x"] for r in rows if r["id"] == key and r["_before"] <= position < r["_before"] + r["_n"]]
            pair.append(hit[0] if hit else None)
        found[key] = tuple(pair)
    return found


def group_mode(df: DataFrame, groups: list[str], value: str, out: str) -> DataFrame:
    """Most frequent non-null value per group, the smallest on ties; values are counted first."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("rank"), F.col(value).alias("v")))
    return counted.groupBy(*groups).agg(best.getField("v").alias(out))


def global_mode(df: DataFrame, value: str):
    """Most frequent non-null value of the column, as a scalar subquery."""
    return group_mode(df, [], value, "mode").scalar()


def pct_ranks(df: DataFrame, group: str, outputs: dict[str, str]) -> DataFrame:
    """Average rank of each value in its group over the number of non-null values; null stays null.

    ``outputs`` maps value column to rank column. All columns are ranked by one ordering of (column, group, value), which is
    written once; the ranks of a column are joined back by (group, value).
    """
    if not outputs:
        return df
    kinds = {df.schema[value].dataType for value in outputs}
    same = (lambda c: F.col(c)) if len(kinds) == 1 else (lambda c: F.col(c).cast("double"))
    entries = [F.struct(F.lit(i).alias("_column"), same(value).alias("_value")) for i, value in enumerate(outputs)]
    values = df.select(F.col(group).alias("_group"), F.explode(F.array(*entries)).alias("_e")).select("_group", "_e.*")
    rank = (F.col("_before") + (F.col("_n") + 1) / 2) / F.col("_total")
    ranks = materialise(ordered_counts(values, ["_column", "_group"], "_value").select("_column", "_group", "_value", rank.alias("_rank")), "ranks")
    for i, (value, out) in enumerate(outputs.items()):
        own = ranks.df.filter(F.col("_column") == i).select(F.col("_group").alias(group), F.col("_value").alias("_ranked"), F.col("_rank").alias(out))
        df = attach(df.withColumn("_ranked", same(value)), Table(own, ranks.rows, ranks.bytes), [group, "_ranked"]).drop("_ranked")
    return df


def pct_rank(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    return pct_ranks(df, group, {value: out})


def min_by_finite(board: DataFrame, name: str, score: str) -> DataFrame:
    """The name with the smallest finite score of a leaderboard, with that score."""
    finite = board.filter(F.col(score).isNotNull() & (F.abs(score) < F.lit(float("inf"))) & ~F.isnan(score))
    return finite.agg(F.min_by(name, F.struct(score, name)).alias(name), F.min(score).alias(score))

"""Folds, holdouts and statistics that leave a row's own fold out."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.groupstats import group_stats, mean_of
from shelfcast.operators.joins import attach
from shelfcast.operators.order_stats import running_totals
from shelfcast.session import materialise

#: Text that stands for a null key in a hash; no null compares equal to it by chance of its spelling.
_NULL = "\x00"


def fold_by_hash(keys: Sequence[str], folds: int, seed: int = 0) -> Column:
    """Fold number from a hash of the key columns: the same on every run and partitioning."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(folds)).cast("int")


def fold_by_keys(multipliers: Mapping[str, int], folds: int, offset: int = 0) -> Column:
    """Fold number by integer arithmetic on numeric keys, reproducible in any engine."""
    mixed = F.lit(offset).cast("long")
    for key, factor in multipliers.items():
        mixed = mixed + F.col(key).cast("long") * F.lit(factor)
    return F.pmod(mixed, F.lit(folds)).cast("int")


def holdout(mixed_fold: Column, names: tuple[str, str] = ("fit", "holdout")) -> Column:
    """Fold 0 is held out."""
    return F.when(mixed_fold == 0, names[1]).otherwise(names[0])


def shuffle_hash(keys: Sequence[str], seed: int = 0) -> Column:
    """MD5 of the seed and the keys, joined by ``|``: a shuffled order that any engine can repeat."""
    texts = [F.coalesce(F.col(k).cast("string"), F.lit(_NULL)) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *texts).cast("binary"))


def shuffled_rank(df: DataFrame, keys: Sequence[str], seed: int = 0, out: str = "rank") -> DataFrame:
    """``df`` with each row's place, from 0 and without gaps, in the order of ``shuffle_hash``.

    Places are counted in range partitions of the hash, so no task sorts the table. Rows with equal keys have neighbouring places; a
    salt spreads them over the ranges, so a key that most rows share does no harm.
    """
    salted = df.withColumns({"_hash": shuffle_hash(keys, seed), "_salt": F.xxhash64(F.monotonically_increasing_id())})
    return running_totals(salted, [], ["_hash", "_salt"], {out: None}).drop("_hash", "_salt")


def balanced_folds(df: DataFrame, keys: Sequence[str], folds: int, seed: int = 0, out: str = "fold") -> DataFrame:
    """Shuffled folds whose sizes differ by at most one row."""
    ranked = shuffled_rank(df, keys, seed, "_rank")
    return ranked.withColumn(out, (F.col("_rank") % folds).cast("int")).drop("_rank")


def exact_holdout(
    df: DataFrame, keys: Sequence[str], share: float = 0.2, seed: int = 0, out: str = "part", names: tuple[str, str] = ("fit", "holdout")
) -> DataFrame:
    """Shuffled holdout of exactly ``ceil(share * rows)`` rows."""
    ranked = materialise(shuffled_rank(df, keys, seed, "_rank"), "ranked")
    held = math.ceil(round(share * ranked.rows, 9))
    return ranked.df.withColumn(out, F.when(F.col("_rank") < held, names[1]).otherwise(names[0])).drop("_rank")


def other_fold_aggregates(fold: str, folds: int, values: Mapping[str, str | Column]) -> dict[str, Column]:
    """Aggregates for the sum and count of each value, whole and without each fold.

    All folds come from one aggregation with partial sums before the shuffle. The sums
    without a fold are added up directly rather than by subtraction, so a row's own
    target never enters its feature, not even as a rounding error.
    """
    aggregates = {}
    for name, value in values.items():
        y = (F.col(value) if isinstance(value, str) else value).cast("double")
        aggregates[f"{name}_sum"] = F.sum(y)
        aggregates[f"{name}_n"] = F.count(y)
        aggregates[f"{name}_sums"] = F.array(
            *[F.sum(F.when(F.col(fold) != i, y).otherwise(0.0)) for i in range(folds)]
        )
        aggregates[f"{name}_ns"] = F.array(*[F.count(F.when(F.col(fold) != i, y)) for i in range(folds)])
    return aggregates


def other_fold_sums(
    train: DataFrame, key: str, fold: str, folds: int, values: Mapping[str, str | Column]
) -> DataFrame:
    """One row per key with the aggregates above."""
    return group_stats(train, [key], **other_fold_aggregates(fold, folds, values))


def other_folds_mean(name: str, fold: str, in_train: Column) -> Column:
    """Mean over the other folds for training rows, over all of them for the rest."""
    own = F.try_divide(F.get(f"{name}_sums", F.col(fold)), F.get(f"{name}_ns", F.col(fold)))
    return F.when(in_train, own).otherwise(full_mean(name))


def full_mean(name: str) -> Column:
    return F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n"))


def _sum_columns(*names: str) -> list[str]:
    return [f"{n}_{part}" for n in names for part in ("sum", "n", "sums", "ns")]


def target_mean_kfold(
    df: DataFrame, keys: list[str], target: str, fold: str, folds: int, source: str = "source", suffix: str = "_avg_sales"
) -> DataFrame:
    """Out-of-fold mean target per key column; unseen keys get the overall mean of the train rows."""
    in_train = F.col(source) == "train"
    train = df.filter(in_train)
    overall = mean_of(train, target)
    for key in keys:
        sums = other_fold_sums(train, key, fold, folds, {"_y": target})
        df = (
            attach(df, sums, [key])
            .withColumn(f"{key}{suffix}", F.coalesce(other_folds_mean("_y", fold, in_train), overall))
            .drop(*_sum_columns("_y"))
        )
    return df


def price_ratio_kfold(
    df: DataFrame,
    key: str,
    target: str,
    price: str,
    fold: str,
    folds: int,
    out: str,
    fallback: str,
    source: str = "source",
    epsilon: float = 1e-6,
) -> DataFrame:
    """Out-of-fold ``mean(target) / (mean(price) + epsilon)`` per key.

    Keys without other rows get the ratio of the overall means (``fallback="overall"``)
    or the unweighted mean of the keys' own ratios (``fallback="keys"``).
    """
    in_train = F.col(source) == "train"
    sums = materialise(
        other_fold_sums(df.filter(in_train), key, fold, folds, {"_y": target, "_p": price})
    )
    if fallback == "overall":
        default = sums.df.agg(
            F.try_divide(
                F.try_divide(F.sum("_y_sum"), F.sum("_y_n")),
                F.try_divide(F.sum("_p_sum"), F.sum("_p_n")) + epsilon,
            )
        ).scalar()
    else:
        default = sums.df.agg(F.avg(F.try_divide(full_mean("_y"), full_mean("_p") + epsilon))).scalar()
    ratio = F.try_divide(
        other_folds_mean("_y", fold, in_train), other_folds_mean("_p", fold, in_train) + epsilon
    )
    return (
        attach(df, sums, [key])
        .withColumn(out, F.coalesce(ratio, default))
        .drop(*_sum_columns("_y", "_p"))
    )


def saleability_kfold(df, item, target, price, fold, folds, out, source="source") -> DataFrame:
    return price_ratio_kfold(df, item, target, price, fold, folds, out, "overall", source)


def outlet_efficiency_kfold(df, outlet, target, price, fold, folds, out, source="source") -> DataFrame:
    return price_ratio_kfold(df, outlet, target, price, fold, folds, out, "keys", source)

"""Error measures as aggregate expressions over (label, prediction)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rmse(label: str, prediction: str) -> Column:
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2)))


def r2(label: str, prediction: str) -> Column:
    """1 - residual over total sum of squares, in one pass; null for a constant label."""
    y = F.col(label)
    residual = F.sum(F.pow(y - F.col(prediction), 2))
    return 1 - F.try_divide(residual, F.var_pop(y) * F.count(y))


def bias_factor(label: str, prediction: str) -> Column:
    """The factor c that makes c * prediction closest to the label."""
    p = F.col(prediction)
    return F.try_divide(F.sum(F.col(label) * p), F.sum(p * p))


def rmse_by_fold(df: DataFrame, label: str, prediction: str, fold: str) -> DataFrame:
    return df.groupBy(fold).agg(rmse(label, prediction).alias("rmse"))


def rmse_original_scale(df: DataFrame, log_label: str, log_prediction: str, fold: str) -> DataFrame:
    """Mean over folds of the error after undoing log1p on both sides."""
    back = df.select(
        fold, F.expm1(log_label).alias("_label"), F.expm1(log_prediction).alias("_prediction")
    )
    return rmse_by_fold(back, "_label", "_prediction", fold).agg(F.avg("rmse").alias("rmse"))

"""Projection, tagging, union, split and schema alignment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tag_source(df: DataFrame, name: str, column: str = "source") -> DataFrame:
    return df.withColumn(column, F.lit(name))


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both; a column one side lacks is null there."""
    return a.unionByName(b, allowMissingColumns=True)


def split_source(df: DataFrame, column: str = "source") -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(column) == "train"), df.filter(F.col(column) == "test")


def drop_columns(df: DataFrame, names: list[str], strict: bool = False) -> DataFrame:
    """Without the named columns; ``strict`` objects to names that are not there."""
    missing = [n for n in names if n not in df.columns]
    if strict and missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*names)


def columns_of_type(df: DataFrame, kind: type[T.DataType], exclude: list[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind) and f.name not in exclude]


def unique_names(names: list[str]) -> list[str]:
    """Names in order, each once."""
    return list(dict.fromkeys(names))


def distinct_values(frames: list[DataFrame], column: str) -> DataFrame:
    """Values of a column over several tables; each table is made distinct by the same shuffle."""
    return reduce(DataFrame.unionAll, [f.select(column) for f in frames]).distinct()


def align_columns(df: DataFrame, like: list[str], fill=0) -> DataFrame:
    """The columns of ``like`` in that order: absent ones filled, others dropped."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in like])


def numeric_matrix(df: DataFrame, columns: list[str], lenient: bool = False) -> DataFrame:
    """The columns as doubles; ``lenient`` turns text that is no number into null."""
    cast = (lambda c: F.col(c).try_cast("double")) if lenient else (lambda c: F.col(c).cast("double"))
    return df.withColumns({c: cast(c) for c in columns})


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, nulls)`` from one aggregation."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "nulls")


def shape_profile(frames: dict[str, DataFrame]) -> DataFrame:
    """``(name, n_rows, n_cols)`` of each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("name"), "n_rows", F.lit(len(df.columns)).alias("n_cols")
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, parts)

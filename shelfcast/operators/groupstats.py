"""Group statistics as feature columns: fit on one table, join to another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.joins import attach
from shelfcast.operators.order_stats import group_quantile
from shelfcast.session import Table, materialise


def group_stats(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """One row per non-null key. Aggregation is partial before the shuffle, so hot keys are cheap."""
    return df.dropna(subset=keys).groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])


def group_mean(df: DataFrame, keys: list[str], value: str | Column, out: str) -> DataFrame:
    return group_stats(df, keys, **{out: F.avg(value)})


def broadcast_mean(df: DataFrame, keys: list[str], value: str | Column, out: str) -> DataFrame:
    """The group mean on every row; a join of the means rather than a window over whole groups."""
    return attach(df, group_mean(df, keys, value, out), keys)


def mean_of(df: DataFrame, value: str | Column) -> Column:
    """Mean of a column as a scalar subquery."""
    return df.agg(F.avg(value)).scalar()


def median_of(df: DataFrame, value: str, weight: str | None = None) -> Column:
    """Exact median as a scalar subquery; ``weight`` lets a group table stand for its rows."""
    return group_quantile(df, [], value, 0.5, "median", weight).scalar()


def ratio_to_mean(
    df: DataFrame,
    stats: DataFrame,
    keys: list[str],
    value: str,
    mean: str,
    out: str,
    epsilon: float = 0.0,
    unseen_mean: Column | None = None,
    unseen_ratio: float | None = None,
) -> DataFrame:
    """Value over its group's mean; unseen groups use another mean or a fixed ratio."""
    joined = attach(df, stats, keys)
    divisor = F.col(mean) if unseen_mean is None else F.coalesce(F.col(mean), unseen_mean)
    result = F.try_divide(F.col(value), divisor + F.lit(epsilon) if epsilon else divisor)
    if unseen_ratio is not None:
        result = F.coalesce(result, F.lit(unseen_ratio))
    return joined.withColumn(out, result).drop(mean)


#: Values that one mask of bits can tell apart.
MASK_BITS = 62


def value_mask(value: str | Column, values: Sequence) -> Column:
    """The set of values that occur, as bits: an aggregate that merges by ``bit_or``. Other values and null leave no bit."""
    if len(values) > MASK_BITS:
        raise ValueError(f"a mask holds {MASK_BITS} values")
    value = F.col(value) if isinstance(value, str) else value
    bit = F.lit(0).cast("long")
    for i, v in enumerate(values):
        bit = F.when(value == F.lit(v), F.lit(1 << i).cast("long")).otherwise(bit)
    return F.bit_or(F.coalesce(bit, F.lit(0).cast("long")))


def mask_counts(mask: str, names: Sequence[str], counted: Column | None = None) -> dict[str, Column]:
    """Aggregates over one row per (group, item): how many items have each bit. They add up, so larger groups follow."""
    has = F.lit(True) if counted is None else counted
    return {name: F.count_if(has & (F.getbit(F.col(mask), F.lit(i)) == 1)) for i, name in enumerate(names)}


def shares_of(counts: Sequence[str], outputs: Sequence[str]) -> dict[str, Column]:
    """Each count over the sum of all, null where that is 0."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in counts])
    return {out: F.try_divide(F.col(c), total) for c, out in zip(counts, outputs, strict=True)}


def distinct_share(
    df: DataFrame, key: str, category: str, item: str, outputs: Mapping[str, str], complete: bool = False
) -> DataFrame:
    """Per key, the share of its distinct items in each category.

    The divisor is the sum over all categories of distinct items per category, so an
    item in two categories counts twice. ``outputs`` maps category to column name; ``complete`` says that there are no other
    categories, else they are looked up first.

    The categories of an item become bits, which merge in the partial aggregation, so no distinct triples are shuffled.
    """
    values = list(outputs)
    if not complete:
        others = df.select(category).dropna().distinct().filter(~F.col(category).isin(values)).orderBy(category)
        values += [r[0] for r in others.limit(MASK_BITS + 1).collect()]
    if len(values) > MASK_BITS:
        return _distinct_share_of_many(df, key, category, item, outputs)
    masks = df.dropna(subset=[key, category, item]).groupBy(key, item).agg(value_mask(category, values).alias("_mask"))
    names = [f"_n_{i}" for i in range(len(values))]
    counts = masks.groupBy(key).agg(*[c.alias(n) for n, c in mask_counts("_mask", names).items()])
    shares = shares_of(names, [*outputs.values(), *names[len(outputs) :]])
    return counts.select(key, *[shares[name].alias(name) for name in outputs.values()])


def _distinct_share_of_many(df: DataFrame, key: str, category: str, item: str, outputs: Mapping[str, str]) -> DataFrame:
    """``distinct_share`` with more categories than bits."""
    pairs = df.select(key, category, item).dropna().distinct()
    counts = pairs.groupBy(key).agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.col(category) == value).alias(f"_n_{i}") for i, value in enumerate(outputs)],
    )
    return counts.select(
        key,
        *[(F.col(f"_n_{i}") / F.col("_all")).alias(name) for i, name in enumerate(outputs.values())],
    )


def rollup(rows: DataFrame, sets: Sequence[Sequence[str]], merge: Mapping[str, Column]) -> dict[tuple[str, ...], Table]:
    """Statistics of several groupings from one aggregation, partial before the shuffle, written once.

    ``merge`` holds the aggregates. Each grouping comes back as a table of its keys and them, with its
    measured size; groups of which all keys are null are left out.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    grouped = rows.groupingSets([[F.col(k) for k in s] for s in sets], *keys)
    table = materialise(grouped.agg(F.grouping_id().alias("_set"), *[a.alias(n) for n, a in merge.items()]), "rollup")
    numbers = {tuple(s): sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s) for s in sets}
    sizes = {r["_set"]: r["count"] for r in table.df.groupBy("_set").count().collect()}
    found = {}
    for s, number in numbers.items():
        some = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in s])
        part = table.df.filter((F.col("_set") == number) & some).select(*s, *merge)
        n = sizes.get(number, 0)
        found[s] = Table(part, n, -(-table.bytes * n // max(table.rows, 1)))
    return found


def item_first_year(df: DataFrame, item: str, year: str, reference_year: int, out: str) -> DataFrame:
    """Years since the earliest outlet that carries the item."""
    return group_stats(df, [item], **{out: F.lit(reference_year) - F.min(year)})


def outlet_stats(df: DataFrame, outlet: str, item: str, target: str) -> DataFrame:
    """Distinct items and mean target per outlet, through (outlet, item) partial results."""
    pairs = df.dropna(subset=[outlet]).groupBy(outlet, item).agg(
        F.sum(target).alias("_sum"), F.count(target).alias("_count")
    )
    return pairs.groupBy(outlet).agg(
        F.count(item).alias("item_count"),
        F.try_divide(F.sum("_sum"), F.sum("_count")).alias("mean_sales"),
    )


def target_mean(
    train: DataFrame, df: DataFrame, keys: list[str], target: str | Column, out: str, default: Column | None = None
) -> DataFrame:
    """Mean target per key learned on ``train`` (leaks a row's own target into its feature)."""
    joined = attach(df, group_mean(train, keys, target, out), keys)
    return joined if default is None else joined.withColumn(out, F.coalesce(F.col(out), default))


def target_mean_of_means(
    train: DataFrame, df: DataFrame, keys: list[str], target: str | Column, out: str
) -> DataFrame:
    """As ``target_mean``, unseen keys getting the unweighted mean of the group means."""
    means = group_mean(train, keys, target, out)
    return attach(df, means, keys).withColumn(out, F.coalesce(F.col(out), mean_of(means, out)))

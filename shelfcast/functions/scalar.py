"""Column expressions for cleaning and deriving single values; all stay inside codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------
FAT_CONTENT = {"LF": "Low Fat", "low fat": "Low Fat", "reg": "Regular", "Non Edible": "Non-Edible"}
CATEGORY_BY_PREFIX = {"FD": "Food", "DR": "Drinks", "NC": "Non-Consumable"}
SIZE_SCORE = {"Small": 1, "Medium": 2, "High": 3}
TIER_SCORE = {"Tier 1": 3, "Tier 2": 2, "Tier 3": 1}
SIZE_BY_TYPE = {
    "Grocery Store": "Small",
    "Supermarket Type1": "Medium",
    "Supermarket Type2": "Medium",
    "Supermarket Type3": "Medium",
}
SIZE_BY_TYPE_SMALL_FIRST = {**SIZE_BY_TYPE, "Supermarket Type1": "Small"}
PRICE_EDGES = [0.0, 70.0, 135.0, 200.0, None]
PRICE_LABELS = ["Low_MRP", "Mid_MRP", "High_MRP", "VHigh_MRP"]
PRICE_EDGES_WIDE = [0.0, 70.0, 140.0, 210.0]
PRICE_LABELS_WIDE = ["Low", "Medium", "High", "Very High"]
ERAS = [(1990, "1980s"), (2000, "1990s"), (None, "2000s")]
REFERENCE_YEAR = 2013
HIGH_VISIBILITY = 0.19
# ----------------------------------------------------------------------------------


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_value(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Literal lookup; unmapped values (and nulls) give ``default``."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.create_map(*pairs)[as_column(c)]
    return found if default is None else F.coalesce(found, F.lit(default))


def remap(c: Column | str, mapping: Mapping) -> Column:
    """Spelling variants to their canonical value; other values are kept."""
    return F.coalesce(map_value(c, mapping), as_column(c))


def prefix(c: Column | str, length: int = 2) -> Column:
    return F.substring(as_column(c), 1, length)


def prefix_category(c: Column | str, mapping: Mapping, otherwise: str | None = None) -> Column:
    """Category by the first two characters; unknown prefixes give ``otherwise``."""
    return map_value(prefix(c), mapping, otherwise)


def prefix_category_enum(c: Column | str, mapping: Mapping) -> Column:
    """Category by an enumerated list of three-character prefixes; unlisted ones stay as they are."""
    return remap(prefix(c, 3), mapping)


def override_where(c: Column | str, condition: Column, value) -> Column:
    return F.when(condition, F.lit(value)).otherwise(as_column(c))


def age(year: Column | str, reference_year: int = REFERENCE_YEAR) -> Column:
    return F.lit(reference_year) - as_column(year)


def era(year: Column | str, eras: Sequence[tuple] = ERAS) -> Column:
    """First label whose bound lies above the year."""
    year = as_column(year)
    *bounded, (_, last) = eras
    chain = F.when(year.isNull(), None)
    for bound, label in bounded:
        chain = chain.when(year < bound, label)
    return chain.otherwise(last)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def text_or_nan(c: Column | str) -> Column:
    """Text form in which a missing value is a class of its own."""
    return F.coalesce(as_column(c).cast("string"), F.lit("nan"))


def joined_text(*columns: Column | str) -> Column:
    return F.concat_ws("_", *[text_or_nan(c) for c in columns])


def last_digit(c: Column | str) -> Column:
    return F.substring(as_column(c), -1, 1).cast("int")


def ratio(a: Column | str, b: Column | str, epsilon: float = 0.0) -> Column:
    """``a / (b + epsilon)``, null where the divisor is zero."""
    b = as_column(b)
    return F.try_divide(as_column(a), b + F.lit(epsilon) if epsilon else b)


def price_per_unit(price: Column | str, weight: Column | str, zero: float = 1e-6) -> Column:
    """Price by weight, a zero weight counting as ``zero``; null for a missing weight."""
    weight = as_column(weight)
    return as_column(price) / F.when(weight == 0, F.lit(zero)).otherwise(weight)


def floor_at(c: Column | str, bound: float = 0.0) -> Column:
    c = as_column(c)
    return F.when(c < bound, F.lit(bound)).otherwise(c)


def clamp(c: Column | str, low, high) -> Column:
    """Value held between two limits; null stays null."""
    c = as_column(c)
    low, high = (v if isinstance(v, Column) else F.lit(v) for v in (low, high))
    return F.when(c < low, low).when(c > high, high).otherwise(c)


def finite_or_null(c: Column | str) -> Column:
    c = as_column(c).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)


def bin_left_closed(c: Column | str, edges: Sequence[float | None], labels: Sequence[str]) -> Column:
    """Label of ``[a, b)``; a top edge of None is open. Null outside all bins."""
    c = as_column(c)
    chain = F.when(c.isNull() | F.isnan(c.cast("double")), None)
    for a, b, label in zip(edges, edges[1:], labels):
        inside = c >= F.lit(a)
        if b is not None:
            inside = inside & (c < (b if isinstance(b, Column) else F.lit(b)))
        chain = chain.when(inside, label)
    return chain


def bin_right_closed(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of ``(a, b]`` with open ends; ``edges`` are the inner ones, one fewer than labels."""
    c = as_column(c)
    chain = F.when(c.isNull(), None)
    for edge, label in zip(edges, labels):
        chain = chain.when(c <= F.lit(edge), label)
    return chain.otherwise(labels[-1])


def box_cox(c: Column | str, power: float) -> Column:
    c = as_column(c)
    if power == 0:
        return F.ln(c)
    return (F.pow(c, F.lit(float(power))) - 1) / F.lit(float(power))

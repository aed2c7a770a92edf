"""Every operator as a query over the given tables, with its check SQL."""

from shelfcast.catalog import cleaning, distribution, encoding, filling, fitted, groups, modelling, shaping  # noqa: F401
from shelfcast.catalog.common import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]

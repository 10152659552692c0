"""Registered queries over the driver's tables, each next to the SQL that checks it."""

from starmart.queries import (  # noqa: F401  (importing a module registers its queries)
    aggregates,
    cleaning,
    dictionary,
    files,
    joins,
    keys,
    quality,
    star,
)
from starmart.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

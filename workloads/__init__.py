"""Queries binding the engine's operators to the supplied tables.

Each module registers (name, Spark query, equivalent SQL). Importing the package
registers all of them.
"""

from . import enrich, functions, matching, merges, pages, publish, quality, reports, search, streams, taxonomy, views  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401

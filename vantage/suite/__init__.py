"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is the same result as SQL over
the driver tables registered as views. Computed columns carry the same names on both sides.
Importing the group modules registers their queries.
"""

from vantage.suite.registry import ORACLE, QUERIES
from vantage.suite import catalog, charts, datasets, insights, reports, sqlsurface  # noqa: F401  (registration)

__all__ = ["ORACLE", "QUERIES"]

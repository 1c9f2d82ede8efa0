"""The operators applied to the driver's tables, each with the same query in SQL."""

from . import aggregates, files, jobs, joins, links, scalars  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

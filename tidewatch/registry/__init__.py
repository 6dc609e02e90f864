"""Named queries over the driver tables, with the SQL that states their expected results."""

from . import operator_queries, report_queries, stream_queries, table_queries  # noqa: F401
from .entries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Registered queries and the SQL they are checked against."""

from wattlake.queries.oracle import ORACLE
from wattlake.queries.registry import QUERIES

__all__ = ["ORACLE", "QUERIES"]

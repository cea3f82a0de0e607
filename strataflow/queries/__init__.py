"""The registered queries, each with its counterpart in plain SQL over the test tables."""

from . import aggregates, columns, predicates, files, joins, layers, ordered, scalars, tables  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Operators for corpora of training texts; nothing else in the library imports this package."""

from fleetmart.llm import queries  # noqa: F401
from fleetmart.llm.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

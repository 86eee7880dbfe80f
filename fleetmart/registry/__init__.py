"""All registered queries."""

from fleetmart.registry import (  # noqa: F401
    columns,
    events,
    functions,
    histories,
    lookups,
    properties,
    refresh,
    schema,
    sync,
    views,
)
from fleetmart.registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

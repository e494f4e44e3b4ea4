"""Registered queries: one per operator, each with the SQL it is checked against."""

from larkspur.catalog import registry
from larkspur.catalog import (  # noqa: F401  (importing fills the registry)
    aggregates,
    calendar,
    checks,
    expectations,
    joins,
    layout,
    ordering,
    plans_orders,
    plans_retail,
    rows,
    scalars,
    sinks,
    streams,
    suites,
)

QUERIES = registry.QUERIES
SQL = registry.SQL

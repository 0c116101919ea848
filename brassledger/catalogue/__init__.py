"""Registered queries with their SQL oracles."""

from brassledger.catalogue import (  # noqa: F401  (importing registers the queries)
    aggregates,
    curated,
    dashboards,
    governance,
    ingest,
    joins,
    malformed,
    preparation,
    quality,
    row_checks,
    scalars,
    standardising,
    streams,
    windows,
)
from brassledger.catalogue.core import oracle_sql, queries  # noqa: F401

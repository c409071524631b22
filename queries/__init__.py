"""Queries over the driver's tables, each with its DuckDB oracle where SQL can say it."""

from queries import (  # noqa: F401
    checks,
    features,
    gold,
    ingest,
    kpis,
    models,
    report,
    scalars,
    serving,
    silver,
    streams,
)
from queries.registry import ORACLES, QUERIES  # noqa: F401

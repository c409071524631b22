"""Entity time-series forecasting on Spark: ingest, clean, model, check, publish, report.

Every operator is a function from DataFrames to a lazy DataFrame. Settings and the clock
are parameters; nothing reads module-level time and no transform collects rows.
"""

from slotcast.config import Settings, Site

__all__ = ["Settings", "Site"]

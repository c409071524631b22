"""The report job: the tables behind the report, from one published pair that passes its guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.config import Settings
from slotcast.operators import report as rp
from slotcast.plans.publish import checked_pair
from slotcast.session import materialize
from slotcast.sources.store import TableStore


def sections(kpis: DataFrame, predictions: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """Tables of the report by name. The serving model's backtest is written once for all three."""
    columns = ["park_name", "ride_key", "ride_name", "ts_local", "actual_wait_min",
               "predicted_wait_min", "error_min"]
    own = materialize(rp.serving_backtest(predictions, kpis).select(*columns), "backtest")
    histogram = materialize(rp.error_histogram(predictions, settings), "histogram")
    return {
        "provenance": rp.provenance_strip(kpis, predictions),
        "tiles": rp.kpi_tiles(kpis),
        "comparison": rp.model_comparison(kpis, settings),
        "daily": rp.daily_means(own),
        "hourly": rp.hourly_means(own),
        "histogram": histogram,
        "scale": rp.shared_scale(histogram),
        "hardest": rp.hardest_units(own),
    }


def run_report(
    store: TableStore, settings: Settings, now_local: Column, folder: str
) -> DataFrame:
    """Write every table under ``folder`` and return how many rows each has (section, rows).

    Both halves come from one pointer row. A pair that a guard refuses raises before anything is
    written, so a report never shows tables of two runs or a window that is over.
    """
    kpis, predictions = checked_pair(store, now_local)
    written = None
    for name, rows in sections(kpis, predictions, settings).items():
        path = f"{folder}/{name}"
        rows.write.mode("overwrite").parquet(path)
        count = store.spark.read.schema(rows.schema).parquet(path).agg(
            F.lit(name).alias("section"), F.count(F.lit(1)).alias("rows")
        )
        written = count if written is None else written.unionByName(count)
    return written

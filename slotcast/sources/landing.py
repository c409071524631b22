"""Landing area: immutable Parquet batches under ``dt=<UTC date>/batch=<low id>-<stamp>``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from slotcast.functions.clock import run_id_text
from slotcast.schemas import LANDING, LANDING_COLUMNS


def batch_path(root: str, low: int, now_utc: datetime) -> str:
    return f"{root}/dt={now_utc:%Y-%m-%d}/batch={low:012d}-{run_id_text(now_utc)}"


def land_batch(batch: DataFrame, root: str, low: int, now_utc: datetime) -> str:
    """Write one batch; sending the same batch again replaces it."""
    path = batch_path(root, low, now_utc)
    batch.select(*LANDING_COLUMNS).write.mode("overwrite").option("compression", "snappy").parquet(
        path
    )
    return path


def read_batch(spark: SparkSession, path: str) -> DataFrame:
    """One landed batch by its exact path: the rest of the landing area is not listed."""
    return spark.read.schema(LANDING).parquet(path)

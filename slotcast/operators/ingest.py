"""Incremental ingest: marks, gaps and the insert-only merge."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.functions.clock import naive
from slotcast.schemas import BRONZE_COLUMNS


def high_water(df: DataFrame, name: str = "mark") -> DataFrame:
    """Highest id, 0 when there is none. Taken from the data, never stored."""
    return df.agg(F.coalesce(F.max("wait_time_id"), F.lit(0)).cast("bigint").alias(name))


def batch_range(batch: DataFrame) -> DataFrame:
    return batch.agg(
        F.min("wait_time_id").alias("low"),
        F.max("wait_time_id").alias("high"),
        F.count(F.lit(1)).alias("rows"),
    )


def gap_report(upstream: DataFrame, bronze: DataFrame) -> DataFrame:
    """How many ids bronze is behind; writes nothing. Of bronze the newest rows are enough."""
    mark = high_water(bronze).scalar()
    return high_water(upstream, "upstream_max").select(
        mark.alias("mark"),
        "upstream_max",
        F.greatest(F.lit(0), F.col("upstream_max") - mark).cast("bigint").alias("gap"),
    )


def stamp_ingested(batch: DataFrame, now_utc: datetime | None = None) -> DataFrame:
    when = F.current_timestamp() if now_utc is None else naive(now_utc).cast("timestamp")
    return batch.withColumn("_ingested_at", when).select(*BRONZE_COLUMNS)


def new_rows(batch: DataFrame, bronze: DataFrame, low: int | Column | None = None) -> DataFrame:
    """Rows of the batch whose id bronze does not hold.

    Only bronze ids from the batch's lowest id on can match, so that bound is pushed into
    the bronze scan and row groups below it are skipped. Equal ids inside one batch are
    all kept; silver removes them. Rows are never updated.
    """
    if low is None:
        low = batch.agg(F.min("wait_time_id")).scalar()
    held = bronze.where(F.col("wait_time_id") >= low).select("wait_time_id")
    return batch.join(held, "wait_time_id", "left_anti").select(*batch.columns)


def merge(batch: DataFrame, bronze: DataFrame, low: int | Column | None = None) -> DataFrame:
    """Bronze after the insert-only merge of one stamped batch."""
    return bronze.unionByName(new_rows(batch, bronze, low))


def ingest_summary(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.count(F.lit(1)).alias("rows"), F.max("wait_time_id").alias("max_id")
    )

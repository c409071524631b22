"""Landed files into bronze as a stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slotcast.config import Settings
from slotcast.functions import clock
from slotcast.operators import ingest as ing
from slotcast.schemas import LANDING, LANDING_COLUMNS
from slotcast.session import materialize
from slotcast.sources.bronze import Bronze


def read_landing(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """New files of the landing area; the source remembers the ones it has handed out."""
    reader = spark.readStream.schema(LANDING)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(landing).select(*LANDING_COLUMNS)


def drain_to_bronze(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    now_utc: datetime | None = None,
    max_files: int | None = None,
    range_ids: int = Settings().bronze_range_ids,
) -> StreamingQuery:
    """Merge everything that has landed into bronze, a few files at a time, and stop.

    Each batch goes through the insert-only merge, so a batch that is run again after a
    failure, or a file that lands twice, adds nothing.
    """
    table = Bronze(spark, bronze, range_ids)
    table.ensure()

    def merge_batch(batch: DataFrame, _epoch: int) -> None:
        # Written once: the merge reads it for its ids, its order and its rows.
        rows = materialize(ing.stamp_ingested(batch, now_utc), "batch")
        span = ing.batch_range(rows).first()
        if span["low"] is not None:
            table.merge(rows, span["low"], span["high"])

    return (
        read_landing(spark, landing, max_files)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_stream(landing: DataFrame, delay: str) -> DataFrame:
    """One row per id while copies arrive within ``delay`` of event time; bounded state.

    For exact results over any distance, use the merge of ``drain_to_bronze``.
    """
    instants = landing.withColumn("ts_utc", F.col("ts_utc").cast("timestamp"))
    return instants.withWatermark("ts_utc", delay).dropDuplicatesWithinWatermark(["wait_time_id"])


def freshness_stream(
    landing: DataFrame, out: str, checkpoint: str, zone: str, now_local: datetime
) -> StreamingQuery:
    """Newest local time and input age after each batch, one file per batch."""

    def measure(batch: DataFrame, epoch: int) -> None:
        newest = F.max(clock.to_local(F.col("ts_utc"), zone))
        age = clock.hours_between(clock.naive(now_local), F.col("newest_local"))
        row = batch.agg(newest.alias("newest_local")).withColumn("age_hours", age)
        # A batch that is run again replaces its own folder.
        row.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return (
        landing.writeStream.foreachBatch(measure)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

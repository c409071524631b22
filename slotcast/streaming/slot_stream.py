"""Slot means as a stream.

Windows run over the UTC instant and only their start is turned into local time, which is right
where every offset of the zone is a multiple of the grid; other zones are refused. State holds
one sum and count per open group; the watermark drops groups older than the allowed delay.
"""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slotcast.config import Settings
from slotcast.functions import clock

GROUP = ["park_name", "ride_name"]


def check_zone(zone: str, grid_minutes: int, years: range = range(1990, 2045)) -> None:
    """Raise if slots of the zone do not begin where slots of UTC begin, in any month."""
    for year in years:
        for month in range(1, 13):
            offset = datetime(year, month, 15, tzinfo=ZoneInfo(zone)).utcoffset()
            if offset.total_seconds() % (60 * grid_minutes):
                raise ValueError(f"{zone} is off the {grid_minutes}-minute grid of UTC in {year}")


def slot_means(landing: DataFrame, settings: Settings, delay: str) -> DataFrame:
    """Mean and count per site, name and slot."""
    check_zone(settings.time_zone, settings.grid_minutes)
    instants = landing.withColumn("ts", F.col("ts_utc").cast("timestamp"))
    window = F.window("ts", f"{settings.grid_minutes} minutes")
    return (
        instants.withWatermark("ts", delay)
        .groupBy(window, *GROUP)
        .agg(F.avg("wait_time").alias("wait_time"), F.count(F.lit(1)).alias("rows"))
        .select(
            *GROUP,
            clock.to_local(clock.as_naive(F.col("window.start")), settings.time_zone).alias(
                "ts_local"
            ),
            F.col("window.start").cast("timestamp_ntz").alias("ts_utc"),
            "wait_time",
            "rows",
        )
    )


def drain_slot_means(means: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write the groups each batch changed; a batch that is run again replaces its folder."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return (
        means.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain_closed_slots(means: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write every slot once, when the watermark has passed its end, and forget it.

    Nothing has to be looked up later: the folder holds a row per closed slot, and the state
    the slots of the allowed delay. A batch that is run again replaces its folder.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return (
        means.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_slot_means(spark: SparkSession, out: str) -> DataFrame:
    """The newest state of every group from the change log."""
    log = spark.read.parquet(out)
    newest = F.max_by(F.struct("wait_time", "rows"), "epoch").alias("_last")
    return log.groupBy(*GROUP, "ts_local", "ts_utc").agg(newest).select(
        *GROUP, "ts_local", "ts_utc", "_last.*"
    )

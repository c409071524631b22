"""Units that have fallen silent, as a stream with a timer per unit.

State holds one number per unit, its newest observation. Each observation sets the unit's timer
to that long after it; a timer that the watermark overtakes reports the unit and drops its
state, so what is kept is one number per unit that still speaks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

UNIT = ["park_name", "ride_name"]
CHANGES = "park_name string, ride_name string, newest_micros bigint, silent boolean"


def silence(landing: DataFrame, silent_minutes: int, delay: str) -> DataFrame:
    """Changes: a unit's newest observation, or that it has been silent for too long since.

    Only names and times are sent to the groups. An observation that is already too old when it
    comes reports its unit as silent at once, unless a newer one is known.
    """
    limit = silent_minutes * 60_000_000

    def follow(
        key: tuple[str, str], chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            newest, silent = state.get[0], True
        else:
            newest = max([int(c["micros"].max()) for c in chunks] + [*(state.get if state.exists else ())])
            silent = newest + limit <= state.getCurrentWatermarkMs() * 1000
        if silent:
            if state.exists:
                state.remove()
        else:
            state.update((newest,))
            # Rounded up, as the watermark has milliseconds.
            state.setTimeoutTimestamp(-(-(newest + limit) // 1000))
        yield pd.DataFrame(
            {"park_name": [key[0]], "ride_name": [key[1]], "newest_micros": [newest], "silent": [silent]}
        )

    seen = landing.where(F.col("ts_utc").isNotNull()).select(
        *UNIT, F.col("ts_utc").cast("timestamp").alias("ts")
    )
    timed = seen.withWatermark("ts", delay).withColumn("micros", F.unix_micros("ts"))
    return timed.groupBy(*UNIT).applyInPandasWithState(
        follow, CHANGES, "newest bigint", "update", GroupStateTimeout.EventTimeTimeout
    )


def drain_silence(changes: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write the changes of each batch; a batch that is run again replaces its folder."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return (
        changes.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def unit_freshness(spark: SparkSession, out: str) -> DataFrame:
    """Per unit its newest observation and whether it is silent since, from the changes."""
    log = spark.read.parquet(out)
    newest = log.groupBy(*UNIT).agg(F.max("newest_micros").alias("newest_micros"))
    # A report of silence comes after the observation it is about.
    return (
        log.join(newest, [*UNIT, "newest_micros"])
        .groupBy(*UNIT, "newest_micros")
        .agg(F.max("silent").alias("silent"))
        .select(
            *UNIT,
            F.timestamp_micros("newest_micros").cast("timestamp_ntz").alias("newest_utc"),
            "silent",
        )
    )

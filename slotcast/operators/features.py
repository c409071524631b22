"""Calendar features of the local clock, the chronological split, and segments."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.config import Settings
from slotcast.functions import clock, text
from slotcast.functions.holidays import is_holiday

# ---- fixed values -------------------------------------------------------------------
CALENDAR_FEATURES = [
    "hour",
    "minute",
    "dayofweek",
    "month",
    "is_holiday",
    "is_weekend",
    "hour_sin",
    "hour_cos",
    "month_sin",
    "month_cos",
]
# ---- end of fixed values ------------------------------------------------------------

ORIGIN = datetime(2020, 1, 1)


def with_entity(df: DataFrame) -> DataFrame:
    return df.withColumn("entity", text.entity(F.col("park_name"), F.col("ride_key")))


def calendar(ts: Column) -> dict[str, Column]:
    """Feature name to expression. Monday is day 0."""
    weekday, hour, month = F.weekday(ts), F.hour(ts), F.month(ts)

    def turn(part: Column, period: float) -> Column:
        return part * F.lit(2 * math.pi) / F.lit(period)

    return {
        "hour": hour,
        "minute": F.minute(ts),
        "dayofweek": weekday,
        "month": month,
        "is_holiday": is_holiday(F.to_date(ts)),
        "is_weekend": weekday.isin(5, 6).cast("int"),
        "hour_sin": F.sin(turn(hour, 24.0)),
        "hour_cos": F.cos(turn(hour, 24.0)),
        "month_sin": F.sin(turn(month, 12.0)),
        "month_cos": F.cos(turn(month, 12.0)),
    }


def build_features(df: DataFrame) -> DataFrame:
    """Append the ten calendar features: plain expressions, no join and no shuffle."""
    return df.withColumns(calendar(F.col("ts_local")))


def time_cutoff(df: DataFrame, settings: Settings) -> DataFrame:
    """One row: the time below which the training share of all rows lies.

    Exact, linearly interpolated quantile. Rows are first counted per distinct time, so
    the quantile sees one entry per slot of the calendar, not one per row. Microseconds
    are counted from a near origin, which keeps the interpolation exact in a double.
    """
    share = 1.0 - settings.test_fraction
    origin = clock.micros(clock.naive(ORIGIN))
    counts = df.groupBy("ts_local").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select((clock.micros(F.col("ts_local")) - origin).alias("_offset"), "_n")
    cut = F.round(F.expr(f"percentile(_offset, {share!r}D, _n)")).cast("bigint")
    return offsets.agg(cut.alias("_cut")).select(
        clock.from_micros(F.col("_cut") + origin).alias("cutoff")
    )


def chrono_split(
    df: DataFrame, settings: Settings, cutoff: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train up to and including the cutoff, test after it; one cutoff for all units.

    The cutoff enters as a scalar subquery: a filter the scan can use, not a join.
    """
    cut = time_cutoff(df, settings).scalar() if cutoff is None else cutoff
    return df.where(F.col("ts_local") <= cut), df.where(F.col("ts_local") > cut)


def split_profile(train: DataFrame, test: DataFrame) -> DataFrame:
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("side"),
            F.count(F.lit(1)).alias("rows"),
            F.max("ts_local").alias("last_local"),
        )

    return side(train, "train").unionByName(side(test, "test"))


def high_wait_entities(train: DataFrame, settings: Settings) -> DataFrame:
    """Entities whose training mean lies above the threshold."""
    means = with_entity(train).groupBy("entity").agg(F.avg("wait_time").alias("mean_wait"))
    return means.where(F.col("mean_wait") > settings.high_wait_mean)

"""Wall-clock conversion, slots and date labels.

Local wall times and naive UTC times are TIMESTAMP_NTZ. The session runs in UTC
(``session.pin_utc``), so casts between TIMESTAMP and TIMESTAMP_NTZ keep the digits.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def naive(ts: datetime) -> Column:
    """A Python wall time as a TIMESTAMP_NTZ literal."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def as_naive(ts: Column) -> Column:
    """Drop the zone label without converting."""
    return ts.cast("timestamp_ntz")


def utc_instant(value: Column) -> Column:
    """Naive values count as UTC, values with a zone are converted, unparsable ones are null."""
    return value.try_cast("timestamp").cast("timestamp_ntz")


def to_local(ts_utc: Column, zone: str) -> Column:
    """Naive UTC to naive local wall time. Must come before any hour filter or feature."""
    return F.from_utc_timestamp(ts_utc.cast("timestamp"), zone).cast("timestamp_ntz")


def to_utc(ts_local: Column, zone: str) -> Column:
    """Naive local wall time to naive UTC.

    A time that occurs twice takes its first occurrence. A time the clock skips moves to
    the first valid instant: the round trip through UTC shows it, as it does not come back.
    """

    def convert(ts: Column) -> Column:
        return F.to_utc_timestamp(ts.cast("timestamp"), zone).cast("timestamp_ntz")

    direct = convert(ts_local)
    back = to_local(direct, zone)
    return F.when(back != ts_local, convert(F.date_trunc("hour", back))).otherwise(direct)


def now_local(now_utc: datetime, zone: str) -> Column:
    return to_local(naive(now_utc), zone)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us.cast("bigint")).cast("timestamp_ntz")


def hours_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(3.6e9)


def slot_start(ts: Column, minutes: int) -> Column:
    """Start of the left-closed slot of the wall clock that holds ``ts``."""
    return F.window(ts, f"{minutes} minutes").start


def run_id(now_utc: Column) -> Column:
    return F.date_format(now_utc, "yyyyMMdd'T'HHmmss'Z'")


def run_id_text(now_utc: datetime) -> str:
    return now_utc.strftime("%Y%m%dT%H%M%SZ")


def day_label(ts: Column) -> Column:
    return F.date_format(ts, "MMM dd")


def hour_label(hour: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def minute_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def iso_text_label(iso: Column) -> Column:
    """First 19 characters of ISO text, with a space for the T."""
    return F.replace(F.substring(iso, 1, 19), F.lit("T"), F.lit(" "))

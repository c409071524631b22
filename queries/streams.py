"""Streams over the landed observations, drained to the end."""


from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.registry import query, rounded
from slotcast.schemas import BRONZE, LANDING_COLUMNS
from slotcast.session import scratch_path
from slotcast.streaming import landing_stream as ls
from slotcast.streaming import silence_stream as quiet
from slotcast.streaming import slot_stream as ss

S = fx.SETTINGS


def _land(spark, sf, copies=1):
    """The observations as landed files in time order, each batch ``copies`` times."""
    path = scratch_path(spark, "landing")
    rows = fx.landing(spark, sf)
    for n in range(copies):
        ordered = rows.repartitionByRange(4, "ts_utc").sortWithinPartitions("ts_utc")
        ordered.write.parquet(f"{path}/dt=2024-02-0{n + 1}")
    return path


def _weekly(spark, sf, drain):
    """The observations land week after week, and ``drain`` takes each week when it is there."""
    path, rows = scratch_path(spark, "landing"), fx.landing(spark, sf)
    week = F.date_trunc("week", "ts_utc")
    # One entry a week, however many observations there are.
    for start in sorted(r[0] for r in rows.select(week.alias("week")).distinct().collect()):
        rows.where(week == F.lit(start)).write.parquet(f"{path}/dt={start:%Y-%m-%d}")
        _done(drain(path))


def _done(stream):
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()


@query("stream_landing_to_bronze", f"""WITH {fx.BRONZE} SELECT wait_time_id, wait_time, ts_utc,
    at_id, ride_name, tp_id, park_name FROM bronze""")
def landing_to_bronze(spark, sf):
    """Files drained in small batches; each one landed twice, and bronze holds it once."""
    landing, bronze = _land(spark, sf, copies=2), scratch_path(spark, "bronze")
    for _ in range(2):
        _done(ls.drain_to_bronze(
            spark, landing, bronze, scratch_path(spark, "checkpoint"), fx.INGESTED, max_files=1
        ))
    return spark.read.schema(BRONZE).parquet(bronze).select(*LANDING_COLUMNS)


@query("stream_dedup_within_watermark", f"""WITH {fx.BRONZE} SELECT wait_time_id, park_name,
    ride_name FROM bronze""")
def dedup(spark, sf):
    landing, out = _land(spark, sf, copies=2), scratch_path(spark, "dedup")
    rows = ls.dedup_stream(ls.read_landing(spark, landing, 2), "60 days")
    _done(
        rows.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True).start()
    )
    return spark.read.parquet(out).select("wait_time_id", "park_name", "ride_name")


@query("stream_slot_means", f"""WITH {fx.BRONZE}
    SELECT park_name, ride_name, {fx.loc('slot')} AS ts_local, slot AS ts_utc,
    round(avg(wait_time), 6) AS wait_time, count(*) AS rows
    FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts_utc) AS slot FROM bronze) GROUP BY ALL""")
def slot_means(spark, sf):
    landing, out = _land(spark, sf), scratch_path(spark, "slots")
    means = ss.slot_means(ls.read_landing(spark, landing, 1), S, "60 days")
    _done(ss.drain_slot_means(means, out, scratch_path(spark, "checkpoint")))
    return rounded(ss.latest_slot_means(spark, out), "wait_time")


@query("stream_closed_slots", f"""WITH {fx.BRONZE}
    SELECT park_name, ride_name, {fx.loc('slot')} AS ts_local, slot AS ts_utc,
    round(avg(wait_time), 6) AS wait_time, count(*) AS rows
    FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts_utc) AS slot FROM bronze)
    WHERE slot + INTERVAL 30 MINUTE <= date_trunc('millisecond', (SELECT max(ts_utc) FROM bronze))
      - INTERVAL 2 DAY
    GROUP BY ALL""")
def closed_slots(spark, sf):
    """Slots that the watermark has closed, each written once; two days of slots stay open."""
    out, checkpoint = scratch_path(spark, "slots"), scratch_path(spark, "checkpoint")

    def drain(landing):
        means = ss.slot_means(ls.read_landing(spark, landing), S, "2 days")
        return ss.drain_closed_slots(means, out, checkpoint)

    _weekly(spark, sf, drain)
    return rounded(spark.read.parquet(out).drop("epoch"), "wait_time")


@query("stream_unit_silence", f"""WITH {fx.BRONZE}, newest AS (
      SELECT park_name, ride_name, max(ts_utc) AS newest_utc FROM bronze GROUP BY ALL)
    SELECT *, newest_utc + INTERVAL 4 HOUR <
      date_trunc('millisecond', (SELECT max(ts_utc) FROM bronze)) - INTERVAL 1 HOUR AS silent
    FROM newest""")
def unit_silence(spark, sf):
    """Units without an observation for four hours, when the stream is an hour behind at most."""
    out, checkpoint = scratch_path(spark, "silence"), scratch_path(spark, "checkpoint")

    def drain(landing):
        changes = quiet.silence(ls.read_landing(spark, landing), 240, "1 hour")
        return quiet.drain_silence(changes, out, checkpoint)

    _weekly(spark, sf, drain)
    return quiet.unit_freshness(spark, out)


@query("stream_freshness", f"""WITH {fx.BRONZE} SELECT max({fx.loc('ts_utc')}) AS newest_local,
    round(date_diff('microsecond', max({fx.loc('ts_utc')}), {fx.ts(fx.NOW_LOCAL)}) / 3.6e9, 6)
    AS age_hours FROM bronze""")
def freshness(spark, sf):
    """Input age after the last batch, from the measures of all batches."""
    landing, out = _land(spark, sf), scratch_path(spark, "freshness")
    rows = ls.read_landing(spark, landing, 1)
    _done(ls.freshness_stream(
        rows, out, scratch_path(spark, "checkpoint"), fx.ZONE, fx.NOW_LOCAL
    ))
    newest = spark.read.parquet(out).agg(
        F.max("newest_local").alias("newest_local"), F.min("age_hours").alias("age_hours")
    )
    return rounded(newest, "age_hours")



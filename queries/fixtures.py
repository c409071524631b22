"""The driver's tables in the shape of the engine's inputs, for Spark and for DuckDB."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.registry import table
from slotcast.config import Settings, Site
from slotcast.functions import clock
from slotcast.operators import features as fe
from slotcast.operators import kpis as kp
from slotcast.operators import silver as si
from slotcast.operators.models import baseline
from slotcast.schemas import BRONZE_COLUMNS
from slotcast.session import materialize

SETTINGS = Settings(
    sites=(
        Site("click", 8, 24, date(2024, 1, 1)),
        Site("view", 8, 22, date(2024, 1, 1)),
        Site("purchase", 8, 22, date(2024, 1, 1)),
        Site("signup", 10, 20, date(2024, 1, 1)),
        Site("error", 10, 21, date(2024, 1, 10)),
    ),
    excluded_sites=("legacy",),
    min_obs=20,
    collection_start=datetime(2023, 12, 1),
)
ZONE = SETTINGS.time_zone
INGESTED = datetime(2024, 2, 1)
NOW_LOCAL = datetime(2024, 1, 30, 16)
NOW_UTC = datetime(2024, 1, 31)
STALE_LOCAL = datetime(2024, 2, 5)
SITE_IDS = ("click", "view", "purchase", "signup", "error")


def now_local():
    return clock.naive(NOW_LOCAL)


# ---- Spark --------------------------------------------------------------------------


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations from ``events``, without the ingest stamp."""
    site_id = F.array_position(F.array(*(F.lit(s) for s in SITE_IDS)), F.col("event_type"))
    unit = (F.col("user_id") % 10).cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("wait_time_id"),
        F.floor("value").cast("bigint").alias("wait_time"),
        F.col("ts").alias("ts_utc"),
        unit.alias("at_id"),
        F.concat(F.lit("Ride "), unit.cast("string")).alias("ride_name"),
        site_id.cast("bigint").alias("tp_id"),
        F.col("event_type").alias("park_name"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = clock.naive(INGESTED).cast("timestamp")
    return landing(spark, sf_dir).withColumn("_ingested_at", stamp).select(*BRONZE_COLUMNS)


def seasonal_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations with a daily peak in the afternoon: something a model can learn.

    The values of the events are noise, on which no model beats the mean, and the gate
    rightly refuses such a run.
    """
    hour = F.hour(clock.to_local(F.col("ts_utc"), ZONE))
    wait = F.floor(F.col("wait_time") / 10) + 70 - 5 * F.abs(hour - 14)
    return bronze(spark, sf_dir).withColumn("wait_time", wait.cast("bigint"))


def dirty_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation in 16 variants: itself, and one for each defect silver handles."""
    v, name, unit = F.col("v"), F.col("ride_name"), F.col("at_id").cast("string")
    wide = bronze(spark, sf_dir).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(15))))
    return wide.select(
        F.when(v == 11, F.lit(None))
        .otherwise(F.col("wait_time_id") * 100 + F.when(v == 1, 0).otherwise(v))
        .cast("bigint").alias("wait_time_id"),
        F.when(v == 1, F.col("wait_time") + 1)
        .when(v == 2, F.col("wait_time") + 900)
        .when(v == 3, -1 - F.col("wait_time"))
        .when(v == 4, F.lit(None))
        .when(v == 13, F.col("wait_time") + 5)
        .otherwise(F.col("wait_time")).cast("bigint").alias("wait_time"),
        F.when(v != 10, F.col("ts_utc")).alias("ts_utc"),
        "at_id",
        F.when(v == 5, F.concat(F.lit("\u00a0\t"), name, F.lit("\u2003 \n")))
        .when(v == 6, F.lit("0"))
        .when(v == 7, F.lit(" \u00a0 "))
        .when(v == 12, F.lit("\u2122 \u00ae"))
        .when(v == 13, F.concat(F.lit("Ride  "), unit))
        .when(v == 14, F.lit(None))
        .otherwise(name).alias("ride_name"),
        "tp_id",
        F.when(v == 8, F.lit("legacy"))
        .when(v == 9, F.lit("elsewhere"))
        .when(v == 15, F.lit(None))
        .otherwise(F.col("park_name")).alias("park_name"),
        F.when(v == 1, F.timestamp_add("HOUR", F.lit(1), F.col("_ingested_at")))
        .otherwise(F.col("_ingested_at")).alias("_ingested_at"),
    ).select(*BRONZE_COLUMNS)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver, written once: later steps read it as the weekly run reads its own table."""
    return materialize(si.build_silver(bronze(spark, sf_dir), SETTINGS), "silver")


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fe.chrono_split(silver(spark, sf_dir), SETTINGS)


def baseline_scored(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test rows scored by the baseline, flagged for the high-wait segment."""
    scored = baseline.score(test, baseline.fit(train))
    flagged = kp.flag_high(scored, fe.high_wait_entities(train, SETTINGS))
    return flagged.withColumn("model", F.lit(SETTINGS.baseline))


# ---- DuckDB -------------------------------------------------------------------------


def loc(x: str) -> str:
    return f"timezone('{ZONE}', timezone('UTC', {x}))"


def utc(x: str) -> str:
    """Local to UTC with the engine's rule for the two odd hours of the year."""
    u = f"timezone('UTC', timezone('{ZONE}', {x}))"
    earlier = f"({u} - INTERVAL 1 HOUR)"
    first_valid = f"timezone('UTC', timezone('{ZONE}', date_trunc('hour', {loc(u)})))"
    return (
        f"CASE WHEN {loc(earlier)} = {x} THEN {earlier} "
        f"WHEN {loc(u)} <> {x} THEN CAST({first_valid} AS TIMESTAMP) ELSE {u} END"
    )


# Whitespace and key characters as in slotcast.functions.text, spelled for this dialect.
WS = (
    r"\t\n\x{0B}\f\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[{WS}]+', ''), '[{WS}]+$', '')"


def key(x: str) -> str:
    kept = strip(rf"regexp_replace(coalesce({x}, ''), '[^\p{{L}}\p{{N}}_\-{WS}]', '', 'g')")
    return f"regexp_replace(replace({kept}, ' ', '_'), '_+', '_', 'g')"


def entity(park: str = "park_name", ride: str = "ride_key") -> str:
    return f"{key(park)} || '::' || {ride}"


def ts(value: datetime) -> str:
    return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"


BRONZE = f"""bronze AS (
  SELECT event_id AS wait_time_id, CAST(floor(value) AS BIGINT) AS wait_time, ts AS ts_utc,
         CAST(user_id % 10 AS BIGINT) AS at_id, 'Ride ' || (user_id % 10) AS ride_name,
         CAST(list_position({list(SITE_IDS)}, event_type) AS BIGINT) AS tp_id,
         event_type AS park_name, {ts(INGESTED)} AS _ingested_at
  FROM events)"""

DIRTY = """dirty AS (
  SELECT CASE WHEN v = 11 THEN NULL
              ELSE wait_time_id * 100 + CASE WHEN v = 1 THEN 0 ELSE v END END AS wait_time_id,
         CASE WHEN v = 1 THEN wait_time + 1 WHEN v = 2 THEN wait_time + 900
              WHEN v = 3 THEN -1 - wait_time WHEN v = 4 THEN NULL
              WHEN v = 13 THEN wait_time + 5 ELSE wait_time END AS wait_time,
         CASE WHEN v <> 10 THEN ts_utc END AS ts_utc, at_id,
         CASE WHEN v = 5 THEN chr(160) || chr(9) || ride_name || chr(8195) || ' ' || chr(10)
              WHEN v = 6 THEN '0' WHEN v = 7 THEN ' ' || chr(160) || ' '
              WHEN v = 12 THEN chr(8482) || ' ' || chr(174)
              WHEN v = 13 THEN 'Ride  ' || at_id WHEN v = 14 THEN NULL
              ELSE ride_name END AS ride_name,
         tp_id,
         CASE WHEN v = 8 THEN 'legacy' WHEN v = 9 THEN 'elsewhere' WHEN v = 15 THEN NULL
              ELSE park_name END AS park_name,
         CASE WHEN v = 1 THEN _ingested_at + INTERVAL 1 HOUR ELSE _ingested_at END AS _ingested_at
  FROM bronze, range(16) r(v))"""

SITES = "sites(park_name, open_hour, close_hour, first_date) AS (VALUES " + ", ".join(
    f"('{s.name}', {s.open_hour}, {s.close_hour}, DATE '{s.first_date}')" for s in SETTINGS.sites
) + ")"


def silver_ctes(source: str = "bronze") -> list[str]:
    """Silver step by step, each step a CTE."""
    base = [BRONZE, SITES] + ([DIRTY] if source == "dirty" else [])
    return base + [
        f"""first_rows AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY wait_time_id
    ORDER BY _ingested_at NULLS FIRST, wait_time NULLS FIRST, ts_utc NULLS FIRST,
             ride_name NULLS FIRST, park_name NULLS FIRST, at_id NULLS FIRST, tp_id) AS rn
    FROM {source}) WHERE rn = 1)""",
        "valid AS (SELECT * FROM first_rows WHERE wait_time >= 0 AND wait_time < 900)",
        f"""named AS (SELECT * REPLACE ({strip('ride_name')} AS ride_name) FROM valid
  WHERE {strip('ride_name')} NOT IN ('0', ''))""",
        """at_site AS (SELECT * FROM named
  WHERE park_name IN (SELECT park_name FROM sites) AND park_name <> 'legacy')""",
        f"""local AS (SELECT *, {loc('ts_utc')} AS ts_local FROM at_site
  WHERE ts_utc IS NOT NULL)""",
        """open AS (SELECT l.* FROM local l, sites s WHERE l.park_name = s.park_name
  AND hour(l.ts_local) >= s.open_hour AND hour(l.ts_local) < s.close_hour
  AND CAST(l.ts_local AS DATE) >= s.first_date)""",
        f"""keyed AS (SELECT *, {key('ride_name')} AS ride_key FROM open
  WHERE {key('ride_name')} <> '')""",
        """slots AS (SELECT park_name, ride_key, ride_name,
    time_bucket(INTERVAL 30 MINUTE, ts_local) AS ts_local, avg(wait_time) AS wait_time
  FROM keyed GROUP BY ALL)""",
        """grid AS (SELECT park_name, ride_key, ts_local, min(ride_name) AS ride_name,
    avg(wait_time) AS wait_time FROM slots GROUP BY ALL)""",
        f"""silver AS (SELECT park_name, ride_key, ride_name, ts_local,
    {utc('ts_local')} AS ts_utc, wait_time FROM grid
  WHERE (park_name, ride_key) IN (SELECT (park_name, ride_key) FROM grid
    GROUP BY park_name, ride_key HAVING count(*) >= {SETTINGS.min_obs}))""",
    ]


SILVER = silver_ctes()

SPLIT = SILVER + [
    "cut AS (SELECT quantile_cont(ts_local, 0.8) AS cutoff FROM silver)",
    f"""train AS (SELECT *, {entity()} AS entity FROM silver
  WHERE ts_local <= (SELECT cutoff FROM cut))""",
    f"""test AS (SELECT *, {entity()} AS entity FROM silver
  WHERE ts_local > (SELECT cutoff FROM cut))""",
]

BASELINE = SPLIT + [
    "means AS (SELECT entity, avg(wait_time) AS mean_wait FROM train GROUP BY entity)",
    """scored AS (SELECT t.*, m.mean_wait AS yhat, m.mean_wait AS lo, m.mean_wait AS hi,
    coalesce(m.mean_wait > 10, false) AS is_high, 'baseline_ride_mean' AS model
  FROM test t LEFT JOIN means m USING (entity))""",
]


def kpi_select(source: str, by: str = "model") -> str:
    return f"""SELECT {by}, avg(abs(yhat - wait_time)) AS mae,
    sqrt(avg((yhat - wait_time) * (yhat - wait_time))) AS rmse,
    avg(CASE WHEN abs(yhat - wait_time) > 15 THEN 1.0
             WHEN abs(yhat - wait_time) <= 15 THEN 0.0 END) * 100 AS pct_severe_miss,
    avg(CASE WHEN abs(yhat - wait_time) <= 10 THEN 1.0
             WHEN abs(yhat - wait_time) > 10 THEN 0.0 END) * 100 AS pct_within_10min,
    avg(yhat - wait_time) AS bias,
    avg(CASE WHEN is_high THEN abs(yhat - wait_time) END) AS high_wait_mae,
    avg(CASE WHEN hour(ts_local) >= 11 AND hour(ts_local) < 20
             THEN abs(yhat - wait_time) END) AS peak_hours_mae,
    count(yhat) / count(*) * 100 AS coverage_pct,
    CAST(count(yhat) AS DOUBLE) AS test_rows
  FROM {source} GROUP BY {by}"""

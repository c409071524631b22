"""Silver, step by step on the defective observations, and whole."""

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.registry import query, rounded, table, with_ctes
from slotcast.operators import silver as si

S = fx.SETTINGS
DIRTY = fx.silver_ctes("dirty")
# Integers that can be null are compared as doubles, which both engines show alike.
COLUMNS = """CAST(wait_time_id AS DOUBLE) AS wait_time_id, CAST(wait_time AS DOUBLE) AS wait_time,
    ts_utc, ride_name, park_name"""
NEEDED = ["wait_time_id", "_ingested_at", "wait_time", "ts_utc", "ride_name", "park_name"]


def _upto(step: str) -> list[str]:
    names = [c.split(" AS ")[0].split("(")[0].strip() for c in DIRTY]
    return DIRTY[: names.index(step) + 1]


def _first(spark, sf):
    return si.first_per_id(fx.dirty_bronze(spark, sf).select(*NEEDED))


def _doubles(df, *columns):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query("silver_dedup_by_id", with_ctes(
    _upto("first_rows"), f"SELECT {COLUMNS}, _ingested_at FROM first_rows"))
def dedup(spark, sf):
    rows = _first(spark, sf).withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp_ntz"))
    return _doubles(rows, "wait_time_id", "wait_time")


@query("silver_wait_range", with_ctes(_upto("valid"), f"SELECT {COLUMNS} FROM valid"))
def wait_range(spark, sf):
    rows = si.valid_waits(_first(spark, sf), S).drop("_ingested_at")
    return _doubles(rows, "wait_time_id", "wait_time")


@query("silver_clean_names", with_ctes(_upto("named"), f"SELECT {COLUMNS} FROM named"))
def clean_names(spark, sf):
    rows = si.clean_names(si.valid_waits(_first(spark, sf), S), S).drop("_ingested_at")
    return _doubles(rows, "wait_time_id", "wait_time")


@query("silver_known_sites", with_ctes(
    [fx.BRONZE, fx.SITES, fx.DIRTY],
    """SELECT CAST(wait_time_id AS DOUBLE) AS wait_time_id, park_name, ride_name FROM dirty
    WHERE park_name IN (SELECT park_name FROM sites) AND park_name <> 'legacy'"""))
def known_sites(spark, sf):
    rows = fx.dirty_bronze(spark, sf).select("wait_time_id", "park_name", "ride_name")
    return _doubles(si.known_sites(rows, S), "wait_time_id")


@query("silver_local_time", with_ctes(
    [fx.BRONZE, fx.DIRTY],
    f"""SELECT CAST(wait_time_id AS DOUBLE) AS wait_time_id, ts_utc, {fx.loc('ts_utc')} AS ts_local FROM dirty
    WHERE ts_utc IS NOT NULL"""))
def local_time(spark, sf):
    rows = si.localize(fx.dirty_bronze(spark, sf).select("wait_time_id", "ts_utc"), S)
    return _doubles(rows, "wait_time_id")


@query("silver_open_hours", with_ctes(
    _upto("open"), f"SELECT {COLUMNS}, ts_local FROM open"))
def open_hours(spark, sf):
    rows = si.known_sites(si.clean_names(si.valid_waits(_first(spark, sf), S), S), S)
    rows = si.open_hours(si.localize(rows, S), S).drop("_ingested_at")
    return _doubles(rows, "wait_time_id", "wait_time")


@query("silver_unit_key", with_ctes(
    _upto("keyed"), """SELECT CAST(wait_time_id AS DOUBLE) AS wait_time_id, park_name, ride_name,
    ride_key FROM keyed"""))
def unit_key(spark, sf):
    rows = si.keyed(si.clean(fx.dirty_bronze(spark, sf), S))
    return _doubles(rows, "wait_time_id").select("wait_time_id", "park_name", "ride_name", "ride_key")


@query("silver_slot_means", with_ctes(
    _upto("slots"),
    """SELECT park_name, ride_key, ride_name, ts_local, round(wait_time, 6) AS wait_time
    FROM slots"""))
def slot_means(spark, sf):
    return rounded(si.slot_means(si.clean(fx.dirty_bronze(spark, sf), S), S), "wait_time")


@query("silver_collapse_spellings", with_ctes(
    _upto("grid"),
    """SELECT park_name, ride_key, ts_local, ride_name, round(wait_time, 6) AS wait_time
    FROM grid"""))
def collapse(spark, sf):
    return rounded(si.slot_grid(fx.dirty_bronze(spark, sf), S), "wait_time")


@query("silver_min_history", with_ctes(
    fx.SILVER[:-1],
    """SELECT park_name, ride_key, ts_local, ride_name, round(wait_time, 6) AS wait_time FROM grid
    WHERE (park_name, ride_key) IN (SELECT (park_name, ride_key) FROM grid
      GROUP BY park_name, ride_key HAVING count(*) >= 100)"""))
def min_history(spark, sf):
    from dataclasses import replace

    grid = si.slot_grid(fx.bronze(spark, sf), S)
    return rounded(si.long_histories(grid, replace(S, min_obs=100)), "wait_time")


SILVER_SELECT = """SELECT park_name, ride_key, ride_name, ts_local, ts_utc,
    round(wait_time, 6) AS wait_time FROM silver"""


@query("silver_build", with_ctes(fx.SILVER, SILVER_SELECT))
def build(spark, sf):
    return rounded(si.build_silver(fx.bronze(spark, sf), S), "wait_time")


@query("silver_build_dirty", with_ctes(DIRTY, SILVER_SELECT))
def build_dirty(spark, sf):
    return rounded(si.build_silver(fx.dirty_bronze(spark, sf), S), "wait_time")


@query("silver_profile", with_ctes(
    fx.SILVER,
    """SELECT (SELECT count(*) FROM bronze) AS raw_rows, CAST(count(*) AS BIGINT) AS grid_rows,
    count(DISTINCT (park_name, ride_key)) AS entities, count(DISTINCT park_name) AS sites,
    round(avg(wait_time), 6) AS mean_wait,
    round(avg(CASE WHEN wait_time = 0 THEN 100.0 ELSE 0.0 END), 6) AS zero_pct,
    min(ts_local) AS first_local, max(ts_local) AS last_local FROM silver"""))
def profile(spark, sf):
    rows = si.silver_profile(fx.silver(spark, sf), table(spark, sf, "events"))
    return rounded(rows, "mean_wait", "zero_pct")


@query("silver_empty_guard", with_ctes(
    _upto("keyed"),
    "SELECT count(*) AS rows, count(*) > 0 AS passed FROM keyed"))
def empty_guard(spark, sf):
    rows = si.clean(fx.dirty_bronze(spark, sf), S)
    n = rows.agg(F.count(F.lit(1)).alias("rows"))
    return n.withColumn("passed", F.col("rows") > 0)

"""Gold: the forecast grid with the baseline as the model, backtests, provenance."""

from datetime import datetime

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.kpis import FOUR, LONG, TRAINED_AT, four_models, kpi_table
from queries.registry import query, rounded, with_ctes
from slotcast.config import STATUS_FALLBACK, STATUS_FRESH
from slotcast.operators import features as fe
from slotcast.operators import gold as go
from slotcast.operators import silver as si
from slotcast.operators.models import baseline
from slotcast.schemas import PREDICTION_CORE
from slotcast.session import materialize

S = fx.SETTINGS
RUN_ID = "20240131T000000Z"
GENERATED = datetime(2024, 1, 31)
VALUES = ["predicted_wait_min", "lower_bound", "upper_bound", "actual_wait_min", "error_min"]

ENTITIES = f"""entities AS (
  SELECT entity, arg_max(park_name, (ts_local, park_name, ride_key)) AS park_name,
         arg_max(ride_key, (ts_local, park_name, ride_key)) AS ride_key,
         arg_max(ride_name, (ts_local, park_name, ride_key)) AS ride_name
  FROM (SELECT *, {fx.entity()} AS entity FROM silver) GROUP BY entity)"""
SLOTS = f"""all_slots AS (
  SELECT s AS ts_local FROM generate_series(
    time_bucket(INTERVAL 30 MINUTE, {fx.ts(fx.NOW_LOCAL)} + INTERVAL 30 MINUTE),
    {fx.ts(fx.NOW_LOCAL)} + INTERVAL 7 DAY, INTERVAL 30 MINUTE) g(s))"""
GRID = """fgrid AS (
  SELECT e.*, s.ts_local FROM entities e JOIN sites USING (park_name), all_slots s
  WHERE hour(s.ts_local) >= open_hour AND hour(s.ts_local) < close_hour)"""
CORE = ", ".join(PREDICTION_CORE)
# The baseline's interval is a point; widen it unevenly so that every repair rule acts.
FORECAST = f"""forecast AS (
  SELECT 'forecast' AS row_kind, park_name, ride_key, ride_name, ts_local,
    {fx.utc('ts_local')} AS ts_utc, greatest(0.0, y) AS predicted_wait_min,
    least(greatest(0.0, y - 20), greatest(0.0, y)) AS lower_bound,
    greatest(y - 1, greatest(0.0, y)) AS upper_bound,
    CAST(NULL AS DOUBLE) AS actual_wait_min, CAST(NULL AS DOUBLE) AS error_min,
    'prophet_fleet' AS model_name
  FROM (SELECT g.*, m.mean_wait - hour(ts_local) * 3 AS y FROM fgrid g LEFT JOIN means m
        USING (entity)) WHERE y IS NOT NULL)"""
BACKTEST = f"""backtest AS (
  SELECT 'backtest' AS row_kind, park_name, ride_key, ride_name, ts_local, ts_utc,
    greatest(0.0, yhat) AS predicted_wait_min,
    least(greatest(0.0, lo), greatest(0.0, yhat)) AS lower_bound,
    greatest(hi, greatest(0.0, yhat)) AS upper_bound, wait_time AS actual_wait_min,
    greatest(0.0, yhat) - wait_time AS error_min, model AS model_name
  FROM four WHERE yhat IS NOT NULL)"""
STAMP = f"""'{RUN_ID}' AS run_id, 'fresh_model' AS run_status,
    {fx.ts(GENERATED)} AS generated_at, '{TRAINED_AT}' AS model_trained_at"""
PAIR = LONG + [ENTITIES, SLOTS, GRID, FORECAST, BACKTEST, f"""predictions AS (
  SELECT {CORE}, {STAMP} FROM (SELECT * FROM forecast UNION ALL BY NAME SELECT * FROM backtest))""",
    f"kpi_pair AS (SELECT *, {STAMP} FROM kpi_table)"]
GOLD_GRID = fx.BASELINE + [ENTITIES, SLOTS, GRID]


def with_rounded(columns):
    return ", ".join(f"round({c}, 6) AS {c}" if c in VALUES else c for c in columns)


def forecast(silver, train):
    """Forecast rows of a model that falls with the hour, so that some turn negative."""
    entities = go.active_entities(silver)
    grid = go.forecast_grid(entities, fx.now_local(), S)
    scored = baseline.score(grid, baseline.fit(train))
    y = F.col("yhat") - F.hour("ts_local") * 3
    scored = scored.withColumns({"yhat": y, "lo": y - 20, "hi": y - 1})
    return go.forecast_rows(scored, "prophet_fleet", S)


def pair(spark, sf):
    """The serving pair: KPI table and predictions, stamped and written."""
    silver = fx.silver(spark, sf)
    train, _ = fe.chrono_split(silver, S)
    scored = four_models(spark, sf, silver)
    rows = go.gold_union(forecast(silver, train), go.backtest_rows(scored))
    stamps = (RUN_ID, STATUS_FRESH, GENERATED, TRAINED_AT)
    kpis = materialize(go.stamp(kpi_table(spark, sf, scored), *stamps), "kpis")
    return kpis, materialize(go.stamp(rows, *stamps), "predictions")


@query("gold_slots_per_site", "SELECT * FROM (VALUES " + ", ".join(
    f"('{s.name}', CAST({(s.close_hour - s.open_hour) * 14} AS BIGINT))" for s in S.sites
) + ") t(park_name, slots) WHERE park_name IN (SELECT event_type FROM events)")
def slots_per_site(spark, sf):
    seen = fx.bronze(spark, sf).select("park_name").distinct()
    return go.slots_per_site(si.site_table(spark, S), S).join(seen, "park_name", "left_semi")


@query("gold_active_entities", with_ctes(fx.SILVER + [ENTITIES], "SELECT * FROM entities"))
def active_entities(spark, sf):
    return go.active_entities(fx.silver(spark, sf))


@query("gold_model_coverage", with_ctes(fx.BASELINE + [ENTITIES], """
    SELECT count(m.entity) AS covered, count(*) - count(m.entity) AS dropped
    FROM entities e LEFT JOIN (SELECT entity FROM train GROUP BY entity HAVING count(*) >= 75) m
    USING (entity)"""))
def model_coverage(spark, sf):
    silver = fx.silver(spark, sf)
    train, _ = fe.chrono_split(silver, S)
    known = baseline.fit(train).where(F.col("train_rows") >= 75)
    return go.coverage_profile(go.active_entities(silver), known)


@query("gold_covered_entities", with_ctes(fx.BASELINE + [ENTITIES], """
    SELECT * FROM entities
    WHERE entity IN (SELECT entity FROM train GROUP BY entity HAVING count(*) >= 75)"""))
def covered(spark, sf):
    silver = fx.silver(spark, sf)
    train, _ = fe.chrono_split(silver, S)
    known = baseline.fit(train).where(F.col("train_rows") >= 75)
    return go.covered_entities(go.active_entities(silver), known)


@query("gold_slot_sequence", f"""SELECT event_id, count(*) AS slots,
    min(s) AS first_slot, max(s) AS last_slot FROM (SELECT event_id, unnest(generate_series(
    time_bucket(INTERVAL 30 MINUTE, ts + INTERVAL 30 MINUTE), ts + INTERVAL 7 DAY,
    INTERVAL 30 MINUTE)) AS s FROM events) GROUP BY event_id""")
def slot_sequence(spark, sf):
    """The grid as it would start at the time of every event."""
    events = fx.bronze(spark, sf).select(F.col("wait_time_id").alias("event_id"), "ts_utc")
    slots = go.slot_sequence(F.col("ts_utc"), S)
    return events.select(
        "event_id",
        F.size(slots).cast("bigint").alias("slots"),
        F.array_min(slots).alias("first_slot"),
        F.array_max(slots).alias("last_slot"),
    )


@query("gold_forecast_grid", with_ctes(GOLD_GRID, "SELECT * FROM fgrid"))
def grid(spark, sf):
    return go.forecast_grid(go.active_entities(fx.silver(spark, sf)), fx.now_local(), S)


@query("gold_forecast_scored", with_ctes(GOLD_GRID, """SELECT entity, ts_local,
    round(mean_wait, 6) AS yhat FROM fgrid JOIN means USING (entity)"""))
def scored(spark, sf):
    silver = fx.silver(spark, sf)
    train, _ = fe.chrono_split(silver, S)
    rows = go.forecast_grid(go.active_entities(silver), fx.now_local(), S)
    answered = baseline.score(rows, baseline.fit(train)).where(F.col("yhat").isNotNull())
    return rounded(answered, "yhat").select("entity", "ts_local", "yhat")


@query("gold_bound_repair", """SELECT event_id, greatest(0.0, p) AS predicted_wait_min,
    CASE WHEN lo IS NOT NULL THEN least(greatest(0.0, lo), greatest(0.0, p)) END AS lower_bound,
    CASE WHEN hi IS NOT NULL THEN greatest(hi, greatest(0.0, p)) END AS upper_bound
    FROM (SELECT event_id, value - 30 AS p, CASE WHEN event_id % 7 > 0 THEN 60 - value END AS lo,
        CASE WHEN event_id % 5 > 0 THEN value * 0.5 END AS hi FROM events)""")
def bound_repair(spark, sf):
    from queries.registry import table

    v = F.col("value")
    lo, hi = (F.when(F.col("event_id") % k > 0, x) for k, x in ((7, 60 - v), (5, v * 0.5)))
    bounds = go.repaired_bounds(v - 30, lo, hi)
    rows = table(spark, sf, "events")
    return rows.select("event_id", *(c.alias(name) for name, c in bounds.items()))


@query("gold_forecast_rows", with_ctes(
    GOLD_GRID + [FORECAST], f"SELECT {with_rounded(PREDICTION_CORE)} FROM forecast"))
def forecast_rows(spark, sf):
    silver = fx.silver(spark, sf)
    train, _ = fe.chrono_split(silver, S)
    return rounded(forecast(silver, train), *VALUES)


@query("gold_backtest_rows", with_ctes(
    FOUR + [BACKTEST], f"SELECT {with_rounded(PREDICTION_CORE)} FROM backtest"))
def backtest_rows(spark, sf):
    return rounded(go.backtest_rows(four_models(spark, sf)), *VALUES)


@query("gold_stamped_union", with_ctes(
    PAIR, f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in VALUES)}) FROM predictions"))
def stamped_union(spark, sf):
    return rounded(pair(spark, sf)[1], *VALUES)


@query("gold_kpi_stamped", with_ctes(
    PAIR, "SELECT * REPLACE (round(kpi_value, 6) AS kpi_value) FROM kpi_pair"))
def kpi_stamped(spark, sf):
    return rounded(pair(spark, sf)[0], "kpi_value")


@query("gold_carry_forward_kpis", with_ctes(LONG, """SELECT model, kpi_name,
    round(kpi_value, 6) AS kpi_value, is_serving, trained_at FROM kpi_table"""))
def carry_kpis(spark, sf):
    kpis, predictions = pair(spark, sf)
    return rounded(go.carry_forward(kpis, predictions)[0], "kpi_value")


@query("gold_carry_forward_backtest", with_ctes(
    FOUR + [BACKTEST], f"SELECT {with_rounded(PREDICTION_CORE)} FROM backtest"))
def carry_backtest(spark, sf):
    kpis, predictions = pair(spark, sf)
    return rounded(go.carry_forward(kpis, predictions)[1], *VALUES)


@query("gold_fallback_replace", with_ctes(PAIR, f"""
    SELECT {with_rounded(PREDICTION_CORE)}, 'r9' AS run_id,
    'fallback_after_failure' AS run_status, {fx.ts(fx.INGESTED)} AS generated_at, 't9' AS model_trained_at
    FROM (SELECT * FROM forecast UNION ALL BY NAME SELECT * FROM backtest)"""))
def fallback_replace(spark, sf):
    silver = fx.silver(spark, sf)
    train, _ = fe.chrono_split(silver, S)
    old = pair(spark, sf)[1]
    fresh = forecast(silver, train)
    new = go.replace_forecast(fresh, old, "r9", STATUS_FALLBACK, fx.INGESTED, "t9")
    return rounded(new, *VALUES)


@query("gold_row_counts", with_ctes(PAIR, """SELECT
    count(*) FILTER (row_kind = 'forecast') AS forecast_rows,
    count(*) FILTER (row_kind = 'backtest') AS backtest_rows FROM predictions"""))
def row_counts(spark, sf):
    return go.row_counts(pair(spark, sf)[1])

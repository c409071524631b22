"""Aggregates of the monitoring report."""

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.gold import PAIR, RUN_ID, pair
from queries.registry import query, rounded, with_ctes
from slotcast.operators import report as rp
from slotcast.plans.report_job import run_report
from slotcast.session import scratch_path
from slotcast.sources import serving as sv
from slotcast.sources.store import TableStore

S = fx.SETTINGS
TILE_ROWS = ", ".join(f"({i}, '{k}', '{label}', '{u}')" for i, (k, label, u) in enumerate(rp.TILES))
OWN = PAIR + ["""own AS (SELECT * FROM predictions WHERE row_kind = 'backtest'
  AND model_name = (SELECT min(model) FROM kpi_pair WHERE is_serving))"""]


def _own(spark, sf):
    kpis, predictions = pair(spark, sf)
    return rp.serving_backtest(predictions, kpis)


@query("report_kpi_tiles", with_ctes(PAIR, f"""SELECT position, t.kpi_name, label, unit,
    CASE WHEN kpi_value IS NULL OR NOT isfinite(kpi_value) THEN 'n/a'
         ELSE format('{{:,.1f}}', kpi_value) END AS value
    FROM (VALUES {TILE_ROWS}) t(position, kpi_name, label, unit)
    LEFT JOIN (SELECT * FROM kpi_pair WHERE is_serving) k ON k.kpi_name = t.kpi_name"""))
def tiles(spark, sf):
    return rp.kpi_tiles(pair(spark, sf)[0])


@query("report_model_comparison", with_ctes(PAIR, f"""SELECT
    CAST(list_position({list(S.model_order)}, model) AS BIGINT) AS position, model,
    bool_or(is_serving) AS serving, {', '.join(
        f"round(avg(kpi_value) FILTER (kpi_name = '{k}'), 6) AS {k}" for k, _, _ in rp.TILES)}
    FROM kpi_pair GROUP BY model"""))
def comparison(spark, sf):
    rows = rp.model_comparison(pair(spark, sf)[0], S)
    return rounded(rows, *(k for k, _, _ in rp.TILES))


SLICE = """SELECT model_name, park_name, ride_key, ts_local, round(error_min, 6) AS error_min"""


@query("report_serving_slice", with_ctes(OWN, f"{SLICE} FROM own"))
def serving_slice(spark, sf):
    return rounded(_own(spark, sf), "error_min").select(
        "model_name", "park_name", "ride_key", "ts_local", "error_min"
    )


@query("report_serving_slice_fallback", with_ctes(
    PAIR, f"{SLICE} FROM predictions WHERE row_kind = 'backtest'"))
def serving_slice_fallback(spark, sf):
    """No backtest row is of the serving model, so all of them are shown."""
    kpis, predictions = pair(spark, sf)
    renamed = kpis.withColumn("model", F.concat(F.col("model"), F.lit("_v2")))
    return rounded(rp.serving_backtest(predictions, renamed), "error_min").select(
        "model_name", "park_name", "ride_key", "ts_local", "error_min"
    )


MEANS = """round(avg(actual_wait_min), 2) AS actual,
    round(avg(predicted_wait_min), 2) AS predicted"""


@query("report_daily_means", with_ctes(OWN, f"""SELECT strftime(ts_local, '%Y-%m-%d') AS day,
    {MEANS}, strftime(min(ts_local), '%b %d') AS label FROM own GROUP BY 1"""))
def daily(spark, sf):
    rows = rp.daily_means(_own(spark, sf))
    return rows.withColumn("day", F.col("day").cast("string"))


@query("report_hourly_means", with_ctes(OWN, f"""SELECT CAST(hour(ts_local) AS INTEGER) AS hour,
    {MEANS}, lpad(CAST(hour(ts_local) AS VARCHAR), 2, '0') || ':00' AS label
    FROM own GROUP BY hour(ts_local)"""))
def hourly(spark, sf):
    return rp.hourly_means(_own(spark, sf))


HISTOGRAM = PAIR + [
    """counted AS (SELECT model_name AS model, CASE WHEN error_min < -40 THEN 0
      WHEN error_min >= 40 THEN 17 ELSE CAST(floor((error_min + 40) / 5) AS INTEGER) + 1 END AS bin,
      count(*) AS rows FROM predictions WHERE row_kind = 'backtest' GROUP BY ALL)""",
    """histogram AS (SELECT m.model, CAST(b AS INTEGER) AS bin,
      CASE WHEN b > 0 THEN -40.0 + (b - 1) * 5 END AS bin_low,
      CASE WHEN b <= 16 THEN -40.0 + b * 5 END AS bin_high, coalesce(rows, 0) AS rows,
      100.0 * coalesce(rows, 0) / sum(coalesce(rows, 0)) OVER (PARTITION BY m.model) AS share_pct,
      CASE WHEN -42.5 + b * 5 < -2.5 THEN 'under' WHEN -42.5 + b * 5 > 2.5 THEN 'over'
           ELSE 'zero' END AS side
      FROM (SELECT DISTINCT model FROM counted) m CROSS JOIN range(18) r(b)
      LEFT JOIN counted c ON c.model = m.model AND c.bin = b)""",
]


@query("report_error_histogram", with_ctes(HISTOGRAM, """SELECT model, bin,
    CAST(bin_low AS DOUBLE) AS bin_low, CAST(bin_high AS DOUBLE) AS bin_high, rows,
    round(share_pct, 6) AS share_pct, side FROM histogram"""))
def histogram(spark, sf):
    return rounded(rp.error_histogram(pair(spark, sf)[1], S), "share_pct")


@query("report_shared_scale", with_ctes(HISTOGRAM, "SELECT max(rows) AS max_rows FROM histogram"))
def shared_scale(spark, sf):
    return rp.shared_scale(rp.error_histogram(pair(spark, sf)[1], S))


@query("report_hardest_units", with_ctes(OWN, """SELECT park_name, ride_key, ride_name AS label,
    round(mae, 6) AS mae, slots, ride_name || ' (' || park_name || '): MAE '
    || format('{:,.1f}', mae) || ' min over ' || format('{:,.0f}', CAST(slots AS DOUBLE))
    || ' test slots' AS tooltip
    FROM (SELECT park_name, ride_key, avg(abs(error_min)) AS mae, count(*) AS slots,
          arg_min(ride_name, ts_local) AS ride_name FROM own GROUP BY ALL)
    ORDER BY mae DESC, park_name, ride_key LIMIT 15"""))
def hardest(spark, sf):
    return rounded(rp.hardest_units(_own(spark, sf)), "mae")


@query("report_provenance", with_ctes(PAIR, """SELECT (SELECT min(run_id) FROM kpi_pair) AS run_id,
    'Fresh model' AS status_label, 'good' AS status_class,
    strftime(min(ts_local) FILTER (row_kind = 'forecast'), '%b %d') || ' to '
    || strftime(max(ts_local) FILTER (row_kind = 'forecast'), '%b %d, %Y') AS "window",
    (SELECT min(model) FROM kpi_pair WHERE is_serving) AS model,
    replace(left(min(model_trained_at), 19), 'T', ' ') AS trained,
    strftime(min(generated_at), '%Y-%m-%d %H:%M') AS published FROM predictions"""))
def provenance(spark, sf):
    return rp.provenance_strip(*pair(spark, sf))


@query("report_job", with_ctes(OWN, f"""SELECT 'provenance' AS section, count(DISTINCT run_id) AS rows
    FROM kpi_pair
    UNION ALL SELECT 'tiles', {len(rp.TILES)} FROM kpi_pair WHERE is_serving HAVING count(*) > 0
    UNION ALL SELECT 'comparison', count(DISTINCT model) FROM kpi_pair
    UNION ALL SELECT 'daily', count(DISTINCT CAST(ts_local AS DATE)) FROM own
    UNION ALL SELECT 'hourly', count(DISTINCT hour(ts_local)) FROM own
    UNION ALL SELECT 'histogram', 18 * count(DISTINCT model_name) FROM predictions
      WHERE row_kind = 'backtest' AND error_min IS NOT NULL
    UNION ALL SELECT 'scale', 1
    UNION ALL SELECT 'hardest', least(15, count(DISTINCT (park_name, ride_key))) FROM own"""))
def job(spark, sf):
    """The job on a published pair: rows of each table that it wrote."""
    store = TableStore(spark, scratch_path(spark, "store"))
    sv.publish_pair(store, *pair(spark, sf), RUN_ID)
    return run_report(store, S, fx.now_local(), scratch_path(spark, "report"))

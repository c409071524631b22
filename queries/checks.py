"""Quality checks and the guards of the serving pair, passing and failing ones."""

from datetime import datetime

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.gold import PAIR, pair
from queries.kpis import MODEL_ADDITIVE
from queries.registry import query, rounded, with_ctes
from slotcast.functions import clock
from slotcast.operators import checks as ck

S = fx.SETTINGS


def _plain(rows):
    return rounded(rows, "observed", "threshold").select(
        "check_id", "table_name", "observed", "threshold", "passed"
    )


def _epoch(x):
    return f"epoch_us({x}) / 1e6"


def _check(check_id, table, observed, threshold, passed, source):
    return f"""SELECT '{check_id}' AS check_id, '{table}' AS table_name,
    round(CAST({observed} AS DOUBLE), 6) AS observed,
    round(CAST({threshold} AS DOUBLE), 6) AS threshold, coalesce({passed}, false) AS passed
    FROM {source}"""


def _silver_sql(last_rows):
    hour = """(SELECT h FROM (SELECT hour(ts_local) AS h, avg(wait_time) AS m FROM silver
      GROUP BY 1) ORDER BY m DESC, h LIMIT 1)"""
    zero = "100.0 * count(*) FILTER (wait_time = 0) / count(*)"
    units = "count(DISTINCT (park_name, ride_key))"
    parts = [
        _check("CHK-01", "silver", "count(*)", f"({last_rows}) * 0.5",
               f"count(*) >= ({last_rows}) * 0.5", "silver"),
        _check("CHK-02", "silver", units, "50", f"{units} >= 50", "silver"),
        _check("CHK-03", "silver", zero, "75", f"{zero} <= 75", "silver"),
        *(
            _check(f"CHK-04:{c}", "silver", f"count(*) FILTER ({c} IS NULL)", "0",
                   f"count(*) FILTER ({c} IS NULL) = 0", "silver")
            for c in ("ride_key", "ts_local", "wait_time")
        ),
        _check("CHK-05:min", "silver", _epoch("min(ts_local)"),
               _epoch(fx.ts(S.collection_start)),
               f"min(ts_local) >= {fx.ts(S.collection_start)}", "silver"),
        _check("CHK-05:max", "silver", _epoch("max(ts_local)"),
               _epoch(f"{fx.ts(fx.NOW_LOCAL)} + INTERVAL 1 DAY"),
               f"max(ts_local) <= {fx.ts(fx.NOW_LOCAL)} + INTERVAL 1 DAY", "silver"),
        _check("CHK-06", "silver", hour, "20", f"{hour} BETWEEN 11 AND 20", "(SELECT 1)"),
    ]
    return " UNION ALL ".join(parts)


@query("check_silver", with_ctes(fx.SILVER, _silver_sql("SELECT count(*) FROM bronze")))
def silver(spark, sf):
    rows = fx.silver(spark, sf)
    last = fx.bronze(spark, sf).agg(F.count(F.lit(1))).scalar()
    return _plain(ck.silver_checks(rows, S, fx.now_local(), last))


@query("check_peak_hour", with_ctes(fx.SILVER, """SELECT h AS peak_hour FROM
    (SELECT CAST(hour(ts_local) AS INTEGER) AS h, avg(wait_time) AS m FROM silver GROUP BY 1)
    ORDER BY m DESC, h LIMIT 1"""))
def peak_hour(spark, sf):
    return ck.peak_hour(fx.silver(spark, sf))


def _kpi_sql(source):
    mae = "(SELECT kpi_value FROM {s} WHERE kpi_name = 'mae' AND model = '{m}')"
    parts = []
    for m in S.candidates:
        n = f"count(*) FILTER (model = '{m}')"
        parts.append(_check(f"CHK-07:{m}", "kpis", n, "1", f"{n} > 0", source))
    for m in S.model_order:
        v = mae.format(s=source, m=m)
        seen = f"(SELECT count(*) FROM {source} WHERE model = '{m}')"
        parts.append(_check(f"CHK-08:{m}", "kpis", v, "0",
                            f"{seen} = 0 OR (isfinite({v}) AND {v} > 0)", "(SELECT 1)"))
    n = "count(DISTINCT model) FILTER (is_serving)"
    parts.append(_check("CHK-09", "kpis", n, "1", f"{n} = 1", source))
    own = f"(SELECT max(kpi_value) FROM {source} WHERE kpi_name = 'mae' AND is_serving)"
    base = mae.format(s=source, m=S.baseline)
    parts.append(_check("CHK-10", "kpis", own, base, f"""
      (SELECT count(DISTINCT model) FROM {source} WHERE is_serving) <> 1 OR {own} IS NULL
      OR {base} IS NULL OR {own} < {base}""", "(SELECT 1)"))
    return " UNION ALL ".join(parts)


@query("check_kpis", with_ctes(PAIR, _kpi_sql("kpi_pair")))
def kpis(spark, sf):
    return _plain(ck.kpi_checks(pair(spark, sf)[0], S))


# A spoiled table: one candidate gone, one MAE not positive, the baseline serves as well.
SPOILED_KPIS = """spoiled AS (SELECT * REPLACE (
    CASE WHEN model = 'xgb_global' AND kpi_name = 'mae' THEN 0 ELSE kpi_value END AS kpi_value,
    is_serving OR model = 'baseline_ride_mean' AS is_serving)
  FROM kpi_pair WHERE model <> 'xgb_local_fleet')"""


@query("check_kpis_spoiled", with_ctes(PAIR + [SPOILED_KPIS], _kpi_sql("spoiled")))
def kpis_spoiled(spark, sf):
    rows = pair(spark, sf)[0].where(F.col("model") != "xgb_local_fleet")
    bad = (F.col("model") == "xgb_global") & (F.col("kpi_name") == "mae")
    rows = rows.withColumns(
        {
            "kpi_value": F.when(bad, F.lit(0.0)).otherwise(F.col("kpi_value")),
            "is_serving": F.col("is_serving") | (F.col("model") == S.baseline),
        }
    )
    return _plain(ck.kpi_checks(rows, S))


def _prediction_sql(source):
    fc = f"(SELECT * FROM {source} WHERE row_kind = 'forecast')"
    bt = f"(SELECT * FROM {source} WHERE row_kind = 'backtest')"
    active = "(SELECT count(DISTINCT (park_name, ride_key)) FROM silver)"
    units = "count(DISTINCT (park_name, ride_key))"
    expected = f"""(SELECT sum((close_hour - open_hour) * 14) FROM
      (SELECT DISTINCT park_name, ride_key FROM {fc}) JOIN sites USING (park_name))"""
    negative = "count(*) FILTER (predicted_wait_min < 0 OR lower_bound < 0)"
    disorder = """count(*) FILTER (lower_bound > predicted_wait_min
      OR predicted_wait_min > upper_bound)"""
    sign = "count(*) FILTER (predicted_wait_min < 0)"
    parts = [
        _check("CHK-11", "predictions", "count(*)", "1", "count(*) > 0", fc),
        _check("CHK-12", "forecast", units, f"{active} * 0.95", f"{units} >= {active} * 0.95", fc),
        *(
            _check(f"CHK-13:{c}", "forecast", f"count(*) FILTER ({c} IS NULL)", "0",
                   f"count(*) FILTER ({c} IS NULL) = 0", fc)
            for c in ck.FORECAST_NOT_NULL
        ),
        _check("CHK-14", "forecast", negative, "0", f"{negative} = 0", fc),
        _check("CHK-15", "forecast", disorder, "0", f"{disorder} = 0", fc),
        _check("CHK-16", "forecast", "count(*)", expected,
               f"count(*) BETWEEN 0.75 * {expected} AND 1.05 * {expected}", fc),
        *(
            _check(f"CHK-17:{c}", "backtest", f"count(*) FILTER ({c} IS NULL)", "0",
                   f"count(*) FILTER ({c} IS NULL) = 0", bt)
            for c in ck.BACKTEST_NOT_NULL
        ),
        _check("CHK-17:sign", "backtest", sign, "0", f"{sign} = 0", bt),
    ]
    return " UNION ALL ".join(parts)


def _active(spark, sf):
    rows = fx.silver(spark, sf)
    return rows.agg(F.count_distinct("park_name", "ride_key")).scalar()


@query("check_predictions", with_ctes(PAIR, _prediction_sql("predictions")))
def predictions(spark, sf):
    return _plain(ck.prediction_checks(pair(spark, sf)[1], S, _active(spark, sf)))


SPOILED = """spoiled AS (SELECT * REPLACE (
    CASE WHEN hour(ts_local) = 12 THEN -1 ELSE predicted_wait_min END AS predicted_wait_min,
    CASE WHEN hour(ts_local) <> 13 THEN upper_bound END AS upper_bound,
    CASE WHEN hour(ts_local) <> 14 THEN error_min END AS error_min)
  FROM predictions WHERE park_name <> 'signup' AND hour(ts_local) < 18)"""


@query("check_predictions_spoiled", with_ctes(PAIR + [SPOILED], _prediction_sql("spoiled")))
def predictions_spoiled(spark, sf):
    """A site missing, evenings missing, negative values, bounds out of order, nulls."""
    hour = F.hour("ts_local")
    rows = pair(spark, sf)[1].where((F.col("park_name") != "signup") & (hour < 18))
    rows = rows.withColumns(
        {
            "predicted_wait_min": F.when(hour == 12, -1.0).otherwise(F.col("predicted_wait_min")),
            "upper_bound": F.when(hour != 13, F.col("upper_bound")),
            "error_min": F.when(hour != 14, F.col("error_min")),
        }
    )
    return _plain(ck.prediction_checks(rows, S, _active(spark, sf)))


@query("check_predictions_no_forecast", with_ctes(PAIR, """SELECT 'CHK-11' AS check_id,
    'predictions' AS table_name, 0.0 AS observed, 1.0 AS threshold, count(*) < 0 AS passed
    FROM predictions"""))
def predictions_no_forecast(spark, sf):
    rows = pair(spark, sf)[1].where(F.col("row_kind") == "backtest")
    return _plain(ck.prediction_checks(rows, S, 50))


def _pair_sql(now):
    end = "max(ts_local) FILTER (row_kind = 'forecast')"
    return " UNION ALL ".join([
        _check("PUB-01:kpis", "kpis", "count(*)", "1", "count(*) > 0", "kpi_pair"),
        _check("PUB-01:predictions", "predictions", "count(*)", "1", "count(*) > 0", "predictions"),
        _check("PUB-01:forecast", "predictions", "count(*) FILTER (row_kind = 'forecast')", "1",
               "count(*) FILTER (row_kind = 'forecast') > 0", "predictions"),
        _check("PUB-02", "pair", "count(DISTINCT run_id)", "1", """count(DISTINCT run_id) = 1
          AND NOT EXISTS (SELECT run_id FROM predictions EXCEPT SELECT run_id FROM kpi_pair)""",
               "kpi_pair"),
        _check("PUB-03", "predictions", _epoch(end), _epoch(now), f"{end} > {now}", "predictions"),
    ])


@query("publish_pair_checks", with_ctes(PAIR, _pair_sql(fx.ts(fx.NOW_LOCAL))))
def pair_checks(spark, sf):
    return _plain(ck.pair_checks(*pair(spark, sf), fx.now_local()))


@query("publish_pair_elapsed", with_ctes(PAIR, _pair_sql("TIMESTAMP '2024-03-01 00:00:00'")))
def pair_elapsed(spark, sf):
    now = clock.naive(datetime(2024, 3, 1))
    return _plain(ck.pair_checks(*pair(spark, sf), now))


@query("publish_run_id_difference", with_ctes(PAIR, """
    SELECT coalesce(k.run_id, p.run_id) AS run_id, k.run_id IS NOT NULL AS in_kpis,
    p.run_id IS NOT NULL AS in_predictions
    FROM (SELECT DISTINCT model AS run_id FROM kpi_pair WHERE model <> 'xgb_global') k
    FULL JOIN (SELECT DISTINCT CASE row_kind WHEN 'forecast' THEN 'new' ELSE model_name END
      AS run_id FROM predictions) p ON k.run_id = p.run_id
    WHERE k.run_id IS NULL OR p.run_id IS NULL"""))
def run_id_difference(spark, sf):
    """Tables whose run ids differ on both sides."""
    kpis_rows, rows = pair(spark, sf)
    left = kpis_rows.where(F.col("model") != "xgb_global").withColumn("run_id", F.col("model"))
    is_new = F.col("row_kind") == "forecast"
    right = rows.withColumn("run_id", F.when(is_new, "new").otherwise(F.col("model_name")))
    return ck.run_id_difference(left, right).select(
        "run_id",
        F.col("in_kpis").isNotNull().alias("in_kpis"),
        F.col("in_predictions").isNotNull().alias("in_predictions"),
    )


@query("publish_summary", with_ctes(PAIR, """SELECT min(run_id) AS run_id,
    min(run_status) AS run_status,
    min(model_name) FILTER (row_kind = 'forecast') AS model_name,
    min(generated_at) AS generated_at,
    min(ts_local) FILTER (row_kind = 'forecast') AS window_start,
    max(ts_local) FILTER (row_kind = 'forecast') AS window_end,
    count(*) FILTER (row_kind = 'forecast') AS forecast_rows,
    (SELECT count(*) FROM kpi_pair) AS kpi_rows FROM predictions"""))
def summary(spark, sf):
    return ck.pair_summary(*pair(spark, sf))


def _constraints(table, key, required):
    out = [f"""SELECT '{table}:unique' AS rule, count(*) AS violations FROM
      (SELECT {', '.join(key)} FROM {table} GROUP BY ALL HAVING count(*) > 1)"""]
    out += [f"""SELECT '{table}:not_null:{c}', count(*) FILTER ({c} IS NULL) FROM {table}"""
            for c in required]
    return out


@query("publish_constraints", with_ctes(
    PAIR + ["kpis_twice AS (SELECT * FROM kpi_pair UNION ALL SELECT * FROM kpi_pair)"],
    " UNION ALL ".join(
        _constraints("kpis_twice", ck.KPI_KEY, ck.KPI_REQUIRED)
        + _constraints("predictions", ck.PREDICTION_KEY, ck.PREDICTION_REQUIRED)
    ).replace("'kpis_twice:", "'kpis:")))
def constraints(spark, sf):
    """The KPI table is given twice, so its key breaks; the predictions are in order."""
    kpis_rows, rows = pair(spark, sf)
    return ck.serving_constraints(kpis_rows.unionByName(kpis_rows), rows)


@query("check_gate_messages", with_ctes(PAIR, """SELECT 'CHK-07:prophet_fleet' AS check_id,
    'model prophet_fleet is missing from the KPI table' AS message
    UNION ALL SELECT 'CHK-09', count(DISTINCT model) || ' serving models, exactly one expected'
    FROM kpi_pair WHERE is_serving AND model <> 'prophet_fleet'"""))
def gate_messages(spark, sf):
    """The messages the gate would raise with for the spoiled KPI table."""
    rows = pair(spark, sf)[0].where(F.col("model") != MODEL_ADDITIVE)
    return ck.kpi_checks(rows, S).where(~F.col("passed")).select("check_id", "message")

"""Model families: sums they are fitted on, scores, registry, and the weekly run."""

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries import gold
from queries.features import HOLIDAYS
from queries.registry import query, rounded, table, with_ctes
from slotcast.config import MODEL_ADDITIVE, MODEL_LOCAL
from slotcast.operators import features as fe
from slotcast.operators import kpis as kp
from slotcast.operators.checks import QualityCheckError
from slotcast.operators.models import additive, baseline, cells, global_trees, local_effects, registry
from slotcast.plans import weekly
from slotcast.session import scratch_path
from slotcast.sources.store import TableStore

S = fx.SETTINGS
TRAINED_AT = "2024-01-31T00:00:00+00:00"


@query("model_baseline_fit", with_ctes(fx.BASELINE, """SELECT entity,
    round(avg(wait_time), 6) AS mean_wait, count(*) AS train_rows FROM train GROUP BY entity"""))
def baseline_fit(spark, sf):
    return rounded(baseline.fit(fx.split(spark, sf)[0]), "mean_wait")


@query("model_baseline_score", with_ctes(fx.BASELINE, """SELECT entity, ts_local,
    round(yhat, 6) AS yhat, round(lo, 6) AS lo, round(hi, 6) AS hi FROM scored"""))
def baseline_score(spark, sf):
    train, test = fx.split(spark, sf)
    rows = baseline.score(test, baseline.fit(train)).select("entity", "ts_local", "yhat", "lo", "hi")
    return rounded(rows, "yhat", "lo", "hi")


@query("model_baseline_unknown", with_ctes(fx.BASELINE, """SELECT
    count(*) FILTER (park_name <> 'view') AS answered,
    count(*) FILTER (park_name = 'view') AS unanswered FROM scored"""))
def baseline_unknown(spark, sf):
    """One site is unknown to the model, so its rows have no answer."""
    train, test = fx.split(spark, sf)
    params = baseline.fit(train.where(F.col("park_name") != "view"))
    return baseline.score(test, params).agg(
        F.count("yhat").alias("answered"), F.count_if(F.col("yhat").isNull()).alias("unanswered")
    )


@query("model_eligibility", with_ctes(fx.SPLIT, """SELECT entity, count(*) AS train_rows,
    count(*) >= 50 AS eligible FROM train GROUP BY entity"""))
def eligibility(spark, sf):
    return cells.eligibility(fx.split(spark, sf)[0], S)


@query("model_fit_report", with_ctes(fx.SPLIT, """SELECT
    count(*) FILTER (n >= 50) AS fitted, count(*) FILTER (n < 50) AS skipped
    FROM (SELECT count(*) AS n FROM train GROUP BY entity)"""))
def fit_report(spark, sf):
    return cells.fit_report(cells.eligibility(fx.split(spark, sf)[0], S))


NAMES = ", ".join("'" + n.replace("'", "''") + "'" for n in additive.HOLIDAY_NAMES)


@query("model_additive_sums", f"""WITH {', '.join(fx.SPLIT)}, {HOLIDAYS}
    SELECT entity, CAST((isodow(ts_local) - 1) * 48 + hour(ts_local) * 2
      + minute(ts_local) // 30 AS INTEGER) AS week_slot,
    CAST(coalesce(list_position([{NAMES}], h.name), 0) - 1 AS INTEGER) AS holiday,
    count(*) AS n, round(sum(wait_time), 6) AS total, round(sum(wait_time * wait_time), 6) AS squares
    FROM train LEFT JOIN holidays h ON CAST(ts_local AS DATE) = h.day GROUP BY ALL""")
def additive_sums(spark, sf):
    return rounded(additive.design_cells(fx.split(spark, sf)[0], S), "total", "squares")


@query("model_additive_score")
def additive_score(spark, sf):
    train, test = fx.split(spark, sf)
    model = registry.fit(MODEL_ADDITIVE, train, S, TRAINED_AT)
    rows = model.score(test, S).select("entity", "ts_local", "wait_time", "yhat", "lo", "hi")
    return rounded(rows, "yhat", "lo", "hi", digits=4)


@query("model_category_index", """SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS BIGINT)
    AS code FROM (SELECT DISTINCT p_type AS value FROM part)""")
def category_index(spark, sf):
    return global_trees.category_index(table(spark, sf, "part"), "p_type")


@query("model_category_apply", """SELECT l_orderkey, l_linenumber, l_partkey,
    CAST(coalesce(code, -1) AS BIGINT) AS code
    FROM lineitem JOIN part ON l_partkey = p_partkey
    LEFT JOIN (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code
      FROM (SELECT DISTINCT p_type AS v FROM part WHERE p_size <= 25)) ON v = p_type""")
def category_apply(spark, sf):
    """Codes pinned on some parts, applied to all line items; unseen types have none."""
    part = table(spark, sf, "part")
    codes = global_trees.category_index(part.where(F.col("p_size") <= 25), "p_type")
    rows = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    coded = global_trees.apply_category(rows, codes, "p_type")
    return coded.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.coalesce("p_type_code", F.lit(-1)).cast("bigint").alias("code"),
    )


@query("model_calendar_cells", f"""WITH {', '.join(fx.SPLIT)}, {HOLIDAYS}
    SELECT park_name, ride_key, CAST(hour(ts_local) AS INTEGER) AS hour,
    CAST(minute(ts_local) AS INTEGER) AS minute, CAST(isodow(ts_local) - 1 AS INTEGER) AS dayofweek,
    CAST(month(ts_local) AS INTEGER) AS month, CAST(h.day IS NOT NULL AS INTEGER) AS is_holiday,
    count(*) AS n, round(avg(wait_time), 6) AS label
    FROM train LEFT JOIN holidays h ON CAST(ts_local AS DATE) = h.day GROUP BY ALL""")
def calendar_cells(spark, sf):
    rows = rounded(global_trees.calendar_cells(fx.split(spark, sf)[0]), "label")
    return rows.select("park_name", "ride_key", "hour", "minute", "dayofweek", "month",
                       "is_holiday", "n", "label")


@query("model_residual_quantiles", with_ctes(fx.BASELINE, """SELECT entity,
    round(quantile_cont(wait_time - mean_wait, 0.1), 6) AS res_lo,
    round(quantile_cont(wait_time - mean_wait, 0.9), 6) AS res_hi
    FROM train JOIN means USING (entity) GROUP BY entity"""))
def residual_quantiles(spark, sf):
    train, _ = fx.split(spark, sf)
    scored = baseline.score(train, baseline.fit(train))
    return rounded(cells.residual_quantiles(scored, S), "res_lo", "res_hi")


@query("model_offsets", with_ctes(fx.BASELINE, """, q AS (SELECT entity,
    quantile_cont(wait_time - mean_wait, 0.1) AS a, quantile_cont(wait_time - mean_wait, 0.9) AS b
    FROM train JOIN means USING (entity) WHERE park_name <> 'view' GROUP BY entity)
    SELECT entity, ts_local, round(yhat, 6) AS yhat, round(yhat + coalesce(a, 0), 6) AS lo,
    round(yhat + coalesce(b, 0), 6) AS hi FROM scored LEFT JOIN q USING (entity)""").replace(
        "\n, q AS", ",\nq AS"))
def offsets(spark, sf):
    """Bounds from residual quantiles; one site has none, which counts as 0."""
    train, test = fx.split(spark, sf)
    params = baseline.fit(train)
    residuals = cells.residual_quantiles(baseline.score(train, params), S)
    known = residuals.where(~F.col("entity").startswith("view::"))
    rows = cells.with_offsets(baseline.score(test, params), known)
    return rounded(rows.select("entity", "ts_local", "yhat", "lo", "hi"), "yhat", "lo", "hi")


@query("model_global_score")
def global_score(spark, sf):
    train, test = fx.split(spark, sf)
    model = registry.fit(S.candidates[1], train, S, TRAINED_AT)
    rows = model.score(test, S).select("entity", "ts_local", "wait_time", "yhat", "lo", "hi")
    return rounded(rows, "yhat", "lo", "hi", digits=4)


def _stage(name: str, before: str) -> str:
    """One stage of the local family: effects by a calendar feature, and what they leave."""
    return f"""l_{name} AS (SELECT *, {name}_left - {name}_effect AS after_{name} FROM (
    SELECT *, {before} AS {name}_left,
        sum({before}) OVER (PARTITION BY entity, {name}) /
        (count(*) OVER (PARTITION BY entity, {name}) + 10) AS {name}_effect FROM SOURCE))"""


LOCAL = fx.SPLIT + [
    HOLIDAYS,
    """days AS (SELECT s.*, {e} AS entity, hour(ts_local) AS hour, isodow(ts_local) - 1 AS weekday,
    month(ts_local) AS month, CAST(h.day IS NOT NULL AS INTEGER) AS holiday
    FROM silver s LEFT JOIN (SELECT DISTINCT day FROM holidays) h
    ON CAST(s.ts_local AS DATE) = h.day)""".replace("{e}", fx.entity()),
    """l_base AS (SELECT *, wait_time - base AS after_base FROM (
    SELECT *, avg(wait_time) OVER (PARTITION BY entity) AS base,
        count(*) OVER (PARTITION BY entity) AS rows
    FROM days WHERE ts_local <= (SELECT cutoff FROM cut)) WHERE rows >= 50)""",
    _stage("hour", "after_base").replace("SOURCE", "l_base"),
    _stage("weekday", "after_hour").replace("SOURCE", "l_hour"),
    _stage("month", "after_weekday").replace("SOURCE", "l_weekday"),
    _stage("holiday", "after_month").replace("SOURCE", "l_month"),
    """l_offsets AS (SELECT entity, quantile_cont(after_holiday, 0.1) AS a,
    quantile_cont(after_holiday, 0.9) AS b, any_value(base) AS base FROM l_holiday GROUP BY entity)""",
    *(
        f"""e_{name} AS (SELECT DISTINCT entity, {name}, first({name}_effect) OVER
        (PARTITION BY entity, {name}) AS e_{name} FROM l_holiday)"""
        for name in ("hour", "weekday", "month", "holiday")
    ),
    """l_scored AS (SELECT d.entity, d.ts_local, d.wait_time, o.a, o.b, o.base
        + coalesce(e_hour, 0) + coalesce(e_weekday, 0) + coalesce(e_month, 0)
        + coalesce(e_holiday, 0) AS yhat
    FROM days d LEFT JOIN l_offsets o USING (entity) LEFT JOIN e_hour USING (entity, hour)
    LEFT JOIN e_weekday USING (entity, weekday) LEFT JOIN e_month USING (entity, month)
    LEFT JOIN e_holiday USING (entity, holiday) WHERE d.ts_local > (SELECT cutoff FROM cut))""",
]


@query("model_local_score", with_ctes(LOCAL, """SELECT entity, ts_local, wait_time,
    round(yhat, 4) AS yhat, round(yhat + a, 4) AS lo, round(yhat + b, 4) AS hi FROM l_scored"""))
def local_score(spark, sf):
    train, test = fx.split(spark, sf)
    model = registry.fit(MODEL_LOCAL, train, S, TRAINED_AT)
    rows = model.score(test, S).select("entity", "ts_local", "wait_time", "yhat", "lo", "hi")
    return rounded(rows, "yhat", "lo", "hi", digits=4)


CONTRACT = {
    "prophet_fleet": "n >= 50", "xgb_global": "n >= 1", "xgb_local_fleet": "n >= 50",
    "baseline_ride_mean": "n >= 1",
}


@query("model_contracts", with_ctes(fx.SPLIT + [
    "sizes AS (SELECT entity, count(*) AS n FROM train GROUP BY entity)"], " UNION ALL ".join(
    f"""SELECT '{m}' AS model, count(*) AS rows, count(*) FILTER ({rule}) AS answered,
    CAST(0 AS BIGINT) AS disorder FROM test LEFT JOIN sizes USING (entity)"""
    for m, rule in CONTRACT.items())))
def contracts(spark, sf):
    """Each family answers every row of the entities it fits, with bounds in order."""
    train, test = fx.split(spark, sf)
    out = None
    for name in S.model_order:
        scored = registry.fit(name, train, S, TRAINED_AT).score(test, S)
        row = scored.agg(
            F.lit(name).alias("model"),
            F.count(F.lit(1)).alias("rows"),
            F.count("yhat").alias("answered"),
            F.count_if((F.col("lo") > F.col("yhat")) | (F.col("yhat") > F.col("hi"))).alias(
                "disorder"
            ),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("model_save_load", with_ctes(fx.SPLIT, """SELECT count(*) AS rows,
    CAST(0 AS BIGINT) AS differences FROM test"""))
def save_load(spark, sf):
    """Scores of a saved and loaded fleet beside those of the fleet in memory."""
    train, test = fx.split(spark, sf)
    store = TableStore(spark, scratch_path(spark, "store"))
    model = registry.fit(MODEL_ADDITIVE, train, S, TRAINED_AT)
    count = registry.save(model, store, "r1")
    store.promote(serving={"run_id": "r1", "model_name": model.family,
                           "trained_at": TRAINED_AT, "ride_count": count})
    loaded = registry.load(store, store.serving(), S)
    key = ["entity", "ts_local"]
    kept = model.score(test, S).select(*key, F.col("yhat").alias("before"))
    again = loaded.score(test, S).select(*key, F.col("yhat").alias("after"))
    joined = kept.join(again, key)
    return joined.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("differences"),
    )


@query("model_manifest", with_ctes(fx.SPLIT, f"""SELECT 'r1' AS run_id,
    'prophet_fleet' AS model_name, '{TRAINED_AT}' AS trained_at, entity,
    count(*) OVER () AS ride_count
    FROM (SELECT entity FROM train GROUP BY entity HAVING count(*) >= 50)"""))
def manifest(spark, sf):
    eligible = cells.eligibility(fx.split(spark, sf)[0], S).where("eligible")
    return registry.manifest(eligible, "r1", MODEL_ADDITIVE, TRAINED_AT)


@query("model_manifest_problems", """SELECT unnest(['missing trained_at',
    'count differs from the list']) AS problem FROM (SELECT count(*) AS n FROM customer) WHERE n > 1""")
def manifest_problems(spark, sf):
    """A manifest over all customers, without a training time and with a wrong count."""
    customers = table(spark, sf, "customer").select(F.col("c_name").alias("entity"))
    rows = registry.manifest(customers, "r1", MODEL_ADDITIVE, TRAINED_AT)
    spoiled = rows.withColumns(
        {"trained_at": F.lit(None).cast("string"), "ride_count": F.col("ride_count") + 1}
    )
    return registry.manifest_problems(spoiled)


@query("model_reconcile", """SELECT coalesce(a, b) AS entity, a IS NOT NULL AS listed,
    b IS NOT NULL AS loaded FROM (SELECT c_name AS a FROM customer WHERE c_acctbal > 0)
    FULL JOIN (SELECT c_name AS b FROM customer WHERE c_mktsegment <> 'BUILDING') ON a = b
    WHERE a IS NULL OR b IS NULL""")
def reconcile(spark, sf):
    """Customers in credit as listed entities, customers of most segments as loaded ones."""
    customers = table(spark, sf, "customer").withColumn("entity", F.col("c_name"))
    listed = customers.where(F.col("c_acctbal") > 0)
    loaded = customers.where(F.col("c_mktsegment") != "BUILDING")
    return registry.entity_difference(listed, loaded).select(
        "entity",
        F.col("listed").isNotNull().alias("listed"),
        F.col("loaded").isNotNull().alias("loaded"),
    )


@query("model_expired_runs", """SELECT run_id FROM (SELECT DISTINCT
    strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS run_id FROM orders)
    WHERE run_id NOT IN (SELECT DISTINCT strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS r FROM orders
      ORDER BY r DESC LIMIT 4) AND run_id <> (SELECT strftime(min(o_orderdate), '%Y%m%dT%H%M%SZ')
      FROM orders)""")
def expired_runs(spark, sf):
    """Every order date as a run; the pointer names the oldest."""
    stamp = F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss'Z'").alias("run_id")
    runs = table(spark, sf, "orders").select(stamp)
    return registry.expired_runs(runs, runs.agg(F.min("run_id")).scalar(), S)


# ---- the whole run ------------------------------------------------------------------

# Some units are too short at a small scale for a model of their own.
WEEKLY = replace(S, min_entities=10, min_train_rows=30)


def _run(spark, store, now):
    return weekly.Run(store, WEEKLY, now)


@query("run_weekly_predictions")
def weekly_predictions(spark, sf):
    """The promoted predictions of a first weekly run on the events."""
    store = TableStore(spark, scratch_path(spark, "store"))
    weekly.run_weekly(_run(spark, store, fx.NOW_UTC), fx.seasonal_bronze(spark, sf))
    return store.read("predictions")


SEASONAL = [
    fx.BRONZE,
    f"""seasonal AS (SELECT * REPLACE (CAST(floor(wait_time / 10) + 70
    - 5 * abs(hour({fx.loc('ts_utc')}) - 14) AS BIGINT) AS wait_time) FROM bronze)""",
    *fx.silver_ctes("seasonal")[1:],
    *fx.BASELINE[len(fx.SILVER):],
]


@query("run_weekly_baseline", with_ctes(SEASONAL, """SELECT park_name, ride_key, ride_name,
    ts_local, ts_utc, round(yhat, 6) AS predicted_wait_min, wait_time AS actual_wait_min,
    round(yhat - wait_time, 6) AS error_min, '20240131T000000Z' AS run_id,
    'fresh_model' AS run_status FROM scored"""))
def weekly_baseline(spark, sf):
    """What a whole weekly run publishes of the one model that SQL can state."""
    store = TableStore(spark, scratch_path(spark, "store"))
    weekly.run_weekly(_run(spark, store, fx.NOW_UTC), fx.seasonal_bronze(spark, sf))
    rows = store.read("predictions").where(F.col("model_name") == S.baseline)
    return rounded(rows, "predicted_wait_min", "actual_wait_min", "error_min").select(
        "park_name", "ride_key", "ride_name", "ts_local", "ts_utc", "predicted_wait_min",
        "actual_wait_min", "error_min", "run_id", "run_status",
    )


def _later(days: int) -> list[str]:
    """The forecast grid of a clock so many days later."""
    slots = gold.SLOTS.replace(fx.ts(fx.NOW_LOCAL), fx.ts(fx.NOW_LOCAL + timedelta(days=days)))
    return [
        slots.replace("all_slots", f"slots_{days}"),
        gold.GRID.replace("fgrid", f"grid_{days}").replace("all_slots", f"slots_{days}"),
    ]


STATUSES = {0: "fresh_model", 1: "kept_previous_model", 4: "stale_input"}
SUMMARY_DOUBLES = "silver_rows attractions forecast_rows backtest_rows raw_rows sites train_rows test_rows".split()


@query("run_four_statuses", with_ctes(SEASONAL + [
    gold.ENTITIES, *_later(0), *_later(1), *_later(4),
    "sizes AS (SELECT entity, count(*) AS n FROM train GROUP BY entity)",
    """tested AS (SELECT count(*) AS test_rows, 2 * count(n) + 2 * count(*) FILTER (n >= 30)
    AS backtest_rows FROM test LEFT JOIN sizes USING (entity))""",
    """fits AS (SELECT count(*) AS fitted, count(*) FILTER (n < 30) AS skipped,
    sum(n) AS train_rows FROM sizes)""",
    """profile AS (SELECT count(*) AS silver_rows, count(DISTINCT (park_name, ride_key)) AS attractions,
    count(DISTINCT park_name) AS sites, round(avg(wait_time), 6) AS mean_wait,
    round(avg(CASE WHEN wait_time = 0 THEN 100.0 ELSE 0.0 END), 6) AS zero_pct,
    min(ts_local) AS first_local, max(ts_local) AS last_local,
    (SELECT count(*) FROM bronze) AS raw_rows FROM silver)""",
    """days AS (SELECT days, days < 4 AS learns, '2024' || strftime(TIMESTAMP '2024-01-31'
    + to_days(days), '%m%d') || 'T000000Z' AS run_id, run_status, forecast_rows FROM (VALUES """
    + ", ".join(f"({d}, '{s}', (SELECT count(*) FROM grid_{d}))" for d, s in STATUSES.items())
    + ") v(days, run_status, forecast_rows))",
    """summary AS (SELECT run_id, run_status, '20240131T000000Z' AS serving_run_id, silver_rows,
    attractions, forecast_rows, backtest_rows, raw_rows, sites, mean_wait, zero_pct, first_local,
    last_local, CASE WHEN learns THEN cutoff END AS cutoff,
    CASE WHEN learns THEN train_rows END AS train_rows,
    CASE WHEN learns THEN test_rows END AS test_rows,
    CASE WHEN learns THEN fitted END AS fitted_floor,
    CASE WHEN learns THEN fitted - skipped END AS fitted_additive,
    CASE WHEN learns THEN skipped END AS skipped_additive
    FROM days, profile, tested, fits, cut
    UNION ALL BY NAME
    SELECT '20240205T000000Z' AS run_id, 'fallback_after_failure' AS run_status FROM profile)""",
], "SELECT * REPLACE (" + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in
    [*SUMMARY_DOUBLES, "fitted_floor", "fitted_additive", "skipped_additive"]) + ") FROM summary"))
def four_statuses(spark, sf):
    """A fresh run, the same again (kept), one on stale input, and one that fails.

    Of the last only the status of what it left is known. Scores are left out: they are MLlib's.
    """
    store = TableStore(spark, scratch_path(spark, "store"))
    bronze, now = fx.seasonal_bronze(spark, sf), fx.NOW_UTC
    out = []
    for days in (0, 1, 4):
        out.append(weekly.run_weekly(_run(spark, store, now + timedelta(days=days)), bronze))
    failing = weekly.Run(
        store, replace(WEEKLY, min_entities=10**9), now + timedelta(days=5)
    )
    try:
        weekly.run_or_fall_back(failing, bronze)
    except QualityCheckError:
        rows = store.read("predictions")
        status = rows.select("run_status").distinct().first()["run_status"]
        out.append({"run_id": failing.run_id, "run_status": status})
    frames = [weekly.summary_frame(store, s) for s in out]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    report = result.select(
        "run_id", "run_status", "serving_run_id", "mean_wait", "zero_pct", "first_local",
        "last_local", F.date_trunc("second", "cutoff").cast("timestamp_ntz").alias("cutoff"),
        *[F.col(c).cast("double").alias(c) for c in SUMMARY_DOUBLES],
        F.col("fitted")[S.baseline].cast("double").alias("fitted_floor"),
        F.col("fitted")[MODEL_ADDITIVE].cast("double").alias("fitted_additive"),
        F.col("skipped")[MODEL_ADDITIVE].cast("double").alias("skipped_additive"),
    )
    return rounded(report, "mean_wait", "zero_pct")


@query("model_retention", """WITH weeks AS (
    SELECT run, row_number() OVER (ORDER BY run) AS n, count(*) OVER () AS total
    FROM (SELECT DISTINCT strftime(date_trunc('week', ts), '%Y%m%d') AS run FROM events))
    SELECT name, run, CAST(n AS DOUBLE) AS last_named FROM weeks,
      (VALUES ('silver'), ('models')) v(name) WHERE n <= total - 2
    UNION ALL SELECT 'silver', 'abandoned', NULL FROM weeks WHERE n = 1""")
def retention(spark, sf):
    """A run for each week of the events, promoted one after the other, and one that was cut off:
    what the two newest promotions do not name may go."""
    store = TableStore(spark, scratch_path(spark, "store"))
    week = F.date_format(F.date_trunc("week", "ts"), "yyyyMMdd")
    events = table(spark, sf, "events").withColumn("run", week)
    # One entry a week, however many events there are.
    for run in sorted(r["run"] for r in events.select("run").distinct().collect()):
        rows = events.where(F.col("run") == run)
        store.write("silver", rows, run)
        rows.select("event_type").distinct().write.parquet(f"{store.root}/models/run={run}/params")
        store.promote("silver", serving={"run_id": run, "model_name": MODEL_ADDITIVE,
                                         "trained_at": TRAINED_AT, "ride_count": 1})
    store.write("silver", events, "abandoned")
    found = registry.unreachable(store, replace(S, retain_runs=2))
    return found.select(
        "name",
        F.regexp_replace("run", "-[0-9a-f]{8}$", "").alias("run"),
        F.col("last_named").cast("double").alias("last_named"),
    )


STALE_SLOTS = gold.SLOTS.replace(fx.ts(fx.NOW_LOCAL), fx.ts(fx.STALE_LOCAL))
LATER_SLOTS = gold.SLOTS.replace(
    fx.ts(fx.NOW_LOCAL), fx.ts(fx.STALE_LOCAL + timedelta(days=1))
).replace("all_slots", "later_slots")


@query("run_degraded_forecasts", with_ctes(
    SEASONAL + [gold.ENTITIES, STALE_SLOTS, LATER_SLOTS, gold.GRID,
                gold.GRID.replace("fgrid", "later").replace("all_slots", "later_slots")],
    """SELECT 'stale_input' AS run_status, '20240131T000000Z' AS run_id, park_name, ride_key,
    ride_name, ts_local FROM fgrid UNION ALL
    SELECT 'fallback_after_failure', '20240131T000000Z', park_name, ride_key, ride_name, ts_local
    FROM later"""))
def degraded_forecasts(spark, sf):
    """Forecast rows after a run on stale input, and after one that failed a day later."""
    store = TableStore(spark, scratch_path(spark, "store"))
    bronze, stale_utc = fx.seasonal_bronze(spark, sf), fx.STALE_LOCAL + timedelta(hours=8)
    weekly.run_weekly(_run(spark, store, fx.NOW_UTC), bronze)
    columns = ["run_status", "run_id", "park_name", "ride_key", "ride_name", "ts_local"]

    def forecast():
        return store.read("predictions").where(F.col("row_kind") == "forecast").select(*columns)

    weekly.run_weekly(_run(spark, store, stale_utc), bronze)
    stale = forecast()
    failing = replace(WEEKLY, min_entities=10**9)
    try:
        weekly.run_or_fall_back(
            weekly.Run(store, failing, stale_utc + timedelta(days=1)), bronze
        )
    except QualityCheckError:
        pass
    return stale.unionByName(forecast())


@query("run_candidates_kpis")
def candidates_kpis(spark, sf):
    """KPIs of the four real families on the same test rows."""
    silver = fx.silver(spark, sf)
    train, test = fe.chrono_split(silver, S)
    run = _run(spark, TableStore(spark, scratch_path(spark, "store")), fx.NOW_UTC)
    models = [registry.fit(n, train, S, TRAINED_AT) for n in S.model_order]
    scored = weekly.score_models(run, models, train, test)
    return kp.compute_kpis(scored, S)

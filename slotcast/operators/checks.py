"""Quality checks as rows: (check_id, table_name, observed, threshold, passed, message).

Each table is aggregated once into a single row of measures, and the checks are read off
that row. ``message`` is null where the check passed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.config import Settings
from slotcast.functions import clock
from slotcast.functions.numbers import is_finite
from slotcast.operators.gold import slots_per_site
from slotcast.operators.silver import site_table
from slotcast.schemas import (
    KPI_KEY,
    KPI_REQUIRED,
    PREDICTION_KEY,
    PREDICTION_REQUIRED,
    UNIT_KEY,
)


class QualityCheckError(Exception):
    """At least one check failed; the message joins all of them."""


def row(
    check_id: str, table: str, observed: Column, threshold: Column, passed: Column, message: Column
) -> Column:
    ok = F.coalesce(passed, F.lit(False))
    return F.struct(
        F.lit(check_id).alias("check_id"),
        F.lit(table).alias("table_name"),
        observed.cast("double").alias("observed"),
        threshold.cast("double").alias("threshold"),
        ok.alias("passed"),
        F.when(~ok, message).alias("message"),
    )


def as_checks(measures: DataFrame, rows: list[Column]) -> DataFrame:
    """One check row per struct, from a one-row frame of measures."""
    return measures.select(F.inline(F.array(*rows)))


def null_checks(check_id: str, table: str, columns: list[str]) -> list[Column]:
    return [
        row(
            f"{check_id}:{c}", table, F.col(f"null_{c}"), F.lit(0), F.col(f"null_{c}") == 0,
            F.format_string(f"%d nulls in {table}.{c}", F.col(f"null_{c}")),
        )
        for c in columns
    ]


def null_counts(columns: list[str], among: Column | None = None) -> list[Column]:
    def missing(c: str) -> Column:
        return F.col(c).isNull() if among is None else among & F.col(c).isNull()

    return [F.count_if(missing(c)).alias(f"null_{c}") for c in columns]


# ---- silver -------------------------------------------------------------------------

SILVER_NOT_NULL = ["ride_key", "ts_local", "wait_time"]


def peak_hour(silver: DataFrame) -> DataFrame:
    """Local hour with the highest mean wait; ties go to the earliest hour."""
    means = silver.groupBy(F.hour("ts_local").alias("hour")).agg(F.avg("wait_time").alias("mean"))
    return means.agg(
        F.min_by("hour", F.struct((-F.col("mean")).alias("m"), "hour")).alias("peak_hour")
    )


def silver_measures(silver: DataFrame, last_rows: int | Column | None) -> DataFrame:
    """One pass: per-unit partial results first, so that units are counted without a
    distinct aggregate over all rows."""
    per_unit = silver.groupBy(*UNIT_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("wait_time") == 0).alias("zeros"),
        F.min("ts_local").alias("first"),
        F.max("ts_local").alias("last"),
        F.count_if(F.col("ts_local").isNull()).alias("no_time"),
        F.count_if(F.col("wait_time").isNull()).alias("no_wait"),
    )
    last = F.lit(last_rows) if last_rows is None or isinstance(last_rows, int) else last_rows
    return per_unit.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_if(F.col("park_name").isNotNull() & F.col("ride_key").isNotNull()).alias("units"),
        (F.sum("zeros") * 100.0 / F.sum("n")).alias("zero_pct"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.coalesce(F.sum(F.when(F.col("ride_key").isNull(), F.col("n"))), F.lit(0)).alias(
            "null_ride_key"
        ),
        F.coalesce(F.sum("no_time"), F.lit(0)).alias("null_ts_local"),
        F.coalesce(F.sum("no_wait"), F.lit(0)).alias("null_wait_time"),
    ).select(
        "*", last.cast("bigint").alias("last_rows"), peak_hour(silver).scalar().alias("peak_hour")
    )


def silver_checks(
    silver: DataFrame, settings: Settings, now_local: Column, last_rows: int | Column | None = None
) -> DataFrame:
    table = "silver"
    s = settings
    floor_rows = F.col("last_rows") * F.lit(s.min_row_ratio)
    low, high = s.peak_check_hours
    limit = now_local + F.expr("interval 1 day")
    start = clock.naive(s.collection_start)
    rows = [
        row("CHK-01", table, F.col("rows"), floor_rows,
            F.col("last_rows").isNull() | (F.col("rows") >= floor_rows),
            F.format_string("silver fell to %d rows from %d", F.col("rows"), F.col("last_rows"))),
        row("CHK-02", table, F.col("units"), F.lit(s.min_entities),
            F.col("units") >= s.min_entities,
            F.format_string(f"%d distinct units, at least {s.min_entities} needed",
                            F.col("units"))),
        row("CHK-03", table, F.col("zero_pct"), F.lit(s.max_zero_pct),
            F.col("zero_pct") <= s.max_zero_pct,
            F.format_string(f"%.1f%% of the waits are zero, at most {s.max_zero_pct:g}%% allowed",
                            F.col("zero_pct"))),
        *null_checks("CHK-04", table, SILVER_NOT_NULL),
        row("CHK-05:min", table, clock.micros(F.col("first")) / 1e6, clock.micros(start) / 1e6,
            F.col("first") >= start,
            F.format_string("first slot %s lies before trusted collection",
                            F.col("first").cast("string"))),
        row("CHK-05:max", table, clock.micros(F.col("last")) / 1e6, clock.micros(limit) / 1e6,
            F.col("last") <= limit,
            F.format_string("last slot %s lies in the future", F.col("last").cast("string"))),
        row("CHK-06", table, F.col("peak_hour"), F.lit(high),
            F.col("peak_hour").between(low, high),
            F.format_string(f"mean wait peaks at local hour %d, expected {low} to {high}: "
                            "suspect the time zone conversion", F.col("peak_hour"))),
    ]
    return as_checks(silver_measures(silver, last_rows), rows)


# ---- KPI table ----------------------------------------------------------------------


def kpi_checks(kpis: DataFrame, settings: Settings) -> DataFrame:
    """Candidates present, MAE usable, one serving model, and it beats the baseline."""
    table = "kpis"
    models = settings.model_order
    is_mae = F.col("kpi_name") == "mae"
    mae_of = [
        F.max(F.when(is_mae & (F.col("model") == m), F.col("kpi_value"))).alias(f"mae_{m}")
        for m in models
    ]
    seen = [F.count_if(F.col("model") == m).alias(f"seen_{m}") for m in models]
    serving_mae = F.max(F.when(is_mae & F.col("is_serving"), F.col("kpi_value")))
    measures = kpis.agg(
        *mae_of, *seen,
        F.count_distinct(F.when(F.col("is_serving"), F.col("model"))).alias("serving_models"),
        F.max(F.when(F.col("is_serving"), F.col("model"))).alias("serving"),
        serving_mae.alias("serving_mae"),
    )
    base = F.col(f"mae_{settings.baseline}")
    beaten = F.col("serving_mae") < base
    applies = (F.col("serving_models") == 1) & base.isNotNull() & F.col("serving_mae").isNotNull()
    rows = [
        row(f"CHK-07:{m}", table, F.col(f"seen_{m}"), F.lit(1), F.col(f"seen_{m}") > 0,
            F.lit(f"model {m} is missing from the KPI table"))
        for m in settings.candidates
    ] + [
        row(f"CHK-08:{m}", table, F.col(f"mae_{m}"), F.lit(0),
            (F.col(f"seen_{m}") == 0) | (is_finite(F.col(f"mae_{m}")) & (F.col(f"mae_{m}") > 0)),
            F.concat(F.lit(f"MAE of {m} is "),
                     F.coalesce(F.col(f"mae_{m}").cast("string"), F.lit("missing")),
                     F.lit(", not finite and positive")))
        for m in models
    ] + [
        row("CHK-09", table, F.col("serving_models"), F.lit(1), F.col("serving_models") == 1,
            F.format_string("%d serving models, exactly one expected", F.col("serving_models"))),
        row("CHK-10", table, F.col("serving_mae"), base, ~applies | beaten,
            F.format_string("serving model %s with MAE %.2f does not beat the baseline's %.2f",
                            F.col("serving"), F.col("serving_mae"), base)),
    ]
    return as_checks(measures, rows)


# ---- predictions --------------------------------------------------------------------

FORECAST_NOT_NULL = [
    "park_name", "ride_key", "ride_name", "ts_local", "ts_utc",
    "predicted_wait_min", "lower_bound", "upper_bound", "model_name",
]
BACKTEST_NOT_NULL = ["predicted_wait_min", "actual_wait_min", "error_min"]


def prediction_measures(
    predictions: DataFrame, settings: Settings, sites: DataFrame | None = None
) -> DataFrame:
    """One row of measures, aggregated per (kind, unit) first and then overall."""
    sites = site_table(predictions.sparkSession, settings) if sites is None else sites
    p, lo, hi = F.col("predicted_wait_min"), F.col("lower_bound"), F.col("upper_bound")
    nullable = list(dict.fromkeys([*FORECAST_NOT_NULL, *BACKTEST_NOT_NULL]))
    per_unit = predictions.groupBy("row_kind", *UNIT_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((p < 0) | (lo < 0)).alias("negative"),
        F.count_if(p < 0).alias("negative_pred"),
        F.count_if((lo > p) | (p > hi)).alias("disorder"),
        *(F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in nullable),
    )
    slots = slots_per_site(sites, settings)
    joined = per_unit.join(slots, "park_name", "left")
    fc, bt = F.col("row_kind") == "forecast", F.col("row_kind") == "backtest"
    keyed = F.col("park_name").isNotNull() & F.col("ride_key").isNotNull()

    def total(name: str, among: Column) -> Column:
        return F.coalesce(F.sum(F.when(among, F.col(name))), F.lit(0))

    return joined.agg(
        total("n", fc).alias("forecast_rows"),
        total("n", bt).alias("backtest_rows"),
        F.count_if(fc & keyed).alias("forecast_units"),
        total("slots", fc & keyed).alias("expected_rows"),
        total("negative", fc).alias("forecast_negative"),
        total("disorder", fc).alias("forecast_disorder"),
        total("negative_pred", bt).alias("backtest_negative"),
        *(total(f"n_{c}", fc).alias(f"null_{c}") for c in FORECAST_NOT_NULL),
        *(total(f"n_{c}", bt).alias(f"null_bt_{c}") for c in BACKTEST_NOT_NULL),
    )


def prediction_checks(
    predictions: DataFrame,
    settings: Settings,
    active: int | Column,
    sites: DataFrame | None = None,
) -> DataFrame:
    """Without any forecast row, only that is reported."""
    measures = prediction_measures(predictions, settings, sites)
    active = F.lit(active) if isinstance(active, int) else active
    measures = measures.withColumn("active", active)
    need = F.col("active") * F.lit(settings.min_coverage)
    low, high = settings.row_band
    n, expected = F.col("forecast_rows"), F.col("expected_rows")
    first = row("CHK-11", "predictions", n, F.lit(1), n > 0,
                F.lit("the predictions hold no forecast rows"))
    others = [
        row("CHK-12", "forecast", F.col("forecast_units"), need,
            (F.col("active") == 0) | (F.col("forecast_units") >= need),
            F.format_string("forecast covers %d of %d active units, "
                            f"a share of {settings.min_coverage:g} is needed",
                            F.col("forecast_units"), F.col("active"))),
        *null_checks("CHK-13", "forecast", FORECAST_NOT_NULL),
        row("CHK-14", "forecast", F.col("forecast_negative"), F.lit(0),
            F.col("forecast_negative") == 0,
            F.format_string("%d forecast rows with a negative prediction or lower bound",
                            F.col("forecast_negative"))),
        row("CHK-15", "forecast", F.col("forecast_disorder"), F.lit(0),
            F.col("forecast_disorder") == 0,
            F.format_string("%d forecast rows with bounds out of order",
                            F.col("forecast_disorder"))),
        row("CHK-16", "forecast", n, expected,
            n.between(expected * F.lit(low), expected * F.lit(high)),
            F.format_string("%d forecast rows where about %d were expected", n, expected)),
        *(
            row(f"CHK-17:{c}", "backtest", F.col(f"null_bt_{c}"), F.lit(0),
                F.col(f"null_bt_{c}") == 0,
                F.format_string(f"%d nulls in backtest.{c}", F.col(f"null_bt_{c}")))
            for c in BACKTEST_NOT_NULL
        ),
        row("CHK-17:sign", "backtest", F.col("backtest_negative"), F.lit(0),
            F.col("backtest_negative") == 0,
            F.format_string("%d backtest rows with a negative prediction",
                            F.col("backtest_negative"))),
    ]
    every = F.array(first, *others)
    return measures.select(F.inline(F.when(n > 0, every).otherwise(F.array(first))))


# ---- the serving pair ---------------------------------------------------------------


def run_id_difference(kpis: DataFrame, predictions: DataFrame) -> DataFrame:
    """Run ids that only one table of the pair carries."""
    left = kpis.select("run_id").distinct().withColumn("in_kpis", F.lit(True))
    right = predictions.select("run_id").distinct().withColumn("in_predictions", F.lit(True))
    return left.join(right, "run_id", "full").where(
        F.col("in_kpis").isNull() | F.col("in_predictions").isNull()
    )


def pair_checks(kpis: DataFrame, predictions: DataFrame, now_local: Column) -> DataFrame:
    """What must hold before a pair is published: both full, one run, window not over."""
    run = F.col("run_id").cast("string")
    fc = F.col("row_kind") == "forecast"
    k = kpis.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(run).alias("runs"), F.min(run).alias("run")
    )
    p = predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(fc).alias("forecast"),
        F.min(run).alias("first_run"),
        F.max(run).alias("last_run"),
        F.max(F.when(fc, F.col("ts_local"))).alias("window_end"),
    )
    measures = p.select(
        "*",
        k.select("n").scalar().alias("kpi_rows"),
        k.select("runs").scalar().alias("kpi_runs"),
        k.select("run").scalar().alias("kpi_run"),
    )
    one_run = (
        (F.col("kpi_runs") == 1)
        & (F.col("first_run") == F.col("kpi_run"))
        & (F.col("last_run") == F.col("kpi_run"))
    )
    rows = [
        row("PUB-01:kpis", "kpis", F.col("kpi_rows"), F.lit(1), F.col("kpi_rows") > 0,
            F.lit("the KPI table is empty")),
        row("PUB-01:predictions", "predictions", F.col("n"), F.lit(1), F.col("n") > 0,
            F.lit("the predictions are empty")),
        row("PUB-01:forecast", "predictions", F.col("forecast"), F.lit(1), F.col("forecast") > 0,
            F.lit("the predictions hold no forecast rows")),
        row("PUB-02", "pair", F.col("kpi_runs"), F.lit(1), one_run,
            F.concat_ws(" ", F.lit("run ids differ: KPIs"), F.col("kpi_run"),
                        F.lit("predictions"), F.col("first_run"), F.col("last_run"))),
        row("PUB-03", "predictions", clock.micros(F.col("window_end")) / 1e6,
            clock.micros(now_local) / 1e6, F.col("window_end") > now_local,
            F.concat(F.lit("the forecast ended at "), F.col("window_end").cast("string"))),
    ]
    return as_checks(measures, rows)


def pair_summary(kpis: DataFrame, predictions: DataFrame) -> DataFrame:
    fc = F.col("row_kind") == "forecast"
    return predictions.agg(
        F.min("run_id").alias("run_id"),
        F.min("run_status").alias("run_status"),
        F.min(F.when(fc, F.col("model_name"))).alias("model_name"),
        F.min("generated_at").alias("generated_at"),
        F.min(F.when(fc, F.col("ts_local"))).alias("window_start"),
        F.max(F.when(fc, F.col("ts_local"))).alias("window_end"),
        F.count_if(fc).alias("forecast_rows"),
    ).withColumn("kpi_rows", kpis.agg(F.count(F.lit(1))).scalar())


def constraint_violations(df: DataFrame, table: str, key: list[str], required: list[str]):
    """Rows that break the serving table's key or NOT NULL columns, counted per constraint."""
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    keys = repeated.agg(
        F.lit(f"{table}:unique").alias("rule"), F.count(F.lit(1)).alias("violations")
    )
    nulls = df.agg(*null_counts(required)).unpivot(
        [], [f"null_{c}" for c in required], "rule", "violations"
    )
    named = F.concat(F.lit(f"{table}:not_null:"), F.expr("substring(rule, 6)"))
    return keys.unionByName(nulls.withColumn("rule", named))


def serving_constraints(kpis: DataFrame, predictions: DataFrame) -> DataFrame:
    return constraint_violations(kpis, "kpis", KPI_KEY, KPI_REQUIRED).unionByName(
        constraint_violations(predictions, "predictions", PREDICTION_KEY, PREDICTION_REQUIRED)
    )


# ---- the gate -----------------------------------------------------------------------


def failures(checks: DataFrame) -> list[str]:
    """Messages of the failed checks. A check frame has a few dozen rows by construction."""
    failed = checks.where(~F.col("passed")).select("check_id", "message").collect()
    return [r["message"] or r["check_id"] for r in failed]


def gate(*frames: DataFrame) -> None:
    """Raise once, with every failed check, unless all pass."""
    problems = [message for frame in frames for message in failures(frame)]
    if problems:
        raise QualityCheckError("; ".join(problems))

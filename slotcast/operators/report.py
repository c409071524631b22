"""Aggregates behind the monitoring report; rendering them is left to the reader's tool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slotcast.config import KPI_NAMES, Settings
from slotcast.functions import clock, text
from slotcast.functions.numbers import fmt, value_label
from slotcast.schemas import UNIT_KEY

# ---- fixed values -------------------------------------------------------------------
STATUS_LABELS = {
    "fresh_model": ("Fresh model", "good"),
    "kept_previous_model": ("Kept previous model", "neutral"),
    "fallback_after_failure": ("Fallback after a failed run", "serious"),
    "stale_input": ("Stale input - forecast only", "serious"),
}
# KPI, label, unit
TILES = (
    ("mae", "MAE", "min"),
    ("rmse", "RMSE", "min"),
    ("pct_within_10min", "Within 10 min", "%"),
    ("pct_severe_miss", "Severe misses", "%"),
    ("bias", "Bias", "min"),
    ("high_wait_mae", "High-wait MAE", "min"),
    ("peak_hours_mae", "Peak-hours MAE", "min"),
)
HISTOGRAM_LOW, HISTOGRAM_HIGH, HISTOGRAM_BINS = -40.0, 40.0, 16
NEAR_ZERO = 2.5
HARDEST = 15
# ---- end of fixed values ------------------------------------------------------------


def _literal_table(like: DataFrame, rows: list[Column]) -> DataFrame:
    return like.sparkSession.range(1).select(F.inline(F.array(*rows)))


def serving_model(kpis: DataFrame) -> Column:
    """Name of the serving model as a scalar subquery."""
    return kpis.where(F.col("is_serving")).agg(F.min("model")).scalar()


def kpi_tiles(kpis: DataFrame) -> DataFrame:
    """The serving model's KPIs in fixed order; n/a where there is none."""
    specs = [
        F.struct(F.lit(i).alias("position"), F.lit(k).alias("kpi_name"),
                 F.lit(label).alias("label"), F.lit(unit).alias("unit"))
        for i, (k, label, unit) in enumerate(TILES)
    ]
    values = kpis.where(F.col("is_serving")).select("kpi_name", "kpi_value")
    return (
        _literal_table(kpis, specs)
        .join(values, "kpi_name", "left")
        .select("position", "kpi_name", "label", "unit", fmt(F.col("kpi_value")).alias("value"))
    )


def model_comparison(kpis: DataFrame, settings: Settings) -> DataFrame:
    """One row per model in fixed order; KPI names are given, so the pivot needs no scan."""
    names = F.array(*(F.lit(m) for m in settings.model_order))
    wide = kpis.groupBy("model").pivot("kpi_name", list(KPI_NAMES)).agg(F.avg("kpi_value"))
    return (
        wide.withColumn("position", F.array_position(names, F.col("model")))
        .where(F.col("position") > 0)
        .withColumn("serving", F.coalesce(F.col("model") == serving_model(kpis), F.lit(False)))
        .select("position", "model", "serving", *(k for k, _, _ in TILES))
    )


def serving_backtest(predictions: DataFrame, kpis: DataFrame) -> DataFrame:
    """Backtest rows of the serving model, or all of them when it has none.

    Whether it has any is one scalar subquery, not a window over the whole table.
    """
    backtest = predictions.where(F.col("row_kind") == "backtest")
    own = F.col("model_name") == serving_model(kpis)
    found = backtest.agg(F.count_if(own)).scalar()
    return backtest.where(own | (found == 0))


def _means() -> list[Column]:
    return [
        F.round(F.avg("actual_wait_min"), 2).alias("actual"),
        F.round(F.avg("predicted_wait_min"), 2).alias("predicted"),
    ]


def daily_means(backtest: DataFrame) -> DataFrame:
    day = F.to_date("ts_local").alias("day")
    return backtest.groupBy(day).agg(*_means()).withColumn("label", clock.day_label(F.col("day")))


def hourly_means(backtest: DataFrame) -> DataFrame:
    hour = F.hour("ts_local").alias("hour")
    return backtest.groupBy(hour).agg(*_means()).withColumn(
        "label", clock.hour_label(F.col("hour"))
    )


def error_histogram(predictions: DataFrame, settings: Settings) -> DataFrame:
    """Errors of each model in 18 bins, open at both ends; empty bins are kept.

    Only bin counts are shuffled. The shares and the common scale come from the counts,
    which are at most 18 per model.
    """
    low, high, inner = HISTOGRAM_LOW, HISTOGRAM_HIGH, HISTOGRAM_BINS
    step = (high - low) / inner
    errors = predictions.where(
        (F.col("row_kind") == "backtest")
        & F.col("model_name").isin(*settings.model_order)
        & F.col("error_min").isNotNull()
    )
    bin_of = F.width_bucket("error_min", F.lit(low), F.lit(high), F.lit(inner)).cast("int")
    counts = errors.groupBy(F.col("model_name").alias("model"), bin_of.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    spine = counts.select("model").distinct().select(
        "model", F.explode(F.sequence(F.lit(0), F.lit(inner + 1))).alias("bin")
    )
    filled = spine.join(counts, ["model", "bin"], "left").withColumn(
        "rows", F.coalesce("rows", F.lit(0).cast("bigint"))
    )
    # The open bins have no middle; they lie beyond the near-zero band on their side.
    middle = F.lit(low) + (F.col("bin") - F.lit(0.5)) * F.lit(step)
    side = (
        F.when((F.col("bin") == 0) | (middle < -NEAR_ZERO), "under")
        .when((F.col("bin") == inner + 1) | (middle > NEAR_ZERO), "over")
        .otherwise("zero")
    )
    of_model = W.partitionBy("model")
    return filled.select(
        "model",
        "bin",
        F.when(F.col("bin") > 0, F.lit(low) + (F.col("bin") - 1) * F.lit(step)).alias("bin_low"),
        F.when(F.col("bin") <= inner, F.lit(low) + F.col("bin") * F.lit(step)).alias("bin_high"),
        "rows",
        (F.col("rows") * 100.0 / F.sum("rows").over(of_model)).alias("share_pct"),
        side.alias("side"),
    )


def shared_scale(histogram: DataFrame) -> DataFrame:
    """Highest bin over all models."""
    return histogram.agg(F.max("rows").alias("max_rows"))


def hardest_units(backtest: DataFrame, limit: int = HARDEST) -> DataFrame:
    """Units with the highest mean absolute error; equal errors are ordered by key."""
    per_unit = backtest.groupBy(*UNIT_KEY).agg(
        F.avg(F.abs("error_min")).alias("mae"),
        F.count(F.lit(1)).alias("slots"),
        F.min_by("ride_name", "ts_local").alias("ride_name"),
    )
    tip = F.concat(
        F.col("ride_name"), F.lit(" ("), F.col("park_name"), F.lit("): MAE "),
        F.format_number("mae", 1), F.lit(" min over "), F.format_number("slots", 0),
        F.lit(" test slots"),
    )
    return (
        per_unit.orderBy(F.col("mae").desc(), *UNIT_KEY)
        .limit(limit)
        .select(*UNIT_KEY, text.shorten(F.col("ride_name")).alias("label"), "mae", "slots",
                tip.alias("tooltip"))
    )


def provenance_strip(kpis: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: run, status, forecast window, model, training and publication time.

    The status is that of the predictions: a fallback restamps only them.
    """
    fc = F.col("row_kind") == "forecast"
    head = predictions.agg(
        F.min("run_status").alias("run_status"),
        F.min("generated_at").alias("generated_at"),
        F.min("model_trained_at").alias("model_trained_at"),
        F.min(F.when(fc, F.col("ts_local"))).alias("first"),
        F.max(F.when(fc, F.col("ts_local"))).alias("last"),
    )
    status = value_label(F.col("run_status"), STATUS_LABELS, "neutral")
    return head.withColumn("_status", status).select(
        kpis.agg(F.min("run_id")).scalar().alias("run_id"),
        F.col("_status.label").alias("status_label"),
        F.col("_status.class").alias("status_class"),
        F.concat(
            clock.day_label(F.col("first")), F.lit(" to "), F.date_format("last", "MMM dd, yyyy")
        ).alias("window"),
        serving_model(kpis).alias("model"),
        clock.iso_text_label(F.col("model_trained_at")).alias("trained"),
        clock.minute_label(F.col("generated_at")).alias("published"),
    )

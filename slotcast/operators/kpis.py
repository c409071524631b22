"""Error metrics per model, the KPI table, and the promotion decision.

A scored row carries the test row plus ``model``, ``yhat``, ``lo`` and ``hi``; ``yhat`` is
null where the model does not know the entity. Metrics use the unclipped prediction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.config import KPI_NAMES, Settings
from slotcast.functions.numbers import is_finite, pct
from slotcast.operators.features import with_entity


def flag_high(rows: DataFrame, high: DataFrame) -> DataFrame:
    """Mark rows of high-wait entities."""
    flags = high.select("entity", F.lit(True).alias("_high"))
    return (
        with_entity(rows)
        .join(flags, "entity", "left")
        .withColumn("is_high", F.coalesce("_high", F.lit(False)))
        .drop("_high", "entity")
    )


def compute_kpis(scored: DataFrame, settings: Settings) -> DataFrame:
    """The nine metrics of every model in one aggregation over all scored rows.

    Each model is measured on the rows it answered; ``coverage_pct`` tells how many. Only
    sums and counts per model leave a task, whatever the number of rows.
    """
    err = F.col("yhat") - F.col("wait_time")
    size = F.abs(err)
    hour = F.hour("ts_local")
    start, end = settings.peak_hours
    peak = (hour >= start) & (hour < end)
    return scored.groupBy("model").agg(
        F.avg(size).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        pct(size > settings.severe_miss).alias("pct_severe_miss"),
        pct(size <= settings.within).alias("pct_within_10min"),
        F.avg(err).alias("bias"),
        F.avg(F.when(F.col("is_high"), size)).alias("high_wait_mae"),
        F.avg(F.when(peak, size)).alias("peak_hours_mae"),
        (F.count("yhat") / F.count(F.lit(1)) * 100).alias("coverage_pct"),
        F.count("yhat").cast("double").alias("test_rows"),
    )


def build_kpi_table(
    kpis: DataFrame, serving: str, trained_at: dict[str, str] | None = None
) -> DataFrame:
    """Wide to long, with the serving flag and each model's training time (or '')."""
    stamp = F.lit("")
    for model, when in (trained_at or {}).items():
        stamp = F.when(F.col("model") == model, F.lit(when)).otherwise(stamp)
    return kpis.unpivot(["model"], list(KPI_NAMES), "kpi_name", "kpi_value").select(
        "model",
        "kpi_name",
        "kpi_value",
        (F.col("model") == serving).alias("is_serving"),
        stamp.alias("trained_at"),
    )


def best_candidate(kpis: DataFrame, settings: Settings) -> DataFrame:
    """One row: the candidate with the lowest MAE (ties by list order), and if it is usable."""
    names = F.array(*(F.lit(m) for m in settings.candidates))
    rank = F.struct(F.col("mae"), F.array_position(names, F.col("model")))
    return (
        kpis.where(F.col("model").isin(*settings.candidates) & F.col("mae").isNotNull())
        .agg(F.min_by("model", rank).alias("model"), F.min("mae").alias("mae"))
        .withColumn("usable", is_finite(F.col("mae")) & (F.col("mae") > 0))
    )


def incumbent(kpi_table: DataFrame) -> DataFrame:
    """The serving model's MAE as published; no row on the first run.

    Should two models be marked as serving, the newest run counts, then the first name.
    """
    serving = kpi_table.where(F.col("is_serving") & (F.col("kpi_name") == "mae"))
    row = F.struct(F.col("model").alias("model_name"), F.col("kpi_value").alias("mae"), "run_id")
    newest = serving.agg(F.max("run_id")).scalar()
    of_run = serving.where(F.col("run_id").eqNullSafe(newest))
    return of_run.agg(F.min_by(row, "model").alias("row")).where("row IS NOT NULL").select("row.*")


def decide_promotion(best: DataFrame, previous: DataFrame, settings: Settings) -> DataFrame:
    """Ship without an incumbent, or when the new MAE is below its MAE times the factor."""
    old = previous.agg(F.first("mae")).scalar()
    limit = old * F.lit(settings.improvement_factor)
    ship = old.isNull() | (F.col("mae") < limit)
    percent = (1 - settings.improvement_factor) * 100
    reason = (
        F.when(old.isNull(), F.lit("no incumbent: the new model ships"))
        .when(
            F.col("mae") < limit,
            F.format_string(
                f"MAE %.3f improves on %.3f by more than {percent:g} percent (limit %.3f)",
                F.col("mae"), old, limit,
            ),
        )
        .otherwise(
            F.format_string(
                f"MAE %.3f is no improvement on %.3f by {percent:g} percent (limit %.3f): "
                "the incumbent stays",
                F.col("mae"), old, limit,
            )
        )
    )
    return best.select(
        "model", F.col("mae").alias("new_mae"), old.alias("old_mae"),
        limit.alias("limit"), ship.alias("ship"), reason.alias("reason"),
    )

"""Gold rows: the forecast grid, bound repair, backtest rows and provenance."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.config import Settings
from slotcast.functions import clock
from slotcast.functions.numbers import clip_low
from slotcast.operators.features import with_entity
from slotcast.operators.silver import site_table
from slotcast.schemas import KPI_CORE, PREDICTION_CORE


def slots_per_site(sites: DataFrame, settings: Settings) -> DataFrame:
    """Open slots of a site over the whole horizon."""
    per_hour = 60 // settings.grid_minutes
    hours = F.col("close_hour") - F.col("open_hour")
    return sites.select(
        "park_name", (hours * per_hour * settings.forecast_days).cast("bigint").alias("slots")
    )


def active_entities(silver: DataFrame) -> DataFrame:
    """Every entity of silver with the name and key of its latest slot."""
    # Two sites may clean to one entity; the struct breaks that tie the same way always.
    last = F.max_by(
        F.struct("park_name", "ride_key", "ride_name"),
        F.struct("ts_local", "park_name", "ride_key"),
    )
    return (
        with_entity(silver).groupBy("entity").agg(last.alias("_last")).select("entity", "_last.*")
    )


def covered_entities(entities: DataFrame, model_entities: DataFrame) -> DataFrame:
    return entities.join(model_entities.select("entity"), "entity", "left_semi")


def coverage_profile(entities: DataFrame, model_entities: DataFrame) -> DataFrame:
    """How many active entities the model answers for, and how many it drops."""
    known = model_entities.select("entity", F.lit(1).alias("_known"))
    return entities.join(known, "entity", "left").agg(
        F.count("_known").alias("covered"),
        (F.count(F.lit(1)) - F.count("_known")).alias("dropped"),
    )


def slot_sequence(start: Column, settings: Settings) -> Column:
    """All slots from the one after ``start`` to the end of the horizon, as an array."""
    step = F.expr(f"interval {settings.grid_minutes} minutes")
    first = clock.from_micros(
        F.floor(clock.micros(start + step) / F.lit(settings.grid_minutes * 60_000_000))
        * F.lit(settings.grid_minutes * 60_000_000)
    )
    return F.sequence(first, start + F.expr(f"interval {settings.forecast_days} days"), step)


def forecast_grid(
    entities: DataFrame, start: Column, settings: Settings, sites: DataFrame | None = None
) -> DataFrame:
    """Every entity with each open slot of its site.

    The slots are built and filtered inside the entity's own row, then exploded: one join
    with the site dimension, no cross product, and no shuffle of the result.
    """
    sites = site_table(entities.sparkSession, settings) if sites is None else sites

    def is_open(slot: Column) -> Column:
        return (F.hour(slot) >= F.col("open_hour")) & (F.hour(slot) < F.col("close_hour"))

    slots = F.filter(slot_sequence(start, settings), is_open)
    return entities.join(sites, "park_name").select(
        "entity", "park_name", "ride_key", "ride_name", F.explode(slots).alias("ts_local")
    )


def repaired_bounds(yhat: Column, lo: Column, hi: Column) -> dict[str, Column]:
    """Non-negative prediction with ``lower <= predicted <= upper``.

    A missing bound stays missing, for the checks to refuse; ``least`` and ``greatest`` would
    replace it.
    """
    predicted = clip_low(yhat)
    return {
        "predicted_wait_min": predicted,
        "lower_bound": F.when(lo.isNotNull(), F.least(clip_low(lo), predicted)),
        "upper_bound": F.when(hi.isNotNull(), F.greatest(hi, predicted)),
    }


def forecast_rows(scored: DataFrame, model: str, settings: Settings) -> DataFrame:
    """Scored grid rows in gold form; rows the model did not answer are dropped."""
    answered = scored.where(F.col("yhat").isNotNull())
    return answered.select(
        F.lit("forecast").alias("row_kind"),
        "park_name", "ride_key", "ride_name", "ts_local",
        clock.to_utc(F.col("ts_local"), settings.time_zone).alias("ts_utc"),
        *(
            value.alias(name)
            for name, value in repaired_bounds(F.col("yhat"), F.col("lo"), F.col("hi")).items()
        ),
        F.lit(None).cast("double").alias("actual_wait_min"),
        F.lit(None).cast("double").alias("error_min"),
        F.lit(model).alias("model_name"),
    ).select(*PREDICTION_CORE)


def backtest_rows(scored: DataFrame) -> DataFrame:
    """Answered test rows of every model. The error is that of the clipped prediction."""
    bounds = repaired_bounds(F.col("yhat"), F.col("lo"), F.col("hi"))
    return (
        scored.where(F.col("yhat").isNotNull())
        .withColumns(bounds)
        .select(
            F.lit("backtest").alias("row_kind"),
            "park_name", "ride_key", "ride_name", "ts_local", "ts_utc",
            "predicted_wait_min", "lower_bound", "upper_bound",
            F.col("wait_time").cast("double").alias("actual_wait_min"),
            (F.col("predicted_wait_min") - F.col("wait_time")).alias("error_min"),
            F.col("model").alias("model_name"),
        )
        .select(*PREDICTION_CORE)
    )


def stamp(
    df: DataFrame, run_id: str, status: str, generated_at: datetime, model_trained_at: str
) -> DataFrame:
    """Provenance: the run that trained the serving model, this run's status and time."""
    return df.withColumns(
        {
            "run_id": F.lit(run_id),
            "run_status": F.lit(status),
            "generated_at": clock.naive(generated_at),
            "model_trained_at": F.lit(model_trained_at),
        }
    )


def gold_union(forecast: DataFrame, *backtests: DataFrame) -> DataFrame:
    for part in backtests:
        forecast = forecast.unionByName(part)
    return forecast


def carry_forward(kpis: DataFrame, predictions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What stays true while the serving model stays: its KPIs and its backtest rows."""
    backtest = predictions.where(F.col("row_kind") == "backtest")
    return kpis.select(*KPI_CORE), backtest.select(*PREDICTION_CORE)


def replace_forecast(
    forecast: DataFrame,
    predictions: DataFrame | None,
    run_id: str,
    status: str,
    generated_at: datetime,
    model_trained_at: str,
) -> DataFrame:
    """A new forecast with the old backtest rows as they were, all under one stamp."""
    rows = forecast.select(*PREDICTION_CORE)
    if predictions is not None:
        old = predictions.where(F.col("row_kind") == "backtest").select(*PREDICTION_CORE)
        rows = rows.unionByName(old)
    return stamp(rows, run_id, status, generated_at, model_trained_at)


def row_counts(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count_if(F.col("row_kind") == "forecast").alias("forecast_rows"),
        F.count_if(F.col("row_kind") == "backtest").alias("backtest_rows"),
    )

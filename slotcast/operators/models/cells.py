"""Calendar cells and the pieces all model families share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.config import Settings
from slotcast.operators.features import with_entity


def sums(value: str = "wait_time") -> list[Column]:
    """Sufficient statistics of a least-squares fit within one cell."""
    x = F.col(value)
    return [
        F.count(x).alias("n"),
        F.sum(x).cast("double").alias("total"),
        F.sum(x * x).cast("double").alias("squares"),
    ]


def eligibility(train: DataFrame, settings: Settings) -> DataFrame:
    """Training rows per entity, and whether they are enough for a model of its own."""
    return (
        with_entity(train)
        .groupBy("entity")
        .agg(F.count("wait_time").alias("train_rows"))
        .withColumn("eligible", F.col("train_rows") >= settings.min_train_rows)
    )


def fit_report(eligible: DataFrame) -> DataFrame:
    return eligible.agg(
        F.count_if(F.col("eligible")).alias("fitted"),
        F.count_if(~F.col("eligible")).alias("skipped"),
    )


def residual_quantiles(scored: DataFrame, settings: Settings) -> DataFrame:
    """Per entity, the interval's quantiles of ``actual - yhat``, linearly interpolated.

    Exact. Silver has one row per entity and slot, so the values held for one entity are
    bounded by the slots of the training period (17,520 in a year of half hours).
    """
    low, high = settings.quantile_bounds
    residual = F.col("wait_time") - F.col("yhat")
    both = F.percentile(residual, F.array(F.lit(low), F.lit(high)))
    return (
        scored.where(F.col("yhat").isNotNull())
        .groupBy("entity")
        .agg(both.alias("_q"))
        .select("entity", F.col("_q")[0].alias("res_lo"), F.col("_q")[1].alias("res_hi"))
    )


def with_offsets(scored: DataFrame, offsets: DataFrame) -> DataFrame:
    """Bounds from residual quantiles; a missing offset counts as 0."""
    joined = scored.join(offsets, "entity", "left")
    return joined.withColumns(
        {
            "lo": F.col("yhat") + F.coalesce("res_lo", F.lit(0.0)),
            "hi": F.col("yhat") + F.coalesce("res_hi", F.lit(0.0)),
        }
    ).drop("res_lo", "res_hi")

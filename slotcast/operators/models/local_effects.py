"""Local calendar effects: one small model per entity, fitted in stages by Spark.

An entity's prediction is its mean plus effects of the hour, the weekday, the month and
holidays. Each stage takes the mean residual that the stages before have left, over the rows
with one value of its calendar feature, shrunk by ``local_shrinkage`` rows without any. The
stages run on calendar cells with counts and sums: an entity has no more of them than the
calendar (24 x 7 x 12 x 2), so one shuffle of cells carries all stages, and an entity with a
third of all rows costs as much as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slotcast.config import Settings
from slotcast.functions.holidays import is_holiday
from slotcast.operators.features import with_entity
from slotcast.operators.models import cells


def calendar(ts: Column) -> dict[str, Column]:
    """The feature of each stage, in order."""
    return {
        "hour": F.hour(ts),
        "weekday": F.weekday(ts),
        "month": F.month(ts),
        "holiday": is_holiday(F.to_date(ts)),
    }


def fit(train: DataFrame, settings: Settings) -> DataFrame:
    """entity, n, base, and a map of effects per stage; entities with too few rows have none."""
    stages = calendar(F.col("ts_local"))
    keys = [value.cast("int").alias(name) for name, value in stages.items()]
    rows = with_entity(train).groupBy("entity", *keys).agg(*cells.sums())
    own = W.partitionBy("entity")
    rows = rows.withColumn("rows", F.sum("n").over(own))
    rows = rows.withColumn("base", F.sum("total").over(own) / F.col("rows"))
    rows = rows.where(F.col("rows") >= settings.min_train_rows)
    rows = rows.withColumn("left", F.col("total") - F.col("n") * F.col("base"))
    for name in stages:
        by = W.partitionBy("entity", name)
        weight = F.sum("n").over(by) + F.lit(settings.local_shrinkage)
        rows = rows.withColumn(f"{name}_effect", F.sum("left").over(by) / weight)
        rows = rows.withColumn("left", F.col("left") - F.col("n") * F.col(f"{name}_effect"))
    # One pair for each value, as an effect depends on nothing else within its entity.
    maps = [
        F.map_from_entries(F.array_distinct(F.collect_list(F.struct(name, f"{name}_effect"))))
        .alias(name)
        for name in stages
    ]
    return rows.groupBy("entity").agg(F.first("rows").alias("n"), F.first("base").alias("base"), *maps)


def score(
    rows: DataFrame, params: DataFrame, settings: Settings, offsets: DataFrame | None = None
) -> DataFrame:
    """Predictions of known entities; a value the training rows lack has no effect."""
    stages = calendar(F.col("ts_local"))
    effects = [
        F.coalesce(F.try_element_at(F.col(f"_fit.{name}"), value.cast("int")), F.lit(0.0))
        for name, value in stages.items()
    ]
    fitted = params.select("entity", F.struct("base", *stages).alias("_fit"))
    yhat = sum(effects, F.col("_fit.base"))
    scored = with_entity(rows).join(fitted, "entity", "left").withColumn("yhat", yhat).drop("_fit")
    if offsets is None:
        return scored.withColumns({"lo": F.col("yhat"), "hi": F.col("yhat")})
    return cells.with_offsets(scored, offsets)

"""Historical mean per entity: the floor every candidate has to beat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.operators.features import with_entity


def fit(train: DataFrame) -> DataFrame:
    return (
        with_entity(train)
        .groupBy("entity")
        .agg(F.avg("wait_time").alias("mean_wait"), F.count("wait_time").alias("train_rows"))
    )


def score(rows: DataFrame, params: DataFrame) -> DataFrame:
    means = params.select("entity", "mean_wait")
    mean = F.col("mean_wait")
    return (
        with_entity(rows)
        .join(means, "entity", "left")
        .withColumns({"yhat": mean, "lo": mean, "hi": mean})
        .drop("mean_wait")
    )

"""Global boosted trees over site, unit and calendar, trained by MLlib on calendar cells.

A cell enters with its mean and, as weight, its row count: for squared loss that is the
same fit as on the rows, and every pass of the booster reads cells instead of rows.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.config import Settings
from slotcast.functions.ranking import with_row_index
from slotcast.operators.features import CALENDAR_FEATURES, build_features, with_entity
from slotcast.operators.models import cells
from slotcast.session import materialize, shared_root

CATEGORIES = ("park_name", "ride_key")
POSITIONS = ["hour", "minute", "dayofweek", "month", "is_holiday"]
#: Each tree runs a job per level, so small partitions cost more than they save.
CELLS_PER_PARTITION = 50_000
#: MLlib squares the number of bins in 32 bits.
MOST_BINS = 46_340


def category_index(train: DataFrame, column: str) -> DataFrame:
    """Pinned codes: the position of each training value in alphabetical order."""
    values = train.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    return with_row_index(values, ["value"], "code")


def apply_category(rows: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """Add the pinned code of a column; a value unseen in training has none."""
    pinned = codes.select(F.col("value").alias(column), F.col("code").alias(f"{column}_code"))
    return rows.join(pinned, column, "left")


def calendar_cells(train: DataFrame) -> DataFrame:
    """Counts and sums per site, unit and calendar position."""
    derived = [c for c in CALENDAR_FEATURES if c not in POSITIONS]
    grouped = build_features(train).groupBy(*CATEGORIES, *POSITIONS)
    # The derived features are functions of the position, so any of their values is theirs.
    return grouped.agg(*cells.sums(), *(F.first(c).alias(c) for c in derived)).withColumn(
        "label", F.col("total") / F.col("n")
    )


def fit(train: DataFrame, settings: Settings) -> PipelineModel:
    """Fit the pipeline. Site and unit enter as the mean of their training rows.

    For squared loss the best split of categories is a cut in the order of their means, so
    categories are split as one number, and no label reaches the driver. Bins follow the number of
    distinct means, so any two of them can be told apart; more than ``MOST_BINS`` are refused.
    """
    shared_root(train.sparkSession)
    params = settings.trees
    data = materialize(with_means(calendar_cells(train), unit_means(train)), "global-cells")
    # Row samples go by position, so a fixed order makes the fit repeatable.
    means = [f"{c}_mean" for c in CATEGORIES]
    size = data.agg(F.count(F.lit(1)).alias("n"), *(F.count_distinct(m).alias(m) for m in means)).first()
    few = data.coalesce(max(1, math.ceil(size["n"] / CELLS_PER_PARTITION)))
    few = few.sortWithinPartitions(*CATEGORIES, *POSITIONS)
    inputs = means + CALENDAR_FEATURES
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    # Each job of the booster ships the lineage of its input, so that is cut off here; a checkpoint
    # keeps partitions and their order.
    points = assembler.transform(few).select("features", "label", "n").checkpoint()
    booster = GBTRegressor(
        featuresCol="features",
        labelCol="label",
        weightCol="n",
        maxDepth=params.depth,
        maxIter=params.trees,
        stepSize=params.rate,
        subsamplingRate=params.row_sample,
        featureSubsetStrategy=str(params.column_sample),
        seed=params.seed,
        maxBins=bins_for(size["n"], max(size[m] for m in means)),
        checkpointInterval=10,
    )
    return PipelineModel([assembler, booster.fit(points)])


def bins_for(n_cells: int, distinct: int) -> int:
    """Bins that hold every distinct value of a feature.

    MLlib looks for thresholds in a sample of about bins * bins cells, so the square must cover
    all cells, or a unit of few cells might be left out.
    """
    bins = max(64, distinct + 1, math.isqrt(n_cells) + 1)
    if bins > MOST_BINS:
        raise ValueError(f"{bins} bins are needed to keep all units apart, {MOST_BINS} are possible")
    return bins


def unit_means(train: DataFrame) -> dict[str, DataFrame]:
    """Mean of each category's training rows, by column."""
    return {
        c: train.groupBy(c).agg(F.avg("wait_time").alias(f"{c}_mean")) for c in CATEGORIES
    }


def with_means(rows: DataFrame, means: dict[str, DataFrame]) -> DataFrame:
    for c in CATEGORIES:
        rows = rows.join(means[c], c, "left")
    return rows


def score(
    rows: DataFrame,
    model: PipelineModel,
    entities: DataFrame,
    offsets: DataFrame | None = None,
    *,
    means: dict[str, DataFrame],
) -> DataFrame:
    """Predictions for the rows of known entities, plus residual offsets as bounds."""
    keep = [*with_entity(rows).columns, "yhat"]
    known = entities.select("entity", F.lit(True).alias("_known"))
    data = build_features(with_entity(rows)).join(known, "entity", "left")
    data = with_means(data, means)
    scored = model.transform(data).withColumn("yhat", F.when(F.col("_known"), F.col("prediction")))
    scored = scored.select(*keep)
    if offsets is None:
        return scored.withColumns({"lo": F.col("yhat"), "hi": F.col("yhat")})
    return cells.with_offsets(scored, offsets)

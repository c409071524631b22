"""The bronze table: folders of one range of ids each, and a record of what was sent to them.

    <path>/id_range=<id div width>/part-*.parquet    observations, sorted by id
    <path>/_spans/                                    one row per append and range: lowest, highest id

Ids grow with time, so a transfer touches the last folders only. Everything that asks for ids names
the ranges they are in, which prunes the other folders before any file is opened. The record is
written before the rows it speaks of: what it does not name is not there, so a transfer of new
ids is appended without looking at bronze at all, while one that was cut off halfway finds
its spans and is compared with the rows that really arrived.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast.schemas import BRONZE, BRONZE_COLUMNS, ID_RANGE
from slotcast.session import materialize

STORED = T.StructType([*BRONZE.fields, T.StructField(ID_RANGE, T.LongType())])
SPANS = f"{ID_RANGE} bigint, low bigint, high bigint"


def range_of(value: Column, width: int) -> Column:
    return F.floor(value / F.lit(width)).cast("bigint")


class Bronze:
    """Bronze under ``path``, which every executor must reach; ``width`` is fixed for its life."""

    def __init__(self, spark: SparkSession, path: str, width: int):
        self.spark, self.path, self.width = spark, path.rstrip("/"), width

    def ensure(self) -> None:
        """An empty table if there is none."""
        empty = self.spark.createDataFrame([], STORED)
        empty.write.mode("ignore").partitionBy(ID_RANGE).parquet(self.path)

    def read(self) -> DataFrame:
        """All observations, with the range they are in."""
        return self.spark.read.schema(STORED).parquet(self.path)

    def newest_range(self) -> DataFrame:
        """Observations of the last folder: the highest id is in it, and no other is opened."""
        rows = self.read()
        return rows.where(F.col(ID_RANGE) == rows.agg(F.max(ID_RANGE)).scalar())

    def between(self, low: int | Column, high: int | Column) -> DataFrame:
        """Observations with ids from ``low`` to ``high``, from the folders that can hold them."""
        low, high = (F.lit(v) if isinstance(v, int) else v for v in (low, high))
        ranges = F.col(ID_RANGE).between(range_of(low, self.width), range_of(high, self.width))
        return self.read().where(ranges & F.col("wait_time_id").between(low, high))

    def spans(self) -> DataFrame:
        try:
            return self.spark.read.schema(SPANS).parquet(f"{self.path}/_spans")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SPANS)

    def may_hold(self, low: int, high: int) -> bool:
        """Whether any append so far was to write an id from ``low`` to ``high``."""
        ranges = F.col(ID_RANGE).between(low // self.width, high // self.width)
        met = self.spans().where(ranges & (F.col("low") <= high) & (F.col("high") >= low))
        return not met.isEmpty()

    def append(self, rows: DataFrame) -> None:
        """Add stamped rows as they are. They should be written somewhere, as they are read twice.

        A range shuffle on the id spreads a transfer within one folder over all tasks, and leaves
        each task with few folders.
        """
        keyed = rows.select(*BRONZE_COLUMNS).withColumn(
            ID_RANGE, range_of(F.col("wait_time_id"), self.width)
        )
        spans = keyed.groupBy(ID_RANGE).agg(
            F.min("wait_time_id").alias("low"), F.max("wait_time_id").alias("high")
        )
        spans.coalesce(1).write.mode("append").parquet(f"{self.path}/_spans")
        (
            keyed.repartitionByRange("wait_time_id")
            .sortWithinPartitions(ID_RANGE, "wait_time_id")
            .write.mode("append")
            .partitionBy(ID_RANGE)
            .parquet(self.path)
        )

    def merge(self, batch: DataFrame, low: int, high: int) -> None:
        """Append the rows of a stamped, written batch whose ids bronze does not hold.

        ``low`` and ``high`` are the batch's ids. Equal ids inside it are all kept; rows are
        never updated. Safe to repeat.
        """
        if self.may_hold(low, high):
            held = self.between(low, high).select("wait_time_id")
            fresh = batch.join(held, "wait_time_id", "left_anti").select(*batch.columns)
            batch = materialize(fresh, "fresh")
        self.append(batch)

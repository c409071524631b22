"""The upstream as a stream: its offsets are ids, its rows are the id ranges to transfer."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

# Spark plans a source in a worker that does not have the files of the application yet.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tasks that list the ranges of one batch; each may list many.
SLICES = 16


@dataclass
class Slice(InputPartition):
    low: int
    high: int


class IdRanges(DataSource):
    """Options: ``start`` (id the first run begins after), ``top`` (highest id), ``width``."""

    @classmethod
    def name(cls) -> str:
        return "id_ranges"

    def schema(self) -> str:
        return "low bigint, high bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return IdRangeReader(*(int(self.options[k]) for k in ("start", "top", "width")))


class IdRangeReader(DataSourceStreamReader):
    def __init__(self, start: int, top: int, width: int):
        self.start, self.top, self.width = start, top, width

    def initialOffset(self) -> dict:
        return {"id": min(self.start, self.top)}

    def latestOffset(self) -> dict:
        return {"id": self.top}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        """Slices of (start, end], cut where ranges are cut."""
        low, high = start["id"] + 1, end["id"]
        first, last = low // self.width, high // self.width
        step = max(1, -(-(last - first + 1) // SLICES)) * self.width
        cuts = range((first * self.width), high + 1, step) if low <= high else ()
        return [Slice(max(low, at), min(high, at + step - 1)) for at in cuts]

    def read(self, partition: Slice) -> Iterator[tuple[int, int]]:
        at = partition.low
        while at <= partition.high:
            end = min(partition.high, (at // self.width + 1) * self.width - 1)
            yield at, end
            at = end + 1


def drain_ids(
    spark: SparkSession,
    transfer: Callable[[int, int, int, int], None],
    start: int,
    top: int,
    width: int | None,
    checkpoint: str,
) -> StreamingQuery:
    """Call ``transfer(low, high, ranges, epoch)`` for all ids up to ``top`` that are not through.

    Where an earlier run stopped is in the checkpoint: a batch it began and did not finish comes
    again with the same ids, one it finished does not. Without a checkpoint it begins after
    ``start``, which is kept beside it: Spark asks a source again where its first batch began. What
    is due comes as one batch, so a backlog of any length is one parallel read.
    """
    spark.dataSource.register(IdRanges)
    began = f"{checkpoint}-start"
    spark.createDataFrame([(start,)], "start bigint").coalesce(1).write.mode("ignore").json(began)
    start = spark.read.schema("start bigint").json(began).first()["start"]
    options = {"start": start, "top": top, "width": width or max(top, 1)}

    def run(ranges: DataFrame, epoch: int) -> None:
        due = ranges.agg(F.min("low"), F.max("high"), F.count(F.lit(1))).first()
        if due[2]:
            transfer(due[0], due[1], due[2], epoch)

    return (
        spark.readStream.format("id_ranges")
        .options(**{k: str(v) for k, v in options.items()})
        .load()
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

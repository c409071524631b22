"""Helpers shared by the operators: reading tables and walking Arrow batches in bounded slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, under names of its own; null texts are empty."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def row_hash(doc_id: Column | str, text: Column | str) -> Column:
    """A key of a document that also tells apart rows without an id or with another's."""
    return F.xxhash64(doc_id, text)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: What a worker keeps between tasks: by key the stage that asked last, and the value.
_held: dict[Any, tuple[int | None, Any]] = {}


def _stage() -> int | None:
    context = TaskContext.get()
    return None if context is None else context.stageId()


def held(key: Any, make: Callable[[], Any]) -> Any:
    """A value that tasks of one stage share in a worker; ask for it before ``slices``.

    The first task of another stage that does not ask for it drops it, so that workers that are
    used again do not carry the memory of earlier operators along. What earlier stages held goes
    before a value is made, so the two are never held at once.
    """
    if key not in _held:
        _drop_held()
    value = _held[key][1] if key in _held else make()
    _held[key] = _stage(), value
    return value


def _drop_held() -> None:
    stage = _stage()
    old = [key for key, (asked, _) in _held.items() if asked != stage]
    for key in old:
        del _held[key]
    if old:
        pa.default_memory_pool().release_unused()


def slices(
    batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the values of ``column`` hold about ``max_bytes`` or are one row.

    Python objects made from a slice are then bounded by the longest text, not by the number
    of rows that Arrow happens to send at once.
    """
    _drop_held()
    for batch in batches:
        start, size = 0, 0
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        for row, length in enumerate(lengths):
            size += length or 0
            if size >= max_bytes:
                yield batch.slice(start, row + 1 - start)
                start, size = row + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)

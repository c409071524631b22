"""Global row numbers without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slotcast.session import materialize

# monotonically_increasing_id holds the partition number above bit 33.
_SHIFT = 33
_MASK = (1 << _SHIFT) - 1


def with_row_index(df: DataFrame, order: list[str], name: str = "row_index") -> DataFrame:
    """Add the position (from 0) of each row in ``order``.

    A window without partitions would sort everything in one task. Here one range shuffle
    sorts in parallel, the sorted rows are written once, and only the row count of each
    partition (one row per partition) is summed up to give the partition's first position.
    ``order`` must identify a row, so that equal keys cannot swap places.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    rows = materialize(ranged.withColumn("_mid", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_mid", _SHIFT)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the shuffle above, whatever the size of the data, so it is broadcast.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    first = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(first), "_part")
        .withColumn(name, F.col("_first") + F.col("_mid").bitwiseAND(F.lit(_MASK)))
        .drop("_mid", "_part", "_first")
    )

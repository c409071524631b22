"""A join whose hot keys are spread over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.session import materialize

SALT, HOT = "_salt", "_hot"


def hot_keys(left: DataFrame, key: str, share: int) -> DataFrame:
    """Keys with at least a ``share``-th of all rows: at most ``share`` of them, whatever the size.

    One hash aggregate over the key column, combined inside each task and written.
    """
    counts = materialize(left.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "key_counts")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    return counts.where(F.col("_n") * share >= total).select(key, F.lit(True).alias(HOT))


def salted(
    left: DataFrame, right: DataFrame, key: str, salts: int, share: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: rows of a hot key get one of ``salts`` on the left, all on the right.

    The salt follows from the row, so a task that runs again deals its rows as before.
    """
    hot = F.broadcast(hot_keys(left, key, share))
    own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    dealt = left.join(hot, key, "left").withColumn(
        SALT, F.when(F.col(HOT), own).otherwise(F.lit(0))
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = right.join(hot, key, "left").withColumn(
        SALT, F.explode(F.when(F.col(HOT), every).otherwise(F.array(F.lit(0))))
    )
    return dealt.drop(HOT), copies.drop(HOT)


def spread_join(
    left: DataFrame, right: DataFrame, key: str, salts: int = 32, share: int = 200
) -> DataFrame:
    """Inner join on ``key`` for a right side that is too large to broadcast.

    ``left`` may have any share of its rows on one key; on the right a key has few. Rows of a key
    with a ``share``-th of the left are dealt to ``salts`` tasks, so none gets more than about
    rows / salts of it. Sides are shuffled and merged, never broadcast but for the hot keys.
    """
    dealt, copies = salted(left, right, key, salts, share)
    return dealt.join(copies.hint("merge"), [key, SALT]).drop(SALT)

"""Ids that are listed, or may occur more than once, as a filter of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.session import materialize

#: Slots of one bitmap of ``bitmap_construct_agg``; slots per repeated id; bitmaps of 4 KB at most.
BLOCK_SLOTS, SLOTS_PER_ID, MOST_BLOCKS = 32768, 16, 16384


def repeated_words(rows: DataFrame, id_col: str) -> DataFrame:
    """word, bits: per run of 64 ids those that may occur twice; every id that does is among them.

    A run is one long that says which of its ids occur, one that says which occur oddly often,
    and a count. Where no id of it occurs more than twice, the repeats are exactly the ids that occur
    an even number of times; else all its ids count as repeated. So a task holds a row per run,
    neither one per id nor, for an id that fills the table, more than one.
    """
    own = F.col(id_col)
    bit = F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), own.bitwiseAND(F.lit(63)).cast("int")
    )
    runs = rows.where(own.isNotNull()).groupBy(F.shiftright(own, 6).alias("word")).agg(
        F.bit_or(bit).alias("any"), F.bit_xor(bit).alias("odd"), F.count(F.lit(1)).alias("n")
    )
    excess = F.col("n") - F.bit_count("any")
    even = F.col("any").bitwiseAND(F.bitwise_not("odd"))
    bits = F.when(excess == F.bit_count(even), even).otherwise(F.col("any"))
    return runs.where(excess > 0).select("word", bits.alias("bits"))


def _block(own: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(own, F.lit(0)), F.lit(blocks))


def _slot(own: Column) -> Column:
    return F.pmod(F.xxhash64(own, F.lit(1)), F.lit(BLOCK_SLOTS)).cast("int")


class Listed:
    """A filter that every id of ``ids`` (own; ``count`` of them) passes, and few others.

    Sixteen slots per id, at most 64 MB, so it is broadcast whatever the table: beyond 33 million
    ids more of the others pass, and no listed one is ever missed.
    """

    def __init__(self, ids: DataFrame, count: int):
        self.blocks = min(MOST_BLOCKS, max(1, -(-count * SLOTS_PER_ID // BLOCK_SLOTS)))
        bitmap = F.bitmap_construct_agg(_slot(F.col("own")).cast("bigint")).alias("bits")
        # Dealt by block before the bitmaps are built, so that no task sends half-filled ones.
        dealt = ids.select("own", _block(F.col("own"), self.blocks).alias("block"))
        self.bitmaps = materialize(
            dealt.repartition("block").groupBy("block").agg(bitmap), "id_filter"
        )

    def mark(self, rows: DataFrame, id_col: str, name: str) -> DataFrame:
        """``rows`` with a column that says whether the id may be listed; false for no id."""
        own = F.col(id_col).cast("bigint")
        slot = _slot(own)
        inner, taken = name, {c.lower() for c in rows.columns}
        while {f"{inner}_block".lower(), f"{inner}_bits".lower()} & taken:
            inner += "_"
        block, bits = f"{inner}_block", f"{inner}_bits"
        asked = rows.withColumn(block, _block(own, self.blocks))
        byte = F.conv(F.hex(F.substring(bits, F.shiftright(slot, 3) + 1, F.lit(1))), 16, 10)
        hit = F.getbit(byte.cast("int"), slot.bitwiseAND(F.lit(7))) == 1
        marked = asked.join(F.broadcast(self.bitmaps.toDF(block, bits)), block, "left")
        said = F.coalesce(hit & own.isNotNull(), F.lit(False))
        return marked.withColumn(name, said).drop(block, bits)


class Repeated:
    """A filter that every repeated id of ``rows`` passes, and few others."""

    def __init__(self, rows: DataFrame, id_col: str):
        words = materialize(repeated_words(rows, id_col), "repeated_ids")
        found = words.agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0))).first()[0]
        self.id_col = id_col
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(63).cast("bigint"))
        places = F.filter(every, lambda i: F.getbit("bits", i.cast("int")) == 1)
        place = words.select("word", F.explode(places).alias("place"))
        ids = place.select(F.shiftleft("word", 6).bitwiseOR(F.col("place")).alias("own"))
        self.listed = Listed(ids, found)

    def mark(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with a column that says whether the id may be repeated; false for no id."""
        return self.listed.mark(rows, self.id_col, name)

"""Exact duplicates by two passes over a Bloom filter, with DataFrame functions only (operator 12).

Texts are equal when they are identical after each run of white space became one space; a row
carries the SHA-256 digest of that form. The first pass counts how often each slot of a blocked
Bloom filter is hit: a digest names one block of 32,768 slots and ``hashes`` slots inside it.
Slots hit once say that a digest is alone, so only slots hit twice or more make the filter, one
bitmap a block. The second pass asks the filter for every row. A row that misses one of its slots
has no equal and passes straight through; the others, true repeats and about 1.4 % of the
rest at 16 slots a row, are grouped by their digest.

Texts never travel for a verdict: a row is its id, digest and number. The first shuffle holds one
count per distinct slot and task, so thousands of copies are one entry each. A filter takes two
bytes a row; it is broadcast while that stays under ``broadcast_bytes`` (33 million rows at 64 MB)
and joined by block beyond it, where these short rows travel, in ``keep_first`` whole ones. Groups
are counted inside each task first. Those with a thousandth of the suspected rows or more,
at most a thousand of them, are brought back by a broadcast, so that no key gathers in one task.

Defined cases: a null text counts as empty and equals an empty one. A null id is larger than any
other; a group of null ids keeps one of its rows and ``keep_id`` is null. Of rows repeated with id
and text one stays, whichever. An empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.llm.common import id_and_text
from slotcast.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
#: Slots of one bitmap of ``bitmap_construct_agg``, and its bytes.
BLOCK_SLOTS, BLOCK_BYTES = 32768, 4096
#: A group is hot from this share of the suspected rows on; so many groups are hot at most.
HOT_GROUPS = 1000


@dataclass(frozen=True)
class Bloom:
    slots_per_row: int = 16
    hashes: int = 2
    broadcast_bytes: int = 64 << 20


def fingerprint(text: Column | str) -> Column:
    """32 bytes that equal texts share."""
    return F.unhex(F.sha2(F.regexp_replace(text, SPACE, " "), 256))


def _slot(k: int) -> Column:
    return F.pmod(F.xxhash64("digest", F.lit(k + 1)), F.lit(BLOCK_SLOTS)).cast("int")


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("digest", F.lit(0)), F.lit(blocks))


def repeated_slots(prints: DataFrame, blocks: int, hashes: int) -> DataFrame:
    """block, bitmap of its slots that two or more rows of ``prints`` (digest) hit."""
    slots = F.array_distinct(F.array(*[_slot(k) for k in range(hashes)]))
    hits = (
        prints.select(_block(blocks).alias("block"), F.explode(slots).alias("slot"))
        .groupBy("block", "slot")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n >= 2")
    )
    # Dealt by block before the bitmaps are built, so that no task sends half-filled ones.
    bitmap = F.bitmap_construct_agg(F.col("slot").cast("bigint")).alias("bitmap")
    return hits.repartition("block").groupBy("block").agg(bitmap)


def _is_set(slot: Column) -> Column:
    byte = F.conv(F.hex(F.substring("bitmap", F.shiftright(slot, 3) + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), slot.bitwiseAND(F.lit(7))) == 1


class Suspects:
    """The filter over a table of digests, and what it lets through."""

    def __init__(self, prints: DataFrame, bloom: Bloom):
        self.blocks = max(1, -(-prints.count() * bloom.slots_per_row // BLOCK_SLOTS))
        self.hashes = bloom.hashes
        built = materialize(repeated_slots(prints, self.blocks, bloom.hashes), "bloom")
        small = self.blocks * BLOCK_BYTES <= bloom.broadcast_bytes
        self.bitmaps = F.broadcast(built) if small else built

    def split(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows (with a digest) that are alone, and those that may have an equal."""
        asked = rows.withColumn("block", _block(self.blocks)).join(self.bitmaps, "block", "left")
        hit = reduce(Column.__and__, [_is_set(_slot(k)) for k in range(self.hashes)])
        marked = asked.withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("block", "bitmap")
        return marked.where(~F.col("maybe")).drop("maybe"), marked.where("maybe").drop("maybe")


def _groups(suspects: DataFrame) -> DataFrame:
    """digest, first (id and row that stay), group_size. Only suspected rows are ever sorted here."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    return suspects.groupBy("digest").agg(
        first.alias("first"), F.count(F.lit(1)).alias("group_size")
    )


def _with_groups(rows: DataFrame, groups: DataFrame, n_suspects: int) -> DataFrame:
    """Join ``groups`` to ``rows`` by digest; the few large groups come by a broadcast."""
    is_hot = F.col("group_size") * HOT_GROUPS >= n_suspects
    hot = F.broadcast(groups.where(is_hot))
    rest = rows.join(hot.select("digest"), "digest", "left_anti")
    return rows.join(hot, "digest").unionByName(rest.join(groups.where(~is_hot), "digest"))


def exact_duplicates(
    docs: DataFrame, bloom: Bloom = Bloom(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest (binary): a row per row of ``docs``."""
    own = id_and_text(docs, id_col, text_col)
    rows = materialize(
        own.select(
            "doc_id",
            fingerprint("text").alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "prints",
    )
    alone, maybe = Suspects(rows, bloom).split(rows)
    suspects = materialize(maybe, "suspects")
    groups = materialize(_groups(suspects), "groups")
    judged = _with_groups(suspects, groups, suspects.count())
    return alone.select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "digest",
    ).unionByName(
        judged.select(
            "doc_id",
            F.col("first.doc_id").alias("keep_id"),
            "group_size",
            (F.col("row") == F.col("first.row")).alias("kept"),
            "digest",
        )
    )


def keep_first(
    docs: DataFrame, bloom: Bloom = Bloom(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows without an equal never leave their task; of the others only those with the id that stays
    travel with their text.
    """
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        fingerprint(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("digest"),
        F.lit(0).alias("row"),
    )
    prints = materialize(own.select("doc_id", "digest", "row"), "prints")
    found = Suspects(prints, bloom)
    suspects = materialize(found.split(prints)[1], "suspects")
    groups = materialize(_groups(suspects), "groups")
    alone, maybe = found.split(own)
    kept = (
        _with_groups(maybe, groups, suspects.count())
        .where(F.col("doc_id").eqNullSafe(F.col("first.doc_id")))
        .dropDuplicates(["digest"])
    )
    return alone.select("doc.*").unionByName(kept.select("doc.*"))

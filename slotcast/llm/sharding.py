"""Contiguous shards of nearly equal bytes (operator 9), with DataFrame functions only.

Documents with equal texts are one group that is never split. Groups are ordered by their
smallest id, and the smallest feasible capacity is found by binary search: a capacity is feasible
if filling shards greedily in order needs no more shards than there are. The running sums of the
groups stay distributed. The driver fills shards on an outline of them of at most ``CELLS`` rows,
and asks for a finer outline of the places that leave the answer open, until it is exact.

A group larger than an equal share gets a shard of its own and leaves the others an equal
share of the rest. At most ``shards`` such groups can exist, so that list is bounded.

Defined cases: a null text counts as empty (size 16). Null ids come first, repeated rows are rows
of their own in the same shard, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotcast.functions.ranking import with_row_index
from slotcast.session import materialize

OVERHEAD = 16
CELLS = 40_000


def _running_sums(groups: DataFrame) -> DataFrame:
    """Add ``upto``: bytes of all groups up to and with this one, in order."""
    ranged = groups.repartitionByRange("first", "key").sortWithinPartitions("first", "key")
    placed = materialize(ranged.withColumn("_mid", F.monotonically_increasing_id()), "groups")
    placed = placed.withColumn("_part", F.shiftright("_mid", 33))
    sums = placed.groupBy("_part").agg(F.sum("bytes").alias("_sum"))
    # One row per partition of the range shuffle.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.join(first, "_part")
        .withColumn("upto", F.sum("bytes").over(within) + F.col("_first"))
        .drop("_part", "_mid", "_first")
    )


class Outline:
    """What the driver knows of the running sums: cells with their least, largest and count.

    Where a greedy filling stops is then known exactly or between two bounds, and both bounds
    grow with the capacity. So a binary search bounds the smallest feasible capacity from both
    sides; where the sides differ, the cells in question are outlined again more finely. Every
    look holds at most ``CELLS`` rows, whatever the number of groups.
    """

    def __init__(self, sums: DataFrame, total: int, shards: int):
        self.sums, self.total, self.shards = sums, total, shards
        self.low = self.top = self.count = np.zeros(0, np.int64)
        self._look([(0, total)])

    def _look(self, spans: list[tuple[int, int]]) -> None:
        each = max(2, CELLS // len(spans))
        cell = F.lit(None).cast("bigint")
        for k, (a, b) in enumerate(spans):
            width = max(1, -(-(b + 1 - a) // each))
            inside = F.col("upto").between(a, b)
            place = F.expr(f"(upto - {a}L) div {width}L") + F.lit(k * (each + 1))
            cell = F.when(inside, place).otherwise(cell)
        near = reduce(or_, [F.col("upto").between(a, b) for a, b in spans])
        rows = (
            self.sums.where(near)
            .groupBy(cell.alias("cell"))
            .agg(F.min("upto").alias("a"), F.max("upto").alias("b"), F.count("upto").alias("n"))
            .select("a", "b", "n")
            .collect()
        )
        keep = np.ones(len(self.low), bool)
        for a, b in spans:
            keep &= (self.top < a) | (self.low > b)
        found = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 3)
        parts = (self.low, self.top, self.count)
        joined = [np.concatenate([old[keep], found[:, k]]) for k, old in enumerate(parts)]
        order = np.argsort(joined[0])
        self.low, self.top, self.count = (x[order] for x in joined)

    def _stop(self, target: int, upper: bool) -> int:
        """A bound on the largest running sum up to ``target``."""
        at = int(np.searchsorted(self.low, target, "right")) - 1
        if at < 0:
            return 0
        if target >= self.top[at]:
            return int(self.top[at])
        return target if upper and self.count[at] > 2 else int(self.low[at])

    def fill(self, capacity: int, upper: bool) -> list[int] | None:
        """Ends of the shards of the greedy filling, or None if shards run out."""
        ends, at = [], 0
        for _ in range(self.shards):
            at = self._stop(at + capacity, upper) if at + capacity < self.total else self.total
            ends.append(at)
            if at == self.total:
                return ends
        return None

    def _least(self, low: int, high: int, upper: bool) -> int:
        while low < high:
            middle = (low + high) // 2
            if self.fill(middle, upper) is None:
                low = middle + 1
            else:
                high = middle
        return low

    def smallest(self, low: int, high: int) -> list[int]:
        """Ends of the shards at the smallest feasible capacity; ``high`` must be feasible."""
        while True:
            low, high = self._least(low, high, True), self._least(low, high, False)
            first, last = self.fill(low, False), self.fill(high, True)
            ends = self.fill(high, False) or []
            if low == high and ends == last:
                return ends
            self._look(self._doubtful(low, high, first or [], last or []))

    def _doubtful(self, low: int, high: int, first: list[int], last: list[int]) -> list:
        """Spans of cells in which some capacity in question may stop."""
        if not first:
            first, at = [], 0
            for _ in range(self.shards):
                at = self._stop(min(at + low, self.total), False)
                first.append(at)
        spans: list[tuple[int, int]] = []
        for a, b in zip([0, *first], [0, *last], strict=False):
            i = max(0, int(np.searchsorted(self.low, min(a + low, self.total), "right")) - 1)
            j = max(i, int(np.searchsorted(self.low, min(b + high, self.total), "right")) - 1)
            if self.count[i : j + 1].max() > 2:
                span = int(self.low[i]), int(self.top[j])
                if spans and span[0] <= spans[-1][1]:
                    span = spans.pop()[0], max(span[1], self.top[j])
                spans.append((int(span[0]), int(span[1])))
        return spans


def assign(
    docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, group_first, shard, slot."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = materialize(
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            (F.octet_length(text) + F.lit(OVERHEAD)).cast("bigint").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("key"),
        ),
        "sizes",
    )
    groups = materialize(
        base.groupBy("key").agg(
            F.min("doc_id").alias("first"),
            F.sum("size").alias("bytes"),
            F.count(F.lit(1)).alias("n"),
        ),
        "groups",
    )
    whole = groups.agg(F.sum("bytes").alias("total")).first()
    left, open_shards = whole["total"] or 0, shards
    giants = []
    # No more than ``shards`` groups can be larger than an equal share.
    for row in groups.orderBy(F.desc("bytes"), "first", "key").limit(shards).collect():
        if open_shards < 2 or row["bytes"] * open_shards <= left:
            break
        giants.append(bytes(row["key"]))
        left, open_shards = left - row["bytes"], open_shards - 1
    own_shard = F.lit(None).cast("int")
    for place, key in enumerate(giants):
        own_shard = F.when(F.col("key") == F.lit(key), open_shards + place).otherwise(own_shard)
    marked = groups.withColumn("own", own_shard)
    rest = marked.where(F.col("own").isNull())
    sums = materialize(_running_sums(rest), "ordered")
    ends: list[int] = []
    if left:
        largest = sums.agg(F.max("bytes")).first()[0]
        low = max(-(-left // open_shards), largest)
        ends = Outline(sums, left, open_shards).smallest(low, low + largest)
    # A group belongs to the shard after all ends that lie before its own running sum.
    passed = [F.when(F.col("upto") > e, 1).otherwise(0) for e in ends]
    shard = sum(passed, F.lit(0)).cast("int")
    placed = sums.select("key", "first", shard.alias("shard")).unionByName(
        marked.where(F.col("own").isNotNull()).select("key", "first", F.col("own").alias("shard"))
    )
    rows = base.join(placed, "key")
    order = ["shard", "first", "key", "doc_id"]
    ranked = with_row_index(rows, order, "_row")
    # One row per shard.
    starts = {r["shard"]: r["s"] for r in rows.groupBy("shard").agg(F.count(F.lit(1)).alias("s")).collect()}
    before, begin = 0, F.lit(0).cast("bigint")
    for number in sorted(starts):
        begin = F.when(F.col("shard") == number, F.lit(before).cast("bigint")).otherwise(begin)
        before += starts[number]
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("first").alias("group_first"),
        "shard",
        (F.col("_row") - begin).alias("slot"),
    )

"""Hard negatives by bounds along spanning trees of anchors (operator 11).

Anchors are cut into trees of ``TREE`` near ones (sorted by label and by the signs of their first
components), each a minimum spanning tree over Euclidean distance. A candidate's score at an anchor
is at most ``edge * norm`` away from its score at the parent, ``norm`` being the candidate's, so the
walk carries an interval per candidate from the root down and computes an inner product only where
the interval meets a window that the anchor still needs: a score that can be among the best of its
label, or among the best negatives inside the share of a positive's score. Where a score was
computed the interval is a point again. The root hangs at the origin, where all scores are 0.

Two walks over all rows: the first finds the positives of each anchor, the second, with their
scores, the negatives. Trees of at most ``HELD_BYTES`` go to the tasks together; candidates are
dealt evenly to tasks of about ``TASK_ROWS`` whatever their labels, and a task answers with a few
rows an anchor, which Spark ranks. So no label and no common vector gathers anywhere. Work is
anchors times rows by definition of the search; only the inner products are saved.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no
part. Shorter vectors count as followed by zeros, an empty one is a zero vector. Components are
floored after scaling, scores are exact. Repeated rows are rows each, also as positives of each
other; an anchor is not its own positive. A null id comes after all others (the largest long
stands for it inside and cannot be an id). An anchor without positives or without negatives in
the window has no rows. Inner products beyond 2^56 raise an error. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slotcast.functions.ranking import with_row_index
from slotcast.session import materialize

TREE = 1024
HELD_BYTES = 32 << 20
TASK_ROWS = 16384
SLICE_ROWS = 4096
SIGNS = 24
NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Mining:
    """How many positives and negatives, and the window in percent of the positive's score."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256


def prepare(vectors: DataFrame, anchors: Column, scale: int, names: tuple[str, str, str]) -> DataFrame:
    """row, id, label, q (whole components), is_anchor of the rows that take part."""
    id_col, vector_col, label_col = (F.col(f"`{c}`") for c in names)
    own = vectors.select(
        F.coalesce(id_col.cast("bigint"), F.lit(int(NO_ID))).alias("id"),
        label_col.cast("bigint").alias("label"),
        vector_col.cast("array<double>").alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return own.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        "label",
        F.transform("vector", lambda x: F.floor(x * scale)).alias("q"),
        "is_anchor",
    )


def _matrix(column: pa.Array | pa.ChunkedArray, width: int, exact: str) -> np.ndarray:
    """Lists as rows of one array, shorter ones followed by zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lengths), width), exact)
    if len(values):
        rows = np.repeat(np.arange(len(lengths)), lengths)
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[rows, np.arange(len(values)) - first] = values
    return out


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent (-1 at the first point) and edge length of a minimum spanning tree, by Prim."""
    n = len(points)
    squared = (points * points).sum(1)
    near, parent = np.full(n, np.inf), np.full(n, -1)
    left, at = np.ones(n, bool), 0
    edge = np.zeros(n)
    for _ in range(n - 1):
        left[at] = False
        gap = np.maximum(squared[at] + squared - 2 * (points @ points[at]), 0)
        closer = left & (gap < near)
        near[closer], parent[closer] = gap[closer], at
        at = int(np.argmin(np.where(left, near, np.inf)))
        edge[at] = np.sqrt(near[at])
    edge[0] = np.sqrt(squared[0]) if n else 0
    return parent, edge


def walk_order(parent: np.ndarray) -> list[int]:
    """Parents first, heaviest child last, so that few nodes wait for children at a time."""
    below: list[list[int]] = [[] for _ in parent]
    for node, up in enumerate(parent):
        if up >= 0:
            below[up].append(node)
    order, stack = [], [0] if len(parent) else []
    while stack:
        order.append(stack.pop())
        stack.extend(below[order[-1]])
    weight = np.ones(len(parent), np.int64)
    for node in reversed(order):
        if parent[node] >= 0:
            weight[parent[node]] += weight[node]
    order, stack = [], [0] if len(parent) else []
    while stack:
        order.append(stack.pop())
        stack.extend(sorted(below[order[-1]], key=lambda c: -weight[c]))
    return order


def plant(anchors: DataFrame, width: int) -> DataFrame:
    """Trees, a row per anchor: tree, place, up (place of the parent), edge, row, id, label, q."""
    signs = F.transform(F.slice("q", 1, SIGNS), lambda x: F.when(x < 0, "0").otherwise("1"))
    sorted_ = with_row_index(
        anchors.withColumn("signs", F.array_join(signs, "")), ["label", "signs", "row"], "nth"
    )
    cut = sorted_.select(F.floor(F.col("nth") / TREE).alias("tree"), "row", "id", "label", "q")

    def grow(table: pa.Table) -> pa.Table:
        points = _matrix(table.column("q"), width, "float64")
        parent, edge = spanning_tree(points)
        order = walk_order(parent)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        up = np.where(parent >= 0, place[parent], -1)
        out = table.append_column("place", pa.array(place))
        return out.append_column("up", pa.array(up)).append_column("edge", pa.array(edge))

    return cut.groupBy("tree").applyInArrow(
        grow,
        "tree bigint, row bigint, id bigint, label bigint, q array<bigint>, "
        "place bigint, up bigint, edge double",
    )


class Best:
    """The best ``keep`` (score, id) seen so far; higher scores first, then smaller ids."""

    __slots__ = ("keep", "scores", "ids")

    def __init__(self, keep: int):
        self.keep = keep
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)

    def floor(self) -> float:
        return self.scores[-1] if len(self.scores) == self.keep else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        take = scores >= self.floor()
        if take.any():
            scores = np.concatenate([self.scores, scores[take]])
            ids = np.concatenate([self.ids, ids[take]])
            first = np.lexsort((ids, -scores))[: self.keep]
            self.scores, self.ids = scores[first], ids[first]


class Positives:
    """What an anchor looks for among rows of its label."""

    def __init__(self, anchor, how: Mining):
        self.row, self.label = anchor.row, anchor.label
        self.found = [Best(how.positives)]

    def wanted(self, rows, low, high):
        own = (rows.label == self.label) & (rows.row != self.row)
        return own & (high >= self.found[0].floor())

    def add(self, scores, ids):
        self.found[0].add(scores, ids)


class Negatives:
    """What an anchor looks for among rows of other labels: one window per positive."""

    def __init__(self, anchor, how: Mining):
        self.label = anchor.label
        scores = np.asarray(anchor.scores, np.int64)
        self.bottom = -(-how.low * scores // 100)
        self.top = how.high * scores // 100
        self.found = [Best(how.negatives) for _ in scores]

    def wanted(self, rows, low, high):
        meets = np.zeros(len(low), bool)
        for bottom, top, best in zip(self.bottom, self.top, self.found, strict=True):
            if bottom <= top:
                meets |= (high >= max(bottom, best.floor())) & (low <= top)
        return meets & (rows.label != self.label)

    def add(self, scores, ids):
        for bottom, top, best in zip(self.bottom, self.top, self.found, strict=True):
            inside = (scores >= bottom) & (scores <= top)
            best.add(scores[inside], ids[inside])


class Rows:
    def __init__(self, batch: pa.RecordBatch, width: int, exact: str):
        self.row = batch.column("row").to_numpy()
        self.id = batch.column("id").to_numpy()
        self.label = batch.column("label").to_numpy()
        self.q = _matrix(batch.column("q"), width, exact)
        # Computed a little too long rather than too short.
        self.norm = np.sqrt((self.q.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)


def descend(tree: pd.DataFrame, points: np.ndarray, rows: Rows, seeks: list) -> int:
    """Walk one tree for a slice of rows; how many inner products it took."""
    waiting = {}
    children = np.bincount(tree.up[tree.up >= 0], minlength=len(tree))
    computed = 0
    at_origin = np.zeros(len(rows.norm))
    for place, (up, edge) in enumerate(zip(tree.up, tree.edge, strict=True)):
        low, high = waiting[up] if up >= 0 else (at_origin, at_origin)
        reach = edge * rows.norm * (1 + 1e-9) + 1
        low, high = low - reach, high + reach
        if up >= 0:
            children[up] -= 1
            if not children[up]:
                del waiting[up]
        need = np.flatnonzero(seeks[place].wanted(rows, low, high))
        if len(need):
            part = rows.q[need] if len(need) < len(low) else rows.q
            scores = part @ points[place]
            low[need] = high[need] = scores
            seeks[place].add(scores.astype(np.int64), rows.id[need])
            computed += len(need)
        if children[place]:
            waiting[place] = low, high
    return computed


def _search(candidates: DataFrame, trees: pd.DataFrame, seek: type, how: Mining, width: int,
            exact: str) -> DataFrame:
    """anchor (row), window, score, id: the best of each task."""
    held = candidates.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown = []
        for _, tree in held.value.sort_values(["tree", "place"]).groupby("tree", sort=False):
            tree = tree.reset_index(drop=True)
            points = np.zeros((len(tree), width), exact)
            for k, q in enumerate(tree.q):
                points[k, : len(q)] = q
            seeks = [seek(anchor, how) for anchor in tree.itertuples()]
            grown.append((tree, points, seeks))
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                rows = Rows(batch.slice(start, SLICE_ROWS), width, exact)
                for tree, points, seeks in grown:
                    descend(tree, points, rows, seeks)
        for tree, _, seeks in grown:
            out = [
                (row, window, best.scores, best.ids)
                for row, sought in zip(tree.row, seeks, strict=True)
                for window, best in enumerate(sought.found)
                if len(best.scores)
            ]
            if out:
                sizes = [len(x[2]) for x in out]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([x[0] for x in out], sizes)),
                        pa.array(np.repeat([x[1] for x in out], sizes)),
                        pa.array(np.concatenate([x[2] for x in out])),
                        pa.array(np.concatenate([x[3] for x in out])),
                    ],
                    names=["anchor", "window", "score", "id"],
                )

    return candidates.mapInArrow(run, "anchor bigint, window bigint, score bigint, id bigint")


def _ranked(found: DataFrame, keep: int, label: str) -> DataFrame:
    order = W.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    return materialize(ranked, label)


def mine(
    vectors: DataFrame,
    anchors: Column,
    how: Mining = Mining(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` says which rows are searched for; every row is a candidate.
    """
    spark = vectors.sparkSession
    rows = materialize(prepare(vectors, anchors, how.scale, (id_col, vector_col, label_col)), "vectors")
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    n, width, longest = rows.agg(
        F.count(F.lit(1)), F.max(F.size("q")), F.max(square)
    ).first()
    width, longest = width or 0, longest or 0.0
    if longest >= 2.0**56:
        raise ValueError("inner products beyond 2^56")
    exact = "float64" if longest < 2.0**52 else "int64"

    trees = materialize(plant(rows.where("is_anchor").drop("is_anchor"), width), "trees")
    n_trees = (trees.agg(F.max("tree")).first()[0] or 0) + 1
    held = max(1, HELD_BYTES // (TREE * max(width, 1) * 8))
    dealt = rows.drop("is_anchor").repartition(max(1, -(-n // TASK_ROWS)))
    found = []
    for start in range(0, n_trees, held):
        own = trees.where(F.col("tree").between(start, start + held - 1))
        near = own.toPandas()
        positives = _ranked(
            _search(dealt, near, Positives, how, width, exact), how.positives, "positives"
        )
        # The trees of one call and their few positives: bounded by HELD_BYTES.
        scores = positives.groupBy("anchor").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"])
            .alias("scores")
        )
        sought = near.merge(scores.toPandas(), "left", left_on="row", right_on="anchor")
        sought["scores"] = [[] if s is None or np.isscalar(s) else list(s) for s in sought["scores"]]
        negatives = _ranked(
            _search(dealt, sought, Negatives, how, width, exact), how.negatives, "negatives"
        )
        a, p, g = own.alias("a"), positives.alias("p"), negatives.alias("g")
        found.append(
            g.join(p, (F.col("p.anchor") == F.col("g.anchor"))
                   & (F.col("p.rank") == F.col("g.window") + 1))
            .join(a, F.col("a.row") == F.col("g.anchor"))
            .select(
                *[F.when(F.col(f"{t}.id") < int(NO_ID), F.col(f"{t}.id")).alias(name)
                  for t, name in (("a", "anchor_id"), ("p", "positive_id"), ("g", "negative_id"))],
                F.col("g.rank").alias("rank"),
                F.col("p.score").alias("positive_score"),
                F.col("g.score").alias("negative_score"),
            )
        )
    return reduce(DataFrame.unionByName, found).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )

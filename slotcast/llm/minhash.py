"""Near duplicates of documents by fast similarity sketching (operator 4).

A document is its set of word windows. Sketch: in each round every element of a set is hashed to
one bin and leaves a value that begins with the number of the round; the least value stays.
Random rounds go on until all bins are filled, and after as many rounds as there are bins, fixed
rounds put every element into one given bin each. So every coordinate is filled, the work is
about bins * log(bins) + set size, and agreement of coordinates is concentrated around the
similarity as closely as with as many independent hash functions.

Documents with equal sets are one class with one representative. Bands of coordinates name
candidate buckets of representatives. Links are confirmed on full sets, in rounds that never
list all pairs of a bucket:

1. each representative against the smallest one it meets in any bucket;
2. in ``HUBS`` turns each member outside of the largest component of a bucket against one member
   of that, another one in each turn;
3. sets that still meet another component in a bucket, by a prefix filter over their windows
   (``_possible``), unless the sketches (``Scheme.least_equal``) rule out the similarity.

After 1 and 2 a group of near copies is one component or a few, so 3 is left with stragglers; it
is there to lose no link. Components are joined by contraction of edges in written tables, so
nothing but counts reaches the driver.

Defined cases: a text without words, or null, has no windows, is linked with nothing and kept. A
text with fewer words than a window is one window. A null id takes part only through its
class: it gets the class's component and is kept if there is none. Repeated rows have equal
sets and one component; each row is returned. An empty table gives an empty result. Columns
other than the two named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slotcast.functions.idfilter import Listed
from slotcast.llm.common import id_and_text, row_hash, slices, unused
from slotcast.llm.words import find_words, mix
from slotcast.session import materialize

SLICE = 1 << 20
HUBS = 4
_EMPTY = np.uint64((1 << 64) - 1)


@dataclass(frozen=True)
class Scheme:
    """Windows of ``words`` words; linked at ``percent`` similarity; a pair at 80 percent shares
    no band with probability 5e-6."""

    words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6

    @property
    def least_equal(self) -> int:
        """Coordinates in which two sets at the threshold agree but for a chance of 1e-6."""
        bins, p = self.bands * self.rows, self.percent / 100
        return int(bins * p - 4.75 * (bins * p * (1 - p)) ** 0.5)


def window_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the windows of each text."""
    words = find_words(texts)
    hashes = words.hashes(lower=True)
    at, joined = words.windows(hashes, k)
    bounds = np.searchsorted(at, words.first)
    sets = []
    for text, count in enumerate(words.per_text):
        if count >= k:
            own = np.sort(joined[bounds[text] : bounds[text + 1]])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif count:
            short = np.full(1, count, np.uint64)
            for h in hashes[words.first[text] : words.first[text + 1]]:
                short = mix(short + h)
            own = short
        else:
            own = np.zeros(0, np.uint64)
        sets.append(own)
    return sets


def sketch(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of ``bins`` coordinates per set; rows of empty sets mean nothing."""
    out = np.full((len(sets), bins), _EMPTY)
    flat = out.reshape(-1)
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    base = np.repeat(np.arange(len(sets)) * bins, [len(s) for s in sets])
    for turn in range(2 * bins):
        hashed = mix(element + np.uint64((0x632BE59BD9B4E019 * (turn + 1)) & (1 << 64) - 1))
        if turn < bins:
            place = (((hashed >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
        else:
            place = turn - bins
        value = (np.uint64(turn) << np.uint64(54)) | (mix(hashed) >> np.uint64(10))
        np.minimum.at(flat, base + place, value)
        open_rows = (out == _EMPTY).any(axis=1)
        still = open_rows[base // bins]
        if not still.any():
            break
        if not still.all():
            element, base = element[still], base[still]
    return out


def _sketches(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, row, n (set size), d1, d2 (digest of the set), keys (one per band)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            sets = window_sets(part.column("text"), scheme.words)
            rows = sketch(sets, scheme.bands * scheme.rows)
            rows = rows.reshape(len(sets), scheme.bands, scheme.rows)
            keys = np.tile(np.arange(scheme.bands, dtype=np.uint64), (len(sets), 1))
            for r in range(scheme.rows):
                keys = mix(keys + rows[:, :, r])
            digest = np.frombuffer(
                b"".join(hashlib.sha256(s.tobytes()).digest()[:16] for s in sets), np.int64
            ).reshape(-1, 2)
            ends = np.arange(len(sets) + 1, dtype=np.int32) * scheme.bands
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("row"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digest[:, 0]),
                    pa.array(digest[:, 1]),
                    pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(keys.reshape(-1).view(np.int64))
                    ),
                ],
                names=["doc_id", "row", "n", "d1", "d2", "keys"],
            )

    schema = "doc_id bigint, row bigint, n bigint, d1 bigint, d2 bigint, keys array<bigint>"
    return docs.mapInArrow(run, schema)


def _sets(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """node, members (the set), marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            sets = window_sets(part.column("text"), scheme.words)
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            # A byte of each coordinate, eight to a number.
            rows = sketch(sets, scheme.bands * scheme.rows)
            marks = np.ascontiguousarray(rows.astype(np.uint8)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1, dtype=np.int32) * marks.shape[1]),
                        pa.array(marks.reshape(-1)),
                    ),
                ],
                names=["node", "members", "marks"],
            )

    return docs.mapInArrow(run, "node bigint, members array<bigint>, marks array<bigint>")


def _equal_marks(a: str, b: str) -> Column:
    """In how many coordinates the marks of two sketches agree (and, rarely, in more)."""

    def differing(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift)).bitwiseAND(F.lit(mask))
        return F.bit_count(bits)

    total = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda held, n: held + n)
    return 8 * F.size(a) - total


def _confirmed(pairs: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Sketches first rule out what they can, so that full sets are fetched for likely pairs only.
    """
    marks = sets.select("node", "marks")
    near = (
        pairs.join(marks.toDF("a", "ma"), "a")
        .join(marks.toDF("b", "mb"), "b")
        .where(_equal_marks("ma", "mb") >= scheme.least_equal)
    )
    likely = materialize(near.select("a", "b").distinct(), "likely")
    used = materialize(likely.select("a").union(likely.select("b")).distinct().toDF("node"), "used")
    full = sets.select("node", "members").join(used, "node", "left_semi")
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    return (
        likely.join(full.toDF("a", "set_a"), "a")
        .join(full.toDF("b", "set_b"), "b")
        .where(100 * both >= scheme.percent * union)
        .select("a", "b")
        .distinct()
    )


def _possible(rest: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """Pairs (a, b) in different components that may be similar enough, by a prefix filter.

    The windows of each of the remaining sets are put in order, the rarest among them first. Two
    sets of n and m windows that are similar enough share one among the first
    n - ceil(percent * n) + 1 of either, and the first one they share leaves enough windows after
    it in both. So only these are indexed and joined, with sets of a size that allows the
    similarity; the bound is exact. Windows that one set alone has are counted and not indexed.
    """
    labels = rest.select("node", "label").distinct()
    own = materialize(sets.select("node", "members").join(labels, "node"), "own")
    windows = own.select(
        "node", "label", F.size("members").alias("size"), F.explode("members").alias("window")
    )
    holders = materialize(windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")), "holders")
    in_order = W.partitionBy("node").orderBy("n", "window")
    least = -F.floor(F.lit(-scheme.percent) * F.col("size") / F.lit(100))
    index = materialize(
        windows.join(holders, "window")
        .withColumn("place", F.row_number().over(in_order))
        .where((F.col("place") <= F.col("size") - least + 1) & (F.col("n") > 1))
        .select("window", "node", "label", "size", "place"),
        "prefixes",
    )
    a = index.toDF("window", "a", "la", "na", "pa")
    b = index.toDF("window", "b", "lb", "nb", "pb")
    left = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) + 1
    near = (F.col("a") < F.col("b")) & (F.col("la") != F.col("lb"))
    near &= (100 + scheme.percent) * left >= scheme.percent * (F.col("na") + F.col("nb"))
    near &= 100 * F.least("na", "nb") >= scheme.percent * F.greatest("na", "nb")
    return a.join(b, "window").where(near).select("a", "b").distinct()


class Components:
    """node -> smallest node reachable, kept as a table and contracted edge by edge."""

    def __init__(self, nodes: DataFrame):
        self.labels = nodes.select("node", F.col("node").alias("label"))

    def link(self, edges: DataFrame) -> bool:
        """Merge the components that ``edges`` (a, b) join; whether there were any."""
        a, b = self.labels.toDF("a", "la"), self.labels.toDF("b", "lb")
        now = edges.join(a, "a").join(b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
        linked = False
        while True:
            now = materialize(
                now.where("a <> b")
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .distinct(),
                "edges",
            )
            if now.isEmpty():
                return linked
            linked = True
            both = now.unionAll(now.select("b", "a"))
            up = both.groupBy(F.col("a").alias("old")).agg(F.min("b").alias("least"))
            step = materialize(up.select("old", F.least("old", "least").alias("new")), "parents")
            for _ in range(2):
                further = step.toDF("new", "top")
                step = step.join(further, "new", "left").select(
                    "old", F.coalesce("top", "new").alias("new")
                )
            step = materialize(step, "parents")
            named = step.toDF("label", "top")
            self.labels = materialize(
                self.labels.join(named, "label", "left").select(
                    "node", F.coalesce("top", "label").alias("label")
                ),
                "labels",
            )
            now = (
                now.join(step.toDF("a", "na"), "a")
                .join(step.toDF("b", "nb"), "b")
                .select(F.col("na").alias("a"), F.col("nb").alias("b"))
            )


def _shared_keys(members: DataFrame) -> DataFrame:
    """key, node, least (the smallest node of the key) of the keys that two nodes or more have.

    Most keys are of one node, so a map of all keys would hold a row for almost each of
    them. They are sorted instead, in the one shuffle that brings equal keys together.
    """
    same = W.partitionBy("key")
    met = members.select(
        "key", "node", F.min("node").over(same).alias("least"), F.max("node").over(same).alias("most")
    )
    return met.where("least < most").select("key", "node", "least").distinct()


def near_duplicates(
    docs: DataFrame, scheme: Scheme = Scheme(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, row (``row_hash`` of the row)."""
    own = id_and_text(docs, id_col, text_col).withColumn("row", row_hash("doc_id", "text"))
    rows = materialize(_sketches(own, scheme), "sketches")
    classes = materialize(
        rows.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("node")), "classes"
    )
    known = classes.where(F.col("node").isNotNull())
    members = materialize(
        rows.join(known, ["d1", "d2"])
        .where("doc_id = node")
        .select("node", F.explode("keys").alias("key")),
        "bands",
    )
    shared = materialize(_shared_keys(members), "buckets")
    nodes = materialize(shared.select("node").distinct(), "nodes")
    sets = materialize(
        _sets(own.join(nodes.toDF("doc_id"), "doc_id", "left_semi"), scheme), "sets"
    )
    found = Components(nodes)

    first = shared.groupBy("node").agg(F.min("least").alias("a"))
    pairs = materialize(first.where("a < node").select("a", F.col("node").alias("b")), "pairs")
    found.link(_confirmed(pairs, sets, scheme))

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.select("key", "node").join(found.labels, "node")

    for turn in range(HUBS):
        spread = materialize(labelled(shared), "spread")
        # One member of each component of a bucket, then that of the largest one.
        parts = spread.groupBy("key", "label").agg(
            F.count(F.lit(1)).alias("n"),
            F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("a"),
        )
        hubs = parts.groupBy("key").agg(
            F.max_by(
                F.struct("a", "n", F.col("label").alias("hub_label")), F.struct("n", "label")
            ).alias("hub"),
            F.count(F.lit(1)).alias("components"),
        )
        hubs = hubs.where("components > 1").select("key", "hub.*")
        # One hub for each member in a turn, that of its bucket with the largest component.
        pairs = spread.join(hubs, "key").where("label <> hub_label")
        pairs = pairs.groupBy("node").agg(F.max_by("a", F.struct("n", "a")).alias("a"))
        found.link(_confirmed(pairs.select("a", F.col("node").alias("b")), sets, scheme))

    spread = materialize(labelled(shared), "spread")
    mixed = spread.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1"))
    rest = spread.join(mixed.where("l0 < l1").select("key"), "key")
    pairs = _possible(materialize(rest, "rest"), sets, scheme)
    found.link(_confirmed(pairs, sets, scheme))

    named = classes.join(found.labels, "node", "left").select(
        "d1", "d2", F.coalesce("label", "node").alias("label")
    )
    return (
        rows.select("doc_id", "row", "n", "d1", "d2")
        .join(named, ["d1", "d2"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("label", "doc_id").alias("component_id"),
            F.col("doc_id").eqNullSafe(F.coalesce("label", "doc_id")).alias("kept"),
            "row",
        )
    )


def keep_first(
    docs: DataFrame, scheme: Scheme = Scheme(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component, with all its columns.

    Rows that stay and occur once never leave their task: a filter names the keys of the others,
    and only rows that it names are compared and travel with their text.
    """
    found = near_duplicates(docs, scheme, id_col, text_col)
    key, named = unused(docs, "row_key"), unused(docs, "row_named")
    verdict = materialize(
        found.groupBy(F.col("row").alias(key)).agg(
            F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n")
        ),
        "verdict",
    )
    away = verdict.where(~F.col("kept") | (F.col("n") > 1)).select(F.col(key).alias("own"))
    own = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumn(key, row_hash(F.col(id_col).cast("bigint"), own))
    marked = Listed(away, away.count()).mark(rows, key, named)
    compared = marked.where(named).join(verdict.where("kept").select(key), key, "left_semi")
    compared = compared.dropDuplicates([key])
    return marked.where(~F.col(named)).unionByName(compared).drop(key, named)

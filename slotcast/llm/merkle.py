"""Merkle manifest of a table: leaves, roots and a proof for every row (operator 13).

A leaf is the SHA-256 of a row's fields, each with its length. Leaves of a group stand in the
order of their ids; every two consecutive nodes become the hash of their hex digits, a last one
without a partner is hashed alone, until one node is left. The roots of the groups, in the order
of their names, make the last tree in the same way.

Leaves are numbered by one range shuffle and cut into aligned blocks of 256, so that no parent
has children in two blocks. A block keeps each of its eight levels as one string of hex digits:
the level above hashes its substrings of two digests, and the siblings of a leaf are the flanking
substrings of each level. The tops of the blocks are the leaves of the next round, which
has a 256th of the nodes, until every group has one block. On the way down, each block
hands what stands above it to its nodes. Rows travel as digests, never as texts; a block is the
largest thing that meets in one task, and a group with a third of all rows is just more blocks.

Defined cases: a null field is ``-``; a null group or id comes before all others. Rows with one id
stand in the order of their leaves, equal rows are leaves each. A table of one row has a leaf that
is its root, with no siblings. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.functions.ranking import with_row_index
from slotcast.session import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that a block holds, and its leaves.
LEVELS = 8
BLOCK = 1 << LEVELS
DIGITS = 64


def leaf(values: Sequence[Column]) -> Column:
    """Hash of the values, each as ``bytes:value`` or ``-``."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        size = F.octet_length(text).cast("string")
        return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(v) for v in values]), 256)


def _steps(depth: Column) -> Column:
    return F.slice(F.array(*[F.lit(k) for k in range(LEVELS)]), 1, depth)


def _parents(level: Column) -> Column:
    last = ((F.octet_length(level) - 1) / (2 * DIGITS)).cast("int")
    hashed = F.transform(
        F.sequence(F.lit(0), last),
        lambda k: F.sha2(F.substring(level, k * 2 * DIGITS + 1, F.lit(2 * DIGITS)), 256),
    )
    return F.array_join(hashed, "").cast("binary")


def _blocks(nodes: DataFrame, carried: Sequence[str]) -> DataFrame:
    """tree, block, size, entries (in order, with ``carried``), levels, top.

    ``nodes`` has tree, pos, size (nodes of its tree) and digest. A tree with more than one block
    climbs all levels of each, a tree with one only as far as two nodes remain.
    """
    entry = F.struct("pos", "digest", *carried)
    held = nodes.groupBy("tree", F.shiftright("pos", LEVELS).alias("block"), "size").agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )
    bits = F.when(F.col("size") > 1, F.length(F.bin(F.col("size") - 1))).otherwise(0)
    depth = F.when(F.col("size") > BLOCK, LEVELS).otherwise(bits)
    bottom = F.array_join(F.transform("entries", lambda e: e["digest"]), "").cast("binary")
    levels = F.aggregate(
        _steps(depth),
        F.array(bottom),
        lambda below, _: F.concat(below, F.array(_parents(F.element_at(below, -1)))),
    )
    return held.withColumn("levels", levels).select(
        "tree",
        "block",
        "size",
        F.transform(
            "entries", lambda e: F.struct(e["pos"].alias("pos"), *[e[c].alias(c) for c in carried])
        ).alias("entries"),
        "levels",
        F.element_at("levels", -1).cast("string").alias("top"),
    )


def _climb(nodes: DataFrame, largest: int, carried: Sequence[str]) -> list[DataFrame]:
    """Blocks of every round, written; the last round has one block a tree."""
    rounds: list[DataFrame] = []
    while True:
        rounds.append(materialize(_blocks(nodes, () if rounds else carried), "blocks"))
        if largest <= BLOCK:
            return rounds
        largest = -(-largest // BLOCK)
        nodes = rounds[-1].select(
            "tree",
            F.col("block").alias("pos"),
            F.ceil(F.col("size") / BLOCK).alias("size"),
            F.col("top").alias("digest"),
        )


def _flank(level: Column, at: Column) -> Column:
    """The other node of the run: side and digest, or nothing."""
    other = F.substring(level, at.bitwiseXOR(F.lit(1)) * DIGITS + 1, F.lit(DIGITS)).cast("string")
    side = F.when(at.bitwiseAND(F.lit(1)) == 1, "L").otherwise("R")
    return F.when(other == "", F.lit("")).otherwise(F.concat(side, other))


def _node(k: Column, carried: Sequence[str]) -> Column:
    """The node at place ``k`` of a block: pos, digest, its path inside the block."""
    own = F.transform(
        _steps(F.size("levels") - 1),
        lambda up: _flank(F.element_at("levels", up + 1), F.call_function("shiftright", k, up)),
    )
    digest = F.substring(F.element_at("levels", 1), k * DIGITS + 1, F.lit(DIGITS))
    entry = F.get("entries", k)
    return F.struct(
        entry["pos"].alias("pos"),
        digest.cast("string").alias("digest"),
        own.alias("own"),
        *[entry[c].alias(c) for c in carried],
    )


def _descend(rounds: list[DataFrame], above: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Every node of the first round with ``digest`` and the ``path`` from it to the root.

    ``above`` has tree, path and what else belongs to a tree.
    """
    kept = [c for c in above.columns if c not in ("tree", "path")]
    up = above.withColumn("block", F.lit(0).cast("bigint"))
    for depth in reversed(range(len(rounds))):
        names = carried if depth == 0 else ()
        held = rounds[depth].join(up, ["tree", "block"])

        nodes = F.transform(F.sequence(F.lit(0), F.size("entries") - 1), lambda k: _node(k, names))
        up = held.select("tree", "path", *kept, F.explode(nodes).alias("node")).select(
            "tree",
            F.col("node.pos").alias("block"),
            F.concat("node.own", "path").alias("path"),
            *kept,
            *([F.col("node.digest").alias("digest")] if depth == 0 else []),
            *[F.col(f"node.{c}").alias(c) for c in names],
        )
    return up


def folded(start: Column | str, path: Column | str) -> Column:
    """The root that a leaf and its path lead to."""

    def step(node: Column, other: Column) -> Column:
        digest = F.substring(other, 2, DIGITS)
        pair = F.when(other.startswith("L"), F.concat(digest, node)).otherwise(
            F.concat(node, digest)
        )
        return F.sha2(pair, 256)

    return F.aggregate(path, F.col(start) if isinstance(start, str) else start, step)


def siblings(path: Column | str) -> Column:
    """The digests of a path, one after the other."""
    return F.array_join(F.transform(path, lambda other: F.substring(other, 2, DIGITS)), "")


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    claim: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``order``, leaf, claimed, subroot, root, path: a row per row of ``docs``.

    ``path`` goes from the leaf to the root: at each level the other node with its side before it,
    ``L`` or ``R``, or an empty string where there is none. ``claimed`` is the leaf with the values
    of ``claim`` in place of the fields it names; ``folded`` shows whether a claim holds.
    """
    claim = claim or {}
    own = [F.col(f"`{c}`") for c in fields]
    claimed = [claim.get(c, value) for c, value in zip(fields, own, strict=True)]
    leaves = docs.select(
        F.col(f"`{group}`").cast("string").alias("tree_name"),
        F.col(f"`{order}`").cast("bigint").alias("id"),
        leaf(own).alias("leaf"),
        (leaf(claimed) if claim else F.lit(None).cast("string")).alias("claimed"),
        # Tells equal rows apart, so that many of them are dealt to many tasks.
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("claimed", F.when(F.col("claimed") != F.col("leaf"), F.col("claimed")))
    numbered = materialize(
        with_row_index(materialize(leaves, "leaves"), ["tree_name", "id", "leaf", "row"]), "numbered"
    )
    trees = materialize(
        numbered.groupBy("tree_name").agg(
            F.min("row_index").alias("tree"), F.count(F.lit(1)).alias("size")
        ),
        "trees",
    )
    largest, n_trees = trees.agg(F.max("size"), F.count(F.lit(1))).first()
    nodes = numbered.join(
        trees, numbered["tree_name"].eqNullSafe(trees["tree_name"])
    ).select(
        "tree",
        (F.col("row_index") - F.col("tree")).alias("pos"),
        "size",
        F.col("leaf").alias("digest"),
        "id",
        "claimed",
    )
    rounds = _climb(nodes, largest or 0, ("id", "claimed"))

    # A tree is named by the number of its first leaf, so trees are already in order.
    tops = rounds[-1].select(F.col("tree").alias("of"), F.col("top").alias("digest"))
    last = _climb(
        with_row_index(tops, ["of"], "pos").select(
            F.lit(0).cast("bigint").alias("tree"),
            "pos",
            F.lit(n_trees).cast("bigint").alias("size"),
            "digest",
            "of",
        ),
        n_trees,
        ("of",),
    )
    root = last[-1].select(
        "tree", F.array().cast("array<string>").alias("path"), F.col("top").alias("root")
    )
    above = _descend(last, root, ("of",)).select(
        F.col("of").alias("tree"), "path", F.col("digest").alias("subroot"), "root"
    )
    return _descend(rounds, above, ("id", "claimed")).select(
        F.col("id").alias(order),
        F.col("digest").alias("leaf"),
        F.coalesce("claimed", "digest").alias("claimed"),
        "subroot",
        "root",
        "path",
    )

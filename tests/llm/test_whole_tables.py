"""Exact duplicates, Merkle manifests and hard negatives against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotcast.llm import merkle, negatives
from slotcast.llm.exact_dedup import BLOCK_SLOTS, Bloom, Suspects, exact_duplicates, fingerprint
from slotcast.llm.exact_dedup import keep_first
from slotcast.llm.queries import op13_merkle
from tests.llm.helpers import corpus, frame, plain


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    long = "ab \t" * 300_000
    return [*corpus(), (80, long, "s1"), (81, long.replace("\t", "\n"), "s1"), (82, "a  b", "s1"),
            (83, "a\r\n b", None), (84, "a b", "s1"), (85, " a b", "s1")]


def same_texts(rows) -> dict[str, list]:
    groups = defaultdict(list)
    for doc, text, _ in rows:
        groups[sha(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""))].append(doc)
    return groups


def after_nulls(doc):
    return (doc is None, doc or 0)


@pytest.mark.parametrize("broadcast", [64 << 20, 0])
def test_exact_duplicates_equal_brute_force(spark, rows, broadcast):
    found = exact_duplicates(frame(spark, rows), Bloom(broadcast_bytes=broadcast))
    got = found.withColumn("digest", F.lower(F.hex("digest"))).collect()
    expected = []
    for digest, docs in same_texts(rows).items():
        docs = sorted(docs, key=after_nulls)
        expected += [(d, docs[0], len(docs), k == 0, digest) for k, d in enumerate(docs)]
    assert plain(got) == plain(expected)


def test_keep_first_keeps_whole_rows(spark, rows):
    docs = frame(spark, rows)
    left = keep_first(docs)
    assert left.columns == docs.columns
    expected = [min(docs_, key=after_nulls) for docs_ in same_texts(rows).values()]
    assert sorted((r.doc_id for r in left.collect()), key=after_nulls) == sorted(
        expected, key=after_nulls
    )


def test_filter_misses_no_repeat_and_passes_most_others(spark):
    texts = spark.range(40_000).select(
        F.when(F.col("id") < 5000, F.col("id") % 100).otherwise(F.col("id")).cast("string").alias("t")
    )
    prints = texts.select("t", fingerprint("t").alias("digest"))
    found = Suspects(prints, Bloom())
    assert found.blocks == -(-40_000 * 16 // BLOCK_SLOTS)
    alone, maybe = found.split(prints)
    assert alone.where("cast(t as long) < 100").count() == 0
    assert 5000 <= maybe.count() < 5000 + 0.03 * 35_000
    assert alone.count() + maybe.count() == 40_000


def test_rows_alone_are_not_shuffled(spark, rows):
    prints = frame(spark, rows).select(fingerprint(F.coalesce("text", F.lit(""))).alias("digest"))
    alone, _ = Suspects(prints, Bloom()).split(prints)
    plan = alone._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_exact_duplicates_of_nothing(spark):
    empty = frame(spark, [])
    assert exact_duplicates(empty).count() == 0 and keep_first(empty).count() == 0


def merkle_oracle(leaves: list[tuple]) -> dict:
    """(group, id, leaf) to per leaf: subroot, root, path; by recursion over whole lists."""

    def climb(nodes: list[str]) -> list[list[str]]:
        levels = [nodes]
        while len(levels[-1]) > 1:
            below = levels[-1]
            levels.append([sha("".join(below[k : k + 2])) for k in range(0, len(below), 2)])
        return levels

    def path(levels: list[list[str]], at: int) -> list[str]:
        out = []
        for level in levels[:-1]:
            other = at ^ 1
            out.append(("L" if at & 1 else "R") + level[other] if other < len(level) else "")
            at >>= 1
        return out

    groups = defaultdict(list)
    for group, doc, digest in leaves:
        groups[group].append((doc is not None, doc or 0, digest))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [climb([x[2] for x in sorted(groups[g])]) for g in names]
    top = climb([t[-1][0] for t in trees])
    out = []
    for k, (name, levels) in enumerate(zip(names, trees, strict=True)):
        for at, (known, doc, digest) in enumerate(sorted(groups[name])):
            steps = path(levels, at) + path(top, k)
            out.append((doc if known else None, digest, levels[-1][0], top[-1][0], tuple(steps)))
    return out


def framed(*values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def some_docs(rows) -> list[tuple]:
    langs = ["en", "de", None, "日本", "", "fr"]
    draw = random.Random(5)
    out = [
        (d, t, draw.choice(langs[:3]), s, draw.choice([None, len(t or ""), 7])) for d, t, s in rows
    ]
    return out + [(900, "only", "日本", "s", 1), (901, "x", "", "s", 1), (None, None, None, None, None)]


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest_equals_brute_force(spark, rows, levels, monkeypatch):
    """One and two levels a block make many rounds of few rows."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 1 << levels)
    docs = some_docs(rows)
    table = spark.createDataFrame(
        [(*d, "x", "y") for d in docs],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, "
        "leaf string",
    )
    got = merkle.manifest(table).withColumn("folded", merkle.folded("leaf", "path")).collect()
    expected = merkle_oracle([(l, d, framed(d, s, l, n, t)) for d, t, l, s, n in docs])
    assert plain((r.doc_id, r.leaf, r.subroot, r.root, tuple(r.path)) for r in got) == plain(expected)
    assert all(r.folded == r.root and r.claimed == r.leaf for r in got)


def test_tampered_rows_do_not_verify(spark, tmp_path, rows):
    docs = some_docs(rows)
    spark.createDataFrame(
        docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ).write.parquet(str(tmp_path / "documents.parquet"))
    got = op13_merkle(spark, str(tmp_path)).collect()
    assert len(got) == len(docs)
    moved = {
        d for d, _, _, _, n in docs
        if d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
    }
    assert moved and {r.doc_id for r in got if not r.verified} == moved
    root = got[0].root
    assert all((r.folded_root == root) == r.verified for r in got)


def test_manifest_of_one_row_and_of_none(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    one = merkle.manifest(spark.createDataFrame([(1, "a", "en", "s", 1)], schema)).collect()
    assert [(r.leaf == r.root == r.subroot, r.path) for r in one] == [(True, [])]
    assert merkle.manifest(spark.createDataFrame([], schema)).count() == 0


VECTORS = "vec_id bigint, embedding array<double>, label int, row string, q string, rank string"


def vectors(seed: int, n: int, width: int) -> list[tuple]:
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(4, width))
    common = list(map(float, centres[0] / 3))
    out = []
    for k in range(n):
        label = int(draw.integers(0, 4))
        x = centres[label] * draw.uniform(0, 1) + draw.normal(size=width) * 0.4
        out.append((k, common if k % 3 == 0 else [float(v) for v in x / 3], label, "", "", ""))
    bad = [float("nan"), float("inf"), -float("inf"), None]
    out += [(n + k, [v] + [0.1] * (width - 1), 1, "", "", "") for k, v in enumerate(bad)]
    out += [(n + 5, None, 1, "", "", ""), (n + 6, [0.1] * width, None, "", "", ""),
            (n + 7, [], 2, "", "", ""), (n + 8, [0.4, 0.2], 3, "", "", ""),
            (None, common, 0, "", "", ""), (None, [0.3] * width, 1, "", "", "")]
    return out + out[:1] + out[20:23] + [out[-1]]


def mined(rows: list[tuple], every: int) -> list[tuple]:
    last = float("inf")
    known = [
        (k, r[0], [math.floor(256 * x) for x in r[1]], r[2])
        for k, r in enumerate(rows)
        if r[1] is not None and r[2] is not None
        and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    order = lambda x: (-x[0], last if x[1] is None else x[1])
    out = []
    for at, anchor, q, label in known:
        if anchor is None or anchor % every:
            continue
        scores = [
            (sum(a * b for a, b in zip(q, c, strict=False)), i, own)
            for k, i, c, own in known if k != at
        ]
        for score, positive, _ in sorted((s for s in scores if s[2] == label), key=order)[:5]:
            inside = [
                s for s in scores if s[2] != label and 30 * score <= 100 * s[0] <= 90 * score
            ]
            for rank, (s, i, _) in enumerate(sorted(inside, key=order)[:10], 1):
                out.append((anchor, positive, rank, i, score, s))
    return out


@pytest.mark.parametrize("tree,held", [(1024, 32 << 20), (4, 1)])
def test_mining_equals_brute_force(spark, tree, held, monkeypatch):
    """Small trees and one tree a search, too."""
    monkeypatch.setattr(negatives, "TREE", tree)
    monkeypatch.setattr(negatives, "HELD_BYTES", held)
    rows = vectors(1, 400, 6)
    table = spark.createDataFrame(rows, VECTORS)
    got = negatives.mine(table, F.col("vec_id") % 25 == 0).collect()
    expected = mined(rows, 25)
    assert expected and plain(got) == plain(expected)


def test_mining_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert negatives.mine(empty, F.col("vec_id") % 2 == 0).count() == 0
    lonely = spark.createDataFrame([(0, [1.0], 1, "", "", "")], VECTORS)
    assert negatives.mine(lonely, F.col("vec_id") % 2 == 0).count() == 0


def test_large_components_are_exact_or_refused(spark):
    big = 2.0**19
    rows = [(k, [big + k, big - 3 * k], k % 2, "", "", "") for k in range(8)]
    table = spark.createDataFrame(rows, VECTORS)
    how = negatives.Mining(low=0, high=200)
    got = negatives.mine(table, F.col("vec_id") == 0, how).collect()
    scores = {
        (k, sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(rows[0][1], r[1], strict=True)))
        for k, r in enumerate(rows)
    }
    assert len(got) == 3 * 4 and {(r.negative_id, r.negative_score) for r in got} <= scores
    huge = spark.createDataFrame([(0, [1e30], 1, "", "", ""), (1, [1e30], 0, "", "", "")], VECTORS)
    with pytest.raises(ValueError, match="inner products"):
        negatives.mine(huge, F.col("vec_id") == 0)


def test_tree_bounds_save_inner_products():
    """Near anchors: a walk computes fewer products than all, and none of them is needed twice."""
    draw = np.random.default_rng(0)
    points = np.floor(256 * (draw.normal(size=(1, 16)) + 0.01 * draw.normal(size=(64, 16))))
    parent, edge = negatives.spanning_tree(points)
    order = negatives.walk_order(parent)
    assert sorted(order) == list(range(64))
    assert all(order.index(up) < order.index(k) for k, up in enumerate(parent) if up >= 0)
    place = np.argsort(order)
    import pandas as pd

    tree = pd.DataFrame(
        {"up": [place[parent[k]] if parent[k] >= 0 else -1 for k in order], "edge": edge[order],
         "label": 0, "row": -1, "scores": [[40_000]] * 64}
    )

    class Sample:
        q = np.floor(256 * draw.normal(size=(500, 16)))
        norm = np.sqrt((q**2).sum(1)) * (1 + 1e-9)
        label, row, id = np.ones(500), np.arange(500), np.arange(500)

    seeks = [negatives.Negatives(a, negatives.Mining()) for a in tree.itertuples()]
    computed = negatives.descend(tree, points[order], Sample, seeks)
    assert computed < 0.5 * 64 * 500
    for at, seek in zip(order, seeks, strict=True):
        scores = (Sample.q @ points[at]).astype(int)
        inside = sorted(((-s, k) for k, s in enumerate(scores) if 12_000 <= s <= 36_000))[:10]
        assert [(-s, k) for s, k in zip(seek.found[0].scores, seek.found[0].ids, strict=True)] == inside

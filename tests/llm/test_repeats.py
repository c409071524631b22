"""Operators 4 and 6 against brute force."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slotcast.llm import minhash, suffix_dedup
from slotcast.llm.suffixes import common_prefixes, suffix_array, words_at
from slotcast.session import DROP_SHUFFLES, materialize_and_drop

from .helpers import corpus, frame, plain


def shingles(text: str | None, k: int) -> frozenset:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[i:] for i in range(k)), strict=False))


def classes(rows, k):
    """Component of every row, by comparing all pairs."""
    sets = [shingles(t, k) for _, t, _ in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    return sets, label


@pytest.mark.parametrize("k", [2, 5])
def test_components(spark, k):
    rows = corpus()
    sets, label = classes(rows, k)
    want = []
    for (d, _, _), own, mine in zip(rows, sets, label, strict=True):
        ids = [r[0] for r, other in zip(rows, label, strict=True) if other == mine and r[0] is not None]
        smallest = min(ids, default=None) if own else d
        want.append((d, len(own), smallest, d == smallest))
    scheme = minhash.Scheme(words=k)
    got = minhash.near_duplicates(frame(spark, rows), scheme).drop("row").collect()
    assert plain(got) == plain(want)
    assert minhash.near_duplicates(frame(spark, []), scheme).count() == 0


def test_shared_keys_take_one_shuffle(spark):
    draw = random.Random(7)
    pairs = [(draw.randrange(60), draw.randrange(50)) for _ in range(80)]
    pairs += [(100, 5), (100, 5), (101, 9), (101, 2), (101, 2)]
    found = minhash._shared_keys(spark.createDataFrame(pairs, "node bigint, key bigint").select("node", "key"))
    nodes = {}
    for node, key in pairs:
        nodes.setdefault(key, set()).add(node)
    want = [(k, n, min(own)) for k, own in nodes.items() if len(own) > 1 for n in own]
    got = [tuple(r) for r in found.collect()]
    assert sorted(got) == sorted(want) and want
    assert found._jdf.queryExecution().sparkPlan().toString().count("Join") == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("+- == Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_the_prefix_filter_loses_no_pair(spark, percent):
    """Sets of many sizes around shared ones, each its own component."""
    draw, sets = random.Random(percent), []
    for base in range(12):
        core = [draw.randrange(400) for _ in range(draw.randint(1, 60))]
        for _ in range(9):
            rate = draw.choice([0, 0.02, 0.15])
            own = {w for w in core if draw.random() >= rate}
            own |= {draw.randrange(2000) for _ in range(draw.randint(0, 6) if rate else 0)}
            sets.append(own or {base})
    held = spark.createDataFrame(
        [(k, sorted(s)) for k, s in enumerate(sets)], "node bigint, members array<bigint>"
    )
    rest = spark.createDataFrame([(1, k, k) for k in range(len(sets))], "key int, node bigint, label bigint")
    found = minhash._possible(rest, held, minhash.Scheme(percent=percent)).collect()
    got = {(r.a, r.b) for r in found}
    near = {(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j])
            if 100 * len(a & b) >= percent * len(a | b)}
    assert near and near <= got and len(got) < len(sets) * (len(sets) - 1) // 2


def test_every_coordinate_is_filled_and_estimates_similarity():
    draw = np.random.default_rng(2)
    for size in (1, 3, 50, 2000):
        own = np.unique(draw.integers(0, 1 << 63, size, np.uint64))
        shared = own[: -(-4 * size // 5)]
        other = np.unique(np.concatenate([shared, draw.integers(0, 1 << 63, size // 5, np.uint64)]))
        a, b = minhash.sketch([own, other], 240)
        assert (a != minhash._EMPTY).all() and (b != minhash._EMPTY).all()
        true = len(np.intersect1d(own, other)) / len(np.union1d(own, other))
        assert abs((a == b).mean() - true) < 0.2


def test_keep_first_keeps_all_columns_and_one_row(spark):
    docs = frame(spark, corpus())
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and 41 not in ids and 53 not in ids and 70 in ids and 71 in ids


def brute_removed(rows, length):
    first = {}
    for d, t, _ in rows:
        raw, key = (t or "").encode(), suffix_dedup.LAST if d is None else d
        for i in range(len(raw) - length + 1):
            own = raw[i : i + length]
            first[own] = min(first.get(own, key), key)
    out = []
    for d, t, _ in rows:
        raw, key = (t or "").encode(), suffix_dedup.LAST if d is None else d
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < key:
                gone[i : i + length] = True
        spans = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if raw else 0
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]]) if raw else b""
        out.append((d, len(raw), spans, kept))
    return out


@pytest.mark.parametrize("hot", [2, 256])
def test_removed_bytes(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = corpus()
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    got = [(r.doc_id, r.n_bytes, len(r.removed), bytes(r.kept)) for r in got]
    assert plain(got) == plain(brute_removed(rows, 50))
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("hot", [2, 256])
def test_removed_bytes_over_many_buckets_and_bins(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = corpus()
    size = sum(len((t or "").encode()) for _, t, _ in rows)
    monkeypatch.setattr(suffix_dedup, "ANCHORS", size // 9)
    monkeypatch.setattr(suffix_dedup, "PIECES", size // 13)
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    got = [(r.doc_id, r.n_bytes, len(r.removed), bytes(r.kept)) for r in got]
    assert plain(got) == plain(brute_removed(rows, 50))


def test_buckets_make_a_row_for_each_bin_of_texts(spark, monkeypatch):
    """Rows of the two group steps follow buckets and bins, not texts times buckets or spans."""
    draw = random.Random(8)
    phrases = ["".join(draw.choices("abcdefghij ", k=70)) for _ in range(12)]
    lines = [[*draw.sample(phrases, 6), str(k) * 9] for k in range(300)]
    rows = [(k, "".join(p + str(draw.random()) for p in own), None) for k, own in enumerate(lines)]
    size = sum(len(t) for _, t, _ in rows)
    monkeypatch.setattr(suffix_dedup, "ANCHORS", size // 4)
    monkeypatch.setattr(suffix_dedup, "PIECES", size // 4)
    made = spark.sparkContext.accumulator(0)

    def counted(make):
        def outer(*args):
            inner = make(*args)

            def group(table: pa.Table) -> pa.Table:
                out = inner(table)
                made.add(out.num_rows)
                return out

            return group

        return outer

    monkeypatch.setattr(suffix_dedup, "_shared_of", counted(suffix_dedup._shared_of))
    monkeypatch.setattr(suffix_dedup, "_spans_of", counted(suffix_dedup._spans_of))
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    got = [(r.doc_id, r.n_bytes, len(r.removed), bytes(r.kept)) for r in got]
    assert plain(got) == plain(brute_removed(rows, 50))
    assert sum(r[2] for r in got) > 1500
    # Each step runs once or twice, over 5 buckets and 5 bins.
    assert 0 < made.value <= 4 * 5 * 5


def test_suffix_array_orders_prefixes():
    draw = random.Random(4)
    for alphabet in ("a", "ab", "abcdefgh"):
        text = np.frombuffer("".join(draw.choices(alphabet, k=900)).encode(), np.uint8)
        wanted = np.array([draw.random() < 0.7 for _ in text]) & (np.arange(900) < 850)
        words = words_at(text)
        order = suffix_array(text, wanted, words)
        raw = text.tobytes()
        prefixes = [raw[i : i + 50] for i in order]
        assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        assert prefixes == sorted(prefixes)
        same = common_prefixes(order, words, 50)
        assert same.tolist() == [a == b for a, b in zip(prefixes, prefixes[1:], strict=False)]


def test_short_texts_have_no_anchor():
    assert len(suffix_dedup.anchors(pa.array(["", "short"]), 50)[0]) == 0


def test_texts_that_share_less_than_half_a_string_share_no_anchor():
    draw = random.Random(3)
    short = ["".join(draw.choices("abcdefgh ", k=22)) for _ in range(40)]
    texts = ["".join(f"{p}{draw.random()}" for p in draw.sample(short, 40)) for _ in range(2)]
    found = [set(suffix_dedup.anchors(pa.array([t]), 50)[0].tolist()) for t in texts]
    assert min(map(len, found)) > 40 and not found[0] & found[1]
    longer = "".join(draw.choices("abcdefgh ", k=50))
    found = [set(suffix_dedup.anchors(pa.array([t + longer + t]), 50)[0].tolist()) for t in texts]
    assert found[0] & found[1]


def test_the_first_pass_moves_few_bytes_an_anchor(spark):
    """With a bucket for each anchor a text adds its hash to each, and nothing else."""
    draw = random.Random(5)
    texts = ["".join(draw.choices("abcdefgh ", k=2000)) for _ in range(20)]
    docs = spark.createDataFrame(
        [(k, k, 7 * k, t) for k, t in enumerate(texts)], "doc_id bigint, id bigint, row bigint, text string"
    )
    rows = suffix_dedup._runs(docs, 50, 1 << 16).collect()
    moved = sum(len(v) for r in rows for v in r if not isinstance(v, int))
    assert moved < 16 * len(suffix_dedup.anchors(pa.array(texts), 50)[0])


def test_texts_at_a_home_follow_the_table_within_bounds():
    assert [suffix_dedup.hot(n) for n in (0, 236_076, 1_000_000, 10**9)] == [4096, 4096, 15_625, 32_768]


def test_shuffle_files_go_with_their_step(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles().iterator()
        names = set()
        while found.hasNext():
            names.add(found.next().getName())
        return {n for n in names if n.startswith("shuffle_")}

    before, setting = files(), spark.conf.get(DROP_SHUFFLES, None)
    grouped = spark.range(10_000, numPartitions=4).groupBy((F.col("id") % 97).alias("k")).count()
    table = materialize_and_drop(grouped, "dropped")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert table.count() == 97 and spark.conf.get(DROP_SHUFFLES, None) == setting

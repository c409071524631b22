"""Benchmark decontamination (operator 1): BM25 retrieval of test items, then exact overlap.

The inverted index is over the test items; every passage of every training text is a query. A
passage is a window of twice the longest item, moved by half its length, so any run of words as
long as an item lies inside one. An impact is a term's BM25 weight in an item as a share of the
item's score for itself, so one threshold serves all items. Lists hold block maxima, and
``block_max_wand`` retrieves all items at or above the threshold.

Most passages are dismissed many at once by the same bound that WAND uses: in each item the
commonest terms, as long as their impacts stay under ``slack`` together, cannot bring it to the
threshold without ``threshold - slack`` from the others. Only passages in which some item gets
that much from its other terms are queried.

A retrieved item is confirmed on words: those in five-word windows shared with the passage must
make up ``overlap`` of the item, or ``part_overlap`` of its question (all sentences but the last)
and of its answer (the last one, if there are several). So an item without its short answer is found.

Items are indexed in blocks of ``block_items``, each broadcast (its size is bounded by that number
and checked against ``block_bytes``) and run against all texts. Term statistics are those of all
items.

Defined cases: null and empty texts have no passages and match nothing, items without words are
left out. Items shorter than five words must be found whole. Rows that repeat an id and an item are
reported once; a null id is kept. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.llm.common import id_and_text, row_hash, slices, unused
from slotcast.llm.words import Words, find_words
from slotcast.session import materialize

SLICE = 2 << 20
K1, B = 1.2, 0.75
WINDOW = 5
BLOCK = 64
_ALNUM = np.zeros(256, bool)
_ALNUM[0x80:] = True
_ALNUM[[c for c in range(0x80) if chr(c).isalnum()]] = True
_SENTENCE = re.compile(r"(?<=[.!?\n])\s+(?=\S)")


@dataclass(frozen=True)
class Rule:
    threshold: float = 0.6
    slack: float = 0.3
    overlap: float = 0.8
    part_overlap: float = 0.5
    block_items: int = 10_000
    block_bytes: int = 64 << 20


def _words(texts: pa.Array) -> Words:
    return find_words(pc.utf8_lower(texts.cast(pa.large_string())), _ALNUM)


@dataclass
class Item:
    name: int
    words: list[bytes]
    question: int  # number of leading words that form the question

    def windows(self) -> list[tuple[bytes, ...]]:
        k = min(WINDOW, len(self.words))
        return [tuple(self.words[i : i + k]) for i in range(len(self.words) - k + 1)]


def parse_item(name: int, text: str) -> Item:
    sentences = _SENTENCE.split(text.strip())
    head = " ".join(sentences[:-1]) if len(sentences) > 1 else text
    found = [_words(pa.array([part])) for part in (text, head)]
    words = [bytes(found[0].data[a:b]) for a, b in zip(found[0].start, found[0].end, strict=True)]
    question = len(found[1].start)
    return Item(name, words, question if question else len(words))


class Index:
    """Postings of a block of items, ordered by item, with maxima per list and per block."""

    def __init__(self, items: list[Item], df: dict[bytes, int], n_items: int, mean_words: float):
        self.items = items
        postings: dict[bytes, list[tuple[int, float]]] = {}
        for place, item in enumerate(items):
            norm = K1 * (1 - B + B * len(item.words) / max(mean_words, 1.0))
            impacts = {}
            for term in set(item.words):
                tf = item.words.count(term)
                idf = np.log(1 + (n_items - df[term] + 0.5) / (df[term] + 0.5))
                impacts[term] = idf * tf * (K1 + 1) / (tf + norm)
            total = sum(impacts.values())
            for term, impact in impacts.items():
                postings.setdefault(term, []).append((place, float(impact / total)))
        self.terms = sorted(postings)
        self.lists = [postings[t] for t in self.terms]
        self.places = [[p for p, _ in found] for found in self.lists]
        self.most = [max(w for _, w in found) for found in self.lists]
        self.block_most = [
            [max(w for _, w in found[i : i + BLOCK]) for i in range(0, len(found), BLOCK)]
            for found in self.lists
        ]
        longest = max(len(item.words) for item in items)
        self.stride = max(longest, WINDOW)

        blob = pa.array([b" ".join(self.terms)], pa.binary()).cast(pa.string())
        hashed = find_words(blob, _ALNUM).hashes(lower=False)
        order = np.argsort(hashed)
        self.hashes, self.term_of = hashed[order], order

    def essential(self, slack: float) -> None:
        """Split each item's postings by document frequency; keep what the rest leaves to reach."""
        per_item: list[list[tuple[int, int, float]]] = [[] for _ in self.items]
        for term, found in enumerate(self.lists):
            for place, impact in found:
                per_item[place].append((-len(found), term, impact))
        self.spare = np.zeros(len(self.items))
        kept: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for place, own in enumerate(per_item):
            for _, term, impact in sorted(own):
                if self.spare[place] + impact <= slack:
                    self.spare[place] += impact
                else:
                    kept[term].append((place, impact))
        self.first = np.cumsum([0, *map(len, kept)])
        flat = [pair for found in kept for pair in found]
        self.item = np.array([p for p, _ in flat], np.int64)
        self.impact = np.array([w for _, w in flat])


def block_max_wand(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All items (by place) whose impacts over ``terms`` sum to the threshold or more."""
    slack = threshold - 1e-9
    at = {t: 0 for t in terms}
    heap = [(index.places[t][0], t) for t in terms]
    heapq.heapify(heap)
    found = []
    while heap:
        # Lists in order of their next item, up to the pivot where the list maxima suffice.
        passed, bound = [], 0.0
        while heap and bound < slack:
            entry = heapq.heappop(heap)
            passed.append(entry)
            bound += index.most[entry[1]]
        if bound < slack:
            break
        pivot = passed[-1][0]
        while heap and heap[0][0] == pivot:
            passed.append(heapq.heappop(heap))
        tight, edge = 0.0, None
        for _, t in passed:
            places = index.places[t]
            while at[t] < len(places) and places[at[t]] < pivot:
                # Whole blocks that end before the pivot are skipped at once.
                last = min((at[t] // BLOCK + 1) * BLOCK, len(places)) - 1
                at[t] = last + 1 if places[last] < pivot else at[t] + 1
            if at[t] < len(places):
                block = at[t] // BLOCK
                tight += index.block_most[t][block]
                end = places[min((block + 1) * BLOCK, len(places)) - 1]
                edge = end if edge is None else min(edge, end)
        if tight >= slack:
            score = sum(
                index.lists[t][at[t]][1]
                for _, t in passed
                if at[t] < len(index.places[t]) and index.places[t][at[t]] == pivot
            )
            if score >= slack:
                found.append((pivot, score))
            target = pivot + 1
        else:
            # No item up to the nearest end of a block, or the next list's item, can reach it.
            target = (edge if edge is not None else pivot) + 1
            if heap:
                target = min(target, heap[0][0])
            target = max(target, pivot + 1)
        for _, t in passed:
            places = index.places[t]
            while at[t] < len(places) and places[at[t]] < target:
                at[t] += 1
            if at[t] < len(places):
                heapq.heappush(heap, (places[at[t]], t))
    return found


def overlaps(item: Item, passage: list[bytes]) -> tuple[float, float, float]:
    """Shares of the item, its question and its answer that lie in windows of the passage."""
    windows = item.windows()
    k = len(windows[0])
    there = set(zip(*(passage[i:] for i in range(k)), strict=False))
    held = np.zeros(len(item.words), bool)
    for place, window in enumerate(windows):
        if window in there:
            held[place : place + k] = True
    question, answer = held[: item.question], held[item.question :]
    return (
        float(held.mean()),
        float(question.mean()) if len(question) else 1.0,
        float(answer.mean()) if len(answer) else 1.0,
    )


def _candidates(index: Index, words: Words, rule: Rule) -> dict[int, list[int]]:
    """Windows to be queried, as text -> window numbers."""
    hashed = words.hashes(lower=False)
    spot = np.minimum(np.searchsorted(index.hashes, hashed), len(index.hashes) - 1)
    known = np.flatnonzero(index.hashes[spot] == hashed)
    term = index.term_of[spot[known]]
    listed = index.first[term + 1] > index.first[term]
    known, term = known[listed], term[listed]
    text = words.text_of_word()[known]
    window = (known - words.first[text]) // index.stride
    count = -(-words.per_text // index.stride)
    base = np.concatenate([[0], np.cumsum(count)])
    place = base[text] + window
    earlier = window > 0
    place = np.concatenate([place, place[earlier] - 1])
    term = np.concatenate([term, term[earlier]])
    pairs = np.unique(place * len(index.terms) + term)
    place, term = pairs // len(index.terms), pairs % len(index.terms)
    size = index.first[term + 1] - index.first[term]
    posting = np.repeat(index.first[term] - np.cumsum(size) + size, size) + np.arange(size.sum())
    key = np.repeat(place, size) * len(index.items) + index.item[posting]
    named, inverse = np.unique(key, return_inverse=True)
    score = np.bincount(inverse, index.impact[posting], len(named))
    enough = score + index.spare[named % len(index.items)] >= rule.threshold - 1e-9
    out: dict[int, list[int]] = {}
    for place in np.unique(named[enough] // len(index.items)):
        text = int(np.searchsorted(base, place, "right")) - 1
        out.setdefault(text, []).append(int(place - base[text]))
    return out


def _search(docs: DataFrame, index: Index, rule: Rule) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        number = {t: k for k, t in enumerate(index.terms)}
        for part in slices(batches, "text", SLICE):
            words = _words(part.column("text"))
            ids = part.column("doc_id").to_pylist()
            rows = []
            for text, windows in _candidates(index, words, rule).items():
                begin, end = words.first[text], words.first[text + 1]
                for window in windows:
                    a = begin + window * index.stride
                    b = min(a + 2 * index.stride, end)
                    own = [
                        bytes(words.data[i:j])
                        for i, j in zip(words.start[a:b], words.end[a:b], strict=True)
                    ]
                    terms = sorted({number[w] for w in own if w in number})
                    for place, score in block_max_wand(index, terms, rule.threshold):
                        whole, question, answer = overlaps(index.items[place], own)
                        if whole >= rule.overlap or min(question, answer) >= rule.part_overlap:
                            rows.append((ids[text], index.items[place].name, score, question, answer))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
            )

    return docs.mapInArrow(
        run,
        "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double",
    )


def _parsed(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            names, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
            found = [parse_item(n, t) for n, t in zip(names, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int64()),
                    pa.array([i.words for i in found], pa.list_(pa.binary())),
                    pa.array([i.question for i in found], pa.int64()),
                ],
                names=["item_id", "words", "question"],
            )

    return items.mapInArrow(run, "item_id bigint, words array<binary>, question bigint")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rule: Rule = Rule(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of each confirmed leak."""
    own = id_and_text(docs, id_col, text_col)
    items = _parsed(id_and_text(benchmark, item_col, item_text_col)).where(F.size("words") > 0)
    items = items.groupBy("item_id", "words", "question").agg(F.lit(1).alias("one"))
    size = items.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean")).first()
    frequency = items.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").count()
    blocks = max(1, -(-size["n"] // rule.block_items))
    block = F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks))
    out = None
    for number in range(blocks if size["n"] else 0):
        mine = items.where(block == number)
        weight = mine.agg(F.sum(F.aggregate("words", F.lit(0), lambda a, w: a + F.length(w)))).first()
        if (weight[0] or 0) > rule.block_bytes:
            raise ValueError("a block of items is too large to broadcast; lower block_items")
        rows = mine.collect()
        if not rows:
            continue
        terms = mine.select(F.explode("words").alias("word")).distinct()
        df = {bytes(r["word"]): r["count"] for r in frequency.join(terms, "word").collect()}
        listed = [Item(r["item_id"], [bytes(w) for w in r["words"]], r["question"]) for r in rows]
        listed.sort(key=lambda item: (item.name is None, item.name or 0, item.words))
        index = Index(listed, df, size["n"], size["mean"])
        index.essential(rule.slack)
        found = _search(own, index, rule)
        out = found if out is None else out.unionAll(found)
    if out is None:
        schema = (
            "doc_id bigint, item_id bigint, score double, question_overlap double, "
            "answer_overlap double"
        )
        return docs.sparkSession.createDataFrame([], schema)
    # Windows overlap and rows may repeat; the best window stands for the pair.
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def keep_unleaked(
    docs: DataFrame,
    benchmark: DataFrame,
    rule: Rule = Rule(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without a confirmed leak, with all their columns."""
    own = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = unused(docs, "row_key")
    rows = docs.withColumn(key, row_hash(F.col(id_col).cast("bigint"), own))
    keyed = rows.select(F.col(key).alias("doc_id"), F.col(text_col).alias("text"))
    found = leaks(keyed, benchmark, rule)
    spoiled = materialize(found.select(F.col("doc_id").alias(key)).distinct(), "leaks")
    return rows.join(spoiled, key, "left_anti").drop(key)

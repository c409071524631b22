"""Quality rules per document and per host (operator 8).

Each document is measured once. Rule failures are counted per host; a host's failure rate is
shrunk towards the corpus by a beta prior fitted to all hosts (moments of the host rates, less
what chance alone explains), so that a host with three documents is not condemned by two. A
host whose shrunk rate reaches ``host_rate`` is strict in that rule: its documents that fail the
rule are rejected. Documents that fail no rule are always kept, whatever their host.

Only failure counts per host are shuffled, summed inside each task first; the prior is one row.
Verdicts come back by a join on the host in which only strict hosts take part, so a host with a
third of all rows is one row on that side.

Defined cases: a null text has no words, lines or symbols and fails the base rules. A null
host belongs to no host and is judged by the base rules alone. A null id is kept, repeated rows
are judged each, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast.functions.idfilter import Listed
from slotcast.llm.common import slices, unused
from slotcast.llm.words import Words, find_words
from slotcast.session import materialize

SLICE = 1 << 20
SYMBOLS = "#*$%&|<>"
WINDOW = 5
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    min_words: int = 10
    repeat_percent: int = 20
    symbols_per_word: int = 1
    dup_line_percent: int = 30
    host_rate: float = 0.5


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeat_words(words: Words) -> np.ndarray:
    """Words inside windows that occur twice or more in their text.

    Hashes only name the texts that may have such windows; those are counted on the words.
    """
    out = np.zeros(len(words.offsets) - 1, np.int64)
    at, hashed = words.windows(words.hashes(lower=False), WINDOW)
    text = words.text_of_word()[at]
    order = np.lexsort((hashed, text))
    same = (hashed[order][1:] == hashed[order][:-1]) & (text[order][1:] == text[order][:-1])
    for doc in np.unique(text[order][1:][same]):
        own = bytes(words.data[words.offsets[doc] : words.offsets[doc + 1]]).split()
        places: dict[tuple, list[int]] = {}
        for place, window in enumerate(zip(*(own[k:] for k in range(WINDOW)), strict=False)):
            places.setdefault(window, []).append(place)
        held = np.zeros(len(own), bool)
        for found in places.values():
            if len(found) > 1:
                for place in found:
                    held[place : place + WINDOW] = True
        out[doc] = held.sum()
    return out


def _lines(words: Words) -> tuple[list[int], list[int]]:
    """Lines with a word, and those of them that repeat an earlier line."""
    counts, repeats = [], []
    raw = words.data.tobytes()
    for start, end in zip(words.offsets[:-1], words.offsets[1:], strict=True):
        lines = [x for x in raw[start:end].split(b"\n") if x and x.split(None, 1)]
        counts.append(len(lines))
        repeats.append(len(lines) - len(set(lines)))
    return counts, repeats


def measure(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, host and the counts of each document; also the short columns ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            words = find_words(part.column("text"))
            letters = (words.data & 0xC0) != 0x80
            inside = np.zeros(len(words.data) + 1, np.int64)
            inside[words.start] += 1
            np.subtract.at(inside, words.end, 1)
            inside = np.cumsum(inside[:-1]) > 0
            lines, repeats = _lines(words)
            counts = (
                words.per_text,
                _per_text(letters & inside, words.offsets),
                _per_text(_IS_SYMBOL[words.data], words.offsets),
                lines,
                repeats,
                _repeat_words(words),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("host"),
                    *(part.column(c) for c in keep),
                    *(pa.array(np.asarray(c, np.int64)) for c in counts),
                ],
                names=["doc_id", "host", *keep, *COUNTS],
            )

    own = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *keep,
    )
    counts = [T.StructField(name, T.LongType()) for name in COUNTS]
    return own.mapInArrow(run, T.StructType([*own.drop("text").schema.fields, *counts]))


def rules(limits: Limits) -> dict[str, Column]:
    """Failures of one document, by rule."""
    return {
        "short": F.col("n_words") < limits.min_words,
        "repeats": 100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"),
        "symbols": F.col("n_symbols") > limits.symbols_per_word * F.col("n_words"),
        "lines": 100 * F.col("n_dup_lines") > limits.dup_line_percent * F.col("n_lines"),
    }


def host_rates(measured: DataFrame, limits: Limits) -> DataFrame:
    """host, n_docs and per rule its failures and shrunk rate."""
    names = list(rules(limits))
    failures = [F.sum(F.when(fails, 1).otherwise(0)).alias(f"f_{r}")
                for r, fails in rules(limits).items()]
    hosts = materialize(
        measured.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n_docs"), *failures),
        "hosts",
    )
    total = hosts.agg(
        F.sum("n_docs").alias("n"),
        F.count(F.lit(1)).alias("h"),
        *[F.sum(f"f_{r}").alias(f"f_{r}") for r in names],
        *[F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / F.col("n_docs")).alias(f"q_{r}")
          for r in names],
    ).first()
    shrunk = []
    for r in names:
        n = max(total["n"] or 0, 1)
        mean = (total[f"f_{r}"] or 0) / n
        spread = mean * (1 - mean)
        between = (total[f"q_{r}"] or 0.0) / n - mean * mean - spread * total["h"] / n
        weight = min(max(spread / between - 1, 1.0), 1e6) if between > 0 else 1e6
        shrunk.append(
            ((F.col(f"f_{r}") + mean * weight) / (F.col("n_docs") + weight)).alias(f"rate_{r}")
        )
    return hosts.select("host", "n_docs", *[f"f_{r}" for r in names], *shrunk)


def _strict(measured: DataFrame, limits: Limits) -> DataFrame:
    """host, strict_rules of the hosts that have any."""
    strict = F.array_compact(
        F.array(*[F.when(F.col(f"rate_{r}") >= limits.host_rate, F.lit(r)) for r in rules(limits)])
    )
    hosts = host_rates(measured, limits).select("host", strict.alias("strict_rules"))
    return hosts.where(F.size("strict_rules") > 0)


def _judged(measured: DataFrame, strict: DataFrame, limits: Limits) -> DataFrame:
    fails = rules(limits)
    own = F.array_compact(F.array(*[F.when(failed, F.lit(r)) for r, failed in fails.items()]))
    return (
        measured.join(strict, "host", "left")
        .withColumn("strict_rules", F.coalesce("strict_rules", F.array().cast("array<string>")))
        .withColumn("base_failed", fails["short"] | fails["repeats"])
        .withColumn("kept", ~F.col("base_failed") & ~F.arrays_overlap(own, "strict_rules"))
    )


def judge(
    docs: DataFrame,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """doc_id, host, the counts, base_failed, strict_rules (of the host), kept."""
    measured = materialize(measure(docs, id_col, text_col, host_col), "measured")
    judged = _judged(measured, _strict(measured, limits), limits)
    return judged.select("doc_id", "host", *COUNTS, "base_failed", "strict_rules", "kept")


def keep_good(
    docs: DataFrame,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    Only keys of rejected rows come back from the workers: 96 bits of hashes of id, host and text,
    on which a verdict depends. They are written, and the rows are taken from ``docs`` itself: those
    that a filter of the rejected keys does not name stay in their tasks, the others are compared.
    """
    key, check = unused(docs, "row_key"), unused(docs, "row_check")
    own = [
        F.col(id_col).cast("bigint"),
        F.col(host_col).cast("string"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")),
    ]
    rows = docs.withColumns({key: F.xxhash64(*own), check: F.hash(*own)})
    named = rows.select(
        F.col(key).alias("doc_id"),
        F.col(host_col).alias("host"),
        F.col(text_col).alias("text"),
        F.col(check).alias("check"),
    )
    measured = materialize(measure(named, "doc_id", "text", "host", ("check",)), "measured")
    judged = _judged(measured, _strict(measured, limits), limits)
    rejected = judged.where(~F.col("kept")).select(
        F.col("doc_id").alias(key), F.col("check").alias(check)
    )
    rejected = materialize(rejected.distinct(), "rejected")
    listed = Listed(rejected.select(F.col(key).alias("own")), rejected.count())
    named = unused(docs, "row_named")
    marked = listed.mark(rows, key, named)
    compared = marked.where(named).join(rejected, [key, check], "left_anti")
    return marked.where(~F.col(named)).unionByName(compared).drop(key, check, named)

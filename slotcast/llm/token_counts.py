"""Token counts of whole texts and of their prefixes (operator 5).

``bpe.Merges.walk`` is a dynamic programme over prefixes: the number of tokens of a prefix is
one more than that of the prefix before its last token. It fills a table of exact counts for
every prefix of every distinct word once. Counts of a text are running sums over its words, so
"how many tokens do the first k words have" and "what fits a budget" are look-ups.

Defined cases: a null text is empty and has no tokens. A null id is kept, repeated rows are
repeated, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from slotcast.llm.bpe import END, Encoder, encoder
from slotcast.llm.common import id_and_text, slices

SLICE = 2 << 20


def word_prefix_counts(coder: Encoder, word: str) -> list[int]:
    """Tokens of each prefix of one piece, as if the piece ended there."""
    merges, plain = coder.merges, word.encode().decode("latin-1")
    ended = [plain[:n] for n in range(1, len(plain) + 1)]
    if merges.suffix:
        ended = [p[:-1] + chr(ord(p[-1]) + END) for p in ended]
    counts = {w: states[len(w)] for w, _, states in merges.walk(ended)}
    return [0, *(counts[w] for w in ended)]


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    budget: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefixes: bool = False,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, fit_words, fit_tokens; with ``prefixes`` also prefix_counts.

    fit_words is the number of leading words (chunks of ``Pieces.chunks``) that hold at most
    ``budget`` tokens, fit_tokens their tokens. prefix_counts holds the tokens of the first k
    words for each k, from which any other budget is a binary search.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, counts=True)
        for part in slices(batches, "text", SLICE):
            texts = part.column("text")
            totals, words, fits, tables = [], [], [], []
            for counts in coder.values(texts.to_pylist()):
                total = sum(counts)
                totals.append(total)
                table = list(accumulate(counts)) if prefixes or total > budget else []
                fit = len(counts) if total <= budget else bisect_right(table, budget)
                words.append(fit)
                fits.append(total if total <= budget else table[fit - 1] if fit else 0)
                if prefixes:
                    tables.append(table)
            columns = [
                part.column("doc_id"),
                pc.binary_length(texts).cast(pa.int64()),
                *(pa.array(x, pa.int64()) for x in (totals, words, fits)),
            ]
            names = ["doc_id", "n_bytes", "n_tokens", "fit_words", "fit_tokens"]
            if prefixes:
                columns.append(pa.array(tables, pa.list_(pa.int64())))
                names.append("prefix_counts")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, fit_words bigint, fit_tokens bigint"
    if prefixes:
        schema += ", prefix_counts array<bigint>"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)

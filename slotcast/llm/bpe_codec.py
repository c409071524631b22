"""BPE encoding and decoding of whole texts (operator 2).

Each task cuts its texts into chunks, puts the distinct pieces it has not met into a trie and
walks it depth first (``bpe.Merges.walk``); texts are then joined up from known chunks. No
shuffle is needed and nothing is shared between tasks, so a lost executor costs its own tasks.

Defined cases: a null text is the empty text, which has no tokens and decodes to itself. A null
id is kept. Repeated rows give repeated results. An empty table gives an empty result. Columns
other than the two named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slotcast.llm.bpe import MEMORY, encoder
from slotcast.llm.common import id_and_text, slices

SLICE = 2 << 20


def encode_decode(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    memory: int = MEMORY,
) -> DataFrame:
    """doc_id, ids (array of int), decoded (the text read back from the ids).

    ``tokenizer`` is the path of a byte-level BPE file that every executor can open. ``memory`` bounds
    what a worker remembers of chunks and the texts it takes at once; less costs time only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, memory=memory)
        for part in slices(batches, "text", min(SLICE, memory >> 5)):
            packed = coder.encode(part.column("text").to_pylist())
            ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
            if ends[-1] >= 1 << 31:
                raise OverflowError("one text has more tokens than an array can hold")
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                    coder.decode(ids, ends[1:]),
                ],
                names=["doc_id", "ids", "decoded"],
            )

    schema = "doc_id bigint, ids array<int>, decoded string"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)

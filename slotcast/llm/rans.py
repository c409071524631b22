"""Token ids in files coded by a static range asymmetric numeral system (operator 7).

All blocks share one table of symbol frequencies, counted over every token. A block holds whole
documents, about ``block_tokens`` ids, dealt round robin to interleaved lanes; one NumPy step
moves all lanes by one symbol. A block keeps the lane states at checkpoints, from which decoding
may start in its middle, and a checksum of its bytes. Blocks know nothing of one another, so
they are written and read in parallel; only their numbers of tokens are summed to place them.

A file set under ``path`` is ``frequencies`` (symbol, frequency) and ``blocks`` (part, block,
doc_ids, lengths, payload), both Parquet: its committer makes a retried task harmless.

Defined cases: a null text is empty, so its document holds just the end id. Null ids come first.
Repeated rows are documents of their own, in any order among themselves. An empty table gives
empty files. Columns other than the two named ones are not read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from slotcast.llm.bpe import BATCH, END, LATIN, Encoder, printable_bytes
from slotcast.llm.common import held, id_and_text, slices
from slotcast.session import materialize

SLICE = 2 << 20
#: Texts at once: the more, the fewer chunks are distinct.
TEXTS = 4 << 20
#: Bytes of chunks that a worker remembers.
MEMORY = 288 << 20
SCALE = 18  # bits of the frequency table
LOW = np.uint64(1 << 31)
LANES, PER_LANE, STRIDE = 8192, 64, 64
BLOCK_TOKENS = 1 << 20
HEAD = struct.Struct("<4sIQIII")
MAGIC = b"rAN1"
#: Pieces about which no two Unicode versions disagree: letters, a digit, a run of signs but "'".
PLAIN_PIECES = (f"[{LATIN}]+", "[0-9]", r"[!-&(-/:-@\[-`{-~]+")


# ---- coding of one block -----------------------------------------------------------------


class Table:
    """Frequencies summing to 2**SCALE, every counted symbol with one at least."""

    def __init__(self, symbols: np.ndarray, frequency: np.ndarray):
        size = int(symbols.max()) + 1 if len(symbols) else 1
        self.frequency = np.zeros(size, np.uint32)
        self.frequency[symbols] = frequency
        self.before = np.zeros(size, np.uint32)
        self.before[symbols] = np.cumsum(frequency) - frequency
        self.symbol = np.repeat(symbols, frequency).astype(np.uint32)


def scaled(counts: np.ndarray) -> np.ndarray:
    spare = (1 << SCALE) - len(counts)
    if spare < 0:
        raise ValueError(f"more than {1 << SCALE} symbols")
    total = int(counts.sum())
    frequency = np.array([1 + int(c) * spare // total for c in counts], np.int64)
    frequency[int(np.argmax(counts))] += (1 << SCALE) - int(frequency.sum())
    return frequency


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    n = len(ids)
    lanes = max(1, min(LANES, -(-n // PER_LANE)))
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, np.uint64)
    shift, scale, half = np.uint64(31 - SCALE + 32), np.uint64(SCALE), np.uint64(32)
    words: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    written = 0
    for step in range(steps - 1, -1, -1):
        symbol = ids[step * lanes : (step + 1) * lanes]
        x = state[: len(symbol)]
        f = table.frequency[symbol].astype(np.uint64)
        full = x >= (f << shift)
        out = x[full].astype(np.uint32)
        words.append(out)
        written += len(out)
        x = np.where(full, x >> half, x)
        whole = x // f
        state[: len(symbol)] = (whole << scale) + (x - whole * f) + table.before[symbol]
        if step % STRIDE == 0:
            marks.append((written, state.copy()))
    marks.reverse()
    words.reverse()
    body = b"".join(
        [
            np.array([written - w for w, _ in marks], "<u8").tobytes(),
            *[s.astype("<u8").tobytes() for _, s in marks],
            *[w.astype("<u4").tobytes() for w in words],
        ]
    )
    head = HEAD.pack(MAGIC, zlib.crc32(body), n, lanes, len(marks), written)
    return head + body


def decode_block(payload: bytes, table: Table, checkpoint: int = 0) -> np.ndarray:
    """Ids of a block from a checkpoint on (0: all of them)."""
    magic, check, n, lanes, marks, written = HEAD.unpack_from(payload)
    body = memoryview(payload)[HEAD.size :]
    if magic != MAGIC or zlib.crc32(body) != check:
        raise ValueError("damaged block")
    offsets = np.frombuffer(body, "<u8", marks)
    state = np.frombuffer(body, "<u8", lanes, 8 * (marks + checkpoint * lanes)).astype(np.uint64)
    words = np.frombuffer(body, "<u4", written, 8 * (marks + marks * lanes)).astype(np.uint64)
    scale, half, mask = np.uint64(SCALE), np.uint64(32), np.uint64((1 << SCALE) - 1)
    first = checkpoint * STRIDE * lanes
    ids = np.empty(n - first, np.uint32)
    at = int(offsets[checkpoint])
    for start in range(0, n - first, lanes):
        x = state[: min(lanes, n - first - start)]
        slot = x & mask
        symbol = table.symbol[slot]
        x = table.frequency[symbol] * (x >> scale) + slot - table.before[symbol]
        low = x < LOW
        refill = int(low.sum())
        x[low] = (x[low] << half) | words[at : at + refill]
        at += refill
        state[: len(x)] = x
        ids[start : start + len(x)] = symbol
    return ids


# ---- encoding of texts -------------------------------------------------------------------


class LibraryEncoder(Encoder):
    """As ``Encoder``, but new bodies go through the tokenizers library, many in one call.

    Where the file marks ends of words, bodies of Latin letters, digits and signs are cut into their
    pieces here, and each distinct piece goes to the library's model once, past its normaliser and
    its splitting rule. Other bodies take the whole way.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        super().__init__(path, memory)
        self.library = Tokenizer.from_file(path)
        # The same model, which is not held twice.
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._printable = {b: c for c, b in printable_bytes().items()} | {32: " "}
        self._cut_plain = re.compile("|".join(PLAIN_PIECES)).findall
        self._is_plain = re.compile(f"(?:{'|'.join(PLAIN_PIECES)})+").fullmatch
        self._ends = np.zeros(self.width + len(self.special), bool)
        if self.merges.suffix:
            self._ends[[n for n, w in self.merges.text.items() if w and ord(w[-1]) >= END]] = True

    def _bodies(self, bodies: list[str]) -> None:
        if not self.merges.suffix:  # chunks begin with spaces, so they cannot be put in one row
            return super()._bodies(bodies)
        plain = self._is_plain
        rest, whole, cut = [], [], {}
        for body in bodies:
            if not plain(body):
                rest.append(body)
            elif body.isalpha():
                whole.append(body)
            else:
                cut[body] = self._cut_plain(body)
        if whole or cut:
            pieces = list(dict.fromkeys([*whole, *(p for own in cut.values() for p in own)]))
            row = " ".join(pieces).lower()
            if not row.isascii():
                row = row.encode().decode("latin-1").translate(self._printable)
            (coded,) = self.model.encode_batch_fast([row], add_special_tokens=False)
            ids = np.array(coded.ids, "<u4")
            # A piece ends where a token ends a word.
            ends = np.append(0, 4 * (np.flatnonzero(self._ends[ids]) + 1)).tolist()
            if len(ends) == len(pieces) + 1:
                self._keep(pieces, ids, ends)
                for body, own in cut.items():
                    self.known[body] = b"".join([self.known[p] for p in own])
            else:  # the libraries disagree about some letter
                rest = bodies
        if rest:
            coded = self.library.encode(" ".join(rest), add_special_tokens=False)
            starts = np.cumsum([0, *(len(b) + 1 for b in rest)])
            begin = np.array([a for a, _ in coded.offsets], np.int64)
            self._keep(rest, np.array(coded.ids, "<u4"), (4 * np.searchsorted(begin, starts)).tolist())

    def _ask_bodies(self, asked: list[str]) -> list[bytes]:
        """As ``_ask``, for bodies that have no tail and are lower case."""
        self._forget()
        known, older = self.known, self._older
        # White space at an end leaves an empty chunk, which has no ids.
        known[""] = b""
        found = list(map(known.get, asked))
        new = dict.fromkeys([body for body, ids in zip(asked, found, strict=True) if ids is None])
        if not new:
            return found
        before, fresh = len(known), []
        for body in new:
            ids = older.get(body)
            if ids is None:
                fresh.append(body)
            else:
                known[body] = ids
        for at in range(0, len(fresh), BATCH):
            self._bodies(fresh[at : at + BATCH])
        self._held += 220 * (len(known) - before) + sum(map(len, new))
        return [known[c] if ids is None else ids for c, ids in zip(asked, found, strict=True)]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one row, and how many each text has.

        Arrow cuts the texts and numbers their distinct chunks; Python sees each of these once.
        Texts with special strings or separators, which are cut otherwise, go one by one.
        """
        odd = pc.match_substring_regex(texts, r"[\x1c-\x1f]")
        for special in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        if not self.splitter.marks_ends:
            odd = pa.array(np.ones(len(texts), bool))
        alone = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        words = pc.utf8_split_whitespace(pc.if_else(odd, "", texts) if len(alone) else texts)
        coded = words.flatten().dictionary_encode()
        chunks = coded.dictionary
        # A comma or full stop behind a letter or digit is a piece of its own.
        tailed = pc.match_substring_regex(chunks, "[A-Za-z0-9][,.]$")
        last = pc.if_else(tailed, pc.add(pc.cast(pc.ends_with(chunks, "."), pa.int8()), 1), 0)
        cut = pc.if_else(tailed, pc.utf8_slice_codeunits(chunks, 0, -1), chunks)
        cut = pc.if_else(pc.string_is_ascii(cut), pc.ascii_lower(cut), cut).dictionary_encode()
        bodies = cut.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = self._ask_bodies(["", ",", ".", *bodies])
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        # Chunks as ids: a body, and what follows it.
        two = np.stack([cut.indices.to_numpy() + 3, last.to_numpy()], 1).ravel()
        ids, size = _gathered(np.frombuffer(b"".join(found), "<u4"), size, two)
        size = size.reshape(-1, 2).sum(1)
        ids, sizes = _gathered(ids, size, coded.indices.to_numpy())
        after = np.cumsum(sizes)
        cuts = np.cumsum(pc.list_value_length(words).to_numpy())
        ends = np.append(0, after)[cuts]
        if len(alone):
            parts = np.split(ids, ends[:-1])
            for row, raw in zip(alone, self.encode(texts.take(pa.array(alone)).to_pylist()), strict=True):
                parts[row] = np.frombuffer(raw, "<u4")
            ids, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        return ids, np.diff(ends, prepend=0)

    def _keep(self, bodies: list[str], ids: np.ndarray, cuts: list[int]) -> None:
        raw = ids.tobytes()
        self.known.update(
            zip(bodies, [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=False)
        )


def _gathered(ids: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of ``ids`` with these sizes, those numbered ``at`` in a row, and their sizes."""
    sizes = size[at]
    after = np.cumsum(sizes)
    place = np.repeat((np.cumsum(size) - size)[at] - (after - sizes), sizes)
    return ids[place + np.arange(len(place))], sizes


def _encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = held(("library", tokenizer), lambda: LibraryEncoder(tokenizer))
        kind = "<u2" if max(coder.width, end_id + 1) <= 1 << 16 else "<u4"
        for part in slices(batches, "text", TEXTS):
            ids, sizes = coder.flat(part.column("text"))
            ends = np.cumsum(sizes)
            ids = np.insert(ids, ends, end_id).astype(kind)
            if ids.nbytes >= 1 << 31:
                raise OverflowError("one text has more ids than a row can hold")
            cuts = np.append(0, ends + np.arange(1, 1 + len(ends))) * ids.itemsize
            packed = pa.BinaryArray.from_buffers(
                pa.binary(), len(ends), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(ids)]
            )
            width = pa.array(np.full(len(ends), ids.itemsize, np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), width, packed], names=["doc_id", "width", "ids"]
            )

    return docs.mapInArrow(run, "doc_id bigint, width int, ids binary")


def _unpacked(part: pa.RecordBatch) -> list[np.ndarray]:
    kinds = part.column("width").to_pylist()
    return [
        np.frombuffer(raw, f"<u{kind}")
        for raw, kind in zip(part.column("ids").to_pylist(), kinds, strict=True)
    ]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1, np.int64)
    for part in slices(batches, "ids", SLICE):
        arrays = _unpacked(part)
        found = np.bincount(np.concatenate(arrays))
        if len(found) > len(total):
            found[: len(total)] += total
            total = found
        else:
            total[: len(found)] += found
    symbols = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(symbols, pa.int64()), pa.array(total[symbols], pa.int64())],
        names=["symbol", "n"],
    )


# ---- files -------------------------------------------------------------------------------


def _load_table(spark: SparkSession, path: str) -> Table:
    """The shared table; its rows are bounded by the vocabulary."""
    rows = spark.read.parquet(f"{path}/frequencies").collect()
    pairs = np.array(sorted((r["symbol"], r["frequency"]) for r in rows), np.int64).reshape(-1, 2)
    return Table(pairs[:, 0], pairs[:, 1])


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    block_tokens: int = BLOCK_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of all texts, each followed by ``end_id``, in ascending order of ids."""
    spark = docs.sparkSession
    coded = materialize(_encoded(id_and_text(docs, id_col, text_col), tokenizer, end_id), "ids")
    counted = (
        coded.mapInArrow(_counts, "symbol bigint, n bigint")
        .groupBy("symbol")
        .agg(F.sum("n").alias("n"))
        .collect()  # a row for each symbol of the vocabulary at most
    )
    counted.sort()
    frequency = scaled(np.array([r["n"] for r in counted], np.int64)) if counted else []
    rows = [(r["symbol"], int(f)) for r, f in zip(counted, frequency, strict=True)]
    spark.createDataFrame(rows, "symbol bigint, frequency bigint").coalesce(1).write.parquet(
        f"{path}/frequencies"
    )
    shared = spark.sparkContext.broadcast(_load_table(spark, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            payload = encode_block(np.concatenate(held), shared.value)
            columns = [
                pa.array([part], pa.int32()),
                pa.array([block], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(x) for x in held]], pa.list_(pa.int64())),
                pa.array([payload], pa.binary()),
            ]
            names = ["part", "block", "doc_ids", "lengths", "payload"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        tokens = 0
        for piece in slices(batches, "ids", SLICE):
            for doc, own in zip(piece.column("doc_id").to_pylist(), _unpacked(piece), strict=True):
                ids.append(doc)
                held.append(own)
                tokens += len(own)
                if tokens >= block_tokens:
                    yield flush()
                    ids, held, tokens, block = [], [], 0, block + 1
        if held:
            yield flush()

    schema = (
        "part int, block bigint, doc_ids array<bigint>, lengths array<bigint>, payload binary"
    )
    ordered = coded.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, schema).write.parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids, read from the files.

    ``ids`` holds little-endian unsigned 32-bit integers, the form in which readers take them.
    """
    table = spark.sparkContext.broadcast(_load_table(spark, path))
    blocks = spark.read.parquet(f"{path}/blocks")
    tokens = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)
    sizes = blocks.select("part", "block", tokens.alias("n"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    starts = (
        sizes.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(first, "part")
        .select("part", "block", (F.col("first") + F.col("inside")).alias("start"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "payload", 1 << 18):
            for row in piece.to_pylist():
                raw = decode_block(row["payload"], table.value).astype("<u4", copy=False).tobytes()
                ends = np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["start"] + ends[:-1], pa.int64()),
                        pa.array(
                            [raw[4 * a : 4 * b] for a, b in zip(ends, ends[1:], strict=False)],
                            pa.binary(),
                        ),
                    ],
                    names=["doc_id", "start", "ids"],
                )

    placed = blocks.join(starts, ["part", "block"]).select("doc_ids", "lengths", "payload", "start")
    return placed.mapInArrow(run, "doc_id bigint, start bigint, ids binary")

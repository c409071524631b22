"""Removal of byte strings that an earlier document holds (operator 6), by suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts in a document with a smaller
id is removed; strings are judged on the input.

No suffix of unique text is shuffled. In each string of that length the least hash of its parts of
half that length is its anchor, so equal strings have equal anchors, and neighbouring
strings mostly share one; shorter parts would be shared by more and more texts by chance while the table grows.
A first pass finds anchors of two or more texts and the least of these by hash,
its home. A second pass cuts texts into pieces, runs of strings whose anchors have one home,
and sends each to its home's bucket. A bucket so holds every copy of each string that it holds;
its distinct pieces get one suffix array, whose common prefixes name equal strings and so the
smallest id of each.

Copies of a text count once, under their smallest id, and travel through this once. Anchors found
in too many texts (``hot``) would still gather too much at one home. Their strings are sent one by one, each to the bucket of its own hash, and equal ones are one row for
each slice of texts. Numbers of buckets follow from the bytes of the table, so a bucket stays as
large as it is while the table grows. What the passes shuffle leaves the disk when they end.

What a bucket finds goes back to the texts by bin: texts are dealt to bins by a hash, and a bucket
makes one row for each bin, with the entries of the bin's texts packed. A bin unpacks them
to one row for each text. So no step makes a row for each text and bucket, or for each span.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing. A null id counts
as larger than all others. Rows that repeat an id are no smaller than one another and keep what only
they share. An empty table gives an empty result. Columns other than the two named ones are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.llm.common import id_and_text, slices
from slotcast.llm.suffixes import common_prefixes, suffix_array, words_at
from slotcast.llm.words import _VALUES, _grow, buffers, mix
from slotcast.session import materialize, materialize_and_drop

SLICE = 2 << 20
HOT, HOT_SHARE, HOT_MOST = 4096, 64, 32768
KEY_BITS = 40
ANCHORS, PIECES = 24 << 20, 4 << 20  # bytes of text for each bucket of anchors and of pieces
LAST = (1 << 63) - 1


def hot(texts: int) -> int:
    """Texts that an anchor may have at its home: a share of all, within bounds.

    A string sent alone costs about as much as the piece it would be part of.
    """
    return min(max(HOT, texts // HOT_SHARE), max(HOT, HOT_MOST))


def anchors(texts: pa.Array, length: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with one anchor: (anchor, text, first start, number of starts), bytes, offsets."""
    data, offsets = buffers(texts)
    n, gram = len(data), max(16, length // 2)
    spread = length - gram + 1
    if n < length:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, data, offsets
    power, inverse = _grow(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * power[:n], out=sums[1:])
    least = mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
    width, count = 1, n - length + 1
    while 2 * width <= spread:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:count], least[spread - width : spread - width + count])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = np.flatnonzero(text[:count] == text[length - 1 :])
    least, text = least[start], text[start]
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new) if len(start) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(start)))
    return least[first], text[first], start[first], sizes, data, offsets


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, id, row, check and z: texts travel compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        for part in slices(batches, "text", SLICE):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            columns = [part.column(c) for c in ("doc_id", "id", "row", "check")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(map(squeeze, texts), pa.binary())],
                names=["doc_id", "id", "row", "check", "z"],
            )

    return docs.mapInArrow(run, "doc_id bigint, id bigint, row bigint, check bigint, z binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices with their texts, as bytes."""
    expand = zstandard.ZstdDecompressor().decompress
    for part in slices(batches, "z", SLICE // 3):
        yield part, pa.array([expand(z) for z in part.column("z").to_pylist()], pa.binary())


def _bucketed(anchor: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each anchor and KEY_BITS of it.

    A bucket holds about as many anchors whatever the size of the table, so that many bits leave
    about one pair of anchors in a bucket that only seem equal; the suffix arrays see through them.
    """
    whole = np.uint64(buckets)
    return (anchor % whole).astype(np.int64), (anchor // whole) & np.uint64((1 << KEY_BITS) - 1)


def _narrow(key: np.ndarray) -> np.ndarray:
    """The KEY_BITS of each key, a row of bytes each."""
    return np.ascontiguousarray(key).view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8]


def _wide(packed: bytes) -> np.ndarray:
    narrow = np.frombuffer(packed, np.uint8).reshape(-1, KEY_BITS // 8)
    out = np.zeros((len(narrow), 8), np.uint8)
    out[:, : KEY_BITS // 8] = narrow
    return out.view("<u8").reshape(-1)


def _runs(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """Anchors of texts by bucket, packed: per row the texts and (anchor, text) pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            anchor, text, _, _, _, _ = anchors(part.column("text"), length)
            rows = part.column("row").to_numpy(zero_copy_only=False)
            bucket, key = _bucketed(anchor, buckets)
            raw = _narrow(key)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            columns: list[list] = [[], [], [], []]
            for number in np.flatnonzero(edges[1:] > edges[:-1]):
                own = order[edges[number] : edges[number + 1]]
                used, place = np.unique(text[own], return_inverse=True)
                for column, value in zip(
                    columns,
                    (
                        int(number),
                        rows[used].astype("<i8").tobytes(),
                        raw[own].tobytes(),
                        place.astype("<u2" if len(used) <= 1 << 16 else "<u4").tobytes(),
                    ),
                    strict=True,
                ):
                    column.append(value)
            kinds = [pa.int32(), *[pa.binary()] * 3]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["bucket", "rows", "anchors", "places"],
            )

    schema = "bucket int, rows binary, anchors binary, places binary"
    return docs.mapInArrow(run, schema)


def _by_bin(
    row: np.ndarray, sizes: np.ndarray, bins: int, per_text: dict, per_entry: dict
) -> pa.Table:
    """One row per bin: rows and sizes of its texts, packed, and what belongs to a text or an entry.

    Texts come in order with their numbers of entries.
    """
    number = (mix(row.view(np.uint64)) % np.uint64(bins)).astype(np.int64)
    order = np.argsort(number, kind="stable")
    used, first = np.unique(number[order], return_index=True)
    cuts = np.append(first, len(order)).tolist()
    size, begin = sizes[order], (np.cumsum(sizes) - sizes)[order]
    entry = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
    entry_cuts = np.append(0, np.cumsum(size))[cuts].tolist()

    def packed(values: np.ndarray, by: np.ndarray, at: list[int]) -> pa.Array:
        values = values[by]
        return pa.array([values[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)], pa.binary())

    texts = {"rows": row.astype("<i8"), "sizes": sizes.astype("<u4"), **per_text}
    return pa.table(
        {"bin": pa.array(used, pa.int32())}
        | {name: packed(values, order, cuts) for name, values in texts.items()}
        | {name: packed(values, entry, entry_cuts) for name, values in per_entry.items()}
    )


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(new), n)


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


SHARED = "bin int, rows binary, sizes binary, bucket bigint, anchors binary, homes binary"


def _shared_of(bins: int, most: int):
    def shared(table: pa.Table) -> pa.Table:
        """Anchors of a bucket that two or more texts have, and their homes, by bin of texts.

        A home is a hash of the least text; for anchors of more than ``most`` texts it is -1.
        """
        anchor, row = [], []
        columns = (table.column(c).to_pylist() for c in ("rows", "anchors", "places"))
        for rows, packed, places in zip(*columns, strict=True):
            own = _wide(packed)
            place = np.frombuffer(places, f"<u{len(places) // len(own)}")
            anchor.append(own)
            row.append(np.frombuffer(rows, "<i8")[place])
        anchor, row = (np.concatenate(x) for x in (anchor, row))
        # Copies of a text are one row.
        order = np.lexsort((row, anchor))
        anchor, row = anchor[order], row[order]
        new = _edges(anchor, row)[:-1]
        anchor, row = anchor[new], row[new]
        ends = _edges(anchor)
        first, count = ends[:-1], np.diff(ends)
        spread = (mix(row[first].view(np.uint64)) >> np.uint64(33)).astype(np.int32)
        home = np.where(count > most, np.int32(-1), spread)
        kept = np.repeat(count > 1, count)
        anchor, row, home = anchor[kept], row[kept], np.repeat(home, count)[kept]
        order = np.argsort(row, kind="stable")
        anchor, row, home = anchor[order], row[order], home[order]
        ends = _edges(row)
        found = _by_bin(
            row[ends[:-1]], np.diff(ends), bins, {}, {"anchors": _narrow(anchor), "homes": home.astype("<i4")}
        )
        bucket = table.column("bucket")[0].as_py()
        numbers = pa.array(np.full(found.num_rows, bucket), pa.int64())
        return found.add_column(3, "bucket", numbers)

    return shared


def _anchors_of_texts(table: pa.Table) -> pa.Table:
    """Per text of a bin its shared anchors in all buckets, and their homes."""
    anchor, row, home = [], [], []
    columns = (table.column(c).to_pylist() for c in ("rows", "sizes", "bucket", "anchors", "homes"))
    for rows, sizes, bucket, packed, homes in zip(*columns, strict=True):
        row.append(np.repeat(np.frombuffer(rows, "<i8"), np.frombuffer(sizes, "<u4")))
        anchor.append(_wide(packed) | np.uint64(bucket) << np.uint64(KEY_BITS))
        home.append(np.frombuffer(homes, "<i4"))
    anchor, row, home = (np.concatenate(x) for x in (anchor, row, home))
    order = np.argsort(row, kind="stable")
    anchor, row, home = anchor[order], row[order], home[order]
    ends = _edges(row)
    return pa.table(
        {
            "row": pa.array(row[ends[:-1]], pa.int64()),
            "anchors": _lists(anchor.view(np.int64), ends),
            "homes": _lists(home, ends),
        }
    )


_PIECE = ["bucket", "piece", "ids", "rows", "starts"]


def _pieces(docs: DataFrame, length: int, key_buckets: int, buckets: int) -> DataFrame:
    """Pieces of texts by bucket; equal strings of much-shared anchors are one row per slice."""

    def cut(part: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        anchor, text, start, count, data, offsets = anchors(texts, length)
        number, anchor = _bucketed(anchor, key_buckets)
        anchor |= number.astype(np.uint64) << np.uint64(KEY_BITS)
        known, homes = part.column("anchors"), part.column("homes")
        owner = np.repeat(np.arange(part.num_rows), np.diff(known.offsets.to_numpy()))
        a, b = known.offsets.to_numpy()[[0, -1]]
        listed = known.values.to_numpy()[a:b].view(np.uint64)
        home = homes.values.to_numpy()[homes.offsets.to_numpy()[0] :][: b - a]
        salt = np.uint64(0xD6E8FEB86659FD93)
        key = mix(listed + owner.astype(np.uint64) * salt)
        by = np.argsort(key)
        key, home = key[by], home[by]
        mine = mix(anchor + text.astype(np.uint64) * salt)
        spot = np.minimum(np.searchsorted(key, mine), max(len(key) - 1, 0))
        found = key[spot] == mine if len(key) else np.zeros(len(mine), bool)
        text, start, count = text[found], start[found], count[found]
        home = home[spot[found]]
        ids = part.column("id").to_pylist()
        rows = part.column("row").to_pylist()
        raw = data.tobytes()
        out: dict[tuple[int, bytes], tuple[list, list, list]] = {}

        def add(bucket: int, piece: bytes, doc: int, at: int) -> None:
            held = out.setdefault((bucket, piece), ([], [], []))
            held[0].append(ids[doc])
            held[1].append(rows[doc])
            held[2].append(at - int(offsets[doc]))

        alone = home < 0
        for doc, begin, size in zip(text[alone].tolist(), start[alone].tolist(), count[alone].tolist(), strict=True):
            for at in range(begin, begin + size):
                piece = raw[at : at + length]
                digest = hashlib.blake2b(piece, digest_size=8).digest()
                add(int.from_bytes(digest, "little") % buckets, piece, doc, at)
        text, start, count, home = (x[~alone] for x in (text, start, count, home))
        if len(text):
            joined = (text[1:] == text[:-1]) & (home[1:] == home[:-1])
            joined &= start[1:] == start[:-1] + count[:-1]
            first = np.flatnonzero(np.concatenate([[True], ~joined]))
            last = np.append(first[1:], len(text)) - 1
            stop = start[last] + count[last] + length - 1
            for doc, begin, end, h in zip(
                text[first].tolist(), start[first].tolist(), stop.tolist(), home[first].tolist(), strict=True
            ):
                add(h % buckets, raw[begin:end], doc, begin)
        held = list(out.values())
        columns = [
            pa.array([k[0] for k in out], pa.int32()),
            pa.array([k[1] for k in out], pa.binary()),
            *(pa.array([h[k] for h in held], pa.list_(pa.int64())) for k in range(3)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=_PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _unpacked(batches):
            yield cut(part, texts)

    schema = "bucket int, piece binary, ids array<bigint>, rows array<bigint>, starts array<bigint>"
    return docs.mapInArrow(run, schema)


def smallest_ids(pieces: list[bytes], least: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per start in the joined pieces the smallest id among pieces with that string; and offsets."""
    text = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    wanted = np.zeros(len(text) + 1, np.int64)
    wanted[ends - sizes] += 1
    np.subtract.at(wanted, ends - length + 1, 1)
    wanted = np.cumsum(wanted[:-1]) > 0
    words = words_at(text)
    order = suffix_array(text, wanted, words)
    piece = np.repeat(np.arange(len(pieces)), sizes)
    same = common_prefixes(order, words, length)
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    low = np.minimum.reduceat(least[piece[order]], first)
    out = np.full(len(text), LAST)
    out[order] = np.repeat(low, np.diff(np.append(first, len(order))))
    return out, ends - sizes


def _joined(
    row: np.ndarray, doc_id: np.ndarray, a: np.ndarray, b: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Spans by text and place, those that overlap or touch as one: row, id, a, b, and the texts' ends."""
    order = np.lexsort((a, doc_id, row))
    row, doc_id, a, b = (x[order] for x in (row, doc_id, a, b))
    ends = _edges(row, doc_id)
    # Texts one behind the other; none is longer than 2 GB.
    line = np.repeat(np.arange(len(ends) - 1, dtype=np.int64), np.diff(ends)) << 32
    reach = np.maximum.accumulate(b + line)
    new = np.ones(len(a), bool)
    new[1:] = (a + line)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a))[: len(first)] - 1
    row, doc_id = row[first], doc_id[first]
    return row, doc_id, a[first], (reach - line)[last], _edges(row, doc_id)


SPANS = "bin int, rows binary, sizes binary, ids binary, a binary, b binary"


def _spans_of(length: int, bins: int):
    def spans(table: pa.Table) -> pa.Table:
        """Spans of documents that smaller ids hold, from the pieces of one bucket, by bin of texts."""
        held: dict[bytes, list[int]] = {}
        for place, piece in enumerate(table.column("piece").to_pylist()):
            held.setdefault(piece, []).append(place)
        columns = {}
        for name in ("ids", "rows", "starts"):
            column = table.column(name).combine_chunks()
            ends = column.offsets.to_numpy()
            columns[name] = column.values.to_numpy()
        pieces = list(held)
        number = np.empty(table.num_rows, np.int64)
        for k, places in enumerate(held.values()):
            number[places] = k
        per_row = np.diff(ends)
        piece = np.repeat(number, per_row)
        ids, rows, starts = (columns[n][ends[0] : ends[-1]] for n in ("ids", "rows", "starts"))
        least = np.full(len(pieces), LAST)
        np.minimum.at(least, piece, ids)
        low, offset = smallest_ids(pieces, least, length)
        sizes = np.array([len(p) for p in pieces])
        count = sizes - length + 1
        begin = np.repeat(offset - np.cumsum(count) + count, count) + np.arange(count.sum())
        packed = low[begin]
        edge = np.cumsum(count) - count
        most, fewest = np.maximum.reduceat(packed, edge), np.minimum.reduceat(packed, edge)
        whole = np.flatnonzero(ids > most[piece])
        out = [
            (rows[whole], ids[whole], starts[whole], starts[whole] + sizes[piece[whole]]),
        ]
        some = np.flatnonzero((ids > fewest[piece]) & (ids <= most[piece]))
        for at in some:
            k = piece[at]
            taken = np.flatnonzero(packed[edge[k] : edge[k] + count[k]] < ids[at])
            breaks = np.flatnonzero(np.diff(taken) > length)
            a = taken[np.concatenate([[0], breaks + 1])] + starts[at]
            b = taken[np.append(breaks, len(taken) - 1)] + length + starts[at]
            out.append((np.full(len(a), rows[at]), np.full(len(a), ids[at]), a, b))
        row, doc_id, a, b, ends = _joined(*(np.concatenate(x) for x in zip(*out, strict=True)))
        return _by_bin(
            row[ends[:-1]],
            np.diff(ends),
            bins,
            {"ids": doc_id[ends[:-1]].astype("<i8")},
            {"a": a.astype("<u4"), "b": b.astype("<u4")},
        )

    return spans


def _spans_of_texts(table: pa.Table) -> pa.Table:
    """Per text of a bin its spans from all buckets."""
    row, doc_id, a, b = [], [], [], []
    columns = (table.column(c).to_pylist() for c in ("rows", "ids", "sizes", "a", "b"))
    for rows, ids, sizes, begins, ends in zip(*columns, strict=True):
        size = np.frombuffer(sizes, "<u4")
        row.append(np.repeat(np.frombuffer(rows, "<i8"), size))
        doc_id.append(np.repeat(np.frombuffer(ids, "<i8"), size))
        a.append(np.frombuffer(begins, "<u4").astype(np.int64))
        b.append(np.frombuffer(ends, "<u4").astype(np.int64))
    row, doc_id, a, b, ends = _joined(*(np.concatenate(x) for x in (row, doc_id, a, b)))
    spans = pa.StructArray.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    return pa.table(
        {
            "row": pa.array(row[ends[:-1]], pa.int64()),
            "least": pa.array(doc_id[ends[:-1]], pa.int64()),
            "spans": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans),
        }
    )


def _remove_with(length: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _unpacked(batches):
            yield _without_spans(part, texts.to_pylist(), length)

    return remove


def _without_spans(part: pa.RecordBatch, texts: list[bytes], length: int) -> pa.RecordBatch:
    kept, spans = [], []
    copies = part.column("copy").to_pylist()
    for text, found, copy in zip(texts, part.column("spans").to_pylist(), copies, strict=True):
        if copy:
            # A smaller id has the whole text.
            runs = [(0, len(text))] if len(text) >= length else []
        else:
            runs = [(s["a"], s["b"]) for s in found or ()]
        at, left = 0, []
        for a, b in runs:
            left.append(text[at:a])
            at = b
        left.append(text[at:])
        kept.append(b"".join(left))
        spans.append([{"a": a, "b": b} for a, b in runs])
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array(spans, kind),
            pa.array(kept, pa.binary()),
        ],
        names=["doc_id", "n_bytes", "removed", "kept"],
    )


def remove_repeats(
    docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, removed (maximal spans a..b of bytes), kept (the bytes that are left)."""
    if not 24 <= length <= 64:
        raise ValueError("length must be 24 to 64 bytes")
    own = id_and_text(docs, id_col, text_col)
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    own = own.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(LAST)).alias("id"),
        F.xxhash64("text").alias("row"),
        F.xxhash64("text", F.lit(1)).alias("check"),
        "text",
    )
    copies = own.groupBy("row", "check").agg(F.min("id").alias("least"))
    copies = materialize(copies, "copies")
    packed = _packed(own)
    key_buckets = 1 + size // ANCHORS
    shared = _runs(own, length, key_buckets).groupBy("bucket").applyInArrow(
        _shared_of(key_buckets, hot(copies.count())), SHARED
    )
    per_row = shared.groupBy("bin").applyInArrow(
        _anchors_of_texts, "row bigint, anchors array<bigint>, homes array<int>"
    )
    first = materialize_and_drop(
        per_row.join(copies.select("row", F.col("least").alias("id")), "row"), "anchors"
    )
    pieces = _pieces(
        packed.join(first, ["row", "id"]), length, key_buckets, 1 + size // PIECES
    )
    spans = pieces.groupBy("bucket").applyInArrow(_spans_of(length, key_buckets), SPANS)
    per_text = materialize_and_drop(
        spans.groupBy("bin").applyInArrow(
            _spans_of_texts, "row bigint, least bigint, spans array<struct<a:bigint,b:bigint>>"
        ),
        "spans",
    )
    verdict = copies.join(per_text, ["row", "least"], "left")
    schema = "doc_id bigint, n_bytes bigint, removed array<struct<a:bigint,b:bigint>>, kept binary"
    return (
        packed.join(verdict, ["row", "check"])
        .select("doc_id", "z", "spans", (F.col("id") > F.col("least")).alias("copy"))
        .mapInArrow(_remove_with(length), schema)
    )

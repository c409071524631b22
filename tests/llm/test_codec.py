"""Operators 2, 5 and 7 against the tokenizers library."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from slotcast.llm import common, rans
from slotcast.llm.bpe import Encoder, encoder
from slotcast.llm.bpe_codec import encode_decode
from slotcast.llm.token_counts import token_counts, word_prefix_counts

from .helpers import corpus, frame, plain

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
ODD = ["a  b", "a \n b ", " \n", "don't we'LL", "x\x1cy z.", "İ, é., 12, ..", "ΑΣ ΑΣ.", "　 a",
       "<|startoftext|>a<|endoftext|> b", "a" * 300, "日本語, text.", "\x00\x00special x"]


def ids(path: str, text: str) -> list[int]:
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_trie_walk_is_the_librarys_encoding(path):
    texts = [t or "" for _, t, _ in corpus()] + ODD
    want = [ids(path, t) for t in texts]
    coder = Encoder(path)
    for _ in range(2):  # the second time from memory
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == want
    counts = Encoder(path, counts=True)
    assert [sum(c) for c in counts.values(texts)] == [len(w) for w in want]


def test_forgetting_changes_nothing():
    texts = [t or "" for _, t, _ in corpus()] + ODD
    coder = Encoder(WORD, memory=1)
    got = [np.frombuffer(coder.encode([t])[0], "<u4").tolist() for t in texts + texts]
    assert got == 2 * [ids(WORD, t) for t in texts]


def test_library_chunks_are_the_librarys_encoding():
    texts = [t or "" for _, t, _ in corpus()] + ODD
    coder = rans.LibraryEncoder(WORD)
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]
    assert got == [ids(WORD, t) for t in texts]


@pytest.mark.parametrize("path", [BYTE, WORD])
@pytest.mark.parametrize("memory", [1, rans.MEMORY])
def test_ids_of_texts_in_one_row(path, memory):
    texts = [t or "" for _, t, _ in corpus()] + ODD + ["", " a ", "<|endoftext|>", "É é\x1fA, ß."]
    coder, library = rans.LibraryEncoder(path, memory), Tokenizer.from_file(path)
    for part in (texts, texts[::-1], texts[5:9], ["", " "], ODD[4:5], []):
        found, sizes = coder.flat(pa.array([*part, "not this"], pa.string()).slice(0, len(part)))
        want = [library.encode(t, add_special_tokens=False).ids for t in part]
        assert sizes.tolist() == [len(w) for w in want]
        assert found.tolist() == [n for w in want for n in w]


def test_arrow_cuts_at_the_white_space_of_python():
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    cut = pc.utf8_split_whitespace(pa.array([f"a{c}b" for c in chars]))
    two = pc.equal(pc.list_value_length(cut), 2).to_pylist()
    assert [c for c, cut in zip(chars, two) if cut] == [c for c in chars if c.isspace()]


def test_most_chunks_are_never_seen_one_by_one(monkeypatch):
    coder, asked = rans.LibraryEncoder(WORD), []
    ask = coder._ask_bodies
    monkeypatch.setattr(coder, "_ask_bodies", lambda chunks: asked.extend(chunks) or ask(chunks))
    coder.flat(pa.array(["To be, or not to be."] * 1000))
    assert sorted(asked) == ["", ",", ".", "be", "not", "or", "to"]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_counts_of_all_prefixes(path):
    word = "unbelievable"
    found = word_prefix_counts(encoder(path), word)
    assert found == [0, *(len(ids(path, word[:n])) for n in range(1, len(word) + 1))]


def test_encode_decode(spark):
    rows = corpus()
    got = encode_decode(frame(spark, rows), BYTE).collect()
    library = Tokenizer.from_file(BYTE)
    want = []
    for d, t, _ in rows:
        coded = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, coded, library.decode(coded, skip_special_tokens=False)))
    assert plain(got) == plain(want)
    assert encode_decode(frame(spark, []), BYTE).count() == 0


def test_token_counts_and_budgets(spark):
    rows = corpus()
    got = token_counts(frame(spark, rows), WORD, 40, prefixes=True).collect()
    assert plain((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == plain(
        (d, len((t or "").encode()), len(ids(WORD, t or ""))) for d, t, _ in rows
    )
    for r in got:
        counts = [0, *r.prefix_counts]
        assert counts[-1] == r.n_tokens and counts[r.fit_words] == r.fit_tokens <= 40
        assert r.fit_words == len(r.prefix_counts) or counts[r.fit_words + 1] > 40
    assert token_counts(frame(spark, []), WORD, 40).count() == 0


def test_blocks_decode_from_any_checkpoint():
    draw = np.random.default_rng(1)
    values = np.minimum(draw.zipf(1.3, 700_000), 40_000).astype(np.uint16)
    counts = np.bincount(values)
    symbols = np.flatnonzero(counts)
    table = rans.Table(symbols, rans.scaled(counts[symbols]))
    for n in (1, 2, 65, 4097, len(values)):
        block = rans.encode_block(values[:n], table)
        assert (rans.decode_block(block, table) == values[:n]).all()
    skipped = rans.STRIDE * rans.LANES
    assert (rans.decode_block(block, table, 1) == values[skipped:]).all()
    assert len(block) < 2 * len(values)
    damaged = block[:-1] + bytes([block[-1] ^ 1])
    with pytest.raises(ValueError, match="damaged"):
        rans.decode_block(damaged, table)


def test_token_files(spark, scratch):
    rows = corpus()
    path = scratch("tokens")
    rans.write_tokens(frame(spark, rows), path, WORD, 1, block_tokens=500)
    got = sorted(rans.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _, _ in rows), key=lambda d: (d is not None, d))
    assert [r.start for r in got] == np.cumsum([0, *(len(r.ids) // 4 for r in got)])[:-1].tolist()
    want = [(d, zlib.crc32(np.array([*ids(WORD, t or ""), 1], "<u4"))) for d, t, _ in rows]
    assert plain((r.doc_id, zlib.crc32(r.ids)) for r in got) == plain(want)
    empty = scratch("none")
    rans.write_tokens(frame(spark, []), empty, WORD)
    assert rans.read_tokens(spark, empty).count() == 0


def test_a_worker_drops_what_an_earlier_stage_held(monkeypatch):
    stage, made = [1], []
    monkeypatch.setattr(common, "_stage", lambda: stage[0])
    monkeypatch.setattr(common, "_held", {})
    batch = pa.RecordBatch.from_arrays([pa.array(["x"])], names=["text"])

    def ask():
        return common.held("tokenizer", lambda: made.append(stage[0]) or object())

    first = ask()
    assert len(list(common.slices([batch], "text"))) == 1 and ask() is first
    stage[0] = 2
    again = ask()
    list(common.slices([batch], "text"))
    assert again is first and common._held
    stage[0] = 3
    list(common.slices([batch], "text"))
    assert not common._held and ask() is not first and made == [1, 3]


def test_what_an_earlier_stage_held_goes_before_a_value_is_made(monkeypatch):
    stage, seen = [1], []
    monkeypatch.setattr(common, "_stage", lambda: stage[0])
    monkeypatch.setattr(common, "_held", {})
    common.held("index", object)
    common.held("tokenizer", lambda: seen.append(list(common._held)) or object())
    stage[0] = 2
    common.held("other tokenizer", lambda: seen.append(list(common._held)) or object())
    assert seen == [["index"], []]


def test_an_encoder_with_little_memory_gives_the_same_ids(spark, monkeypatch):
    rows = corpus() + [(100 + n, f"{t}, {t}!", None) for n, t in enumerate(ODD)]
    docs, library = frame(spark, rows), Tokenizer.from_file(BYTE)
    want = [(d, library.encode(t or "", add_special_tokens=False).ids) for d, t, _ in rows]
    got = encode_decode(docs, BYTE, memory=1 << 10).collect()
    assert plain((r.doc_id, r.ids) for r in got) == plain(want)
    merges = Encoder(BYTE).merges
    monkeypatch.setattr("slotcast.llm.bpe.NEIGHBOURS", 8)
    for a in range(256, 300):
        merges.neighbours(a, a + 1)
    assert len(merges._neighbours) <= 8


def test_tokens_that_end_at_a_place():
    merges = Encoder(BYTE).merges
    list(merges.walk([]))
    word, state = " international", 0
    for end, symbol in enumerate(map(ord, word), 1):
        while state and state << 13 | symbol not in merges._ahead:
            state = merges._back[state]
        state = merges._ahead.get(state << 13 | symbol, 0)
        found = [merges.ids[word[at:end]] for at in range(end) if word[at:end] in merges.ids]
        assert list(merges._ends[state]) == found

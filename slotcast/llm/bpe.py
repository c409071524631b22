"""Byte-pair encoding as states that move along the prefixes of words.

Two facts carry everything here. A sequence of tokens is the encoding of its text exactly when
each neighbouring pair is: merging the text of the pair gives the pair back. So the encoding
of a prefix is known from its *last token* and the encoding of the shorter prefix in front of
it. The words of a batch form a trie; walking it depth first carries the last token of each
prefix down the path, and what words share is computed once.

Pieces are strings over an alphabet of base symbols: one character below 256 for a byte, plus
``END`` for the last byte of a piece where the vocabulary marks ends of words.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex

from slotcast.llm.common import held

END = 0x1000
BATCH = 20_000
#: Pairs of tokens whose answer is remembered, about 140 bytes each.
NEIGHBOURS = 1 << 18
#: Bytes of chunks that an encoder remembers where its operator does not say.
MEMORY = 192 << 20
MARK = "\0\0special "
#: Letters of Latin alphabets, each of which is one letter in lower case as well.
LATIN = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f"
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The two splitting rules of the public vocabularies.
BYTE_LEVEL_PIECES = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+"
    rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
WORD_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+"


def printable_bytes() -> dict[str, int]:
    """The usual mapping of bytes to printable characters in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Vocabulary and merges of one tokenizer file, and which pairs of tokens may be neighbours."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        byte_of = printable_bytes()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.ids: dict[str, int] = {}
        self.text: dict[int, str] = {}
        for token, number in model["vocab"].items():
            ended = bool(self.suffix) and token.endswith(self.suffix)
            body = token[: -len(self.suffix)] if ended else token
            if any(c not in byte_of for c in body):
                continue
            symbols = [byte_of[c] for c in body]
            if ended and symbols:
                symbols[-1] += END
            word = "".join(map(chr, symbols))
            self.ids[word], self.text[number] = number, word
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        marked = {token: number for token, number in model["vocab"].items()}
        for order, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, c = marked[left], marked[right], marked[left + right]
            self.rank[a, b] = order
            self.made.setdefault(c, (order, a, b))
        self._neighbours: dict[int, bool] = {}
        known: dict[int, bool] = {}
        self.ids = {w: number for w, number in self.ids.items() if self._whole(number, known)}
        self._ends: list[tuple[int, ...]] = []

    def _suffixes(self) -> None:
        """Which tokens end at a place: an automaton over the tokens, after Aho and Corasick.

        A state is the longest end of what was read that begins a token; ``_ends`` lists the tokens
        that this end ends with, longest first.
        """
        ahead: dict[int, int] = {}
        depth, back, own = [0], [0], [-1]
        for word, token in self.ids.items():
            state = 0
            for symbol in map(ord, word):
                key = state << 13 | symbol
                state = ahead.get(key, 0)
                if not state:
                    state = ahead[key] = len(own)
                    depth.append(key)
                    back.append(0)
                    own.append(-1)
            own[state] = token
        ends: list[tuple[int, ...]] = [()] * len(own)
        level = [s for k, s in ahead.items() if not k >> 13]
        below: dict[int, list[int]] = {}
        for key, state in ahead.items():
            if key >> 13:
                below.setdefault(key >> 13, []).append(state)
        while level:
            for state in level:
                key = depth[state]
                at, symbol = key >> 13, key & 0x1FFF
                while at:
                    at = back[at]
                    found = ahead.get(at << 13 | symbol)
                    if found is not None:
                        back[state] = found
                        break
                rest = ends[back[state]]
                ends[state] = (own[state], *rest) if own[state] >= 0 else rest
            level = [s for state in level for s in below.get(state, ())]
        self._ahead, self._back, self._ends = ahead, back, ends
        self._size = {token: len(word) for word, token in self.ids.items()}

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(rank at which it appears, token) along one edge of a token, outermost symbol first.

        Not kept: the spines of all tokens take far more memory than the merges they come from.
        """
        spine, at = [], token
        while at in self.made:
            spine.append((self.made[at][0], at))
            at = self.made[at][side]
        spine.append((-1, at))
        spine.reverse()
        return spine

    def _seam(self, left: int, right: int, last: int) -> bool:
        """True if some merge before rank ``last`` joins the edge of ``left`` to that of ``right``.

        Both sides merge on their own in order of rank, as parts always rank before the whole.
        An edge symbol lives from its own rank to that of the next one on its spine; a merge
        over the seam happens if it comes while both its parts live. Among equal ranks the
        leftmost merge goes first.
        """
        a, b = self._spine(left, 2), self._spine(right, 1)
        i = j = 0
        while True:
            end_a = a[i + 1][0] if i + 1 < len(a) else last
            end_b = b[j + 1][0] if j + 1 < len(b) else last
            rank = self.rank.get((a[i][1], b[j][1]))
            if rank is not None and rank < last and rank < end_a and rank <= end_b:
                if rank >= max(a[i][0], b[j][0]):
                    return True
            if end_a >= last and end_b >= last:
                return False
            if end_a <= end_b:
                i += 1
            else:
                j += 1

    def _whole(self, token: int, known: dict[int, bool]) -> bool:
        """Whether merging the text of a token gives that token (some may be out of reach)."""
        if token not in known:
            if token not in self.made:
                known[token] = True
            else:
                rank, a, b = self.made[token]
                parts = self._whole(a, known) and self._whole(b, known)
                known[token] = parts and not self._seam(a, b, rank)
        return known[token]

    def neighbours(self, left: int, right: int) -> bool:
        if len(self._neighbours) >= NEIGHBOURS:
            self._neighbours.clear()
        fits = self._neighbours[left << 32 | right] = not self._seam(left, right, 1 << 60)
        return fits

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list[int], list[int]]]:
        """Depth-first over the trie of distinct ``words``: per word its states, which stay shared.

        Sorted order visits a trie depth first, and the common prefix of two words in a row is
        the path kept on the stack. State i holds the last token of the prefix of length i and
        that prefix's number of tokens (-1 where no encoding of the prefix exists).
        """
        if not self._ends:
            self._suffixes()
        ahead, back, ends, size = self._ahead.get, self._back, self._ends, self._size
        known = self._neighbours.get
        last, count, states = [-1], [0], [0]
        before = ""
        for word in sorted(set(words)):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], count[shared + 1 :], states[shared + 1 :]
            state, end = states[shared], shared
            for symbol in map(ord, word[shared:]):
                end += 1
                after = ahead(state << 13 | symbol)
                while after is None:
                    if not state:
                        after = 0
                        break
                    state = back[state]
                    after = ahead(state << 13 | symbol)
                state = after
                found, tokens = -1, -1
                for token in ends[state]:
                    start = end - size[token]
                    if not start:
                        found, tokens = token, 1
                        break
                    left = last[start]
                    if left < 0:
                        continue
                    fits = known(left << 32 | token)
                    if fits is None:
                        fits = self.neighbours(left, token)
                    if fits:
                        found, tokens = token, count[start] + 1
                        break
                states.append(state)
                last.append(found)
                count.append(tokens)
            before = word
            yield word, last, count

    def tokens(self, word: str, last: list[int]) -> list[int]:
        """Read an encoding back from the states along a word."""
        out, end = [], len(word)
        while end:
            token = last[end]
            out.append(token)
            end -= len(self.text[token])
        out.reverse()
        return out


def lower_each(text: str) -> str:
    """Lower case of each character on its own; a final sigma is not special."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


class Pieces:
    """How one tokenizer file turns a stretch of text without special strings into pieces."""

    def __init__(self, merges: Merges):
        self.marks_ends = bool(merges.suffix)
        self._split = regex.compile(WORD_PIECES if self.marks_ends else BYTE_LEVEL_PIECES)
        self._special = None
        if merges.special:
            ordered = sorted(merges.special, key=len, reverse=True)
            self._special = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")")
        spaces = "" if self.marks_ends else r"\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
        # Letters alone, behind a space or not: surely one piece.
        self._letters = re.compile(f" ?[{LATIN}]+").fullmatch
        self._rare = re.compile(rf"[\x1c-\x1f{spaces}]")
        self._odd = regex.compile(
            r"[\x1c-\x1f]" if self.marks_ends else rf"[{WHITE}]\x20[{WHITE}]|[{WHITE}]\x20$"
        )

    def _plain(self, text: str) -> bool:
        """A quick test that most texts pass; the others are searched."""
        if self._rare.search(text):
            return False
        return self.marks_ends or not ("  " in text or " \n" in text or " \t" in text)

    def _letter(self, char: str) -> bool:
        """Whether a character is one letter or digit, also in the form that is encoded."""
        if not self.marks_ends or char.isascii():
            return char.isalnum()
        return lower_each(unicodedata.normalize("NFC", char)).isalnum() and char.isalnum()

    def split_tail(self, chunk: str) -> tuple[str, str]:
        """(body, tail): a chunk as a part that many chunks share, and pieces that follow it.

        A comma or full stop behind a letter or digit is a piece of its own. Where the vocabulary
        is lower case, so is the body.
        """
        tail = ""
        if chunk[-1:] in (",", ".") and self._letter(chunk[-2:-1]):
            chunk, tail = chunk[:-1], chunk[-1]
        if self.marks_ends and not chunk.islower() and chunk.isascii():
            chunk = chunk.lower()
        return chunk, tail

    def stretches(self, text: str) -> list[str]:
        """Plain text at even places, special strings at odd ones."""
        if self._special is None or "<" not in text:
            return [text]
        return self._special.split(text)

    def chunks(self, text: str) -> list[str]:
        """Parts of a stretch that split into pieces independently of one another.

        A space with a non-space on one side always begins a piece, so most texts can be cut
        there and each distinct chunk is looked at once. The rest stay whole.
        """
        if not self._plain(text) and self._odd.search(text):
            return [text]
        if self.marks_ends:
            return text.split()
        parts = text.split(" ")
        head = parts[0]
        rest = [" " + p for p in parts[1:]]
        return [head, *rest] if head else rest

    def pieces(self, chunk: str) -> list[str]:
        if not self.marks_ends and self._letters(chunk):
            return [chunk if chunk.isascii() else chunk.encode().decode("latin-1")]
        if self.marks_ends:
            found = self._split.findall(lower_each(unicodedata.normalize("NFC", chunk)))
            out = []
            for p in found:
                raw = p.encode("utf-8", "surrogatepass").decode("latin-1")
                out.append(raw[:-1] + chr(ord(raw[-1]) + END))
            return out
        return [
            p.encode("utf-8", "surrogatepass").decode("latin-1") for p in self._split.findall(chunk)
        ]


class Encoder:
    """Encodes texts by distinct chunk; what it remembers is bounded by ``memory`` bytes.

    Forgetting costs time only: chunks of the texts at hand are always learned first. ``value``
    says what is kept of a chunk: its packed ids, or the number of its tokens.
    """

    def __init__(self, path: str, memory: int = MEMORY, counts: bool = False):
        self.merges = Merges(path)
        self.splitter = Pieces(self.merges)
        self.memory = memory
        self.counts = counts
        self.width = 1 + max(self.merges.text, default=0)
        self.known: dict[str, bytes | int] = {}
        self._older: dict[str, bytes | int] = {}
        self._held = 0
        self._packed = {number: number.to_bytes(4, "little") for number in self.merges.text}
        self.special = {
            s: 1 if counts else number.to_bytes(4, "little")
            for s, number in self.merges.special.items()
        }
        spelled = {
            number: bytes(ord(c) % END if self.merges.suffix else ord(c) for c in word)
            for number, word in self.merges.text.items()
        } | {number: s.encode() for s, number in self.merges.special.items()}
        # The bytes of all tokens in one row, and where each begins.
        listed = [spelled.get(number, b"") for number in range(1 + max(spelled, default=0))]
        self._buffer = np.frombuffer(b"".join(listed) or b"\0", np.uint8)
        self._sizes = np.array([len(b) for b in listed], np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes

    def _bodies(self, bodies: list[str]) -> None:
        """Encode distinct bodies into ``known``."""
        split = {c: self.splitter.pieces(c) for c in bodies}
        words: dict[str, bytes | int] = {}
        packed = self._packed
        for word, last, count in self.merges.walk({w for p in split.values() for w in p}):
            if self.counts:
                words[word] = count[len(word)]
            else:
                words[word] = b"".join([packed[t] for t in self.merges.tokens(word, last)])
        add = sum if self.counts else b"".join
        for body, pieces in split.items():
            self.known[body] = words[pieces[0]] if len(pieces) == 1 else add([words[p] for p in pieces])

    def _learn(self, new: set[str]) -> None:
        older, known = self._older, self.known
        before = len(known)
        fresh, derived = set(), []
        split_tail = self.splitter.split_tail
        for chunk in new:
            value = older.get(chunk)
            if value is not None:
                known[chunk] = value
                continue
            if chunk.isalpha() and chunk.islower():
                fresh.add(chunk)
                continue
            body, tail = split_tail(chunk)
            if body == chunk:
                fresh.add(chunk)
                continue
            derived.append((chunk, body, tail))
            for part in (body, tail):
                if part and part not in known:
                    value = older.get(part)
                    if value is None:
                        fresh.add(part)
                    else:
                        known[part] = value
        listed = list(fresh)
        for at in range(0, len(listed), BATCH):
            self._bodies(listed[at : at + BATCH])
        for chunk, body, tail in derived:
            known[chunk] = known[body] + known[tail] if tail else known[body]
        self._held += 220 * (len(known) - before) + sum(map(len, new))

    def _forget(self) -> None:
        """The older half is forgotten; what is asked for again comes over from it."""
        if self._held > self.memory // 2:
            self._older, self._held = self.known, 0
            self.known = {}

    def _ask(self, asked: list[str]) -> list[bytes | int]:
        """What is known of distinct chunks, learning the new ones first."""
        self._forget()
        known = self.known
        found = list(map(known.get, asked))
        new = {chunk for chunk, value in zip(asked, found, strict=True) if value is None}
        if not new:
            return found
        special = {c for c in new if c.startswith(MARK) and c[len(MARK) :] in self.special}
        self._learn(new - special)
        for chunk in special:
            known[chunk] = self.special[chunk[len(MARK) :]]
        return [known[c] if v is None else v for c, v in zip(asked, found, strict=True)]

    def values(self, texts: list[str]) -> list[list[bytes | int]]:
        """Per text what is known of its chunks, in order."""
        cuts = []
        for text in texts:
            parts = self.splitter.stretches(text)
            cut = self.splitter.chunks(parts[0])
            if len(parts) > 1:
                # Special strings stand alone, marked by a beginning that no chunk has.
                for k, part in enumerate(parts[1:], 1):
                    cut += [MARK + part] if k % 2 else self.splitter.chunks(part)
            cuts.append(cut)
        # What is known is large and scattered, so it is asked once for each chunk of these texts.
        asked = list(set().union(*cuts))
        found = dict(zip(asked, self._ask(asked), strict=True))
        return [list(map(found.__getitem__, cut)) for cut in cuts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian unsigned 32-bit integers."""
        return [b"".join(found) for found in self.values(texts)]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of byte-level ids that end at ``ends``; all bytes of a slice are gathered at once.

        Bytes that are not UTF-8 become replacement characters.
        """
        sizes = self._sizes[ids]
        after = np.cumsum(sizes, dtype=np.int64)
        total = int(after[-1]) if len(after) else 0
        kind = np.int32 if total < 1 << 30 else np.int64
        at = np.repeat((self._starts[ids] - (after - sizes)).astype(kind), sizes)
        at += np.arange(total, dtype=kind)
        raw = self._buffer[at]
        cuts = np.concatenate([[0], after])[np.concatenate([[0], ends])]
        data = raw.tobytes()
        try:
            data.decode("utf-8")
            # A text that begins inside a character was not whole before either.
            inside = cuts[cuts < total]
            whole = not ((raw[inside] & 0xC0) == 0x80).any() and total < 1 << 31
        except UnicodeDecodeError:
            whole = False
        if whole:
            offsets = pa.py_buffer(cuts.astype(np.int32))
            return pa.StringArray.from_buffers(len(cuts) - 1, offsets, pa.py_buffer(data))
        return pa.array(
            [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)],
            pa.string(),
        )


def encoder(path: str, counts: bool = False, memory: int = MEMORY) -> Encoder:
    """One encoder for each tokenizer file and Python worker, while a stage asks for it."""
    return held((path, counts, memory), lambda: Encoder(path, memory, counts))

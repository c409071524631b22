"""Suffix array of a byte string by two-stage sorting, as NumPy steps over whole buckets.

A suffix is *small* if it comes before the suffix one further on. Only small suffixes are sorted
directly; scanning the buckets of first bytes in order then puts every other suffix behind
those already placed: its place in its bucket follows from that of its successor.

Callers look for common prefixes of ``depth`` bytes at given places, so suffixes are told apart
by their first ``DEPTH`` bytes only, and places from which no wanted one is induced are left out.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64


def words_at(text: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on as one number that sorts like them; zeros past the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(text)]
    return out


def small_suffixes(text: np.ndarray) -> np.ndarray:
    """Whether each suffix comes before its successor (the last one does not)."""
    n = len(text)
    small = np.zeros(n, bool)
    if n < 2:
        return small
    small[:-1] = text[:-1] < text[1:]
    equal = np.flatnonzero(text[:-1] == text[1:])
    if len(equal):
        # A run of equal bytes takes the answer of its last byte.
        ends = np.flatnonzero(np.append(text[:-1] != text[1:], True))
        small[equal] = small[ends[np.searchsorted(ends, equal)]]
    return small


def _sorted_small(places: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Places in the order of their first DEPTH bytes."""

    def word(at: np.ndarray, level: int) -> np.ndarray:
        further = at + 8 * level
        return np.where(further < len(words), words[np.minimum(further, len(words) - 1)], 0)

    order = places[np.argsort(word(places, 0), kind="stable")]
    first = word(order, 0)
    new = np.concatenate([[True], first[1:] != first[:-1]])
    for level in range(1, DEPTH // 8):
        group = np.cumsum(new)
        tied = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(tied):
            break
        own = order[tied]
        key = word(own, level)
        by = np.lexsort((key, group[tied]))
        order[tied], key, group = own[by], key[by], group[tied][by]
        new[tied[1:]] |= (key[1:] != key[:-1]) & (group[1:] == group[:-1])
    return order


def suffix_array(text: np.ndarray, wanted: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The ``wanted`` places (a mask) in the order of the first DEPTH bytes of their suffixes."""
    n = len(text)
    small = small_suffixes(text)
    small_places = np.flatnonzero(small)
    # A large suffix needs its successors up to the next small one.
    starts = np.flatnonzero(wanted)
    following = np.searchsorted(small_places, starts)
    until = np.append(small_places, n - 1)[following]
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.subtract.at(depth, until + 1, 1)
    needed = np.cumsum(depth[:-1]) > 0
    placed = _sorted_small(np.flatnonzero(small & needed), words)
    bounds = np.searchsorted(text[placed], np.arange(257))
    large = needed & ~small
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and large[n - 1]:
        waiting[text[n - 1]].append(np.array([n - 1]))
    out = []
    for byte in range(256):
        parts = waiting[byte]
        base = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        parts = [base]
        while len(base):
            # Runs of this byte: predecessors land behind, in the same bucket.
            before = base[base > 0] - 1
            base = before[large[before] & (text[before] == byte)]
            parts.append(base)
        bucket = np.concatenate([*parts, placed[bounds[byte] : bounds[byte + 1]]])
        waiting[byte] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[large[before] & (text[before] > byte)]
        if len(before):
            target = text[before]
            by = np.argsort(target, kind="stable")
            before, target = before[by], target[by]
            cuts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
            for part, at in zip(np.split(before, cuts[1:]), cuts, strict=True):
                waiting[target[at]].append(part)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def common_prefixes(order: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Per neighbours in ``order`` whether they share ``depth`` (8 to DEPTH) bytes."""
    a, b = order[:-1], order[1:]
    same = np.ones(len(a), bool)
    for at in [*range(0, depth - 7, 8), depth - 8]:
        live = np.flatnonzero(same)
        same[live] = words[a[live] + at] == words[b[live] + at]
    return same

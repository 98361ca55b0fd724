"""Sets of word shingles of texts, as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from trendloom.llm.byteops import _join, buffers

FOLD = np.arange(256, dtype=np.uint64)
FOLD[65:91] += np.uint64(32)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
PIECE = 1 << 20
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
S29, S32 = np.uint64(29), np.uint64(32)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = (x ^ (x >> S29)) * K1 + np.uint64(seed)
    x = (x ^ (x >> S32)) * K2
    return x ^ (x >> S29)


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased) of adjacent texts and how many each text has.

    A word's hash is the sum of a hash of each byte with its place in the word.
    """
    at = np.flatnonzero(~SPACE[data])
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(ends) - 1, np.int64)
    fresh = np.append(True, np.diff(at) > 1)
    first = np.searchsorted(at, ends[:-1])
    fresh[first[first < len(at)]] = True
    starts = np.flatnonzero(fresh)
    place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    x = FOLD[data[at]] + (place.astype(np.uint64) << np.uint64(8)) + np.uint64(1)
    hashes = np.add.reduceat(mix(x), starts)
    return hashes, np.diff(np.searchsorted(at[starts], ends))


def word_hashes(data: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """The word hashes of each text, texts being taken some at a time and long ones in pieces."""
    i, n = 0, len(ends) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + PIECE, "right")) - 1)
        low, high = int(ends[i]), int(ends[j])
        if high - low <= 2 * PIECE:
            hashes, counts = _words(data[low:high], ends[i : j + 1] - low)
            yield from np.split(hashes, np.cumsum(counts)[:-1])
        else:
            parts, at = [], low
            while at < high:
                end = min(high, at + PIECE)
                while end < high and not SPACE[data[end]]:
                    gap = np.flatnonzero(SPACE[data[end : min(high, end + PIECE)]])
                    end = end + int(gap[0]) if len(gap) else min(high, end + PIECE)
                parts.append(_words(data[at:end], np.array([0, end - at]))[0])
                at = end
            yield np.concatenate(parts)
        i = j


def shingle_set(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Distinct hashes of the k-word shingles, sorted; fewer words are one shingle of their own."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    if len(words) < k:
        out = words[:1] + np.uint64(len(words))
        for w in words[1:]:
            out = _join(out, np.array([w]))
        return mix(out, len(words))
    out, done, size, own = None, 0, 1, words
    while done < k:
        if k & size:
            n = len(words) - done - size + 1
            out = own[:n].copy() if out is None else _join(out[:n], own[done : done + n])
            done += size
        if done < k:
            own = _join(own[: len(own) - size], own[size:])
            size *= 2
    return np.unique(mix(out[: len(words) - k + 1]))


def sets(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """The shingle set of each row of a binary column."""
    data, ends = buffers(column)
    for words in word_hashes(data, ends):
        yield shingle_set(words, k)


def signature(own: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, whatever the order of their members."""
    a, b = mix(own, 1).sum(dtype=np.uint64), mix(own, 2).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))

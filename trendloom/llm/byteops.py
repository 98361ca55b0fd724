"""Bytes of Arrow batches as numpy arrays, and hashes of all their substrings of one length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(29)
_HALF = np.uint64(32)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends) of a binary or string column without nulls: row i is bytes[ends[i]:ends[i + 1]]."""
    kind = np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], (ends - ends[0]).astype(np.int64)


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = left ^ (left >> _SHIFT)
    out *= _MIX
    out += right
    out ^= out >> _HALF
    out *= _MIX2
    return out


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each q-byte substring; substrings double in length step by step."""
    if len(data) < q:
        return np.zeros(0, np.uint64)
    own = data.astype(np.uint64)
    own += np.uint64(1)
    own *= _MIX
    out, done, size = None, 0, 1
    while True:
        if q & size:
            n = len(data) - done - size + 1
            out = own[:n].copy() if out is None else _join(out[:n], own[done : done + n])
            done += size
        if done == q:
            break
        own = _join(own[: len(own) - size], own[size:])
        size *= 2
    out = out[: len(data) - q + 1]
    out ^= out >> _HALF
    out *= _MIX
    return out

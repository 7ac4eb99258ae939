"""Vectorised word splitting and hashing over the UTF-8 buffers of Arrow batches.

A word is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r``; those
separators are ASCII, so splitting bytes and splitting code points agree.  Texts
are read whole; a null text has no words, like an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

# Random odd multipliers from a fixed seed: the same in every process.
_rng = np.random.Generator(np.random.PCG64(20240229))
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)  # fixed values: splitmix64 finaliser
_GRAM = _rng.integers(2**62, 2**63, 64, dtype=U64) * U64(2) + U64(1)
_STEP = U64(int(_rng.integers(2**62, 2**63)) * 2 + 1)
_KEEP = np.array([0] + [(1 << 8 * k) - 1 for k in range(1, 8)] + [2**64 - 1], U64)  # the first k of 8 bytes
_LONG = 512          # bytes from which a word is hashed by itself
_AT_ONCE = 1 << 17   # words hashed at once


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * _MIX1
    x = x ^ (x >> U64(27))
    x = x * _MIX2
    return x ^ (x >> U64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row bounds) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(bounds):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words; row r holds words first[r]:first[r+1]."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)  # a row begins (or all ends) here
    edge[bounds] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word's bytes: eight bytes at a time, mixed after each, for all words at once.

    The mixing is not linear, so no two words collide because of how they are built; words
    of many bytes are hashed by xxhash.
    """
    if lower:
        data = _LOWER[data]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    out = np.empty(len(starts), U64)
    for i in range(0, len(starts), _AT_ONCE):
        at, left = starts[i:i + _AT_ONCE].copy(), ends[i:i + _AT_ONCE] - starts[i:i + _AT_ONCE]
        state = mix(left.astype(U64) * _STEP)
        long = np.flatnonzero(left >= _LONG)
        live = np.flatnonzero(left < _LONG)
        while len(live):
            state[live] = mix(state[live] * _STEP ^ (eight[at[live]] & _KEEP[np.minimum(left[live], 8)]))
            at[live] += 8
            left[live] -= 8
            live = live[left[live] > 0]
        for k in long.tolist():
            state[k] ^= U64(xxhash.xxh3_64_intdigest(data[starts[i + k]:ends[i + k]].tobytes()))
        out[i:i + _AT_ONCE] = mix(state)
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes (row bounds are the caller's)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, U64)
    out = words[:count] * _GRAM[0]
    for k in range(1, n):
        out += words[k:count + k] * _GRAM[k]
    return mix(out + U64(n))


def slices(batch: pa.RecordBatch, text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows holding about `limit` bytes of text, one row at least."""
    _, bounds = utf8(batch.column(text))
    i = 0
    while i < batch.num_rows:
        j = max(int(np.searchsorted(bounds, bounds[i] + limit, "right")) - 1, i + 1)
        yield batch.slice(i, j - i)
        i = j

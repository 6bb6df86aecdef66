"""Vectorised kernels over the bytes of many texts at once.

A word is `[^\\x20\\x09-\\x0D]+`. Texts come as one byte buffer with offsets, the way Arrow holds
them, so a word costs a few array operations and no Python object.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = bytes([0x20, 9, 10, 11, 12, 13])
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SPACES)] = False
#: Odd multipliers of hashes, taken mod 2**64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93
LONG = 1024  #: bytes of a word from which it is hashed by the library
_FIRST = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_thrifty = False
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def thrifty() -> None:
    """Let a worker give memory back: large arrays get pages of their own, and free ones go. Does nothing without glibc."""
    import ctypes

    global _thrifty
    try:
        libc = ctypes.CDLL(None)
        if not _thrifty:
            libc.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD, which else grows with what is freed
            _thrifty = True
        libc.malloc_trim(0)
    except (OSError, AttributeError):
        _thrifty = True


def as_bytes(column: Column) -> Column:
    """UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(column.cast("binary"), F.lit("").cast("binary"))


def held_out(id_column: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text, mod 5, is 0 (null ids as well)."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values in one array, and where each value begins (one more than values)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def loosen(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A struct column whose fields, at any depth of structs, may be null, as Spark's schema strings say."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    parts = [loosen(x) if pa.types.is_struct(x.type) else x for x in column.flatten()]
    return pa.StructArray.from_arrays(parts, fields=[pa.field(f.name, x.type, True) for f, x in zip(column.type, parts, strict=True)])


def slices(offsets: np.ndarray, most: int = (1 << 20) - 1) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `most` bytes, a longer text alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, b
        a = b


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i below n, kept for the worker's life."""
    held = _tables.get(base)
    if held is None or len(held[0]) < n:
        size, inverse = max(n, 1 << 16), pow(base, -1, 1 << 64)
        size = 1 << (size - 1).bit_length()
        up, down = np.full(size, base, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        held = _tables[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return held[0][:n], held[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    start: np.ndarray  #: of each word, its first byte in the buffer
    end: np.ndarray
    first: np.ndarray  #: of each text, its first word; one more entry than texts


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of texts that lie one after another in data."""
    n = len(data)
    if not n:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64))
    inside = IS_WORD[data]
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begin[cuts] = inside[cuts]
    stop[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(begin)
    return Words(start, np.flatnonzero(stop) + 1, np.searchsorted(start, offsets))


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one integer; behind the end stand zeros."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def word_hashes(data: np.ndarray, w: Words, seed: int = 0, only: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word's bytes (or of those in `only`, zero for the rest).

    Eight bytes at a time are mixed into the hash of those before, so that no algebra makes words alike; words over LONG bytes are
    hashed by XXH3. Hashes of two seeds are independent. Equal hashes are no proof of equal words: see word_ids().
    """
    import xxhash

    at = np.arange(len(w.start)) if only is None else only
    start, size = w.start[at], w.end[at] - w.start[at]
    found, view = size.astype(np.uint64) * np.uint64(WORD_BASE) + np.uint64((seed * BYTE_BASE + 0x51) % (1 << 64)), eights(data)
    live = np.flatnonzero(size <= LONG)
    k = 0
    while len(live):
        left = size[live] - k
        piece = view[start[live] + k] & _FIRST[np.minimum(left, 8)]
        found[live] = mix(found[live] ^ mix(piece + np.uint64((seed * WORD_BASE + BYTE_BASE) % (1 << 64))))
        live, k = live[left > 8], k + 8
    for i in np.flatnonzero(size > LONG).tolist():
        found[i] = xxhash.xxh3_64_intdigest(data[start[i] : start[i] + size[i]].tobytes(), seed)
    if only is None:
        return found
    out = np.zeros(len(w.start), np.uint64)
    out[at] = found
    return out


def same_bytes(data: np.ndarray, start: np.ndarray, other: np.ndarray, size: np.ndarray) -> bool:
    """Whether each run of `size` bytes from start equals the one from other."""
    view, live, k = eights(data), np.flatnonzero(start != other), 0
    while len(live):
        left = size[live] - k
        keep = _FIRST[np.minimum(left, 8)]
        if ((view[start[live] + k] ^ view[other[live] + k]) & keep).any():
            return False
        live, k = live[left > 8], k + 8
        if k >= LONG:
            return all(data[a : a + n].tobytes() == data[b : b + n].tobytes() for a, b, n in zip(start[live].tolist(), other[live].tolist(), size[live].tolist(), strict=True))
    return True


def equal_bytes(data: np.ndarray, start: np.ndarray, size: np.ndarray, others: np.ndarray, other: np.ndarray, other_size: np.ndarray) -> np.ndarray:
    """Which runs of data equal those of others."""
    same, view, theirs = size == other_size, eights(data), eights(others)
    live, k = np.flatnonzero(same), 0
    while len(live) and k < LONG:
        left = size[live] - k
        alike = ((view[start[live] + k] ^ theirs[other[live] + k]) & _FIRST[np.minimum(left, 8)]) == 0
        same[live[~alike]] = False
        live, k = live[alike & (left > 8)], k + 8
    for i in live.tolist():
        same[i] = data[start[i] : start[i] + size[i]].tobytes() == others[other[i] : other[i] + size[i]].tobytes()
    return same


def word_ids(data: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, equal where the bytes are equal and only there, and the first word of each number.

    Words are brought together by hashes, and each is then compared with the first of its hash.
    """
    ids, distinct = pd.factorize(word_hashes(data, w))
    size = w.end - w.start
    first = np.empty(len(distinct), np.int64)
    first[ids[::-1]] = np.arange(len(ids) - 1, -1, -1)
    like = first[ids]
    if (size[like] == size).all() and same_bytes(data, w.start, w.start[like], size):
        return ids, first
    raw = data.tobytes()  # two words of one hash
    ids, distinct = pd.factorize(np.array([raw[a:b] for a, b in zip(w.start.tolist(), w.end.tolist(), strict=True)], object))
    first = np.empty(len(distinct), np.int64)
    first[ids[::-1]] = np.arange(len(ids) - 1, -1, -1)
    return ids, first


def run_ids(ids: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of `size` entries, equal where the runs are equal and only there: pairs of runs are numbered anew."""
    if len(ids) < size:
        return np.zeros(0, np.int64)

    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        b = b[: len(a)]
        return pd.factorize(a[: len(b)].astype(np.int64) * (int(b.max(initial=0)) + 1) + b)[0]

    whole, done, power, length = None, 0, ids, 1  # numbers stay below len(ids), so products fit
    while True:
        if size & length:
            whole, done = (power, length) if whole is None else (joined(whole, power[done:]), done + length)
        if done == size:
            return whole[: len(ids) - size + 1]
        power, length = joined(power, power[length:]), 2 * length


def window_hashes(word_hash: np.ndarray, size: int, base: int = WORD_BASE) -> np.ndarray:
    """A 64-bit hash of each run of `size` words; runs across texts are included and the caller skips them."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(base, len(word_hash) + 1)
    total = np.zeros(len(word_hash) + 1, np.uint64)
    np.cumsum(word_hash * up[:-1], out=total[1:])
    return mix((total[size:] - total[:n]) * down[:n] + np.uint64(size))


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n places lie in a run of `size` from one of starts."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + size, n), -1)
    return np.cumsum(change[:-1]) > 0

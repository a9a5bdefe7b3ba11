"""Words and hashes of many texts at once, as numpy operations over the UTF-8 bytes of an Arrow column.

White space is ASCII, so it can be found in the bytes; the same holds for lower-casing A-Z. Hashes are polynomials modulo
2**64 over a fixed random value per byte, taken as differences of one running sum, and mixed at the end.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the whole word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))


@lru_cache(maxsize=1)
def space_bytes() -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[[0x20, *range(0x09, 0x0E)]] = True
    return flags


@lru_cache(maxsize=1)
def lower_bytes() -> np.ndarray:
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    return low


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and extended."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=U64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=U64)
    return known[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each (nulls are empty)."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    offsets = offsets.astype(np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of the first word of each text (one more at the end)."""
    inside = np.empty(len(raw) + 1, dtype=bool)
    np.logical_not(space_bytes()[raw], out=inside[:-1])
    inside[-1] = False
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    inner = offsets[:-1]
    first = np.zeros(len(inside), dtype=bool)
    first[inner] = True  # texts lie side by side: a word ends where its text does
    starts = np.flatnonzero(inside & (~before | first))
    ends = np.flatnonzero(before & (~inside | first))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(raw)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(byte_values()[raw] * powers(BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, n + 1)[starts])

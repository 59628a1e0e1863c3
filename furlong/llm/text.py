"""Vectorised words and hashes over Arrow text columns, used inside tasks.

A batch of texts is one byte buffer with document offsets. Words are the maximal runs of bytes other than
space and 0x09-0x0D; they never cross documents. Hashes are polynomials modulo 2**64 over randomised byte
values, followed by a mixing step, and are the same in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = U64(0xD1342543DE82EF95)
STEP_INVERSE = U64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (the finaliser of the public splitmix64 generator)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(30))
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
        return x


BYTE_VALUES = mixed(np.arange(1, 257, dtype=U64) * BASE)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    key = int(base)
    if key not in _powers or len(_powers[key]) < n:
        factors = np.full(max(n, 1 << 16), base, U64)
        factors[0] = 1
        with np.errstate(over="ignore"):
            _powers[key] = np.multiply.accumulate(factors)
    return _powers[key][:n]


def rolled(values: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """Prefix sums ``P`` with which :func:`spanned` hashes any run of ``values``."""
    out = np.empty(len(values) + 1, U64)
    out[0] = 0
    with np.errstate(over="ignore"):
        np.multiply(values, powers(base, len(values)), out=out[1:])
        np.cumsum(out[1:], out=out[1:])
    return out


def spanned(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray,
            inverse: np.uint64 = BASE_INVERSE) -> np.ndarray:
    """Hashes of the runs ``starts[i]:ends[i]``."""
    with np.errstate(over="ignore"):
        return mixed((prefix[ends] - prefix[starts]) * powers(inverse, len(prefix))[starts])


def spanned_all(prefix: np.ndarray, n: int, inverse: np.uint64 = BASE_INVERSE, start: int = 0,
                stop: int | None = None) -> np.ndarray:
    """Hashes of all runs of ``n`` values, at every position or at those from ``start`` up to ``stop``."""
    stop = len(prefix) - n if stop is None else stop
    with np.errstate(over="ignore"):
        out = prefix[start + n:stop + n] - prefix[start:stop]
        out *= powers(inverse, len(prefix))[start:stop]
        return mixed(out)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(
        1, np.int64)
    data = texts.buffers()[2] if len(texts) else None
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column of about ``limit`` bytes each; a longer text is a range of its own."""
    sizes = np.zeros(len(column) + 1, np.int64)
    _, offsets = buffer_of(column)
    sizes[:] = offsets
    at = 0
    while at < len(column):
        end = int(np.searchsorted(sizes, sizes[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, end
        at = end


def words_of(raw: np.ndarray, offsets: np.ndarray,
             between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word starts, word ends, word offsets per document); ``between`` tells for each byte whether it parts words."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inked = ~between[raw]
    first = inked.copy()
    first[1:] &= ~inked[:-1]
    last = inked.copy()
    last[:-1] &= ~inked[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    first[cuts] = inked[cuts]
    last[cuts - 1] = inked[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return spanned(rolled(BYTE_VALUES[raw]), starts, ends)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, also those that cross documents; empty if there are fewer words."""
    if len(words) < n:
        return np.zeros(0, U64)
    return spanned_all(rolled(words, STEP), n, STEP_INVERSE)


def inside(word_offsets: np.ndarray, n: int) -> np.ndarray:
    """Positions at which a run of ``n`` words lies within one document."""
    total = int(word_offsets[-1])
    ok = np.zeros(total + 1, np.int64)
    starts, ends = word_offsets[:-1], word_offsets[1:] - n + 1
    real = ends > starts
    np.add.at(ok, starts[real], 1)
    np.add.at(ok, ends[real], -1)
    return np.flatnonzero(np.cumsum(ok)[:total])


def within(word_offsets: np.ndarray, n: int) -> np.ndarray:
    """For each position whether a run of ``n`` words from there lies within one document."""
    sizes = np.diff(word_offsets)
    runs = np.maximum(sizes - n + 1, 0)
    flags = np.tile(np.array([True, False]), len(sizes))
    return np.repeat(flags, np.column_stack([runs, sizes - runs]).ravel())


def owners(word_offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The document of each word position."""
    return np.searchsorted(word_offsets, at, side="right") - 1

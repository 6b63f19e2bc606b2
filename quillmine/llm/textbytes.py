"""Vectorised work on the UTF-8 bytes of an Arrow text column.

Texts are handled in chunks of about CHUNK bytes (a longer text is a chunk of its own), so that memory
follows the longest text and not the batch. Words are runs of bytes for which a 256-entry table is true; a word
never crosses a document's border.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def byte_table(chars: bytes, others: bool = False) -> np.ndarray:
    """True for the bytes in ``chars``, or for all others."""
    table = np.zeros(256, np.uint8)
    table[list(chars)] = 1
    return (1 - table).astype(np.uint8) if others else table


#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words between ASCII blanks.
NOT_BLANK = byte_table(b" \t\n\x0b\x0c\r", others=True)
#: Letters and digits of ASCII, and all bytes of other characters.
ALNUM = byte_table(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the int64 offsets of its rows. A null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of rows of about ``limit`` bytes."""
    raw, at = column_bytes(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1))
        yield lo, hi, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each run of ones in ``inside``."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = offsets[:-1][offsets[:-1] < n]
    before = np.empty_like(inside)
    before[0], before[1:] = 0, inside[:-1]
    before[first] = 0
    after = np.empty_like(inside)
    after[-1], after[:-1] = 0, inside[1:]
    after[first[first > 0] - 1] = 0
    starts = np.flatnonzero(inside > before)
    ends = np.flatnonzero(inside > after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_CACHE: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the multiplier and of its inverse, modulo 2**64."""
    if not _CACHE or len(_CACHE["up"]) < n:
        size = max(n, CHUNK + 1)
        _CACHE["up"], _CACHE["down"] = _powers(_MULTIPLIER, size), _powers(_INVERSE, size)
    return _CACHE["up"][:n], _CACHE["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def many_span_hashes(data: np.ndarray, starts: np.ndarray, ends: list[np.ndarray], segment: int = CHUNK) -> np.ndarray:
    """For each array of ``ends``, the 64-bit hashes of the spans' bytes (polynomial, then mixed). ``starts`` must ascend.

    Spans are hashed from running sums over segments of the data, so a long text needs no more memory
    than a segment, or than its longest span.
    """
    out = np.empty((len(ends), len(starts)), np.uint64)
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(starts, base + segment)))
        top = max(int(e[lo:hi].max()) for e in ends)
        up, down = powers(top - base + 1)
        sums = np.zeros(top - base + 1, np.uint64)
        np.cumsum((data[base:top].astype(np.uint64) + np.uint64(1)) * up[: top - base], out=sums[1:])
        s = starts[lo:hi] - base
        at, scale = sums[s], down[s]
        for j, end in enumerate(ends):
            e = end[lo:hi] - base
            out[j, lo:hi] = (sums[e] - at) * scale + (e - s).astype(np.uint64)
        lo = hi
    return mix(out)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, segment: int = CHUNK) -> np.ndarray:
    return many_span_hashes(data, starts, [ends], segment)[0]


_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _eight(padded: np.ndarray, starts: np.ndarray, size: np.ndarray, at: int) -> np.ndarray:
    """Bytes ``at`` to ``at`` + 8 of each span as one number; bytes after its end are zero."""
    found = np.lib.stride_tricks.sliding_window_view(padded, 8)[np.minimum(starts + at, len(padded) - 8)]
    return np.ascontiguousarray(found).view("<u8").ravel() & _FIRST_BYTES[np.clip(size - at, 0, 8)]


def same_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each span's bytes are those of the span ``starts[other], ends[other]``: by eights up to 16 bytes, longer ones byte by byte."""
    size = ends - starts
    same = size == size[other]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for at in (0, 8):
        eight = _eight(padded, starts, size, at)
        same &= eight == eight[other]
    of = np.flatnonzero(same & (size > 16) & (other != np.arange(len(starts))))
    lo = 0
    total = np.cumsum(size[of])
    while lo < len(of):  # about CHUNK bytes at once
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + CHUNK, side="right")))
        part = of[lo:hi]
        n = size[part]
        first = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(first, n)
        equal = data[np.repeat(starts[part], n) + step] == data[np.repeat(starts[other[part]], n) + step]
        wrong = np.add.reduceat(~equal, first, dtype=np.int64) > 0 if len(equal) else np.zeros(0, bool)
        same[part[wrong]] = False
        lo = hi
    return same


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` (1 or 2 dimensions) by ascending row number, zeros where a row has none."""
    out = np.zeros((n, *values.shape[1:]), np.float64)
    if len(rows):
        at = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        out[rows[at]] = np.add.reduceat(values, at, axis=0, dtype=np.float64)
    return out

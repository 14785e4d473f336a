"""Vectorised text kernels over Arrow string columns: word spans, hashes, shingles.

A string column is seen as one byte array with row offsets, so a task hashes millions of words
without making a Python string for each. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII white space as bytes 0x20 and 0x09 to 0x0D.
SPACE_BYTES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACE_BYTES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_TABLE = LOWER.tobytes()

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_WORD_FACTOR = [np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) for k in range(5)]
_tables: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(kind: str, base: int, n: int) -> np.ndarray:
    table = _tables.get(kind)
    if table is None or len(table) < n:
        size = 1 << max(16, n.bit_length())
        steps = np.full(size, np.uint64(base), np.uint64)
        steps[0] = 1
        table = _tables[kind] = np.cumprod(steps, dtype=np.uint64)
    return table[:n]


def text_slices(
    column: pa.Array, limit: int = 1 << 18
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first row, end row, bytes, offsets), each of about ``limit`` bytes.

    A row longer than that comes alone and whole.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without ASCII white space), and words per row."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offs) - 1, np.int64)
    space = IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before = np.empty(len(data), bool)
    before[0] = True
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = space[1:]
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offs))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, the same for equal bytes at any place."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * _powers("up", _BASE, len(data)), out=total[1:])
    h = (total[ends] - total[starts]) * _powers("down", _INVERSE, len(data) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def shingle_hashes(
    words: np.ndarray, counts: np.ndarray, width: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words, and how many each row has.

    A row of fewer words has one: its whole sequence. A row without words has none.
    """
    n = len(words)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    left = np.repeat(counts, counts) - (np.arange(n) - first)
    h = np.zeros(n, np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for k in range(width):
        h += np.where(left > k, padded[k:k + n], np.uint64(0)) * _WORD_FACTOR[k % 5]
    starts_here = (left >= width) | (left == np.repeat(counts, counts))
    salt = np.minimum(left, width).astype(np.uint64)
    made = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    return mix(h + salt)[starts_here], made


def row_sets(column: pa.Array, width: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text, A-Z lower-cased."""
    for lo, hi, data, offs in text_slices(column):
        low = LOWER[data]
        starts, ends, counts = word_spans(low, offs)
        hashes, made = shingle_hashes(span_hashes(low, starts, ends), counts, width)
        at = np.concatenate([[0], np.cumsum(made)])
        for i in range(hi - lo):
            own = np.sort(hashes[at[i]:at[i + 1]])
            if len(own) > 1:
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            yield lo + i, own

"""Bloom filters of bounded size, built in parts where the rows are and merged by blocks."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bourseloom.llm.store import shuffles_removed, text_batches

BLOCK_BYTES = 1 << 17
#: Keys that are put into the filters at a time.
RUN = 1 << 16
PROBES = 3


def filter_bits(keys: int, per_key: int = 16, most: int = 1 << 28) -> int:
    """Bits for about ``keys`` keys, a power of two. Never over ``most`` (32 MB).

    A fuller filter lets more rows through; callers confirm exactly, so results stay the same.
    """
    return min(most, 1 << max(20, int(keys * per_key - 1).bit_length()))


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bit places of 64-bit hashes, one row per probe."""
    keys = keys.astype(np.uint64, copy=False)
    step = ((keys >> np.uint64(32)) | np.uint64(1)) & np.uint64(0xFFFFFFFF)
    tries = np.arange(PROBES, dtype=np.uint64)[:, None]
    return (keys[None, :] + tries * step[None, :] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(
        65 - bits.bit_length())


def contains(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = places(keys, len(bitmap) * 8)
    return ((bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _set(bitmap: np.ndarray, keys: np.ndarray) -> None:
    at = places(keys, len(bitmap) * 8).ravel()
    np.bitwise_or.at(bitmap, at >> np.uint64(3),
                     np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


class OnceTwice:
    """Two filters: keys seen once, and keys seen again."""

    def __init__(self, bits: int) -> None:
        self.once, self.twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def add(self, keys: np.ndarray) -> None:
        """Keys of a run of documents, each key once per document."""
        for lo in range(0, len(keys), RUN):
            distinct, counts = np.unique(keys[lo:lo + RUN], return_counts=True)
            again = (counts > 1) | contains(self.once, distinct)
            _set(self.twice, distinct[again])
            _set(self.once, distinct)

    def parts(self) -> Iterator[tuple[int, bytes, bytes]]:
        size = min(BLOCK_BYTES, len(self.once))
        for b in range(len(self.once) // size):
            once = self.once[b * size:(b + 1) * size]
            if once.any():
                yield b, zlib.compress(once, 1), zlib.compress(self.twice[b * size:(b + 1) * size], 1)


def seen_twice(
    rows: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int, least: int = 2
) -> np.ndarray:
    """Bitmap of the keys that occur in at least ``least`` (1 or 2) documents of ``rows``.

    Each task fills both filters for its rows, in small batches, and hands on a block at a time, so
    beside the two filters it holds little. Merged, a key is seen twice where either side
    says so, or where both sides saw it once. Parts travel compressed, at about their entropy;
    each block is folded as a stream. The driver gets ``bits / 8`` bytes.
    """
    schema = "block int, once binary, twice binary"

    def fill(batches):
        both = OnceTwice(bits)
        for batch in batches:
            both.add(hashes(batch))
        for b, once, twice in both.parts():
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), pa.array([once], pa.binary()), pa.array([twice], pa.binary())],
                names=["block", "once", "twice"])

    def fold(batches):
        blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for b, o, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                once, twice = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
                if b in blocks:
                    a_once, a_twice = blocks[b]
                    blocks[b] = a_once | once, a_twice | twice | (a_once & once)
                else:
                    blocks[b] = once, twice
        got = sorted(blocks)
        yield pa.RecordBatch.from_arrays(
            [pa.array(got, pa.int32()),
             pa.array([zlib.compress(blocks[b][least - 1], 1) for b in got], pa.binary())],
            names=["block", "bits"])

    n = max(1, bits // 8 // BLOCK_BYTES)
    with shuffles_removed(rows.sparkSession), text_batches(rows.sparkSession):
        merged = rows.mapInArrow(fill, schema).repartition(n, "block").mapInArrow(
            fold, "block int, bits binary").collect()
    bitmap = np.zeros(bits // 8, np.uint8)
    size = min(BLOCK_BYTES, bits // 8)
    for row in merged:
        bitmap[row["block"] * size:(row["block"] + 1) * size] = np.frombuffer(
            zlib.decompress(row["bits"]), np.uint8)
    return bitmap

"""Lexical retrieval packing: BM25 neighbours of a seed document fill its window.

1. Documents are encoded once (``tokens``), with an end id after each, and written with two
   min-hashes of their distinct ids. Document frequencies of the ids, a table as long as the
   vocabulary, are counted over all documents on the way.
2. Rows are range-partitioned by the min-hashes, so lexically close documents share a partition.
   A task streams its partition and cuts it into shards of about ``shard_tokens`` ids: its memory
   is a shard's, however long the partition.
3. A shard has a BM25 inverted index over its documents (frequencies of the whole corpus). The
   first unused document is the seed; its unused neighbours follow by falling score until the
   window is full. A document that crosses the end of a window is cut there, and its rest is the
   next seed, so windows have no padding. Ids that at least half of all documents have are left
   out of queries, as their weight is near nothing.
4. What is left at the end of a partition goes into sequences of powers of two, which need no
   padding either.

Defined cases: a null or empty text is its end id alone; rows with one id are packed one by one;
rows are ordered by id and ids' bytes where min-hashes tie; an empty table gives an empty table;
other columns are not read. A document longer than a shard is a shard of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseloom.llm.arrays import mix
from bourseloom.llm.store import settle_texts
from bourseloom.llm.tokens import default_path, encoder

K1, B = 1.2, 0.75
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long")


def encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Rows of documents (ids as bytes, min-hashes h1, h2), and per task one row of frequencies."""
    schema = "doc_id long, n long, h1 long, h2 long, ids binary, seen binary"

    def run(batches):
        tool = encoder(path)
        size = max(tool.vocab_size, end_id + 1)
        hash1 = (mix(np.arange(size, dtype=np.uint64)) >> np.uint64(40)).astype(np.int64)
        hash2 = (mix(np.arange(size, dtype=np.uint64) + np.uint64(1 << 40)) >> np.uint64(40)).astype(np.int64)
        seen = np.zeros(size, np.int64)
        names = ["doc_id", "n", "h1", "h2", "ids", "seen"]
        types = [pa.int64()] * 4 + [pa.binary()] * 2
        for batch in batches:
            for lo, hi, ids, at in tool.slices(batch.column(1)):
                n, h1, h2, blobs = [], [], [], []
                for i in range(hi - lo):
                    own = np.append(ids[at[i]:at[i + 1]], np.array([end_id], ids.dtype))
                    flags = np.zeros(size, bool)
                    flags[own] = True
                    kinds = np.flatnonzero(flags)
                    seen[kinds] += 1
                    n.append(len(own))
                    h1.append(int(hash1[kinds].min()))
                    h2.append(int(hash2[kinds].min()))
                    blobs.append(own.tobytes())
                columns = [batch.column(0).slice(lo, hi - lo), n, h1, h2, blobs, [None] * len(n)]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, t)
                     for c, t in zip(columns, types, strict=True)], names=names)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip([None, None, None, None, None, seen.tobytes()], types, strict=True)],
            names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """Documents that have each id: one sum per id of the vocabulary comes to the driver."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                total += np.frombuffer(part, np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "docs"])

    found = np.zeros(size, np.int64)
    parts = rows.filter(F.col("seen").isNotNull()).select("seen").mapInArrow(run, "id long, docs long")
    for row in parts.groupBy("id").agg(F.sum("docs").alias("docs")).collect():
        found[row["id"]] = row["docs"]
    return found


class Shard:
    """A BM25 inverted index over the documents of a shard."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, average: float) -> None:
        terms, rows, weights = [], [], []
        self.terms = []
        for i, ids in enumerate(docs):
            counts = np.bincount(ids, minlength=0)
            own = np.flatnonzero(counts)
            own = own[idf[own] > 0]
            tf = counts[own].astype(np.float32)
            norm = K1 * (1 - B + B * len(ids) / average)
            terms.append(own)
            rows.append(np.full(len(own), i, np.int32))
            weights.append(idf[own] * tf * (K1 + 1) / (tf + norm))
            self.terms.append(own)
        term = np.concatenate(terms)
        order = np.argsort(term, kind="stable")
        self.rows, self.weights = np.concatenate(rows)[order], np.concatenate(weights)[order]
        self.at = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(idf)))])
        self.n = len(docs)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with the seed, best first (ties: shard order)."""
        own = self.terms[seed]
        lo, sizes = self.at[own], self.at[own + 1] - self.at[own]
        posted = int(sizes.sum())
        if posted <= len(own):  # nobody else has its terms (texts without any included)
            return own[:0]
        pos = np.repeat(lo - (np.cumsum(sizes) - sizes), sizes) + np.arange(posted)
        if posted * 16 < self.n:  # short lists: only the rows in them are looked at
            rows, at = np.unique(self.rows[pos], return_inverse=True)
            scores, free = np.bincount(at, self.weights[pos]), unused[rows]
        else:
            rows, free = np.arange(self.n), unused
            scores = np.bincount(self.rows[pos], self.weights[pos], minlength=self.n)
        near = np.flatnonzero((scores > 0) & free)
        return rows[near[np.argsort(-scores[near], kind="stable")]]


def chain(docs: list[np.ndarray], idf: np.ndarray, average: float, room: int, window: int) -> list[int]:
    """Order in which a shard's documents fill windows; ``room`` is left in the open window."""
    index = Shard(docs, idf, average)
    unused = np.ones(len(docs), bool)
    order: list[int] = []

    def place(i: int) -> bool:
        """Put a document next; true if it reaches the end of the window."""
        nonlocal room
        unused[i] = False
        order.append(i)
        room -= len(docs[i])
        crossed = room <= 0
        if crossed:
            room = window - (-room) % window
        return crossed

    seed, first = None, 0
    while True:
        if seed is None:
            while first < len(docs) and not unused[first]:
                first += 1
            if first == len(docs):
                return order
            seed = first
            place(seed)
        # a document cut at the window's end seeds the next window
        seed = next((i for i in index.neighbours(seed, unused).tolist() if place(i)), None)


class Packer:
    """Lays documents end to end into windows and gives the pieces of those that are full."""

    def __init__(self, window: int, base: int) -> None:
        self.window, self.next, self.open, self.filled = window, base, [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            take = min(self.window - self.filled, len(ids) - start)
            self.open.append((doc_id, start, ids[start:start + take], len(ids)))
            self.filled += take
            start += take
            if self.filled == self.window:
                yield from self._close(self.window)

    def finish(self) -> Iterator[tuple]:
        """The rest as sequences whose lengths are powers of two."""
        rest, self.open, left, self.filled = self.open, [], self.filled, 0
        while left:
            goal = 1 << (left.bit_length() - 1)
            while self.filled < goal:
                doc_id, start, ids, total = rest.pop(0)
                take = min(goal - self.filled, len(ids))
                self.open.append((doc_id, start, ids[:take], total))
                self.filled += take
                if take < len(ids):
                    rest.insert(0, (doc_id, start + take, ids[take:], total))
            yield from self._close(goal)
            left -= goal

    def _close(self, length: int) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in self.open:
            yield (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next,
                   offset, length)
            offset += len(ids)
        self.open, self.filled = [], 0
        self.next += 1


def pack(
    docs: DataFrame, window: int = 4096, end_id: int = 2, path: str | None = None,
    shard_tokens: int = 1 << 19, part_tokens: int = 1 << 22,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` ids; every id lies in one piece."""
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    path = path or default_path()
    tool = encoder(path)
    size = max(tool.vocab_size, end_id + 1)
    rows = settle_texts(encoded(docs, path, end_id), "encoded")
    texts = rows.filter(F.col("ids").isNotNull()).drop("seen")
    totals = texts.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("tokens")).first()
    n, tokens = totals["n"], totals["tokens"] or 0
    found = frequencies(rows, size)
    idf = np.log1p((n - found + 0.5) / (found + 0.5)).astype(np.float32)
    idf[2 * found >= max(n, 2)] = 0
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    average, dtype = max(1.0, tokens / max(n, 1)), np.dtype(tool.dtype)

    def run(batches):
        packer = Packer(window, TaskContext.get().partitionId() << 36)
        ids_of, arrays, held = [], [], 0

        def flush():
            out = []
            for i in chain(arrays, shared.value, average, window - packer.filled, window):
                out.extend(packer.add(ids_of[i], arrays[i]))
            return out

        def table(out):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 8)],
                names=[x.split()[0] for x in SCHEMA.split(", ")])

        for batch in batches:
            for doc_id, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(blob, dtype)
                if held and held + len(own) > shard_tokens:
                    yield table(flush())
                    ids_of, arrays, held = [], [], 0
                ids_of.append(doc_id)
                arrays.append(own)
                held += len(own)
        out = flush() if arrays else []
        yield table([*out, *packer.finish()])

    parts = max(1, -(-tokens // part_tokens))
    keys = [F.col("h1"), F.col("h2"), F.col("doc_id")]
    close = texts.repartitionByRange(parts, *keys).sortWithinPartitions(*keys, "ids")
    return close.select("doc_id", "ids").mapInArrow(run, SCHEMA)

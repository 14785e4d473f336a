"""Nearest neighbours by multi-index hashing of learned binary codes.

Vectors get one more component that makes all norms equal, so that the largest inner product is
the smallest angle. A code has the signs of the vector under several rotations; each rotation is
learned (it is turned until the signs lose least) on at most ``FIT_ROWS`` vectors, those with the
smallest hashed ids. All vectors are indexed.

A code is split into ``PARTS`` substrings, each with its own index from value to a list of rows. By the
pigeonhole principle a code within Hamming radius r of a query's differs in at most r // PARTS
bits in some substring, so probing every value that near in every substring finds them all; only the
rows in the lists of probed values have their whole codes compared, and those within r are ranked by the inner product of the original
vectors in double precision. The radius is the one within which ``AIM`` of the true neighbours lie
for the fitted sample; a query that finds fewer than k rows in an index block raises it there.

Blocks of queries meet blocks of the index: a task holds one of each. The shuffle copies the table
once per ``QUERY_BLOCK`` queries, and the queries once per ``INDEX_BLOCK`` rows. Where codes of
neighbours differ in many bits, as for directions without structure, probing leaves out little and
the work is that of comparing codes; in clusters it leaves out all but the own cluster.

Defined cases: vectors that are null, zero, hold null or non-finite components, or have another
length than most take no part, nor do rows without id; of rows with one id the smallest vector
counts; ties go to the smaller id; with fewer than k candidates all are returned; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bourseloom.llm.store import settle

BITS, PARTS = 256, 16
FIT_ROWS, FIT_QUERIES, FIT_ROUNDS, AIM = 10_000, 300, 25, 0.98
INDEX_BLOCK, QUERY_BLOCK = 50_000, 20_000
#: Rows of a column that are compared in the time of one probe of its lists.
PROBE_COST = 32
_ONES = np.bitwise_count(np.arange(1 << 16, dtype=np.uint16))
SCHEMA = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): one whole, finite, non-zero vector of the usual length per id."""
    v = F.col("embedding").cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.coalesce(whole, F.lit(False))
        & F.exists("v", lambda x: x != 0.0))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.filter(F.size("v") == (usual["d"] if usual else 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _lift(x: np.ndarray, norm: float) -> np.ndarray:
    """Index vectors with the component that brings their norm to the largest."""
    rest = np.sqrt(np.maximum(norm * norm - (x * x).sum(1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def learn(x: np.ndarray, bits: int = BITS, seed: int = 5) -> np.ndarray:
    """Columns of learned rotations side by side, ``bits`` of them."""
    random, turns = np.random.default_rng(seed), []
    while sum(t.shape[1] for t in turns) < bits:
        turn = np.linalg.qr(random.normal(size=(x.shape[1], x.shape[1])))[0]
        for _ in range(FIT_ROUNDS):
            left, _, right = np.linalg.svd(np.sign(x @ turn).T @ x)
            turn = (left @ right).T
        turns.append(turn)
    return np.concatenate(turns, axis=1)[:, :bits]


def codes(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Codes as rows of 16-bit substrings."""
    return np.ascontiguousarray(np.packbits(x @ turn > 0, axis=1)).view(np.uint16)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of all codes ``a`` to all codes ``b``."""
    total = np.zeros((len(a), len(b)), np.uint16)
    for x, y in zip(a.view(np.uint64).T, b.view(np.uint64).T, strict=True):
        total += np.bitwise_count(x[:, None] ^ y[None, :])
    return total


def fit(rows: DataFrame, k: int, norm: float) -> tuple[np.ndarray, int]:
    """The rotations and the radius, from a bounded sample."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).collect()
    x = np.array([r["v"] for r in sample])
    lifted = _lift(x, norm)
    turn = learn(lifted / norm)
    queries = np.concatenate([x[:FIT_QUERIES], np.zeros((len(x[:FIT_QUERIES]), 1))], axis=1)
    score = queries @ lifted.T
    score[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    near = np.argsort(-score, axis=1)[:, :max(1, min(k, len(x) - 1))]
    far = np.take_along_axis(distances(codes(queries, turn), codes(lifted, turn)), near, axis=1)
    return turn, int(np.quantile(far, AIM))


def masks(near: int) -> np.ndarray:
    """All 16-bit differences of at most ``near`` bits."""
    return np.flatnonzero(_ONES <= near).astype(np.uint16)


class SubstringIndex:
    """Per substring the sorted distinct values, each with the list of rows that have it."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows, self.lists = rows, []
        self.columns, self.words = np.ascontiguousarray(rows.T), np.ascontiguousarray(rows.view(np.uint64).T)
        for column in self.columns:
            order = np.argsort(column, kind="stable")
            values, starts = np.unique(column[order], return_index=True)
            self.lists.append((values, order, starts, np.append(starts[1:], len(order))))

    def reached(self, query: np.ndarray, near: int) -> np.ndarray:
        """Rows with some substring within ``near`` bits of the query's, from the lists of probed values.

        Where probes are too many for that, a substring's column is compared as a whole: the same rows.
        """
        hit, differences = np.zeros(len(self.rows), bool), masks(near)
        few = len(differences) * PROBE_COST < len(self.rows)
        for column, (values, order, starts, ends), own in zip(self.columns, self.lists, query, strict=True):
            if not few:
                hit |= np.bitwise_count(column ^ own) <= near
                continue
            probes = np.sort(differences ^ own)
            at = np.searchsorted(values, probes)
            at = at[values[np.minimum(at, len(values) - 1)] == probes]
            sizes = ends[at] - starts[at]
            hit[order[np.repeat(starts[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]] = True
        return np.flatnonzero(hit)

    def inside(self, query: np.ndarray, radius: int) -> tuple[np.ndarray, int]:
        """Rows within ``radius`` of the query, and how many codes were compared for it."""
        rows = self.reached(query, radius // len(self.lists))
        far = np.zeros(len(rows), np.uint16)
        for word, own in zip(self.words, query.view(np.uint64), strict=True):
            far += np.bitwise_count(word[rows] ^ own)
        return rows[far <= radius], len(rows)

    def within(self, query: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The same for many queries: which rows their probes reach."""
        out = np.zeros((len(query), len(self.rows)), bool)
        for i, (own, r) in enumerate(zip(query, radius, strict=True)):
            out[i, self.reached(own, int(r) // len(self.lists))] = True
        return out


def _best(ids: np.ndarray, x: np.ndarray, query_id: int, query: np.ndarray, found: np.ndarray, k: int):
    rows = found[ids[found] != query_id]
    score = (x[rows] * query).sum(axis=1)
    order = np.lexsort((ids[rows], -score))[:k]
    return ids[rows][order], score[order]


def search_block(ids, x, query_ids, queries, turn, radius: int, k: int, norm: float):
    """The k nearest rows of an index block for each query of a block of queries."""
    own = codes(_lift(x, norm), turn)
    index = SubstringIndex(own)
    lifted = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
    asked = codes(lifted, turn)
    out = []
    for query_id, query, code in zip(query_ids, queries, asked, strict=True):
        limit = radius
        found, _ = index.inside(code, limit)
        while len(found) < min(k + 1, len(ids)) and limit < BITS:
            limit += PARTS
            found, _ = index.inside(code, limit)
        near, score = _best(ids, x, query_id, query, found, k)
        out.append((np.full(len(near), query_id), near, score))
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query, its own id left out."""
    rows, asked = settle(usable(vectors), "vectors"), usable(queries)
    n, norm = rows.agg(F.count(F.lit(1)), F.sqrt(F.max(
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()
    shared = None
    if n:
        asked = settle(asked.filter(F.size("v") == len(rows.first()["v"])), "queries")
        norm = norm * (1 + 1e-12)
        turn, radius = fit(rows, k, norm)
        shared = rows.sparkSession.sparkContext.broadcast(turn)
    else:
        radius = 0
    many = max(1, -(-n // INDEX_BLOCK))
    parts = max(1, -(-(asked.count() if n else 0) // QUERY_BLOCK))
    block = lambda of, side: F.pmod(F.xxhash64("vec_id", F.lit(side)), F.lit(of)).cast("int")
    left = rows.select(block(many, "i").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("j"),
                       F.lit(0).alias("side"), "vec_id", "v")
    right = asked.select(F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("i"), block(parts, "j").alias("j"),
                         F.lit(1).alias("side"), "vec_id", "v")

    def run(table: pa.Table) -> pa.Table:
        side, ids = table["side"].to_numpy(), table["vec_id"].to_numpy()
        flat = table["v"].combine_chunks().flatten().to_numpy()
        x = flat.reshape(len(ids), -1)
        order = np.argsort(ids, kind="stable")
        a, b = order[side[order] == 0], order[side[order] == 1]
        got = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(a) and len(b):
            got = search_block(ids[a], x[a], ids[b], x[b], shared.value, radius, k, norm)
        return pa.table({"query_id": got[0], "vec_id": got[1], "score": got[2]})

    found = left.union(right).groupBy("i", "j").applyInArrow(run, SCHEMA)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)

"""Ranked lexical search by the Best Position Algorithm over impact lists.

1. Terms of the query items become a vocabulary. Every document is cut into terms once; its number of
   terms and its occurrences of vocabulary terms are written (a forward index). Collection figures are
   sums over these rows, a term's document frequency a partial sum in each task.
2. Each task reads its share of the forward index in shards of at most ``SHARD_POSTINGS`` postings and
   sorts, per term, an impact list: documents by falling contribution to the score.
3. For each item the lists are read from the top, ``FIRST_READ`` positions at first and half as many
   more in each further round. A document that comes up is scored by direct accesses to all lists of the
   item, which also marks its positions there as seen. A list's best position is the last one up to
   which all are seen; the contributions at the best positions sum up to the most that a document
   not seen can score (a list seen to its end gives nothing). Reading stops when that is strictly below
   the k-th score so far, so ties at the k-th place are all seen. A task's top documents go on from shard
   to shard, so later shards stop sooner.
4. A task passes on k rows per item at most; the top k of these are the result.

The query set is read in blocks of ``BLOCK_TERMS`` terms, one search of all documents each; no more than
a block's vocabulary is on the driver or broadcast. Terms are compared by 64-bit hashes of their bytes.

Defined cases: a null or empty text has no terms; a document without terms is not counted and never
found; an item without terms, or whose terms are in no document, gives no rows; rows of one doc_id are
documents of their own; a null doc_id comes last among equal scores; each row of the items is an item of
its own, also if its item_id repeats or is null; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bourseloom.llm.arrays import LOWER, span_hashes, text_slices
from bourseloom.llm.store import settle

K = 50
BLOCK_TERMS = 1 << 19
SHARD_POSTINGS = 1 << 21
FIRST_READ = 16
#: Fixed values of the score: its scale, and the shares of a document's length in percent.
SCALE, LENGTH_PERCENT, TF_UNIT, LENGTH_UNIT = 1_000_000_000, 50, 1000, 20
NO_ID = np.iinfo(np.int64).max

#: Bytes that belong to terms: digits, letters, and all of characters beyond ASCII.
_TERM = np.zeros(256, bool)
_TERM[0x30:0x3A] = _TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True


def term_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first row, end row, hashes of their terms in order, terms per row)."""
    for lo, hi, data, offs in text_slices(column):
        low = LOWER[data]
        inside = np.concatenate([[False], _TERM[low], [False]])
        edge = np.zeros(len(low) + 1, bool)
        edge[offs] = True
        starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1])) if len(low) else np.zeros(0, np.int64)
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1 if len(low) else starts
        h = span_hashes(low, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        yield lo, hi, h, np.diff(np.searchsorted(starts, offs))


def item_blocks(items: DataFrame, block_terms: int) -> Iterator[list[tuple[object, np.ndarray]]]:
    """The query set in blocks of (item_id, hashes of its distinct terms)."""
    block, held = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        terms = np.concatenate([h for _, _, h, _ in term_hashes(pa.array([row["text"]], pa.string()))])
        block.append((row["item_id"], np.unique(terms)))
        held += max(1, len(block[-1][1]))
        if held >= block_terms:
            yield block
            block, held = [], 0
    if block:
        yield block


def forward_index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tf) of each document with terms, written: those of the vocabulary, as numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        words = shared.value
        for batch in batches:
            for lo, hi, h, counts in term_hashes(batch.column(1)):
                row = np.repeat(np.arange(hi - lo), counts)
                at = np.minimum(np.searchsorted(words, h), max(len(words) - 1, 0))
                hit = words[at] == h if len(words) else np.zeros(len(h), bool)
                key, tf = np.unique(row[hit] * len(words) + at[hit], return_counts=True)
                cuts = np.searchsorted(key, np.arange(hi - lo + 1) * max(len(words), 1))
                terms = (key % max(len(words), 1)).astype("<u4")
                tf = tf.astype("<u4")
                keep = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi].take(pa.array(keep)), pa.array(counts[keep].astype(np.int64)),
                     pa.array([terms[cuts[i]:cuts[i + 1]].tobytes() for i in keep], pa.binary()),
                     pa.array([tf[cuts[i]:cuts[i + 1]].tobytes() for i in keep], pa.binary())],
                    names=["doc_id", "n", "terms", "tf"])

    made = settle(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, terms binary, tf binary"), "forward-index")
    shared.destroy()
    return made


def document_frequencies(index: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary is."""

    def run(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            found = b"".join(x for x in batch.column(0).to_pylist())
            df += np.bincount(np.frombuffer(found, "<u4"), minlength=size)
        here = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(df[here])], names=["term", "df"])

    total = index.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    rows, df = total.toArrow(), np.zeros(size, np.int64)
    df[rows["term"].to_numpy()] = rows["df"].to_numpy()
    return df


class Shard:
    """Impact lists of a run of documents, with direct access by document."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, terms: np.ndarray, tf: np.ndarray, per_doc: np.ndarray,
                 weights: np.ndarray, total_docs: int, total_terms: int) -> None:
        m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * total_docs) // total_terms
        doc = np.repeat(np.arange(len(ids)), per_doc)
        impact = weights[terms] * ((SCALE * tf) // (TF_UNIT * tf + LENGTH_UNIT * m[doc]))
        some = impact > 0
        doc, terms, impact = doc[some], terms[some], impact[some]
        self.ids, self.n_docs = ids, len(ids)
        by_impact = np.lexsort((doc, -impact, terms))
        self.list_doc, self.list_impact = doc[by_impact], impact[by_impact]
        by_doc = np.lexsort((doc, terms))
        self.doc, self.impact = doc[by_doc], impact[by_doc]
        place = np.empty(len(doc), np.int64)
        place[by_impact] = np.arange(len(doc))
        self.place = place[by_doc]
        self.bounds = np.searchsorted(terms[by_doc], np.arange(len(weights) + 1))
        self.seen_doc, self.seen_place = np.zeros(self.n_docs, bool), np.zeros(len(doc), bool)

    def search(self, terms: np.ndarray, top: Top) -> int:
        """Bring the shard's best documents into ``top``; how many documents were scored."""
        lists = [(self.bounds[t], self.bounds[t + 1]) for t in terms.tolist() if self.bounds[t] < self.bounds[t + 1]]
        best = np.array([lo for lo, _ in lists], np.int64)  # first place of each list that is not seen
        touched, read, step = [], 0, FIRST_READ
        marks = []
        while lists:
            found = [self.list_doc[lo + read:min(lo + read + step, hi)] for lo, hi in lists]
            docs = np.unique(np.concatenate(found))
            docs = docs[~self.seen_doc[docs]]
            self.seen_doc[docs] = True
            touched.append(docs)
            score = np.zeros(len(docs), np.int64)
            for lo, hi in lists:  # direct accesses
                own = self.doc[lo:hi]
                at = np.minimum(np.searchsorted(own, docs), hi - lo - 1)
                hit = own[at] == docs
                at = at[hit] + lo
                score[hit] += self.impact[at]
                self.seen_place[self.place[at]] = True
                marks.append(self.place[at])
            top.add(score, self.ids[docs])
            read, step, most, left = read + step, step + step // 2, 0, False
            for i, (lo, hi) in enumerate(lists):
                rest = self.seen_place[best[i]:hi]
                gap = int(np.argmin(rest)) if len(rest) and not rest.all() else len(rest)
                best[i] += gap
                if best[i] < hi:
                    left = True
                    most += int(self.list_impact[max(best[i] - 1, lo)])
            if not left or most < top.kth:
                break
        scored = sum(len(x) for x in touched)
        for x in touched:
            self.seen_doc[x] = False
        for x in marks:
            self.seen_place[x] = False
        return scored


class Top:
    """The k best (score, id) so far, higher scores first, then smaller ids."""

    def __init__(self, k: int) -> None:
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def kth(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else -1

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        fit = (score > 0) & (score >= self.kth)
        score, ids = np.concatenate([self.score, score[fit]]), np.concatenate([self.ids, ids[fit]])
        order = np.lexsort((ids, -score))[:self.k]
        self.score, self.ids = score[order], ids[order]


def shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, n, terms, tf, postings per document) of runs of documents with about ``most`` postings."""
    rows, held = [], 0

    def cut() -> tuple[np.ndarray, ...]:
        ids = np.concatenate([r[0] for r in rows])
        per_doc = np.concatenate([r[4] for r in rows])
        return (ids, *(np.concatenate([r[i] for r in rows]) for i in (1, 2, 3)), per_doc)

    for batch in batches:
        terms = [np.frombuffer(x, "<u4").astype(np.int64) for x in batch.column(2).to_pylist()]
        tf = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<u4").astype(np.int64)
        ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        sizes = np.array([len(x) for x in terms], np.int64)
        rows.append((ids, batch.column(1).to_numpy(), np.concatenate([np.zeros(0, np.int64), *terms]), tf, sizes))
        held += len(tf)
        if held >= most:
            yield cut()
            rows, held = [], 0
    if rows:
        yield cut()


def search_block(index: DataFrame, shared: Broadcast, k: int, shard_postings: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents of each item of a block."""

    def run(batches):
        items, weights, total_docs, total_terms = shared.value
        tops = [Top(k) for _ in items]
        for part in shards(batches, shard_postings):
            shard = Shard(*part, weights, total_docs, total_terms)
            for terms, top in zip(items, tops, strict=True):
                shard.search(terms, top)
        sizes = np.array([len(t.ids) for t in tops], np.int64)
        ids = np.concatenate([np.zeros(0, np.int64), *(t.ids for t in tops)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(tops)), sizes)), pa.array(ids, mask=ids == NO_ID),
             pa.array(np.concatenate([np.zeros(0, np.int64), *(t.score for t in tops)]))],
            names=["item", "doc_id", "score"])

    return index.mapInArrow(run, "item long, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS,
    shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of each item with the highest score above 0."""
    spark, out = docs.sparkSession, None
    for block in item_blocks(items, block_terms):
        vocabulary = np.unique(np.concatenate([t for _, t in block]))
        index = forward_index(docs, vocabulary)
        total = index.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        df = document_frequencies(index, len(vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * d + 1))) if d else 0
                            for d in df.tolist()], np.int64)
        terms = [np.searchsorted(vocabulary, t) for _, t in block]
        shared = spark.sparkContext.broadcast(
            ([t[weights[t] > 0] for t in terms], weights, total["docs"], total["terms"] or 1))
        found = settle(search_block(index, shared, k, shard_postings), "found")
        shared.destroy()
        ranked = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)],
                                      f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        part = found.withColumn("rank", ranked).filter(F.col("rank") <= k).join(F.broadcast(names), "item").select(
            "item_id", "rank", "doc_id", "score")
        out = part if out is None else out.union(part)
    if out is None:
        schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
        return spark.createDataFrame([], schema)
    return out

"""Token counts from the exact histogram of encoded lengths.

Documents are reduced to one row per encoded length where they are read, then merged: exact
totals over all documents. Suffix sums over the lengths answer any context limit L:
tokens(L) = sum of lengths up to L, plus L for each longer document. The suffix sums run inside
blocks of ``BLOCK`` lengths plus one total per block, so no window holds all lengths.

Defined cases: a null or empty text has length 0; an empty table gives an empty histogram; every
row counts, repeated ones too; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bourseloom.llm.tokens import default_path, encoder

BLOCK = 1024


def length_histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(length, docs): how many texts have how many tokens."""
    path = path or default_path()

    def run(batches):
        counts = np.zeros(1, np.int64)
        for batch in batches:
            for _, _, _, at in encoder(path).slices(batch.column(0)):
                own = np.bincount(np.diff(at))
                if len(own) > len(counts):
                    own[:len(counts)] += counts
                    counts = own
                else:
                    counts[:len(own)] += own
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used])],
                                         names=["length", "docs"])

    parts = docs.select("text").mapInArrow(run, "length long, docs long")
    return parts.groupBy("length").agg(F.sum("docs").alias("docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """One row per length taken as the context limit, from suffix sums.

    docs_over and tokens_over belong to longer documents; tokens_kept is the total when each text
    is cut at the limit; share_whole is the share of documents that fit.
    """
    h = histogram.withColumn("tokens", F.col("length") * F.col("docs")).withColumn(
        "block", F.floor(F.col("length") / BLOCK))
    totals = h.groupBy("block").agg(F.sum("docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    later = W.orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    totals = totals.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("block_docs").over(everything).alias("all_docs"),
        F.sum("block_tokens").over(everything).alias("all_tokens"))
    inside = W.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(W.unboundedPreceding, -1)
    return h.join(totals, "block").select(
        "length", "docs", "tokens",
        (F.col("later_docs") + F.coalesce(F.sum("docs").over(inside), F.lit(0))).alias("docs_over"),
        (F.col("later_tokens") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).alias("tokens_over"),
        "all_docs", "all_tokens").select(
        "length", "docs", "tokens", "docs_over", "tokens_over",
        (F.col("all_tokens") - F.col("tokens_over") + F.col("length") * F.col("docs_over")).alias("tokens_kept"),
        ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("share_whole"))


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_over, tokens_kept) for stated limits, whether some text has that length or not."""
    made = F.explode(F.array([F.lit(int(x)) for x in limits])).alias("context_limit")
    return histogram.select("length", "docs", made).groupBy("context_limit").agg(
        F.sum(F.when(F.col("length") > F.col("context_limit"), F.col("docs")).otherwise(0)).alias("docs_over"),
        F.sum(F.least("length", "context_limit") * F.col("docs")).alias("tokens_kept"))


def quantile(limits: DataFrame, share: float) -> int | None:
    """The smallest length that holds at least ``share`` of the documents."""
    return limits.filter(F.col("share_whole") >= share).agg(F.min("length")).first()[0]

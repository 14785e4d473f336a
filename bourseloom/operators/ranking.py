"""How well scores rank and how far their probabilities can be trusted, from counted ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseloom.operators.quantiles import known, running_counts

BINS = 10


def rank_quality(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row (n, positives, auc, average_precision) of 0/1 labels and scores, higher for class 1.

    Equal scores are one rank: half of the pairs that they make count for the area, and the precision is
    taken behind all of them. Rows without a label or score are left out. A measure is null if a class is
    missing. Scores are counted and bucketed as for quantiles; no task sorts a whole column.
    """
    rows = df.filter(F.col(label).isin(0, 1) & known(F.col(score))).select(
        F.col(score).alias("_v"), F.col(label).cast("long").alias("_y"))
    counts = rows.groupBy("_v").agg(F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"))
    ranked = running_counts(counts, [], "_v", ["pos", "neg"])
    below = F.col("cum_neg") - F.col("neg") + F.col("neg") / 2
    hits = F.col("all_pos") - F.col("cum_pos") + F.col("pos")
    taken = hits + F.col("all_neg") - F.col("cum_neg") + F.col("neg")
    totals = ranked.agg(
        F.coalesce(F.max("all_pos"), F.lit(0)).alias("positives"), F.coalesce(F.max("all_neg"), F.lit(0)).alias("_neg"),
        F.sum(F.col("pos") * below).alias("_pairs"), F.sum(F.col("pos") * hits / taken).alias("_precision"))
    both = (F.col("positives") > 0) & (F.col("_neg") > 0)
    return totals.select(
        (F.col("positives") + F.col("_neg")).alias("n"), "positives",
        F.when(both, F.try_divide("_pairs", F.col("positives").cast("double") * F.col("_neg"))).alias("auc"),
        F.when(both, F.try_divide("_precision", "positives")).alias("average_precision"))


def calibration(df: DataFrame, label: str, probability: str, bins: int = BINS) -> DataFrame:
    """(bin, n, mean_probability, positive_share) of the bins that have rows; a probability of 1 is in the last."""
    rows = df.filter(F.col(label).isin(0, 1) & known(F.col(probability)))
    place = F.least(F.floor(F.col(probability) * bins), F.lit(bins - 1)).cast("int")
    return rows.groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(probability).alias("mean_probability"),
        F.avg(F.col(label).cast("double")).alias("positive_share"))


def calibration_error(table: DataFrame) -> DataFrame:
    """One row (calibration_error, largest_gap): the mean gap of all rows, and that of the worst bin."""
    gap = F.abs(F.col("mean_probability") - F.col("positive_share"))
    return table.agg(F.try_divide(F.sum(F.col("n") * gap), F.sum("n")).alias("calibration_error"),
                     F.max(gap).alias("largest_gap"))

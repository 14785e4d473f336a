"""Drift of a numeric feature against a baseline: PSI and KS. Definitions are our own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourseloom.operators.quantiles import exact_quantiles, known, running_counts

PSI_FLOOR = 1e-6
PSI_BINS = 10


def day_summaries(df: DataFrame, time: str, value: str) -> DataFrame:
    """(day, value, n): how often each value was there on each day, to be stored.

    Exact and mergeable: sums over days are the counts of any window, so drift between any two windows
    is measured from summaries with ``weight="n"``, without the raw rows. Missing values are left out.
    """
    rows = df.filter(F.col(time).isNotNull() & known(F.col(value)))
    return rows.groupBy(F.to_date(time).alias("day"), F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def between(summaries: DataFrame, first: str, end: str) -> DataFrame:
    """The summaries of the days from ``first`` up to, not including, ``end``."""
    return summaries.filter((F.col("day") >= F.lit(first).cast("date")) & (F.col("day") < F.lit(end).cast("date")))


def quantile_edges(
    baseline: DataFrame, value: str, bins: int = PSI_BINS, weight: str | None = None
) -> DataFrame:
    """One row, ``edges``: the inner bin edges, as exact quantiles of the baseline."""
    probs = [i / bins for i in range(1, bins)]
    return exact_quantiles(baseline, [], value, probs, weight=weight).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("prob", "quantile"))),
                    lambda x: x["quantile"]).alias("edges")
    )


def _samples(baseline: DataFrame, current: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """(_v, _b, _c): each value with how often it stands for the baseline and for the current rows."""
    n, none = F.col(weight) if weight else F.lit(1), F.lit(0)
    both = baseline.select(F.col(value).alias("_v"), n.alias("_b"), none.alias("_c")).unionAll(
        current.select(F.col(value).alias("_v"), none.alias("_b"), n.alias("_c"))
    )
    return both.filter(known(F.col("_v")))


def psi(
    baseline: DataFrame, current: DataFrame, value: str, bins: int = PSI_BINS,
    floor: float = PSI_FLOOR, weight: str | None = None,
) -> DataFrame:
    """(bin, baseline_count, current_count, baseline_share, current_share, psi) per bin.

    ``weight`` names a column of repeat counts. A value on an edge belongs to the bin above. Shares are floored, so an empty bin counts.
    The edges reach the rows as a scalar subquery: a constant of ``bins - 1`` numbers.
    """
    edges = quantile_edges(baseline, value, bins, weight).scalar()
    binned = _samples(baseline, current, value, weight).select("_v", "_b", "_c", edges.alias("_edges")).select(
        "_b", "_c", F.size(F.filter("_edges", lambda e: e <= F.col("_v"))).alias("bin")
    )
    counts = binned.groupBy("bin").agg(
        F.sum("_b").alias("baseline_count"),
        F.sum("_c").alias("current_count"),
    )
    all_bins = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    full = all_bins.join(counts, "bin", "left").na.fill(0, ["baseline_count", "current_count"])
    # ten rows at most: the totals come from a window over them, not from another pass
    every = Window.partitionBy()

    def share(count: str) -> Column:
        return F.greatest(F.try_divide(F.col(count), F.sum(count).over(every)), F.lit(floor))

    shares = full.select(
        "bin", "baseline_count", "current_count",
        share("baseline_count").alias("baseline_share"),
        share("current_count").alias("current_share"),
    )
    gap = F.col("current_share") - F.col("baseline_share")
    return shares.withColumn("psi", gap * F.log(F.col("current_share") / F.col("baseline_share")))


def ks(baseline: DataFrame, current: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """One row: largest gap between the two distribution functions, and the sample sizes."""
    counts = _samples(baseline, current, value, weight).groupBy("_v").agg(
        F.sum("_b").alias("b"), F.sum("_c").alias("c")
    )
    ranked = running_counts(counts, [], "_v", ["b", "c"])
    gap = F.abs(F.col("cum_b") / F.col("all_b") - F.col("cum_c") / F.col("all_c"))
    return ranked.agg(
        F.max(gap).alias("ks"), F.max("all_b").alias("baseline_count"),
        F.max("all_c").alias("current_count"),
    )

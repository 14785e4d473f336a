"""Exact quantiles and running counts that no single task has to sort.

Values are counted first (equal values combine on the map side), then placed into
order-preserving buckets. Running totals over the buckets, a small table, give every bucket
its offset; ranks are finished inside one bucket at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_OCTAVE = 256


def known(value: Column) -> Column:
    """Neither null nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def value_bucket(value: Column, per_octave: int = BUCKETS_PER_OCTAVE) -> Column:
    """A bucket number that never decreases with the value; about 0.3 % wide at any magnitude.

    Magnitudes below 2 ** -1000 share a bucket with zero.
    """
    size = F.floor((F.log2(F.abs(value)) + 1000) * per_octave) + 1
    return F.when(F.abs(value) < 2.0 ** -1000, F.lit(0)).otherwise(
        F.signum(value).cast("long") * size)


def running_counts(
    counts: DataFrame, keys: Sequence[str], value: str, totals: Sequence[str],
    per_octave: int = BUCKETS_PER_OCTAVE,
) -> DataFrame:
    """Adds ``cum_<t>``, the running sum of each ``t`` of ``totals`` in ``value`` order, and ``all_<t>``.

    ``counts`` holds one row per (keys, value); ``keys`` must not be null. The sum over buckets
    is the only step that sees a whole key, and it sees one row per bucket.
    """
    bucket_keys = [*keys, "_bucket"]
    placed = counts.withColumn("_bucket", value_bucket(F.col(value), per_octave))
    # stated here, the null tests the join implies are the same on both of its sides, and the
    # shuffle that makes ``counts`` is done once and reused
    placed = placed.filter(reduce(and_, [F.col(k).isNotNull() for k in bucket_keys]))
    sums = placed.groupBy(*bucket_keys).agg(*[F.sum(t).alias(f"_sum_{t}") for t in totals])
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *bucket_keys,
        *[F.coalesce(F.sum(f"_sum_{t}").over(before), F.lit(0)).alias(f"_off_{t}")
          for t in totals],
        *[F.sum(f"_sum_{t}").over(whole).alias(f"all_{t}") for t in totals],
    )
    inside = (
        Window.partitionBy(*bucket_keys).orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return placed.join(offsets, bucket_keys).select(
        *keys, value, *totals, *[f"all_{t}" for t in totals],
        *[(F.sum(t).over(inside) + F.col(f"_off_{t}")).alias(f"cum_{t}") for t in totals],
    )


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
    per_octave: int = BUCKETS_PER_OCTAVE, weight: str | None = None,
) -> DataFrame:
    """(keys, prob, quantile, n): linear-interpolation quantiles of the values, missing ones left out.

    ``weight`` names a column of repeat counts. ``keys`` must not be null.
    """
    repeats = F.sum(weight) if weight else F.count(F.lit(1))
    counts = (
        df.filter(known(F.col(value))).groupBy(*keys, F.col(value).alias("_v"))
        .agg(repeats.alias("_n"))
    )
    ranked = running_counts(counts, keys, "_v", ["_n"], per_octave)

    def holds(rank: Column) -> Column:
        """The value stands at this 0-based rank."""
        return (F.col("cum__n") > rank) & (F.col("cum__n") - F.col("_n") <= rank)

    def position(prob: Column) -> Column:
        return prob * (F.col("all__n") - 1)

    wanted = F.filter(
        F.array(*[F.lit(float(p)) for p in probs]),
        lambda p: holds(F.floor(position(p))) | holds(F.ceil(position(p))),
    )
    at = position(F.col("prob"))
    return (
        ranked.withColumn("prob", F.explode(wanted))
        .groupBy(*keys, "prob")
        .agg(F.max(F.when(holds(F.floor(at)), F.col("_v"))).alias("_lo"),
             F.max(F.when(holds(F.ceil(at)), F.col("_v"))).alias("_hi"),
             F.max(at - F.floor(at)).alias("_w"), F.max("all__n").alias("n"))
        .select(*keys, "prob",
                (F.col("_lo") + F.col("_w") * (F.col("_hi") - F.col("_lo"))).alias("quantile"),
                "n")
    )

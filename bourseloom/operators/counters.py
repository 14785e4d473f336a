"""Alert rules over counter series, as a monitoring system scrapes them: totals that only grow until a restart.

A sample is (series keys, time, total). What a series has counted between two samples is the difference of
their totals; a smaller total means that the process restarted at 0, and the new total is what it counted
since. An increase is booked at the time of the sample that shows it. The first sample of a series shows no
increase: nothing is known from before. Samples may arrive in any order: series are ordered by sample time,
equal times by total, so a repeated sample adds 0; in a batch no sample is too late.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bourseloom.operators.alerts import (
    ERROR_RATE_LIMIT, LATENCY_LIMIT, LATENCY_QUANTILE, RULE_SLIDE, RULE_WINDOW, pane_of, windowed,
)
from bourseloom.operators.chunked import CHUNK, CHUNK_ROWS, carried, with_chunks

INFINITE = float("inf")


def increases(
    samples: DataFrame, keys: Sequence[str], time: str, total: str, unit: str = "hour",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(keys, time, increase) per sample with a known time and total; keys must not be null.

    Series of any length: the sample before a chunk's first one is carried over, one row per chunk.
    """
    known = samples.filter(F.col(time).isNotNull() & F.col(total).isNotNull()).select(*keys, time, total)
    rows = with_chunks(known, keys, time, unit, chunk_rows)
    last = F.max_by(total, F.struct(F.col(time), F.col(total)))
    outside = carried(rows, keys, {"_outside": last})
    inside = F.lag(total).over(Window.partitionBy(*keys, CHUNK).orderBy(time, total))
    joined = rows.withColumn("_inside", inside).join(outside, [*keys, CHUNK], "left")
    before = F.coalesce("_inside", "_outside")
    grown = F.when(before.isNull(), F.lit(0)).when(F.col(total) < before, F.col(total)).otherwise(F.col(total) - before)
    return joined.select(*keys, time, grown.alias("increase"))


def window_increases(
    increased: DataFrame, keys: Sequence[str], time: str, window: str = RULE_WINDOW, slide: str = RULE_SLIDE
) -> DataFrame:
    """(window, keys, increase): sums over sliding windows, taken per pane first."""
    panes = increased.groupBy(pane_of(time, window, slide).alias("_pane"), *keys).agg(F.sum("increase").alias("increase"))
    return windowed(panes, "_pane", window, slide).groupBy("window_start", "window_end", *keys).agg(
        F.sum("increase").alias("increase"))


def rate_alert(
    samples: DataFrame, keys: Sequence[str], time: str, total: str, window: str = RULE_WINDOW,
    slide: str = RULE_SLIDE, limit: float = ERROR_RATE_LIMIT, **chunks,
) -> DataFrame:
    """(window, increase, per_second, breached): the summed rate of all series against a limit.

    The rate is the increase over the window's length; it is not stretched to a window's edges.
    """
    grown = window_increases(increases(samples, keys, time, total, **chunks), [], time, window, slide)
    seconds = F.unix_timestamp(F.col("window_end").cast("timestamp")) - F.unix_timestamp(
        F.col("window_start").cast("timestamp"))
    rate = F.col("increase") / seconds
    return grown.select("window_start", "window_end", "increase", rate.alias("per_second"),
                        (rate > limit).alias("breached"))


def bucket_quantile_alert(
    samples: DataFrame, keys: Sequence[str], le: str, time: str, total: str, window: str = RULE_WINDOW,
    slide: str = RULE_SLIDE, quantile: float = LATENCY_QUANTILE, limit: float = LATENCY_LIMIT, **chunks,
) -> DataFrame:
    """(window, n, latency, breached): the quantile from cumulative bucket counters of all series.

    ``le`` is a bucket's upper bound, infinite for the one that counts all. Rates of one bound are summed
    over the series; where a restart that one bucket does not show leaves a bound with less than the bound
    below, it gets as much. The rank is interpolated inside its bucket, which starts at the bound below or
    at 0; a rank beyond the last finite bound gives that bound. A window without increase has no quantile
    and does not breach.
    """
    grown = window_increases(increases(samples, [*keys, le], time, total, **chunks), [le], time, window, slide)
    lists = grown.groupBy("window_start", "window_end").agg(
        F.array_sort(F.collect_list(F.struct(F.col(le).alias("le"), F.col("increase").alias("n")))).alias("_b"))
    rising = F.transform("_b", lambda x, i: F.struct(x["le"].alias("le"), F.array_max(
        F.transform(F.slice("_b", 1, i + 1), lambda y: y["n"])).alias("n")))
    lists = lists.withColumn("_b", rising)
    finite = F.filter("_b", lambda x: x["le"] < INFINITE)
    rows = lists.withColumns({"n": F.array_max(F.transform("_b", lambda x: x["n"])), "_b": finite})
    rank = F.col("n") * quantile
    below = F.size(F.filter("_b", lambda x: x["n"] < rank))
    lower, upper = F.get("_b", below - 1), F.get("_b", below)
    low, count = F.coalesce(lower["le"], F.lit(0.0)), F.coalesce(lower["n"], F.lit(0))
    inside = low + (upper["le"] - low) * F.try_divide(rank - count, upper["n"] - count)
    read = F.when(F.col("n") > 0, F.when(below == F.size("_b"), F.element_at("_b", -1)["le"]).otherwise(inside))
    return rows.select("window_start", "window_end", "n", read.alias("latency"),
                       F.coalesce(read > limit, F.lit(False)).alias("breached"))

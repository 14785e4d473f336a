"""Windowed alert rules over raw events."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourseloom.operators.quantiles import exact_quantiles, known

# Rule window, thresholds, hold time, the latency quantile, and the bucket
# bounds (seconds) a latency histogram has unless it names others.
RULE_WINDOW = "5 minutes"
RULE_SLIDE = "1 minute"
LATENCY_QUANTILE = 0.95
LATENCY_LIMIT = 1.0
ERROR_RATE_LIMIT = 0.05
HOLD_SECONDS = 300
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


def windowed(df: DataFrame, time: str, window: str, slide: str) -> DataFrame:
    """Each row once per sliding window it falls into."""
    spans = df.withColumn("_w", F.window(time, window, slide))
    return spans.withColumns({
        "window_start": F.col("_w.start"), "window_end": F.col("_w.end")
    }).drop("_w")


def pane_of(time: str, window: str, slide: str) -> Column:
    """Start of the pane of a time: the longest panes that tile every window whole."""
    seconds = [int(pd.Timedelta(x).total_seconds()) for x in (window, slide)]
    return F.window(time, f"{math.gcd(*seconds)} seconds")["start"]


def latency_alert(
    df: DataFrame, time: str, latency: str, window: str = RULE_WINDOW, slide: str = RULE_SLIDE,
    quantile: float = LATENCY_QUANTILE, limit: float = LATENCY_LIMIT,
) -> DataFrame:
    """(window, n, p95, breached): exact latency quantile per sliding window.

    Values are counted per pane before they are spread to windows, so an
    event is shuffled once, not once per window.
    """
    pane = pane_of(time, window, slide)
    panes = (
        df.filter(F.col(time).isNotNull() & known(F.col(latency)))
        .groupBy(pane.alias("_pane"), F.col(latency).alias("_latency"))
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    spread = windowed(panes, "_pane", window, slide)
    q = exact_quantiles(spread, ["window_start", "window_end"], "_latency", [quantile],
                        weight="_count")
    return q.select(
        "window_start", "window_end", "n", F.col("quantile").alias("latency"),
        (F.col("quantile") > limit).alias("breached"),
    )


def histogram_alert(
    df: DataFrame, time: str, latency: str, bounds: Sequence[float] = LATENCY_BOUNDS,
    window: str = RULE_WINDOW, slide: str = RULE_SLIDE, quantile: float = LATENCY_QUANTILE,
    limit: float = LATENCY_LIMIT,
) -> DataFrame:
    """(window, n, latency, breached): the rule as written, a quantile read off histogram buckets.

    A value counts in the first bucket whose upper bound it does not exceed. The quantile is
    interpolated inside the bucket that holds its rank; the first bucket starts at 0, and a
    rank beyond the last bound gives that bound. Windows hold one row of bucket counts.
    """
    panes = histogram_panes(df, time, latency, bounds, window, slide)
    return histogram_windows(panes, bounds, window, slide, quantile, limit)


def histogram_panes(
    df: DataFrame, time: str, latency: str, bounds: Sequence[float] = LATENCY_BOUNDS,
    window: str = RULE_WINDOW, slide: str = RULE_SLIDE,
) -> DataFrame:
    """(_pane, _all, _le0..): values up to each bound per pane; sums of such rows may be summed again."""
    known_rows = df.filter(F.col(time).isNotNull() & known(F.col(latency)))
    return known_rows.groupBy(pane_of(time, window, slide).alias("_pane")).agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.col(latency) <= b).alias(f"_le{i}") for i, b in enumerate(bounds)])


def histogram_windows(
    panes: DataFrame, bounds: Sequence[float] = LATENCY_BOUNDS, window: str = RULE_WINDOW,
    slide: str = RULE_SLIDE, quantile: float = LATENCY_QUANTILE, limit: float = LATENCY_LIMIT,
) -> DataFrame:
    totals = windowed(panes, "_pane", window, slide).groupBy("window_start", "window_end").agg(
        F.sum("_all").alias("n"), F.array(*[F.sum(f"_le{i}") for i in range(len(bounds))])
        .alias("_cum")
    )
    rank = F.col("n") * quantile
    uppers = F.array(*[F.lit(float(b)) for b in bounds])
    below = F.size(F.filter("_cum", lambda c: c < rank))
    lower_bound = F.coalesce(F.get(uppers, below - 1), F.lit(0.0))
    lower_count = F.coalesce(F.get("_cum", below - 1), F.lit(0))
    inside = (rank - lower_count) / (F.get("_cum", below) - lower_count)
    read_off = F.when(below == len(bounds), F.lit(float(bounds[-1]))).otherwise(
        lower_bound + (F.get(uppers, below) - lower_bound) * inside
    )
    return totals.select(
        "window_start", "window_end", "n", read_off.alias("latency"),
        (read_off > limit).alias("breached"),
    )


def error_alert(
    df: DataFrame, time: str, is_error: Column, window: str = RULE_WINDOW,
    slide: str = RULE_SLIDE, limit: float = ERROR_RATE_LIMIT,
) -> DataFrame:
    """(window, n, errors, errors_per_second, error_share, breached).

    The rule is on errors per second; the share of failed requests stands beside it.
    Counts are taken per pane and then summed over the panes of each window.
    """
    return error_windows(error_panes(df, time, is_error, window, slide), window, slide, limit)


def error_panes(
    df: DataFrame, time: str, is_error: Column, window: str = RULE_WINDOW, slide: str = RULE_SLIDE
) -> DataFrame:
    """(_pane, _n, _errors); sums of such rows may be summed again."""
    return df.groupBy(pane_of(time, window, slide).alias("_pane")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(is_error).alias("_errors"))


def error_windows(
    panes: DataFrame, window: str = RULE_WINDOW, slide: str = RULE_SLIDE,
    limit: float = ERROR_RATE_LIMIT,
) -> DataFrame:
    return error_rates(
        windowed(panes, "_pane", window, slide).groupBy("window_start", "window_end")
        .agg(F.sum("_n").alias("n"), F.sum("_errors").alias("errors")), limit,
    )


def error_rates(counts: DataFrame, limit: float = ERROR_RATE_LIMIT) -> DataFrame:
    """Rates from per-window ``n`` and ``errors``."""
    seconds = F.unix_timestamp(F.col("window_end").cast("timestamp")) - F.unix_timestamp(
        F.col("window_start").cast("timestamp")
    )
    rate = F.col("errors") / seconds
    return counts.select(
        "window_start", "window_end", "n", "errors", rate.alias("errors_per_second"),
        (F.col("errors") / F.col("n")).alias("error_share"), (rate > limit).alias("breached"),
    )


def firing(
    evaluated: DataFrame, alert: str, slide_seconds: int, hold_seconds: int = HOLD_SECONDS
) -> DataFrame:
    """Unbroken runs of breached evaluations and whether each held long enough to fire.

    Evaluations are ``slide_seconds`` apart; a missing one breaks the run. The input has one
    row per window, so its size follows elapsed time and not the events.
    """
    at = F.unix_timestamp(F.col("window_end").cast("timestamp"))
    order = Window.partitionBy("alert").orderBy("_at")
    runs = (
        evaluated.filter("breached")
        .select(F.lit(alert).alias("alert"), "window_end", at.alias("_at"))
        .withColumn("_run", F.col("_at") - F.row_number().over(order) * slide_seconds)
    )
    held = F.max("_at") - F.min("_at")
    return runs.groupBy("alert", "_run").agg(
        F.min("window_end").alias("pending_from"), F.max("window_end").alias("last_breach"),
        F.count(F.lit(1)).alias("evaluations"), held.alias("held_seconds"),
        (held >= hold_seconds).alias("fired"),
    ).drop("_run")

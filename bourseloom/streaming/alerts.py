"""Alert rules over streams.

A stream keeps a log of pane counts: each micro-batch adds one small row per pane it has events
of, and a replayed batch replaces its own rows. Windows are evaluated from the log by the batch
operators, so they equal the batch rule, open windows and late events included, and the stream
holds no state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bourseloom.operators.alerts import (
    ERROR_RATE_LIMIT, HOLD_SECONDS, LATENCY_BOUNDS, LATENCY_LIMIT, LATENCY_QUANTILE, RULE_SLIDE,
    RULE_WINDOW, error_panes, error_windows, firing, histogram_panes, histogram_windows,
)
from bourseloom.streaming.ingest import keep_batches, read_log


def _panes(counts: Sequence[str], time_type: str) -> T.StructType:
    return T.StructType([T.StructField("_pane", T.TimestampNTZType() if time_type == "timestamp_ntz" else T.TimestampType()),
                         *[T.StructField(c, T.LongType()) for c in counts]])


def start_error_panes(
    stream: DataFrame, time: str, is_error: Column, log: str, checkpoint: str,
    window: str = RULE_WINDOW, slide: str = RULE_SLIDE, every: str | None = None,
) -> StreamingQuery:
    return keep_batches(stream, lambda batch: error_panes(batch, time, is_error, window, slide),
                        log, checkpoint, every)


def start_latency_panes(
    stream: DataFrame, time: str, latency: str, log: str, checkpoint: str,
    bounds: Sequence[float] = LATENCY_BOUNDS, window: str = RULE_WINDOW, slide: str = RULE_SLIDE,
    every: str | None = None,
) -> StreamingQuery:
    return keep_batches(
        stream, lambda batch: histogram_panes(batch, time, latency, bounds, window, slide),
        log, checkpoint, every)


def logged_errors(
    spark: SparkSession, log: str, window: str = RULE_WINDOW, slide: str = RULE_SLIDE,
    limit: float = ERROR_RATE_LIMIT, time_type: str = "timestamp_ntz",
) -> DataFrame:
    """The error rule over all that the log holds."""
    rows = read_log(spark, log, _panes(["_n", "_errors"], time_type))
    return error_windows(rows, window, slide, limit)


def logged_latency(
    spark: SparkSession, log: str, bounds: Sequence[float] = LATENCY_BOUNDS,
    window: str = RULE_WINDOW, slide: str = RULE_SLIDE, quantile: float = LATENCY_QUANTILE,
    limit: float = LATENCY_LIMIT, time_type: str = "timestamp_ntz",
) -> DataFrame:
    """The latency rule over all that the log holds."""
    counts = ["_all", *(f"_le{i}" for i in range(len(bounds)))]
    return histogram_windows(read_log(spark, log, _panes(counts, time_type)), bounds, window, slide,
                             quantile, limit)


def fired_alerts(
    evaluated: DataFrame, alert: str, slide_seconds: int, hold_seconds: int = HOLD_SECONDS
) -> DataFrame:
    """Runs of breached windows so far: pending or fired."""
    return firing(evaluated, alert, slide_seconds, hold_seconds)

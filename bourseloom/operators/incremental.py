"""Loading only what is newer than the history, per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourseloom.functions.times import epoch_seconds, parse_history_time
from bourseloom.operators.lookup import lookup
from bourseloom.session import MARKET_ZONE

# Bars asked for beyond the gap, least request, and the first-load depth.
DEFAULT_BARS = 10_000
MIN_BARS = 10
BAR_SECONDS = {"15min": 900, "daily": 86_400}
SPARE_BARS = {"15min": 20, "daily": 5}


def latest_per_symbol(
    df: DataFrame, time_text: str = "published_at", symbol: str = "symbol",
    zone: str = MARKET_ZONE,
) -> DataFrame:
    """Newest readable time per symbol; a symbol with no readable time has no row."""
    stamped = df.select(symbol, parse_history_time(F.col(time_text), zone).alias("_t"))
    return (
        stamped.filter(F.col("_t").isNotNull() & F.col(symbol).isNotNull())
        .groupBy(symbol).agg(F.max("_t").alias("latest"))
    )


def latest_bar(df: DataFrame, time_col: str, symbol: str = "symbol") -> DataFrame:
    """Newest bar time per symbol of a typed history, null where every time is null."""
    return df.groupBy(symbol).agg(F.max(time_col).alias("latest"))


def newer_than(
    df: DataFrame, latest: DataFrame, time: Column, symbol: str = "symbol"
) -> DataFrame:
    """Rows strictly after their symbol's ``latest``; unknown symbols and unreadable times stay.

    A symbol may hold any share of the rows: see :func:`bourseloom.operators.lookup.lookup`.
    """
    cut = latest.select(symbol, F.col("latest").alias("_cut"))
    kept = lookup(df.withColumn("_t", time), cut, symbol).filter(
        F.col("_cut").isNull() | F.col("_t").isNull() | (F.col("_t") > F.col("_cut"))
    )
    return kept.select(*df.columns)


def new_rows_per_symbol(new: DataFrame, dim: DataFrame, symbol: str = "symbol") -> DataFrame:
    """New rows per dimension symbol, zero included, and a ``TOTAL`` row."""
    counts = new.groupBy(symbol).agg(F.count(F.lit(1)).alias("n"))
    per_symbol = dim.select(symbol).distinct().join(counts, symbol, "left").select(
        symbol, F.coalesce("n", F.lit(0)).alias("new_rows")
    )
    return (
        per_symbol.rollup(symbol)
        .agg(F.sum("new_rows").alias("new_rows"), F.grouping(symbol).alias("_g"))
        .select(F.when(F.col("_g") == 1, F.lit("TOTAL")).otherwise(F.col(symbol)).alias(symbol),
                "new_rows")
    )


def backfill_plan(
    latest: DataFrame, dim: DataFrame, as_of: Column, interval: str,
    default_bars: int = DEFAULT_BARS, symbol: str = "symbol",
) -> DataFrame:
    """How many bars to ask for per dimension symbol.

    The gap to ``as_of`` in whole bars (cut toward zero) plus a spare, at least
    ``MIN_BARS``; symbols without history get ``default_bars``.
    """
    gap = epoch_seconds(as_of) - epoch_seconds(F.col("latest").cast("timestamp_ntz"))
    bars = F.greatest(
        (gap / BAR_SECONDS[interval]).cast("long") + SPARE_BARS[interval], F.lit(MIN_BARS)
    )
    asked = F.when(F.col("latest").isNull(), default_bars).otherwise(bars)
    return dim.select(symbol).distinct().join(latest, symbol, "left").select(
        symbol, "latest", asked.cast("long").alias("bars")
    )

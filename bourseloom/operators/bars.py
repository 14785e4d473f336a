"""OHLC bars: localising, rounding, merging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseloom.functions.times import utc_to_market
from bourseloom.session import MARKET_ZONE

PRICE_COLS = ["open", "high", "low", "close"]
TIME_COL = {"daily": "date", "15min": "datetime"}


def localize_bars(
    df: DataFrame, interval: str, time_utc: str = "datetime", zone: str = MARKET_ZONE
) -> DataFrame:
    """Vendor bars with a UTC wall-clock time -> market-time bars of the stored shape.

    Daily bars keep the market day only. Prices round to 2 places, volume is cut to whole units.
    """
    wall = utc_to_market(F.col(time_utc), zone)
    time = F.to_date(wall).alias("date") if interval == "daily" else wall.alias("datetime")
    return df.select(
        "symbol", time, *[F.round(c, 2).alias(c) for c in PRICE_COLS],
        F.col("volume").cast("long").alias("volume"),
    )


def union_bars(*frames: DataFrame) -> DataFrame:
    """All bars, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sorted_bars(df: DataFrame, interval: str) -> DataFrame:
    """Global (symbol, time) order: range-partitioned, so a hot symbol spreads over tasks."""
    return df.orderBy("symbol", TIME_COL[interval])


def merge_summary(df: DataFrame) -> DataFrame:
    """Row count and exact distinct symbols, through per-symbol counts."""
    return (
        df.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
             F.count("symbol").alias("symbol_count"))
    )

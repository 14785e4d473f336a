"""The stock dimension and symbol resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseloom.functions.text import exchange_ticker, news_page_url
from bourseloom.operators.lookup import lookup


def usable_stocks(df: DataFrame, name_col: str) -> DataFrame:
    """Dimension rows that have a non-blank ``name_col``; header blanks are stripped."""
    named = df.toDF(*[c.strip() for c in df.columns])
    return named.filter(F.trim(name_col) != "")


def with_news_url(df: DataFrame, name_col: str = "Groww_name") -> DataFrame:
    return df.withColumn("news_url", news_page_url(F.col(name_col)))


def with_exchange(df: DataFrame, name_col: str = "TradingView_name") -> DataFrame:
    """Adds ``ticker`` and ``exchange`` read from ``EXCHANGE:TICKER``."""
    ticker, exchange = exchange_ticker(F.col(name_col))
    return df.withColumns({"ticker": ticker, "exchange": exchange})


def resolve_symbol(
    df: DataFrame, dim: DataFrame, from_col: str = "Symbol", to_col: str = "Stock_name",
    symbol: str = "symbol",
) -> DataFrame:
    """Translate ``symbol`` from one vocabulary to another; the unknown become null.

    The dimension is reduced to one row per source name first, so no row multiplies.
    """
    names = (
        dim.filter(F.col(from_col).isNotNull())
        .groupBy(F.col(from_col).alias(symbol)).agg(F.min(to_col).alias("_to"))
    )
    rest = [c for c in df.columns if c != symbol]
    return lookup(df, names, symbol).select(
        F.col("_to").alias(symbol), F.col(symbol).alias(f"source_{symbol}"), *rest
    )

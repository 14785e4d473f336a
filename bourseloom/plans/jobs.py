"""The pipeline's batch jobs, each one lazy function of its inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseloom.functions.text import clean_text
from bourseloom.functions.times import parse_history_time
from bourseloom.operators import (
    bars as B, dedupe, fill, headlines as H, incremental as I, preopen as P,
)
from bourseloom.schemas import CLEAN_HEADLINE, CLEAN_PRICE, OHLCV, RAW_PRICE
from bourseloom.session import MARKET_ZONE


def clean_headlines(raw: DataFrame, key: tuple[str, ...] = ("headline_id",)) -> DataFrame:
    """First scrape per key, text and source cleaned; cleaned-to-empty rows stay.

    Copies go before cleaning, so the patterns run once per kept row. ``key`` may add
    ``symbol`` to keep one article under several stocks.
    """
    first = dedupe.keep_first(raw.select(*CLEAN_HEADLINE.names), list(key), ["scraped_at"])
    cleaned = first.withColumns({c: clean_text(F.col(c)) for c in ("headline", "source")})
    return cleaned.select(*CLEAN_HEADLINE.names)


def clean_prices(raw: DataFrame) -> DataFrame:
    """Latest row per (symbol, date), gaps filled per column, rows still without close dropped.

    Columns beyond the contract (an arrival number, say) break ties of ``inserted_at``.
    """
    ties = [c for c in raw.columns if c not in RAW_PRICE.names]
    latest = dedupe.keep_latest(raw, ["symbol", "date"], ["inserted_at", *ties])
    filled = fill.forward_fill(latest.select(*CLEAN_PRICE.names), "symbol", "date", OHLCV)
    return filled.filter(F.col("close").isNotNull())


def feature_vectors(
    prices: DataFrame, headlines: DataFrame, date_from: str = "scraped_at",
    zone: str = MARKET_ZONE,
) -> DataFrame:
    """Clean prices with each day's headline count and texts."""
    return H.join_features(prices, H.daily_headlines(headlines, date_from, zone))


def merged_bars(*frames: DataFrame, interval: str = "daily") -> DataFrame:
    return B.sorted_bars(B.union_bars(*frames), interval)


def incremental_bars(
    existing: DataFrame, fetched: DataFrame, interval: str, arrival: str = "arrival",
) -> DataFrame:
    """Fetched bars after each stock's newest stored bar, one per bar time, last delivery kept."""
    time = B.TIME_COL[interval]
    latest = I.latest_bar(existing, time)
    new = I.newer_than(fetched, latest, F.col(time))
    return dedupe.keep_latest(new, ["symbol", time], [arrival]).drop(arrival)


def incremental_headlines(
    history: DataFrame, fetched: DataFrame, zone: str = MARKET_ZONE
) -> DataFrame:
    """Fetched headlines after each stock's newest stored time; ids are not compared here."""
    latest = I.latest_per_symbol(history, zone=zone)
    return I.newer_than(fetched, latest, parse_history_time(F.col("published_at"), zone))


def preopen_snapshot(payloads: DataFrame, fallback=None) -> DataFrame:
    """Payloads -> flat dated rows, ready for :func:`bourseloom.sources.tables.write_by_day`."""
    return P.with_trade_date(P.flatten_preopen(payloads), fallback)

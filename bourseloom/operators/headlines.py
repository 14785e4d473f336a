"""Daily headline aggregates and their join with prices."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourseloom.functions.codec import json_array
from bourseloom.functions.times import market_date
from bourseloom.operators.asof import asof_join
from bourseloom.session import MARKET_ZONE

KEYS = ["symbol", "date"]
#: Days that a headline waits for a price day at most.
CARRY_DAYS = 7


def explode_symbols(df: DataFrame) -> DataFrame:
    """One row per ticker of a comma-separated ``symbol``; off unless a caller asks for it."""
    return df.withColumn("symbol", F.explode(F.split("symbol", r"\s*,\s*")))


def dated(df: DataFrame, date_from: str = "scraped_at", zone: str = MARKET_ZONE) -> DataFrame:
    """Adds ``date``, the market day of ``date_from``."""
    return df.withColumn("date", market_date(df, date_from, zone))


def _texts(items: Column) -> Column:
    ordered = F.array_sort(items)
    return F.transform(
        F.filter(ordered, lambda x: x["headline"].isNotNull()), lambda x: x["headline"]
    )


def _item() -> Column:
    return F.struct("scraped_at", "headline_id", "headline")


def daily_headlines(
    df: DataFrame, date_from: str = "scraped_at", zone: str = MARKET_ZONE
) -> DataFrame:
    """(symbol, date) -> headline_count, headlines_json.

    Counts non-null ids and lists non-null texts, so the two may differ. Texts run in
    (scraped_at, headline_id) order. The cell holds a whole day of one symbol, as the
    feature table asks; :func:`headline_parts` gives days too large for one cell.
    """
    return daily_of(dated(df, date_from, zone))


def daily_of(dated_rows: DataFrame) -> DataFrame:
    """:func:`daily_headlines` of rows that have their ``date`` already."""
    return (
        dated_rows.groupBy(*KEYS)
        .agg(F.count("headline_id").alias("headline_count"),
             F.collect_list(_item()).alias("_items"))
        .select(*KEYS, "headline_count", json_array(_texts(F.col("_items"))).alias("headlines_json"))
    )


def headline_parts(
    df: DataFrame, part_rows: int = 10_000, date_from: str = "scraped_at",
    zone: str = MARKET_ZONE,
) -> DataFrame:
    """(symbol, date, part) -> headline_count, headlines_json with bounded parts.

    Same headlines in the same order as :func:`daily_headlines`, cut into consecutive parts, so
    no task ever holds a whole hot day. The order key is cut into slices (scrape time, then the
    first three hex digits of the id, which is a hash and spreads evenly); slice sizes are
    counted first, and runs of slices of about ``part_rows`` rows become a part. A smaller day
    is one part.
    """
    rows = dated(df, date_from, zone).withColumns({
        "_stamp": F.col("scraped_at"), "_prefix": F.substring("headline_id", 1, 3),
    })
    slice_keys = [*KEYS, "_stamp", "_prefix"]
    sizes = rows.groupBy(*slice_keys).agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy(*KEYS).orderBy("_stamp", "_prefix")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = sizes.select(
        *slice_keys,
        F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / part_rows).alias("part"),
    )
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"p.{k}")) for k in slice_keys]
    placed = rows.alias("r").join(parts.alias("p"), reduce(and_, same), "left").select(
        *[f"r.{c}" for c in (*KEYS, "scraped_at", "headline_id", "headline")], "p.part"
    )
    return (
        placed.groupBy(*KEYS, "part")
        .agg(F.count("headline_id").alias("headline_count"),
             F.collect_list(_item()).alias("_items"))
        .select(*KEYS, "part", "headline_count",
                json_array(_texts(F.col("_items"))).alias("headlines_json"))
    )


def join_features(prices: DataFrame, daily: DataFrame) -> DataFrame:
    """Every price row with its day's headlines; none gives 0 and ``[]``.

    ``daily`` is unique per (symbol, date), so the price row count stays.
    """
    return prices.join(daily, KEYS, "left").select(
        *[prices[c] for c in prices.columns],
        F.coalesce("headline_count", F.lit(0)).alias("headline_count"),
        F.coalesce("headlines_json", F.lit("[]")).alias("headlines_json"),
    )


def join_parts(
    prices: DataFrame, headlines: DataFrame, part_rows: int = 10_000, date_from: str = "scraped_at",
    zone: str = MARKET_ZONE,
) -> DataFrame:
    """(price row, headline_count of the day, part, headlines_json of the part).

    The day's count is an aggregate of its own, so no task holds a day's texts. A day without
    headlines is one part, 0, with ``[]``.
    """
    counts = dated(headlines, date_from, zone).groupBy(*KEYS).agg(
        F.count("headline_id").alias("headline_count"))
    parts = headline_parts(headlines, part_rows, date_from, zone).drop("headline_count")
    joined = prices.join(counts, KEYS, "left").join(parts, KEYS, "left")
    return joined.select(
        *[prices[c] for c in prices.columns],
        F.coalesce("headline_count", F.lit(0)).alias("headline_count"),
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("headlines_json", F.lit("[]")).alias("headlines_json"),
    )


def carried_headlines(
    df: DataFrame, prices: DataFrame, days: int = CARRY_DAYS, date_from: str = "scraped_at", zone: str = MARKET_ZONE
) -> DataFrame:
    """Every headline once, with its market day as ``news_date`` and the price day that it counts for as ``date``.

    That is the stock's first price day on or after the headline's, at most ``days`` later: news of a
    weekend or a holiday counts for the next day of trading. ``date`` is null where there is none.
    """
    rows = dated(df, date_from, zone).withColumnRenamed("date", "news_date")
    quoted = prices.select("symbol", F.col("date").alias("price_date"))
    within = F.make_dt_interval(F.lit(days))
    joined = asof_join(rows, quoted, ["symbol"], "news_date", "price_date", [], "next", within)
    return joined.withColumnRenamed("matched_price_date", "date")


def join_carried(
    prices: DataFrame, df: DataFrame, days: int = CARRY_DAYS, date_from: str = "scraped_at", zone: str = MARKET_ZONE
) -> DataFrame:
    """The feature join with headlines of days without trading carried to the next price day."""
    carried = carried_headlines(df, prices, days, date_from, zone)
    return join_features(prices, daily_of(carried.filter(F.col("date").isNotNull())))


def carry_audit(carried: DataFrame) -> DataFrame:
    """(symbol, same_day, carried, without_price): where each stock's headlines went; no text is read."""
    same = F.col("date") == F.col("news_date")
    return carried.groupBy("symbol").agg(
        F.count_if(same).alias("same_day"), F.count_if(~same).alias("carried"),
        F.count_if(F.col("date").isNull()).alias("without_price"))


def unmatched_headlines(daily: DataFrame, prices: DataFrame) -> DataFrame:
    """Headline days the feature join leaves out because no price row has their key."""
    return daily.join(prices.select(*KEYS), KEYS, "left_anti")

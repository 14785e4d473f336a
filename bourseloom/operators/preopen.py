"""Pre-open auction snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourseloom.functions.times import payload_date

# Output column <- payload field, and the crore.
FIELDS = {
    "symbol": "symbol",
    "prev_close": "previousClose",
    "iep": "iep",
    "change": "change",
    "pct_change": "pChange",
    "final_price": "lastPrice",
    "final_quantity": "finalQuantity",
    "value_crores": "totalTurnover",
    "ffm_cap_crores": "marketCap",
    "nm_52w_high": "yearHigh",
    "nm_52w_low": "yearLow",
}
CRORE = 1e7
PREVIEW_ROWS = 10


def crores(c: Column) -> Column:
    """Amount in crores, 2 places; a missing amount counts as 0."""
    return F.round(F.coalesce(c, F.lit(0.0)) / CRORE, 2)


def flatten_preopen(df: DataFrame) -> DataFrame:
    """Payload rows -> one flat row per quoted symbol, envelope kept; no item gives no row.

    A ``payload_id`` column of ``df`` (a file name, a hash of the document) stays beside the rows.
    """
    named = ["payload_id"] if "payload_id" in df.columns else []
    items = df.select(
        *named, F.explode("data").alias("_item"), "advances", "declines",
        F.col("timestamp").alias("payload_time"),
    )
    flat = []
    for out, name in FIELDS.items():
        c = F.col("_item.metadata").getField(name)
        if out == "symbol":
            c = F.coalesce(c, F.lit(""))
        elif out.endswith("_crores"):
            c = crores(c)
        flat.append(c.alias(out))
    return items.select(*named, *flat, "advances", "declines", "payload_time")


def with_trade_date(df: DataFrame, fallback: Column | None = None) -> DataFrame:
    """Adds ``trade_date`` (yyyymmdd) read from the payload stamp."""
    day = payload_date(F.col("payload_time"), fallback)
    return df.withColumn("trade_date", F.date_format(day, "yyyyMMdd"))


def by_move(df: DataFrame) -> DataFrame:
    """Largest absolute percent change first, unknown last, then symbol, price and quantity."""
    return df.orderBy(F.abs("pct_change").desc_nulls_last(), "symbol", "final_price", "final_quantity")


def top_movers(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return by_move(df).limit(n)


def item_moves(df: DataFrame) -> DataFrame:
    """Payload rows -> the change of each quoted item, envelope kept: all that :func:`breadth` reads."""
    named = ["payload_id"] if "payload_id" in df.columns else []
    return df.select(*named, F.explode("data.metadata.change").alias("change"), "advances", "declines",
                     F.col("timestamp").alias("payload_time"))


def breadth(df: DataFrame) -> DataFrame:
    """Advances and declines counted from the items of each payload, next to what it claims.

    With a ``payload_id`` column, payloads of one stamp are told apart by it, and one that is
    delivered twice is one group; without it, payloads of one stamp and claim are one group.
    """
    named = ["payload_id"] if "payload_id" in df.columns else []
    return df.groupBy(*named, "payload_time", "advances", "declines").agg(
        F.count_if(F.col("change") > 0).alias("counted_advances"),
        F.count_if(F.col("change") < 0).alias("counted_declines"),
        F.count(F.lit(1)).alias("items"),
    )

"""Market-data views over the given test tables.

Each rule is plain arithmetic on the row, so the same view can be written in any SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bourseloom.functions.text import content_id
from bourseloom.functions.times import ISO_SECONDS
from bourseloom.session import use_utc

SPLIT_DAY = "2024-01-16"
HISTORY_END = "2024-01-20"
PAYLOAD_ITEMS = 500
SYMBOLS_WITH_NEWS = 15
NO_HISTORY_SYMBOL = "U3"
NO_BARS_FROM = "U5"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _symbol(n: Column) -> Column:
    return F.concat(F.lit("U"), n.cast("string"))


def _hours(c: Column) -> Column:
    return F.make_dt_interval(F.lit(0), c.cast("int"))


def event_prices(events: DataFrame) -> DataFrame:
    """raw_prices with ``event_id`` as tie-breaker; one field per event type is missing."""
    def unless(kind: str, value: Column) -> Column:
        return F.when(F.col("event_type") == kind, None).otherwise(value)

    value = F.col("value")
    return events.select(
        _symbol(F.col("user_id")).alias("symbol"), F.to_date("ts").alias("date"),
        unless("click", value).alias("open"), unless("signup", value + 1).alias("high"),
        (value - 1).alias("low"), unless("error", value).alias("close"),
        F.get_json_object("props", "$.k").cast("long").alias("volume"),
        unless("view", value).alias("adjusted_close"), F.col("ts").alias("inserted_at"),
        "event_id",
    )


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_prices(table(spark, sf_dir, "events"))


def document_headlines(documents: DataFrame) -> DataFrame:
    """raw_headlines; ids hash the document number, scrape times spread over 30 days."""
    scraped = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + _hours(
        (F.col("doc_id") * 7) % 720
    )
    return documents.select(
        content_id(F.col("doc_id").cast("string")).alias("headline_id"),
        _symbol(F.col("doc_id") % SYMBOLS_WITH_NEWS).alias("symbol"),
        F.date_format(scraped, ISO_SECONDS).alias("published_at"), "source",
        F.col("text").alias("headline"),
        F.when(F.col("doc_id") % 4 != 0, F.concat(
            F.lit("https://news.example/"), F.col("doc_id").cast("string")
        )).alias("article_url"),
        scraped.alias("scraped_at"),
    )


def raw_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_headlines(table(spark, sf_dir, "documents"))


def _second_scrape(headlines: DataFrame) -> DataFrame:
    return headlines.withColumn("scraped_at", F.col("scraped_at") + _hours(F.lit(24)))


def repeated_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All headlines, and all of them scraped again a day later."""
    first = raw_headlines(spark, sf_dir)
    return first.unionByName(_second_scrape(first))


def staged_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All headlines, and a second scrape in which some have lost their text."""
    first = raw_headlines(spark, sf_dir)
    lost = F.when(F.col("headline_id").like("f%"), F.lit("")).otherwise(F.col("headline"))
    return first.unionByName(_second_scrape(first).withColumn("headline", lost))


def headline_history(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(stored, fetched): history to a day, for all but one symbol; some times are free text."""
    def with_free_text(df: DataFrame) -> DataFrame:
        return df.withColumn("published_at", F.when(
            F.col("headline_id").like("a%"), F.lit("2 days ago")
        ).otherwise(F.col("published_at")))

    fetched = raw_headlines(spark, sf_dir)
    stored = fetched.filter(
        (F.col("scraped_at") <= F.lit(HISTORY_END).cast("timestamp_ntz"))
        & (F.col("symbol") != NO_HISTORY_SYMBOL)
    )
    return with_free_text(stored), with_free_text(fetched)


def headline_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged headlines as JSON text: unknown keys, NaN tokens and broken documents occur."""
    staged = staged_headlines(spark, sf_dir).withColumn(
        "scraped_at", F.date_format("scraped_at", ISO_SECONDS)
    )
    text = F.to_json(F.struct("*", F.lit("x").alias("extra")))
    return staged.select(
        F.when(F.col("headline_id").like("0%"), F.lit("{broken"))
        .when(F.col("headline_id").like("1%"),
              F.lit('{"headline_id":NaN,"symbol":"U1","headline":"t"}'))
        .otherwise(text).alias("value")
    )


def price_messages(prices: DataFrame) -> DataFrame:
    """Price rows as JSON text, absent keys for nulls, plus position columns for arrival order."""
    record = F.struct(
        "symbol", F.date_format("date", "yyyy-MM-dd").alias("date"), "open", "high", "low",
        "close", "volume", "adjusted_close",
        F.date_format("inserted_at", ISO_SECONDS).alias("fetched_at"),
    )
    return prices.select(F.to_json(record).alias("value"), "inserted_at", "event_id")


def utc_bars(spark: SparkSession, sf_dir: str, interval: str) -> DataFrame:
    """Event bars with their opening time as a UTC wall clock ``datetime``."""
    length = "1 day" if interval == "daily" else "15 minutes"
    events = table(spark, sf_dir, "events").select(
        _symbol(F.col("user_id")).alias("symbol"), "ts", "value",
        F.window("ts", length)["start"].alias("datetime"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )
    return events.groupBy("symbol", "datetime").agg(
        F.min_by("value", "ts").alias("open"), F.max("value").alias("high"),
        F.min("value").alias("low"), F.max_by("value", "ts").alias("close"),
        F.sum("k").alias("volume"),
    )


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc_bars(spark, sf_dir, "daily").select(
        "symbol", F.to_date("datetime").alias("date"), "open", "high", "low", "close", "volume"
    )


def bar_history(bars: DataFrame) -> DataFrame:
    """Stored bars: to a day, and nothing yet for stocks late in the alphabet."""
    return bars.filter(
        (F.col("date") <= F.lit(HISTORY_END).cast("date")) & (F.col("symbol") < NO_BARS_FROM)
    )


def fetched_bars(bars: DataFrame) -> DataFrame:
    """Vendor delivery: every bar, then every bar again with a corrected close."""
    first = bars.withColumn("arrival", F.lit(0))
    return first.unionByName(
        bars.withColumns({"close": F.col("close") + 0.5, "arrival": F.lit(1)})
    )


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock dimension of the event users; every tenth has a blank exchange name."""
    number = F.col("user_id")
    name = number.cast("string")
    return table(spark, sf_dir, "events").select("user_id").distinct().select(
        _symbol(number).alias("Symbol"), F.concat(F.lit("Stock "), name).alias("Stock_name"),
        F.lit("Sector").alias("Sector"),
        F.when(number % 10 == 7, None).otherwise(F.concat(F.lit("stock-"), name))
        .alias("Groww_name"),
        F.when(number % 10 == 9, F.lit(" ")).otherwise(F.concat(F.lit("NSE:U"), name))
        .alias("TradingView_name"),
    )


def preopen_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quoted item per supplier and part; the mean price is rounded on whole cents.

    Only the numbers that an item is made of; :func:`quoted_item` makes the fields of the message.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"),
        F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    last = F.expr("(2 * cents + quantity) div (2 * quantity)") / 100
    change = F.round(F.col("last") - F.col("p_retailprice"), 2)
    return (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("last", last).withColumn("change", change)
        .select("l_suppkey", "l_partkey", F.col("p_retailprice").alias("prev"), "last", "change", "quantity", "cents")
    )


def quoted_item(item: Column) -> Column:
    """A struct of :func:`preopen_items` -> the item as it stands in a payload."""
    part, prev, last, change = (item[c] for c in ("l_partkey", "prev", "last", "change"))
    turnover = item["cents"] / 100
    return F.struct(
        F.concat(F.lit("P"), part.cast("string")).alias("symbol"), prev.alias("previousClose"), last.alias("iep"),
        change.alias("change"), (change / prev * 100).alias("pChange"), last.alias("lastPrice"),
        item["quantity"].alias("finalQuantity"), turnover.alias("totalTurnover"),
        F.when(part % 2 == 1, turnover * 100).alias("marketCap"),
        (prev * 2).alias("yearHigh"), (prev / 2).alias("yearLow"))


def preopen_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot documents as JSON text, one per supplier and block of part numbers.

    The block bounds the items of a document, whatever the supplier's weight. Items are gathered as the
    few numbers that they are made of, and get their other fields and texts in their document.
    """
    numbers = ["l_partkey", "prev", "last", "change", "quantity", "cents"]
    items = F.transform("items", lambda i: F.struct(quoted_item(i).alias("metadata")))
    day = F.date_add(F.lit("2026-06-01").cast("date"), (F.col("l_suppkey") % 28).cast("int"))
    stamp = F.when(F.col("l_suppkey") % 7 == 0, F.lit("pending")).otherwise(
        F.concat(F.date_format(day, "dd-MMM-yyyy"), F.lit(" 09:07:55"))
    )
    block = F.floor(F.col("l_partkey") / PAYLOAD_ITEMS)
    return (
        preopen_items(spark, sf_dir).groupBy("l_suppkey", block.alias("block"))
        .agg(F.collect_list(F.struct(*numbers)).alias("items"),
             F.count_if(F.col("change") > 0).alias("advances"),
             F.count_if(F.col("change") < 0).alias("declines"))
        .select(F.to_json(F.struct(items.alias("data"), "advances", "declines", stamp.alias("timestamp")))
                .alias("payload"))
    )


def time_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times in five spellings: instant, local ISO, legacy with and without a clock, junk."""
    kind = F.col("event_id") % 5
    spellings = [
        F.concat(F.date_format("ts", ISO_SECONDS), F.lit(".000Z")),
        F.date_format("ts", ISO_SECONDS),
        F.concat(F.date_format("ts", "d MMM yyyy, hh:mm a"), F.lit(" IST")),
        F.date_format("ts", "d MMM yyyy"),
    ]
    text = reduce(lambda acc, i: acc.when(kind == i, spellings[i]), range(1, 4),
                  F.when(kind == 0, spellings[0])).otherwise(F.lit("2 days ago"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(kind == 0, text).alias("attribute"),
        F.when(kind != 0, text).alias("title"),
    )


def drift_samples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(baseline, current): event values before and from the split day."""
    events = table(spark, sf_dir, "events")
    split = F.lit(SPLIT_DAY).cast("timestamp_ntz")
    return (events.filter(F.col("ts") < split).select("value"),
            events.filter(F.col("ts") >= split).select("value"))


def counter_samples(spark: SparkSession, sf_dir: str, bounds: list[float]) -> DataFrame:
    """(instance, ts, requests, errors, buckets): what each user's process would show after each event.

    All totals start at 0 again every day, as after a restart. ``buckets`` maps an upper bound to the
    number of values up to it, the infinite one to that of all known values.
    """
    events = table(spark, sf_dir, "events")
    so_far = (Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts", "event_id")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = [F.lit(float(b)) for b in (*bounds, float("inf"))]
    buckets = F.create_map(*[x for b in counted for x in (b, F.count_if(F.col("value") <= b).over(so_far))])
    return events.select(
        F.concat(F.lit("host-"), "user_id").alias("instance"), "ts", F.count(F.lit(1)).over(so_far).alias("requests"),
        F.count_if(F.col("event_type") == "error").over(so_far).alias("errors"), buckets.alias("buckets"))

"""Message streams into staging logs.

A staging log is a parquet folder with one ``batch_id`` partition per micro-batch. A batch
writes only its own rows, reduced to one per key; a replayed batch replaces its own
partition, so delivery is effectively once. Keys repeated over batches are settled when the
log is read (first or latest arrival) and for good by :func:`compact`. No batch rewrites or
rescans the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bourseloom.functions.codec import decode
from bourseloom.functions.times import iso_market, market_now, parse_history_time, to_market
from bourseloom.operators.dedupe import keep_first, keep_latest
from bourseloom.operators.quality import valid_headlines, valid_prices
from bourseloom.schemas import HEADLINE_MESSAGE, PRICE_MESSAGE, RAW_HEADLINE, RAW_PRICE

BATCH = "batch_id"


def accepted_headlines(messages: DataFrame, fill_scraped_at: bool = True) -> DataFrame:
    """Decoded messages that carry the required fields.

    A headline without a scrape time would belong to no day; unless ``fill_scraped_at`` is off
    it gets the message's own ``timestamp``, which a replay repeats, or where messages have none
    the clock's.
    """
    good = valid_headlines(decode(messages, HEADLINE_MESSAGE))
    if fill_scraped_at:
        arrived = (to_market(F.col("timestamp").cast("timestamp")) if "timestamp" in messages.columns
                   else market_now())
        good = good.withColumn("scraped_at", F.coalesce("scraped_at", iso_market(arrived)))
    return good


def accepted_prices(messages: DataFrame) -> DataFrame:
    return valid_prices(decode(messages, PRICE_MESSAGE))


def _start(stream: DataFrame, write, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def _write_batch(batch: DataFrame, log: str, epoch: int) -> None:
    batch.write.mode("overwrite").parquet(f"{log}/{BATCH}={epoch}")


def keep_batches(
    stream: DataFrame, shrink: Callable[[DataFrame], DataFrame], log: str, checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Each micro-batch, reduced, as a partition of a log."""
    return _start(stream, lambda batch, epoch: _write_batch(shrink(batch), log, epoch), checkpoint, every)


def start_headlines(
    messages: DataFrame, log: str, checkpoint: str, arrival: Sequence[str],
    key: Sequence[str] = ("headline_id",), every: str | None = None,
    unique_on_write: bool = False,
) -> StreamingQuery:
    """Insert-ignore: the first arrival of a key wins.

    Without ``every`` the query takes what is there and stops. ``unique_on_write`` also leaves
    out keys of earlier batches when writing, at the price of reading all stored keys per batch.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        rows = keep_first(batch, list(key), list(arrival))
        if unique_on_write and epoch > 0:
            earlier = read_log(batch.sparkSession, log, rows.schema)
            stored = earlier.filter(F.col(BATCH) < epoch).select(*key).distinct()
            rows = rows.join(stored, list(key), "left_anti")
        _write_batch(rows, log, epoch)

    return _start(accepted_headlines(messages), write, checkpoint, every)


def start_prices(
    messages: DataFrame, log: str, checkpoint: str, arrival: Sequence[str],
    key: Sequence[str] = ("symbol", "date"), every: str | None = None,
) -> StreamingQuery:
    """Upsert: the last arrival of a key replaces the whole row."""
    def write(batch: DataFrame, epoch: int) -> None:
        _write_batch(keep_latest(batch, list(key), list(arrival)), log, epoch)

    return _start(accepted_prices(messages), write, checkpoint, every)


def read_log(spark: SparkSession, log: str, schema: T.StructType) -> DataFrame:
    """All batches of a log with their ``batch_id``."""
    layout = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(layout).parquet(log)


def first_arrivals(rows: DataFrame, key: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    return keep_first(rows, list(key), [BATCH, *arrival]).drop(BATCH)


def latest_arrivals(rows: DataFrame, key: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    return keep_latest(rows, list(key), [BATCH, *arrival]).drop(BATCH)


def settled_headlines(spark: SparkSession, *logs: str) -> DataFrame:
    """raw_headlines from message logs (a compacted one and later ones): first arrival per id.

    Times are market wall clocks; ``inserted_at`` is the time of the scrape, which a replay repeats.
    """
    rows = [read_log(spark, log, HEADLINE_MESSAGE) for log in logs]
    first = first_arrivals(reduce(DataFrame.unionByName, rows), ["headline_id"], ["scraped_at"])
    scraped = parse_history_time(F.col("scraped_at"))
    return first.withColumns({"scraped_at": scraped, "inserted_at": scraped}).select(*RAW_HEADLINE.names)


def settled_prices(spark: SparkSession, *logs: str) -> DataFrame:
    """raw_prices from message logs: last arrival per stock and day."""
    rows = [read_log(spark, log, PRICE_MESSAGE) for log in logs]
    last = latest_arrivals(reduce(DataFrame.unionByName, rows), ["symbol", "date"], ["fetched_at"])
    return last.withColumns({
        "date": F.to_date("date"), "inserted_at": parse_history_time(F.col("fetched_at")),
    }).select(*RAW_PRICE.names)


def compact(
    spark: SparkSession, log: str, target: str, schema: T.StructType, settle, upto: int
) -> None:
    """Write batches up to ``upto``, settled to one row per key, as one batch of a new log.

    ``settle`` maps log rows to one row per key. The old log is left alone; readers move over.
    """
    done = read_log(spark, log, schema).filter(F.col(BATCH) <= upto)
    _write_batch(settle(done), target, upto)


def dedupe_stream(
    stream: DataFrame, key: Sequence[str], event_time: str, within: str
) -> DataFrame:
    """Drop repeats of a key that arrive within ``within`` of the first; state stays bounded."""
    return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(key))

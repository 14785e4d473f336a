import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from bourseloom.functions.codec import encode
from bourseloom.operators import alerts
from bourseloom.plans.registered import _delivered, registered
from bourseloom.schemas import HEADLINE_MESSAGE, PRICE_MESSAGE
from bourseloom.streaming import alerts as stream_alerts, ingest

VALUE = "value string, n long"


def headline(i, text, n):
    return (f'{{"headline_id":"{i}","symbol":"S","headline":"{text}"}}', n)


def price(symbol, close, n):
    return (f'{{"symbol":"{symbol}","date":"2026-01-01","close":{close},"open":1.0}}', n)


@pytest.fixture
def feed(spark, tmp_path):
    """A folder that files are dropped into, and the stream over it, one file per batch."""
    folder = str(tmp_path / "in")
    os.makedirs(folder)

    def drop(rows):
        spark.createDataFrame(rows, VALUE).coalesce(1).write.mode("append").json(folder)

    stream = spark.readStream.schema(VALUE).option("maxFilesPerTrigger", 1).json(folder)
    return drop, stream, str(tmp_path)


def headlines_now(spark, base, log="log"):
    stored = ingest.read_log(spark, f"{base}/{log}", ingest.T.StructType(
        [*HEADLINE_MESSAGE.fields, ingest.T.StructField("n", ingest.T.LongType())]))
    return stored


def start_headlines(stream, base, **options):
    ingest.start_headlines(stream, f"{base}/log", f"{base}/cp", ["n"], **options).awaitTermination()


@pytest.mark.parametrize("unique", [False, True])
def test_first_arrival_wins_over_batches(spark, feed, unique):
    drop, stream, base = feed
    drop([headline("a", "first", 1), headline("a", "later", 2), ("{broken", 3), headline("", "no id", 4)])
    start_headlines(stream, base, unique_on_write=unique)
    drop([headline("a", "again", 5), headline("b", "new", 6)])
    start_headlines(stream, base, unique_on_write=unique)
    stored = headlines_now(spark, base)
    assert stored.count() == (2 if unique else 3)
    got = ingest.first_arrivals(stored, ["headline_id"], ["n"]).select("headline_id", "headline").collect()
    assert sorted(map(tuple, got)) == [("a", "first"), ("b", "new")]


def test_a_replayed_batch_changes_nothing(spark, feed):
    drop, stream, base = feed
    drop([headline("a", "first", 1), headline("b", "x", 2)])
    start_headlines(stream, base)
    seen = ["headline_id", "headline", "n", "batch_id"]
    before = sorted(map(tuple, headlines_now(spark, base).select(*seen).collect()))
    ingest.start_headlines(stream, f"{base}/log", f"{base}/cp-lost", ["n"]).awaitTermination()
    assert sorted(map(tuple, headlines_now(spark, base).select(*seen).collect())) == before


def test_missing_scrape_time_becomes_ingest_time(spark):
    df = spark.createDataFrame([headline("a", "x", 1)], VALUE)
    assert ingest.accepted_headlines(df).first()["scraped_at"].endswith("+05:30")
    assert ingest.accepted_headlines(df, fill_scraped_at=False).first()["scraped_at"] is None


def test_last_price_wins_and_compaction_agrees(spark, feed):
    drop, stream, base = feed
    schema = ingest.T.StructType([*PRICE_MESSAGE.fields, ingest.T.StructField("n", ingest.T.LongType())])

    def run():
        ingest.start_prices(stream, f"{base}/log", f"{base}/cp", ["n"]).awaitTermination()

    drop([price("A", 1.0, 1), price("A", 2.0, 2), price("B", "null", 3)])
    run()
    drop([price("A", 3.0, 4), price("C", 0.0, 5)])
    run()
    settle = lambda df: ingest.latest_arrivals(df, ["symbol", "date"], ["n"])
    stored = ingest.read_log(spark, f"{base}/log", schema)
    want = sorted((r["symbol"], r["close"]) for r in settle(stored).collect())
    assert want == [("A", 3.0), ("C", 0.0)]
    ingest.compact(spark, f"{base}/log", f"{base}/compacted", schema, settle, upto=1)
    packed = ingest.read_log(spark, f"{base}/compacted", schema)
    assert sorted((r["symbol"], r["close"]) for r in packed.collect()) == want


def test_missing_scrape_time_is_the_messages_own(spark):
    df = spark.createDataFrame([("{", 0), headline("a", "x", 1), headline("b", "y", 2)], VALUE)
    stamped = df.withColumn("timestamp", F.lit("2026-01-01 00:00:00").cast("timestamp"))
    got = ingest.accepted_headlines(stamped).select("scraped_at").distinct().collect()
    assert len(ingest.accepted_headlines(df).collect()) == 2
    assert [r[0] for r in got] == ["2026-01-01T05:30:00+05:30"]


def file_stream(spark, df, folder, parts=3):
    """The rows as a stream of several micro-batches."""
    df.repartition(parts).write.parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_windows_equal_batch_windows(spark, tmp_path):
    first = dt.datetime(2026, 1, 1)
    rows = [(first + dt.timedelta(seconds=20 * i), float(i % 100), i % 4 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double, bad boolean")
    stream = file_stream(spark, df, str(tmp_path / "in"))
    log = [str(tmp_path / x) for x in ("errors", "latency", "c1", "c2")]
    stream_alerts.start_error_panes(stream, "ts", F.col("bad"), log[0], log[2]).awaitTermination()
    stream_alerts.start_latency_panes(stream, "ts", "v", log[1], log[3], [10.0, 50.0, 90.0]).awaitTermination()
    assert len(list((tmp_path / "errors").glob("batch_id=*"))) == 3
    key = lambda df: sorted(map(tuple, df.collect()))
    errors = stream_alerts.logged_errors(spark, log[0])
    assert key(errors) == key(alerts.error_alert(df, "ts", F.col("bad")))
    latency = stream_alerts.logged_latency(spark, log[1], [10.0, 50.0, 90.0])
    assert key(latency) == key(alerts.histogram_alert(df, "ts", "v", [10.0, 50.0, 90.0]))
    runs = stream_alerts.fired_alerts(errors, "e", 60)
    assert key(runs) == key(alerts.firing(alerts.error_alert(df, "ts", F.col("bad")), "e", 60))


def test_encoded_rows_can_be_read_back(spark):
    df = spark.createDataFrame([("a", "S", None, None, "t", None, None)], HEADLINE_MESSAGE)
    assert ingest.accepted_headlines(encode(df)).count() == 1


def test_streams_read_a_table_that_is_a_folder(spark, sf_dir, tmp_path):
    for name in ("documents", "events"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("stream_headlines", "stream_prices"):
        made, wanted = (registered()[name](spark, d) for d in (str(tmp_path), sf_dir))
        assert sorted(map(str, made.collect())) == sorted(map(str, wanted.collect()))


def test_a_delivery_of_many_files_is_one_micro_batch(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.range(60).select(F.format_string('{"headline_id":"%d","symbol":"S","headline":"t"}', "id").alias("value"))
    _delivered(spark, [rows.repartition(7), rows.repartition(5)], "many-files", lambda stream: ingest.start_headlines(
        stream, f"{base}/log", f"{base}/checkpoint", ["scraped_at"]).awaitTermination())
    assert sorted(d for d in os.listdir(f"{base}/log") if d.startswith("batch_id=")) == ["batch_id=0", "batch_id=1"]
    assert ingest.read_log(spark, f"{base}/log", HEADLINE_MESSAGE).count() == 120

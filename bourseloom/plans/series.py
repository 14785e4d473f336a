"""Registered queries over ordered series, streams with state, models in closed form, day summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourseloom.functions import codec, times as C
from bourseloom.operators import asof, bayes, counters, drift, headlines, ranking, recurrences
from bourseloom.operators.lookup import stored
from bourseloom.plans.registered import (
    ERROR_LIMIT, HOLD_SECONDS, LATENCY_BOUNDS, LATENCY_LIMIT, SLIDE, SLIDE_SECONDS, WINDOW, _clean_headlines,
    _clean_prices, _delivered, query,
)
from bourseloom.schemas import HEADLINE_MESSAGE
from bourseloom.session import work_dir
from bourseloom.sources import stand_ins as V
from bourseloom.streaming import ingest, stateful


def _rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


# --- as-of joins --------------------------------------------------------------------------------


@query
def asof_headlines(spark: SparkSession, sf: str) -> DataFrame:
    """Each headline with its stock's next price day and close, at most a week later."""
    rows = headlines.dated(V.raw_headlines(spark, sf)).select("headline_id", "symbol", "date")
    quoted = _clean_prices(spark, sf).select("symbol", F.col("date").alias("price_date"), "close")
    return asof.asof_join(rows, quoted, ["symbol"], "date", "price_date", ["close"], "next",
                          F.make_dt_interval(F.lit(headlines.CARRY_DAYS)))


@query
def asof_last_quote(spark: SparkSession, sf: str) -> DataFrame:
    """Each headline with its stock's last quote at or before its scrape, at most a day old."""
    rows = V.raw_headlines(spark, sf).select("headline_id", "symbol", "scraped_at")
    quotes = V.raw_prices(spark, sf).select("symbol", F.col("inserted_at").alias("quoted_at"), "close", "volume")
    return asof.asof_join(rows, quotes, ["symbol"], "scraped_at", "quoted_at", ["close", "volume"], "last",
                          F.make_dt_interval(F.lit(1)), unit="hour")


@query
def feature_vectors_carried(spark: SparkSession, sf: str) -> DataFrame:
    return headlines.join_carried(_clean_prices(spark, sf), _clean_headlines(spark, sf))


@query
def headline_carry_audit(spark: SparkSession, sf: str) -> DataFrame:
    news = V.raw_headlines(spark, sf).select("symbol", "scraped_at")
    return headlines.carry_audit(headlines.carried_headlines(news, _clean_prices(spark, sf)))


# --- recursive indicators -----------------------------------------------------------------------


@query
def recursive_indicators(spark: SparkSession, sf: str) -> DataFrame:
    made = recurrences.recursive_indicators(_clean_prices(spark, sf))
    return _rounded(made, 6, *[c for c in made.columns if c not in ("symbol", "date", "close")])


# --- counters -----------------------------------------------------------------------------------


@query
def counter_error_rate(spark: SparkSession, sf: str) -> DataFrame:
    samples = V.counter_samples(spark, sf, LATENCY_BOUNDS)
    made = counters.rate_alert(samples, ["instance"], "ts", "errors", WINDOW, SLIDE, ERROR_LIMIT)
    return _rounded(made, 8, "per_second")


@query
def counter_latency(spark: SparkSession, sf: str) -> DataFrame:
    samples = V.counter_samples(spark, sf, LATENCY_BOUNDS)
    buckets = samples.select("instance", "ts", F.explode("buckets").alias("le", "total"))
    made = counters.bucket_quantile_alert(buckets, ["instance"], "le", "ts", "total", WINDOW, SLIDE,
                                          limit=LATENCY_LIMIT)
    return _rounded(made, 4, "latency")


# --- streams with state -------------------------------------------------------------------------


def _news_messages(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.document_headlines(V.table(spark, sf, "documents"))
    return rows.withColumn("scraped_at", F.date_format("scraped_at", C.ISO_SECONDS))


@query
def stream_first_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Messages in three micro-batches, every id again with another text in a later one: the first stays."""
    base = work_dir(spark, "first-arrivals")
    news = _news_messages(spark, sf)
    again = news.withColumn("headline", F.lit("a later text"))
    early = F.col("headline_id") < "8"
    parts = [news.filter(early), news.filter(~early).unionByName(again.filter(early)), again]

    def run(stream: DataFrame) -> None:
        accepted = ingest.accepted_headlines(stream)
        timed = accepted.withColumn("_at", C.parse_history_time(F.col("scraped_at")).cast("timestamp"))
        stateful.start_first_arrivals(timed, ["headline_id"], "_at", "60 days", f"{base}/out",
                                      f"{base}/checkpoint").awaitTermination()

    _delivered(spark, [codec.encode(x) for x in parts], "first-messages", run)
    return spark.read.parquet(f"{base}/out").select(*HEADLINE_MESSAGE.names)


@query
def stream_bounded_headlines(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over one checkpoint, the first stopped after a third of the messages: nothing is lost."""
    base = work_dir(spark, "bounded")
    news = _news_messages(spark, sf)
    parts = [news.filter(F.col("headline_id").between(lo, hi)) for lo, hi in (("0", "4"), ("4", "8"), ("8", "g"))]
    folder = work_dir(spark, "bounded-messages")
    for number, part in enumerate(parts):
        codec.encode(part).select("value").write.text(f"{folder}/delivery={number}")
    first = len(spark.read.text(f"{folder}/delivery=0").inputFiles())  # micro-batches of a third, not of a file
    stream = (spark.readStream.schema("value string").option("maxFilesPerTrigger", max(1, first))
              .option("recursiveFileLookup", True).text(folder))

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/log/{ingest.BATCH}={epoch}")

    accepted = ingest.accepted_headlines(stream)
    for wanted in (1, 1 << 62):
        stateful.consume_until(accepted, wanted, write, f"{base}/checkpoint")
    return ingest.read_log(spark, f"{base}/log", HEADLINE_MESSAGE).drop(ingest.BATCH)


@query
def stream_alert_states(spark: SparkSession, sf: str) -> DataFrame:
    """The error rule with timers, three deliveries and a restart before each: runs of breached windows."""
    base = work_dir(spark, "alert-states")
    events = V.table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    cuts = [F.lit(d).cast("timestamp") for d in ("1970-01-01", "2024-01-11", "2024-01-20", "2100-01-01")]
    for n in range(3):
        part = events.filter((F.col("ts") >= cuts[n]) & (F.col("ts") < cuts[n + 1]))
        part.write.parquet(f"{base}/in/delivery={n}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(f"{base}/in")
        stateful.start_closed_windows(
            stream, "ts", F.col("event_type") == "error", "1 hour", f"{base}/windows", f"{base}/window-checkpoint",
            WINDOW, SLIDE, ERROR_LIMIT).awaitTermination()
        stateful.start_transitions(spark, f"{base}/windows", f"{base}/out", f"{base}/checkpoint", SLIDE_SECONDS,
                                   HOLD_SECONDS).awaitTermination()
    made = stateful.runs_of(spark.read.parquet(f"{base}/out"))
    return made.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pending_from", "resolved_at")})


# --- models in closed form ----------------------------------------------------------------------


def _bayes(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of texts; odds are rounded first, so that ranks do not hang on the order of sums."""
    docs = V.table(spark, sf, "documents").select("doc_id", "text")
    made = bayes.cross_scored(docs, V.table(spark, sf, "labels"), "doc_id", "text", "quality")
    odds = F.round("log_odds", 6)
    return made.withColumn("log_odds", odds).withColumns({
        "probability": 1 / (1 + F.exp(-F.col("log_odds"))), "predicted": (F.col("log_odds") > 0).cast("int")})


@query
def sentiment_bayes(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_bayes(spark, sf), 6, "probability")


@query
def sentiment_rank_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The held-out scores of the labelled documents: ranking and calibration in one row."""
    held_out = _bayes(spark, sf).filter(F.col("label").isNotNull())
    ranked = ranking.rank_quality(held_out, "label", "log_odds")
    error = ranking.calibration_error(ranking.calibration(held_out, "label", "probability"))
    both = ranked.withColumns({c: error.select(c).scalar() for c in error.columns})
    return _rounded(both, 6, "auc", "average_precision", "calibration_error", "largest_gap")


@query
def sentiment_calibration(spark: SparkSession, sf: str) -> DataFrame:
    made = ranking.calibration(_bayes(spark, sf), "label", "probability")
    return _rounded(made, 6, "mean_probability", "positive_share")


# --- drift from day summaries -------------------------------------------------------------------

#: First day of the current rows, and the ends of the windows that are compared with the days before it.
DRIFT_DAY, DRIFT_ENDS = "2024-01-16", ["2024-01-23", "2100-01-01"]


def _day_windows(spark: SparkSession, sf: str) -> list[tuple[str, DataFrame, DataFrame]]:
    """Each window's name, baseline and current summaries; the events are read once for all of them."""
    days = stored(drift.day_summaries(V.table(spark, sf, "events"), "ts", "value"), "day-summaries")
    before = drift.between(days, "1970-01-01", DRIFT_DAY)
    return [(end, before, drift.between(days, DRIFT_DAY, end)) for end in DRIFT_ENDS]


@query
def drift_days_psi(spark: SparkSession, sf: str) -> DataFrame:
    made = [drift.psi(before, now, "value", weight="n").withColumn("window_end", F.lit(end))
            for end, before, now in _day_windows(spark, sf)]
    both = made[0].unionByName(made[1])
    return _rounded(both, 6, "baseline_share", "current_share", "psi")


@query
def drift_days_ks(spark: SparkSession, sf: str) -> DataFrame:
    made = [drift.ks(before, now, "value", weight="n").withColumn("window_end", F.lit(end))
            for end, before, now in _day_windows(spark, sf)]
    return _rounded(made[0].unionByName(made[1]), 8, "ks")

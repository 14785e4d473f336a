"""Streams with state: first arrivals, alert timers, bounded runs, over micro-batches and restarts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from bourseloom.operators import alerts
from bourseloom.streaming import stateful

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def hours(n):
    return T0 + dt.timedelta(hours=n)


@pytest.fixture
def feed(spark, tmp_path):
    """Drops rows as one file of a folder, and streams over it, one file per micro-batch."""
    folder = str(tmp_path / "in")

    def drop(rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)

    def stream(schema, files=1):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)

    return drop, stream, str(tmp_path)


def test_a_key_is_kept_once_and_state_is_forgotten(spark, feed):
    drop, stream, base = feed
    schema = "id string, at timestamp, text string"

    def run():
        query = stateful.start_first_arrivals(stream(schema), ["id"], "at", "2 hours", f"{base}/out", f"{base}/cp")
        query.awaitTermination()
        return stateful.state_rows(query)

    drop([("a", hours(0), "first"), ("b", hours(0), "first"), ("c", hours(1), "first")], schema)
    assert run() == 3
    drop([("a", hours(1), "again"), ("d", hours(1), "first"), (None, hours(1), "first")], schema)
    run()
    drop([("e", hours(30), "first")], schema)
    run()
    drop([("b", hours(29), "long after"), ("e", hours(30), "again")], schema)
    assert run() <= 2
    got = sorted((r["id"] or "", r["text"]) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [("", "first"), ("a", "first"), ("b", "first"), ("b", "long after"), ("c", "first"),
                   ("d", "first"), ("e", "first")]


def error_rows(spans, until):
    """An event every half hour; those in ``spans`` of hours are errors."""
    return [(hours(h / 2), "error" if any(lo <= h / 2 < hi for lo, hi in spans) else "view") for h in range(2 * until)]


def follow(spark, stream, base):
    stateful.start_closed_windows(
        stream, "ts", F.col("event_type") == "error", "10 minutes", f"{base}/windows", f"{base}/cp1", "2 hours",
        "1 hour", 1.5 / 7200).awaitTermination()
    stateful.start_transitions(spark, f"{base}/windows", f"{base}/out", f"{base}/cp2", 3600, 10_800).awaitTermination()


def test_a_timer_ends_a_run_without_evaluations(spark, feed):
    """The windows of one alert stop coming; the evaluations of another one move the watermark on."""
    drop, stream, base = feed
    schema = "alert string, closed_at timestamp, window_end timestamp, breached boolean"
    ends = lambda alert, lo, hi: [(alert, hours(h) - dt.timedelta(microseconds=1), hours(h), True)
                                  for h in range(lo, hi)]
    for rows in (ends("a", 1, 6) + ends("b", 1, 6), ends("b", 6, 9), ends("b", 9, 12), ends("a", 12, 13)):
        drop(rows, schema)
        stateful.start_transitions(spark, f"{base}/in", f"{base}/out", f"{base}/cp", 3600, 10_800).awaitTermination()
    got = [(r["state"], r["at"]) for r in spark.read.parquet(f"{base}/out").filter("alert = 'a'").orderBy("at").collect()]
    naive = lambda h: hours(h).replace(tzinfo=None)
    assert got == [("pending", naive(1)), ("firing", naive(4)), ("resolved", naive(6)), ("pending", naive(12))]


def test_alert_states_equal_the_batch_rule(spark, feed):
    drop, stream, base = feed
    schema = "ts timestamp, event_type string"
    rows = error_rows([(3, 5), (12, 24), (30, 31), (45, 48)], 60)
    is_error = F.col("event_type") == "error"
    for part in (rows[:20], rows[20:45], rows[45:90], rows[90:]):
        drop(part, schema)
        follow(spark, stream(schema), base)
    events = spark.read.parquet(f"{base}/out")
    got = {r["pending_from"]: r for r in stateful.runs_of(events).collect()}
    batch = alerts.firing(alerts.error_alert(
        spark.createDataFrame(rows, schema), "ts", is_error, "2 hours", "1 hour", 1.5 / 7200), "errors", 3600, 10_800)
    want = {r["pending_from"]: r for r in batch.collect()}
    assert set(got) == set(want) and len(want) == 4
    for start, r in want.items():
        assert (got[start]["fired"], got[start]["evaluations"]) == (r["fired"], r["evaluations"])
        assert got[start]["resolved_at"] == r["last_breach"] + dt.timedelta(hours=1)
    assert [r["state"] for r in events.filter(F.col("pending_from") == max(
        want, key=lambda s: want[s]["evaluations"])).orderBy("at").collect()] == ["pending", "firing", "resolved"]


def test_an_open_alert_has_no_end(spark, feed):
    drop, stream, base = feed
    schema = "ts timestamp, event_type string"
    drop(error_rows([(3, 20)], 20), schema)
    follow(spark, stream(schema), base)
    run, = stateful.runs_of(spark.read.parquet(f"{base}/out")).collect()
    assert run["fired"] and run["resolved_at"] is None and run["evaluations"] is None


def test_bounded_runs_follow_each_other(spark, feed):
    drop, stream, base = feed
    schema = "n long, good boolean"
    for lo in range(0, 50, 10):
        drop([(i, i % 5 != 0) for i in range(lo, lo + 10)], schema)
    seen = []

    def run(wanted):
        got = stateful.consume_until(
            stream(schema).filter("good"), wanted, lambda b, e: seen.append((e, sorted(r["n"] for r in b.collect()))),
            f"{base}/cp")
        return got

    assert run(0) == 0 and not seen
    assert run(9) == 16 and len(seen) == 2
    assert run(1) == 8
    assert run(1000) == 16
    assert run(1000) == 0
    assert [n for _, part in sorted(seen) for n in part] == [i for i in range(50) if i % 5]
    assert len({e for e, _ in seen}) == 5


def test_a_failing_writer_is_told(spark, feed):
    drop, stream, base = feed
    drop([(1, True)], "n long, good boolean")

    def broken(batch, epoch):
        raise RuntimeError("disk full")

    with pytest.raises(Exception, match="disk full"):
        stateful.consume_until(stream("n long, good boolean"), 5, broken, f"{base}/cp")


def test_closed_windows_are_written_by_many_tasks(spark, feed, tmp_path):
    drop, stream, base = feed
    schema = "ts timestamp, event_type string"
    drop(error_rows([(3, 5)], 80), schema)
    follow(spark, stream(schema), base)
    files = [f for f in os.listdir(f"{base}/windows") if f.endswith(".parquet")]
    assert len(files) > 2  # two micro-batches: one with the events, one that closes windows

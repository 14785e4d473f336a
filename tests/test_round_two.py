"""Cases that once gave wrong answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bourseloom.functions import times as C
from bourseloom.operators import alerts, dedupe, fill, headlines, preopen, quantiles


@pytest.mark.parametrize("text,want", [
    ("2026-06-07T07:25Z", dt.datetime(2026, 6, 7, 12, 55)),
    ("2026-06-07 07:25+05:30", dt.datetime(2026, 6, 7, 7, 25)),
    ("2026-06-07T07:25", dt.datetime(2026, 6, 7, 12, 55)),
    ("2026-06-07", dt.datetime(2026, 6, 7, 5, 30)),
    ("2026-06-07T07:25:10.5Z", dt.datetime(2026, 6, 7, 12, 55, 10, 500000)),
    ("07:25", None),
])
def test_instants_of_any_precision(spark, text, want):
    assert spark.range(1).select(C.parse_instant(F.lit(text))).first()[0] == want


@pytest.mark.parametrize("window,slide", [(5, 2), (6, 4), (5, 1), (7, 3)])
def test_windows_that_are_no_multiple_of_the_slide(spark, window, slide):
    first = dt.datetime(2026, 1, 1)
    rows = [(first + dt.timedelta(seconds=i), i % 3 == 0) for i in range(0, 1800, 7)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, bad boolean")
    got = {r["window_start"]: (r["n"], r["errors"]) for r in alerts.error_alert(
        df, "ts", F.col("bad"), f"{window} minutes", f"{slide} minutes").collect()}
    for start, counts in got.items():
        own = [b for t, b in rows if start <= t < start + dt.timedelta(minutes=window)]
        assert counts == (len(own), sum(own))
    assert sum(n for n, _ in got.values()) == sum(
        1 for t, _ in rows for k in range(-window, 1800 // 60 + 1)
        if ((first - dt.datetime(1970, 1, 1)).total_seconds() // 60 + k) % slide == 0
        and first + dt.timedelta(minutes=k) <= t < first + dt.timedelta(minutes=k + window))


def test_latest_row_does_not_depend_on_input_order(spark):
    rows = [("A", 1, 1.0), ("A", 1, 2.0), ("A", 1, None)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, at int, v double").coalesce(1)
        assert [r["v"] for r in dedupe.keep_latest(df, ["k"], ["at"]).collect()] == [2.0]


def test_payloads_with_equal_claims_stay_apart(spark):
    rows = [("p1", "t", 1, 0, 2.0), ("p2", "t", 1, 0, -1.0), ("p2", "t", 1, 0, -2.0)]
    df = spark.createDataFrame(rows, "payload_id string, payload_time string, advances int, declines int, change double")
    got = {r["payload_id"]: (r["counted_advances"], r["counted_declines"]) for r in preopen.breadth(df).collect()}
    assert got == {"p1": (1, 0), "p2": (0, 2)}


@pytest.mark.parametrize("scale", [1e-12, 1e-3, 1.0, 1e9])
def test_small_values_spread_over_buckets(spark, scale):
    values = spark.range(100_000).select(((F.col("id") - 50_000) * scale / 50_000).alias("v"))
    placed = values.select("v", quantiles.value_bucket(F.col("v")).alias("b"))
    assert placed.select("b").distinct().count() > 2000
    ordered = placed.orderBy("v").select(F.collect_list("b")).first()[0]
    assert ordered == sorted(ordered)
    q = quantiles.exact_quantiles(values.withColumn("k", F.lit(1)), ["k"], "v", [0.25]).first()["quantile"]
    assert q == pytest.approx(-0.5 * scale, rel=1e-4)


def test_counted_chunks_fill_like_one_window(spark):
    first = dt.datetime(2026, 1, 1)
    rows = [("A" if i % 3 else "B", first + dt.timedelta(seconds=7 * i), float(i) if i % 5 == 0 else None)
            for i in range(600)]
    df = spark.createDataFrame(rows, "s string, t timestamp_ntz, v double")
    got = fill.forward_fill_counted(df, "s", "t", ["v"], "minute", chunk_rows=20)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, fill.forward_fill(df, "s", "t", ["v"]).collect()))


def test_hot_day_is_cut_into_parts(spark):
    """A third of the headlines on one stock and day: no part, and so no cell, holds that day."""
    day = dt.datetime(2026, 1, 5)
    rows = [(f"{i * 2654435761 % 2**32:08x}", "HOT" if i % 3 == 0 else f"S{i % 50}", f"text {i}", day + dt.timedelta(
        seconds=i if i % 3 == 0 else i * 60)) for i in range(3000)]
    news = spark.createDataFrame(rows, "headline_id string, symbol string, headline string, scraped_at timestamp_ntz")
    prices = spark.createDataFrame([("HOT", day.date()), ("S1", day.date()), ("NONE", day.date())], "symbol string, date date")
    got = headlines.join_parts(prices, news, part_rows=100).collect()
    hot = [r for r in got if r["symbol"] == "HOT"]
    assert {r["headline_count"] for r in hot} == {1000} and len(hot) >= 10
    assert max(r["headlines_json"].count("text") for r in hot) <= 110
    assert sum(r["headlines_json"].count("text") for r in hot) == 1000
    assert [(r["headline_count"], r["headlines_json"]) for r in got if r["symbol"] == "NONE"] == [(0, "[]")]

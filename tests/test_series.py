"""Ordered series in chunks: as-of joins, recurrences and counters against plain Python."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from bourseloom.operators import asof, chunked, counters, headlines, recurrences

T0 = dt.datetime(2024, 1, 1)
LEFT = "id long, k string, at timestamp_ntz"
RIGHT = "k string, rt timestamp_ntz, v long, w string"


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


@pytest.mark.parametrize("direction", ["last", "next"])
@pytest.mark.parametrize("chunk_rows", [3, 100_000])
@pytest.mark.parametrize("within", [None, 40])
def test_asof_against_a_loop(spark, direction, chunk_rows, within):
    rng = random.Random(3)
    left = [(i, rng.choice("aab"), minutes(rng.randrange(900))) for i in range(120)]
    left += [(200, None, minutes(5)), (201, "a", None), (202, "none", minutes(5)), (203, "a", minutes(5)), (203, "a", minutes(5))]
    right = [(rng.choice("aab"), minutes(rng.randrange(900)), rng.randrange(9), None) for _ in range(60)]
    right += [("a", None, 1, "x"), (None, minutes(1), 1, "x"), ("a", minutes(50), None, "y"), ("a", minutes(50), 1, "x")]
    got = asof.asof_join(
        spark.createDataFrame(left, LEFT).withColumn("_time", F.lit(1)).drop("_time"), spark.createDataFrame(right, RIGHT),
        ["k"], "at", "rt", ["v", "w"], direction, within and F.make_dt_interval(mins=F.lit(within)),
        unit="minute", chunk_rows=chunk_rows)
    assert got.columns == ["id", "k", "at", "matched_rt", "v", "w"]

    def want(k, at):
        if k is None or at is None:
            return None, None, None
        low = lambda x: (x is not None, x)
        fit = [r for r in right if r[0] == k and r[1] and (r[1] <= at if direction == "last" else r[1] >= at)]
        if within:
            fit = [r for r in fit if abs(r[1] - at) <= dt.timedelta(minutes=within)]
        if not fit:
            return None, None, None
        day = (max if direction == "last" else min)(r[1] for r in fit)
        return max(((r[1], r[2], r[3]) for r in fit if r[1] == day), key=lambda r: (low(r[1]), low(r[2])))

    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(((*r, *want(r[1], r[2])) for r in left), key=key)


def test_asof_of_nothing_and_bad_direction(spark):
    left, right = spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT)
    assert asof.asof_join(left, right, ["k"], "at", "rt", ["v"]).count() == 0
    one = spark.createDataFrame([(1, "a", T0)], LEFT)
    assert asof.asof_join(one, right, ["k"], "at", "rt", ["v"]).collect()[0]["matched_rt"] is None
    with pytest.raises(ValueError):
        asof.asof_join(left, right, ["k"], "at", "rt", ["v"], "nearest")


def test_weekend_news_counts_for_monday(spark):
    prices = spark.createDataFrame([("S", dt.date(2024, 1, 5)), ("S", dt.date(2024, 1, 8))], "symbol string, date date")
    news = [("h1", "S", dt.datetime(2024, 1, 5, 10), "fri"), ("h2", "S", dt.datetime(2024, 1, 6, 10), "sat"),
            ("h3", "S", dt.datetime(2024, 1, 7, 10), "sun"), ("h4", "S", dt.datetime(2024, 1, 9, 10), "late"),
            ("h5", "X", dt.datetime(2024, 1, 6, 10), "other")]
    rows = spark.createDataFrame(news, "headline_id string, symbol string, scraped_at timestamp_ntz, headline string")
    got = {r["date"].day: (r["headline_count"], r["headlines_json"]) for r in headlines.join_carried(prices, rows).collect()}
    assert got == {5: (1, '["fri"]'), 8: (2, '["sat","sun"]')}
    audit = {r["symbol"]: tuple(r)[1:] for r in headlines.carry_audit(headlines.carried_headlines(rows, prices)).collect()}
    assert audit == {"S": (1, 2, 1), "X": (0, 0, 1)}


def test_places_are_counted_over_units(spark):
    rows = [("a", minutes(i * 7)) for i in range(50)] + [("b", minutes(3))]
    df = chunked.with_places(spark.createDataFrame(rows, "k string, at timestamp_ntz"), ["k"], ["at"], "hour", 8)
    got = sorted((r["k"], r["at"], r["_place"], r["_chunk"]) for r in df.collect())
    assert got == [("a", minutes(i * 7), i, i // 8) for i in range(50)] + [("b", minutes(3), 0, 0)]


@pytest.mark.parametrize("chunk_rows,fan", [(None, 512), (7, 3), (1, 4)])
def test_indicators_against_a_loop(spark, chunk_rows, fan):
    rng, rows = random.Random(9), []
    for symbol, n in (("A", 90), ("B", 15), ("C", 3), ("FLAT", 30)):
        price = 100.0
        for i in range(n):
            price += 0 if symbol == "FLAT" else rng.gauss(0, 2)
            rows.append((symbol, dt.date(2024, 1, 1) + dt.timedelta(days=i), price))
    df = spark.createDataFrame([*rows, ("A", dt.date(2025, 1, 1), None)], "symbol string, date date, close double")
    made = recurrences.recursive_indicators(df, chunk_rows=chunk_rows, fan=fan)
    got = {(r["symbol"], r["date"]): r for r in made.collect()}
    assert len(got) == len(rows)
    state = {}
    for symbol, date, close in rows:
        if symbol not in state:
            state[symbol] = dict(n=0, fast=close, slow=close, signal=0.0, gain=[], loss=[], g=None, l=None, last=close)
        s = state[symbol]
        if s["n"]:
            s["fast"] += 2 / 13 * (close - s["fast"])
            s["slow"] += 2 / 27 * (close - s["slow"])
            s["signal"] += 0.2 * (s["fast"] - s["slow"] - s["signal"])
            s["gain"].append(max(close - s["last"], 0))
            s["loss"].append(max(s["last"] - close, 0))
            if len(s["gain"]) == 14:
                s["g"], s["l"] = sum(s["gain"]) / 14, sum(s["loss"]) / 14
            elif len(s["gain"]) > 14:
                s["g"], s["l"] = (s["g"] * 13 + s["gain"][-1]) / 14, (s["l"] * 13 + s["loss"][-1]) / 14
        s["n"], s["last"] = s["n"] + 1, close
        r = got[symbol, date]
        assert r["ema_12"] == pytest.approx(s["fast"]) and r["ema_26"] == pytest.approx(s["slow"])
        assert r["macd_signal"] == pytest.approx(s["signal"], abs=1e-9)
        assert r["macd_histogram"] == pytest.approx(s["fast"] - s["slow"] - s["signal"], abs=1e-9)
        if s["g"] is None:
            assert r["rsi_14"] is None
        else:
            total = s["g"] + s["l"]
            assert r["rsi_14"] == pytest.approx(100 * s["g"] / total if total else 50.0)


def test_a_long_series_is_cut(spark):
    """100,000 rows of one stock: chunks of bounded length, and the average of the last row is right."""
    n = 100_000
    close = F.lit(50.0) + F.sin(F.col("id") / 50) * 10
    df = spark.range(n).select(F.lit("S").alias("symbol"), F.col("id"), close.alias("close"),
                               F.timestamp_add("MINUTE", F.col("id"), F.lit(T0)).cast("timestamp_ntz").alias("date"))
    assert recurrences.chunk_length(1 - 2 / 13) < 3000
    made = recurrences.recursive_indicators(df, unit="day")
    assert made.count() == n
    last = made.orderBy(F.desc("date")).first()
    value = 50.0
    for i in range(1, n):
        value += 2 / 13 * (50.0 + math.sin(i / 50) * 10 - value)
    assert last["ema_12"] == pytest.approx(value, abs=1e-9)


SAMPLES = "i string, ts timestamp_ntz, total long"


@pytest.mark.parametrize("chunk_rows", [2, 100_000])
def test_increases_see_resets(spark, chunk_rows):
    rows = [("a", 0, 5), ("a", 1, 9), ("a", 2, 9), ("a", 3, 2), ("a", 4, 0), ("a", 5, 7), ("a", 5, 7), ("b", 3, 4), ("b", 9, None),
            ("b", 7, 5)]
    df = spark.createDataFrame([(i, minutes(m), v) for i, m, v in rows] + [("b", None, 8)], SAMPLES).repartition(3)
    got = counters.increases(df, ["i"], "ts", "total", "minute", chunk_rows)
    assert sorted((r["i"], (r["ts"] - T0).seconds // 60, r["increase"]) for r in got.collect()) == [
        ("a", 0, 0), ("a", 1, 4), ("a", 2, 0), ("a", 3, 2), ("a", 4, 0), ("a", 5, 0), ("a", 5, 7), ("b", 3, 0), ("b", 7, 1)]


def test_bucket_quantiles(spark):
    inf = float("inf")
    totals = {1: {0.1: 0, 0.5: 0, inf: 0}, 2: {0.1: 10, 0.5: 30, inf: 40}, 9: {0.1: 10, 0.5: 30, inf: 50}}
    rows = [("a", le, minutes(m), v) for m, t in totals.items() for le, v in t.items()]
    df = spark.createDataFrame(rows, "i string, le double, ts timestamp_ntz, total long")
    made = counters.bucket_quantile_alert(df, ["i"], "le", "ts", "total", "5 minutes", "5 minutes", 0.5, 0.2)
    got = sorted((r["window_start"], r["n"], r["latency"], r["breached"]) for r in made.collect())
    assert got[0][1:] == (40, pytest.approx(0.1 + 0.4 * 10 / 20), True)
    assert got[1][1:] == (10, 0.5, True)
    still = counters.bucket_quantile_alert(df.filter(F.col("ts") < minutes(2)), ["i"], "le", "ts", "total")
    assert {(r["n"], r["latency"], r["breached"]) for r in still.collect()} == {(0, None, False)}

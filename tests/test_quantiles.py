"""Exact quantiles, running counts, drift and alert runs against brute force, hot keys included."""

import bisect
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bourseloom.operators import alerts, drift, quantiles


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(11)
    hot = [("HOT", rng.choice([0.0, 1.0, 1.0, rng.gauss(0, 50)])) for _ in range(700)]
    rest = [(rng.choice("AB"), rng.lognormvariate(0, 3)) for _ in range(300)]
    return hot + rest + [("C", -5.5), ("A", None), ("A", float("nan"))]


PROBS = [0.0, 0.1, 0.5, 0.95, 1.0]


@pytest.mark.parametrize("per_octave", [1, 256])
def test_quantiles_equal_numpy(spark, samples, per_octave):
    df = spark.createDataFrame(samples, "k string, v double")
    got = {(r["k"], r["prob"]): r for r in
           quantiles.exact_quantiles(df, ["k"], "v", PROBS, per_octave).collect()}
    for key in "ABC", "HOT":
        for k in ([key] if key == "HOT" else key):
            values = [v for s, v in samples if s == k and v is not None and v == v]
            for p in PROBS:
                assert got[(k, p)]["quantile"] == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)
                assert got[(k, p)]["n"] == len(values)


def test_quantiles_of_a_whole_column(spark, samples):
    df = spark.createDataFrame(samples, "k string, v double")
    values = [v for _, v in samples if v is not None and v == v]
    for r in quantiles.exact_quantiles(df, [], "v", PROBS).collect():
        assert r["quantile"] == pytest.approx(np.quantile(values, r["prob"]), rel=1e-9, abs=1e-9)


def test_buckets_keep_the_order(spark):
    rng = random.Random(5)
    values = sorted([rng.uniform(-1e9, 1e9) for _ in range(500)] + [rng.uniform(-1, 1) for _ in range(500)]
                    + [0.0, -0.0, 1e-300, -1e-300, 1e300, -1e300])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    made = [r["b"] for r in df.select("v", quantiles.value_bucket(F.col("v")).alias("b")).orderBy("v").collect()]
    assert made == sorted(made)


def test_ks_and_psi_equal_brute_force(spark):
    rng = random.Random(2)
    base = [round(rng.gauss(0, 1), 2) for _ in range(400)]
    curr = [round(rng.gauss(0.3, 1.2), 2) for _ in range(250)]
    b = spark.createDataFrame([(v,) for v in base] + [(None,)], "v double")
    c = spark.createDataFrame([(v,) for v in curr] + [(float("nan"),)], "v double")
    sb, sc = sorted(base), sorted(curr)
    want = max(abs(bisect.bisect_right(sb, v) / len(sb) - bisect.bisect_right(sc, v) / len(sc)) for v in sb + sc)
    got = drift.ks(b, c, "v").first()
    assert got["ks"] == pytest.approx(want) and (got["baseline_count"], got["current_count"]) == (400, 250)
    edges = np.quantile(base, [i / 10 for i in range(1, 10)])
    cb = np.bincount(np.searchsorted(edges, base, side="right"), minlength=10)
    cc = np.bincount(np.searchsorted(edges, curr, side="right"), minlength=10)
    made = drift.psi(b, c, "v").orderBy("bin").collect()
    assert [r["baseline_count"] for r in made] == list(cb)
    assert [r["current_count"] for r in made] == list(cc)
    pb, pc = np.maximum(cb / 400, 1e-6), np.maximum(cc / 250, 1e-6)
    assert sum(r["psi"] for r in made) == pytest.approx(float(((pc - pb) * np.log(pc / pb)).sum()))


def start(minute):
    return dt.datetime(2026, 1, 1) + dt.timedelta(minutes=minute)


def test_runs_must_hold_without_a_gap(spark):
    breached = [0, 1, 2, 3, 4, 5, 7, 8, 20]
    data = [(start(m), m in breached) for m in range(10)] + [(start(20), True)]
    df = spark.createDataFrame(data, "window_end timestamp_ntz, breached boolean")
    got = sorted((r["pending_from"], r["evaluations"], r["held_seconds"], r["fired"])
                 for r in alerts.firing(df, "x", 60).collect())
    assert got == [(start(0), 6, 300, True), (start(7), 2, 60, False), (start(20), 1, 0, False)]


def test_error_rate_is_per_second(spark):
    data = [(start(m), "error" if m % 2 else "ok") for m in range(10)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, kind string")
    got = alerts.error_alert(df, "ts", F.col("kind") == "error").filter(F.col("window_end") == start(10)).first()
    assert (got["n"], got["errors"]) == (5, 3)
    assert got["errors_per_second"] == pytest.approx(3 / 300) and got["error_share"] == pytest.approx(0.6)
    assert got["breached"] is False


def test_histogram_rule_reads_inside_the_bucket(spark):
    data = [(start(0), v) for v in [0.3] * 90 + [0.6] * 10]
    df = spark.createDataFrame(data, "ts timestamp_ntz, v double")
    got = alerts.histogram_alert(df, "ts", "v").first()
    assert got["latency"] == pytest.approx(0.5 + 0.25 * 0.5) and got["breached"] is False
    slow = spark.createDataFrame([(start(0), 99.0)], "ts timestamp_ntz, v double")
    assert alerts.histogram_alert(slow, "ts", "v").first()["latency"] == 10.0

"""Drift from stored day summaries equals drift from the raw rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from bourseloom.operators import drift


def test_windows_from_summaries_equal_raw_rows(spark, tmp_path):
    rng = random.Random(4)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 30)), round(rng.gauss(i / 100, 1), 1))
            for i in range(400)]
    rows += [(dt.datetime(2024, 1, 3), None), (None, 1.0), (dt.datetime(2024, 1, 20), float("nan"))]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, value double")
    df.write.parquet(f"{tmp_path}/raw")
    df = spark.read.parquet(f"{tmp_path}/raw")
    drift.day_summaries(df, "ts", "value").write.parquet(f"{tmp_path}/days")
    days = spark.read.parquet(f"{tmp_path}/days")
    assert days.agg(F.sum("n")).first()[0] == 400
    assert days.count() == days.select("day", "value").distinct().count() < 400
    day = F.to_date("ts")
    for lo, mid, end in (("2024-01-01", "2024-01-10", "2024-01-20"), ("2024-01-05", "2024-01-20", "2025-01-01")):
        raw = [df.filter((day >= F.lit(a).cast("date")) & (day < F.lit(b).cast("date"))) for a, b in ((lo, mid), (mid, end))]
        kept = [drift.between(days, a, b) for a, b in ((lo, mid), (mid, end))]
        for measure in (drift.psi, drift.ks):
            want = sorted(map(tuple, measure(*raw, "value").collect()))
            assert sorted(map(tuple, measure(*kept, "value", weight="n").collect())) == want


def test_no_rows(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz, value double")
    assert drift.day_summaries(df, "ts", "value").count() == 0

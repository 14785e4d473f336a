"""Lookups under skew: every way must equal the plain left join."""

import random
from collections import Counter

import pytest

from bourseloom.operators import lookup as L


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(4)
    keys = ["HOT"] * 400 + [None] * 150 + [f"k{rng.randrange(60)}" for _ in range(450)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int").repartition(4)
    dim = spark.createDataFrame([("HOT", 1.0)] + [(f"k{n}", float(n)) for n in range(0, 60, 2)] + [("z", 0.0)],
                                "k string, v double")
    want = Counter(tuple(r) for r in df.join(dim, "k", "left").select("k", "i", "v").collect())
    return df, dim, want


@pytest.mark.parametrize("share", [0.9, 0.1, 0.01, 1e-9])
def test_split_equals_plain_join(skewed, share):
    df, dim, want = skewed
    got = L.split_lookup(df, dim, "k", share=share)
    assert got.columns == ["k", "i", "v"]
    assert Counter(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_lookup_measures_first(skewed, max_rows):
    df, dim, want = skewed
    made = L.lookup(df, dim, "k", max_rows).select("k", "i", "v")
    assert Counter(tuple(r) for r in made.collect()) == want


@pytest.mark.parametrize("max_bytes", [1 << 20, 100])
def test_lookup_bounds_bytes_too(skewed, max_bytes):
    df, dim, want = skewed
    made = L.lookup(df, dim, "k", max_bytes=max_bytes)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert ("LeftSemi" in plan) == (max_bytes == 100)
    assert Counter(tuple(r) for r in made.select("k", "i", "v").collect()) == want


def test_bytes_of_wide_rows(spark):
    rows = spark.createDataFrame([("a" * 1000, None, [1, 2], 1), (None, b"xy", None, 2)],
                                 "s string, `b.c` binary, l array<int>, n int")
    assert 1000 < L.value_bytes(rows) < 1300
    assert L.value_bytes(rows.limit(0)) == 0

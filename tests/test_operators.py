import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from bourseloom.operators import (
    bars, dedupe, features, fill, headlines as H, incremental as I, preopen as P, quality as Q,
    signals, symbols, upsert,
)
from bourseloom.plans import jobs
from bourseloom.schemas import CONTRACTS, HEADLINE_REQUIRED, OHLCV, RAW_PRICE, PREDICTION_REQUEST


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(n):
    return dt.date(2026, 1, n)


def at(d, h=0, m=0):
    return dt.datetime(2026, 1, d, h, m)


def test_keep_first_breaks_ties_by_the_rest(spark):
    df = spark.createDataFrame([("a", at(2), "y"), ("a", at(1), "z"), ("a", at(1), "b"), ("c", None, "q")],
                               "k string, t timestamp_ntz, v string")
    assert rows(dedupe.keep_first(df, ["k"], ["t"])) == [("a", at(1), "b"), ("c", None, "q")]


def test_dedupe_combines_a_hot_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = dedupe.keep_latest(df, ["k"], ["t"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def random_series(spark, seed=1, n=600):
    rng = random.Random(seed)
    data, t = [], at(1)
    for i in range(n):
        t += dt.timedelta(minutes=rng.choice([1, 7, 600]))
        hot = "HOT" if rng.random() < 0.6 else rng.choice("AB")
        data.append((hot, t, rng.choice([None, None, float(i)]), rng.choice([None, i]), i))
    return data, spark.createDataFrame(data, "s string, t timestamp_ntz, x double, y long, id long")


def test_chunked_fill_equals_plain_fill_and_brute_force(spark):
    data, df = random_series(spark)
    last, want = {}, []
    for s, t, x, y, i in data:
        seen = last.setdefault(s, {"x": None, "y": None})
        seen["x"] = x if x is not None else seen["x"]
        seen["y"] = y if y is not None else seen["y"]
        want.append((s, t, seen["x"], seen["y"], i))
    want = sorted(want, key=repr)
    assert rows(fill.forward_fill(df, "s", "t", ["x", "y"])) == want
    for unit in ("hour", "day", "year"):
        chunk = F.date_trunc(unit, "t")
        assert rows(fill.forward_fill_chunked(df, "s", "t", ["x", "y"], chunk)) == want


def test_price_job_fills_per_column_and_drops_leading_gaps(spark):
    df = spark.createDataFrame([
        ("S", day(1), 1.0, 1.0, 1.0, None, 5, None, at(1)),
        ("S", day(2), 2.0, None, 2.0, 20.0, None, 2.0, at(2)),
        ("S", day(3), None, 3.0, None, None, 7, None, at(3)),
        ("S", day(3), 9.0, 9.0, 9.0, 9.0, 9, 9.0, at(2, 5)),
    ], RAW_PRICE)
    assert rows(jobs.clean_prices(df)) == [
        ("S", day(2), 2.0, 1.0, 2.0, 20.0, 5, 2.0), ("S", day(3), 2.0, 3.0, 2.0, 20.0, 7, 2.0),
    ]


def test_required_fields(spark):
    df = spark.createDataFrame([
        ("abc123", "AAPL", "Apple stock rises"), (None, "AAPL", "x"), ("i", "", "x"), ("i", "s", None),
        ("i", "s", " "),
    ], "headline_id string, symbol string, headline string")
    assert rows(Q.valid_headlines(df)) == [("abc123", "AAPL", "Apple stock rises"), ("i", "s", " ")]
    counted = Q.rejected_counts(df, HEADLINE_REQUIRED, True, "f")
    assert rows(counted) == [("f", "headline", 1), ("f", "headline_id", 1), ("f", "symbol", 1)]
    prices = spark.createDataFrame([("A", "d", 0.0), ("", "d", 1.0), ("A", "d", None), (None, "d", 1.0)],
                                   "symbol string, date string, close double")
    assert rows(Q.valid_prices(prices)) == [("", "d", 1.0), ("A", "d", 0.0)]


def test_contracts(spark):
    df = spark.createDataFrame([
        ("S", day(1), "up", 1.5, "v", at(1)), ("S", day(1), "high", 0.5, "v" * 300, at(1)),
        (None, day(1), None, None, None, None),
    ], CONTRACTS["execution_signals"].schema)
    found = {(r["rule"], r["field"]): r["violations"]
             for r in Q.contract_violations(df, CONTRACTS["execution_signals"]).collect()}
    assert found[("domain", "signal")] == 1 and found[("range", "confidence")] == 1
    assert found[("not_null", "symbol")] == 1 and found[("not_null", "signal")] == 1
    assert found[("max_length", "model_version")] == 1 and found[("schema", "missing")] == 0
    few = df.drop("confidence").withColumn("date", F.lit("x"))
    found = {(r["rule"], r["field"]): r["violations"]
             for r in Q.contract_violations(few, CONTRACTS["execution_signals"]).collect()}
    assert found[("schema", "missing")] == 1 and found[("schema", "wrong_type")] == 1
    empty = Q.contract_violations(df.limit(0), CONTRACTS["execution_signals"])
    assert {r["violations"] for r in empty.collect()} == {0}


def test_optional_fields_of_the_price_record(spark):
    assert "adjusted_close" in CONTRACTS["price_record"].schema.names
    assert "adjusted_close" not in CONTRACTS["price_record"].not_null
    assert {"author", "body_snippet"}.isdisjoint(CONTRACTS["headline_record"].not_null)


def test_defaults(spark):
    df = spark.createDataFrame([("S", None, None)], "symbol string, headline_count long, headlines_json string")
    filled = Q.with_defaults(df, CONTRACTS["feature_vectors"], F.current_timestamp())
    assert tuple(filled.first()) == ("S", 0, "[]")


def test_insert_ignore_and_replay(spark):
    schema = "id string, v string, t long"
    stored = spark.createDataFrame([("a", "old", 0)], schema)
    incoming = spark.createDataFrame([("a", "new", 1), ("b", "second", 3), ("b", "first", 2)], schema)
    once = upsert.insert_ignore(stored, incoming, ["id"], ["t"])
    assert rows(once) == [("a", "old", 0), ("b", "first", 2)]
    assert rows(upsert.insert_ignore(once, incoming, ["id"], ["t"])) == rows(once)


def test_upsert_replaces_whole_rows(spark):
    schema = "symbol string, date date, close double, n long"
    stored = spark.createDataFrame([("S", day(1), 1.0, 0), ("T", day(1), 5.0, 0)], schema)
    incoming = spark.createDataFrame([("S", day(1), None, 2), ("S", day(1), 3.0, 1)], schema)
    merged = upsert.upsert_latest(stored, incoming, ["symbol", "date"], ["n"])
    assert rows(merged) == [("S", day(1), None, 2), ("T", day(1), 5.0, 0)]


HEAD = "headline_id string, symbol string, scraped_at timestamp_ntz, headline string"


def test_daily_headlines_count_ids_and_list_texts(spark):
    df = spark.createDataFrame([
        ("b", "S", at(1, 1), "second"), ("a", "S", at(1, 1), "first"), (None, "S", at(1, 2), "no id"),
        ("c", "S", at(1, 0), None), ("d", "S", None, "no day"),
    ], HEAD)
    got = {r["date"]: r for r in H.daily_headlines(df).collect()}
    assert got[day(1)]["headline_count"] == 3
    assert json.loads(got[day(1)]["headlines_json"]) == ["first", "second", "no id"]
    assert got[None]["headline_count"] == 1


def test_parts_hold_the_same_headlines_in_order(spark):
    rng = random.Random(3)
    data = [(f"{rng.getrandbits(64):016x}", "HOT" if i % 3 else f"S{i % 5}", at(1, rng.choice([0, 0, 0, 9])), f"h{i}")
            for i in range(400)]
    df = spark.createDataFrame(data, HEAD)
    whole = {(r["symbol"], r["date"]): json.loads(r["headlines_json"]) for r in H.daily_headlines(df).collect()}
    for size in (7, 100, 10_000):
        parts = {}
        for r in sorted(H.headline_parts(df, size).collect(), key=lambda r: r["part"]):
            texts = json.loads(r["headlines_json"])
            assert len(texts) == r["headline_count"] <= size + 2
            parts.setdefault((r["symbol"], r["date"]), []).extend(texts)
        assert parts == whole


def test_headline_job_options(spark):
    schema = "headline_id string, symbol string, published_at string, source string, headline string, article_url string, scraped_at timestamp_ntz"
    df = spark.createDataFrame([
        ("x", "A", "p", "SRC", "<b>One</b>", "u", at(1)), ("x", "B", "p", "SRC", "Two", "u", at(2)),
    ], schema)
    assert rows(jobs.clean_headlines(df)) == [("x", "A", "p", "src", "one", "u", at(1))]
    assert jobs.clean_headlines(df, ("headline_id", "symbol")).count() == 2
    both = df.withColumn("symbol", F.lit("A, B"))
    assert H.explode_symbols(both).count() == 4
    by_publication = df.withColumn("published_at", F.lit("2026-01-05T23:00:00Z"))
    assert {r["date"] for r in H.daily_headlines(by_publication, "published_at").collect()} == {day(6)}


def test_no_headlines_at_all(spark):
    prices = spark.createDataFrame([("S", day(1), 1.0, 1.0, 1.0, 1.0, 1, None)],
                                   CONTRACTS["clean_prices"].schema)
    none = spark.createDataFrame([], HEAD)
    assert rows(jobs.feature_vectors(prices, none))[0][-2:] == (0, "[]")


def test_incremental_headlines_cutoffs(spark):
    schema = "symbol string, published_at string"
    history = spark.createDataFrame([
        ("A", "2026-01-05T10:00:00+05:30"), ("A", "2 days ago"), ("A", "2026-01-04 00:00:00"), ("B", "soon"),
    ], schema)
    fetched = spark.createDataFrame([
        ("A", "2026-01-05T10:00:00+05:30"), ("A", "2026-01-05T04:30:01Z"), ("A", "never"), ("B", "2020-01-01"),
        ("C", "2020-01-01"),
    ], schema)
    assert rows(I.latest_per_symbol(history)) == [("A", at(5, 10))]
    assert rows(jobs.incremental_headlines(history, fetched)) == [
        ("A", "2026-01-05T04:30:01Z"), ("A", "never"), ("B", "2020-01-01"), ("C", "2020-01-01"),
    ]


def test_incremental_bars_and_counts(spark):
    schema = "symbol string, date date, open double, high double, low double, close double, volume long"
    stored = spark.createDataFrame([("A", day(3), 1.0, 1.0, 1.0, 1.0, 1)], schema)
    fetched = spark.createDataFrame(
        [("A", day(d), 1.0, 1.0, 1.0, c, 1, n) for d, c, n in [(3, 9.0, 0), (4, 1.0, 0), (4, 2.0, 1)]]
        + [("B", day(1), 1.0, 1.0, 1.0, 3.0, 1, 0)], schema + ", arrival int")
    new = jobs.incremental_bars(stored, fetched, "daily")
    assert [(r[0], r[1], r[5]) for r in rows(new)] == [("A", day(4), 2.0), ("B", day(1), 3.0)]
    dim = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    assert dict(rows(I.new_rows_per_symbol(new, dim))) == {"A": 1, "B": 1, "C": 0, "TOTAL": 2}
    assert rows(bars.merge_summary(jobs.merged_bars(stored, new))) == [(3, 2)]


@pytest.mark.parametrize("interval, latest, want", [
    ("15min", at(31, 23, 45), 20 + 37), ("15min", dt.datetime(2026, 2, 1, 9), 20), ("15min", None, 10_000),
    ("daily", at(31), 10), ("daily", at(1), 31 + 5), ("15min", dt.datetime(2026, 2, 9), 10),
])
def test_backfill(spark, interval, latest, want):
    known = spark.createDataFrame([("A", latest)], "symbol string, latest timestamp_ntz")
    dim = spark.createDataFrame([("A",)], "symbol string")
    as_of = F.lit("2026-02-01 09:00:00").cast("timestamp_ntz")
    assert I.backfill_plan(known, dim, as_of, interval).first()["bars"] == want


def test_vendor_bars_move_to_market_time(spark):
    df = spark.createDataFrame([("S", at(1, 20, 30), 1.005, 2.0, 0.123, 1.0, 9)],
                               "symbol string, datetime timestamp_ntz, open double, high double, low double, close double, volume long")
    assert bars.localize_bars(df, "15min").first()["datetime"] == at(2, 2)
    daily = bars.localize_bars(df, "daily").first()
    assert daily["date"] == day(2) and daily["low"] == 0.12


def test_symbols(spark):
    dim = spark.createDataFrame([("A", "Alpha", "", "n", "NSE:A"), ("A", "Alpha", "", "n", "NSE:A"), ("B", "Beta", "", " ", None)],
                                " Symbol string, `Stock_name ` string, Sector string, Groww_name string, TradingView_name string")
    clean = symbols.usable_stocks(dim, "Groww_name")
    assert clean.columns[1] == "Stock_name" and clean.count() == 2
    data = spark.createDataFrame([("A", 1), ("Z", 2)], "symbol string, n int")
    assert rows(symbols.resolve_symbol(data, clean)) == [("Alpha", "A", 1), (None, "Z", 2)]


def payload(spark, text):
    from bourseloom.sources.files import parse_preopen
    return parse_preopen(spark.createDataFrame([(text,)], "p string"), "p")


def test_preopen(spark):
    doc = {"data": [
        {"metadata": {"symbol": "A", "previousClose": 10, "pChange": -3.0, "change": -0.3, "lastPrice": 9.7,
                      "finalQuantity": 5, "totalTurnover": 123456789, "marketCap": None}},
        {"metadata": {"pChange": None}}, {"metadata": {"symbol": "C", "pChange": 1.0, "change": 0.1}}],
        "advances": 1, "declines": 1, "timestamp": "08-Jun-2026 09:07:55"}
    flat = jobs.preopen_snapshot(payload(spark, json.dumps(doc)))
    ordered = P.by_move(flat).collect()
    assert [r["symbol"] for r in ordered] == ["A", "C", ""]
    assert ordered[0]["value_crores"] == 12.35 and ordered[0]["ffm_cap_crores"] == 0.0
    assert {r["trade_date"] for r in ordered} == {"20260608"}
    breadth = P.breadth(flat).first()
    assert (breadth["counted_advances"], breadth["counted_declines"], breadth["items"]) == (1, 1, 3)
    assert P.flatten_preopen(payload(spark, '{"data":[],"timestamp":"x"}')).count() == 0


def test_labels(spark):
    df = spark.createDataFrame([("S", day(1), 1.0, 100.0), ("S", day(2), 100.05, 100.0), ("S", day(3), 101.0, 100.0),
                                ("S", day(4), 99.0, 1.0)], "symbol string, date date, open double, close double")
    got = [r["direction"] for r in features.direction_labels(df).orderBy("date").collect()]
    assert got == ["flat", "high", "low", None]


def test_metrics_with_an_unpredicted_class(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    got = {r["class"]: r for r in features.classification_metrics(df, "y", "p").collect()}
    assert got["c"]["precision"] == 0.0 and got["c"]["recall"] == 0.0 and got["c"]["f1"] == 0.0
    assert got["a"]["precision"] == 1.0 and got["a"]["recall"] == 0.5
    assert got["b"]["precision"] == pytest.approx(1 / 3)
    assert got["macro"]["accuracy"] == 0.5 and got["macro"]["support"] == 4


def test_requests_without_scores_fall_back(spark):
    requests = spark.createDataFrame([("S", "2026-01-01", ["h"], 1.0), ("T", "2026-01-01", None, None)],
                                     PREDICTION_REQUEST)
    scores = spark.createDataFrame([("S", day(1), "flat", 0.8)], "symbol string, date date, direction string, confidence double")
    got = rows(signals.predict_requests(requests, scores, "m1", F.lit("now")))
    assert got[0] == ("S", "2026-01-01", "flat", 0.8, "m1", "now")
    assert got[1][4] == "baseline" and 0.3 <= got[1][3] <= 0.9


def test_ohlcv_order():
    assert OHLCV == ["open", "high", "low", "close", "volume", "adjusted_close"]

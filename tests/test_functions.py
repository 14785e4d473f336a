import datetime as dt

import pytest
from pyspark.sql import functions as F

from bourseloom.functions import codec, text as X, times as C
from bourseloom.schemas import HEADLINE_MESSAGE, PRICE_MESSAGE


def one(spark, value, expr, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw, want", [
    ("HELLO World", "hello world"),
    ("<b>bold</b> text", "bold text"),
    ("foo&amp;bar", "foo bar"),
    ("  too   many   spaces  ", "too many spaces"),
    (None, None),
    ("  <b>Hello</b> &amp; World  ", "hello world"),
    ("3 < 5 and 6 > 2", "3 2"),
    ("a<br>b", "ab"),
    ("&AMP;x&#39;&frac12;", "x&#39;&frac12;"),
    ("a  \x0b\x1cb", "a b"),
    ("<p></p>", ""),
])
def test_clean_text(spark, raw, want):
    assert one(spark, raw, X.clean_text) == want


@pytest.mark.parametrize("raw, want", [
    ("NSE:HDFCBANK", ("HDFCBANK", "NSE")),
    ("BSE:X ", ("X", "BSE")),
    ("HDFCBANK", ("HDFCBANK", "NSE")),
    (" A:B:C ", (" A:B:C ", "NSE")),
])
def test_exchange_ticker(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "x string")
    ticker, exchange = X.exchange_ticker(F.col("x"))
    assert tuple(df.select(ticker, exchange).first()) == want


def test_ids_come_from_link_or_text_and_time(spark):
    import hashlib
    df = spark.createDataFrame(
        [("https://a/1", "t", "z"), (None, "täxt", "2026"), ("", "t", "9")], "u string, h string, p string"
    )
    got = [r[0] for r in df.select(X.headline_id(F.col("u"), F.col("h"), F.col("p"))).collect()]
    want = [hashlib.sha256(s.encode()).hexdigest()[:16] for s in ("https://a/1", "täxt2026", "t9")]
    assert got == want


def test_field_choice(spark):
    links = F.array(*[F.lit(x) for x in ("/local", "https://groww.in/x", "https://n.example/1", "http://b")])
    assert one(spark, "", lambda _: X.first_external_link(links)) == "https://n.example/1"
    assert one(spark, "", lambda _: X.first_external_link(F.array(F.lit("/a")))) is None
    texts = F.array(F.lit("short"), F.lit("b" * 25), F.lit("c" * 25))
    assert one(spark, "", lambda _: X.longest_text(texts)) == "b" * 25
    assert one(spark, "", lambda _: X.longest_text(F.array(F.lit("short")))) == ""
    assert one(spark, " Mint • ·", X.strip_source) == "Mint"
    assert one(spark, "A/B C", X.safe_name) == "A_B_C"
    assert one(spark, " abc ", X.news_page_url) == "https://groww.in/stocks/abc/market-news"


@pytest.mark.parametrize("attribute, title, want", [
    ("2026-06-07T07:25:51.000Z", None, dt.datetime(2026, 6, 7, 12, 55, 51)),
    (None, "2026-06-07T12:55:51", dt.datetime(2026, 6, 7, 12, 55, 51)),
    (None, "2026-06-07T12:55:51+09:00", dt.datetime(2026, 6, 7, 12, 55, 51)),
    ("junk", "28 May 2026, 05:42 PM IST", dt.datetime(2026, 5, 28, 17, 42)),
    ("", "8 September 2026, 5:42 AM IST", dt.datetime(2026, 9, 8, 5, 42)),
    ("", "28 May 2026", dt.datetime(2026, 5, 28)),
    ("", "2 days ago", None),
    (None, None, None),
])
def test_news_times(spark, attribute, title, want):
    df = spark.createDataFrame([(attribute, title)], "a string, t string")
    assert df.select(C.parse_news_time(F.col("a"), F.col("t"))).first()[0] == want


def test_results_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2026-06-07T20:30:00Z",)], "a string")
    at = C.parse_instant(F.col("a"))
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = df.select(at.alias("t"), C.iso_market(at).alias("iso"), F.to_date(at).alias("d")).first()
            assert row["t"] == dt.datetime(2026, 6, 8, 2, 0)
            assert row["iso"] == "2026-06-08T02:00:00+05:30"
            assert row["d"] == dt.date(2026, 6, 8)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_text_shows_fractions_and_western_offsets(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 2, 3, 4, 5, 60),)], "t timestamp_ntz")
    assert df.select(C.iso_market(F.col("t"))).first()[0] == "2026-01-02T03:04:05.000060+05:30"
    assert df.select(C.iso_market(F.col("t"), "America/New_York")).first()[0].endswith("-05:00")


def test_market_date_moves_instants_only(spark):
    df = spark.sql("SELECT timestamp'2026-05-28 20:30:00' AS i, timestamp_ntz'2026-05-28 20:30:00' AS w,"
                   " '2026-05-28T20:30:00+00:00' AS s")
    row = df.select(*[C.market_date(df, c).alias(c) for c in df.columns]).first()
    assert (row["i"], row["w"], row["s"]) == (dt.date(2026, 5, 29), dt.date(2026, 5, 28), dt.date(2026, 5, 29))


def test_payload_date_falls_back(spark):
    day = lambda c: C.payload_date(c, F.lit("2026-01-01").cast("date"))
    assert one(spark, "08-Jun-2026 09:07:55", day) == dt.date(2026, 6, 8)
    assert one(spark, "soon", day) == dt.date(2026, 1, 1)


def test_messages_survive_a_round_trip(spark):
    rows = [("S", "2026-01-01", 1.5, None, 2.0, 3.0, 7, None, "now")]
    df = spark.createDataFrame(rows, PRICE_MESSAGE)
    encoded = codec.encode(df, key="symbol")
    assert '"high":null' in encoded.first()["value"]
    assert [tuple(r) for r in codec.decode(encoded.drop("key"), PRICE_MESSAGE).collect()] == rows


def test_bad_messages_become_nulls(spark):
    values = ["{broken", "", '{"headline_id":"a","other":1}', '{"headline_id":NaN,"symbol":"NaN"}', "[]"]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    got = codec.decode(df, HEADLINE_MESSAGE).select("headline_id", "symbol").collect()
    assert [tuple(r) for r in got if r["headline_id"]] == [("a", None)]
    assert len(got) >= 4


def test_json_array(spark):
    assert one(spark, ["a", 'q"é'], codec.json_array, "array<string>") == '["a","q\\"é"]'
    assert one(spark, [], codec.json_array, "array<string>") == "[]"
    assert one(spark, None, codec.json_array, "array<string>") == "[]"

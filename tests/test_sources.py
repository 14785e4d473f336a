import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from bourseloom.operators import preopen
from bourseloom.schemas import DAILY_BAR, PREOPEN_MOVES
from bourseloom.session import work_dir
from bourseloom.sources import files, tables, topics


def put(folder, name, text, encoding="utf-8"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def test_headline_csv_nulls_quotes_and_lines(spark, tmp_path):
    path = put(tmp_path, "h.csv", 'headline_id,symbol,published_at,source,headline,article_url,scraped_at\n'
               'a,S,NA,"x, ""y""","two\nlines",,now\nb,null,None,NaN,t,N/A,n/a\n', "utf-8-sig")
    got = files.read_headlines_csv(spark, path).orderBy("headline_id").collect()
    assert tuple(got[0]) == ("a", "S", None, 'x, "y"', "two\nlines", None, "now")
    assert tuple(got[1]) == ("b", None, None, None, "t", None, None)


def test_price_csv_types(spark, tmp_path):
    path = put(tmp_path, "p.csv", "symbol,date,open,high,low,close,volume,adjusted_close\n"
               "^GSPC,2025-01-02,5880.0,5920.5,5870.25,5910.3,3200000000,5910.3\nA,2025-01-02,x,1,1,1,12.9,\n")
    big, bad = files.read_prices_csv(spark, path).orderBy("symbol", ascending=False).collect()
    assert big["volume"] == 3200000000 and big["adjusted_close"] == 5910.3
    assert bad["open"] is None and bad["volume"] == 12 and bad["adjusted_close"] is None
    assert big["fetched_at"].endswith("+05:30")


def test_stock_list_with_windows_lines(spark, tmp_path):
    path = put(tmp_path, "s.csv", 'Symbol,Stock_name,Sector,Groww_name,TradingView_name\r\n'
               'A,Alpha & Co,"Metals, Mining",alpha-ltd,NSE:A\r\nB,Beta,x,,\r\n')
    got = {r["Symbol"]: r for r in files.read_stock_list(spark, path).collect()}
    assert got["A"]["Sector"] == "Metals, Mining" and got["A"]["TradingView_name"] == "NSE:A"
    assert got["B"]["Groww_name"] is None


def test_absent_history_is_empty(spark, tmp_path):
    df = files.read_history(spark, str(tmp_path / "nowhere"), DAILY_BAR)
    assert df.count() == 0 and df.schema == DAILY_BAR


def test_bar_files_by_suffix(spark, tmp_path):
    head = "symbol,date,open,high,low,close,volume\n"
    put(tmp_path, "A_daily_data.csv", head + "A,2026-01-01,1,1,1,1,5\nbroken\n,,,,,,\n", "utf-8-sig")
    put(tmp_path, "B_daily_data.csv", head + "B,2026-01-02,1,1,1,1,nope\n")
    put(tmp_path, "C_daily_data.csv", "")
    put(tmp_path, "A_15min_data.csv", head + "A,2026-01-01,9,9,9,9,9\n")
    put(tmp_path, "merged_ohlc.csv", head + "A,2026-01-01,9,9,9,9,9\n")
    df = files.read_bar_files(spark, str(tmp_path), "daily")
    assert df.count() == 2
    got = sorted((r["symbol"], r["date"], r["volume"]) for r in df.collect())
    assert got == [("A", dt.date(2026, 1, 1), 5), ("B", dt.date(2026, 1, 2), None)]


def test_files_that_give_no_line_are_named(spark, tmp_path):
    head = "symbol,date,open,high,low,close,volume\n"
    put(tmp_path, "A_daily_data.csv", head + "A,2026-01-01,1,1,1,1,5\n")
    put(tmp_path, "B_daily_data.csv", head + "broken\n")
    put(tmp_path, "C_daily_data.csv", head)
    put(tmp_path, "D_daily_data.csv.gz", "no archive at all")
    put(tmp_path, "other.txt", "x")
    got = files.silent_files(spark, str(tmp_path), DAILY_BAR, pathGlobFilter="*_daily_data.csv*")
    assert sorted(map(tuple, got.collect())) == [
        ("C_daily_data.csv", len(head)), ("D_daily_data.csv.gz", 17)]
    assert files.silent_files(spark, str(tmp_path / "nowhere"), DAILY_BAR).count() == 0


def test_bars_append(spark, tmp_path):
    df = spark.createDataFrame([("A/B C", dt.date(2026, 1, 1), 1.0, 1.0, 1.0, 1.0, 5)], DAILY_BAR)
    path = str(tmp_path / "bars")
    assert files.write_bars(df, path, "daily") == 1
    files.write_bars(df.withColumn("date", F.date_add("date", 1)), path, "daily")
    assert os.path.isdir(f"{path}/stock=A_B_C/year=2026")
    assert files.read_bars(spark, path, "daily").count() == 2


def test_many_stocks_share_files(spark, tmp_path):
    rows = [(f"S{i}", dt.date(2025 + d, 1, 1), 1.0, 1.0, 1.0, 1.0, i) for i in range(300) for d in (0, 1)]
    df, path = spark.createDataFrame(rows, DAILY_BAR), str(tmp_path / "bars")
    assert files.write_bars(df, path, "daily", stock_folders=False) == 600
    names = [n for _, _, found in os.walk(path) for n in found if n.endswith(".csv")]
    assert len(names) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, files.read_bars(spark, path, "daily").collect())) == sorted(rows)


def test_day_partitions_replace_only_their_day(spark, tmp_path):
    path = str(tmp_path / "days")
    first = spark.createDataFrame([("20260101", "A", 1.0), ("20260102", "A", 2.0)], "d string, s string, v double")
    assert tables.write_by_day(first, path, "d", [F.col("v").desc()]) == 2
    again = spark.createDataFrame([("20260102", "B", 9.0)], "d string, s string, v double")
    tables.write_by_day(again, path, "d", [F.col("v").desc()])
    got = sorted((str(r["d"]), r["s"]) for r in spark.read.parquet(path).collect())
    assert got == [("20260101", "A"), ("20260102", "B")]


def test_day_partitions_compute_their_rows_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    df = spark.range(1000).select(F.lit("20260101").alias("d"), F.col("id").cast("double").alias("v"))
    rows = df.mapInPandas(seen, df.schema)
    assert tables.write_by_day(rows, str(tmp_path / "days"), "d", [F.col("v").desc()]) == 1000
    assert made.value == 1000


def test_moves_alone_give_the_same_breadth(spark):
    text = ('{"data":[{"metadata":{"symbol":"A","change":1.5}},{"metadata":{"symbol":"B","change":-1}},'
            '{"metadata":{"symbol":"C"}}],"advances":1,"declines":1,"timestamp":"t"}')
    df = spark.createDataFrame([(text,), ('{"data":[],"timestamp":"u"}',), ("{broken",)], "payload string")
    whole = preopen.breadth(preopen.flatten_preopen(files.parse_preopen(df, "payload", True)))
    moves = preopen.breadth(preopen.item_moves(files.parse_preopen(df, "payload", True, PREOPEN_MOVES)))
    assert moves.schema == whole.schema
    assert sorted(map(tuple, moves.collect())) == sorted(map(tuple, whole.collect()))


def test_preopen_documents(spark, tmp_path):
    put(tmp_path, "x.json", '{"data":[\n{"metadata":{"symbol":"A","pChange":1}}],\n"timestamp":"t"}')
    got = files.read_preopen_json(spark, str(tmp_path)).first()
    assert got["data"][0]["metadata"]["symbol"] == "A" and got["advances"] is None


def test_write_counts_without_a_second_pass(spark, tmp_path):
    assert tables.write_table(spark.range(7).toDF("id"), str(tmp_path / "t")) == 7
    assert tables.read_table(spark, str(tmp_path / "t")).count() == 7


def test_dry_run_writes_every_record(spark, tmp_path):
    assert tables.write_json(spark.range(20).toDF("id"), str(tmp_path / "dry")) == 20
    assert sorted(r["id"] for r in spark.read.json(str(tmp_path / "dry")).collect()) == list(range(20))


def test_scratch_follows_the_session_setting(spark, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = work_dir(spark, "x"), work_dir(spark, "x")
    assert one != two and (base is None or one.startswith(base))


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(0, 100, 1, 64)
    assert tables.spread(wide) is wide
    assert tables.spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() > 1


def test_topic_forms_need_the_connector(spark):
    """No broker package here: the call must get as far as looking the source up."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        topics.topic_stream(spark, "host:9092", "news_features", 100)
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        topics.write_topic(spark.range(1), "host:9092", "t", key="id")

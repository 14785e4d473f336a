"""The stored form of the jobs, end to end, and the command line."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from bourseloom.__main__ import main
from bourseloom.plans import pipeline
from bourseloom.schemas import CONTRACTS, FEATURE_VECTOR
from bourseloom.sources import stand_ins as V, tables
from bourseloom.sources.tables import read_table


@pytest.fixture(scope="module")
def staged(spark, sf_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("staged"))
    V.repeated_headlines(spark, sf_dir).withColumn("inserted_at", F.col("scraped_at")).write.parquet(f"{base}/h")
    V.raw_prices(spark, sf_dir).drop("event_id").write.parquet(f"{base}/p")
    return base


def rows(df):
    return sorted(map(tuple, df.select(*FEATURE_VECTOR.names).collect()), key=repr)


def test_daily_run_stores_the_feature_table(spark, sf_dir, staged, tmp_path):
    out = str(tmp_path)
    counts = pipeline.run_daily(spark, f"{staged}/h", f"{staged}/p", out)
    assert counts == {"clean_headlines": 200, "clean_prices": 389, "feature_vectors": 389}
    stored = read_table(spark, f"{out}/feature_vectors", FEATURE_VECTOR)
    want = rows(driver.entry(spark))
    assert rows(stored) == want
    assert pipeline.run_daily(spark, f"{staged}/h", f"{staged}/p", out) == counts
    assert rows(read_table(spark, f"{out}/feature_vectors", FEATURE_VECTOR)) == want


def test_date_filter_reads_one_partition(spark, staged, tmp_path):
    pipeline.run_clean_prices(spark, f"{staged}/p", str(tmp_path / "p"))
    one_day = read_table(spark, str(tmp_path / "p"), CONTRACTS["clean_prices"].schema).filter(
        F.col("date") == F.lit("2024-01-10").cast("date"))
    assert "PartitionFilters: [isnotnull(date" in one_day._jdf.queryExecution().toString()


def test_broken_contract_stops_the_run(spark):
    df = spark.createDataFrame([(None,) * 10, (None,) * 10], FEATURE_VECTOR)
    with pytest.raises(pipeline.ContractError, match="feature_vectors.symbol not_null: 2"):
        pipeline.checked(df, "feature_vectors")


def test_broken_rows_are_not_published(spark, tmp_path):
    good = spark.createDataFrame([("a", "S", "2026-01-01", "s", "t", "u", None)], "headline_id string, symbol string, "
                                 "published_at string, source string, headline string, article_url string, scraped_at timestamp_ntz")
    out = str(tmp_path / "clean")
    publish = lambda rows: tables.write_table(rows, out)
    assert pipeline.published(good, "clean_headlines", publish) == 1
    with pytest.raises(pipeline.ContractError):
        pipeline.published(good.withColumn("symbol", F.lit(None).cast("string")), "clean_headlines", publish)
    assert [r["symbol"] for r in spark.read.parquet(out).collect()] == ["S"]


def test_empty_input_leaves_stored_tables(spark, staged, tmp_path):
    out = str(tmp_path)
    counts = pipeline.run_daily(spark, f"{staged}/h", f"{staged}/p", out)
    for name in ("h", "p"):
        read_table(spark, f"{staged}/{name}").limit(0).write.parquet(f"{out}/none/{name}")
    pipeline.run_clean_headlines(spark, f"{out}/none/h", f"{out}/clean_headlines")
    pipeline.run_clean_prices(spark, f"{out}/none/p", f"{out}/clean_prices")
    assert {n: read_table(spark, f"{out}/{n}").count() for n in counts} == counts


def test_command_line(spark, staged, tmp_path, capsys):
    main(["clean-headlines", "--raw", f"{staged}/h", "--out", str(tmp_path / "h")])
    assert capsys.readouterr().out.strip() == "200"
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "x.json").write_text(json.dumps({
        "data": [{"metadata": {"symbol": "A", "pChange": 1.0}}], "timestamp": "08-Jun-2026 09:07:55"}))
    main(["preopen", "--documents", str(tmp_path / "docs"), "--out", str(tmp_path / "o")])
    assert (tmp_path / "o" / "trade_date=20260608").is_dir()
    (tmp_path / "bars").mkdir()
    (tmp_path / "bars" / "A_daily_data.csv").write_text("symbol,date,open,high,low,close,volume\nA,2026-01-01,1,1,1,1,5\n")
    main(["merge-bars", "--folder", str(tmp_path / "bars"), "--out", str(tmp_path / "m")])
    (tmp_path / "h.csv").write_text("headline_id,symbol,published_at,source,headline,article_url,scraped_at\na,S,p,s,t,u,n\n")
    capsys.readouterr()
    main(["publish", "headlines", "--csv", str(tmp_path / "h.csv"), "--dry-run", str(tmp_path / "dry")])
    assert capsys.readouterr().out.strip() == "1"
    assert [r["headline_id"] for r in spark.read.json(str(tmp_path / "dry")).collect()] == ["a"]

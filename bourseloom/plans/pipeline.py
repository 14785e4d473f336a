"""The batch jobs with their reads and writes.

Each step reads stored tables, writes its own and returns the rows written; a table is
written in one pass and read back by the next step, so a lost executor costs no more than
the step it was lost in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourseloom.operators.preopen import with_trade_date, flatten_preopen
from bourseloom.operators.quality import contract_violations
from bourseloom.plans import jobs
from bourseloom.schemas import CLEAN_HEADLINE, CLEAN_PRICE, CONTRACTS, RAW_HEADLINE, RAW_PRICE
from bourseloom.session import MARKET_ZONE, work_dir
from bourseloom.sources.files import read_bar_files, read_preopen_json
from bourseloom.sources.tables import read_table, write_by_day, write_table


class ContractError(ValueError):
    """A stored table breaks its contract."""


def checked(df: DataFrame, contract: str) -> None:
    """Raise if a written table breaks a rule of its contract; the report is a few rows."""
    broken = contract_violations(df, CONTRACTS[contract]).filter("violations > 0").collect()
    if broken:
        raise ContractError("; ".join(
            f"{r['contract']}.{r['field']} {r['rule']}: {r['violations']}" for r in broken
        ))


def published(
    rows: DataFrame, contract: str, publish: Callable[[DataFrame], int]
) -> int:
    """Write ``rows`` beside the table, check them against their contract, then publish them."""
    spark = rows.sparkSession
    beside = work_dir(spark, contract)
    write_table(rows, beside)
    written = read_table(spark, beside, rows.schema)
    checked(written, contract)
    return publish(written)


def run_clean_headlines(spark: SparkSession, raw: str, out: str) -> int:
    """Rows written; an empty input leaves the stored table as it is and writes none."""
    staged = read_table(spark, raw, RAW_HEADLINE)
    if staged.isEmpty():
        return 0
    return published(jobs.clean_headlines(staged), "clean_headlines", lambda rows: write_table(rows, out))


def run_clean_prices(spark: SparkSession, raw: str, out: str) -> int:
    staged = read_table(spark, raw, RAW_PRICE)
    if staged.isEmpty():
        return 0
    return published(jobs.clean_prices(staged), "clean_prices", lambda rows: write_by_day(
        rows, out, "date", [F.col("symbol")], full=True))


def run_feature_vectors(
    spark: SparkSession, prices: str, headlines: str, out: str, date_from: str = "scraped_at",
    zone: str = MARKET_ZONE,
) -> int:
    stored = read_table(spark, prices, CLEAN_PRICE)
    if stored.isEmpty():
        return 0
    joined = jobs.feature_vectors(stored, read_table(spark, headlines, CLEAN_HEADLINE), date_from, zone)
    return published(joined, "feature_vectors", lambda rows: write_by_day(
        rows, out, "date", [F.col("symbol")], full=True))


def run_daily(spark: SparkSession, raw_headlines: str, raw_prices: str, out: str) -> dict[str, int]:
    """Both cleaning jobs, then the join; (table, rows written)."""
    tables = {n: f"{out.rstrip('/')}/{n}" for n in ("clean_headlines", "clean_prices",
                                                    "feature_vectors")}
    return {
        "clean_headlines": run_clean_headlines(spark, raw_headlines, tables["clean_headlines"]),
        "clean_prices": run_clean_prices(spark, raw_prices, tables["clean_prices"]),
        "feature_vectors": run_feature_vectors(
            spark, tables["clean_prices"], tables["clean_headlines"], tables["feature_vectors"]
        ),
    }


def run_merge_bars(spark: SparkSession, folder: str, interval: str, out: str) -> int:
    """All per-stock files of an interval as one table in (symbol, time) order."""
    bars = read_bar_files(spark, folder, interval)
    return write_table(jobs.merged_bars(bars, interval=interval), out)


def run_preopen(spark: SparkSession, documents: str, out: str) -> int:
    """Snapshot documents into one partition per trading day, largest moves first."""
    rows = with_trade_date(flatten_preopen(read_preopen_json(spark, documents)))
    order = [F.abs("pct_change").desc_nulls_last(), F.col("symbol")]
    return write_by_day(rows, out, "trade_date", order)

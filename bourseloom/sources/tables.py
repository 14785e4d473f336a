"""Table readers and writers: parquet, CSV, JDBC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourseloom.session import work_dir


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """A stored table with an explicit schema; parquet carries its own."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of a scan that has fewer splits than the session has cores.

    For CPU-heavy work right after the scan of a few files that cannot be split. A scan with
    splits enough, the normal case on a cluster, passes through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_jdbc(
    spark: SparkSession, url: str, table: str, user: str, password: str,
    split_column: str | None = None, lower: str | None = None, upper: str | None = None,
    partitions: int = 1, driver: str = "org.postgresql.Driver", fetch_size: int = 10_000,
) -> DataFrame:
    """A database table; with ``split_column`` it is read in ``partitions`` parallel ranges."""
    options = {"url": url, "dbtable": table, "user": user, "password": password,
               "driver": driver, "fetchsize": str(fetch_size)}
    if split_column is not None:
        options |= {"partitionColumn": split_column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(partitions)}
    return spark.read.format("jdbc").options(**options).load()


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet",
    mode: str = "overwrite", **options: str,
) -> int:
    """Write and return the row count, observed during the write: no second pass."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.options(**options).save(path)
    return seen.get["rows"]


def write_jdbc(
    df: DataFrame, url: str, table: str, user: str, password: str, mode: str = "overwrite",
    driver: str = "org.postgresql.Driver", batch_size: int = 10_000,
) -> None:
    """Full refresh of a database table; ``truncate`` keeps its keys and defaults."""
    df.write.format("jdbc").options(
        url=url, dbtable=table, user=user, password=password, driver=driver,
        truncate="true", batchsize=str(batch_size),
    ).mode(mode).save()


def write_by_day(
    df: DataFrame, path: str, day: str, order: list[Column], full: bool = False
) -> int:
    """One partition per day; only the days present in ``df`` are replaced, or all with ``full``.

    Rows are range-partitioned on the day and the order inside it, so a heavy day is written
    by several tasks and files follow the order. They are stored first: the range borders come from
    a pass of their own, which would compute ``df`` once more.
    """
    rows = work_dir(df.sparkSession, "by-day")
    write_table(df, rows)
    ranged = read_table(df.sparkSession, rows, df.schema).repartitionByRange(F.col(day), *order).sortWithinPartitions(F.col(day), *order)
    return write_table(ranged, path, partition_by=[day],
                       partitionOverwriteMode="static" if full else "dynamic")


def write_json(df: DataFrame, path: str) -> int:
    """Dry run: every record as a line of JSON text in a folder."""
    return write_table(df, path, fmt="json", ignoreNullFields="false")

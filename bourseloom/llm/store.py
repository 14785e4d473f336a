"""Intermediates written to the shared folder: lineage ends there, executors may be lost."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from bourseloom.session import work_dir

TEXT_BATCH = "2m"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries made inside remove their shuffle files when they end; nothing reads these again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside give Python workers batches of at most ``TEXT_BATCH``, not 10,000 whole texts at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, TEXT_BATCH)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_texts(df: DataFrame, name: str) -> DataFrame:
    """``settle`` for a step whose tasks pass whole texts to Python."""
    with text_batches(df.sparkSession):
        return settle(df, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(
    df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[dict] | dict], schema: str
) -> DataFrame:
    """``mapInArrow`` for a step that gives columns (name to array) for a batch."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = step(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array)
                 else columns[f.name].cast(f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

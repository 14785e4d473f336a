"""Left lookups in a table with one row per key, whatever the weight of single keys.

A small table is broadcast, after its rows and the bytes of its values have been counted. Beyond that, keys are split by
weight: keys that hold at least ``share`` of the rows number at most ``1 / share``, so their
part of the table is broadcast on a proven bound; every other key is light enough for a
shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourseloom.session import work_dir
from bourseloom.sources.tables import write_table

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1e-4


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back."""
    folder = work_dir(df.sparkSession, name)
    write_table(df, folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """The frame written once to the shared folder, and its row count seen while writing."""
    folder = work_dir(df.sparkSession, "lookup")
    rows = write_table(df, folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), rows


def _width(field: T.StructField) -> Column:
    """Bytes of a value: texts by their length, nested values by that of their JSON text."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(16)
    if isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)) + F.lit(16)
    return F.lit(16)


def value_bytes(df: DataFrame) -> int:
    """Bytes that the values of all rows take."""
    width = F.lit(0).cast("long")
    for field in df.schema:
        width = width + _width(field)
    return df.agg(F.sum(width)).first()[0] or 0


def lookup(
    df: DataFrame, dim: DataFrame, key: str, max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``df`` left-joined with ``dim``, unique on ``key``. Runs the jobs that size ``dim``."""
    stored, rows = measured(dim)
    if rows <= max_rows and value_bytes(stored) <= max_bytes:
        return df.join(F.broadcast(stored), key, "left")
    return split_lookup(df, stored, key)


def split_lookup(
    df: DataFrame, dim: DataFrame, key: str, weights: DataFrame | None = None,
    share: float = HOT_SHARE,
) -> DataFrame:
    """The same join for a ``dim`` of any size.

    ``weights`` has (key, n), the rows of ``df`` per key; it is counted if not given.
    """
    if weights is None:
        df = stored(df, "lookup-rows")
        weights = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = weights.agg(F.sum("n")).scalar()
    hot = weights.filter(F.col("n") >= total * share).select(F.col(key).alias("_hot"))
    found = hot.join(dim, F.col("_hot") == F.col(key), "left").drop(key)
    added = [c for c in dim.columns if c != key]
    same = df[key].eqNullSafe(F.col("_hot"))
    # the semi join can move below an aggregate in ``df``, so each half shuffles only its own rows
    heavy = (
        df.join(F.broadcast(hot), same, "left_semi").join(F.broadcast(found), same)
        .select(*df.columns, *added)
    )
    light = df.join(F.broadcast(hot), same, "left_anti").join(dim, key, "left")
    return heavy.unionByName(light.select(*df.columns, *added))

"""One row per key.

``row_number() = 1`` over the key: Spark keeps one candidate row per key on the map side
(WindowGroupLimit), so a key with any number of copies sends one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that sorts first under ``order``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def keep_first(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Earliest row per key; ties fall to the smallest remaining values, so runs agree."""
    rest = [c for c in df.columns if c not in keys and c not in by]
    return keep_one(df, keys, [F.col(c).asc_nulls_last() for c in (*by, *rest)])


def keep_latest(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Last row per key by ``by`` descending, nulls oldest; ties fall to the largest remaining values."""
    rest = [c for c in df.columns if c not in keys and c not in by]
    return keep_one(df, keys, [F.col(c).desc_nulls_last() for c in (*by, *rest)])

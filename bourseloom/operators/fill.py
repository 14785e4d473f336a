"""Forward fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def forward_fill(
    df: DataFrame, partition_col: str, order_col: str, columns: Sequence[str]
) -> DataFrame:
    """Replace each null by the last earlier non-null value of its column; leading nulls stay.

    One window per ``partition_col`` value. Right for rows that are unique per symbol and
    calendar day, where a century of one symbol is 36,525 rows. For series without
    such a bound use :func:`forward_fill_chunked`.
    """
    window = (
        Window.partitionBy(partition_col).orderBy(order_col)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = {c: F.last(c, ignorenulls=True).over(window) for c in columns}
    return df.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def forward_fill_chunked(
    df: DataFrame, partition_col: str, order_col: str, columns: Sequence[str], chunk: Column
) -> DataFrame:
    """The same result for a series of any length, a bounded chunk of it per window.

    ``chunk`` must never decrease along ``order_col`` (a truncated time, say). Each chunk is
    filled alone; the last known value of every chunk, one row each and combined on the map
    side, is carried forward over the chunks and fills what a chunk's head still lacks.
    Ties in ``order_col`` must not occur. ``partition_col`` must not be null.
    """
    rows = df.withColumn("_chunk", chunk)
    inside = (
        Window.partitionBy(partition_col, "_chunk").orderBy(order_col)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = rows.select(
        *[c for c in rows.columns if c not in columns],
        *[F.last(c, ignorenulls=True).over(inside).alias(c) for c in columns],
    )
    ends = rows.groupBy(partition_col, "_chunk").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order_col))).alias(f"_end_{c}")
          for c in columns]
    )
    before = (
        Window.partitionBy(partition_col).orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = ends.select(
        partition_col, "_chunk",
        *[F.last(f"_end_{c}", ignorenulls=True).over(before).alias(f"_in_{c}") for c in columns],
    )
    joined = filled.join(carried, [partition_col, "_chunk"], "left")
    return joined.select(
        *[F.coalesce(c, f"_in_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def forward_fill_counted(
    df: DataFrame, partition_col: str, order_col: str, columns: Sequence[str], unit: str = "minute",
    chunk_rows: int = 100_000,
) -> DataFrame:
    """The same fill with chunks cut by count: runs of time units of about ``chunk_rows`` rows.

    Units are counted first, a small table; a unit is never split, so ``unit`` must be short
    enough for its rows to fit a task.
    """
    unit_of = F.date_trunc(unit, F.col(order_col))
    rows = df.withColumn("_unit", unit_of)
    sizes = rows.groupBy(partition_col, "_unit").agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy(partition_col).orderBy("_unit")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    cut = sizes.select(
        partition_col, "_unit",
        F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / chunk_rows).alias("_cut"))
    placed = rows.join(cut, [partition_col, "_unit"]).drop("_unit").select(*df.columns, "_cut")
    return forward_fill_chunked(placed, partition_col, order_col, columns, F.col("_cut")).drop("_cut")

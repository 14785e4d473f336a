"""Ordered work on series of any length: a series is cut into chunks of counted rows.

Rows are counted per unit of time first, a small table. Running totals of these counts give every row
its place in its series without a window over the whole series, and places give chunks. What crosses
chunk borders is one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACE, CHUNK = "_place", "_chunk"
CHUNK_ROWS = 100_000


def with_chunks(
    rows: DataFrame, keys: Sequence[str], time: str, unit: str = "hour", chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Adds ``_chunk``, which rises with ``time``: runs of units of about ``chunk_rows`` rows.

    A unit is never split, so ``unit`` must be short enough for its rows to fit a task. Keys and times
    must not be null.
    """
    units = rows.withColumn("_unit", F.date_trunc(unit, F.col(time).cast("timestamp_ntz")))
    before = Window.partitionBy(*keys).orderBy("_unit").rowsBetween(Window.unboundedPreceding, -1)
    sizes = units.groupBy(*keys, "_unit").agg(F.count(F.lit(1)).alias("_n"))
    cut = sizes.select(*keys, "_unit", F.floor(
        F.coalesce(F.sum("_n").over(before), F.lit(0)) / chunk_rows).alias(CHUNK))
    return units.join(cut, [*keys, "_unit"]).select(*rows.columns, CHUNK)


def with_places(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], unit: str = "month", chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Adds ``_place``, 0 for the first row of its series, and ``_chunk`` of exactly ``chunk_rows`` places.

    The first column of ``order`` is the time; ``order`` must tell all rows of a series apart. Places
    inside a unit of time are counted in that unit alone.
    """
    units = rows.withColumn("_unit", F.date_trunc(unit, F.col(order[0]).cast("timestamp_ntz")))
    before = Window.partitionBy(*keys).orderBy("_unit").rowsBetween(Window.unboundedPreceding, -1)
    sizes = units.groupBy(*keys, "_unit").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(*keys, "_unit", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_unit").orderBy(*order)) - 1
    placed = units.withColumn(PLACE, inside).join(offsets, [*keys, "_unit"])
    placed = placed.select(*rows.columns, (F.col(PLACE) + F.col("_offset")).alias(PLACE))
    return placed.withColumn(CHUNK, F.expr(f"{PLACE} div {chunk_rows}"))


def carried(
    rows: DataFrame, keys: Sequence[str], ends: dict[str, Column], later: bool = False
) -> DataFrame:
    """(keys, _chunk, <name>): the nearest known ``ends`` value of the chunks before, or with ``later`` after.

    ``ends`` are aggregates of a chunk; null ones are looked through.
    """
    totals = rows.groupBy(*keys, CHUNK).agg(*[c.alias(n) for n, c in ends.items()])
    order = Window.partitionBy(*keys).orderBy(CHUNK)
    if later:
        frame, pick = order.rowsBetween(1, Window.unboundedFollowing), F.first
    else:
        frame, pick = order.rowsBetween(Window.unboundedPreceding, -1), F.last
    return totals.select(*keys, CHUNK, *[pick(n, ignorenulls=True).over(frame).alias(n) for n in ends])

"""As-of joins: each row gets the next or the last row of the other side by time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourseloom.operators.chunked import CHUNK, CHUNK_ROWS, carried, with_chunks


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
    columns: Sequence[str], direction: str = "last", within: Column | None = None, unit: str = "day",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Every left row once, with the right row's time as ``matched_<right_time>`` and its ``columns``.

    ``direction`` is ``last`` (the right row at or before the left time) or ``next`` (at or after).
    ``within`` is the largest distance in time, an interval; farther rows do not match. Right rows of
    one key and time count as one, that of the largest ``columns``. Left rows without a match, or with
    a null key or time, stay with nulls.

    Both sides are reduced to one row per key and time before they meet, so a key with a third of all
    rows sends its distinct times only; these are cut into counted chunks, each with a window of its
    own, and the row that a chunk takes from its neighbours is carried over by one row per chunk. The
    last step joins the left rows to their times, a join that can be split where one time is hot.
    """
    if direction not in ("last", "next"):
        raise ValueError(f"direction is last or next, not {direction}")
    later = direction == "next"
    known = [F.col(k).isNotNull() for k in keys]
    row = F.struct(F.col(right_time).alias("time"), *columns)
    asked = left.filter(reduce(and_, [*known, F.col(left_time).isNotNull()])).select(
        *keys, F.col(left_time).alias("_time"))
    asked = asked.withColumn("_row", F.lit(None).cast(right.select(row.alias("r")).schema["r"].dataType))
    held = right.filter(reduce(and_, [*known, F.col(right_time).isNotNull()])).select(
        *keys, F.col(right_time).alias("_time"), row.alias("_row"))
    times = asked.unionByName(held).groupBy(*keys, "_time").agg(F.max("_row").alias("_row"))
    rows = with_chunks(times, keys, "_time", unit, chunk_rows)
    inside = Window.partitionBy(*keys, CHUNK).orderBy("_time")
    if later:
        frame, pick, at = inside.rowsBetween(Window.currentRow, Window.unboundedFollowing), F.first, F.min_by
    else:
        frame, pick, at = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow), F.last, F.max_by
    end = at("_row", F.when(F.col("_row").isNotNull(), F.col("_time")))
    outside = carried(rows, keys, {"_outside": end}, later)
    found = rows.withColumn("_inside", pick("_row", ignorenulls=True).over(frame)).join(
        outside, [*keys, CHUNK], "left")
    match = F.coalesce("_inside", "_outside")
    if within is not None:
        near = (match["time"] <= F.col("_time") + within) if later else (match["time"] >= F.col("_time") - within)
        match = F.when(near, match)
    named = [f"_k{i}" for i in range(len(keys))]
    matches = found.select(*[F.col(k).alias(n) for k, n in zip(keys, named, strict=True)], "_time", match.alias("_match"))
    same = [F.col(k) == F.col(n) for k, n in zip(keys, named, strict=True)]
    joined = left.join(matches, reduce(and_, [*same, F.col(left_time) == F.col("_time")]), "left")
    return joined.select(
        *[left[c] for c in left.columns], F.col("_match.time").alias(f"matched_{right_time}"),
        *[F.col(f"_match.{c}").alias(c) for c in columns])

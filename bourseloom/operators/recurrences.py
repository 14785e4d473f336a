"""Linear recurrences over series of any length, and the price indicators that need them.

x[t] = a[t] * x[t-1] + b[t] is a run of affine maps, and maps compose: a chunk of a series is one map.
Chunks are worked off by themselves with windows, their maps are folded in order, and every chunk gets
its first state from that. No task sees more of a series than one chunk and a bounded list of maps.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourseloom.operators.chunked import CHUNK, PLACE, with_places

#: Largest sum of logs of ``a`` in a chunk, so that its powers stay inside a double.
MOST_LOG = 500.0
MOST_CHUNK = 10_000
#: Chunk maps that are folded in one list.
FAN = 512
RSI_DAYS, MACD_SPANS, MACD_SIGNAL, EMA_SPANS = 14, (12, 26), 9, (12, 26)


def chunk_length(least_factor: float) -> int:
    """Rows of a chunk for recurrences whose factors are at least ``least_factor`` (and at most 1)."""
    return max(1, min(MOST_CHUNK, int(MOST_LOG / -math.log(least_factor)) if least_factor < 1 else MOST_CHUNK))


def _folded(maps: str, first: Column) -> Column:
    """Array of (no, x): the state before each map of a sorted array of (no, a, b), from ``first``."""
    start = F.struct(F.array().cast("array<struct<no:bigint,x:double>>").alias("done"), first.cast("double").alias("x"))

    def step(acc: Column, m: Column) -> Column:
        return F.struct(
            F.concat(acc["done"], F.array(F.struct(m["no"].cast("long").alias("no"), acc["x"].alias("x")))).alias("done"),
            (m["a"] * acc["x"] + m["b"]).alias("x"))

    return F.aggregate(maps, start, step, lambda acc: acc["done"])


def _whole(maps: str) -> tuple[Column, Column]:
    """(a, b) of the maps of a sorted array, one after the other."""
    one = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"))

    def step(acc: Column, m: Column) -> Column:
        return F.struct((acc["a"] * m["a"]).alias("a"), (m["a"] * acc["b"] + m["b"]).alias("b"))

    both = F.aggregate(maps, one, step)
    return both["a"], both["b"]


def chunk_starts(maps: DataFrame, keys: Sequence[str], fan: int = FAN, levels: int = 2) -> DataFrame:
    """(keys, no, x): the state before each chunk, from (keys, no, a, b), one row per chunk.

    Runs of ``fan`` maps are folded in one list; with more than one level, the runs are maps of their own.
    """
    lists = maps.withColumn("_run", F.expr(f"no div {fan}") if levels > 1 else F.lit(0).cast("long"))
    lists = lists.groupBy(*keys, "_run").agg(F.array_sort(F.collect_list(F.struct("no", "a", "b"))).alias("maps"))
    if levels > 1:
        a, b = _whole("maps")
        runs = lists.select(*keys, F.col("_run").alias("no"), a.alias("a"), b.alias("b"))
        first = chunk_starts(runs, keys, fan, levels - 1).withColumnRenamed("no", "_run").withColumnRenamed("x", "_first")
        lists = lists.join(first, [*keys, "_run"])
    else:
        lists = lists.withColumn("_first", F.lit(0.0))
    return lists.select(*keys, F.inline(_folded("maps", F.col("_first"))))


def recurrences(
    placed: DataFrame, keys: Sequence[str], maps: dict[str, tuple[Column, Column]], fan: int = FAN
) -> DataFrame:
    """Adds ``name`` for each (a, b) of ``maps``: x[t] = a * x[t-1] + b, with 0 before the first row.

    ``placed`` comes from :func:`with_places`, its chunks no longer than :func:`chunk_length` of the
    least factor. Factors are above 0 and at most 1; neither a nor b may be null.
    """
    inside = Window.partitionBy(*keys, CHUNK).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    logs = {n: F.sum(F.log(a)).over(inside) for n, (a, _) in maps.items()}
    rows = placed.withColumns({f"_log_{n}": c for n, c in logs.items()} | {f"_b_{n}": b for n, (_, b) in maps.items()})
    rows = rows.withColumns({
        f"_z_{n}": F.exp(f"_log_{n}") * F.sum(F.col(f"_b_{n}") * F.exp(-F.col(f"_log_{n}"))).over(inside) for n in maps})
    last = {n: F.max_by(F.struct(F.exp(f"_log_{n}").alias("a"), F.col(f"_z_{n}").alias("b")), PLACE) for n in maps}
    ends = rows.groupBy(*keys, CHUNK).agg(*[c.alias(n) for n, c in last.items()])
    each = ends.select(*keys, F.col(CHUNK).alias("no"), F.explode(F.create_map(
        *[x for n in maps for x in (F.lit(n), F.col(n))])).alias("_name", "_map"))
    starts = chunk_starts(each.select(*keys, "_name", "no", "_map.a", "_map.b"), [*keys, "_name"], fan)
    starts = starts.groupBy(*keys, F.col("no").alias(CHUNK)).agg(
        *[F.max(F.when(F.col("_name") == n, F.col("x"))).alias(f"_x_{n}") for n in maps])
    joined = rows.join(starts, [*keys, CHUNK])
    return joined.select(*[c for c in placed.columns if c not in maps], *[
        (F.exp(f"_log_{n}") * F.col(f"_x_{n}") + F.col(f"_z_{n}")).alias(n) for n in maps])


def ema_map(value: Column, span: int) -> tuple[Column, Column]:
    """Exponential average with factor 2 / (span + 1) that starts at the first value."""
    part = 2.0 / (span + 1)
    first = F.col(PLACE) == 0
    return F.when(first, 1.0).otherwise(1.0 - part), F.when(first, value).otherwise(part * value)


def wilder_map(value: Column, days: int) -> tuple[Column, Column]:
    """Wilder's average: the mean of the first ``days`` changes, then 1 / ``days`` of each new one.

    Changes start at place 1. Before place ``days`` the sum is not complete and means nothing yet.
    """
    return F.when(F.col(PLACE) <= days, 1.0).otherwise((days - 1.0) / days), value / days


def recursive_indicators(
    prices: DataFrame, ema_spans: Sequence[int] = EMA_SPANS, rsi_days: int = RSI_DAYS,
    macd_spans: tuple[int, int] = MACD_SPANS, macd_signal: int = MACD_SIGNAL, chunk_rows: int | None = None,
    fan: int = FAN, unit: str = "month",
) -> DataFrame:
    """(symbol, date, close, ema_<n>.., rsi_<n>, macd, macd_signal, macd_histogram) per priced row.

    Input rows are unique per symbol and date; rows without a close have no state and are left out.
    The relative strength is null before ``rsi_days`` changes are known, 100 without any loss, and 50
    if nothing moved. ``chunk_rows`` can only shorten the chunks that the factors allow.
    """
    spans = sorted({*ema_spans, *macd_spans})
    least = min(1 - 2 / (min(*spans, macd_signal) + 1), (rsi_days - 1) / rsi_days)
    length = min(chunk_length(least), chunk_rows or MOST_CHUNK)
    known = prices.filter(F.col("close").isNotNull()).select("symbol", "date", F.col("close").cast("double"))
    placed = with_places(known, ["symbol"], ["date"], unit, length)
    # the change at a chunk's first row needs the chunk before: its last close is one row
    before = placed.groupBy("symbol", (F.col(CHUNK) + 1).alias(CHUNK)).agg(F.max_by("close", PLACE).alias("_before"))
    lag = F.lag("close").over(Window.partitionBy("symbol", CHUNK).orderBy(PLACE))
    change = F.coalesce(F.col("close") - F.coalesce("_lag", "_before"), F.lit(0.0))
    rows = placed.withColumn("_lag", lag).join(before, ["symbol", CHUNK], "left").withColumn("_change", change)
    rows = rows.drop("_lag", "_before")
    gain, loss = F.greatest("_change", F.lit(0.0)), F.greatest(-F.col("_change"), F.lit(0.0))
    maps = {f"ema_{n}": ema_map(F.col("close"), n) for n in spans}
    maps |= {"_gain": wilder_map(gain, rsi_days), "_loss": wilder_map(loss, rsi_days)}
    made = recurrences(rows, ["symbol"], maps, fan)
    made = made.withColumn("macd", F.col(f"ema_{macd_spans[0]}") - F.col(f"ema_{macd_spans[1]}"))
    made = recurrences(made, ["symbol"], {"macd_signal": ema_map(F.col("macd"), macd_signal)}, fan)
    total = F.col("_gain") + F.col("_loss")
    rsi = F.when(F.col(PLACE) >= rsi_days, F.when(total == 0, 50.0).otherwise(100.0 * F.col("_gain") / total))
    return made.select(
        "symbol", "date", "close", *[f"ema_{n}" for n in ema_spans], rsi.alias(f"rsi_{rsi_days}"), "macd",
        "macd_signal", (F.col("macd") - F.col("macd_signal")).alias("macd_histogram"))

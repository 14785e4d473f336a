"""Streams that keep state: first arrivals, alerts with timers, and runs that stop by their own progress.

State lives in the state store (RocksDB in ``session.CLUSTER_CONF``) and in the checkpoint, so it outlives
lost executors and restarts. What is kept per key is a few numbers, and watermarks bound how long.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from bourseloom.operators.alerts import ERROR_RATE_LIMIT, HOLD_SECONDS, RULE_SLIDE, RULE_WINDOW

# --- first arrivals --------------------------------------------------------------------------------


def first_in_state(
    stream: DataFrame, key: Sequence[str], event_time: str, keep_for: str
) -> DataFrame:
    """The first row of a key to arrive, once; a key is remembered until ``keep_for`` after its time.

    Repeats inside a micro-batch and over micro-batches are dropped by the state store, which forgets a
    key when the watermark passes its row's ``event_time`` plus ``keep_for``: its size follows the keys of
    that span and not the stream. A repeat that arrives later than that is emitted again, and a row whose
    time is null is never late. Which of one micro-batch's rows of a key is first is the source's order.
    """
    return stream.withWatermark(event_time, keep_for).dropDuplicatesWithinWatermark(list(key))


def start_first_arrivals(
    stream: DataFrame, key: Sequence[str], event_time: str, keep_for: str, out: str, checkpoint: str,
) -> StreamingQuery:
    """Runs :func:`first_in_state` over what is there, appending each first row to the folder ``out``."""
    return (first_in_state(stream, key, event_time, keep_for).writeStream.format("parquet")
            .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def state_rows(query: StreamingQuery) -> int:
    """Rows in the state stores of a query's last micro-batch, as its progress shows them."""
    last = query.lastProgress
    operators = json.loads(last.json)["stateOperators"] if last else []
    return sum(op["numRowsTotal"] for op in operators)


# --- alerts with timers ----------------------------------------------------------------------------

_EVENTS = "alert string, state string, at timestamp, pending_from timestamp, evaluations long"
#: The states of an alert in the order that they are reached.
PENDING, FIRING, RESOLVED = "pending", "firing", "resolved"


def closed_windows(
    stream: DataFrame, time: str, is_error: Column, late: str, window: str = RULE_WINDOW, slide: str = RULE_SLIDE,
    limit: float = ERROR_RATE_LIMIT,
) -> DataFrame:
    """(alert, closed_at, window_end, breached): the error rule for each window, once, when it is closed.

    ``time`` is a timestamp. A window is closed when the watermark, ``late`` behind the newest time, has
    passed its end; ``closed_at`` is its last moment. Windows without events have no row.
    """
    counts = stream.withWatermark(time, late).groupBy(F.window(time, window, slide).alias("w")).agg(
        F.count_if(is_error).alias("errors"))
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    return counts.select(
        F.lit("errors").alias("alert"), F.window_time("w").alias("closed_at"), F.col("w.end").alias("window_end"),
        (F.col("errors") / seconds > limit).alias("breached"))


def transitions(
    evaluations: DataFrame, slide_seconds: int, hold_seconds: int = HOLD_SECONDS
) -> DataFrame:
    """(alert, state, at, pending_from, evaluations): when each alert becomes pending, fires and is resolved.

    ``evaluations`` is a stream of (alert, closed_at, window_end, breached), one row per alert and window,
    in the order of time over micro-batches. A run of breached ones is unbroken as long as they are
    ``slide_seconds`` apart. It is pending from its first one, fires at the one that is ``hold_seconds``
    later, and is resolved by the next evaluation that is not breached, or, where none comes because its
    windows had no events, by an event-time timer once other evaluations have moved the watermark past it.
    State per alert: where its run began, its last evaluation, their number and whether it has fired.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run = state.getOption  # (first, last, evaluations, fired), times in microseconds
        out: list[tuple] = []

        def note(what: str, at: int, first: int, n: int) -> None:
            out.append((key[0], what, pd.Timestamp(at, unit="us"), pd.Timestamp(first, unit="us"), n))

        def resolve() -> None:
            first, last, n, _ = run
            note(RESOLVED, last + slide_seconds * 1_000_000, first, n)

        if state.hasTimedOut:
            if run:
                resolve()
            state.remove()
        else:
            rows = sorted({(int(t.value // 1000), bool(b)) for f in frames
                           for t, b in zip(f["window_end"], f["breached"], strict=True)})
            for end, breached in rows:
                if run and (end > run[1] + slide_seconds * 1_000_000 or end > run[1] and not breached):
                    resolve()
                    run = None
                if not breached:
                    continue
                if run is None:
                    run = (end, end, 1, False)
                    note(PENDING, end, end, 1)
                elif end > run[1]:
                    run = (run[0], end, run[2] + 1, run[3])
                if not run[3] and run[1] - run[0] >= hold_seconds * 1_000_000:
                    run = (*run[:3], True)
                    note(FIRING, run[1], run[0], run[2])
            if run is None:
                if state.exists:
                    state.remove()
            else:
                state.update(run)
                due = run[1] // 1000 + slide_seconds * 1000
                state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=["alert", "state", "at", "pending_from", "evaluations"])

    timed = evaluations.withWatermark("closed_at", "0 seconds")
    return timed.groupBy("alert").applyInPandasWithState(
        step, _EVENTS, "first long, last long, evaluations long, fired boolean", "append",
        GroupStateTimeout.EventTimeTimeout)


def start_closed_windows(
    stream: DataFrame, time: str, is_error: Column, late: str, evaluations: str, checkpoint: str,
    window: str = RULE_WINDOW, slide: str = RULE_SLIDE, limit: float = ERROR_RATE_LIMIT,
) -> StreamingQuery:
    """Evaluates the error rule over what is there and appends closed windows to the folder ``evaluations``.

    Each task of the aggregate writes the windows of its own part of the state: one task for all of them
    would hold the memory of all parts at once. Parts without a closed window leave no file.
    """
    rows = closed_windows(stream, time, is_error, late, window, slide, limit)
    return (rows.writeStream.format("parquet").option("path", evaluations)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def start_transitions(
    spark: SparkSession, evaluations: str, out: str, checkpoint: str, slide_seconds: int,
    hold_seconds: int = HOLD_SECONDS,
) -> StreamingQuery:
    """Follows the folder of evaluations and appends the alerts' transitions to ``out``.

    A second query, as Spark has no keyed state of one's own behind a streaming aggregate. Its input is one
    row per alert and window, so one task per alert is enough whatever the number of events.
    """
    schema = "alert string, closed_at timestamp, window_end timestamp, breached boolean"
    rows = spark.readStream.schema(schema).parquet(evaluations)
    return (transitions(rows, slide_seconds, hold_seconds).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def runs_of(events: DataFrame) -> DataFrame:
    """(alert, pending_from, fired, resolved_at, evaluations) of the runs that transitions tell of.

    The last two are null as long as a run is open.
    """
    over = F.col("state") == RESOLVED
    return events.groupBy("alert", "pending_from").agg(
        F.bool_or(F.col("state") == FIRING).alias("fired"), F.max(F.when(over, F.col("at"))).alias("resolved_at"),
        F.max(F.when(over, F.col("evaluations"))).alias("evaluations"))


# --- bounded consumption ---------------------------------------------------------------------------


def consume_until(
    accepted: DataFrame, wanted: int, write: Callable[[DataFrame, int], None], checkpoint: str,
) -> int:
    """Runs micro-batches until ``wanted`` accepted rows are written or nothing is left; gives their number.

    The rows that each micro-batch has written are counted, and none is taken on once enough are there. A
    micro-batch is never cut, so the number may be larger by less than one; how much one reads is the
    source's option (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``). What is not read stays for the next run over the same ``checkpoint``: runs
    follow each other without a gap or a repeat. Without rows wanted, nothing is read.
    """
    if wanted <= 0:
        return 0
    written = 0

    def guarded(batch: DataFrame, epoch: int) -> None:
        nonlocal written
        if written >= wanted:
            raise _Enough
        batch.persist()
        try:
            n = batch.count()
            write(batch, epoch)
        finally:
            batch.unpersist()
        written += n

    query = accepted.writeStream.foreachBatch(guarded).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    try:
        query.awaitTermination()
    except Exception:
        # a micro-batch that was refused is not committed: the next run starts with it
        if written < wanted:
            raise
    return written


class _Enough(Exception):
    """No further micro-batch is wanted."""

"""Silent workers on a heartbeat stream."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cohortmill.operators.health import CHECK_PERIOD_SECONDS, HEARTBEAT_TIMEOUT_SECONDS

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("worker", T.StringType()),
        T.StructField("last_seen_us", T.LongType()),
        T.StructField("stalled", T.BooleanType()),
    ]
)
_STATE_SCHEMA = T.StructType([T.StructField("last_seen_us", T.LongType())])
_PARTIAL_SCHEMA = "worker string, last_seen_us bigint"


def _newest_per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fold each Arrow batch to one row per worker before the shuffle."""
    for pdf in batches:
        yield pdf.groupby("worker", as_index=False)["last_seen_us"].max()


def stalled_worker_stream(
    heartbeats: DataFrame,
    timeout: float = HEARTBEAT_TIMEOUT_SECONDS,
    clock: Callable[[], float] = time.time,
) -> DataFrame:
    """A change log of worker states: ``worker, last_seen_us, stalled``.

    Per worker only the newest heartbeat is kept. A processing-time timer is set for
    the moment it becomes too old, so a silent worker is reported without any new
    input; a heartbeat after that reports it alive again. ``clock`` gives the present
    in epoch seconds and exists for replays of recorded heartbeats.
    """
    limit_us = int(timeout * 1_000_000)

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = state.get[0] if state.exists else None
        newest = [int(pdf["last_seen_us"].max()) for pdf in batches if len(pdf)]
        if known is None and not newest:
            return
        last = max(newest if known is None else [known, *newest])
        silent_us = int(clock() * 1_000_000) - last
        stalled = silent_us > limit_us
        if stalled:
            state.remove()
        else:
            state.update((last,))
            state.setTimeoutDuration(max(1, (limit_us - silent_us) // 1000 + 1))
        if stalled or newest:
            yield pd.DataFrame({"worker": [key[0]], "last_seen_us": [last], "stalled": [stalled]})

    seen = F.unix_micros(F.col("last_seen").cast("timestamp"))
    partial = heartbeats.select(F.col("worker").cast("string").alias("worker"), seen.alias("last_seen_us"))
    return (
        partial.mapInPandas(_newest_per_batch, _PARTIAL_SCHEMA)
        .groupBy("worker")
        .applyInPandasWithState(
            watch, ALERT_SCHEMA, _STATE_SCHEMA, "append", GroupStateTimeout.ProcessingTimeTimeout
        )
    )


def current_alerts(log: DataFrame) -> DataFrame:
    """Workers whose newest entry in the change log says stalled."""
    newest = F.max_by("stalled", F.struct("last_seen_us", "stalled"))
    return log.groupBy("worker").agg(newest.alias("stalled")).filter("stalled").select("worker")


def periodic_check(
    heartbeats: DataFrame,
    path: str,
    checkpoint: str,
    timeout: float = HEARTBEAT_TIMEOUT_SECONDS,
    period: float = CHECK_PERIOD_SECONDS,
    clock: Callable[[], float] = time.time,
    once: bool = False,
):
    """Run :func:`stalled_worker_stream` every ``period`` seconds into Parquet.

    ``once`` handles what is there now in a single micro-batch and stops; the
    available-now trigger would not, because pending timers keep asking for batches.
    """
    writer = (
        stalled_worker_stream(heartbeats, timeout, clock)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"once": True} if once else {"processingTime": f"{int(period * 1000)} milliseconds"}
    return writer.trigger(**trigger).start()

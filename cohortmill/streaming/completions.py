"""Task completions recorded and counted while they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortmill.sources.ledger_store import ledger_compact, ledger_record

# Data folders a stream lets a store have before it compacts it.
COMPACT_AFTER = 64


def completion_sink(
    results: DataFrame, path: str, checkpoint: str, once: bool = False, first_run: int = 0, **trigger: str
):
    """Record outcomes in a ledger store as they arrive.

    A micro-batch is the run of its own number, so a replayed batch
    replaces itself and nothing is recorded twice. In a store that holds runs already,
    ``first_run`` must lie above them. Each time the store has ``COMPACT_AFTER`` folders the stream
    compacts them into one, so reading it does not slow down with its age.
    """

    def record(batch: DataFrame, batch_id: int) -> None:
        if ledger_record(batch, path, first_run + batch_id, "stream") >= COMPACT_AFTER:
            ledger_compact(batch.sparkSession, path)

    writer = results.writeStream.option("checkpointLocation", checkpoint).foreachBatch(record)
    return writer.trigger(**({"availableNow": True} if once else trigger or {"processingTime": "10 seconds"})).start()


def progress_stream(results: DataFrame, by: Sequence[str] = ("batch",)) -> DataFrame:
    """Completions per batch so far, as a streaming aggregate."""
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("done"), F.count_if("did_succeed").alias("successful")
    )


def live_progress(results: DataFrame, path: str, checkpoint: str, by: Sequence[str] = ("batch",), once: bool = False):
    """Write each micro-batch's changed counts; :func:`latest_progress` reads them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            f"{path.rstrip('/')}/update={batch_id}"
        )

    writer = (
        progress_stream(results, by)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return writer.trigger(**({"availableNow": True} if once else {"processingTime": "10 seconds"})).start()


def latest_progress(updates: DataFrame, totals: DataFrame, by: Sequence[str] = ("batch",)) -> DataFrame:
    """The newest count of each batch next to its total."""
    newest = updates.groupBy(*by).agg(F.max("done").alias("done"), F.max("successful").alias("successful"))
    return totals.select(*by, "total").join(newest, list(by), "left").select(
        *by, F.coalesce("done", F.lit(0)).alias("done"), F.coalesce("successful", F.lit(0)).alias("successful"), "total"
    )

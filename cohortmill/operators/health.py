"""Silent workers and blocking locks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Seconds a lock's log or a worker's heartbeat may be old.
LOCK_TOLERANCE_SECONDS = 86_400
HEARTBEAT_TIMEOUT_SECONDS = 60
CHECK_PERIOD_SECONDS = 120
# Lock and log files below a subject's folder.
LOCK_PATTERN = r"^([^/]+)/scripts/IsRunning[^/]*$"
LOG_PATTERN = r"^([^/]+)/scripts/recon-all\.log$"


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def stalled_workers(
    heartbeats: DataFrame, now: Column, timeout: float = HEARTBEAT_TIMEOUT_SECONDS
) -> DataFrame:
    """Workers whose newest heartbeat is more than ``timeout`` seconds before ``now``."""
    newest = heartbeats.groupBy("worker").agg(F.max("last_seen").alias("last_seen"))
    silent = _micros(now) - _micros(F.col("last_seen"))
    return newest.filter(silent > F.lit(int(timeout * 1_000_000)))


def lock_tables(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``locks(subject, path)`` and ``logs(subject, mtime)`` of a scanned subjects folder."""
    path = F.col("path")
    locks = catalog.filter(path.rlike(LOCK_PATTERN))
    logs = catalog.filter(path.rlike(LOG_PATTERN))
    return (
        locks.select(F.regexp_extract(path, LOCK_PATTERN, 1).alias("subject"), "path"),
        logs.select(F.regexp_extract(path, LOG_PATTERN, 1).alias("subject"), "mtime"),
    )


def lock_status(
    subjects: DataFrame, locks: DataFrame, logs: DataFrame, now: Column, tolerance: float = LOCK_TOLERANCE_SECONDS
) -> DataFrame:
    """Per subject: ``clear`` without a lock, ``blocked`` by a recent log, else ``stale``.

    A missing log counts as modified at the epoch. The three tables are stacked and
    folded per subject in one shuffle.
    """
    never = F.lit(None).cast("bigint")
    stacked = (
        subjects.select("subject", F.lit(0).alias("lock"), never.alias("mtime"))
        .unionByName(locks.select("subject", F.lit(1).alias("lock"), never.alias("mtime")))
        .unionByName(logs.select("subject", F.lit(0).alias("lock"), _micros(F.col("mtime")).alias("mtime")))
    )
    folded = stacked.groupBy("subject").agg(F.max("lock").alias("lock"), F.max("mtime").alias("mtime"))
    age = _micros(now) - F.coalesce(F.col("mtime"), F.lit(0))
    status = (
        F.when(F.col("lock") == 0, "clear")
        .when(age < F.lit(int(tolerance * 1_000_000)), "blocked")
        .otherwise("stale")
    )
    return folded.select("subject", status.alias("status"))

"""Ledger files: append-only records, the current view, and the CSV exchange form.

A store holds ``data`` folders, the ``versions`` that say which of them count (see ``commits``), and the ``journal`` folders
of batches that still run or were lost; readers see their outcomes too, each as it is made.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cohortmill.operators.ledgers import LEDGER_SCHEMA, latest_record
from cohortmill.sources.commits import Conflict, Entries, commit, latest
from cohortmill.sources.journal import file_system, journal_read

RECORD_SCHEMA = T.StructType(
    [
        *LEDGER_SCHEMA.fields,
        T.StructField("seq", T.LongType()),
        T.StructField("recorded_at", T.TimestampType()),
        T.StructField("position", T.LongType()),
    ]
)
# Time counts first: runs and streams number their records each for themselves.
ORDER = ("recorded_at", "position", "seq", "did_succeed", "return_code")


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def ledger_read(spark: SparkSession, path: str) -> DataFrame:
    """A CSV ledger with header and fixed types; a missing file is an empty ledger.

    A cell that does not fit its type raises when it is read. Quotes inside a quoted name are
    doubled.
    """
    try:
        reader = spark.read.schema(LEDGER_SCHEMA).option("header", "true").option("mode", "FAILFAST")
        return reader.option("escape", '"').csv(path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def ledger_write_csv(ledger: DataFrame, path: str) -> None:
    """The ledger in the exchange form :func:`ledger_read` reads."""
    ledger.select(*LEDGER_SCHEMA.names).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def ledger_record(results: DataFrame, path: str, run: int, token: str | None = None) -> int:
    """Append the outcomes of one run as one commit; how many data folders the store has then.

    Recording a run again replaces exactly that run (unless it was compacted meanwhile; then the same outcomes
    count once), and writers of different runs do not meet. Later records win, by time. A ``token``
    keeps apart writers that may have chosen the same number. Results may
    bring a ``recorded_at`` time, which orders repeats of a task inside the run, and a
    ``position`` number for repeats at the same time.
    """
    brought = set(results.columns)
    key = f"run={run}{'-' + token if token else ''}"
    folder = f"{key}-{uuid.uuid4().hex}"
    (
        results.withColumn("recorded_at", F.col("recorded_at") if "recorded_at" in brought else F.current_timestamp())
        .withColumn("position", F.col("position").cast("bigint") if "position" in brought else F.lit(0).cast("bigint"))
        .withColumn("seq", F.lit(run).cast("bigint"))
        .select(*RECORD_SCHEMA.names)
        .write.parquet(f"{path.rstrip('/')}/data/{folder}")
    )
    return len(commit(path, lambda entries: {**entries, key: folder}))


def _read(spark: SparkSession, path: str, entries: Entries) -> DataFrame:
    if not entries:
        return spark.createDataFrame([], RECORD_SCHEMA)
    return spark.read.schema(RECORD_SCHEMA).parquet(*[f"{path.rstrip('/')}/data/{x}" for x in entries.values()])


def ledger_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record that counts, and what running or lost batches have journalled; a missing store is empty."""
    committed = _read(spark, path, latest(path)[1])
    journal = f"{path.rstrip('/')}/journal"
    system, place = file_system(journal)
    if not system.get_file_info(fs.FileSelector(place, allow_not_found=True)):
        return committed
    return committed.unionByName(journal_read(spark, journal).select(*RECORD_SCHEMA.names))


def ledger_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest record of each task."""
    return latest_record(ledger_records(spark, path), ORDER)


def ledger_compact(spark: SparkSession, path: str, target: str | None = None) -> None:
    """Rewrite the current view as one folder: in this store, or as a new store in ``target``.

    In place it is a commit like any other: what others record meanwhile stays, and if a run that went in was recorded
    again meanwhile, the work is done anew. Journals stay as they are.
    """
    if target is not None:
        if latest(target)[0]:
            raise FileExistsError(target)
        ledger_record_as_is(ledger_current(spark, path), target, {}, {})
        return
    while True:
        entries = latest(path)[1]
        if len(entries) < 2:
            return
        try:
            ledger_record_as_is(latest_record(_read(spark, path, entries), ORDER), path, entries, entries)
            return
        except Conflict:
            continue


def ledger_record_as_is(records: DataFrame, path: str, instead: Entries, expected: Entries) -> None:
    """Commit ``records`` with their own times and numbers instead of some entries, which must still be there."""
    folder = f"compact-{uuid.uuid4().hex}"
    records.select(*RECORD_SCHEMA.names).write.parquet(f"{path.rstrip('/')}/data/{folder}")

    def change(entries: Entries) -> Entries:
        if any(entries.get(key) != value for key, value in expected.items()):
            raise Conflict(path)
        return {"compact": folder, **{key: value for key, value in entries.items() if key not in instead}}

    commit(path, change)


def journal_close(path: str, token: str) -> str:
    """Put a recorded batch's journal with the store's logs, out of sight of readers; where it is then."""
    system, root = file_system(path)
    logs = f"{root.rstrip('/')}/logs"
    if system.get_file_info(f"{root.rstrip('/')}/journal/{token}").type == fs.FileType.Directory:
        system.create_dir(logs, recursive=True)
        system.move(f"{root.rstrip('/')}/journal/{token}", f"{logs}/{token}")
    return f"{path.rstrip('/')}/logs/{token}"

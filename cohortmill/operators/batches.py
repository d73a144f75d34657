"""User functions over work items, on the workers, with per-item outcomes."""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from cohortmill.functions.tasks import task_name
from cohortmill.operators.ledgers import latest_record
from cohortmill.operators.ordered import number_rows
from cohortmill.session import materialise, scratch_path, worker_partitions
from cohortmill.sources.journal import Journal, journal_read

RAISED_RETURN_CODE = -1
# Results held in a worker before they are passed on; captured logs may be large.
FLUSH_ROWS = 1_000
FLUSH_CHARACTERS = 4_000_000
# Tasks of a batch per worker slot: a slot that ends early takes another one.
TASKS_PER_SLOT = 4


class TaskResult(NamedTuple):
    """What a task function returns."""

    did_succeed: bool
    return_code: int = 0
    stdout: str | None = None
    stderr: str | None = None


RESULT_SCHEMA = T.StructType(
    [
        T.StructField("task_name", T.StringType()),
        T.StructField("did_succeed", T.BooleanType()),
        T.StructField("return_code", T.IntegerType()),
        T.StructField("stdout", T.StringType()),
        T.StructField("stderr", T.StringType()),
    ]
)
RESULT_ARROW = pa.schema(
    [
        ("task_name", pa.string()),
        ("did_succeed", pa.bool_()),
        ("return_code", pa.int32()),
        ("stdout", pa.string()),
        ("stderr", pa.string()),
    ]
)

TaskFunction = Callable[..., TaskResult]
Cleanup = Callable[..., object]
Record = Callable[[DataFrame, int], object]


def name_items(items: DataFrame, task: str, keys: Sequence[str], sep: str | None = None) -> DataFrame:
    """Items with their ledger name ``task_name``."""
    return items.withColumn("task_name", task_name(task, *[F.col(k) for k in keys], sep=sep))


def _sent(items: DataFrame, arguments: Sequence[str], partitions: int) -> DataFrame:
    """``task_name`` and the arguments of every item as ``arg_`` columns, dealt out evenly.

    A struct column passes its fields as arguments of their own. Items with a ``row_number`` are cut into
    ranges of it; without one they are dealt in turn.
    """
    structs = {
        f.name: [x.name for x in f.dataType.fields]
        for f in items.schema.fields
        if f.name in arguments and isinstance(f.dataType, T.StructType)
    }
    names = [x for name in arguments for x in structs.get(name, [name])]
    if len(set(names)) != len(names):
        raise ValueError(f"arguments share a name: {names}")
    flat = [
        F.col(f"{name}.{x}" if name in structs else name).alias(f"arg_{x}")
        for name in arguments
        for x in structs.get(name, [name])
    ]
    numbered = "row_number" in items.columns
    dealt = items.repartitionByRange(partitions, "row_number") if numbered else items.repartition(partitions)
    return dealt.select("task_name", *flat)


def _caller(fn: TaskFunction, cleanup: Cleanup | None) -> Callable[[dict], TaskResult]:
    """Calls ``fn`` on an item's ``arg_`` values, and ``cleanup`` after it."""

    def call(item: dict) -> TaskResult:
        args = {key.removeprefix("arg_"): value for key, value in item.items()}
        try:
            result = TaskResult(*fn(**args))
        except (Exception, SystemExit):
            return TaskResult(False, RAISED_RETURN_CODE, None, traceback.format_exc())
        if cleanup is not None:
            try:
                cleanup(bool(result.did_succeed), **args)
            except (Exception, SystemExit):
                pass
        return result

    return call


def run_items(
    items: DataFrame,
    fn: TaskFunction,
    arguments: Sequence[str],
    cleanup: Cleanup | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Call ``fn`` once per item with its columns as named arguments.

    A struct column passes its fields as arguments of their own. A non-zero return
    code is data; an exception, an exit of the interpreter too, becomes a failed row.
    ``cleanup(did_succeed, **args)`` runs on the same worker right after an item that did
    not raise; its outcome is ignored. Spark may run an item again after losing an
    executor, so ``fn`` must be idempotent. Items with a ``row_number`` are cut into ranges of
    it, so each task gets as many as the others; without one they are dealt in turn.
    """
    call = _caller(fn, cleanup)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, text = [], 0
        for batch in batches:
            for item in batch.to_pylist():
                name = item.pop("task_name")
                result = call(item)
                rows.append({"task_name": name, **result._asdict()})
                text += len(result.stdout or "") + len(result.stderr or "")
                if len(rows) >= FLUSH_ROWS or text >= FLUSH_CHARACTERS:
                    yield pa.RecordBatch.from_pylist(rows, schema=RESULT_ARROW)
                    rows, text = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=RESULT_ARROW)

    return _sent(items, arguments, partitions or worker_partitions(items.sparkSession)).mapInArrow(run, RESULT_SCHEMA)


def run_journalled(
    items: DataFrame,
    fn: TaskFunction,
    arguments: Sequence[str],
    journal: str,
    cleanup: Cleanup | None = None,
    partitions: int | None = None,
) -> None:
    """:func:`run_items` whose tasks write every outcome below ``journal`` as it is made.

    One job without barriers: a slow item delays its own task only. A task that Spark starts again skips what its
    earlier attempts have outcomes of.
    """
    call = _caller(fn, cleanup)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        with Journal(journal, task.partitionId(), task.taskAttemptId()) as own:
            known = own.known() if task.attemptNumber() else set()
            for batch in batches:
                for item in batch.to_pylist():
                    name = item.pop("task_name")
                    if name not in known:
                        own.add({"task_name": name, **call(item)._asdict()})
        yield pa.RecordBatch.from_pydict({"rows": [own.rows]}, schema=pa.schema([("rows", pa.int64())]))

    parts = partitions or TASKS_PER_SLOT * worker_partitions(items.sparkSession)
    _sent(items, arguments, parts).mapInArrow(run, "rows long").agg(F.sum("rows")).collect()


def _in_waves(todo: DataFrame, fn: TaskFunction, arguments: Sequence[str], cleanup: Cleanup | None, slots: int, record: Record | None, seconds: float) -> DataFrame:
    """Run items some at a time, the first wave of a few per worker, later ones of about ``seconds``."""
    spark = todo.sparkSession
    todo = number_rows(todo, ["task_name"])
    total = todo.agg(F.coalesce(F.max("n_rows"), F.lit(0))).first()[0]
    folder = scratch_path(spark, "batch")
    start, size, wave = 0, 4 * slots, 0
    while start < total or not wave:
        began = time.monotonic()
        mine = todo.filter((F.col("row_number") >= start) & (F.col("row_number") < start + size))
        here = f"{folder}/wave={wave}"
        run_items(mine, fn, arguments, cleanup, 4 * slots).write.parquet(here)
        if record is not None:
            record(spark.read.schema(RESULT_SCHEMA).parquet(here), wave)
        took = time.monotonic() - began
        start, wave = start + size, wave + 1
        if took < seconds / 2:
            size *= 8 if took < seconds / 16 else 2
        elif took > 2 * seconds:
            size = max(slots, size // 2)
    return spark.read.schema(RESULT_SCHEMA).parquet(folder).select(*RESULT_SCHEMA.names)


def apply_batch(
    items: DataFrame,
    ledger: DataFrame,
    fn: TaskFunction,
    arguments: Sequence[str],
    cleanup: Cleanup | None = None,
    partitions: int | None = None,
    record: Record | None = None,
    wave_seconds: float | None = None,
    journal: str | None = None,
    close: Callable[[], str] | None = None,
) -> DataFrame:
    """Outcome of every item: finished ones from the ledger, the others run now.

    ``ledger`` is the current view, one row per task; an item given twice counts once.
    Items are first written with what the ledger says of them, so one moment decides
    what runs even while others record. They then run as one job whose tasks write each outcome
    to ``journal`` (a new folder of the shared one by default) as it is made. A run that is lost and
    started again with the same journal goes on from there: what succeeded before does not run again.
    At the end ``record(results, 0)`` gets the new outcomes, and ``close()`` may
    move the journal; it returns where to. With ``wave_seconds`` items run in waves instead, of about that time each, and
    ``record(results, wave)`` gets those of each wave before the next one starts. Using the returned frame several
    times does not run ``fn`` again. ``cached`` tells items already done.
    """
    spark = items.sparkSession
    known = ledger.filter("did_succeed").select("task_name", "return_code")
    before = None
    if journal is not None and wave_seconds is None:
        before = latest_record(journal_read(spark, journal), ("recorded_at", "position")).filter("did_succeed").select("task_name", "return_code")
        before = None if before.isEmpty() else before
        known = known.unionByName(before) if before is not None else known
    done = known.groupBy("task_name").agg(F.max("return_code").alias("_code"), F.lit(True).alias("_done"))
    flagged = materialise(items.dropDuplicates(["task_name"]).join(done, "task_name", "left"), "items")
    todo = flagged.filter("_done IS NULL").drop("_code", "_done")
    if wave_seconds is not None:
        fresh = _in_waves(todo, fn, arguments, cleanup, partitions or worker_partitions(spark), record, wave_seconds)
    else:
        folder = journal or scratch_path(spark, "journal")
        total = todo.count()
        if total:
            run_journalled(todo, fn, arguments, folder, cleanup, partitions)

        def outcomes(place: str) -> DataFrame:
            found = journal_read(spark, place)
            # Only lost tasks and lost runs leave an item with two outcomes.
            if before is not None or (total and found.count() != total):
                found = latest_record(found, ("recorded_at", "position")).join(todo.select("task_name"), "task_name", "left_semi")
            return found

        if record is not None:
            record(outcomes(folder), 0)
        fresh = outcomes(close() if close is not None else folder).select(*RESULT_SCHEMA.names)
    nothing = F.lit(None).cast("string")
    cached = flagged.filter("_done").select(
        "task_name",
        F.lit(True).alias("did_succeed"),
        F.col("_code").alias("return_code"),
        nothing.alias("stdout"),
        nothing.alias("stderr"),
        F.lit(True).alias("cached"),
    )
    return fresh.withColumn("cached", F.lit(False)).unionByName(cached)


def run_once(
    spark, name: str, ledger: DataFrame, fn: TaskFunction, cleanup: Cleanup | None = None, **arguments: object
) -> DataFrame:
    """:func:`apply_batch` for one dataset-level item with constant arguments."""
    item = spark.range(1).select(
        F.lit(name).alias("task_name"), *[F.lit(v).alias(k) for k, v in arguments.items()]
    )
    return apply_batch(item, ledger, fn, list(arguments), cleanup, partitions=1)

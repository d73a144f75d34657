"""Ledger and stage operators: skip finished work, keep survivors, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortmill.operators.ordered import running_count

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("task_name", T.StringType()),
        T.StructField("did_succeed", T.BooleanType()),
        T.StructField("return_code", T.IntegerType()),
    ]
)


def latest_record(ledger: DataFrame, order: Sequence[str] = ("seq",), key: str = "task_name") -> DataFrame:
    """The newest record of each task; ``order`` must be a total order per task.

    An aggregate rather than a window: each task's records fold map-side into one,
    so a task with very many records ships one row per input partition.
    """
    rest = [c for c in ledger.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order) if len(order) > 1 else F.col(order[0]))
    return ledger.groupBy(key).agg(newest.alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def succeeded(ledger: DataFrame) -> DataFrame:
    """Names of the tasks whose (only or newest) record is a success."""
    return ledger.filter("did_succeed").select("task_name").distinct()


def skip_done(items: DataFrame, ledger: DataFrame) -> DataFrame:
    """Items still to run: those not yet successful; failed and unseen ones stay."""
    return items.join(succeeded(ledger), "task_name", "left_anti")


def survivors(items: DataFrame, results: DataFrame) -> DataFrame:
    """Items whose task succeeded, for the next stage."""
    return items.join(succeeded(results), "task_name", "left_semi")


def attach_items(results: DataFrame, items: DataFrame) -> DataFrame:
    """Each completion with the item it belongs to."""
    return results.join(items, "task_name")


def failed_items(items: DataFrame, results: DataFrame) -> DataFrame:
    """Task names among the items that are not successful."""
    return items.select("task_name").distinct().join(succeeded(results), "task_name", "left_anti")


def already_done(items: DataFrame, ledger: DataFrame) -> DataFrame:
    """Task names that are both an item and a recorded success."""
    return items.select("task_name").intersect(ledger.filter("did_succeed").select("task_name"))


def merge_records(ledger: DataFrame, results: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """The ledger after recording ``results``: one row per task, the newest one."""
    return latest_record(ledger.unionByName(results), order)


def duplicate_keys(ledger: DataFrame, key: str = "task_name") -> DataFrame:
    """Tasks with more than one record, and how many."""
    return ledger.groupBy(key).agg(F.count(F.lit(1)).alias("records")).filter("records > 1")


def batch_summary(results: DataFrame, by: Sequence[str] = ("batch",)) -> DataFrame:
    """Successful and failed item counts per batch."""
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if("did_succeed").alias("successful"),
        F.count_if(~F.col("did_succeed")).alias("failed"),
    )


def batch_lists(results: DataFrame, by: Sequence[str] = ("batch",)) -> DataFrame:
    """The successful and failed items of each batch as sorted rows.

    One row per item, not one array per batch: a batch may be most of the table.
    """
    outcome = F.when(F.col("did_succeed"), "successful").otherwise("failed")
    return results.select(*by, outcome.alias("outcome"), "task_name").orderBy(*by, "outcome", "task_name")


def stage_gate(results: DataFrame, by: Sequence[str] = (), single: bool = False) -> DataFrame:
    """Whether the next stage may start.

    A single task goes on only if it succeeded; a batch goes on while anything
    succeeded. No results means stop; without ``by`` that is one row saying so.
    """
    flag = F.bool_and("did_succeed") if single else F.bool_or("did_succeed")
    return results.groupBy(*by).agg(F.coalesce(flag, F.lit(False)).alias("go_on"))


def run_records(records: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per ``by``: done before the run (``skipped``), newest outcome, and the first record of the run (``first``).

    ``records`` have ``did_succeed``, a totally ordered struct ``at`` and ``before``, whether they were made
    before the run. All of it is one aggregate that folds in the tasks.
    """
    earlier = F.when(F.col("before"), F.col("at"))
    return records.groupBy(*by).agg(
        F.coalesce(F.max_by("did_succeed", earlier), F.lit(False)).alias("skipped"),
        F.max_by("did_succeed", "at").alias("did_succeed"),
        F.min(F.when(~F.col("before"), F.col("at"))).alias("first"),
    )


def stage_records(records: DataFrame, by: Sequence[str] = ("item", "stage")) -> DataFrame:
    """The rows :func:`stage_funnel` reads: per item and stage ``skipped`` and ``did_succeed``."""
    return run_records(records, by).drop("first")


def batch_totals(tasks: DataFrame, by: Sequence[str] = ("batch",)) -> DataFrame:
    """The rows :func:`progress` reads: per batch ``initial`` and ``total``, from :func:`run_records` by task."""
    return tasks.groupBy(*by).agg(F.count_if("skipped").alias("initial"), F.count(F.lit(1)).alias("total"))


def progress(
    completions: DataFrame,
    batches: DataFrame,
    by: Sequence[str] = ("batch",),
    order: Sequence[str] = ("seq",),
) -> DataFrame:
    """Each completion with how many items of its batch are done by then.

    ``batches`` holds per batch ``initial`` (items done before the run) and ``total``.
    """
    counted = running_count(completions, by, order, "position")
    return (
        counted.join(batches.select(*by, "initial", "total"), list(by))
        .withColumn("done", F.col("initial") + F.col("position"))
        .drop("initial", "position")
    )


def stage_funnel(records: DataFrame, item: str, stages: Sequence[str]) -> DataFrame:
    """Items in, skipped, successful, failed and pending per chained stage.

    ``records`` has at most one row per (item, stage) with ``skipped`` and
    ``did_succeed``. An item enters a stage when it was skipped or successful in
    the one before. All stages of an item fold into one row, so the chain costs
    one shuffle instead of joins per stage.
    """
    here = [F.col("stage") == s for s in stages]
    flags: list[Column] = []
    for i, h in enumerate(here):
        flags.append(F.coalesce(F.bool_or(h & F.col("skipped")), F.lit(False)).alias(f"skip{i}"))
        flags.append(F.bool_or(F.when(h & ~F.col("skipped"), F.col("did_succeed"))).alias(f"ran{i}"))
    wide = records.groupBy(item).agg(*flags)
    rows = []
    reached: Column = F.lit(True)
    for i, stage in enumerate(stages):
        skip, ran = F.col(f"skip{i}"), F.col(f"ran{i}")
        ok = F.coalesce(ran, F.lit(False)) & ~skip
        failed = F.coalesce(~ran, F.lit(False)) & ~skip
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(stage).alias("stage"),
                reached.alias("reached"),
                (reached & skip).alias("skipped"),
                (reached & ok).alias("ok"),
                (reached & failed).alias("failed"),
            )
        )
        reached = reached & (skip | ok)
    return (
        wide.select(F.inline(F.array(*rows)))
        .groupBy("position", "stage")
        .agg(
            F.count_if("reached").alias("items_in"),
            F.count_if("skipped").alias("skipped"),
            F.count_if("ok").alias("successful"),
            F.count_if("failed").alias("failed"),
        )
        .withColumn("pending", F.col("items_in") - F.col("skipped") - F.col("successful") - F.col("failed"))
    )

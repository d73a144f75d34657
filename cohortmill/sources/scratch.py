"""Scratch rows of items in a store of folders; cleaning up rewrites the folders of finished items and no others."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortmill.operators.manifests import keep_scratch, retire_scratch
from cohortmill.sources.journal import file_system

# Folders of a store; items are hashed to them. What the driver sees of a store is at most their numbers.
FOLDERS = 256
# The folder of a row, and whether the row only stands for its folder, so that one without items can be written too.
FOLDER, MARK = "folder", "_mark"
_WAITING, _READY = "_retire", "_ready"


def _shape(scratch: DataFrame, folders: int) -> DataFrame:
    taken = {FOLDER, MARK} & {c.lower() for c in scratch.columns}
    if taken:
        raise ValueError(f"scratch has columns the store needs itself: {sorted(taken)}")
    folder = F.pmod(F.xxhash64("task_name"), F.lit(folders)).cast("int")
    return scratch.withColumn(MARK, F.lit(False)).withColumn(FOLDER, folder)


def scratch_write(scratch: DataFrame, path: str, mode: str = "errorifexists", folders: int = FOLDERS) -> None:
    """Put scratch rows ``task_name, …`` in a store; with mode ``append`` they join those there, with the same ``folders``.

    One process changes a store at a time.
    """
    if mode == "append":
        scratch_recover(scratch.sparkSession, path)
    # Folders of many rows are cut into several files, small ones are one.
    _shape(scratch, folders).hint("rebalance", FOLDER).write.mode(mode).partitionBy(FOLDER).parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(f"NOT {MARK}")


def scratch_read(spark: SparkSession, path: str) -> DataFrame:
    """All scratch rows of a store."""
    scratch_recover(spark, path)
    return _stored(spark, path).drop(FOLDER, MARK)


def scratch_retire(spark: SparkSession, path: str, results: DataFrame) -> int:
    """Drop the scratch of successful items from the store; how many folders were written for it.

    Only folders that hold such items are read in full and replaced, by a dynamic partition overwrite; files of all others
    stay as they are. What stays of the folders is written aside first, so a clean-up that is lost on the way ends
    when the store is next used (:func:`scratch_recover`) and no row of an unfinished item is lost. Failed items, rows without a
    task name and tasks without a result stay.
    """
    scratch_recover(spark, path)
    stored = _stored(spark, path)
    touched = sorted(r[FOLDER] for r in retire_scratch(stored, results).select(FOLDER).distinct().collect())
    if not touched:
        return 0
    kept = keep_scratch(stored.filter(F.col(FOLDER).isin(touched)), results)
    marks = spark.createDataFrame([(n, True) for n in touched], f"{FOLDER} int, {MARK} boolean")
    kept.unionByName(marks, allowMissingColumns=True).write.mode("overwrite").parquet(f"{path}/{_WAITING}")
    system, root = file_system(path)
    with system.open_output_stream(f"{root}/{_WAITING}/{_READY}"):
        pass
    scratch_recover(spark, path)
    return len(touched)


def scratch_recover(spark: SparkSession, path: str) -> bool:
    """Put in place what a clean-up has written aside in full; whether there was any. Doing it again changes nothing."""
    system, root = file_system(path)
    aside = f"{root}/{_WAITING}"
    if system.get_file_info(f"{aside}/{_READY}").type == fs.FileType.NotFound:
        return False
    replace_folders(spark.read.parquet(f"{path}/{_WAITING}"), path)
    # The mark goes first: without it the rest is no clean-up any more.
    system.delete_file(f"{aside}/{_READY}")
    system.delete_dir(aside)
    return True


def replace_folders(rows: DataFrame, path: str) -> None:
    """Replace the folders these rows lie in; folders without rows here are left alone."""
    writer = rows.hint("rebalance", FOLDER).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(FOLDER).parquet(path)

"""Outcomes written by the tasks themselves, each within about a second of its item's end.

A Spark job's output appears when the job ends; an item may take hours. So every task keeps a journal: small
Parquet files below ``<journal>/part=<partition>``, written by a thread of the worker whenever outcomes
wait. A file appears under its name only when it is complete, and its name holds the task's
attempt, so attempts never meet. A later attempt of the same partition reads what the earlier ones wrote and goes
on behind it; a later run finds the outcomes where the last one left them.
"""

from __future__ import annotations

import threading
import time
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

# An outcome waits at most about so long before it is written.
FLUSH_SECONDS = 1.0
# Characters of captured output a task holds before it writes them out.
FLUSH_CHARACTERS = 4_000_000
FLUSH_ROWS = 10_000

JOURNAL_SCHEMA = T.StructType(
    [
        T.StructField("task_name", T.StringType()),
        T.StructField("did_succeed", T.BooleanType()),
        T.StructField("return_code", T.IntegerType()),
        T.StructField("stdout", T.StringType()),
        T.StructField("stderr", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
        T.StructField("position", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)
_ARROW = pa.schema(
    [
        ("task_name", pa.string()),
        ("did_succeed", pa.bool_()),
        ("return_code", pa.int32()),
        ("stdout", pa.string()),
        ("stderr", pa.string()),
        ("recorded_at", pa.timestamp("us", tz="UTC")),
        ("position", pa.int64()),
        ("seq", pa.int64()),
    ]
)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URL, and the path inside it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


class Journal:
    """One attempt's journal; use it as a context, ``add`` outcomes, and ask ``known`` for what is there already."""

    def __init__(self, folder: str, part: int, attempt: int, run: int = 0):
        self.system, root = file_system(folder)
        self.folder = f"{root.rstrip('/')}/part={part}"
        self.attempt, self.run = attempt, run
        self.waiting: list[dict] = []
        self.characters = self.files = self.rows = 0
        self.lock, self.ended = threading.Lock(), threading.Event()
        self.failure: BaseException | None = None

    def known(self) -> set[str]:
        """Names of the items that earlier attempts of this partition have outcomes of."""
        found = self.system.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        names: set[str] = set()
        for info in found:
            if info.base_name.endswith(".parquet"):
                names.update(pq.read_table(info.path, columns=["task_name"], filesystem=self.system).column(0).to_pylist())
        return names

    def add(self, outcome: dict) -> None:
        with self.lock:
            if self.failure is not None:
                raise self.failure
            self.rows += 1
            self.waiting.append({**outcome, "recorded_at": time.time_ns() // 1000, "position": self.rows, "seq": self.run})
            self.characters += len(outcome.get("stdout") or "") + len(outcome.get("stderr") or "")
            if self.characters >= FLUSH_CHARACTERS or len(self.waiting) >= FLUSH_ROWS:
                self._write()

    def _write(self) -> None:
        if not self.waiting:
            return
        rows, self.waiting, self.characters = self.waiting, [], 0
        self.system.create_dir(self.folder, recursive=True)
        name = f"{self.attempt}-{self.files}-{uuid.uuid4().hex}.parquet"
        self.files += 1
        # Names with a leading dot are invisible to readers of the folder.
        columns = [pa.array([r[f.name] for r in rows], f.type) for f in _ARROW]
        pq.write_table(pa.Table.from_arrays(columns, schema=_ARROW), f"{self.folder}/.{name}", filesystem=self.system)
        self.system.move(f"{self.folder}/.{name}", f"{self.folder}/{name}")

    def _keep_writing(self) -> None:
        while not self.ended.wait(FLUSH_SECONDS):
            with self.lock:
                try:
                    self._write()
                except BaseException as error:  # noqa: BLE001 - the task raises it with its next outcome
                    self.failure = error
                    return

    def __enter__(self) -> Journal:
        self.thread = threading.Thread(target=self._keep_writing, daemon=True)
        self.thread.start()
        return self

    def __exit__(self, *_: object) -> None:
        self.ended.set()
        self.thread.join()
        if self.failure is not None:
            raise self.failure
        with self.lock:
            self._write()


def journal_read(spark: SparkSession, folder: str) -> DataFrame:
    """Every outcome below a journal's folder, or below a folder of journals; a missing one is empty."""
    try:
        return spark.read.schema(JOURNAL_SCHEMA).option("recursiveFileLookup", "true").parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], JOURNAL_SCHEMA)

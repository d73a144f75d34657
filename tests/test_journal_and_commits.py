"""Outcomes written while a batch runs, lost batches, and stores with several writers."""

import os
import sys
import threading
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from cohortmill.operators import batches
from cohortmill.operators.batches import TaskResult
from cohortmill.sources import commits, journal
from cohortmill.sources import ledger_store as store
from cohortmill.streaming import completions

cloudpickle.register_pickle_by_value(sys.modules[__name__])

L = "task_name string, did_succeed boolean, return_code int"


def wait_for(condition, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        if condition():
            return True
        time.sleep(0.1)
    return False


def slow_for_some(number, folder):
    """Marks its call; if the number is a multiple of ten, waits for a file, or dies with its worker."""
    with open(os.path.join(folder, f"call-{number}"), "a") as f:
        f.write("x")
    while number % 10 == 0 and not os.path.exists(os.path.join(folder, "go")):
        if os.path.exists(os.path.join(folder, "die")):
            os._exit(1)
        time.sleep(0.05)
    return TaskResult(number % 7 != 0, number % 7, f"out {number}")


def items_of(spark, n, folder):
    df = spark.range(n).select(F.concat(F.lit("t"), "id").alias("task_name"), F.col("id").alias("number"))
    return df.withColumn("folder", F.lit(str(folder)))


def calls(folder):
    return {int(f[5:]): len((folder / f).read_text()) for f in os.listdir(folder) if f.startswith("call-")}


def test_a_killed_batch_runs_only_unfinished_items_again(spark, tmp_path):
    path, folder = str(tmp_path / "ledger"), tmp_path / "calls"
    folder.mkdir()
    items, failures = items_of(spark, 40, folder), []

    def run():
        spark.sparkContext.setJobGroup("batch", "batch", interruptOnCancel=True)
        try:
            batches.apply_batch(items, store.ledger_current(spark, path), slow_for_some, ["number", "folder"], partitions=4, journal=f"{path}/journal/one")
        except Exception as error:  # noqa: BLE001
            failures.append(error)

    batch = threading.Thread(target=run)
    batch.start()
    # Slow items hold all tasks but outcomes of the others are there to read: no barrier, nothing waits for the job.
    assert wait_for(lambda: store.ledger_current(spark, path).count() > 0)
    spark.sparkContext.cancelAllJobs()
    batch.join(60)
    assert failures and not batch.is_alive()
    (folder / "die").write_text("die")
    time.sleep(2 * journal.FLUSH_SECONDS)
    (folder / "die").unlink()
    finished = {r.task_name: r.did_succeed for r in store.ledger_current(spark, path).collect()}
    before = calls(folder)
    assert 0 < len(finished) < 40 and any(finished.values())
    (folder / "go").write_text("go")
    results = batches.apply_batch(items, store.ledger_current(spark, path), slow_for_some, ["number", "folder"], partitions=4, journal=f"{path}/journal/one")
    got = {r.task_name: r for r in results.collect()}
    assert {int(k[1:]): v.did_succeed for k, v in got.items()} == {i: i % 7 != 0 for i in range(40)}
    done = {int(k[1:]) for k, ok in finished.items() if ok}
    assert {int(k[1:]) for k, v in got.items() if v.cached} == done
    assert calls(folder) == {i: before.get(i, 0) + (i not in done) for i in range(40)}
    assert {r.task_name: r.did_succeed for r in store.ledger_current(spark, path).collect()} == {k: v.did_succeed for k, v in got.items()}


def test_a_later_attempt_goes_on_behind_the_earlier_ones(tmp_path):
    folder = str(tmp_path / "journal")
    with pytest.raises(RuntimeError), journal.Journal(folder, 3, 10) as own:
        own.add({"task_name": "a", "did_succeed": True, "return_code": 0, "stdout": None, "stderr": None})
        own._write()
        own.add({"task_name": "b", "did_succeed": False, "return_code": 1, "stdout": "o", "stderr": "e"})
        raise RuntimeError("lost")
    assert journal.Journal(folder, 3, 11).known() == {"a", "b"} and journal.Journal(folder, 4, 12).known() == set()


def test_journal_of_a_retried_task_counts_each_item_once(spark, tmp_path):
    folder, marks = tmp_path / "journal", tmp_path / "marks"
    marks.mkdir()
    for attempt in (1, 2):
        with journal.Journal(str(folder), 0, attempt) as own:
            own.add({"task_name": "t1", "did_succeed": attempt == 2, "return_code": attempt, "stdout": None, "stderr": None})
    results = batches.apply_batch(items_of(spark, 3, marks), spark.createDataFrame([], L), slow_for_some_fast, ["number", "folder"], journal=str(folder))
    got = {r.task_name: (r.did_succeed, r.cached) for r in results.collect()}
    assert got == {"t0": (True, False), "t1": (True, True), "t2": (True, False)} and set(calls(marks)) == {0, 2}


def slow_for_some_fast(number, folder):
    with open(os.path.join(folder, f"call-{number}"), "a") as f:
        f.write("x")
    return TaskResult(True)


def test_commits_of_racing_writers_all_count(tmp_path):
    path = str(tmp_path / "store")

    def write(name):
        for k in range(25):
            commits.commit(path, lambda entries, k=k: {**entries, f"{name}-{k}": "x"})

    writers = [threading.Thread(target=write, args=(n,)) for n in "abcd"]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    version, entries = commits.latest(path)
    assert version == 100 and set(entries) == {f"{n}-{k}" for n in "abcd" for k in range(25)}
    assert not os.listdir(tmp_path / "store" / "pending")


def test_compaction_races_with_writers_and_readers(spark, tmp_path):
    path, stop, seen, wrong = str(tmp_path / "store"), threading.Event(), [], []
    record = lambda k, ok=True: store.ledger_record(spark.createDataFrame([(f"t{k}", ok, 0)], L), path, k)
    for k in range(4):
        record(k)

    def read():
        while not stop.is_set():
            names = {r.task_name for r in store.ledger_records(spark, path).select("task_name").collect()}
            seen.append(len(names))
            if not names >= {f"t{k}" for k in range(4)}:
                wrong.append(names)

    def compact():
        while not stop.is_set():
            store.ledger_compact(spark, path)

    helpers = [threading.Thread(target=read), threading.Thread(target=compact)]
    for h in helpers:
        h.start()
    for k in range(4, 12):
        record(k)
    record(11, ok=False)
    stop.set()
    for h in helpers:
        h.join()
    store.ledger_compact(spark, path)
    assert not wrong and seen
    current = {r.task_name: r.did_succeed for r in store.ledger_current(spark, path).collect()}
    assert current == {f"t{k}": k != 11 for k in range(12)}
    assert list(commits.latest(path)[1]) == ["compact"]
    dead = len(os.listdir(tmp_path / "store" / "data")) - 1
    assert commits.vacuum(path, 3600) == 0 and dead > 0
    for name in sorted(os.listdir(tmp_path / "store" / "versions"))[:-1]:
        os.unlink(tmp_path / "store" / "versions" / name)
    assert commits.vacuum(path, 0) == dead
    assert store.ledger_current(spark, path).count() == 12


def test_a_replaced_run_is_not_lost_in_a_compaction(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    for k in range(2):
        store.ledger_record(spark.createDataFrame([("a", False, k)], L), path, k)
    plain, done = store._read, []

    def read(spark, path, entries):
        out = plain(spark, path, entries)
        if not done:
            done.append(1)
            store.ledger_record(spark.createDataFrame([("a", True, 7)], L), path, 1)
        return out

    monkeypatch.setattr(store, "_read", read)
    store.ledger_compact(spark, path)
    assert [tuple(r) for r in store.ledger_current(spark, path).select("task_name", "return_code").collect()] == [("a", 7)]


def test_a_stream_compacts_its_store(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(completions, "COMPACT_AFTER", 3)
    src, path = tmp_path / "src", str(tmp_path / "store")
    for k in range(8):
        spark.createDataFrame([(f"t{k % 5}", k % 2 == 0, k)], L).coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(L).option("maxFilesPerTrigger", 1).parquet(str(src))
    completions.completion_sink(stream, path, str(tmp_path / "cp"), once=True).awaitTermination()
    assert len(commits.latest(path)[1]) <= 3
    assert {r.task_name for r in store.ledger_current(spark, path).collect()} == {f"t{k}" for k in range(5)}

import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from cohortmill.operators import batches
from cohortmill.operators.batches import TaskResult
from cohortmill.plans import staged
from cohortmill.plans.staged import Stage
from cohortmill.sources import ledger_store as store

# Test modules are not installed on the workers, so their functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

L = "task_name string, did_succeed boolean, return_code int"


def items_of(spark, n, folder):
    df = spark.createDataFrame([(f"{i:02d}", i) for i in range(n)], "subject string, number int")
    return batches.name_items(df.withColumn("folder", F.lit(str(folder))), "t", ["subject"])


def mark(number, folder):
    """Leaves one file per call, so tests can count the calls."""
    with open(os.path.join(folder, str(number)), "a") as f:
        f.write("x")
    if number == 3:
        raise ValueError("three")
    return TaskResult(number % 2 == 0, number % 2, f"out {number}")


def sweep(did_succeed, number, folder):
    with open(os.path.join(folder, f"clean-{number}-{did_succeed}"), "a") as f:
        f.write("x")
    raise RuntimeError("ignored")


def test_batch_outcomes_cleanup_and_single_execution(spark, tmp_path, rows):
    ledger = spark.createDataFrame([("t_00", True, 0), ("t_01", False, 9)], L)
    items = items_of(spark, 6, tmp_path)
    twice = items.unionByName(items.filter("number < 3"))
    results = batches.apply_batch(twice, ledger, mark, ["number", "folder"], sweep)
    got = {r.task_name: r for r in results.collect()}
    assert {k: (v.did_succeed, v.return_code, v.cached) for k, v in got.items()} == {
        "t_00": (True, 0, True),
        "t_01": (False, 1, False),
        "t_02": (True, 0, False),
        "t_03": (False, -1, False),
        "t_04": (True, 0, False),
        "t_05": (False, 1, False),
    }
    assert got["t_02"].stdout == "out 2" and "ValueError: three" in got["t_03"].stderr
    results.count()
    calls = {f: (tmp_path / f).read_text() for f in os.listdir(tmp_path)}
    assert calls == {
        **{str(i): "x" for i in range(1, 6)},
        "clean-1-False": "x", "clean-2-True": "x", "clean-4-True": "x", "clean-5-False": "x",
    }


def test_second_run_only_repeats_failures(spark, tmp_path):
    path, folder = str(tmp_path / "ledger"), tmp_path / "calls"
    folder.mkdir()
    items = items_of(spark, 6, folder)
    for _ in range(2):
        results = batches.apply_batch(items, store.ledger_current(spark, path), mark, ["number", "folder"])
        staged.record_run(spark, results, path)
    calls = {f: len((folder / f).read_text()) for f in os.listdir(folder)}
    assert calls == {"0": 1, "1": 2, "2": 1, "3": 2, "4": 1, "5": 2}
    ok = {r[0] for r in results.filter("did_succeed").select("task_name").collect()}
    failed = {r[0] for r in results.filter("NOT did_succeed").select("task_name").collect()}
    assert ok | failed == {f"t_{i:02d}" for i in range(6)} and not ok & failed


def test_a_lost_run_goes_on_after_its_last_wave(spark, tmp_path):
    path, folder = str(tmp_path / "ledger"), tmp_path / "calls"
    folder.mkdir()
    items = items_of(spark, 40, folder)
    seen = []

    def record(results, wave):
        store.ledger_record(results, path, 0, f"w{wave}")
        seen.append(results.count())
        if wave == 1:
            raise KeyboardInterrupt("the driver dies")

    with pytest.raises(KeyboardInterrupt):
        batches.apply_batch(items, store.ledger_current(spark, path), mark, ["number", "folder"], partitions=2, record=record, wave_seconds=0.0)
    assert len(os.listdir(folder)) == sum(seen) < 40
    known = {r.task_name for r in store.ledger_current(spark, path).filter("did_succeed").collect()}
    before = set(os.listdir(folder))
    again = batches.apply_batch(items, store.ledger_current(spark, path), mark, ["number", "folder"])
    assert again.count() == 40 and again.filter("cached").count() == len(known)
    calls = {int(f): len((folder / f).read_text()) for f in os.listdir(folder)}
    assert calls == {i: 1 if f"t_{i:02d}" in known or str(i) not in before else 2 for i in range(40)}


def test_exits_and_missing_codes(spark, rows):
    def stop(number):
        if number == 1:
            sys.exit(3)
        return TaskResult(True, None)

    items = spark.createDataFrame([("a", 0), ("b", 1)], "task_name string, number int")
    ledger = spark.createDataFrame([], L)
    results = batches.apply_batch(items, ledger, stop, ["number"])
    assert rows(results.select("task_name", "did_succeed", "return_code")) == [("a", True, None), ("b", False, -1)]
    again = batches.apply_batch(items, results.select("task_name", "did_succeed", "return_code"), stop, ["number"])
    assert rows(again.select("task_name", "cached")) == [("a", True), ("b", False)]


def test_items_are_dealt_evenly(spark):
    items = spark.createDataFrame([(f"item-{i}", i) for i in range(8)], "task_name string, row_number long").repartition(3)
    where = lambda row_number: TaskResult(True, __import__("pyspark").TaskContext.get().partitionId())
    got = batches.run_items(items, where, ["row_number"], partitions=8).collect()
    assert sorted(r.return_code for r in got) == list(range(8))


def test_struct_items_become_named_arguments(spark, rows):
    def join(subject, session, extra):
        return TaskResult(True, 0, f"{subject}/{session}/{extra}")

    df = spark.createDataFrame([("01", "02", None)], "subject string, session string, extra int")
    df = df.select(F.struct("subject", "session").alias("item"), "extra", F.lit("n").alias("task_name"))
    assert rows(batches.run_items(df, join, ["item", "extra"]).select("stdout")) == [("01/02/None",)]
    with pytest.raises(ValueError, match="share a name"):
        batches.run_items(df.withColumn("subject", F.lit("x")), join, ["item", "subject"])


def test_large_outputs_are_passed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(batches, "FLUSH_ROWS", 2)
    df = spark.range(7).select(F.col("id").cast("string").alias("task_name"), "id")
    assert batches.run_items(df, lambda id: TaskResult(True, 0, "x" * 10), ["id"], partitions=1).count() == 7


def test_run_once(spark, rows):
    empty = spark.createDataFrame([], L)
    result = batches.run_once(spark, "validate", empty, lambda folder: TaskResult(folder == "x", 0), folder="x")
    assert rows(result.select("task_name", "did_succeed", "cached")) == [("validate", True, False)]
    again = batches.run_once(spark, "validate", result.select("task_name", "did_succeed", "return_code"), None)
    assert rows(again.select("did_succeed", "cached")) == [(True, True)]
    bare = batches.run_once(spark, "bare", empty, lambda: TaskResult(False, 2))
    assert rows(bare.select("did_succeed", "return_code")) == [(False, 2)]


def study_catalog(spark):
    data = [
        ("01", "1", "T1w"), ("01", "2", "T1w"), ("01", "3", "T1w"), ("01", "1", "bold"), ("01", "4", "bold"),
        ("02", "1", "T1w"), ("02", "1", "bold"), ("03", "1", "bold"), ("04", None, "T1w"),
    ]
    return spark.createDataFrame(data, "subject string, session string, suffix string")


def test_session_run_narrows_to_survivors(spark, tmp_path, rows):
    def anatomical(subject, sessions):
        return TaskResult(subject != "02", 0, ",".join(sessions or []))

    def functional(subject, session, reference_session, filter_json):
        return TaskResult(session != "4", 7 if session == "4" else 0, f"{reference_session} {session in filter_json}")

    stages = {
        "anatomical": Stage(anatomical, arguments=["subject", "sessions"]),
        "session_functional": Stage(functional, arguments=["subject", "session", "reference_session", "filter_json"]),
    }
    path = str(tmp_path / "ledger")
    run = staged.run_study(spark, study_catalog(spark), path, "session", stages)
    assert rows(run.results["anatomical"].select("task_name", "did_succeed", "stdout")) == [
        ("anatomical_01", True, "1,2"), ("anatomical_02", False, "1"), ("anatomical_04", True, ""),
    ]
    assert rows(run.results["session_functional"].select("task_name", "did_succeed", "stdout")) == [
        ("session_functional_('01', '1')", True, "1 True"), ("session_functional_('01', '4')", False, "1 True"),
    ]
    assert rows(run.passed.select("subject", "session")) == [("01", "1")]
    again = staged.run_study(spark, study_catalog(spark), path, "session", stages)
    assert rows(again.results["session_functional"].filter("cached").select("task_name")) == [
        ("session_functional_('01', '1')",)
    ]


def test_filters_are_written_for_the_sessions_that_got_through(spark, tmp_path, rows):
    stages = {
        "anatomical": Stage(lambda subject: TaskResult(subject == "01", 0)),
        "session_functional": Stage(lambda filter_json: TaskResult("session" in filter_json, 0), arguments=["filter_json"]),
    }
    out = str(tmp_path / "filters")
    run = staged.run_study(spark, study_catalog(spark), str(tmp_path / "l"), "session", stages, filters_path=out)
    written = spark.read.text(out)
    assert written.count() == 2 and run.passed.count() == 2
    assert {(int(r.subject), int(r.session)) for r in written.collect()} == {(1, 1), (1, 4)}


def test_a_broken_manifest_stops_the_run_first(spark, tmp_path):
    manifest = spark.createDataFrame([("a", "input_dir", None, "dir")], "path string, role string, kind string, parent_kind string")
    with pytest.raises(staged.StudyStopped) as stopped:
        staged.run_study(spark, study_catalog(spark), str(tmp_path / "l"), "session", {}, manifest=manifest)
    assert stopped.value.code == 1


def test_run_stops_with_the_stage_code(spark, tmp_path):
    stages = {"subject_quality": Stage(lambda subject: TaskResult(False, 1))}
    with pytest.raises(staged.StudyStopped) as stopped:
        staged.run_study(spark, study_catalog(spark), str(tmp_path / "l"), "subject", stages)
    assert stopped.value.code == 2
    with pytest.raises(staged.StudyStopped) as stopped:
        staged.run_study(spark, study_catalog(spark).limit(0), str(tmp_path / "m"), "subject", stages)
    assert stopped.value.code == -2


def test_dataset_run_has_a_single_group_stage(spark, tmp_path, rows):
    good = {
        "subject_quality": Stage(lambda subject: TaskResult(subject == "01", 0)),
        "group_quality": Stage(lambda: TaskResult(True, 0)),
    }
    run = staged.run_study(spark, study_catalog(spark), str(tmp_path / "l"), "dataset", good)
    assert rows(run.passed.select("subject")) == [("01",)]
    assert rows(run.results["group_quality"].select("task_name")) == [("group_quality",)]
    bad = {**good, "group_quality": Stage(lambda: TaskResult(False, 1))}
    with pytest.raises(staged.StudyStopped) as stopped:
        staged.run_study(spark, study_catalog(spark), str(tmp_path / "m"), "dataset", bad)
    assert stopped.value.code == 3

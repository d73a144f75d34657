"""Clean-up of a scratch store: what goes, what is written again, and clean-ups lost on the way."""

import os

import pytest
from pyspark.sql import functions as F

from cohortmill.sources import scratch

RESULTS = "task_name string, did_succeed boolean, return_code int"


def items(spark, names):
    return spark.createDataFrame([(n, f"{n}/{k}", k) for n in names for k in range(3)], "task_name string, path string, size int")


def files(path):
    found = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    return {f: os.stat(f).st_mtime_ns for f in found}


def done(spark, names, succeeded=True):
    return spark.createDataFrame([(n, succeeded, 0) for n in names], RESULTS)


def test_only_folders_of_finished_items_are_written(spark, tmp_path, rows):
    path = str(tmp_path / "store")
    names = [f"t{k}" for k in range(40)]
    scratch.scratch_write(items(spark, names), path, folders=8)
    where = {r.task_name: r.folder for r in spark.read.parquet(path).select("task_name", "folder").distinct().collect()}
    gone = [n for n in names if where[n] == where["t0"]] + ["t1", "t1", "unknown"]
    touched = {where[n] for n in gone if n in where}
    before = files(path)
    assert scratch.scratch_retire(spark, path, done(spark, gone)) == len(touched) < 8
    assert rows(scratch.scratch_read(spark, path)) == rows(items(spark, [n for n in names if n not in gone]))
    after = files(path)
    others = {f: t for f, t in before.items() if int(f.split("folder=")[1].split("/")[0]) not in touched}
    assert others and {f: t for f, t in after.items() if f in others} == others
    assert not set(before) - set(others) & set(after)
    assert spark.read.parquet(path).filter(F.col("folder") == where["t0"]).select("_mark").collect() == [(True,)]
    assert not os.path.exists(f"{path}/_retire")


def test_nothing_done_writes_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "store")
    data = items(spark, ["a", "b"]).unionByName(items(spark, ["c"]).withColumn("task_name", F.lit(None).cast("string")))
    scratch.scratch_write(data, path)
    before = files(path)
    for results in (done(spark, ["a"], False), done(spark, []), done(spark, [None]), done(spark, ["z"])):
        assert scratch.scratch_retire(spark, path, results) == 0
    assert files(path) == before and rows(scratch.scratch_read(spark, path)) == rows(data)
    scratch.scratch_retire(spark, path, done(spark, ["a", "b"]))
    assert [r.task_name for r in scratch.scratch_read(spark, path).collect()] == [None] * 3


@pytest.mark.parametrize("at", ["writing aside", "putting in place", "after that"])
def test_a_lost_clean_up_loses_no_row(spark, tmp_path, rows, monkeypatch, at):
    path = str(tmp_path / "store")
    scratch.scratch_write(items(spark, ["a", "b", "c"]), path, folders=1)
    place = scratch.replace_folders

    def lost(kept, where):
        if at == "after that":
            place(kept, where)
        elif at == "putting in place":
            for f in files(f"{where}/folder=0"):
                os.remove(f)
        raise RuntimeError("lost")

    if at == "writing aside":
        monkeypatch.setattr(scratch, "file_system", None)
        with pytest.raises(TypeError):
            scratch.scratch_retire(spark, path, done(spark, ["a"]))
        items(spark, ["b"]).withColumn("folder", F.lit(0)).withColumn("_mark", F.lit(False)).write.parquet(f"{path}/_retire")
        monkeypatch.undo()
        assert rows(scratch.scratch_read(spark, path)) == rows(items(spark, ["a", "b", "c"]))
        scratch.scratch_retire(spark, path, done(spark, ["a"]))
    else:
        monkeypatch.setattr(scratch, "replace_folders", lost)
        with pytest.raises(RuntimeError):
            scratch.scratch_retire(spark, path, done(spark, ["a"]))
        monkeypatch.undo()
    scratch.scratch_write(items(spark, ["d"]), path, "append", folders=1)
    assert rows(scratch.scratch_read(spark, path)) == rows(items(spark, ["b", "c", "d"]))
    assert not scratch.scratch_recover(spark, path)


def test_columns_of_the_store_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="folder"):
        scratch.scratch_write(items(spark, ["a"]).withColumn("Folder", F.lit(1)), str(tmp_path / "s"))


def test_an_empty_store_is_read(spark, tmp_path):
    path = str(tmp_path / "store")
    scratch.scratch_write(items(spark, ["a"]), path)
    assert scratch.scratch_retire(spark, path, done(spark, ["a"])) == 1
    assert scratch.scratch_read(spark, path).columns == ["task_name", "path", "size"]
    assert scratch.scratch_read(spark, path).count() == 0

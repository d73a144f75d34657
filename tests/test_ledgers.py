import pytest
from pyspark.sql import functions as F

from cohortmill.operators import ledgers, manifests
from cohortmill.sources import ledger_store as store

L = "task_name string, did_succeed boolean, return_code int"


def test_missing_csv_is_an_empty_ledger(spark, tmp_path):
    empty = store.ledger_read(spark, str(tmp_path / "none.csv"))
    assert empty.schema == ledgers.LEDGER_SCHEMA and empty.count() == 0


def test_csv_written_elsewhere_is_read(spark, tmp_path, rows):
    path = tmp_path / "ledger.csv"
    path.write_text("task_name,did_succeed,return_code\n\"f_('01', '02')\",True,0\ng_1,False,3\n")
    assert rows(store.ledger_read(spark, str(path))) == [("f_('01', '02')", True, 0), ("g_1", False, 3)]


def test_malformed_cells_raise_and_quoted_names_survive(spark, tmp_path, rows):
    path = tmp_path / "bad.csv"
    path.write_text("task_name,did_succeed,return_code\na,True,0\nb,maybe,x\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        store.ledger_read(spark, str(path)).collect()
    path = tmp_path / "quoted.csv"
    path.write_text('task_name,did_succeed,return_code\n"(\'func\', ""01"", \'02\')",True,0\n')
    want = [("('func', \"01\", '02')", True, 0)]
    assert rows(store.ledger_read(spark, str(path))) == want
    store.ledger_write_csv(store.ledger_read(spark, str(path)), str(tmp_path / "again"))
    assert rows(store.ledger_read(spark, str(tmp_path / "again"))) == want


def test_time_counts_before_run_numbers(spark, tmp_path, rows):
    path = str(tmp_path / "mixed")
    at = lambda ok, when: spark.createDataFrame([("t", ok, 0 if ok else 1, when)], L + ", recorded_at string").withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))
    store.ledger_record(at(False, "2024-01-01 10:00:00"), path, 50)
    store.ledger_record(at(True, "2024-01-01 11:00:00"), path, 13, "stream")
    assert rows(store.ledger_current(spark, path).select("task_name", "did_succeed")) == [("t", True)]


def test_recording_replaces_the_earlier_record(spark, tmp_path, rows):
    path = str(tmp_path / "store")
    assert store.ledger_current(spark, path).count() == 0
    store.ledger_record(spark.createDataFrame([("a", False, 1), ("b", True, 0)], L), path, 0)
    store.ledger_record(spark.createDataFrame([("a", True, 0)], L), path, 1)
    cut = lambda df: rows(df.select("task_name", "did_succeed", "return_code"))
    want = [("a", True, 0), ("b", True, 0)]
    assert cut(store.ledger_current(spark, path)) == want
    # Recording the same run again changes nothing.
    store.ledger_record(spark.createDataFrame([("a", True, 0)], L), path, 1)
    assert cut(store.ledger_current(spark, path)) == want and store.ledger_records(spark, path).count() == 3
    target = str(tmp_path / "compact")
    store.ledger_compact(spark, path, target)
    assert cut(store.ledger_records(spark, target)) == want
    with pytest.raises(Exception):
        store.ledger_compact(spark, path, target)


def test_writers_with_the_same_number_do_not_meet(spark, tmp_path, rows):
    path = str(tmp_path / "store")
    store.ledger_record(spark.createDataFrame([("a", True, 0)], L), path, 4, "x")
    store.ledger_record(spark.createDataFrame([("b", True, 0)], L), path, 4, "y")
    store.ledger_record(spark.createDataFrame([("c", True, 0)], L), path, 5)
    assert rows(store.ledger_current(spark, path).select("task_name", "seq")) == [("a", 4), ("b", 4), ("c", 5)]


def test_repeats_at_the_same_time_follow_their_position(spark, tmp_path, rows):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([("a", False, 1, 2), ("a", True, 0, 3), ("a", False, 5, 1)], L + ", position long")
    store.ledger_record(df.withColumn("recorded_at", F.timestamp_seconds(F.lit(5))), path, 0)
    assert rows(store.ledger_current(spark, path).select("task_name", "did_succeed")) == [("a", True)]


def test_a_later_failure_hides_an_earlier_success(spark, rows):
    records = spark.createDataFrame(
        [("a", True, 0, 1), ("a", False, 2, 2), ("b", False, 1, 1), ("b", True, 0, 3)], L + ", seq long"
    )
    current = ledgers.latest_record(records)
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "task_name string")
    assert rows(ledgers.skip_done(items, current)) == [("a",), ("c",)]
    assert rows(ledgers.survivors(items, current)) == [("b",)]
    assert rows(ledgers.failed_items(items, current)) == [("a",), ("c",)]
    assert rows(ledgers.already_done(items, current)) == [("b",)]
    assert rows(ledgers.duplicate_keys(records)) == [("a", 2), ("b", 2)]


def test_gates(spark, rows):
    df = spark.createDataFrame([("a", True, 0), ("b", False, 1)], L)
    assert rows(ledgers.stage_gate(df)) == [(True,)]
    assert rows(ledgers.stage_gate(df, single=True)) == [(False,)]
    assert rows(ledgers.stage_gate(df.filter("NOT did_succeed"))) == [(False,)]
    assert rows(ledgers.stage_gate(df.limit(0))) == [(False,)]
    assert rows(ledgers.stage_gate(df.limit(0), single=True)) == [(False,)]


def test_funnel_counts_pending_items(spark, rows):
    data = [("i1", "s0", True, True), ("i1", "s1", False, True), ("i2", "s0", False, False), ("i2", "s1", False, True),
            ("i3", "s0", False, True)]
    df = spark.createDataFrame(data, "item string, stage string, skipped boolean, did_succeed boolean")
    assert rows(ledgers.stage_funnel(df, "item", ["s0", "s1"])) == [(0, "s0", 3, 1, 1, 1, 0), (1, "s1", 2, 0, 1, 0, 1)]


def test_sync_plan_on_nulls_and_times(spark, rows):
    schema = "path string, size long, mtime timestamp"
    t = [F.timestamp_seconds(F.lit(x)) for x in (1, 2)]
    src = spark.createDataFrame([("a", 1), ("b", 1), ("c", None), ("d", 1)], "path string, size long")
    dst = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("x", 1)], "path string, size long")
    src = src.withColumn("mtime", t[0])
    dst = dst.withColumn("mtime", F.when(F.col("path") == "b", t[1]).otherwise(t[0]))
    assert schema and rows(manifests.sync_plan(src, dst).select("path", "reason")) == [
        ("b", "changed"), ("c", "changed"), ("d", "absent"),
    ]


def test_scratch_of_failed_items_stays(spark, rows):
    scratch = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "task_name string, path string")
    results = spark.createDataFrame([("a", True, 0), ("b", False, 1)], L)
    assert rows(manifests.retire_scratch(scratch, results)) == [("a", "x"), ("a", "y")]
    assert rows(manifests.keep_scratch(scratch, results)) == [("b", "z")]

import time

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import health, labels
from cohortmill.operators.ledgers import latest_record
from cohortmill.sources import ledger_store
from cohortmill.sources.catalogs import catalog_scan
from cohortmill.streaming import completions, heartbeats


@pytest.mark.parametrize(
    "locked,tolerance,status",
    [(False, 86400, "clear"), (True, 86400, "blocked"), (True, 0, "stale")],
)
def test_lock_golden_cases_on_files(spark, tmp_path, rows, locked, tolerance, status):
    scripts = tmp_path / "sub-01" / "scripts"
    scripts.mkdir(parents=True)
    (scripts / "recon-all.log").write_text("log")
    for side in ("lh", "rh") if locked else ():
        (scripts / f"IsRunning.{side}").write_text("running")
    locks, logs = health.lock_tables(catalog_scan(spark, str(tmp_path)))
    assert locks.count() == (2 if locked else 0)
    subject = spark.createDataFrame([("sub-01",)], "subject string")
    got = health.lock_status(subject, locks, logs, F.current_timestamp(), tolerance)
    assert rows(got) == [("sub-01", status)]


def test_lock_without_a_log_is_stale_and_the_limit_is_strict(spark, rows):
    subjects = spark.createDataFrame([("a",), ("b",)], "subject string")
    logs = spark.createDataFrame([("b",)], "subject string").withColumn("mtime", F.timestamp_seconds(F.lit(900_000)))
    now = F.timestamp_seconds(F.lit(900_000 + 86_400))
    assert rows(health.lock_status(subjects, subjects, logs, now)) == [("a", "stale"), ("b", "stale")]
    earlier = F.timestamp_seconds(F.lit(900_000 + 86_399))
    assert rows(health.lock_status(subjects, subjects, logs, earlier)) == [("a", "stale"), ("b", "blocked")]


def beats_frame(spark, data):
    df = spark.createDataFrame(data, "worker string, t double")
    return df.select("worker", F.timestamp_micros((F.col("t") * 1_000_000).cast("long")).alias("last_seen"))


def test_stalled_limit_is_strict(spark, rows):
    seen = beats_frame(spark, [("a", 40.0), ("b", 39.999), ("b", 10.0), ("c", 99.0)])
    now = F.timestamp_seconds(F.lit(100))
    assert rows(health.stalled_workers(seen, now).select("worker")) == [("b",)]
    assert health.stalled_workers(seen.limit(0), now).count() == 0


def test_relabel_forms_agree_and_unknown_labels_raise(spark, rows):
    voxels = spark.createDataFrame([(1, 0), (2, 2), (3, 1)], "voxel long, label int")
    lut = [5, 0, 300]
    table = spark.createDataFrame(list(enumerate(lut)), "label int, new_label int")
    want = [(1, 0, 5), (2, 2, 300), (3, 1, 0)]
    for form in (lut, table):
        got = labels.relabel(voxels, form).select("voxel", "label", "new_label")
        assert got.schema["new_label"].dataType.typeName() == "short" and rows(got) == want
    blocks = spark.createDataFrame([([0, 2, 1],)], "labels array<int>")
    assert labels.relabel_blocks(blocks, lut).first().new_labels == [5, 300, 0]
    for bad in (3, -1):
        odd = voxels.withColumn("label", F.when(F.col("voxel") == 2, bad).otherwise(F.col("label")))
        for form in (lut, table):
            with pytest.raises(Exception, match="label outside the lookup table"):
                labels.relabel(odd, form).collect()
    with pytest.raises(ValueError, match="16 bits"):
        labels.relabel(voxels, [40_000])
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        labels.relabel(voxels, table.withColumn("new_label", F.lit(40_000))).collect()


def test_a_label_listed_twice_counts_once_or_raises(spark, rows):
    voxels = spark.createDataFrame([(1, 0), (2, 1)], "voxel long, label int")
    table = spark.createDataFrame([(0, 5), (1, 6), (0, 5)], "label int, new_label int")
    assert rows(labels.relabel(voxels, table).select("voxel", "label", "new_label")) == [(1, 0, 5), (2, 1, 6)]
    with pytest.raises(Exception, match="label listed with two values"):
        labels.relabel(voxels, table.unionByName(spark.createDataFrame([(1, 7)], table.schema))).collect()


def test_lists_of_any_length_are_lookup_tables(spark, rows):
    voxels = spark.createDataFrame([(1, 70_000)], "voxel long, label int")
    assert labels.relabel(voxels, [7] * 70_001).first().new_label == 7


def write_beats(spark, folder, data):
    beats_frame(spark, data).coalesce(1).write.mode("append").parquet(str(folder))


def wait_for(condition, seconds=40):
    end = time.time() + seconds
    while time.time() < end:
        if condition():
            return True
        time.sleep(0.5)
    return False


def test_silent_worker_is_reported_without_new_input(spark, tmp_path, rows):
    src, out = tmp_path / "src", str(tmp_path / "out")
    now = time.time()
    write_beats(spark, src, [("old", now - 1000), ("fresh", now + 3600), ("soon", now + 4)] * 3)
    stream = spark.readStream.schema("worker string, last_seen timestamp").parquet(str(src))
    query = heartbeats.periodic_check(stream, out, str(tmp_path / "cp"), timeout=6, period=1)
    alerts = lambda: rows(heartbeats.current_alerts(spark.read.schema(heartbeats.ALERT_SCHEMA).parquet(out)))
    try:
        # "soon" turns silent on its timer; no file arrives in between.
        assert wait_for(lambda: query.exception() or (query.recentProgress and alerts() == [("old",), ("soon",)]))
        assert query.exception() is None
        # A heartbeat brings a reported worker back.
        write_beats(spark, src, [("old", time.time() + 3600)])
        assert wait_for(lambda: alerts() == [("soon",)])
    finally:
        query.stop()


def result_files(spark, folder):
    data = [("b1", "t1", False, 1, 10), ("b1", "t2", True, 0, 11), ("b2", "t3", True, 0, 12), ("b1", "t1", True, 0, 13)]
    schema = "batch string, task_name string, did_succeed boolean, return_code int, s long"
    for i, row in enumerate(data):
        df = spark.createDataFrame([row], schema).withColumn("recorded_at", F.timestamp_seconds("s")).drop("s")
        df.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.read.parquet(str(folder))


def test_completions_recorded_as_they_arrive_equal_the_batch_ledger(spark, tmp_path, rows):
    src, path = tmp_path / "src", str(tmp_path / "store")
    batch = result_files(spark, src)
    stream = (
        spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    )
    checkpoint = str(tmp_path / "cp")
    completions.completion_sink(stream, path, checkpoint, once=True).awaitTermination()
    current = ledger_store.ledger_current(spark, path).select("task_name", "did_succeed", "return_code")
    want = latest_record(batch.drop("batch"), ["recorded_at"]).select("task_name", "did_succeed", "return_code")
    assert rows(current) == rows(want)
    # Replaying from the start writes the same run folders again.
    before = ledger_store.ledger_records(spark, path).count()
    completions.completion_sink(stream, path, str(tmp_path / "cp2"), once=True).awaitTermination()
    assert ledger_store.ledger_records(spark, path).count() == before == 4
    assert rows(ledger_store.ledger_current(spark, path).select("task_name", "did_succeed", "return_code")) == rows(want)


def test_live_progress_ends_at_the_batch_counts(spark, tmp_path, rows):
    src, out = tmp_path / "src", str(tmp_path / "progress")
    batch = result_files(spark, src)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    completions.live_progress(stream, out, str(tmp_path / "cp"), once=True).awaitTermination()
    totals = spark.createDataFrame([("b1", 3), ("b2", 1), ("b3", 2)], "batch string, total long")
    got = completions.latest_progress(spark.read.parquet(out), totals)
    assert rows(got) == [("b1", 3, 2, 3), ("b2", 1, 1, 1), ("b3", 0, 0, 2)]

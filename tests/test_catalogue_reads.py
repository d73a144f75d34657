"""How often queries and runs read a catalogue, and how many files they leave."""

import glob

from pyspark.sql import functions as F

from cohortmill import registry
from cohortmill.operators.batches import TaskResult
from cohortmill.plans import staged
from cohortmill.plans.staged import Stage
from cohortmill.session import shared_dir


def counted(spark, rows, schema):
    """A frame that counts how often a row of it is made."""
    made = spark.sparkContext.accumulator(0)

    def one(row):
        made.add(1)
        return row

    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(one), schema), made


def test_a_run_makes_the_catalogue_once(spark, tmp_path, rows):
    data = [("1", "1", "T1w"), ("1", "1", "bold"), ("1", "2", "bold"), ("2", "1", "bold"), ("3", None, "T1w")]
    catalog, made = counted(spark, data, "subject string, session string, suffix string")
    stages = {
        "anatomical": Stage(lambda subject: TaskResult(True, 0)),
        "session_functional": Stage(lambda subject, session: TaskResult(session == "1", 0)),
    }
    run = staged.run_study(spark, catalog, str(tmp_path / "ledger"), "session", stages)
    assert rows(run.passed.select("subject", "session", "reference_session")) == [("1", "1", "1")]
    assert made.value == len(data)


def test_packed_queries_make_the_catalogue_once(spark, monkeypatch):
    data = [(f"sub-{s}/{k}.nii", 10, str(s), str(k), x) for s in range(3) for k in range(2) for x in ("T1w", "bold")]
    for name, n in (("s6_extract_subject", 4), ("s6_extract_subjects", 12), ("s7_extract_sessions", 12), ("s7_extract_some_sessions", 4)):
        files, made = counted(spark, data, "path string, size long, subject string, session string, suffix string")
        study = files.withColumn("mtime", F.lit(0).cast("timestamp"))
        monkeypatch.setattr(registry.fx, "study", lambda spark, sf, study=study: study)
        assert registry.REGISTRY[name](spark, "").count() == n
        assert made.value == len(data)


def test_marks_are_files_of_tasks_not_of_subjects(spark, monkeypatch, rows):
    n = 200
    study = spark.range(n).select(F.col("id").cast("string").alias("subject"), F.lit("T1w").alias("suffix"))
    monkeypatch.setattr(registry.fx, "study", lambda spark, sf: study)
    before = set(glob.glob(f"{shared_dir(spark)}/cohortmill/marks-*"))
    got = registry.REGISTRY["u3_cleanup_marks"](spark, "")
    assert rows(got) == sorted(((str(i), i % 4 != 0) for i in range(n)), key=repr)
    (folder,) = set(glob.glob(f"{shared_dir(spark)}/cohortmill/marks-*")) - before
    assert 0 < len(glob.glob(f"{folder}/*.txt")) < n

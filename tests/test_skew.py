"""Groups that hold a third of all rows or more: results stay whole, work stays split."""

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cohortmill.operators import ordered, reports, studies
from cohortmill.sources import packs


def hot_records(n=900):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        batch = "hot" if i % 3 else rng.choice(["a", "b", None])
        # Two thirds of the times are one and the same instant.
        time = 1000 if rng.random() < 0.66 else rng.randrange(2000)
        rows.append((batch, time, i))
    rng.shuffle(rows)
    return rows


def brute_positions(rows):
    out = {}
    for batch in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == batch), key=lambda r: r[1:])
        out.update({r: i + 1 for i, r in enumerate(mine)})
    return out


@pytest.mark.parametrize("bits", [2, 5, None])
def test_running_count_equals_brute_force(spark, bits):
    rows = hot_records()
    df = spark.createDataFrame(rows, "batch string, t long, id long").repartition(5)
    got = ordered.running_count(df, ["batch"], ["t", "id"], "done", bits).collect()
    assert {(r.batch, r.t, r.id): r.done for r in got} == brute_positions(rows)
    assert len(got) == len(rows)


def test_running_count_spreads_a_hot_group_and_a_hot_instant(spark):
    df = spark.createDataFrame(hot_records(), "batch string, t long, id long")
    sizes = ordered.with_order_buckets(df, ["t", "id"], 5).groupBy("batch", "_b1", "_b2").count()
    assert sizes.agg(F.max("count")).first()[0] < 900 * 0.1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["x", "x", "x", "y"]), st.integers(-5, 5)), min_size=1, max_size=40))
def test_running_count_property(spark, data):
    rows = [(g, v, i) for i, (g, v) in enumerate(data)]
    df = spark.createDataFrame(rows, "batch string, t long, id long")
    got = ordered.running_count(df, ["batch"], ["t", "id"], "done", 3).collect()
    assert {(r.batch, r.t, r.id): r.done for r in got} == brute_positions(rows)


def quantile(values, p):
    values = sorted(values)
    r = p * (len(values) - 1)
    low, high = values[int(r)], values[min(int(r) + 1, len(values) - 1)]
    return low + (high - low) * (r - int(r))


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_exact_quantiles_equal_brute_force(spark, bits):
    rng = random.Random(7)
    rows = [("hot" if i % 3 else f"g{i % 5}", rng.choice([1.5, 1.5, rng.random() * 100])) for i in range(800)]
    rows += [(None, 3.0), ("one", 4.0), ("nothing", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    ps = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {r.g: r[1:] for r in ordered.exact_quantiles(df, ["g"], "v", ps, bits).collect()}
    groups = {g for g, v in rows if v is not None}
    assert set(got) == groups
    for g in groups:
        values = [v for k, v in rows if k == g and v is not None]
        assert got[g] == pytest.approx([quantile(values, p) for p in ps])


def test_group_report_keeps_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("n", None), (None, 5.0)], "g string, v double")
    got = {r.g: r for r in reports.group_report(df, ["g"], "v").collect()}
    assert got["a"].median == 2.0 and got["a"].stddev == pytest.approx(statistics.stdev([1, 2, 4]))
    assert got["n"].n == 0 and got["n"].median is None
    assert got[None].quartile1 == 5.0


def hot_catalog(spark):
    rows = [("hot", f"{i:04d}", "T1w" if i % 2 else "bold") for i in range(500)] + [
        (f"s{i}", f"{j}", "T1w") for i in range(20) for j in range(3)
    ] + [("bare", None, "T1w")]
    return spark.createDataFrame(rows, "subject string, session string, suffix string")


def test_session_lists_have_one_shape_at_every_size(spark):
    got = [tuple(r) for r in studies.sessions_by_subject(hot_catalog(spark)).collect()]
    want = [("bare", None)] + [("hot", f"{i:04d}") for i in range(500)] + sorted((f"s{i}", str(j)) for i in range(20) for j in range(3))
    assert got == want


def test_no_task_gets_all_sessions_of_the_hot_subject(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = studies.sessions_by_subject(hot_catalog(spark)).groupBy(F.spark_partition_id().alias("task")).count()
        assert held.agg(F.max("count")).first()[0] < 400
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_first_sessions_cut_before_the_shuffle(spark):
    sessions = studies.sessions(hot_catalog(spark), None)
    first = studies.first_k_sessions(sessions, 2)
    assert [r.session for r in first.filter("subject = 'hot'").orderBy("position").collect()] == ["0000", "0001"]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_pack_splits_a_hot_subject_into_bounded_files(spark, tmp_path):
    rows = [("hot", f"{i % 40:03d}", f"sub-hot/{i:05d}") for i in range(4000)] + [
        (f"s{i}", None, f"sub-s{i}/x") for i in range(300)
    ] + [(None, None, "participants.tsv")]
    df = spark.createDataFrame(rows, "subject string, session string, path string")
    path = str(tmp_path / "pack")
    packs.pack(df, path, max_bytes=8_000)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).count()
    assert files.agg(F.max("count")).first()[0] <= 8_000 * 4301 / (4301 * 14)
    assert packs.extract_all(spark, path).count() == len(rows)
    assert packs.extract_subject(spark, path, "hot").count() == 4001
    assert packs.extract_sessions(spark, path, "hot", ["003"]).count() == 101
    plan = packs.extract_subject(spark, path, "s7")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((shard" in plan and "PushedFilters: [Or(EqualTo(subject,s7)" in plan

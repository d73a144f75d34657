import posixpath
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cohortmill.functions import tasks
from cohortmill.functions.entities import parse_entities
from cohortmill.functions.paths import finished, is_ignored, normalise_path
from cohortmill.operators.manifests import ROLES, manifest_passes, path_rules, validate_manifest


def test_parse_entities_golden(spark):
    paths = [
        "sub-01/ses-02/func/sub-01_ses-02_run-03_bold.nii.gz",
        "sub-1/anat/sub-1_T1w.nii",
        "sub-01/anat/sub-01_space-A_hemi-L_desc-preproc_T1w.nii.gz",
        "sub-01/anat/sub-01_from-T1w_to-A_mode-image_xfm.h5",
        "dataset_description.json",
        "sub-01/anat/sub-01_acq-x.nii",
        "README",
    ]
    got = {
        r.path: r.asDict()
        for r in parse_entities(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    }
    full = got[paths[0]]
    assert (full["subject"], full["session"], full["run"], full["datatype"]) == ("01", "02", "03", "func")
    assert (full["suffix"], full["extension"]) == ("bold", "nii.gz")
    assert got[paths[1]]["subject"] == "1" and got[paths[1]]["session"] is None
    assert (got[paths[2]]["space"], got[paths[2]]["hemi"], got[paths[2]]["desc"]) == ("A", "L", "preproc")
    assert (got[paths[3]]["from_"], got[paths[3]]["to_"], got[paths[3]]["mode"]) == ("T1w", "A", "image")
    assert (got[paths[4]]["subject"], got[paths[4]]["suffix"], got[paths[4]]["extension"]) == (None, "description", "json")
    assert got[paths[5]]["suffix"] is None
    assert got[paths[6]]["suffix"] is None and got[paths[6]]["extension"] is None


def test_name_parts_equal_the_pattern_over_the_whole_path(spark):
    paths = [
        "sub-1_space-A/anat/sub-1_T1w.nii", "sub-1_space-A/sub-1_space-B_T1w.nii", "a_space-/b", "a_space-_space-C_x.nii",
        "_space-.x_space-D", "a_space-A_space-B.nii", "sub-1_space-A/", "a_xspace-A_T1w", "_space-A\n", "", "/", None,
    ]
    frame = parse_entities(spark.createDataFrame([(p,) for p in paths], "path string"))
    whole = F.nullif(F.regexp_extract("path", r"_space-([^/_.]+)[^/]*$", 1), F.lit(""))
    got = frame.select("path", "space", whole.alias("whole"))
    assert [(r.path, r.space) for r in got.collect()] == [(r.path, r.whole) for r in got.collect()]
    plan = frame.select("path", "space")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract(path" not in plan and "CASE WHEN Contains" in plan  # it runs only where the key stands


ids = st.text("ab019", min_size=1, max_size=4)
parts = st.fixed_dictionaries(
    {"subject": ids, "suffix": st.sampled_from(["T1w", "bold", "xfm"]), "extension": st.sampled_from(["nii", "nii.gz"])},
    optional={k: ids for k in ("session", "run", "space", "hemi", "from_", "to_", "mode", "label", "desc")},
)


def built_path(p):
    keys = {"session": "ses", "from_": "from", "to_": "to"}
    order = ("session", "run", "space", "hemi", "from_", "to_", "mode", "label", "desc")
    name = "".join(f"_{keys.get(k, k)}-{p[k]}" for k in order if k in p)
    folder = f"sub-{p['subject']}" + (f"/ses-{p['session']}" if "session" in p else "")
    return f"{folder}/anat/sub-{p['subject']}{name}_{p['suffix']}.{p['extension']}"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(parts, min_size=20, max_size=40))
def test_built_paths_parse_back(spark, data):
    df = spark.createDataFrame([(built_path(p),) for p in data], "path string").coalesce(1)
    for want, row in zip(data, parse_entities(df).collect()):
        got = {k: v for k, v in row.asDict().items() if v is not None and k not in ("path", "datatype")}
        assert got == want and row.datatype == "anat"


@pytest.mark.parametrize(
    "raw,clean",
    [
        ("/a/b/", "/a/b"),
        ("/a//b/./c", "/a/b/c"),
        ("a/../b", "b"),
        ("../a/../../b", "../../b"),
        ("/../a", "/a"),
        ("", "."),
        ("a/..", "."),
        ("$X/b", "/x$Y/b"),
        ("${X}/b", "/x$Y/b"),
        ("$Z/b$", "$Z/b$"),
        ("a$Xb/c", "a$Xb/c"),
    ],
)
def test_normalise_path(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "p string")
    assert df.select(normalise_path(F.col("p"), {"X": "/x$Y"})).first()[0] == clean


def test_normalised_paths_equal_the_standard_ones(spark):
    rng = random.Random(3)
    raw = sorted({"".join(rng.choice(["a", ".", ".", "/", "/", "b"]) for _ in range(rng.randint(0, 9))) for _ in range(3000)})
    got = spark.createDataFrame([(p,) for p in raw], "p string").select("p", normalise_path(F.col("p")).alias("n")).collect()
    wrong = [(r.p, r.n) for r in got if r.n != re.sub("^//", "/", posixpath.normpath(r.p))]
    assert not wrong, wrong[:5]



def test_ignore_patterns(spark):
    paths = {
        "sub-01.html": True,
        "a/logs/x.txt": True,
        "mylogs/x.txt": False,
        "figures/a.svg": True,
        "sub-01/anat/sub-01_xfm.h5": True,
        "sub-01/anat/sub-01_hemi-L_pial.surf.gii": True,
        "sub-01/anat/sub-01_T1w.nii.gz": False,
        "x.html.bak": False,
    }
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert {r[0]: r[1] for r in df.select("path", is_ignored(F.col("path"))).collect()} == paths


def test_walltimes(spark):
    good = {"01:00:00": (3600, 10800), "2-12:00:00": (216000, 212400), "10:30": (37800, 34200)}
    df = spark.createDataFrame([(t,) for t in good], "t string")
    seconds = tasks.walltime_seconds(F.col("t"))
    got = {r[0]: (r[1], r[2]) for r in df.select("t", seconds, tasks.worker_lifetime(seconds)).collect()}
    assert got == good
    bad = spark.createDataFrame([("5",)], "t string")
    with pytest.raises(Exception, match="unexpected walltime"):
        bad.select(tasks.walltime_seconds(F.col("t"))).collect()


def test_task_names_tell_items_apart(spark):
    df = spark.createDataFrame([("01", "02"), ("01", None), ("0'1", "2")], "a string, b string")
    names = [r[0] for r in df.select(tasks.task_name("t", F.col("a"), F.col("b"))).collect()]
    assert names[0] == "t_('01', '02')" and names[1] == "t_('01', None)"
    assert len(set(names)) == 3
    assert df.select(tasks.task_name("t", F.col("a"))).first()[0] == "t_01"
    assert df.select(tasks.task_name("t", F.col("a"), F.col("b"), sep="|")).collect()[1][0] == "t|01|None"


def test_render_command(spark):
    df = spark.createDataFrame([("01", 7.9)], "s string, m double")
    text = "\n    run\n        --sub \"{s}\" {{x}}\n        --mem {m}\n"
    command = tasks.render_command(text, {"s": F.col("s"), "m": F.col("m")}, {"m": tasks.floor_gb})
    assert df.select(command).first()[0] == ' run --sub "01" {x} --mem 7 '
    with pytest.raises(KeyError, match="skull"):
        tasks.render_command("{s} {skull}", {"s": F.col("s")})


def test_manifest_rules(spark, rows):
    data = [
        ("a", "input_dir", None, "dir", {"not_found"}),
        ("b", "input_dir", "file", "dir", {"not_a_dir"}),
        ("c", "input_file", "dir", "dir", {"not_a_file"}),
        ("d", "input_file", "file", "dir", set()),
        ("e", "output_dir", None, None, set()),
        ("f", "output_dir", "file", "dir", {"not_a_dir"}),
        ("g", "output_file", "dir", "dir", {"not_a_file"}),
        ("h", "output_file", None, "file", {"parent_not_a_dir"}),
    ]
    assert {d[1] for d in data} == set(ROLES)
    df = spark.createDataFrame([d[:4] for d in data], "path string, role string, kind string, parent_kind string")
    want = sorted((d[0], v) for d in data for v in d[4])
    assert rows(validate_manifest(df, path_rules())) == want
    assert rows(manifest_passes(df, path_rules())) == [(6, False)]
    assert rows(manifest_passes(df.filter("path IN ('d', 'e')"), path_rules())) == [(0, True)]
    assert rows(manifest_passes(df.limit(0), path_rules())) == [(0, True)]


def test_a_finished_path_is_not_copied_into_what_reads_it(spark):
    """Filters on name parts stay above the grouping that makes the path and read its text."""
    made = F.concat(F.lit("sub-"), F.col("k").cast("string"), F.lit("_run-1_bold.nii.gz"))
    grouped = spark.range(6).select((F.col("id") % 3).alias("k")).groupBy("k").count()
    parsed = parse_entities(grouped.select(finished(made), "count"))
    asked = parsed.filter("suffix = 'bold' AND subject IS NOT NULL").select("subject", "run", "count")
    assert asked._jdf.queryExecution().optimizedPlan().toString().count("_run-1_bold") == 1
    assert sorted(tuple(r) for r in asked.collect()) == [("0", "1", 2), ("1", "1", 2), ("2", "1", 2)]

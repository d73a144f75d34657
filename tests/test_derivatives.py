import json

import pytest
from pyspark.sql import functions as F

from cohortmill.functions.entities import parse_entities
from cohortmill.operators import derivatives as d
from cohortmill.sources.spec import DEFAULT_SPEC, DerivativeSpec, spec_read

SPEC = DerivativeSpec.load()
SPACE = "MNI152NLin2009cAsym"

# The files one subject has with one space and without surfaces.
GOLDEN_PATHS = [
    "sub-01/anat/sub-01_desc-brain_mask.nii.gz",
    "sub-01/anat/sub-01_desc-preproc_T1w.nii.gz",
    "sub-01/anat/sub-01_dseg.nii.gz",
    "sub-01/anat/sub-01_from-MNI152NLin2009cAsym_to-T1w_mode-image_xfm.h5",
    "sub-01/anat/sub-01_from-T1w_to-MNI152NLin2009cAsym_mode-image_xfm.h5",
    "sub-01/anat/sub-01_label-CSF_probseg.nii.gz",
    "sub-01/anat/sub-01_label-GM_probseg.nii.gz",
    "sub-01/anat/sub-01_label-WM_probseg.nii.gz",
    "sub-01/anat/sub-01_space-MNI152NLin2009cAsym_desc-brain_mask.nii.gz",
    "sub-01/anat/sub-01_space-MNI152NLin2009cAsym_desc-preproc_T1w.nii.gz",
    "sub-01/anat/sub-01_space-MNI152NLin2009cAsym_dseg.nii.gz",
    "sub-01/anat/sub-01_space-MNI152NLin2009cAsym_label-CSF_probseg.nii.gz",
    "sub-01/anat/sub-01_space-MNI152NLin2009cAsym_label-GM_probseg.nii.gz",
    "sub-01/anat/sub-01_space-MNI152NLin2009cAsym_label-WM_probseg.nii.gz",
]
# The output fields in order.
GOLDEN_FIELDS = [
    "t1w_preproc", "t1w_mask", "t1w_dseg", "t1w_tpms",
    "std_preproc", "std_mask", "std_dseg", "std_tpms",
    "anat2std_xfm", "std2anat_xfm",
    "t1w_aseg", "t1w_aparc",
    "t1w2fsnative_xfm", "fsnative2t1w_xfm",
    "surfaces",
]


def subjects(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "subject string")


def paths_of(spark, paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def test_predicted_paths_golden(spark):
    got = d.sorted_paths(d.predict_derivatives(subjects(spark, "01"), SPEC, [SPACE]))
    assert [r.path for r in got.collect()] == GOLDEN_PATHS


def test_output_fields_golden():
    assert SPEC.output_fields() == GOLDEN_FIELDS


def test_field_coverage_lists_fields_nobody_has(spark, rows):
    expected = d.predict_derivatives(subjects(spark, "01"), SPEC, [SPACE])
    found = d.resolve_with_fallback(expected, paths_of(spark, [GOLDEN_PATHS[1]]))
    got = {r.field: (r.position, r.subjects) for r in d.field_coverage(found, SPEC).collect()}
    assert list(sorted(got, key=lambda f: got[f][0])) == GOLDEN_FIELDS
    assert [f for f in got if got[f][1]] == ["t1w_preproc"]


def test_only_the_gz_suffix_is_cut(spark):
    expected = paths_of(spark, ["a/zig.gz", "a/x.nii", "a/y.nii.gz"]).withColumn("unit", F.lit(0))
    found = paths_of(spark, ["a/zig", "a/zi", "a/x.nii.gz", "a/y.nii", "a/y.nii.gz"])
    got = {r.path: r.resolved for r in d.resolve_with_fallback(expected, found).collect()}
    assert got == {"a/zig.gz": "a/zig", "a/x.nii": None, "a/y.nii.gz": "a/y.nii.gz"}


def found_among(spark, ids, have, spaces, surfaces=False):
    return d.found_units(subjects(spark, *ids), parse_entities(paths_of(spark, have)), SPEC, spaces, surfaces)


def test_a_missing_unit_makes_the_subject_incomplete(spark, rows):
    have = GOLDEN_PATHS + [p.replace("01", "02") for p in GOLDEN_PATHS[1:]]
    expected = d.predict_derivatives(subjects(spark, "01", "02"), SPEC, [SPACE])
    resolved = d.resolve_with_fallback(expected, paths_of(spark, have))
    assert rows(resolved.filter("NOT found").select("subject", "name")) == [("02", "t1w_mask")]
    everyone, found = subjects(spark, "01", "02", "03"), found_among(spark, ["01", "02", "03"], have, [SPACE])
    assert rows(d.derivatives_complete(everyone, found, SPEC, [SPACE])) == [("01", True), ("02", False), ("03", False)]
    cache = d.derivative_cache(everyone, found, SPEC, [SPACE])
    assert rows(cache.select("subject").distinct()) == [("01",)]
    outputs = d.derivative_maps(cache).first().outputs
    assert outputs["template"] == [SPACE]
    assert len(outputs["t1w_tpms"]) == 3 and outputs["t1w_preproc"] == [GOLDEN_PATHS[1]]


def test_files_in_a_session_or_with_more_name_parts_count(spark, rows):
    have = [p.replace("sub-01/anat/sub-01_", "sub-01/ses-1/anat/sub-01_ses-1_run-2_") for p in GOLDEN_PATHS]
    assert have != GOLDEN_PATHS
    found = found_among(spark, ["01"], have, [SPACE])
    assert {r.path for r in found.collect()} == set(have)
    assert rows(d.derivatives_complete(subjects(spark, "01"), found, SPEC, [SPACE])) == [("01", True)]


def test_one_label_of_a_baseline_unit_is_enough_but_surfaces_need_all(spark, rows):
    expected = d.predict_derivatives(subjects(spark, "01"), SPEC, [], surfaces=True)
    every = [r.path for r in expected.collect()]
    for missing, complete in (("label-GM", True), ("hemi-R_pial", False), ("nothing", True)):
        have = [p for p in every if missing not in p]
        found = found_among(spark, ["01"], have, [], surfaces=True)
        got = d.derivatives_complete(subjects(spark, "01"), found, SPEC, [], surfaces=True)
        assert rows(got) == [("01", complete)]


def test_each_space_has_its_own_transforms():
    items = [i for i in SPEC.items(["A", "B"]) if i["grp"] == "std_xfms"]
    assert sorted((i["from_"], i["to_"]) for i in items) == [("A", "T1w"), ("B", "T1w"), ("T1w", "A"), ("T1w", "B")]
    assert DEFAULT_SPEC["queries"]["std_xfms"]["anat2std_xfm"]["to"] == []


def test_space_names_match_exactly(spark, rows):
    catalog = parse_entities(
        paths_of(spark, [f"sub-01/anat/sub-01_space-{s}_desc-preproc_T1w.nii.gz" for s in ("A", "AB")])
    )
    assert d.space_filter(catalog, "A").count() == 1
    matched = d.match_derivatives(catalog, SPEC, ["A"]).filter("name = 'std_preproc'")
    assert [r.path for r in matched.collect()] == ["sub-01/anat/sub-01_space-A_desc-preproc_T1w.nii.gz"]


def test_absent_desc_and_label_must_be_absent_in_the_file(spark):
    names = ["_dseg.nii.gz", "_desc-aseg_dseg.nii.gz", "_label-GM_dseg.nii.gz", "_dseg.json", "_acq-1_dseg.nii"]
    catalog = parse_entities(paths_of(spark, [f"sub-01/anat/sub-01{n}" for n in names]))
    got = d.match_derivatives(catalog, SPEC, []).filter("name = 't1w_dseg'")
    assert sorted(r.path for r in got.collect()) == ["sub-01/anat/sub-01_acq-1_dseg.nii", "sub-01/anat/sub-01_dseg.nii.gz"]


def test_surface_matches_by_hemisphere(spark):
    expected = d.predict_derivatives(subjects(spark, "01"), SPEC, [], surfaces=True).filter("grp = 'surfaces'")
    catalog = parse_entities(expected.select("path"))
    got = d.match_derivatives(catalog, SPEC, [], surfaces=True)
    assert sorted(r.path for r in got.collect()) == sorted(r.path for r in expected.collect())


def test_transform_filter_any_of_hemispheres(spark):
    catalog = parse_entities(paths_of(spark, [f"sub-01/anat/sub-01_hemi-{h}_pial.surf.gii" for h in "LRX"]))
    wanted = F.array(F.lit("L"), F.lit("R"))
    assert catalog.filter(d.transform_matches(hemis=wanted)).count() == 2
    assert catalog.filter(d.transform_matches(mode=F.lit("image"))).count() == 0
    assert catalog.filter(d.transform_matches(mode=F.lit(None).cast("string"))).count() == 3


def test_own_queries_and_patterns():
    own = {"baseline": {"x": {"suffix": "x", "desc": ["a", "b"]}}, "std_xfms": {}, "surfaces": {}}
    spec = DerivativeSpec.load(queries=own, patterns=["desc", "space"])
    assert [i["tail"] for i in spec.items(["S"])] == [
        "_desc-a_x.nii.gz", "_desc-b_x.nii.gz", "_desc-a_space-S_x.nii.gz", "_desc-b_space-S_x.nii.gz",
    ]


def test_spec_read_of_the_default(spark):
    doc = spark.createDataFrame([(json.dumps(DEFAULT_SPEC),)], "spec string")
    got = {(r.grp, r.name, r.entity): r["values"] for r in spec_read(doc).collect()}
    assert got[("baseline", "tpms", "label")] == ["CSF", "GM", "WM"]
    assert got[("std_xfms", "anat2std_xfm", "to")] == []
    assert got[("surfaces", "t1w_aseg", "desc")] == ["aseg"]
    assert len(got) == sum(len(q) for g in DEFAULT_SPEC["queries"].values() for q in g.values())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_files_of_subjects_are_not_broadcast(spark):
    """Sizes are guessed from the list of subjects; its files are dozens of times as many."""
    ids = subjects(spark, "01", "02")
    found = d.predict_derivatives(ids, SPEC, [SPACE], surfaces=True).select("path")
    resolved = d.resolve_with_fallback(d.predict_derivatives(ids, SPEC, [SPACE], surfaces=True), found)
    units = d.found_units(ids, parse_entities(found), SPEC, [SPACE], surfaces=True)
    complete = d.derivatives_complete(ids, units, SPEC, [SPACE], surfaces=True)
    assert "Broadcast" not in plan_of(resolved)
    assert plan_of(units).count("BroadcastHashJoin") == 1  # the specification
    assert plan_of(complete).count("BroadcastHashJoin") == 1
    assert [r.complete for r in complete.collect()] == [True, True]


def test_one_task_of_subjects_becomes_many_tasks_of_files(spark):
    ids = spark.range(100, numPartitions=1).select(F.col("id").cast("string").alias("subject"))
    items = d.expand_spaces(ids, SPEC, [SPACE])
    assert items.count() == 100 * len(SPEC.items([SPACE]))
    assert items.select(F.spark_partition_id()).distinct().count() > 1


def test_name_parts_are_not_read_again_by_a_filter_below_the_match(spark):
    matched = d.match_derivatives(parse_entities(paths_of(spark, GOLDEN_PATHS)), SPEC, [SPACE])
    filters = [line for line in plan_of(matched).splitlines() if "Filter" in line and "substring_index" in line]
    assert not filters
    assert matched.count() == len(GOLDEN_PATHS)


def test_files_without_suffix_or_extension_match_nothing(spark):
    names = ["sub-01/anat/sub-01_desc-preproc_T1w", "sub-01/anat/sub-01_desc-preproc.nii.gz", "x", "", None]
    assert d.match_derivatives(parse_entities(paths_of(spark, names)), SPEC, [SPACE]).count() == 0


def test_files_are_matched_before_they_meet_the_subjects(spark):
    units = plan_of(found_among(spark, ["01"], GOLDEN_PATHS, [SPACE]))
    assert units.index("ShuffledHashJoin") < units.index("BroadcastHashJoin")  # the match lies below, on the files as they are read


def test_units_of_a_subject_fold_before_an_exchange(spark, tmp_path):
    found_among(spark, ["01"], GOLDEN_PATHS, [SPACE]).write.parquet(f"{tmp_path}/found")
    found = spark.read.parquet(f"{tmp_path}/found")
    complete = d.derivatives_complete(subjects(spark, "01"), found, SPEC, [SPACE])
    assert plan_of(complete).count("Exchange hashpartitioning") == 2  # the subjects and one row each


@pytest.mark.parametrize("missing", ["nothing", "space-S0_desc-brain", "space-S19_dseg", "from-T1w_to-S19"])
def test_more_units_than_bits_of_a_number(spark, missing):
    spaces = [f"S{i}" for i in range(20)]
    expected = d.predict_derivatives(subjects(spark, "01"), SPEC, spaces)
    assert max(i["unit"] for i in SPEC.items(spaces)) > 2 * d.UNIT_BITS - 4
    have = [r.path for r in expected.collect() if missing not in r.path]
    found = found_among(spark, ["01"], [*have, *have], spaces)
    got = d.derivatives_complete(subjects(spark, "01", "01", "02"), found, SPEC, spaces)
    assert {r.subject: r.complete for r in got.collect()} == {"01": missing == "nothing", "02": False}


def test_no_units_asked_is_complete(spark, rows):
    nothing = DerivativeSpec.load(queries={"baseline": {}, "std_xfms": {}, "surfaces": {}})
    found = found_among(spark, [], [], [])
    assert rows(d.derivatives_complete(subjects(spark, "01"), found, nothing, [])) == [("01", True)]


def test_files_of_complete_subjects_are_not_sorted(spark, rows):
    ids = subjects(spark, "01", "02")
    cache = d.derivative_cache(ids, found_among(spark, ["01", "02"], GOLDEN_PATHS, [SPACE]), SPEC, [SPACE])
    semi = [line for line in plan_of(cache).splitlines() if "LeftSemi" in line]
    assert semi and all("ShuffledHashJoin" in line for line in semi)
    assert len(rows(cache)) == len(GOLDEN_PATHS) + 1


def test_subjects_are_decided_on_once_and_apart_from_the_files(spark):
    ids = subjects(spark, "01", "02")
    cache = d.derivative_cache(ids, found_among(spark, ["01", "02"], GOLDEN_PATHS, [SPACE]), SPEC, [SPACE])
    plan = plan_of(d.derivative_maps(cache))
    assert "bit_or" not in plan and "SortMergeJoin" not in plan
    assert d.derivative_maps(cache).first().outputs["template"] == [SPACE]

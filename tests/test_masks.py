"""Ordered masks against a plain reading of the rules, and what a pack reads for them."""

import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from cohortmill.sources import masks, packs
from cohortmill.sources.masks import exclude, include

PATHS = [
    f"sub-{s}/{folder}{name}"
    for s in ("01", "02", "1", "a")
    for folder in ("", "anat/", "ses-1/func/", "ses-2/func/", "ses-12/")
    for name in (f"sub-{s}_T1w.nii", "bold.nii.gz", "x[1].txt")
] + ["participants.tsv", "derivatives/sub-01/x", "README", "sub-01", "code/run.py"]
PARTS = ["sub-*", "sub-01", "sub-0?", "sub-[01]*", "sub-[!0]*", "*", "ses-*", "ses-1", "ses-?", "anat", "func", "bold.*", "x[[]1].txt", "README", "code", "derivatives"]


def plainly(path, rules):
    verdict = not rules or not rules[0].include
    for rule in rules:
        parts, own = rule.pattern.strip("/").split("/"), path.split("/")
        if rule.pattern.strip("/") == "" or (len(own) >= len(parts) and all(fnmatch.fnmatchcase(o, p) for o, p in zip(own, parts, strict=False))):
            verdict = rule.include
    return verdict


def random_rules(rng):
    return [
        masks.Rule(rng.random() < 0.5, "/".join(rng.choice(PARTS) for _ in range(rng.randint(1, 3))))
        for _ in range(rng.randint(0, 5))
    ]


@pytest.fixture(scope="module")
def pack(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("masks") / "pack")
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    subject = F.nullif(F.regexp_extract("path", "^sub-([^/]+)", 1), F.lit(""))
    session = F.nullif(F.regexp_extract("path", "^sub-[^/]+/ses-([^/]+)/", 1), F.lit(""))
    packs.pack(df.select(subject.alias("subject"), session.alias("session"), "path"), path, max_bytes=60)
    return path


def test_random_rules_equal_plain_reading(spark, pack):
    rng = random.Random(8)
    for _ in range(25):
        rules = random_rules(rng)
        got = sorted(r.path for r in masks.extract_masked(spark, pack, rules).select("path").collect())
        assert got == sorted(p for p in PATHS if plainly(p, rules)), rules


def test_expressions_equal_plain_reading(spark):
    rng = random.Random(9)
    lists = [random_rules(rng) for _ in range(60)]
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    rows = df.select("path", *[masks.wanted(F.col("path"), rules).alias(f"r{k}") for k, rules in enumerate(lists)]).collect()
    for row in rows:
        assert [row[f"r{k}"] for k in range(len(lists))] == [plainly(row.path, rules) for rules in lists], row.path
    assert spark.createDataFrame([(None,)], "path string").select(masks.wanted(F.col("path"), [exclude("a")])).first()[0] is None


def test_fixed_forms_are_cases_of_rules(spark, pack, rows):
    cut = lambda df: rows(df.select("path"))
    assert cut(masks.extract_masked(spark, pack, masks.subject_rules("01"))) == cut(packs.extract_subject(spark, pack, "01"))
    assert cut(masks.extract_masked(spark, pack, masks.session_rules("01", ["2"]))) == cut(packs.extract_sessions(spark, pack, "01", {"2"}))
    assert cut(masks.extract_masked(spark, pack, [])) == cut(packs.extract_all(spark, pack))


def test_rules_prune_folders(spark, pack):
    def files(rules):
        return {r.f for r in masks.extract_masked(spark, pack, rules).select(F.input_file_name().alias("f")).collect()}

    plan = masks.extract_masked(spark, pack, masks.subject_rules("a"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "shard" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert files(masks.subject_rules("a")) < files([])
    assert masks.reachable_subjects([exclude("sub-*"), include("sub-a/ses-1"), include("/sub-01")]) == ["01", "a"]
    assert masks.reachable_subjects([exclude("sub-*"), include("sub-0?")]) is None
    assert masks.reachable_subjects([exclude("sub-01")]) is None
    assert masks.reachable_subjects([include("README")]) == []
    assert masks.reachable_subjects([include("sub-a"), include("sub-*")]) is None

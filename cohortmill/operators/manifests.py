"""Path checks, incremental copies and scratch clean-up as set operations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from cohortmill.functions.paths import DEFAULT_IGNORES, is_ignored

# What a path is used for.
ROLES = ("input_dir", "input_file", "output_dir", "output_file")


def path_rules() -> dict[str, Column]:
    """Violations a manifest row ``(path, role, kind, parent_kind)`` may have.

    ``kind`` is ``file``, ``dir`` or null for a missing path. Missing output parents
    are created on use; only a parent that is a file stands in the way.
    """
    role, kind, parent = F.col("role"), F.col("kind"), F.col("parent_kind")
    wants_dir = role.isin("input_dir", "output_dir")
    return {
        "not_found": role.isin("input_dir", "input_file") & kind.isNull(),
        "not_a_dir": wants_dir & (kind == "file"),
        "not_a_file": ~wants_dir & (kind == "dir"),
        "parent_not_a_dir": role.isin("output_dir", "output_file") & kind.isNull() & (parent == "file"),
    }


def naming_rules() -> dict[str, Column]:
    """Violations of the naming standard, on parsed name parts."""
    path, subject, session = F.col("path"), F.col("subject"), F.col("session")
    name = F.substring_index(path, "/", -1)
    return {
        "no_subject": subject.isNull(),
        "no_suffix": F.col("suffix").isNull(),
        "no_datatype": F.col("datatype").isNull(),
        "subject_mismatch": subject.isNotNull()
        & ~F.startswith(name, F.concat(F.lit("sub-"), subject, F.lit("_"))),
        "session_mismatch": session.isNotNull()
        & ~F.contains(name, F.concat(F.lit("_ses-"), session, F.lit("_"))),
    }


def validate_manifest(manifest: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per path and violated rule."""
    broken = F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()])
    return manifest.select("path", F.explode(F.array_compact(broken)).alias("violation"))


def manifest_passes(manifest: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: how many paths break a rule and whether none does."""
    bad: Column = F.lit(False)
    for rule in rules.values():
        bad = bad | F.coalesce(rule, F.lit(False))
    return manifest.agg(F.count_if(bad).alias("bad_paths"), F.coalesce(F.bool_and(~bad), F.lit(True)).alias("passes"))


def apply_ignore(catalog: DataFrame, globs: Iterable[str] = DEFAULT_IGNORES) -> DataFrame:
    """Catalogue without the paths any ignore pattern matches."""
    return catalog.filter(~is_ignored(F.col("path"), globs))


def sync_plan(source: DataFrame, target: DataFrame) -> DataFrame:
    """Files an incremental copy must move: absent at the target, or size or time differ."""
    there = target.select(
        "path", F.col("size").alias("there_size"), F.col("mtime").alias("there_mtime"), F.lit(True).alias("there")
    )
    same = F.col("size").eqNullSafe(F.col("there_size")) & F.col("mtime").eqNullSafe(F.col("there_mtime"))
    reason = F.when(F.col("there").isNull(), "absent").otherwise("changed")
    return (
        source.join(there, "path", "left")
        .filter(F.col("there").isNull() | ~same)
        .select("path", "size", "mtime", reason.alias("reason"))
    )


def retire_scratch(scratch: DataFrame, results: DataFrame) -> DataFrame:
    """Scratch rows that may be dropped: those of successful items only."""
    return scratch.join(results.filter("did_succeed").select("task_name").distinct(), "task_name", "left_semi")


def keep_scratch(scratch: DataFrame, results: DataFrame) -> DataFrame:
    """Scratch rows that stay; write them to a new folder rather than deleting in place."""
    return scratch.join(results.filter("did_succeed").select("task_name").distinct(), "task_name", "left_anti")

"""Expected derivative files against the ones found."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortmill.session import MAX_BROADCAST_ROWS, materialise, worker_partitions
from cohortmill.sources.spec import DerivativeSpec

# Units a bigint can mark without its sign.
UNIT_BITS = 63


def expand_spaces(subjects: DataFrame, spec: DerivativeSpec, spaces: Sequence[str], surfaces: bool = False) -> DataFrame:
    """Each subject with every (query, space) row of the specification.

    The specification is a constant array exploded in place: no join. Only the subjects' ids are dealt out
    first, as a few MB of them, which Spark reads in one task, become dozens of files each.
    """
    ids = subjects.select("subject")
    dealt = ids if ids.isStreaming else ids.repartition(worker_partitions(ids.sparkSession))
    return dealt.select("subject", F.inline(spec.item_column(spaces, surfaces)))


def derivative_path(subject: Column, folder: Column, tail: Column) -> Column:
    return F.concat(F.lit("sub-"), subject, F.lit("/"), folder, F.lit("/sub-"), subject, tail)


def predict_derivatives(
    subjects: DataFrame, spec: DerivativeSpec, spaces: Sequence[str], surfaces: bool = False
) -> DataFrame:
    """Paths each subject should have, with the query and unit they stand for."""
    items = expand_spaces(subjects, spec, spaces, surfaces)
    path = derivative_path(F.col("subject"), F.col("folder"), F.col("tail"))
    return items.select("subject", "unit", "grp", "name", "need_all", "space", path.alias("path"))


def sorted_paths(df: DataFrame) -> DataFrame:
    """Paths in global order, by range partitioning."""
    return df.select("path").orderBy("path")


def space_filter(catalog: DataFrame, space: str | None) -> DataFrame:
    """Files of exactly one space, or files that name none."""
    return catalog.filter(F.col("space").isNull() if space is None else F.col("space") == space)


def transform_matches(
    mode: Column | None = None,
    from_: Column | None = None,
    to_: Column | None = None,
    hemis: Column | None = None,
) -> Column:
    """Conjunction over mode, from, to and any of the hemispheres; null asks nothing."""
    condition = F.lit(True)
    for wanted, found in ((mode, "mode"), (from_, "from_"), (to_, "to_")):
        if wanted is not None:
            condition = condition & (wanted.isNull() | F.coalesce(F.col(found) == wanted, F.lit(False)))
    if hemis is not None:
        any_of = F.coalesce(F.array_contains(hemis, F.col("hemi")), F.lit(False))
        condition = condition & (hemis.isNull() | any_of)
    return condition


def match_derivatives(
    catalog: DataFrame, spec: DerivativeSpec, spaces: Sequence[str], surfaces: bool = False
) -> DataFrame:
    """Catalogue files with the (query, space) each of them answers.

    Suffix, desc and label are the hash keys (null equals null: a part the query
    leaves out must be absent in the file); space, extension and the transform parts
    are checked per candidate. The size of the specification is known here; while it is
    small it is broadcast and the catalogue only streamed past it.
    """
    small = len(spec.items(spaces, surfaces)) <= MAX_BROADCAST_ROWS
    queries = catalog.sparkSession.range(1).select(F.inline(spec.item_column(spaces, surfaces)))
    queries = queries.select(
        "unit", "grp", "name", "need_all", "extensions",
        F.col("space").alias("q_space"),
        F.col("suffix").alias("q_suffix"),
        F.col("desc").alias("q_desc"),
        F.col("label").alias("q_label"),
        F.col("mode").alias("q_mode"),
        F.col("from_").alias("q_from"),
        F.col("to_").alias("q_to"),
        F.col("hemi").alias("q_hemi"),
    )
    hemi = F.when(F.col("q_hemi").isNotNull(), F.array("q_hemi"))
    condition = (
        F.col("suffix").eqNullSafe(F.col("q_suffix"))
        & F.col("desc").eqNullSafe(F.col("q_desc"))
        & F.col("label").eqNullSafe(F.col("q_label"))
        & ((F.col("grp") == "std_xfms") | F.col("space").eqNullSafe(F.col("q_space")))
        & F.coalesce(F.array_contains("extensions", F.col("extension")), F.lit(False))
        & transform_matches(F.col("q_mode"), F.col("q_from"), F.col("q_to"), hemi)
    )
    return catalog.join(F.broadcast(queries) if small else queries, condition).select(
        "subject", "unit", "grp", "name", F.col("q_space").alias("space"), "path"
    )


def resolve_with_fallback(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Expected files with the path found: exact, else without ``.gz``, else null.

    Found files fold to one row per name without ``.gz``, so one join answers both
    questions. The join is a merge of sorted files: sizes are guessed from what the paths were
    made of, often a small list of subjects, and must not send a study's files through the driver.
    """
    stem = F.regexp_replace("path", r"\.gz$", "")
    zipped = F.endswith(F.col("path"), F.lit(".gz"))
    have = found.groupBy(stem.alias("stem")).agg(
        F.max(F.when(zipped, F.col("path"))).alias("as_gz"),
        F.max(F.when(~zipped, F.col("path"))).alias("as_plain"),
    )
    resolved = F.when(zipped, F.coalesce("as_gz", "as_plain")).otherwise(F.col("as_plain"))
    return (
        expected.withColumn("stem", stem)
        .join(have.hint("merge"), "stem", "left")
        .withColumn("resolved", resolved)
        .withColumn("found", F.col("resolved").isNotNull())
        .drop("stem", "as_gz", "as_plain")
    )


def found_units(
    subjects: DataFrame, catalog: DataFrame, spec: DerivativeSpec, spaces: Sequence[str], surfaces: bool = False
) -> DataFrame:
    """Files that answer a unit of the specification: ``subject, unit, grp, name, space, path``.

    Baseline outputs and transforms are any files with the right name parts, at subject or
    session level; surface outputs are the expected paths, with or without ``.gz``. Subjects may be
    millions, more than guessed from their file, so they meet the files in partitions and are not broadcast.
    Only matched files are moved for that: a generated row keeps Spark from moving the catalogue with all its name parts.
    """
    asked = subjects.select("subject").hint("shuffle_hash")
    matched = match_derivatives(catalog, spec, spaces)
    found = matched.select(F.inline(F.array(F.struct(*matched.columns)))).join(asked, "subject", "left_semi")
    if not surfaces:
        return found
    expected = predict_derivatives(subjects, spec, spaces, surfaces=True).filter("grp = 'surfaces'")
    exact = resolve_with_fallback(expected, catalog.select("path")).filter("found")
    return found.unionByName(exact.select("subject", "unit", "grp", "name", "space", F.col("resolved").alias("path")))


def derivatives_complete(
    subjects: DataFrame, found: DataFrame, spec: DerivativeSpec, spaces: Sequence[str], surfaces: bool = False
) -> DataFrame:
    """Per subject whether every required unit has a file in ``found``.

    A unit with several files needs one of them, a surface unit all of them. What a subject needs is a
    number known from the specification. Units that need one file are bits, which fold before any
    exchange; only files of surfaces are told apart by path.
    """
    items = spec.items(spaces, surfaces)
    needed = len({(i["unit"], i["tail"] if i["need_all"] else None) for i in items})
    units = 1 + max((i["unit"] for i in items if not i["need_all"]), default=0)
    unit = F.col("unit")
    parts = {}
    for first in range(0, units, UNIT_BITS):
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), unit - first)
        here = (unit >= first) & (unit < min(first + UNIT_BITS, units))
        parts[f"units_{first}"] = F.bit_count(F.bit_or(F.when(here, bit)))
    if surfaces:
        file = F.when(F.col("grp") == "surfaces", F.struct("unit", "path"))
        parts["files"] = F.count_distinct(file)
    have = found.groupBy("subject").agg(*[part.alias(name) for name, part in parts.items()])
    n = functools.reduce(operator.add, [F.coalesce(F.col(name), F.lit(0)) for name in parts])
    joined = subjects.select("subject").distinct().join(have.hint("merge"), "subject", "left")
    return joined.select("subject", (n == needed).alias("complete"))


def derivative_cache(
    subjects: DataFrame, found: DataFrame, spec: DerivativeSpec, spaces: Sequence[str], surfaces: bool = False
) -> DataFrame:
    """Outputs of the complete subjects in long form ``subject, name, space, path``.

    The requested spaces are listed under the name ``template``. ``found`` is written once, as both
    the decision and the outputs read it, and so are the complete subjects: beside the files their decision would be left
    to a task or two. They are held by hash, so the files are not sorted.
    """
    found = materialise(found, "found")
    decided = derivatives_complete(subjects, found, spec, spaces, surfaces)
    complete = materialise(decided.filter("complete").select("subject"), "complete")
    templates = complete.select(
        "subject",
        F.lit("template").alias("name"),
        F.explode(F.array(*[F.lit(s) for s in spaces]).cast("array<string>")).alias("space"),
        F.lit(None).cast("string").alias("path"),
    )
    outputs = found.select("subject", "name", "space", "path").join(complete.hint("shuffle_hash"), "subject", "left_semi")
    return outputs.unionByName(templates)


def derivative_maps(cache: DataFrame) -> DataFrame:
    """The cache as one map per subject, name to ordered paths (spaces for ``template``).

    A map holds the files of one subject; where those may be many, keep the long form.
    """
    value = F.coalesce("path", "space")
    lists = cache.groupBy("subject", "name").agg(F.array_sort(F.collect_set(value)).alias("paths"))
    entries = F.collect_list(F.struct("name", "paths"))
    return lists.groupBy("subject").agg(F.map_from_entries(entries).alias("outputs"))


def field_coverage(resolved: DataFrame, spec: DerivativeSpec) -> DataFrame:
    """Each output field, in order, with the number of subjects that have it."""
    names = F.array(*[F.lit(name) for name in spec.output_fields()])
    fields = resolved.sparkSession.range(1).select(F.posexplode(names).alias("position", "field"))
    have = resolved.filter("found").select(F.col("name").alias("field"), "subject").distinct()
    counts = have.groupBy("field").agg(F.count(F.lit(1)).alias("subjects"))
    return fields.join(counts, "field", "left").select(
        "position", "field", F.coalesce("subjects", F.lit(0)).alias("subjects")
    )

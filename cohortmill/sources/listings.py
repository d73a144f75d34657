"""Archive listings: which subjects and sessions an archive holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# What marks an anatomical member.
ANAT_FOLDER, ANAT_ENDINGS = "/anat/", ("_T1w.nii", "_T1w.nii.gz")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Listing text as ``line``, without the header lines.

    Header lines are recognised by holding no member path, so the file can be read
    in splits.
    """
    return spark.read.text(path).select(F.col("value").alias("line"))


def _level(member: Column, depth: int, prefix: str) -> Column:
    """The id in the folder at ``depth`` of a member path, null where another kind of name stands there."""
    name = F.get(F.split(member, "/"), F.lit(depth))
    return F.when(F.startswith(name, F.lit(prefix)) & (F.length(name) > len(prefix)), F.substr(name, F.lit(len(prefix) + 1)))


def _anat_path(member: Column, session: Column) -> Column:
    """What follows the subject and session of an anatomical image, up to its extension, else null."""
    depth = F.when(session.isNull(), 1).otherwise(2)
    rest = F.concat(F.lit("/"), F.array_join(F.slice(F.split(member, "/"), depth + 1, 1 << 20), "/"))
    stem = F.substring_index(rest, ".", 1)
    # The name has no dot before its extension; what comes after the extension does not count.
    image = F.startswith(rest, F.lit(ANAT_FOLDER)) & F.endswith(stem, F.lit("_T1w")) & (F.length(stem) > len(ANAT_FOLDER) + len("_T1w"))
    found = F.lit(None).cast("string")
    for ending in ANAT_ENDINGS:
        whole = F.concat(stem, F.lit(ending.removeprefix("_T1w")))
        found = F.when(image & F.startswith(rest, whole), whole).otherwise(found)
    return found


def listing_ingest(lines: DataFrame) -> DataFrame:
    """Sorted distinct ``subject, session, anat_path`` of an archive listing.

    The member path is the last blank-separated field. Lines whose member does not
    start with ``sub-`` are dropped; :func:`rejected_lines` counts them.
    """
    member = F.regexp_extract("line", r"(\S+)\s*$", 1)
    members = lines.select(member.alias("member")).filter(F.startswith("member", F.lit("sub-")))
    parts = members.select("member", _level(F.col("member"), 0, "sub-").alias("subject"), _level(F.col("member"), 1, "ses-").alias("session"))
    return (
        parts.select("subject", "session", _anat_path(F.col("member"), F.col("session")).alias("anat_path"))
        .distinct()
        .orderBy("subject", "session", "anat_path")
    )


def rejected_lines(lines: DataFrame) -> DataFrame:
    """How many lines mention ``sub-`` without their member starting with it."""
    member = F.regexp_extract("line", r"(\S+)\s*$", 1)
    bad = F.contains(member, F.lit("sub-")) & ~F.startswith(member, F.lit("sub-"))
    return lines.agg(F.count_if(bad).alias("rejected"))


def listing_text(listing: DataFrame) -> DataFrame:
    """``subject,session,anat_path`` lines with trailing commas cut."""
    parts = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in ("subject", "session", "anat_path")])
    return listing.select(F.regexp_replace(parts, ",+$", "").alias("line")).distinct().orderBy("line")


def parse_listing(lines: DataFrame) -> DataFrame:
    """``subject, session, has_anat`` from one to three comma-separated fields.

    An empty field is null, and a third field, even an empty one, means anatomical
    data.
    """
    fields = F.split("line", ",")
    return lines.select(
        F.nullif(F.get(fields, F.lit(0)), F.lit("")).alias("subject"),
        F.nullif(F.get(fields, F.lit(1)), F.lit("")).alias("session"),
        (F.size(fields) >= 3).alias("has_anat"),
    )


def listed_sessions(listing: DataFrame) -> DataFrame:
    """One row per (subject, session) of a parsed listing, with its anat flag."""
    return listing.groupBy("subject", "session").agg(F.bool_or("has_anat").alias("has_anat"))

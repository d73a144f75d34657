"""Questions asked of a study catalogue: subjects, sessions, work items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Which file suffix makes a subject or a session count.
ANAT_SUFFIX = "T1w"
FUNC_SUFFIX = "bold"
# Scratch space one work item may use, in bytes.
GIB = 1024**3
SCRATCH_LIMITS = {"session": 240 * GIB, "subject": 300 * GIB, "dataset": 300 * GIB}


def entity_query(catalog: DataFrame, **filters: object) -> DataFrame:
    """Rows whose name parts equal a value, are in a list, or are absent (``None``)."""
    for name, wanted in filters.items():
        column = F.col(name)
        if wanted is None:
            catalog = catalog.filter(column.isNull())
        elif isinstance(wanted, (list, tuple, set, frozenset)):
            catalog = catalog.filter(column.isin(list(wanted)))
        else:
            catalog = catalog.filter(column == wanted)
    return catalog


def _having(catalog: DataFrame, suffix: str | None) -> DataFrame:
    return catalog if suffix is None else entity_query(catalog, suffix=suffix)


def subjects(catalog: DataFrame, suffix: str | None = ANAT_SUFFIX) -> DataFrame:
    """Distinct subjects having a file of ``suffix``; ``None`` takes every subject."""
    return _having(catalog, suffix).filter("subject IS NOT NULL").select("subject").distinct()


def sessions(catalog: DataFrame, suffix: str | None = FUNC_SUFFIX) -> DataFrame:
    """Distinct (subject, session) having a file of ``suffix``, all subjects at once."""
    known = "subject IS NOT NULL AND session IS NOT NULL"
    return _having(catalog, suffix).filter(known).select("subject", "session").distinct()


def session_index(catalog: DataFrame) -> DataFrame:
    """One row per (subject, session): ``has_anat``, ``has_func``, ``func_session``.

    A single partially aggregated shuffle answers the existence questions that would
    otherwise each need a join. ``func_session`` is ``has_func`` with a session. All
    flags are bits of one aggregate, so plans asking for different ones still share
    the same exchange.
    """
    anat, func = F.col("suffix") == ANAT_SUFFIX, F.col("suffix") == FUNC_SUFFIX
    bits = F.when(anat, 1).when(func & F.col("session").isNull(), 2).when(func, 6).otherwise(0)
    flags = F.col("flags")
    return (
        catalog.filter("subject IS NOT NULL")
        .groupBy("subject", "session")
        .agg(F.bit_or(bits).alias("flags"))
        .select(
            "subject",
            "session",
            (flags.bitwiseAND(1) != 0).alias("has_anat"),
            (flags.bitwiseAND(2) != 0).alias("has_func"),
            (flags.bitwiseAND(4) != 0).alias("func_session"),
        )
    )


def session_has_anat(catalog: DataFrame) -> DataFrame:
    """Every (subject, session) with whether it holds anatomical data."""
    return session_index(catalog).select("subject", "session", "has_anat")


def anat_sessions(catalog: DataFrame) -> DataFrame:
    """Sessions that hold anatomical data; data without a session gives no row."""
    return session_index(catalog).filter("session IS NOT NULL AND has_anat").select("subject", "session")


def sessions_in(sessions: DataFrame, others: DataFrame) -> DataFrame:
    """Sessions of one table that also occur in another (two-column key)."""
    return sessions.join(others.select("subject", "session"), ["subject", "session"], "left_semi")


def sessions_by_subject(catalog: DataFrame, suffix: str | None = None) -> DataFrame:
    """The sorted, deduplicated sessions of every subject as rows ``subject, session``.

    A subject without sessions keeps one row with a null session. The rows are sorted over all
    tasks, so a subject's list is its rows in order, and no list has to fit a task.
    """
    listed = _having(catalog, suffix).filter("subject IS NOT NULL")
    known = listed.filter("session IS NOT NULL").select("subject", "session").distinct()
    without = listed.groupBy("subject").agg(F.max("session").alias("session")).filter("session IS NULL")
    return known.unionByName(without).orderBy("subject", "session")


def subject_session_pairs(subjects: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions of the given subjects; a subject without sessions gives no row."""
    return sessions.join(subjects.select("subject"), "subject").select("subject", "session")


def first_k_sessions(sessions: DataFrame, k: int) -> DataFrame:
    """The first ``k`` sessions of each subject in session-id order.

    Spark cuts each task's rows to ``k`` per subject before the shuffle, so a
    subject with very many sessions ships only a few of them.
    """
    w = Window.partitionBy("subject").orderBy("session")
    distinct = sessions.filter("session IS NOT NULL").select("subject", "session").distinct()
    return distinct.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k)


def first_sessions_list(sessions: DataFrame, k: int) -> DataFrame:
    """The first ``k`` sessions of each subject as one list of at most ``k``."""
    kept = first_k_sessions(sessions, k)
    return kept.groupBy("subject").agg(F.slice(F.array_sort(F.collect_list("session")), 1, k).alias("sessions"))


def reference_sessions(index: DataFrame) -> DataFrame:
    """Per subject: the first anatomical session, and how many sessions there are."""
    anat = F.when(F.col("has_anat"), F.col("session"))
    return index.groupBy("subject").agg(
        F.min(anat).alias("reference_session"),
        F.bool_or("has_anat").alias("subject_has_anat"),
        F.count_if("func_session").alias("func_sessions"),
    )


def pick_reference_session(index: DataFrame) -> DataFrame:
    """Each functional session with its subject's first anatomical session.

    The reference may be another session of the subject, and is null when no
    session of the subject holds anatomical data.
    """
    functional = index.filter("func_session")
    chosen = reference_sessions(index)
    return functional.join(chosen, "subject", "left").select(
        "subject", "session", "reference_session", "subject_has_anat", "func_sessions"
    )


def work_items(catalog: DataFrame) -> DataFrame:
    """Dataset, subject and session units with file counts and bytes.

    Files are summed per session before the grouping sets triple the rows.
    """
    per_session = (
        catalog.groupBy("subject", "session")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
    )
    level = F.grouping_id()
    return (
        per_session.groupingSets([[], ["subject"], ["subject", "session"]], "subject", "session")
        .agg(level.alias("level"), F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))
        .withColumn(
            "granularity",
            F.when(F.col("level") == 3, "dataset").when(F.col("level") == 1, "subject").otherwise("session"),
        )
        .filter(
            (F.col("granularity") == "dataset")
            | ((F.col("granularity") == "subject") & F.col("subject").isNotNull())
            | (F.col("subject").isNotNull() & F.col("session").isNotNull())
        )
        .select("granularity", "subject", "session", "files", "bytes")
    )


def budget_check(units: DataFrame, limits: Mapping[str, int] = SCRATCH_LIMITS) -> DataFrame:
    """Mark the work items whose bytes fit the limit of their granularity."""
    limit: Column = F.lit(None).cast("bigint")
    for granularity, size in limits.items():
        limit = F.when(F.col("granularity") == granularity, F.lit(size).cast("bigint")).otherwise(limit)
    return units.withColumn("limit_bytes", limit).withColumn("fits", F.col("bytes") <= F.col("limit_bytes"))


def capacity_plan(catalog: DataFrame, requested: int, levels: Sequence[str] = ("subject", "session")) -> DataFrame:
    """Workers worth starting per stage: all items when -1, else at most that many."""
    index = session_index(catalog)
    counts = index.groupBy("subject").agg(
        F.bool_or("has_anat").alias("anat"),
        F.count_if("func_session").alias("n"),
    )
    totals = counts.filter("anat").agg(
        F.count(F.lit(1)).alias("subject"), F.coalesce(F.sum("n"), F.lit(0)).alias("session")
    )
    rows = F.array(*[F.struct(F.lit(level).alias("level"), F.col(level).alias("items")) for level in levels])
    asked = F.lit(requested).cast("bigint")
    return totals.select(F.inline(rows)).withColumn(
        "workers", F.when(asked == -1, F.col("items")).otherwise(F.least(asked, F.col("items")))
    )

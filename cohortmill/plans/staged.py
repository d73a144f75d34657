"""A staged study run: each stage works on the survivors of the one before."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortmill.operators.batches import Cleanup, TaskFunction, apply_batch, name_items
from cohortmill.operators.ledgers import stage_gate, survivors
from cohortmill.operators.manifests import manifest_passes, path_rules
from cohortmill.operators.studies import first_sessions_list, session_index, sessions, subject_session_pairs, subjects
from cohortmill.session import materialise
from cohortmill.sources.documents import session_filters, write_session_filters
from cohortmill.sources.ledger_store import journal_close, ledger_current, ledger_record, ledger_records

# The code a run stops with, by stage, and the sessions a stage gets.
STOP_CODES = {
    "validate": 1,
    "archive": -1,
    "discover": -2,
    "subject_quality": 2,
    "group_quality": 3,
    "anatomical": 4,
    "session_filter": 5,
    "session_functional": 6,
    "subject_functional": 7,
}
ANATOMICAL_SESSIONS = 2

# Stages of each granularity, in order, with the level of their items.
STAGES = {
    "dataset": (("subject_quality", "subject"), ("group_quality", "dataset")),
    "subject": (("subject_quality", "subject"), ("subject_functional", "subject")),
    "session": (("anatomical", "subject"), ("session_filter", "session"), ("session_functional", "session")),
}


class StudyStopped(Exception):
    """A stage left nothing to go on with."""

    def __init__(self, stage: str):
        super().__init__(f"stage {stage} left no successful item")
        self.stage = stage
        self.code = STOP_CODES[stage]


@dataclass
class Stage:
    """What one stage runs; ``arguments`` are the item columns passed by name."""

    fn: TaskFunction
    cleanup: Cleanup | None = None
    arguments: Sequence[str] | None = None


@dataclass
class StudyRun:
    """Outcomes per stage that ran, and the items that passed the last one."""

    results: dict[str, DataFrame] = field(default_factory=dict)
    passed: DataFrame | None = None


def next_run(spark: SparkSession, ledger_path: str) -> int:
    """The number after the last run of the store."""
    last = ledger_records(spark, ledger_path).agg(F.coalesce(F.max("seq"), F.lit(-1)).alias("seq")).first()
    return last["seq"] + 1


def record_run(spark: SparkSession, results: DataFrame, ledger_path: str) -> None:
    """Append fresh outcomes as the next run of the store.

    Drivers recording at the same moment may take the same number but not the same
    folder.
    """
    ledger_record(results.filter("NOT cached"), ledger_path, next_run(spark, ledger_path), uuid.uuid4().hex)


def run_stage(
    spark: SparkSession, name: str, items: DataFrame, stage: Stage, keys: Sequence[str], ledger_path: str
) -> tuple[DataFrame, DataFrame]:
    """Run one stage, stop if nothing succeeded; results and survivors.

    Readers of the ledger see every outcome within about a second of its item's end, from the stage's journal in the store;
    at the end of the stage one commit takes its place. A lost stage goes on from its journal.
    """
    # Written once, as what runs and who survives are both asked of the items.
    named = materialise(name_items(items, name, keys), f"named-{name}") if keys else items.withColumn("task_name", F.lit(name))
    ledger = ledger_current(spark, ledger_path)
    arguments = list(stage.arguments if stage.arguments is not None else keys)
    run, token = next_run(spark, ledger_path), uuid.uuid4().hex

    def record(results: DataFrame, part: int) -> None:
        ledger_record(results, ledger_path, run, f"{token}-{part}")

    results = apply_batch(
        named, ledger, stage.fn, arguments, stage.cleanup, record=record,
        journal=f"{ledger_path.rstrip('/')}/journal/{token}", close=lambda: journal_close(ledger_path, token),
    )
    if not stage_gate(results, single=not keys).first()["go_on"]:
        raise StudyStopped(name)
    if not keys:
        return results, items
    return results, materialise(survivors(named, results).drop("task_name"), f"passed-{name}")


def stage_items(catalog: DataFrame, passed: DataFrame, name: str, level: str) -> DataFrame:
    """The items of a stage, built from the subjects or sessions that got this far.

    Every item carries what its function may need: the anatomical stage the first
    two anatomical sessions of the subject, the session stages the reference session
    and the filter document.
    """
    if level == "dataset":
        return catalog.sparkSession.range(1).select()
    if level == "subject":
        if name != "anatomical":
            return passed.select("subject")
        anat = session_index(catalog).filter("has_anat")
        return passed.select("subject").join(first_sessions_list(anat, ANATOMICAL_SESSIONS), "subject", "left")
    if "session" in passed.columns:
        return passed
    pairs = subject_session_pairs(passed, sessions(catalog))
    anat = first_sessions_list(session_index(catalog).filter("has_anat"), 1)
    reference = anat.select("subject", F.get("sessions", F.lit(0)).alias("reference_session"))
    return session_filters(pairs).join(reference, "subject", "left")


def run_study(
    spark: SparkSession,
    catalog: DataFrame,
    ledger_path: str,
    granularity: str,
    stages: Mapping[str, Stage],
    manifest: DataFrame | None = None,
    filters_path: str | None = None,
) -> StudyRun:
    """Run the given stages of a granularity in order; stages left out are skipped.

    Each stage is one job whose outcomes are written before the next is planned; the
    gates are the only rows read on the driver. A ``manifest`` of probed paths must pass its
    rules before anything runs. With ``filters_path`` the filter documents of the sessions that
    got through the anatomical stage are written there before a session stage reads them. What the stages
    ask of the catalogue is written once, as every one of them reads it again.
    """
    run = StudyRun()
    if manifest is not None and not manifest_passes(manifest, path_rules()).first()["passes"]:
        raise StudyStopped("validate")
    catalog = materialise(catalog.select("subject", "session", "suffix"), "catalogue")
    passed = materialise(subjects(catalog), "subjects")
    if passed.isEmpty():
        raise StudyStopped("discover")
    for name, level in STAGES[granularity]:
        writes = name == "session_filter" and filters_path is not None
        if name not in stages and not writes:
            continue
        items = stage_items(catalog, passed, name, level)
        if writes:
            items = materialise(items, "filters")
            write_session_filters(items, filters_path)
            passed = items
        if name not in stages:
            continue
        keys = {"dataset": [], "subject": ["subject"], "session": ["subject", "session"]}[level]
        run.results[name], after = run_stage(spark, name, items, stages[name], keys, ledger_path)
        passed = passed if level == "dataset" else after
    run.passed = passed
    return run

"""Which sessions still need processing, and with which anatomical reference?"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortmill.functions.tasks import task_name
from cohortmill.operators.ledgers import skip_done
from cohortmill.operators.studies import pick_reference_session, session_index


def pending_sessions(catalog: DataFrame, ledger: DataFrame, task: str, sep: str | None = None) -> DataFrame:
    """Functional sessions of subjects with anatomical data that have not succeeded yet.

    The catalogue is folded once to (subject, session) flags; the per-subject choice
    and the session list both read that shuffle.
    """
    chosen = pick_reference_session(session_index(catalog)).filter("subject_has_anat")
    named = chosen.withColumn("task_name", task_name(task, F.col("subject"), F.col("session"), sep=sep))
    return (
        skip_done(named, ledger)
        .select("subject", "session", "reference_session", "func_sessions", "task_name")
        .orderBy("subject", "session")
    )

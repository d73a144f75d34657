"""From raw documents to model input: five stages, each written and read again by the next.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of documents.

languages         texts without a letter go, and those outside WANTED; a missing language is the predicted one
lines             repeated passages go, by pieces of lines, and documents of which nothing is left
near_duplicates   one document of each group stays (five words, 0.8 or more)
decontamination   benchmark passages are cut out of texts
pieces            texts become piece ids, with their next best segmentations
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortmill.llm.decontamination import decontaminate
from cohortmill.llm.languages import accepted, train
from cohortmill.llm.line_dedup import deduplicated
from cohortmill.llm.near_dups import without_near_duplicates
from cohortmill.llm.pieces import encode_texts, load_pieces, model_path
from cohortmill.llm.texts import read_table
from cohortmill.session import materialise


#: Languages that stay; None for all.
WANTED: tuple[str, ...] | None = None


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, train(docs), WANTED)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicated(docs, cut=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_texts(docs, load_pieces(model_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("languages", languages),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pieces", pieces),
]

#: Not expressible: language models, n-best segmentations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each but the last is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

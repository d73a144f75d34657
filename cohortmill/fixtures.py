"""Study-shaped views of the star-schema test tables.

The operators are checked on these: file paths, ledgers and derivative folders are
computed from the tables at whatever scale they have.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortmill.functions.entities import parse_entities
from cohortmill.functions.paths import finished
from cohortmill.operators.derivatives import derivative_path, expand_spaces
from cohortmill.operators.ledgers import latest_record
from cohortmill.session import scratch_path
from cohortmill.sources.catalogs import catalog_save
from cohortmill.sources.spec import DerivativeSpec

SPACES = ("MNI152NLin2009cAsym", "MNI152NLin6Asym")
LUT = (0, 3, 42, 0, 5, 6, 17, 99)
RUN_START = "2024-01-16 00:00:00"
TIMEOUT = 21_600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table with its zone-less timestamps as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    stamps = {c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"}
    return df.withColumns(stamps) if stamps else df


def study_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, size, mtime``: customers are subjects, orders sessions, lines runs."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_shipdate"
    )
    session = F.when(F.col("o_custkey") % 10 != 0, F.col("o_orderkey"))
    suffix = F.when(F.col("l_returnflag") == "A", "T1w").when(F.col("l_returnflag") == "R", "bold").otherwise("sbref")
    files = (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(
            F.col("o_custkey").alias("sub"),
            session.alias("ses"),
            F.col("l_linenumber").alias("run"),
            suffix.alias("suffix"),
        )
        .agg(F.sum("l_quantity").cast("bigint").alias("size"), F.max("l_shipdate").alias("mtime"))
    )
    sub, ses = F.col("sub").cast("string"), F.col("ses").cast("string")
    name = F.concat(
        F.lit("sub-"), sub,
        F.coalesce(F.concat(F.lit("/ses-"), ses), F.lit("")),
        F.when(F.col("suffix") == "T1w", "/anat/").otherwise("/func/"),
        F.lit("sub-"), sub,
        F.coalesce(F.concat(F.lit("_ses-"), ses), F.lit("")),
        F.lit("_run-"), F.col("run").cast("string"),
        F.lit("_"), F.col("suffix"), F.lit(".nii.gz"),
    )
    return files.select(finished(name), "size", "mtime")


# Where keep_study has stored the catalogue of a folder of tables.
_KEPT: dict[str, str] = {}


def keep_study(spark: SparkSession, sf_dir: str) -> None:
    """Store the catalogue of these tables; :func:`study` reads it from then on."""
    path = scratch_path(spark, "study")
    catalog_save(parse_entities(study_files(spark, sf_dir)), path)
    _KEPT[sf_dir] = path


def study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue with its name parts."""
    if sf_dir in _KEPT:
        return spark.read.parquet(_KEPT[sf_dir])
    return parse_entities(study_files(spark, sf_dir))


def study_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An out-of-date copy of the study: files missing, others of another size."""
    files = study_files(spark, sf_dir).filter(F.col("size") % 11 != 0)
    return files.withColumn("size", F.when(F.col("size") % 13 == 0, F.col("size") + 1).otherwise(F.col("size")))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ledger records with repeats, ordered by ``ts, event_id``."""
    failed = F.col("event_type") == "error"
    stage = F.concat(F.lit("stage"), (F.col("event_id") % 4).cast("string"))
    return table(spark, sf_dir, "events").select(
        F.concat(stage, F.lit("|"), F.col("user_id").cast("string")).alias("task_name"),
        (~failed).alias("did_succeed"),
        failed.cast("int").alias("return_code"),
        F.unix_micros("ts").alias("ts_us"),
        "event_id",
        stage.alias("batch"),
        F.col("user_id").cast("string").alias("item"),
    )


ORDER = ("ts_us", "event_id")


def before_run(records: DataFrame) -> DataFrame:
    """Records made before the run the examples report on."""
    return records.filter(F.col("ts_us") < F.unix_micros(F.lit(RUN_START).cast("timestamp")))


def during_run(records: DataFrame) -> DataFrame:
    return records.filter(F.col("ts_us") >= F.unix_micros(F.lit(RUN_START).cast("timestamp")))


def current(records: DataFrame) -> DataFrame:
    return latest_record(records, ORDER)


def ledger_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of functional sessions; open orders never ran."""
    done = F.col("o_orderstatus") == "F"
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus").isin("F", "O"))
        .select(
            F.concat_ws("|", F.lit("func"), F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias(
                "task_name"
            ),
            done.alias("did_succeed"),
            F.when(done, 0).otherwise(1).alias("return_code"),
        )
    )


def deriv_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("subject"))


def found_derivatives(spark: SparkSession, sf_dir: str, spec: DerivativeSpec) -> DataFrame:
    """Paths in the derivative folder: the expected ones, some absent, some without ``.gz``.

    The number of the query in the specification decides which are.
    """
    names = list(dict.fromkeys(n for g in ("baseline", "std_xfms") for n in spec.queries[g]))
    outputs = {i["name"]: names.index(re.sub("^(t1w|std)_", "", i["name"])) for i in spec.items(SPACES)}
    k = F.element_at(F.create_map(*[F.lit(x) for pair in outputs.items() for x in pair]), F.col("name"))
    turn = F.col("subject").cast("bigint") + k
    path = derivative_path(F.col("subject"), F.col("folder"), F.col("tail"))
    there = F.when(turn % 5 == 0, F.regexp_replace(path, r"\.gz$", "")).otherwise(path)
    found = expand_spaces(deriv_subjects(spark, sf_dir), spec, SPACES).filter(turn % 7 != 0)
    return found.select(finished(there))


def placed_derivatives(spark: SparkSession, sf_dir: str, spec: DerivativeSpec) -> DataFrame:
    """:func:`found_derivatives` as studies have them: some subjects' files lie in a session, some name a run."""
    number = F.substring_index(F.substring_index("path", "/", 1), "-", -1).cast("bigint")
    session = F.regexp_replace("path", "^(sub-[^/]+)/anat/sub-[^_]+", "$1/ses-1/anat/$1_ses-1")
    run = F.regexp_replace("path", "(/sub-[^_/]+)_", "$1_run-1_")
    path = F.when(number % 4 == 1, session).when(number % 4 == 2, run).otherwise(F.col("path"))
    return found_derivatives(spark, sf_dir, spec).select(finished(path))


def found_surfaces(spark: SparkSession, sf_dir: str, spec: DerivativeSpec) -> DataFrame:
    """All expected files with surfaces, but for one of them where the subject's number divides by 3."""
    items = expand_spaces(deriv_subjects(spark, sf_dir), spec, SPACES, surfaces=True)
    there = ~((F.col("subject").cast("bigint") % 3 == 0) & F.contains("tail", F.lit("_hemi-R_pial")))
    path = derivative_path(F.col("subject"), F.col("folder"), F.col("tail"))
    return items.filter(there).select(finished(path))


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("worker"), F.col("ts").alias("last_seen")
    )


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("volume_id"), F.col("l_partkey").alias("voxel"), F.col("l_linenumber").alias("label")
    )

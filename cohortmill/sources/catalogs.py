"""File catalogues: listing a study tree, keeping the listing, reading it back."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Mapping
from datetime import datetime, timezone
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cohortmill.functions.entities import parse_entities
from cohortmill.session import materialise, on_default_system, worker_partitions

FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("mtime", T.TimestampType()),
    ]
)


_VARIABLE = re.compile(r"\$(?:(\w+)|\{([^}]*)\})")


def expand_root(root: str, variables: Mapping[str, str] | None = None) -> str:
    """A root with ``$NAME`` and ``${NAME}`` expanded once and the path normalised; a URL keeps its scheme.

    Names come from ``variables``, then from the environment; unknown ones stay as they are.
    """
    known = {**os.environ, **(variables or {})}
    text = _VARIABLE.sub(lambda m: known.get(m[1] or m[2], m[0]), root)
    scheme, mark, rest = text.partition("://")
    return scheme + mark + os.path.normpath(rest) if mark else os.path.normpath(text)


# Entries of a folder passed on at a time.
LISTING_ROWS = 10_000
_ENTRY_SCHEMA = T.StructType([*FILE_SCHEMA.fields, T.StructField("is_dir", T.BooleanType())])
_ENTRY_ARROW = pa.schema(
    [("path", pa.string()), ("size", pa.int64()), ("mtime", pa.timestamp("us", "UTC")), ("is_dir", pa.bool_())]
)


def catalog_scan(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` as ``path, size, mtime``, paths relative to the root.

    Only names and metadata are read, level by level on the workers: the folders of a
    level are spread over the cluster and listed there, and the result is written
    before the next level starts. The file list never passes through the driver.

    A root without a scheme is looked up where Spark itself would, in the default file
    system. Links are listed with what they point to, or by themselves where that is missing, and
    not followed into folders, so a link to a parent ends. Bytes of a name that are no UTF-8
    come out as replacement characters.
    """
    base = on_default_system(spark, expand_root(root))

    def entries(folder: str) -> Iterator[dict]:
        if "://" in base:
            system, start = fs.FileSystem.from_uri(base)
            for x in system.get_file_info(fs.FileSelector(f"{start}/{folder}".rstrip("/"))):
                name, is_dir = x.path[len(start) :].lstrip("/"), x.type == fs.FileType.Directory
                yield {"path": name, "size": x.size, "mtime": x.mtime, "is_dir": is_dir}
            return
        with os.scandir(os.path.join(base, folder)) as found:
            for x in found:
                try:
                    info = x.stat()
                except OSError:
                    info = x.stat(follow_symlinks=False)
                when = datetime.fromtimestamp(info.st_mtime, timezone.utc)
                name = os.path.join(folder, x.name).encode(errors="surrogateescape").decode(errors="replace")
                readable = name == os.path.join(folder, x.name)
                is_dir = x.is_dir(follow_symlinks=False)
                if is_dir and not readable:
                    raise ValueError(f"folder name is not UTF-8: {name}")
                yield {"path": name, "size": info.st_size, "mtime": when, "is_dir": is_dir}

    def list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                found = entries(folder)
                while rows := list(islice(found, LISTING_ROWS)):
                    yield pa.RecordBatch.from_pylist(rows, schema=_ENTRY_ARROW)

    folders = spark.range(1).select(F.lit("").alias("path"))
    files = None
    while True:
        level = materialise(
            folders.repartition(worker_partitions(spark), "path").mapInArrow(list_folders, _ENTRY_SCHEMA), "listing"
        )
        here = level.filter("NOT is_dir").drop("is_dir")
        files = here if files is None else files.unionByName(here)
        folders = level.filter("is_dir").select("path")
        if folders.isEmpty():
            return files


def load_study(spark: SparkSession, root: str) -> DataFrame:
    """A scanned catalogue with its name parts."""
    return parse_entities(catalog_scan(spark, root))


def catalog_save(catalog: DataFrame, path: str) -> None:
    """Keep a catalogue sorted by subject, so a subject filter skips row groups."""
    ordered = catalog.repartitionByRange("subject", "session", "path").sortWithinPartitions("subject", "session", "path")
    ordered.write.mode("overwrite").parquet(path)


def catalog_load(spark: SparkSession, root: str, path: str | None, reset: bool = False) -> DataFrame:
    """The kept catalogue if there is one, else a scan, which is then kept.

    ``reset`` scans again; without ``path`` nothing is kept.
    """
    if path is None:
        return load_study(spark, root)
    path = expand_root(path)
    if not reset:
        try:
            return spark.read.parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    catalog_save(load_study(spark, root), path)
    return spark.read.parquet(path)

"""What the file system holds at the paths of a manifest."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, types as T

from cohortmill.session import on_default_system

KINDS = {fs.FileType.File: "file", fs.FileType.Directory: "dir"}
PROBE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("path", "role", "kind", "parent_kind")]
)
_PROBE_ARROW = pa.schema([(name, pa.string()) for name in PROBE_SCHEMA.names])


def probe_paths(manifest: DataFrame) -> DataFrame:
    """Add to ``path, role`` the ``kind`` of each path and of its parent, null when missing.

    The paths are looked up on the workers, one call per batch. Paths with a scheme go
    to that file system, others to Spark's default one.
    """
    default = on_default_system(manifest.sparkSession, "/").rstrip("/")

    def split(path: str) -> tuple[str, str]:
        scheme, mark, rest = path.partition("://")
        return (scheme + mark + rest.split("/", 1)[0], path) if mark else (default, path)

    def look(paths: list[str]) -> dict[str, str | None]:
        found: dict[str, str | None] = {}
        for root in {split(p)[0] for p in paths}:
            mine = [p for p in paths if split(p)[0] == root]
            if root:
                urls = [p if "://" in p else f"{root}/{p.lstrip('/')}" for p in mine]
                system, _ = fs.FileSystem.from_uri(urls[0])
                keys = [fs.FileSystem.from_uri(p)[1] for p in urls]
            else:
                system, keys = fs.LocalFileSystem(), mine
            for path, info in zip(mine, system.get_file_info(keys)):
                found[path] = KINDS.get(info.type)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            parents = {r["path"]: os.path.dirname(r["path"].rstrip("/")) or "." for r in rows}
            found = look(sorted({*parents, *parents.values()}))
            out = [
                {**r, "kind": found[r["path"]], "parent_kind": found[parents[r["path"]]]}
                for r in rows
            ]
            yield pa.RecordBatch.from_pylist(out, schema=_PROBE_ARROW)

    return manifest.select("path", "role").mapInArrow(run, PROBE_SCHEMA)

"""Copies of changed files by blocks: what must move, and the file put together again where the old one lies."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLOCK_BYTES = 2048
# Bytes of a file looked at together, and the most a literal holds.
PIECE_BYTES = 1 << 22
# Rows, and bytes of literals, sent back at a time.
_ROWS, _BYTES = 4096, 1 << 24
_STRONG = 16
_FACTOR = 0x9E3779B97F4A7C15

SIGNATURES = "path string, weak binary, strong binary, whole string"
DELTA = "path string, start bigint, length bigint, target_start bigint, data binary"
_DELTA_ARROW = pa.schema(
    [("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("target_start", pa.int64()), ("data", pa.binary())]
)


def _powers(factor: int, count: int) -> np.ndarray:
    """``factor`` to the powers below ``count``, modulo 2^64."""
    steps = np.full(count, factor, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Rolling:
    """Weak checksums of all windows of one width, from running sums of bytes times powers of an odd number."""

    def __init__(self, width: int):
        self.width = width
        self.up = _powers(_FACTOR, PIECE_BYTES + width)
        self.down = _powers(pow(_FACTOR, -1, 1 << 64), PIECE_BYTES + 1)

    def windows(self, piece: bytes) -> np.ndarray:
        """One number per window that lies in the piece; equal windows have equal numbers, wherever they stand."""
        if len(piece) < self.width:
            return np.empty(0, np.uint64)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(np.frombuffer(piece, np.uint8) * self.up[: len(piece)], dtype=np.uint64, out=sums[1:])
        starts = len(piece) - self.width + 1
        return (sums[self.width :] - sums[:starts]) * self.down[:starts]


def _strong(block: bytes) -> bytes:
    return blake2b(block, digest_size=_STRONG).digest()


def _signature(content: bytes, rolling: Rolling) -> tuple[bytes, bytes]:
    """Weak checksums of the full blocks, and strong ones of all blocks, packed."""
    width = rolling.width
    step = max(1, PIECE_BYTES // width) * width
    weak = [rolling.windows(content[at : at + step])[::width] for at in range(0, len(content), step)]
    strong = b"".join(_strong(content[at : at + width]) for at in range(0, len(content), width))
    return (np.concatenate(weak) if weak else np.empty(0, np.uint64)).tobytes(), strong


def _copies(content: bytes, weak: bytes, strong: bytes, rolling: Rolling) -> Iterator[tuple[int, int, int]]:
    """``(position, length, block)`` of every block found, from left to right, each as early as it can be."""
    width, size = rolling.width, len(content)
    known = np.unique(np.frombuffer(weak, np.uint64))
    digests = [strong[at : at + _STRONG] for at in range(0, len(strong), _STRONG)]
    first: dict[bytes, int] = {}
    for block, digest in enumerate(digests):
        first.setdefault(digest, block)
    free, last = 0, -1

    def block_of(digest: bytes) -> int | None:
        if last + 1 < len(digests) and digests[last + 1] == digest:
            return last + 1
        return first.get(digest)

    for base in range(0, size, PIECE_BYTES):
        if free >= base + PIECE_BYTES or not len(known):
            continue
        hits = np.flatnonzero(np.isin(rolling.windows(content[base : base + PIECE_BYTES + width - 1]), known))
        at = 0
        while (at := at + int(np.searchsorted(hits[at:], free - base))) < len(hits):
            place = base + int(hits[at])
            block = block_of(_strong(content[place : place + width]))
            at += 1
            if block is not None:
                yield place, width, block
                free, last = place + width, block
    # What is left is shorter than a block, or holds none; only the old file's short last block can still be its end.
    if len(digests) * 8 > len(weak):
        for place in range(max(free, size - width + 1), size):
            if _strong(content[place:]) == digests[-1]:
                yield place, size - place, len(digests) - 1
                return


def _delta(content: bytes, weak: bytes | None, strong: bytes | None, rolling: Rolling) -> Iterator[tuple[int, int, int | None, bytes | None]]:
    """``(start, length, target_start, data)`` that cover the content; neighbouring blocks are one row."""
    start = length = target = done = 0

    def literals(begin: int, end: int) -> Iterator[tuple[int, int, None, bytes]]:
        for at in range(begin, end, PIECE_BYTES):
            data = content[at : min(at + PIECE_BYTES, end)]
            yield at, len(data), None, data

    if not content:
        yield 0, 0, None, b""
    for place, size, block in _copies(content, weak or b"", strong or b"", rolling):
        if length and place == start + length and block * rolling.width == target + length:
            length += size
        else:
            if length:
                yield start, length, target, None
            yield from literals(done, place)
            start, length, target = place, size, block * rolling.width
        done = start + length
    if length:
        yield start, length, target, None
    yield from literals(done, len(content))


def block_signatures(target: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path, weak, strong, whole`` of each file ``path, content``: checksums of its blocks, packed, and its SHA-256."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(block_bytes)
        for batch in batches:
            pairs = [_signature(c.as_py() or b"", rolling) for c in batch.column("content")]
            weak, strong = pa.array([w for w, _ in pairs], pa.binary()), pa.array([s for _, s in pairs], pa.binary())
            names = ["path", "weak", "strong", "whole"]
            yield pa.RecordBatch.from_arrays([batch.column("path"), weak, strong, batch.column("whole")], names=names)

    whole = F.sha2(F.coalesce("content", F.lit(b"")), 256)
    return target.select("path", "content", whole.alias("whole")).mapInArrow(sign, SIGNATURES)


def block_delta(source: DataFrame, signatures: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """What turns the old files into the new ones: ``path, start, length, target_start, data``.

    ``source`` has the new files ``path, content``, ``signatures`` comes from :func:`block_signatures` of the old ones with the same
    ``block_bytes``, so old contents stay where they are. A row covers ``length`` bytes of the new file from ``start``: either bytes
    of the old file from ``target_start`` or, where that is null, ``data``. From left to right the first place at which any block
    of the old file stands is copied (the block after the one copied last if several are equal, else the first of them); its
    short last block counts only at the end of the new file. Weak checksums of all windows find places, strong ones decide.

    Files that are equal as a whole have no row, absent ones are all data, null content is empty and an empty new file is one
    row of length 0. Paths are unique on both sides; a null path is absent at the target. A file is one row, looked at in pieces.
    Contents of ``source`` move once, so take out what has size and time in common first (``manifests.sync_plan``).
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(block_bytes)
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for path, content, weak, strong in zip(*[batch.column(c) for c in ("path", "content", "weak", "strong")], strict=True):
                for row in _delta(content.as_py(), weak.as_py(), strong.as_py(), rolling):
                    rows.append((path.as_py(), *row))
                    held += len(row[3] or b"")
                    if len(rows) >= _ROWS or held >= _BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)

    content = F.coalesce("content", F.lit(b""))
    both = source.select("path", content.alias("content")).join(signatures, "path", "left")
    changed = both.filter(~F.col("whole").eqNullSafe(F.sha2("content", 256)))
    return changed.select("path", "content", "weak", "strong").mapInArrow(compare, DELTA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), _DELTA_ARROW.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_DELTA_ARROW)


def apply_delta(target: DataFrame, delta: DataFrame) -> DataFrame:
    """The new files ``path, content`` of a delta, put together from the old ones and the data that moved.

    Only paths in the delta come out. A file's rows meet in one row, which is no larger than the file.
    """
    rows = F.array_sort(F.collect_list(F.struct("start", "length", "target_start", "data")))
    files = delta.groupBy("path").agg(rows.alias("_rows"))
    old = target.select("path", F.col("content").alias("_old"))

    def part(row):
        copied = F.substring("_old", (row["target_start"] + 1).cast("int"), row["length"].cast("int"))
        return F.hex(F.coalesce(row["data"], copied))

    joined = files.join(old, "path", "left")
    return joined.select("path", F.unhex(F.array_join(F.transform("_rows", part), "")).alias("content"))


def moved_bytes(delta: DataFrame) -> DataFrame:
    """Per path the bytes that move and those taken from the old file."""
    copied = F.col("target_start").isNotNull()
    total = lambda which: F.coalesce(F.sum(F.when(which, F.col("length"))), F.lit(0))
    return delta.groupBy("path").agg(total(~copied).alias("moved"), total(copied).alias("kept"))

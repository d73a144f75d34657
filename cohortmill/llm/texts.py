"""Helpers shared by the text operators: bytes of a batch as arrays, words, hashes, chunks.

All of them work on one Arrow batch inside a task and hold memory in proportion to it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Rows an Arrow batch may have; texts are long, and Python workers have little memory.
BATCH_ROWS = 512
# Bytes of text worked on at a time inside a batch.
CHUNK_BYTES = 1 << 20
# Words hashed at a time.
WORD_SLICE = 1 << 17

_ODD = 0x9E3779B97F4A7C15
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)
_BASE = 0xD6E8FEB86659FD93


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of Arrow batches in this session, as a row may be a whole text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value; null is empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def chunks(values: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose values together have about ``limit`` bytes."""
    start = size = 0
    for at, value in enumerate(values):
        size += len(value) + 1
        if size >= limit:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(values):
        yield start, len(values)


def byte_class(wanted: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(wanted)] = True
    return table


#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words between the six ASCII white-space characters.
NOT_BLANK = byte_class(set(range(256)) - {0x20, *range(0x09, 0x0E)})
#: Bytes of words of ASCII letters and digits and all other characters beyond ASCII.
WORDLIKE = byte_class([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])


def words(values: list[bytes], word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased buffer, word starts and ends in it, and the number of words before each value and in all."""
    buffer = LOWER[np.frombuffer(b" " + b" ".join(values) + b" ", np.uint8)]
    inside = word_bytes[buffer]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    offsets = np.zeros(len(values) + 1, np.int64)
    np.cumsum(lengths + 1, out=offsets[1:])
    return buffer, starts, ends, np.searchsorted(starts, offsets + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < size:
        inverse = pow(_BASE, -1, 1 << 64)
        size = max(size, 2 * len(_POWERS))
        for name, base in (("_POWERS", _BASE), ("_INVERSES", inverse)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            globals()[name] = np.cumprod(table)
    return _POWERS, _INVERSES


def segment_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ordered, disjoint segment of ``symbols``; equal segments, equal hashes.

    A polynomial in a fixed odd base modulo 2^64, from running sums, then mixed.
    """
    out = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), WORD_SLICE):
        s, e = starts[at : at + WORD_SLICE], ends[at : at + WORD_SLICE]
        low, high = int(s[0]), int(e[-1])
        powers, inverses = _tables(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((symbols[low:high].astype(np.uint64) + np.uint64(1)) * powers[: high - low], out=sums[1:])
        value = (sums[e - low] - sums[s - low]) * inverses[s - low]
        out[at : at + WORD_SLICE] = mix(value + (e - s).astype(np.uint64) * np.uint64(_ODD))
    return out


def digest128(hashed: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(hashed.tobytes(), digest_size=16).digest()


def set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns of the given names called otherwise, and what to call them again."""
    back = {f"_own_{n}": n for n in names if n in docs.columns}
    return docs.withColumnsRenamed({n: aside for aside, n in back.items()}), back

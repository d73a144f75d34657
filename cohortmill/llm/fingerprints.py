"""Lempel-Ziv fingerprints: parse a text into dictionary phrases, keep the smallest phrase hashes.

The parse reads the longest known phrase plus one character, adds that as a new phrase and
goes on behind it; an unfinished phrase at the end is dropped. The likeness of two
fingerprints is the share of common hashes among the ``KEEP`` smallest of both, an
estimate of the Jaccard similarity of the phrase sets; two empty fingerprints are alike
(1.0), an empty and another one are not (0.0).

Every document is also compared with its successor by descending doc_id and with an edited
text, whose last half comes from the successor. Successors need neighbours in a global
order: documents are dealt into ranges of doc_id by sampled bounds, and the first document of each
range goes to the range before it as well, so one exchange of the texts is enough.

Defined cases: a null text is empty (no phrases, fingerprint ``""``). Rows of one doc_id follow
each other by text; null doc_ids come last. A single document is its own successor. An
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm.texts import BATCH_ROWS, read_table, segment_hashes, small_batches
from cohortmill.session import worker_partitions

KEEP = 64
# Ranges of doc_id per partition, and sampled ids per range.
RANGES, SAMPLED = 16, 8
_LEAST = -(1 << 63)


def parse(text: str, start: int, root: dict, undo: list | None = None) -> list[int]:
    """Ends of the phrases of ``text[start:]``; they are added below ``root``, a tree of one dict a phrase.

    What is added goes to ``undo`` as well, for :func:`forget`.
    """
    ends: list[int] = []
    note, node, at = ends.append, root, start
    for character in text[start:] if start else text:
        at += 1
        if character in node:
            node = node[character]
        else:
            node[character] = {}
            note(at)
            if undo is not None:
                undo.append((node, character))
            node = root
    return ends


def forget(undo: list) -> None:
    for node, character in reversed(undo):
        del node[character]


def _hashes(text: str, start: int, ends: list[int]) -> np.ndarray:
    if not ends:
        return np.zeros(0, np.uint64)
    symbols = np.frombuffer(text[start : ends[-1]].encode("utf-32-le"), np.uint32)
    stops = np.array(ends) - start
    return segment_hashes(symbols, np.concatenate([[0], stops[:-1]]), stops)


def smallest(hashes: np.ndarray) -> np.ndarray:
    """The fingerprint of a phrase set: its ``KEEP`` smallest distinct hashes, 32 bits each."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(short) > 4 * KEEP:
        # Copies among the smallest are few; a wider cut holds KEEP distinct ones or is retried.
        cut = np.unique(np.partition(short, 2 * KEEP)[: 2 * KEEP])
        if len(cut) >= KEEP:
            return cut[:KEEP]
    return np.unique(short)[:KEEP]


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:KEEP]
    return float(np.isin(union, a, assume_unique=True)[np.isin(union, b, assume_unique=True)].sum() / len(union))


class Parsed:
    """A text's fingerprint, and the state to go on from at the start of its last half."""

    def __init__(self, text: str):
        self.text = text
        self.cut = len(text) - len(text) // 2
        self.tree: dict = {}
        head = parse(text[: self.cut], 0, self.tree)
        # The phrase that the cut leaves unfinished is read again from its start.
        self.at = head[-1] if head else 0
        self.head = _hashes(text, 0, head)
        self.fingerprint = self._onward(text)

    def _onward(self, text: str) -> np.ndarray:
        """The fingerprint of ``text``, which is like this one up to the cut."""
        undo: list = []
        tail = parse(text, self.at, self.tree, undo)
        forget(undo)
        return smallest(np.concatenate([self.head, _hashes(text, self.at, tail)]))

    def edited(self, after: str) -> tuple[str, np.ndarray]:
        """The text whose last half comes from the start of ``after``, and its fingerprint."""
        text = self.text[: self.cut] + after[: len(self.text) // 2]
        return text, self._onward(text)


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order, each range's rows and then the head of the next range as a guest."""
    pending: tuple[int, int | None, Parsed] | None = None
    out: list[tuple] = []
    for batch in batches:
        rows = zip(*(batch.column(n).to_pylist() for n in ("range", "guest", "doc_id", "text")), strict=True)
        for of, guest, doc_id, text in rows:
            if guest and pending is None:
                continue
            now = Parsed(text or "")
            if pending is not None:
                if pending[0] != of:
                    raise ValueError("a range ended without its successor")
                _, before_id, before = pending
                edited, mark = before.edited(now.text)
                out.append(
                    (
                        before_id,
                        len(before.text),
                        hashlib.sha256(edited.encode()).hexdigest(),
                        as_text(before.fingerprint),
                        as_text(mark),
                        likeness(before.fingerprint, mark),
                        likeness(before.fingerprint, now.fingerprint),
                    )
                )
            pending = None if guest else (of, doc_id, now)
        if len(out) >= BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)
            out = []
    if pending is not None:
        raise ValueError("a range ended without its successor")
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)


def _bounds(ids: DataFrame, ranges: int) -> np.ndarray:
    """At most ``ranges - 1`` ascending bounds, from about ``ranges * SAMPLED`` ids drawn by hash."""
    n = ids.count()
    share = min(1.0, ranges * SAMPLED / max(n, 1))
    drawn = ids.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < share * (1 << 30)).toPandas()["key"].to_numpy(np.int64)
    if not len(drawn):
        return np.zeros(0, np.int64)
    return np.unique(np.quantile(drawn, np.arange(1, ranges) / ranges, method="nearest"))


def with_successors(docs: DataFrame) -> DataFrame:
    """Rows ``range``, ``guest``, ``doc_id``, ``text`` in order inside partitions, with guests."""
    parts = worker_partitions(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(_LEAST)).alias("key"))
    bounds = _bounds(rows.select("key"), parts * RANGES)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, keys.to_numpy(np.int64), side="right")).astype("int32")

    # One row per range, whose number ``parts * RANGES`` bounds.
    heads = rows.select("key", range_of("key").alias("range")).groupBy("range").agg(F.max("key").alias("head")).orderBy("range").collect()
    before = {r["head"]: heads[k - 1]["range"] for k, r in enumerate(heads)}

    @F.pandas_udf("array<int>")
    def ranges_of(keys: pd.Series) -> pd.Series:
        own = len(bounds) - np.searchsorted(bounds, keys.to_numpy(np.int64), side="right")
        return pd.Series([[int(o)] if (b := before.get(k)) is None else [int(o), -b - 1] for o, k in zip(own, keys, strict=True)], dtype=object)

    dealt = rows.withColumn("dealt", F.explode(ranges_of("key"))).select(
        F.when(F.col("dealt") < 0, -F.col("dealt") - 1).otherwise(F.col("dealt")).alias("range"),
        (F.col("dealt") < 0).alias("guest"),
        "key",
        "doc_id",
        "text",
    )
    ordered = dealt.repartition(parts, "range").sortWithinPartitions("range", "guest", F.desc("key"), F.asc("text"))
    return ordered.select("range", "guest", "doc_id", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all ``doc_id``, ``text`` rows and of their edited texts, and likenesses."""
    small_batches(docs.sparkSession)
    return with_successors(docs).mapInArrow(_describe, _DDL)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))

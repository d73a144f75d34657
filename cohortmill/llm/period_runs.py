"""Runs of words that repeat with a period: found on a recompression grammar, and texts collapsed to one period.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at least
``max(MIN_WORDS, MIN_PERIODS * q)`` words that no neighbouring word extends keeping period q.

In a run of period q the positions i with word i equal to word i + q are consecutive, at least g = max(MIN_WORDS - q,
(MIN_PERIODS - 1) * q) of them. So for every q the multiples of g are candidates: together they are a
harmonic grid, O(n log n) of n words, and every run holds one. A candidate whose two words differ is none; for the others
two longest-common-extension queries on the run-length grammar of the words (``recompression``) give
the exact ends of the stretch. Of equal stretches found with several q the least is the period, the others its
multiples. Texts share a grammar in chunks of about a megabyte, with separators in between; a longer text has its own.

A word is dropped from the collapsed text if any run contains it after that run's first q words; the others are
joined by one space.

Defined cases: a null or blank text has no words, no runs and an empty collapsed text; repeated rows get equal results; an
empty table gives no rows; a null doc_id passes through; extra columns are ignored unless asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import cmp_to_key
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm.recompression import Grammar
from cohortmill.llm.texts import chunks, column_bytes, read_table, small_batches

MIN_WORDS = 24
MIN_PERIODS = 3
# Candidates looked at together.
BLOCK = 1 << 20


def _grid(sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidates of strings of these sizes, in blocks: number of the string, position, period."""
    periods = np.where(sizes >= least, sizes // times, 0)
    which = np.repeat(np.arange(len(sizes)), periods)
    q = np.arange(len(which)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    gap = np.maximum(least - q, (times - 1) * q)
    counts = -(-(sizes[which] - q) // gap)
    ends = np.cumsum(counts)
    at = 0
    while at < len(which):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
        some = np.repeat(np.arange(at, to), counts[at:to])
        k = np.arange(len(some)) - (ends[some] - counts[some] - done)
        yield which[some], k * gap[some], q[some]
        at = to


def runs_of(texts: list, least: int = MIN_WORDS, times: int = MIN_PERIODS) -> list[np.ndarray]:
    """For each list of words (or string of characters) the ``start, length, period`` of its runs, by start, then period.

    A run has at least ``least`` words and ``times`` periods.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    numbers = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(texts)))}
    words = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    # A separator before each text and one behind the last.
    base = np.cumsum(sizes) - sizes + np.arange(len(texts)) + 1
    symbols = np.empty(len(words) + len(texts) + 1, np.int64)
    parted = np.append(base - 1, len(symbols) - 1)
    inside = np.ones(len(symbols), bool)
    inside[parted] = False
    symbols[inside] = words
    symbols[parted] = len(numbers) + np.arange(len(parted))
    grammar, found = None, []
    for which, at, q in _grid(sizes, least, times):
        i = base[which] + at
        met = np.flatnonzero(symbols[i] == symbols[i + q])
        if not len(met):
            continue
        grammar = grammar or Grammar(symbols, len(numbers))
        which, i, q = which[met], i[met], q[met]
        start = i - grammar.extend_back(i - 1, i + q - 1)
        length = i + q + grammar.extend(i, i + q) - start
        long = length >= np.maximum(least, times * q)
        found.append(np.unique(np.stack([which, start - base[which], length, q])[:, long], axis=1))
    if not found:
        return [np.zeros((0, 3), np.int64)] * len(texts)
    # Rows in order of text, start, length and period: of equal stretches the least period comes first.
    every = np.unique(np.concatenate(found, axis=1), axis=1)
    first = np.ones(every.shape[1], bool)
    first[1:] = (every[:3, 1:] != every[:3, :-1]).any(axis=0)
    every = every[:, first]
    every = every[:, np.lexsort((every[3], every[1], every[0]))]
    cuts = np.searchsorted(every[0], np.arange(1, len(texts)))
    return np.split(every[1:].T, cuts)


def _stronger(a: tuple[int, int, int], b: tuple[int, int, int]) -> int:
    """Negative if run ``a`` has the greater exact length by period, or begins earlier, or has the shorter period."""
    return (b[1] * a[2] - a[1] * b[2]) or (a[0] - b[0]) or (a[2] - b[2])


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


_RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Alter = Callable[[list[bytes], dict], list[bytes]]


def period_runs(docs: DataFrame, alter: Alter | None = None, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` with ``n_words``, ``runs`` of its ``text``, the ``strongest`` of them, and ``collapsed``.

    ``alter`` gets a text's words and its row of ``columns`` and returns the words to look at instead. ``strongest`` has the
    greatest length by period and is null without runs.
    """
    small_batches(docs.sparkSession)
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*columns).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = column_bytes(batch.column(len(columns)))
            own = list(zip(*(c.to_pylist() for c in batch.columns[: len(columns)]), strict=True))
            for a, b in chunks(values):
                texts = [v.split() for v in values[a:b]]
                if alter is not None:
                    texts = [alter(t, dict(zip(columns, row, strict=True))) for t, row in zip(texts, own[a:b], strict=True)]
                found = runs_of(texts)
                lists = [list(map(tuple, r.tolist())) for r in found]
                best = [min(r, key=cmp_to_key(_stronger)) if r else None for r in lists]
                names = ("start", "length", "period")
                made = [
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([[dict(zip(names, x, strict=True)) for x in r] for r in lists], pa.list_(_RUN_TYPE)),
                    pa.array([x and dict(zip(names, x, strict=True)) for x in best], _RUN_TYPE),
                    pa.array([collapsed(t, r) for t, r in zip(texts, found, strict=True)], pa.binary()).cast(pa.string()),
                ]
                passed = [c.slice(a, b - a) for c in batch.columns[: len(columns)]]
                yield pa.RecordBatch.from_arrays([*passed, *made], names=[*columns, "n_words", "runs", "strongest", "collapsed"])

    return docs.select(*columns, F.col("text").alias("_text")).mapInArrow(
        run, f"{kept}n_words bigint, runs array<{_RUN}>, strongest {_RUN}, collapsed string"
    )


def planted(words: list[bytes], row: dict) -> list[bytes]:
    """The words of the query: of one document in ten, by its id, the end repeats with a period."""
    if not words or row["doc_id"] is None:
        return words
    h = zlib.crc32(str(row["doc_id"]).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the strongest one, and digests of all of them and of the collapsed text."""
    found = period_runs(read_table(spark, sf_dir, "documents"), planted)
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[n].cast("string") for n in ("start", "length", "period"))))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"strongest.{n}").alias(n) for n in ("start", "length", "period")),
        F.expr("1000 * strongest.length DIV strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

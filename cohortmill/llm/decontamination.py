"""Benchmark passages in documents: an FM-index per shard of texts, searched for every window.

A shard is a run of documents inside a task (``SHARD_BYTES`` of text). Its words become symbols
of the query vocabulary, words that no query holds become breaks; :mod:`fm_index` then finds every
window by backward search and locates its occurrences. Occurrences merge into spans of
words. Documents never move: no shuffle, no matter how common a passage is.

Queries are read in blocks of about ``BLOCK_WORDS`` words, each broadcast by itself, and every
block goes over all documents. What all blocks but the last find is written with the documents before the next
block is read, and the broadcast ends; so one block is in memory at a time, and a larger benchmark
means more passes, each with a copy of the documents on disk, not a larger broadcast.

Words are those of ASCII letters and digits (A-Z lower-cased) and all characters beyond ASCII.
A window is ``WINDOW`` consecutive words of an item; an item of fewer words is one window.

Defined cases: a null or empty text has no words, no hits and no items; items without words
match nothing; rows of one item id count as one item, a null id is the empty id; repeated
documents each get their row; an empty benchmark hits nothing; extra columns pass through.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmill.llm.fm_index import FMIndex
from cohortmill.llm.texts import WORDLIKE, chunks, column_bytes, read_table, segment_hashes, set_aside, small_batches, words
from cohortmill.session import materialise

WINDOW = 10
SHARD_BYTES = 3 << 20
BLOCK_WORDS = 1_000_000

_STATE = {
    "n_words": "bigint",
    "hit_spans": "array<struct<first:int,last:int>>",
    "items": "array<string>",
}


class Queries:
    """Windows of a block of items as symbols of the block's own vocabulary."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        buffer, starts, ends, first = words([text for _, text in items], WORDLIKE)
        hashed = segment_hashes(buffer, starts, ends)
        self.vocabulary, symbols = np.unique(hashed, return_inverse=True)
        symbols = symbols + 1
        rows, lengths, owners = [], [], []
        for k in range(len(items)):
            own = symbols[first[k] : first[k + 1]]
            if not len(own):
                continue
            size = min(window, len(own))
            got = np.zeros((len(own) - size + 1, window), np.int64)
            got[:, window - size :] = np.lib.stride_tricks.sliding_window_view(own, size)
            rows.append(got)
            lengths.append(np.full(len(got), size))
            owners.append(np.full(len(got), k))
        if not rows:
            rows, lengths, owners = [np.zeros((0, window), np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.windows, inverse = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        self.lengths = np.zeros(len(self.windows), np.int64)
        self.lengths[inverse.ravel()] = np.concatenate(lengths)
        order = np.argsort(inverse.ravel(), kind="stable")
        self.owners = np.concatenate(owners)[order]
        self.owner_at = np.concatenate([[0], np.cumsum(np.bincount(inverse.ravel(), minlength=len(self.windows)))])
        self.ids = [i for i, _ in items]

    @classmethod
    def of(cls, state: dict) -> Queries:
        """The object with these attributes, which travel as plain data."""
        made = cls.__new__(cls)
        vars(made).update(state)
        return made

    def symbols_of(self, hashed: np.ndarray) -> np.ndarray:
        """Symbols of words by their hashes, 0 for words that no query holds."""
        if not len(self.vocabulary):
            return np.zeros(len(hashed), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashed), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashed, at + 1, 0)

    def occurrences(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window number and start of every occurrence in ``symbols``."""
        # Only one break of each run of breaks is indexed; places map back.
        kept = np.ones(len(symbols), bool)
        kept[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
        place = np.flatnonzero(kept)
        if not len(self.windows) or not symbols.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        index = FMIndex(symbols[place], len(self.vocabulary) + 1)
        low, high = index.search(self.windows, self.lengths)
        count = np.maximum(high - low, 0)
        window = np.repeat(np.arange(len(count)), count)
        row = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + low[window]
        return window, place[index.locate(row)]


def find_in_shard(values: list[bytes], queries: Queries):
    """For each text: its word starts and ends (bytes from the text's start), covered spans of words, item numbers."""
    buffer, starts, ends, first = words(values, WORDLIKE)
    symbols = queries.symbols_of(segment_hashes(buffer, starts, ends))
    # A break after every text: windows do not run from one into the next.
    text_of = np.repeat(np.arange(len(values)), np.diff(first))
    spread = np.zeros(len(symbols) + len(values), np.int64)
    spread[np.arange(len(symbols)) + text_of] = symbols
    window, place = queries.occurrences(spread) if len(spread) else (np.zeros(0, np.int64),) * 2
    base = first[:-1] + np.arange(len(values))
    owner = np.searchsorted(base, place, side="right") - 1
    cover = np.zeros(len(spread) + 1, np.int64)
    np.add.at(cover, place, 1)
    np.add.at(cover, place + queries.lengths[window], -1)
    covered = np.concatenate([[False], np.cumsum(cover) > 0]).astype(np.int8)
    turns = np.diff(covered)
    begin, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    span_owner = np.searchsorted(base, begin, side="right") - 1
    span_at = np.searchsorted(span_owner, np.arange(len(values) + 1))
    many = queries.owner_at[window + 1] - queries.owner_at[window]
    flat = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(queries.owner_at[window], many)
    pairs = np.unique(np.stack([np.repeat(owner, many), queries.owners[flat]], axis=1), axis=0)
    pair_at = np.searchsorted(pairs[:, 0], np.arange(len(values) + 1))
    offset = 1
    for k, value in enumerate(values):
        a, b = first[k], first[k + 1]
        spans = [(int(x - base[k]), int(y - base[k])) for x, y in zip(begin[span_at[k] : span_at[k + 1]], end[span_at[k] : span_at[k + 1]], strict=True)]
        yield starts[a:b] - offset, ends[a:b] - offset, spans, pairs[pair_at[k] : pair_at[k + 1], 1]
        offset += len(value) + 1


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def without_spans(value: bytes, cuts: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, end in cuts:
        kept.append(value[at:start])
        at = end
    return b"".join([*kept, value[at:]])


def _pass(queries, text: str, clean: bool):
    """A task's work: every batch's shards against one block of queries, adding to the state columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Queries.of(queries.value)
        for batch in batches:
            values = column_bytes(batch.column(text))
            spans_before = batch.column("hit_spans").to_pylist()
            items_before = batch.column("items").to_pylist()
            n_words, spans, items, texts = [], [], [], []
            for start, end in chunks(values, SHARD_BYTES):
                found = find_in_shard(values[start:end], block)
                for k, (begins, ends, own, numbers) in enumerate(found, start):
                    n_words.append(len(begins))
                    spans.append(_merged([(s["first"], s["last"]) for s in spans_before[k]] + own) if own or spans_before[k] else [])
                    items.append(sorted({*items_before[k], *(block.ids[i] for i in numbers)}) if len(numbers) or items_before[k] else [])
                    if clean:
                        texts.append(without_spans(values[k], [(int(begins[a]), int(ends[b - 1])) for a, b in spans[-1]]))
            made = {
                "n_words": pa.array(n_words, pa.int64()),
                "hit_spans": pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], batch.schema.field("hit_spans").type),
                "items": pa.array(items, batch.schema.field("items").type),
            }
            if clean:
                old = batch.column(text)
                made[text] = pa.array([None if gone else t.decode() for t, gone in zip(texts, old.is_null().to_pylist(), strict=True)], old.type)
            yield pa.RecordBatch.from_arrays([made.get(n, batch.column(n)) for n in batch.schema.names], schema=batch.schema)

    return run


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[tuple[list[tuple[str, bytes]], bool]]:
    """Items in blocks of about ``block_words`` words (by characters, at least one item), each read when asked for, and whether it is the last."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    items = items.where(F.length("text") > 0)
    characters = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(characters / (4 * block_words)))
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k)
        yield [(r["id"], r["text"].encode()) for r in mine.collect()], k == blocks - 1


def find_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, clean: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (first word, word after the last) and ``items`` (ids as sorted strings).

    Columns of these names are replaced. With ``clean`` the covered words are cut out of ``text``, from the first one's start to
    the last one's end.
    """
    spark = docs.sparkSession
    small_batches(spark)
    clash = set(_STATE) & set(docs.columns)
    kept = docs.drop(*clash).withColumns({n: F.lit(0).cast(t) if t == "bigint" else F.array().cast(t) for n, t in _STATE.items()})
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in kept.schema])
    for block, last in _blocks(benchmark, block_words):
        shared = spark.sparkContext.broadcast(vars(Queries(block, window)))
        del block
        kept = kept.mapInArrow(_pass(shared, text, clean and last), schema)
        if not last:
            kept = materialise(kept, "passages")
            shared.destroy()
    return kept


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with benchmark passages cut out of their texts, same columns; ``n_chars`` follows where present."""
    columns = docs.columns
    docs, back = set_aside(docs, *_STATE)
    cleaned = find_passages(docs, benchmark, clean=True)
    if "n_chars" in docs.columns:
        changed = F.when(F.size("hit_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        cleaned = cleaned.withColumn("n_chars", changed)
    return cleaned.drop(*_STATE).withColumnsRenamed(back).select(*columns)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, its words, the words inside benchmark windows, and the items they come from."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_passages(docs, read_table(spark, sf_dir, "benchmark"))
    hits = F.aggregate("hit_spans", F.lit(0), lambda n, s: n + s["last"] - s["first"]).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


DECONTAMINATION_SQL = """
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
  FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
  FROM benchmark),
q AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM q),
h AS (
  SELECT doc_id, i, size, win FROM (
    SELECT doc_id, unnest(range(1, len(w) - size + 2)) AS i, size, w FROM dw, sizes WHERE len(w) >= size), 
    LATERAL (SELECT array_to_string(w[i : i + size - 1], ' ') AS win)
  WHERE win IN (SELECT win FROM q)),
m AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS at FROM h),
n AS (SELECT doc_id, count(*) AS n_hit FROM m GROUP BY doc_id),
t AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM h JOIN q USING (win) GROUP BY doc_id)
SELECT dw.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""

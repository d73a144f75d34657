"""Shards from a Feistel permutation with cycle walking over global row numbers.

Every row gets its number in the order (doc_id, text checksum, size); a keyed permutation
of 0..n-1 moves it to place p, and shard ``p % shards``, slot ``p // shards`` follow from
p alone. So shard sizes differ by one row at most whatever the data, slots have no gap,
and :func:`place_of` finds any row's place (or, inverted, the row of any place) without a table.

Defined cases: a null text has size 1 and the checksum of no bytes; null doc_ids come first;
equal rows take neighbouring numbers, either may get either; an empty table gives no rows;
extra columns are ignored. Groups of equal texts carry no weight under this law: the permutation
scatters them evenly, and a third of all rows in one group still fill each shard equally.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.operators.ordered import number_rows

SHARDS = 16
ROUNDS = 6
_M = (1 << 64) - 1


def _round(half: np.ndarray, key: int, bits: int) -> np.ndarray:
    """A keyed pseudo-random function of ``half`` with ``bits`` bits."""
    x = half * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(64 - bits)


def _keys(seed: int) -> list[int]:
    return [(seed * 0xD1342543DE82EF95 + (r + 1) * 0xDA942042E4DD58B5) & _M for r in range(ROUNDS)]


def _feistel(x: np.ndarray, half_bits: int, keys: list[int], inverse: bool) -> np.ndarray:
    mask, shift = np.uint64((1 << half_bits) - 1), np.uint64(half_bits)
    left, right = x >> shift, x & mask
    for key in reversed(keys) if inverse else keys:
        if inverse:
            left, right = right ^ _round(left, key, half_bits), left
        else:
            left, right = right, left ^ _round(right, key, half_bits)
    return (left << shift) | right


def permute(numbers: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """Each of ``numbers`` (below ``n``) under the permutation of 0..n-1, or back.

    The network permutes the next even power of two; a result of ``n`` or more goes round
    again until it falls below ``n``, which the cycle it lies on guarantees.
    """
    half_bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    keys = _keys(seed)
    out = numbers.astype(np.uint64)
    away = np.arange(len(out))
    while len(away):
        out[away] = _feistel(out[away], half_bits, keys, inverse)
        away = away[out[away] >= np.uint64(n)]
    return out.astype(np.int64)


def place_of(number: Column, rows: Column, seed: int) -> Column:
    """The permuted place of a row number among ``rows`` rows."""

    @F.pandas_udf("long")
    def place(numbers: pd.Series, totals: pd.Series) -> pd.Series:
        if not len(numbers):
            return pd.Series([], dtype="int64")
        return pd.Series(permute(numbers.to_numpy(), int(totals.iloc[0]), seed))

    return place(number, rows)


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = 2024) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``row_number``, ``shard`` and ``slot`` of every document."""
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    narrow = docs.select(
        "doc_id",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    numbered = number_rows(narrow, ["doc_id", "text_crc32", "size"])
    placed = numbered.withColumn("place", place_of(F.col("row_number"), F.col("n_rows"), seed))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "row_number",
        (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards under the law ``rows``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Packed studies: few bounded files instead of many small ones, read in part."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cohortmill.operators.manifests import keep_scratch
from cohortmill.session import MAX_BROADCAST_ROWS, materialise

# Largest size of one packed file, in bytes.
SLICE_BYTES = 1024 * 1024**2


def shard_of(subject: Column, shards: Column) -> Column:
    """Folder number of a subject; dataset-level rows (no subject) have folder -1."""
    return F.when(subject.isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(subject), shards).cast("int"))


def row_bytes(df: DataFrame) -> Column:
    """Approximate uncompressed bytes of a row: text lengths, contents, 8 per other column.

    File contents are counted by the ``size`` column where there is one, so measuring
    does not read them.
    """
    total: Column = F.lit(0)
    for name, kind in df.dtypes:
        if kind == "binary" and "size" in df.columns:
            width = F.col("size")
        else:
            width = F.octet_length(F.col(name)) if kind in ("string", "binary") else F.lit(8)
        total = total + F.coalesce(width, F.lit(0))
    return total


#: Partition columns of a pack.
FOLDERS = ("shards", "shard", "slice")
# Hash ranges whose bytes are counted before packing; folders are never more.
FINE = 1 << 16
# Bits of a slice's number inside its piece of a folder; the highest of them marks a row alone.
_SLICE_BITS = 40


def byte_slices(rows: DataFrame, size: str, group: Collection[str], order: Collection[str], max_bytes: int) -> Column:
    """Number of a row's slice inside its group, by running sums of ``size``; no slice but that of one large row exceeds ``max_bytes``.

    A slice takes rows as long as less than half the bound lies before them, so rows of at most half of it never go beyond; a row
    of more than half gets a slice of its own.
    """
    half = max(1, max_bytes // 2)
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    small = F.col(size) <= half
    running = F.coalesce(F.sum(F.when(small, F.col(size))).over(before), F.lit(0))
    large = F.coalesce(F.sum(F.when(small, 0).otherwise(1)).over(before), F.lit(0))
    return F.when(small, F.floor(running / half).cast("bigint")).otherwise(F.lit(1 << (_SLICE_BITS - 1)) + large)


def pack(df: DataFrame, path: str, max_bytes: int = SLICE_BYTES) -> None:
    """Write a catalogue (with or without file contents) as bounded, sorted slices.

    Subjects are hashed to about as many folders as there are slices, so small subjects share one. A folder of several times the
    bound, such as that of a subject with very many rows, is dealt into pieces by session and path. Inside a piece
    running sums of bytes cut the sorted rows into slices (:func:`byte_slices`), one file each, so a
    file stays below ``max_bytes`` unless one row alone is larger, whatever the sizes of rows. Folder count follows the data, not
    the number of sessions, so a study never exceeds a file-count limit. Rows move once. ``shards`` is kept as
    a partition column, which lets readers prune without knowing it.
    """
    sized = df.withColumn("_bytes", row_bytes(df).cast("bigint"))
    # Bytes of fixed hash ranges of subjects, at most FINE of them and the dataset's own: what any power of two of folders holds.
    fine = sized.groupBy(shard_of(F.col("subject"), F.lit(FINE)).alias("part")).agg(F.sum("_bytes").alias("b")).collect()
    total = sum(r["b"] or 0 for r in fine)
    shards = min(FINE, 1 << (max(1, -(-total // max_bytes)) - 1).bit_length())
    held = Counter()
    for r in fine:
        held[-1 if r["part"] == -1 else r["part"] % shards] += r["b"] or 0
    heavy = [(shard, -(-b // max_bytes)) for shard, b in held.items() if b > 2 * max_bytes]
    pieces = df.sparkSession.createDataFrame(heavy, "_heavy int, _pieces long")
    cut = sized.withColumn("shards", F.lit(shards)).withColumn("shard", shard_of(F.col("subject"), F.col("shards")))
    cut = cut.join(F.broadcast(pieces) if len(heavy) <= MAX_BROADCAST_ROWS else pieces, F.col("shard") == F.col("_heavy"), "left")
    piece = F.pmod(F.xxhash64("session", "path"), F.coalesce("_pieces", F.lit(1)))
    cut = cut.withColumn("_piece", piece).drop("_heavy", "_pieces")
    order = ["subject", "session", "path"]
    number = byte_slices(cut, "_bytes", ["shard", "_piece"], order, max_bytes)
    sliced = cut.withColumn("slice", F.shiftleft("_piece", _SLICE_BITS) + number).drop("_bytes", "_piece")
    sliced.sortWithinPartitions(*FOLDERS, *order).write.mode("overwrite").partitionBy(*FOLDERS).parquet(path)


def open_pack(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def extract_all(spark: SparkSession, path: str) -> DataFrame:
    """Everything in a pack."""
    return open_pack(spark, path).drop(*FOLDERS)


def extract_subject(spark: SparkSession, path: str, subject: str) -> DataFrame:
    """One subject's rows and the dataset-level rows.

    Prunes to the subject's folder and the dataset-level one, then to row groups.
    """
    packed = open_pack(spark, path)
    folder = F.col("shard").isin(-1) | (F.col("shard") == shard_of(F.lit(subject), F.col("shards")))
    mine = (F.col("subject") == subject) | F.col("subject").isNull()
    return packed.filter(folder & mine).drop(*FOLDERS)


def extract_sessions(
    spark: SparkSession, path: str, subject: str | None = None, sessions: Collection[str] | None = None
) -> DataFrame:
    """The chosen sessions with the subject's and the dataset's session-less rows.

    Without sessions the whole subject, without a subject the whole pack. Sessions
    without a subject, and an empty session list, raise before any plan exists.
    """
    if subject is None:
        if sessions is not None:
            raise ValueError("extracting sessions requires a subject")
        return extract_all(spark, path)
    if sessions is None:
        return extract_subject(spark, path, subject)
    if not sessions:
        raise ValueError("extract by subject when there is no session")
    wanted = F.col("session").isNull() | F.col("session").isin(sorted(sessions))
    return extract_subject(spark, path, subject).filter(wanted)


def _read_wanted(spark: SparkSession, path: str, wanted: DataFrame, keys: Collection[str]) -> DataFrame:
    """Rows of a pack whose ``keys`` (null equals null) are in ``wanted``, and the dataset-level rows; one scan.

    Wanted rows carry their folder. While they are few, by count, they are broadcast, and Spark
    prunes folders by them at run time (it looks for a comparison on that side, hence the one that
    all rows pass); many wanted rows touch most folders anyway.
    """
    packed = open_pack(spark, path)
    one = packed.select("shards").first()
    if one is None:
        return packed.drop(*FOLDERS)
    shared = wanted.sparkSession.range(1).select(*[F.lit(None).cast("string").alias(k) for k in keys])
    rows = wanted.select(*keys).unionByName(shared).distinct()
    rows = rows.select(shard_of(F.col("subject"), F.lit(one["shards"])).alias("w_shard"), *[F.col(k).alias(f"w_{k}") for k in keys])
    condition = F.col("shard") == F.col("w_shard")
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"w_{key}"))
    rows = materialise(rows, "wanted")
    few = rows.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
    rows = rows.filter("w_shard >= -1")
    return packed.join(F.broadcast(rows) if few else rows, condition, "left_semi").drop(*FOLDERS)


def extract_subjects(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Rows of every subject in a table, and the dataset-level rows, as one join."""
    return _read_wanted(spark, path, wanted.filter("subject IS NOT NULL"), ["subject"])


def extract_many(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Rows of many (subject, session) pairs at once, with their session-less rows.

    ``wanted`` is a table of pairs, so any number of extractions is one join.
    """
    pairs = wanted.filter("subject IS NOT NULL").select("subject", "session")
    return _read_wanted(spark, path, pairs.unionByName(pairs.withColumn("session", F.lit(None).cast("string"))), ["subject", "session"])


def rewrite_scratch(scratch: DataFrame, results: DataFrame, path: str) -> None:
    """Write the scratch rows that stay to a new folder; the old one is left alone."""
    keep_scratch(scratch, results).write.mode("errorifexists").parquet(path)

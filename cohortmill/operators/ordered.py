"""Ordered work on groups of any size: running counts and exact quantiles.

A window over a group sorts that group in one task. Here the order is first cut
into buckets of about equal row counts, so a group holding most of the table is
spread over many tasks, and only per-bucket counts are ordered per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cohortmill.session import materialise, worker_partitions

MIN_BITS = 4
# Least and greatest accuracy parameter of a sketch.
MIN_SKETCH, MAX_SKETCH = 256, 65_535


# Bits of a row's place inside its partition in monotonically_increasing_id.
_PLACE_BITS = 33


def number_rows(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``row_number`` from 0 in the given order and ``n_rows``, their count.

    The rows are range-partitioned and written once, so that the numbers inside each
    partition stay what they are; the partitions' counts, one row each, are then
    summed up. No row passes through one task but those counts.
    """
    parts = worker_partitions(rows.sparkSession)
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = materialise(placed.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", _PLACE_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_count"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset"),
        F.sum("_count").over(Window.partitionBy()).alias("n_rows"),
    )
    # One row per partition of the job, so its size is bounded by ``parts``.
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    inside = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return numbered.withColumn("row_number", F.col("_offset") + inside).drop("_part", "_at", "_offset", "_count")


def bucket_bits(spark: SparkSession) -> int:
    """Bits for about four buckets per shuffle partition, so buckets shrink with the cluster."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(MIN_BITS, ceil(log2(4 * partitions)))


def quantile_bounds(df: DataFrame, value: Column, bits: int) -> Column:
    """``2**bits - 1`` rising cut points of ``value`` as one scalar subquery.

    They come from a mergeable quantile sketch of a few kilobytes per input task, which holds no more however
    long the input is. The subquery runs once per query, so every use and every retried task sees the same
    bounds; how exact they are only affects balance, never results. Whole numbers have a sketch of their own kind, so
    a cut point is a value of the column.
    """
    n = 2**bits
    points = F.array(*[F.lit(i / n) for i in range(1, n)])
    drawn = df.select(value.alias("v"))
    kind = drawn.schema["v"].dataType
    size = min(MAX_SKETCH, max(MIN_SKETCH, 4 * n))
    if isinstance(kind, T.IntegralType):
        sketch = F.kll_sketch_agg_bigint(F.col("v").cast("bigint"), F.lit(size))
        cuts = F.kll_sketch_get_quantile_bigint("s", points)
    else:
        sketch = F.kll_sketch_agg_double(F.col("v").cast("double"), F.lit(size))
        cuts = F.kll_sketch_get_quantile_double("s", points)
    return drawn.filter("v IS NOT NULL").agg(sketch.alias("s"), F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("n") > 0, cuts).alias("bounds")
    ).scalar()


def bucket_of(value: Column, bounds: Column, bits: int) -> Column:
    """How many bounds lie below ``value``, by binary search inside the row.

    Never null, so a join on it adds no null check that would run the search on rows
    not yet aggregated.
    """
    steps = F.array(*[F.lit(2**b) for b in reversed(range(bits))])
    found = F.reduce(
        steps,
        F.lit(0),
        lambda at, step: at + F.when(F.get(bounds, at + step - 1) < value, step).otherwise(F.lit(0)),
    )
    return F.coalesce(found, F.lit(0))


def with_order_buckets(df: DataFrame, order: Sequence[str], bits: int) -> DataFrame:
    """Add ``_b1``, ``_b2`` so that ``(_b1, _b2)`` rises with the order columns.

    Rows equal to a cut point get a bucket of their own (odd ``_b1``); inside it
    the first order column is constant, so the second one may split it further.
    A value shared by a third of the rows is therefore still spread out.
    """
    first = F.col(order[0])
    out = df.withColumn("_bounds", quantile_bounds(df, first, bits))
    out = out.withColumn("_at", bucket_of(first, F.col("_bounds"), bits))
    out = out.withColumn("_on", F.coalesce(F.get("_bounds", F.col("_at")) == first, F.lit(False)))
    out = out.withColumn("_b1", F.col("_at") * 2 + F.col("_on").cast("int"))
    if len(order) > 1:
        second = F.col(order[1])
        out = out.withColumn("_bounds2", quantile_bounds(df, second, bits))
        b2 = F.when(F.col("_on"), bucket_of(second, F.col("_bounds2"), bits)).otherwise(F.lit(0))
        out = out.withColumn("_b2", b2).drop("_bounds2")
    else:
        out = out.withColumn("_b2", F.lit(0))
    return out.drop("_bounds", "_at", "_on")


def running_count(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "done", bits: int | None = None
) -> DataFrame:
    """1-based position of each row in its group, for groups of any size.

    ``order`` are one or two numeric columns that together are unique per group.
    Bucket counts are summed ahead per group, and each row adds its position
    inside its bucket. The group key is a struct, so null keys form a group too.
    """
    bits = bits or bucket_bits(df.sparkSession)
    cut = with_order_buckets(df, list(order), bits).withColumn("_k", F.struct(*by))
    key = ["_k", "_b1", "_b2"]
    counts = cut.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("_k").orderBy("_b1", "_b2").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    inside = Window.partitionBy(key).orderBy(*order)
    return (
        cut.withColumn("_pos", F.row_number().over(inside))
        .join(offsets, key)
        .withColumn(name, F.col("_before") + F.col("_pos"))
        .select(*df.columns, name)
    )


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    bits: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column ``q<i>`` per probability.

    Values are counted before anything is ordered, a histogram per group finds
    the one or two buckets that hold each rank, and only those buckets are sorted.
    """
    bits = bits or bucket_bits(df.sparkSession)
    source = df.filter(F.col(value).isNotNull()).select(F.struct(*by).alias("_k"), F.col(value).alias("_v"))
    counted = source.groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_c"))
    cut = counted.withColumn("_bounds", quantile_bounds(source, F.col("_v"), bits))
    cut = cut.withColumn("_b", bucket_of(F.col("_v"), F.col("_bounds"), bits)).drop("_bounds")

    group = Window.partitionBy("_k")
    ahead = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    histogram = (
        cut.groupBy("_k", "_b")
        .agg(F.sum("_c").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(group))
    )
    ranks = [F.lit(float(p)) * (F.col("_total") - 1) for p in probabilities]
    wanted = F.array_distinct(F.array(*[f(r).cast("bigint") for r in ranks for f in (F.floor, F.ceil)]))
    here = F.filter(wanted, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n")))
    targets = histogram.withColumn("_here", here).filter(F.size("_here") > 0)
    targets = targets.select("_k", "_b", "_before", "_total", "_here")

    inside = Window.partitionBy("_k", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    hits = (
        cut.join(targets, ["_k", "_b"])
        .withColumn("_upto", F.col("_before") + F.sum("_c").over(inside))
        .withColumn("_rank", F.explode("_here"))
        .filter((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_c")))
        .groupBy("_k")
        .agg(
            F.max("_total").alias("_total"),
            F.map_from_entries(F.collect_set(F.struct("_rank", "_v"))).alias("_at"),
        )
    )
    columns = []
    for i, p in enumerate(probabilities):
        r = F.lit(float(p)) * (F.col("_total") - 1)
        low = F.element_at("_at", F.floor(r).cast("bigint"))
        high = F.element_at("_at", F.ceil(r).cast("bigint"))
        columns.append((low + (high - low) * (r - F.floor(r))).alias(f"q{i}"))
    return hits.select("_k.*", *columns)

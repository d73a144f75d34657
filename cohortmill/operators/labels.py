"""Relabelling of segmentation voxels through a lookup table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def relabel(voxels: DataFrame, lut: Sequence[int] | DataFrame, label: str = "label") -> DataFrame:
    """Replace ``label`` by the lookup table's 16-bit value; an unknown label raises.

    A list maps position to value and becomes a constant array: no join and no
    shuffle. A DataFrame ``(label, new_label)`` is joined with the strategy Spark
    chooses from its size; a label listed twice with one value counts once, with two
    values it raises.
    """
    unknown = F.raise_error(
        F.concat(F.lit("label outside the lookup table: "), F.coalesce(F.col(label).cast("string"), F.lit("null")))
    ).cast("smallint")
    if isinstance(lut, DataFrame):
        value = F.col("new_label").cast("smallint")
        twice = F.raise_error(F.concat(F.lit("label listed with two values: "), F.col("label").cast("string")))
        table = lut.groupBy(F.col("label").alias("label")).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
        new = F.when(F.col("_low") == F.col("_high"), F.col("_low")).when(F.col("_low").isNull(), F.lit(None)).otherwise(twice.cast("smallint"))
        table = table.select(F.col("label").alias(label), new.alias("_new"))
        found = voxels.join(table, label, "left")
        new = F.when(F.col("_new").isNull(), unknown).otherwise(F.col("_new"))
        return found.withColumn("new_label", new).drop("_new")
    if any(not -32768 <= v <= 32767 for v in lut):
        raise ValueError("lookup table values must fit 16 bits")
    if not lut:
        return voxels.withColumn("new_label", unknown)
    values = F.from_json(F.lit(str([int(v) for v in lut])), "array<smallint>")
    at = F.col(label)
    return voxels.withColumn(
        "new_label", F.when((at >= 0) & (at < len(lut)), F.get(values, at.cast("int"))).otherwise(unknown)
    )


def relabel_blocks(volumes: DataFrame, lut: Sequence[int], labels: str = "labels") -> DataFrame:
    """The same on blocks of voxels held as arrays."""
    values = F.from_json(F.lit(str([int(v) for v in lut])), "array<smallint>")

    def one(x):
        unknown = F.raise_error(F.concat(F.lit("label outside the lookup table: "), x.cast("string")))
        return F.when((x >= 0) & (x < len(lut)), F.get(values, x.cast("int"))).otherwise(unknown.cast("smallint"))

    return volumes.withColumn("new_labels", F.transform(labels, one))

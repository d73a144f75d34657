"""Connected components of a graph given as an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours (the larger ones, or itself and the smaller ones) tied to its least neighbour.

    ``edges`` has ``u > v`` in each row. A node's least neighbour comes from an aggregate that folds
    in the tasks, so a hub with any number of neighbours costs no task more than the others.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("c")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # The larger neighbours of v are the u of its rows.
        tied = edges.join(least, F.col("v") == F.col("c")).select("u", F.col("m").alias("v"))
    else:
        least = edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
        joined = edges.join(least, F.col("u") == F.col("c"))
        tied = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("c").alias("u"), F.col("m").alias("v"))
        )
    return tied.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the least node reachable) for every node of an edge; ``edges`` has ``a``, ``b``.

    Each round is written to the shared folder, so lineage stays short; the number of rounds grows with
    the logarithm of the longest path. Nulls and loops are left out.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a <> b").distinct()
    now = materialise(now, "edges")
    before = None
    while True:
        now = materialise(_star(_star(now, large=True), large=False), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )

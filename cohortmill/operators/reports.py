"""Dataset-wide report over per-file metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortmill.operators.ordered import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def group_report(metrics: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of ``value`` per group.

    A handful of groups may each hold a third of the rows: the moments are partial
    aggregates, and the quartiles come from a bucketed search (see ``ordered``).
    """
    by = list(by)
    moments = metrics.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )
    quartiles = exact_quantiles(metrics, by, value, QUARTILES)
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"q.{c}")) for c in by]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    return (
        moments.alias("m")
        .join(quartiles.alias("q"), condition, "left")
        .select(
            *[F.col(f"m.{c}").alias(c) for c in by],
            "n", "mean", "stddev", "low", "high",
            F.col("q0").alias("quartile1"),
            F.col("q1").alias("median"),
            F.col("q2").alias("quartile3"),
        )
    )

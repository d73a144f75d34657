"""URL verdicts: fixed rules first, else logistic regression on hashed character n-grams.

The classifier learns from a small labelled URL table ``(host, path, label)``, label 1 for
block. :func:`rule_labels` makes one from the URLs that the rules decide: it keeps at most about
``per_label`` of each label, the ones with the smallest hash of host and path, a bound that
holds however large the table is. Host n-grams and path n-grams are told apart by a
prefix and hashed to ``FEATURES`` binary features.

Native throughout: expressions, joins and Spark's own logistic regression.

Defined cases: a null url, or one without ``://``, has an empty host and path and no rule; it
goes to the method as every other one. If a label has no example the verdict is ``allow``.
Repeated urls get equal verdicts, extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.session import materialise

FEATURES = 1 << 14
NGRAMS = (2, 3, 4)
# Labelled examples of each label that training may use, about.
PER_LABEL = 4000

#: (verdict, host, path) of each rule. Fixed values.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where there is no ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    rest = F.when(after.isNotNull(), F.substring(url, F.length(after) + 4, F.length(url)))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct ``rule``, ``verdict`` of the longest rule that fits, or null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, of, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        chosen = F.when(fits, F.struct(F.lit(of + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _grams(text: Column, prefix: str) -> Column:
    """All character n-grams of ``text`` between two marks, as ``prefix`` + gram."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    every = [
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1))),
            lambda at, n=n: F.concat(F.lit(prefix), F.substring(marked, at, F.lit(n))),
        )
        for n in NGRAMS
    ]
    return F.concat(*every)


def features(urls: DataFrame) -> DataFrame:
    """``urls`` with ``features``, the hashed n-grams of ``host`` and ``path``."""
    grams = urls.withColumn("_grams", F.concat(_grams(F.col("host"), "h"), _grams(F.col("path"), "p")))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="features").transform(grams).drop("_grams")


def rule_labels(urls: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """A small labelled table ``host``, ``path``, ``label`` from the urls that a rule decides."""
    judged = urls.select("host", "path", matching_rule(F.col("host"), F.col("path")).alias("hit")).where("hit IS NOT NULL")
    judged = judged.select("host", "path", (F.col("hit.verdict") == "block").cast("double").alias("label")).distinct()
    judged = judged.withColumn("_draw", F.pmod(F.xxhash64("host", "path"), F.lit(1 << 30)) / float(1 << 30))
    # Two rows: the share of each label that training takes.
    sizes = {r["label"]: r["count"] for r in judged.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for label, count in sizes.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, per_label / count))).otherwise(share)
    return judged.where(F.col("_draw") < share).drop("_draw")


def train(labelled: DataFrame) -> LogisticRegressionModel | None:
    """A model of ``label`` by ``host`` and ``path``; None where a label is missing."""
    if labelled.select("label").distinct().count() < 2:
        return None
    # Labels weigh alike, however many examples each has.
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    weight = F.lit(1.0)
    for label, count in counts.items():
        weight = F.when(F.col("label") == label, F.lit(sum(counts.values()) / (len(counts) * count))).otherwise(weight)
    rows = features(labelled.withColumn("weight", weight)).select("features", "label", "weight")
    return LogisticRegression(maxIter=30, regParam=1e-3, weightCol="weight", standardization=False).fit(rows)


def judge(urls: DataFrame, model: LogisticRegressionModel | None) -> DataFrame:
    """``urls`` with ``rule``, ``verdict`` and ``p_block``, the method's probability."""
    hit = matching_rule(F.col("host"), F.col("path"))
    if model is None:
        scored = urls.withColumn("p_block", F.lit(0.0))
    else:
        scored = model.transform(features(urls)).withColumn("p_block", vector_to_array("probability")[1])
    by_method = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    return (
        scored.withColumn("_hit", hit)
        .withColumn("rule", F.col("_hit.rule"))
        .withColumn("verdict", F.coalesce("_hit.verdict", by_method))
        .select(*urls.columns, "rule", "verdict", "p_block")
    )


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    host, path = url_parts(F.col("url"))
    urls = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", host.alias("host"), path.alias("path"))
    # The labels are few; written once, training reads them instead of all urls each time.
    return judge(urls, train(materialise(rule_labels(urls), "labels")))

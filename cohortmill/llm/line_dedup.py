"""Repeated passages of lines, found by overlapping windows of three lines.

Lines end at a line feed and compare without blanks, tabs and carriage returns around them. Each
three consecutive lines of a document, not all three blank, are a window. Of all
windows with the same lines, wherever they are, the first one (by doc_id, then text, then
position) stays; every later one covers its three lines, and covered lines go. Overlapping
windows merge, so a passage of any length from three lines on goes as a whole.

The query has no other windows, as its SQL states. In the pipeline (``whole``) a document of one or two lines
that are not blank has one window more, of those lines, which covers the whole document. With ``cut``, which
neither uses, pieces take the place of lines: a line of more than ``PIECE`` words is cut at the first sentence end
after ``SHORTEST - 1`` words, or else after ``PIECE`` words, so a line of over 50 words is four pieces at least.

Windows are compared by 128 bits of hash. Only hashes, keys and positions go through the
exchange by window, folded per task for the search of the first; texts move once, to meet
their own covered positions.

Native: expressions, aggregates and joins only.

Defined cases: a null text stays null, an empty one empty; fewer than three lines have no window
and stay (without ``whole``); rows with the same doc_id and text are one document and get one result each; null
doc_ids come first; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm.texts import set_aside

WINDOW = 3
#: Words of a piece of a cut line: at most, and at least where a sentence ends.
PIECE = 16
SHORTEST = 8
_BLANKS = " \t\r"
# Anchored and possessive, so that each line is read once, also one without any blank.
_LONG = rf"\A\s*+(?:\S++\s++){{{PIECE}}}+\S"
_SENTENCE_GOES_ON = r"\S++(?<![.!?…])(?<![.!?…][\"')\]»”])\s++"
_SENTENCES = rf"(?:\S++\s++){{{SHORTEST - 1}}}+(?:{_SENTENCE_GOES_ON}){{0,{PIECE - SHORTEST}}}+\S++(?:\s++|\z)"
_PIECES = rf"\s*+(?:{_SENTENCES}|(?:\S++(?:\s++|\z)){{1,{PIECE}}}+)|\s++"
#: Start of the window that is a whole document.
_WHOLE = -1


def _pieces(line: Column) -> Column:
    """``line`` in pieces, all its characters in order."""
    return F.when(F.regexp_like(line, F.lit(_LONG)), F.regexp_extract_all(line, F.lit(_PIECES), F.lit(0))).otherwise(F.array(line))


def _windows(docs: DataFrame, whole: bool, cut: bool) -> DataFrame:
    """``doc_id``, ``_text`` (hash of the text), ``at``, ``k1``, ``k2`` of every window; with ``whole`` also ``size``, the document's lines."""
    lines = F.split("text", "\n")
    lines = F.transform(F.flatten(F.transform(lines, _pieces)) if cut else lines, lambda line: F.btrim(line, F.lit(_BLANKS)))
    hashed = docs.select("doc_id", F.xxhash64("text").alias("_text"), lines.alias("lines"), "text")
    # Every text has a line, so with ``whole`` no line is made for the filter.
    hashed = hashed.where(F.col("text").isNotNull() if whole else F.size("lines") >= WINDOW)
    hashed = hashed.select(
        "doc_id",
        "_text",
        F.transform("lines", lambda line: F.xxhash64(line)).alias("h1"),
        F.transform("lines", lambda line: F.xxhash64(F.lit("second"), line)).alias("h2"),
        F.transform("lines", lambda line: line != "").alias("full"),
    )
    starts = F.when(F.size("h1") >= WINDOW, F.sequence(F.lit(0), F.size("h1") - WINDOW)).otherwise(F.array().cast("array<int>"))

    def over(column: str, at):
        return [F.get(F.col(column), at + k) for k in range(WINDOW)]

    made = F.transform(
        starts,
        lambda at: F.struct(
            at.alias("at"),
            F.xxhash64(*over("h1", at)).alias("k1"),
            F.xxhash64(*over("h2", at)).alias("k2"),
            F.greatest(*over("full", at)).alias("full"),
        ),
    )
    if whole:
        own = [F.filter(h, lambda _, at: F.get("full", at)) for h in ("h1", "h2")]
        every = F.struct(F.lit(_WHOLE).alias("at"), *[F.xxhash64(F.lit("whole"), h).alias(k) for h, k in zip(own, ("k1", "k2"), strict=True)], F.lit(True).alias("full"))
        made = F.when(F.size(F.filter("full", lambda full: full)).between(1, WINDOW - 1), F.array_append(made, every)).otherwise(made)
    size = [F.size("h1").alias("size")] if whole else []
    exploded = hashed.select("doc_id", "_text", *size, F.explode(made).alias("w")).where("w.full")
    return exploded.select("doc_id", "_text", *(["size"] if whole else []), "w.at", "w.k1", "w.k2")


def repeated_lines(docs: DataFrame, whole: bool = False, cut: bool = False) -> DataFrame:
    """``doc_id``, ``_text`` and ``starts``, the starts of windows that repeat an earlier one; with ``whole`` also ``size``."""
    windows = _windows(docs, whole, cut)
    place = F.struct("doc_id", "_text", "at")
    firsts = windows.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = firsts.select(F.col("k1").alias("f1"), F.col("k2").alias("f2"), "first")
    later = windows.join(firsts, (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2"))).where(~place.eqNullSafe(F.col("first")))
    # As many starts as the document has lines, at most.
    size = [F.max("size").alias("size")] if whole else []
    return later.groupBy("doc_id", "_text").agg(F.collect_set("at").alias("starts"), *size)


def _covered(starts: Column) -> Column:
    """Positions of all lines in the windows at ``starts``, some more than once."""
    return F.flatten(F.transform(starts, lambda at: F.array(*[at + k for k in range(WINDOW)])))


def remove_repeated_lines(docs: DataFrame, whole: bool = False, cut: bool = False, emptied: bool = True) -> DataFrame:
    """``docs`` without covered lines, with ``n_lines`` and ``n_removed``; columns of these names are replaced.

    With ``cut`` pieces of lines are compared, removed and counted. Without ``emptied``, which needs ``whole``,
    documents of which nothing is left go; the windows say which, before any text is taken apart.
    """
    found = repeated_lines(docs, whole, cut)
    if not emptied:
        found = found.withColumn("_gone", F.array_contains("starts", _WHOLE) | (F.size(F.array_distinct(_covered(F.col("starts")))) == F.col("size")))
    found = found.drop("size").withColumnsRenamed({"doc_id": "_id", "_text": "_of", "starts": "_starts"})
    kept = docs.drop("n_lines", "n_removed")
    matched = kept.join(found, kept["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64("text") == F.col("_of")), "left")
    if not emptied:
        matched = matched.where(~F.coalesce("_gone", F.lit(False)))
    lines = every_line = F.split("text", "\n")
    if cut:
        every_line = F.flatten(F.transform(lines, lambda line, at: F.transform(_pieces(line), lambda piece: F.struct(at.alias("line"), piece.alias("piece")))))
        # Only where some go: pieces cost more than all the rest here.
        lines = F.when(F.col("_starts").isNotNull(), every_line)
    covered = _covered(F.col("_starts"))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    stay = F.when(F.array_contains("_starts", _WHOLE), F.array().cast("array<int>")).otherwise(F.array_except(every, covered))
    made = matched.withColumn("_lines", lines).withColumn("_stay", stay)
    if cut:

        def with_break(at: Column, k: Column) -> Column:
            own = F.get("_lines", at)
            breaks = (k > 0) & (F.get("_lines", F.get("_stay", k - 1))["line"] < own["line"])
            return F.concat(F.when(breaks, "\n").otherwise(""), own["piece"])

        left = F.array_join(F.transform("_stay", with_break), "")
    else:
        left = F.array_join(F.transform("_stay", lambda at: F.get("_lines", at)), "\n")
    made = made.withColumns(
        {
            "n_lines": F.coalesce(F.when(F.col("_starts").isNull(), F.size(every_line)).otherwise(F.size("_lines")) if cut else F.size("_lines"), F.lit(0)).cast("long"),
            "n_removed": F.when(F.col("_starts").isNotNull(), F.size("_lines") - F.size("_stay")).otherwise(0).cast("long"),
            "_left": F.when(F.col("_starts").isNotNull(), left).otherwise(F.col("text")),
        }
    )
    made = made.withColumn("n_lines", F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.col("n_lines")))
    made = made.withColumn("text", F.col("_left"))
    return made.select(*kept.columns, "n_lines", "n_removed")


def deduplicated(docs: DataFrame, cut: bool = False) -> DataFrame:
    """``docs`` with repeated passages and short documents removed, same columns; documents of which nothing is left go."""
    columns = docs.columns
    docs, back = set_aside(docs, "n_lines", "n_removed")
    made = remove_repeated_lines(docs, whole=True, cut=cut, emptied=False)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return made.drop("n_lines", "n_removed").withColumnsRenamed(back).select(*columns)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what is left of its text, and its lines before and removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeated_lines(docs)


LINE_DEDUP_SQL = """
WITH l AS (
  SELECT doc_id, i, raw[i + 1] AS line, trim(raw[i + 1], ' ' || chr(9) || chr(13)) AS t, len(raw) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS raw FROM documents), LATERAL (SELECT unnest(range(len(raw))) AS i)),
w AS (
  SELECT a.doc_id, a.i, md5(concat(length(a.t), '|', a.t, length(b.t), '|', b.t, length(c.t), '|', c.t)) AS k
  FROM l a JOIN l b ON b.doc_id = a.doc_id AND b.i = a.i + 1 JOIN l c ON c.doc_id = a.doc_id AND c.i = a.i + 2
  WHERE a.t <> '' OR b.t <> '' OR c.t <> ''),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM w),
c AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM r WHERE nth > 1)
SELECT d.doc_id, coalesce(x.text, '') AS text, x.n_lines, x.n_removed
FROM documents d JOIN (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE c.i IS NULL) AS text, count(*) AS n_lines,
    CAST(count(c.i) AS BIGINT) AS n_removed
  FROM l LEFT JOIN c ON c.doc_id = l.doc_id AND c.i = l.i GROUP BY l.doc_id) x USING (doc_id)
"""

"""Near-duplicate documents: MinHash with tensored banding, links confirmed on full shingle sets.

A document's set holds its distinct shingles of ``SHINGLE`` words. Documents with equal sets are one class.
A class gets a few small collections of ``WIDTH`` minimum hashes; a table key is a *pair* of
collections, so m collections make m(m-1)/2 tables and the minimum hashes to work out are about
the square root of what tables of their own would take. Two sets meet in a table as soon as any two
collections agree; :func:`collections_for` takes enough of them that a pair right at the threshold is
missed once in 100,000 times, and closer pairs far less often.

Candidates of a table bucket are not paired with each other:

1. A set of which too few shingles occur in any other candidate cannot reach the threshold with any of
   them, and leaves (exact: the intersection is no larger than the shingles that others have).
2. Every member is confirmed against the bucket's leader, the member with the largest share of common
   shingles. In a group of copies that is near the original, so one comparison each links the group.
3. Two members in different components after that can only be linked if they share a shingle that
   the leader lacks, or if one of them is smaller than the leader and most of both lies inside it
   (see :func:`_across`). Both are joins on shingles or sizes, exact and without all pairs of a group.

Confirmation joins the pairs with both full sets and counts the intersection.

Defined cases: no text or no words: set size 0, linked with nothing. Rows of one doc_id and text are one node. A null
doc_id is linked with nothing, its component is null and it is kept. Texts that share a doc_id have a row each; where that
may happen, number the rows first, as :func:`without_near_duplicates` does: there every row is a document of its own, and
rows without an id are compared like all others. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm.components import components
from cohortmill.llm.texts import NOT_BLANK, chunks, column_bytes, digest128, mix, read_table, segment_hashes, small_batches, words
from cohortmill.operators.ordered import number_rows
from cohortmill.session import materialise

SHINGLE = 5
WIDTH = 2
PERCENT = 80
MISSED = 1e-5

_STEPS = [np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) | 1) for j in range(SHINGLE)]


def collections_for(percent: int) -> int:
    """Least number of collections with which a pair at ``percent`` is missed at most ``MISSED`` times."""
    p, m = (percent / 100) ** WIDTH, 2
    while (1 - p) ** m + m * p * (1 - p) ** (m - 1) > MISSED:
        m += 1
    return m


def shingle_sets(values: list[bytes]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer words than a shingle, one of them all."""
    buffer, starts, ends, first = words(values, NOT_BLANK)
    hashed = segment_hashes(buffer, starts, ends)
    rolled = np.zeros(max(0, len(hashed) - SHINGLE + 1), np.uint64)
    for j, step in enumerate(_STEPS):
        rolled += hashed[j : j + len(rolled)] * step
    rolled = mix(rolled)
    for k in range(len(values)):
        a, b = int(first[k]), int(first[k + 1])
        if b - a >= SHINGLE:
            yield np.unique(rolled[a : b - SHINGLE + 1])
        elif b > a:
            short = sum((hashed[a + j : a + j + 1] * _STEPS[j] for j in range(b - a)), np.zeros(1, np.uint64))
            yield mix(short + np.uint64(b - a))
        else:
            yield np.empty(0, np.uint64)


def collections_of(sets: list[np.ndarray], m: int) -> np.ndarray:
    """``m`` collections of each non-empty set, folded to 64 bits each."""
    values = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    out = np.empty((len(sets), m), np.uint64)
    for i in range(m):
        folded = np.full(len(sets), i + 1, np.uint64)
        for k in range(WIDTH):
            seed = mix(np.array([i * WIDTH + k + 1], np.uint64) * np.uint64(0xA24BAED4963EE407))
            permuted = (values ^ seed) * np.uint64(0xBF58476D1CE4E5B9)
            permuted = (permuted ^ (permuted >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
            folded = mix(folded * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(permuted, starts))
        out[:, i] = folded
    return out


def sketches(docs: DataFrame, m: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_key`` (digest of the set) and ``collections``; both null for an empty set."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = column_bytes(batch.column("text"))
            sizes, keys, folded = [], [], []
            for a, b in chunks(values):
                sets = list(shingle_sets(values[a:b]))
                sizes += [len(s) for s in sets]
                keys += [digest128(s) if len(s) else None for s in sets]
                full = [s for s in sets if len(s)]
                made = iter(collections_of(full, m).view(np.int64).tolist()) if full else iter(())
                folded += [next(made) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(folded, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "collections"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_key binary, collections array<bigint>")


def full_sets(docs: DataFrame) -> DataFrame:
    """``node``, ``shingles`` of every row of ``doc_id``, ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = column_bytes(batch.column("text")), 0
            for a, b in chunks(values):
                sets = list(shingle_sets(values[a:b]))
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = pa.array(np.concatenate(sets).view(np.int64))
                own = batch.column("doc_id").slice(at, b - a)
                yield pa.RecordBatch.from_arrays([own, pa.ListArray.from_arrays(pa.array(offsets), flat)], names=["node", "shingles"])
                at = b

    return docs.select("doc_id", "text").mapInArrow(run, "node long, shingles array<bigint>")


def _keys(classes: DataFrame, m: int) -> DataFrame:
    """``key``, ``node`` for every class and table that may hold another class: a key for every pair of collections.

    Two classes agree in a pair only if they agree in both of its collections, so collections that one class
    alone has make no keys; m rows a class find them, where all keys would be m(m-1)/2.
    """
    each = classes.select("node", F.posexplode("collections").alias("i", "c"))
    met = each.groupBy(F.col("i").alias("met_i"), F.col("c").alias("met_c")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = each.join(met, (F.col("i") == F.col("met_i")) & (F.col("c") == F.col("met_c")))
    # At most m collections a class.
    own = kept.groupBy("node").agg(F.array_sort(F.collect_set(F.struct("i", "c"))).alias("own")).where(F.size("own") > 1)
    pairs = F.transform(
        "own",
        lambda x, at: F.transform(
            F.slice(F.col("own"), at + 2, m),
            lambda y: F.xxhash64(x["i"] * m + y["i"], x["c"], y["c"]),
        ),
    )
    return own.select("node", F.explode(F.flatten(pairs)).alias("key"))


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with ``a_set`` and ``b_set`` of its ``a`` and ``b``."""
    left = sets.select(F.col("node").alias("a_node"), F.col("shingles").alias("a_set"))
    right = sets.select(F.col("node").alias("b_node"), F.col("shingles").alias("b_set"))
    joined = pairs.join(left, F.col("a") == F.col("a_node")).join(right, F.col("b") == F.col("b_node"))
    return joined.select(*pairs.columns, "a_set", "b_set")


def _set_pairs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each row both sorted sets, and which of the first are in the second."""
    flat = [batch.column(c).values.to_numpy().view(np.uint64) for c in ("a_set", "b_set")]
    ends = [batch.column(c).offsets.to_numpy() for c in ("a_set", "b_set")]
    for k in range(batch.num_rows):
        a, b = flat[0][ends[0][k] : ends[0][k + 1]], flat[1][ends[1][k] : ends[1][k + 1]]
        yield a, b, b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``a``, ``b`` of ``pairs`` whose full sets reach ``percent``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [bool(100 * (n := int(same.sum())) >= percent * (len(a) + len(b) - n)) for a, b, same in _set_pairs(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return _with_sets(pairs.select("a", "b"), sets).mapInArrow(run, "a long, b long")


def confirm_stars(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``stars`` (members ``a`` of leaders ``b``) with ``size``, ``leader_size``, ``common``, ``linked``, ``extras``.

    ``extras`` are the first of the member's shingles that the leader lacks, so many that two members
    linked through any of them share one of these: a member needs at least ``percent`` of its own size in
    common with the other, and what the leader does not account for must come from extras.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, leader_sizes, commons, linked, extras = [], [], [], [], []
            for a, b, same in _set_pairs(batch):
                n, lacking = int(same.sum()), a[~same]
                least = max(1, -(-percent * len(a) // 100) - n)
                sizes.append(len(a))
                leader_sizes.append(len(b))
                commons.append(n)
                linked.append(100 * n >= percent * (len(a) + len(b) - n))
                extras.append(lacking[: max(0, len(lacking) - least + 1)].view(np.int64))
            made = [pa.array(x, pa.int64()) for x in (sizes, leader_sizes, commons)]
            made += [pa.array(linked, pa.bool_()), pa.array(extras, pa.list_(pa.int64()))]
            own = [batch.column(c) for c in ("a", "b", "shared")]
            yield pa.RecordBatch.from_arrays([*own, *made], names=["a", "b", "shared", "size", "leader_size", "common", "linked", "extras"])

    out = "a long, b long, shared long, size long, leader_size long, common long, linked boolean, extras array<bigint>"
    return _with_sets(stars.select("a", "b", "shared"), sets).mapInArrow(run, out)


def _across(stars: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` of members of one leader in different components that may be linked.

    For members C, A of leader L let c, a be their intersections with L. If both are linked with L they are in
    one component; so let C not be. |C & A| is at most min(c, a) plus their common extras (not in L), and must
    be p/(100+p) (|C| + |A|). Without common extras that makes c so large that, C not being linked with L, A is
    smaller than L and c at least p percent of |C|: few sets qualify but where lengths of near copies vary.
    With common extras the members meet in a join on (leader, extra), and min(c, a) plus the smaller number of
    extras that any other candidate has bounds the intersection.
    """
    placed = stars.join(found.select(F.col("node").alias("of"), "component"), F.col("a") == F.col("of"), "left")
    placed = placed.withColumn("component", F.coalesce("component", "a")).drop("of")
    open_leaders = placed.groupBy(F.col("b").alias("l")).agg((F.min("component") < F.max("component")).alias("open")).where("open").select("l")
    placed = materialise(placed.join(open_leaders, F.col("b") == F.col("l"), "left_semi"), "open")
    columns = ["a", "b", "component", "linked", "size", "common", "shared", "leader_size"]
    x = placed.select(*[F.col(c).alias(f"x_{c}") for c in columns], F.explode("extras").alias("x_h"))
    y = placed.select(*[F.col(c).alias(f"y_{c}") for c in columns], F.explode("extras").alias("y_h"))
    apart = (F.col("x_component") != F.col("y_component")) & ~(F.col("x_linked") & F.col("y_linked"))
    need = percent * (F.col("x_size") + F.col("y_size"))
    inside = F.least("x_common", "y_common")
    outside = F.least(F.col("x_shared") - F.col("x_common"), F.col("y_shared") - F.col("y_common"))
    by_extra = x.join(
        y,
        (F.col("x_b") == F.col("y_b")) & (F.col("x_h") == F.col("y_h")) & (F.col("x_a") < F.col("y_a")) & apart & ((100 + percent) * (inside + outside) >= need),
    )
    small = placed.select(*[F.col(c).alias(f"x_{c}") for c in columns]).where(~F.col("x_linked") & (F.col("x_common") * 100 >= F.col("x_size") * percent))
    smaller = placed.select(*[F.col(c).alias(f"y_{c}") for c in columns]).where(F.col("y_size") < F.col("y_leader_size"))
    by_size = small.join(
        smaller,
        (F.col("x_b") == F.col("y_b")) & (F.col("x_a") != F.col("y_a")) & apart & ((100 + percent) * inside >= need),
    )
    both = by_extra.select("x_a", "y_a").unionByName(by_size.select("x_a", "y_a"))
    return both.select(F.least("x_a", "y_a").alias("a"), F.greatest("x_a", "y_a").alias("b")).distinct()


def _links(docs: DataFrame, classes: DataFrame, m: int, percent: int) -> DataFrame:
    """``node``, ``component`` of the classes that are linked with another one."""
    keys = _keys(classes, m)
    met = keys.groupBy(F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k")
    members = materialise(keys.join(met, F.col("key") == F.col("k")).select("key", "node"), "members")
    candidates = members.select(F.col("node").alias("of")).distinct()
    texts = docs.select("doc_id", "text").join(candidates, F.col("doc_id") == F.col("of"), "left_semi")
    sets = materialise(full_sets(texts).where(F.size("shingles") > 0).distinct(), "sets")

    # Shingles that one candidate alone has; each is one row of a count, whoever else has how many.
    counted = sets.select("node", F.explode("shingles").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("owner"))
    alone = counted.where("n = 1").groupBy("owner").agg(F.count(F.lit(1)).alias("alone"))
    sizes = sets.select("node", F.size("shingles").alias("size"))
    shared = F.col("size") - F.coalesce("alone", F.lit(0))
    able = sizes.join(alone, F.col("node") == F.col("owner"), "left").where(shared * 100 >= F.col("size") * percent)
    able = able.groupBy(F.col("node").alias("of")).agg(F.max(shared).alias("shared"), F.max(shared / F.col("size")).alias("share"))
    members = materialise(members.join(able, F.col("node") == F.col("of")).select("key", "node", "shared", "share"), "members")

    leaders = members.groupBy(F.col("key").alias("k")).agg(F.max(F.struct("share", -F.col("node"))).alias("top"), F.count(F.lit(1)).alias("n"))
    leaders = leaders.where("n > 1").select("k", (-F.col("top.col2")).alias("b"))
    stars = members.join(leaders, F.col("key") == F.col("k")).where("node <> b").select(F.col("node").alias("a"), "b", "shared").distinct()
    stars = materialise(confirm_stars(stars, sets, percent), "stars")
    first = stars.where("linked").select("a", "b")
    second = confirm(_across(stars, components(first), percent), sets, percent)
    return components(first.unionByName(materialise(second, "links")))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``class_id``, ``component_id`` and ``kept`` of every document.

    ``class_id`` is the least doc_id with the same set, ``component_id`` the least one reachable over
    links of ``percent`` or more; ``kept`` is the document that stays of each group.
    """
    m = collections_for(percent)
    every = materialise(sketches(docs, m), "sketches")
    known = every.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = known.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.first("collections").alias("collections"))
    classes = materialise(classes, "classes")
    linked = _links(docs, classes, m, percent).select(F.col("node").alias("of"), "component")
    named = classes.join(linked, F.col("node") == F.col("of"), "left")
    named = named.select(F.col("set_key").alias("k"), F.col("node").alias("class_id"), F.coalesce("component", "node").alias("component"))
    joined = every.join(named, (F.col("set_key") == F.col("k")) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("component", "doc_id")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group, same columns: that of the least doc_id, of equal ids that of the least text hash.

    Rows without an id come behind all others. Removals go by row: while every id is there once, ids name the
    rows, else rows are numbered first.
    """
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        gone = near_duplicates(docs, percent).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
        return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    # Other names while the rows are numbered, so none of the columns clashes.
    aside = {name: f"_c{k}" for k, name in enumerate(docs.columns)}
    own, text = F.col(aside["doc_id"]), F.col(aside["text"])
    keyed = docs.toDF(*aside.values()).withColumns({"_late": own.isNull(), "_text_hash": F.xxhash64(text)})
    rows = number_rows(keyed, ["_late", aside["doc_id"], "_text_hash"])
    found = near_duplicates(rows.select(F.col("row_number").alias("doc_id"), text.alias("text")), percent)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    left = rows.join(gone, F.col("row_number") == F.col("_gone"), "left_anti")
    return left.select(*[F.col(other).alias(name) for name, other in aside.items()])


def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set sizes and components of all documents at a similarity of 0.85."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)


NEAR_DUPS_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + least(5, len(w)) - 1], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, root) AS (
  SELECT a, a FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node WHERE r.root < e.b),
k AS (SELECT node, min(root) AS root FROM r GROUP BY node),
q AS (
  SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(k.root, d.doc_id), d.doc_id) AS component_id
  FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN k ON k.node = d.doc_id),
f AS (SELECT doc_id, md5(string_agg(h, '' ORDER BY h)) AS f FROM s GROUP BY doc_id),
c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY f) AS class_id FROM f)
SELECT q.doc_id, n_shingles, coalesce(class_id, q.doc_id) AS class_id, component_id, q.doc_id = component_id AS kept
FROM q LEFT JOIN c USING (doc_id)
"""

"""Language of a text by a string kernel: n-gram presence, Nyström landmarks, ridge regression.

The kernel of two texts is ``|A & B| / sqrt(|A| |B|)`` for the sets A, B of their character n-grams
of all ``LENGTHS`` (a blended spectrum, presence only), lower-cased and hashed to ``BINS`` bins.
A bounded, labelled sample gives landmarks and training texts; kernel values to the landmarks
times the inverse root of the landmarks' own kernel are the features of one ridge
regression per language against the rest. A batch of texts is scored by two matrix products.

The sample: ``SAMPLE`` labelled texts about, the same number for each language, drawn by a hash
of doc_id; ``LANDMARKS`` of them are landmarks. Both bounds hold for any number of documents.

Defined cases: a text that is null or has no letter is ``und`` with score 0.0; so is every text if
no row is labelled. Null or missing labels teach nothing. With one language all texts with letters are
of it. Repeated texts get equal results; an empty table gives no rows; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm.texts import mix, read_table, set_aside, small_batches

LENGTHS = (1, 2, 3)
BINS = 1 << 16
SAMPLE = 1024
LANDMARKS = 128
RIDGE = 1e-3
# How sharply differences of regression values turn into scores.
SHARPNESS = 4.0
BATCH = 32
UNKNOWN = "und"


def presence(text: str, out: np.ndarray) -> None:
    """Mark the bins of all n-grams of ``text`` in ``out``."""
    symbols = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    rolled = np.zeros(len(symbols), np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        if len(symbols) < n:
            break
        rolled = rolled[: len(symbols) - n + 1] * np.uint64(0x100000001B3) + symbols[n - 1 :]
        if n in LENGTHS:
            out[mix(rolled + np.uint64(n << 56)) >> np.uint64(48)] = 1


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    """What scoring needs; its size depends on the parameters alone."""

    languages: list[str]
    bins: np.ndarray  # bins that any landmark has
    landmarks: np.ndarray  # presence of those bins in each landmark, one column each
    sizes: np.ndarray  # n-grams of each landmark
    weights: np.ndarray  # landmarks x languages
    offsets: np.ndarray

    def scores(self, marks: np.ndarray) -> np.ndarray:
        """Regression values of a batch of presence rows for each language."""
        own = np.maximum(marks.sum(axis=1, dtype=np.int64), 1)
        kernel = marks[:, self.bins].astype(np.float32) @ self.landmarks
        kernel /= np.sqrt(own[:, None] * self.sizes[None, :]).astype(np.float32)
        return kernel @ self.weights + self.offsets


def fit(marks: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """One-versus-rest kernel ridge regression on ``landmarks`` of the given presence rows."""
    if not labels:
        return None
    languages = sorted(set(labels))
    number = np.array([languages.index(x) for x in labels])
    each = max(1, landmarks // len(languages))
    chosen = np.concatenate([np.flatnonzero(number == k)[:each] for k in range(len(languages))])
    sizes = np.maximum(marks[chosen].sum(axis=1, dtype=np.int64), 1)
    bins = np.flatnonzero(marks[chosen].any(axis=0))
    own = marks[chosen][:, bins].astype(np.float32)
    among = (own @ own.T) / np.sqrt(sizes[:, None] * sizes[None, :])
    values, vectors = np.linalg.eigh(among.astype(np.float64))
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    model = Model(languages, bins, np.ascontiguousarray(own.T), sizes, np.eye(len(chosen), dtype=np.float32), np.zeros(len(chosen), np.float32))
    to_landmarks = np.concatenate([model.scores(marks[at : at + BATCH]) for at in range(0, len(marks), BATCH)]).astype(np.float64)
    inputs = np.concatenate([to_landmarks @ root, np.ones((len(marks), 1))], axis=1)
    # Each language weighs alike; targets are +1 for it and -1 for the rest.
    weight = (len(labels) / len(languages) / np.bincount(number))[number]
    targets = np.where(number[:, None] == np.arange(len(languages))[None, :], 1.0, -1.0)
    gram = (inputs * weight[:, None]).T @ inputs
    gram[np.diag_indices(len(gram) - 1)] += ridge * len(labels)
    solved = np.linalg.solve(gram, (inputs * weight[:, None]).T @ targets)
    model.weights = (root @ solved[:-1]).astype(np.float32)
    model.offsets = solved[-1].astype(np.float32)
    return model


def _mark_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            row = np.zeros(BINS, np.uint8)
            presence(text, row)
            rows.append(np.packbits(row).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("draw"), pa.array(rows, pa.binary())], names=["lang", "draw", "marks"])


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from the labelled rows of ``docs`` that are not held out."""
    small_batches(docs.sparkSession)
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    each = max(1, sample // max(1, len(counts)))
    share = F.lit(0.0)
    for lang, count in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, 1.5 * each / count))).otherwise(share)
    drawn = rows.withColumn("draw", draw).where(F.col("draw") < share)
    # About 1.5 * sample rows of BINS / 8 bytes each; the smallest draws of each language stay.
    found = sorted(drawn.select("lang", "draw", "text").mapInArrow(_mark_rows, "lang string, draw double, marks binary").collect())
    taken: dict[str, list[bytes]] = {}
    for row in found:
        own = taken.setdefault(row["lang"], [])
        if len(own) < each:
            own.append(bytes(row["marks"]))
    labels = [lang for lang, own in taken.items() for _ in own]
    if not labels:
        return None
    marks = np.stack([np.unpackbits(np.frombuffer(m, np.uint8)) for own in taken.values() for m in own])
    return fit(marks, labels)


def identify(docs: DataFrame, model: Model | None, lettered: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from ``text`` alone; columns of these names are replaced.

    With ``lettered`` only texts that have a letter, whatever their language.
    """
    spark = docs.sparkSession
    small_batches(spark)
    # Plain data, so workers need nothing to read it.
    shared = spark.sparkContext.broadcast(model and dict(vars(model)))
    kept = docs.drop("lang_pred", "score")
    names = [f.name for f in kept.schema]
    schema = kept.withColumns({"lang_pred": F.lit(None).cast("string"), "score": F.lit(None).cast("double")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value and Model(**shared.value)
        marks = np.zeros((BATCH, BINS), np.uint8)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            predicted, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [k for k, text in enumerate(texts) if model is not None and has_letter(text)]
            for at in range(0, len(known), BATCH):
                some = known[at : at + BATCH]
                marks[:] = 0
                for row, k in enumerate(some):
                    presence(texts[k], marks[row])
                values = SHARPNESS * model.scores(marks[: len(some)]).astype(np.float64)
                values = np.exp(values - values.max(axis=1, keepdims=True))
                values /= values.sum(axis=1, keepdims=True)
                best = values.argmax(axis=1)
                score[some] = values[np.arange(len(some)), best]
                for row, k in enumerate(some):
                    predicted[k] = model.languages[best[row]]
            made = pa.RecordBatch.from_arrays([*batch.columns, pa.array(predicted, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])
            yield made.filter(pa.array(map(has_letter, texts), pa.bool_())) if lettered else made

    return kept.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model | None, wanted: Sequence[str] | None = None) -> DataFrame:
    """Rows that have a letter and are in a wanted language, with their language named; the columns stay.

    A missing ``lang`` becomes the predicted one, and with ``wanted`` texts predicted to be in another language go. Where no model
    could be fitted, or where it was given ``und`` as a language, texts stay as they are.
    """
    columns = docs.columns
    docs, back = set_aside(docs, "lang_pred", "score")
    known = identify(docs, model, lettered=True)
    if model is not None:
        told = F.when(F.col("lang_pred") != UNKNOWN, F.col("lang_pred"))
        if wanted is not None:
            known = known.where(told.isNull() | told.isin(list(wanted)))
        if "lang" in columns:
            known = known.withColumn("lang", F.coalesce("lang", told))
    return known.drop("lang_pred", "score").withColumnsRenamed(back).select(*columns)


def op3_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

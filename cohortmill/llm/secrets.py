"""Secrets in texts: fixed patterns, and values in credential contexts that are costly to guess.

Base spans come from three patterns. The method looks at every value that a credential word
introduces (``CONTEXT``: more words and looser values than the base pattern) and works out
how many guesses an attacker who knows common words, dates, repeats and keyboard walks would need:
the cheapest way to cut the value into such pieces and brute-force rests, by dynamic
programming over end positions. A value that no base span touches and that costs
``MIN_LOG10`` powers of ten or more becomes a ``guess`` span.

The ranked words come from a vocabulary file, read on the driver; its size (the public file has
some 30,000 words) is checked against ``MAX_WORDS`` before it is broadcast.

Spans are in code points, end exclusive. Values are read whole. A word is at most as long as the vocabulary's
longest; runs, walks and repeats may have any length. What is repeated is priced by a search of its
own, wherever the best way up to it leads.

Defined cases: a null or empty text has no spans; repeated rows each get theirs; extra columns
are ignored; an empty table gives no rows. Of overlapping method values the first one counts.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm.period_runs import runs_of
from cohortmill.llm.texts import read_table, small_batches

MIN_LOG10 = 10.0
# Longest date, and up to what length a value is searched for repeats by a pattern first.
DATE, SHORT = 10, 64
MAX_WORDS = 100_000
KINDS = ("assign", "access", "hex", "guess")


def _either_case(text: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", text)


#: Kind, pattern, group that must be long enough, its least length. Fixed values.
BASE = (
    ("assign", re.compile(_either_case(r"(password|passwd|secret|token|api_?key)") + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)
#: The same matches as the patterns above that are long enough, found faster: a run counts whole.
_FAST = {"access": re.compile(r"AKIA[A-Z0-9]{14,}"), "hex": re.compile(r"[0-9a-f]{16,}")}

#: Words that introduce a credential, then a separator, then the value up to white space or a quote.
_WORDS = ("password", "passwd", "passphrase", "passcode", "pass", "pwd", "secret", "token", "api_?key", "access_?key", "private_?key", "auth", "credential", "credentials", "login_?key", "pin")
CONTEXT = re.compile(
    r"(?<![A-Za-z0-9])(?:[A-Za-z0-9]+_)*(?:" + "|".join(map(_either_case, _WORDS)) + r""")["']?\x20*(?::=|=>|[:=]|\x20is\x20)\x20*["'`]?([^\s"'`<>,;]{6,})"""
)

#: Rows of a keyboard, as they lie. Fixed values.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
#: Signs people put for letters. Fixed values.
SIGNS = {"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"}

_SPOT = {c: (row, at) for row, keys in enumerate(KEYBOARD) for at, c in enumerate(keys)}
_UNSIGN = str.maketrans(SIGNS)
_DATE = re.compile(r"(?:(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d)$")


def words_of_vocabulary(path: str) -> dict[str, int]:
    """Whole words of three letters or more and their rank, from a word-piece vocabulary file."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    whole = sorted((at, piece[:-4]) for piece, at in vocabulary.items() if piece.endswith("</w>"))
    ranked = [w for _, w in whole if len(w) >= 3 and w.isalpha() and w.isascii()]
    if len(ranked) > MAX_WORDS:
        raise ValueError(f"{path}: {len(ranked)} words, more than the {MAX_WORDS} that may be broadcast")
    return {w: rank for rank, w in enumerate(ranked, 1)}


def _cardinality(text: str) -> int:
    """Characters a brute-force search would try at each place of ``text``."""
    kinds = {"l" if c.islower() else "u" if c.isupper() else "d" if c.isdigit() else "s" if c.isascii() else "o" for c in text}
    return max(10, sum({"l": 26, "u": 26, "d": 10, "s": 33, "o": 100}[k] for k in kinds))


def _near(a: str, b: str) -> bool:
    """Whether two keys touch on the keyboard."""
    x, y = _SPOT.get(a), _SPOT.get(b)
    return x is not None and y is not None and x != y and abs(x[0] - y[0]) <= 1 and abs(x[1] - y[1]) <= 1


def _add_start(starts: list[tuple[float, int]], cost: float, end: int, least: int) -> None:
    """Add the start of the piece of ``least`` characters that ends at ``end``; drop starts that can't be the cheapest any more.

    A piece from a start costs ``cost`` and the logarithm of its length. What a later start saves by its shorter
    length only shrinks as ``end`` moves on, so one that an earlier start beats stays beaten, and a later start
    that costs no more beats an earlier one always. Starts and costs rise together in what is left.
    """
    while starts and starts[-1][0] >= cost:
        starts.pop()
    starts.append((cost, end - least))
    kept: list[tuple[float, int]] = []
    for own, start in starts:
        if not (kept and kept[-1][0] + math.log10(end - kept[-1][1]) <= own + math.log10(end - start)):
            kept.append((own, start))
    starts[:] = kept


_SQUARE = re.compile(r"(.{2,})\1", re.DOTALL)


def repeats_of(lower: str) -> dict[int, list[tuple[int, int, int]]]:
    """Stretches ``(start, end, period)`` of two periods or more, none of one character, by the least end of two periods."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    if len(lower) < 4 or (len(lower) <= SHORT and not _SQUARE.search(lower)):
        return out
    for start, length, period in runs_of([lower], least=4, times=2)[0].tolist():
        if period > 1:
            out.setdefault(start + 2 * period, []).append((start, start + length, period))
    return out


def longest_word(words: dict[str, int]) -> int:
    return max(map(len, words), default=0)


def guess_log10(value: str, words: dict[str, int], longest: int | None = None, limit: float = math.inf) -> tuple[float, list[tuple[str, int, int]]]:
    """Least log10 of guesses over all segmentations of ``value``, and the segmentation.

    A word costs its rank, times what its capitals and signs add; a date the days of 150 years; a
    repeat what is repeated, times how often; a walk its start, times turns and length; a
    brute-force place the alphabet of the whole value. Each further piece doubles the cost. From ``limit`` on
    costs need not be the least; below they are.
    """
    lower = value.lower()
    if len(lower) != len(value):  # a few capitals grow when lowered
        lower = value
    longest = longest_word(words) if longest is None else longest
    return _least(value, lower, words, max(longest, DATE), math.log10(_cardinality(value)), limit, {})


def _least(value: str, lower: str, words: dict[str, int], longest: int, place: float, limit: float, known: dict[str, float]) -> tuple[float, list[tuple[str, int, int]]]:
    """:func:`guess_log10` of a part of a value, at ``place`` for a brute-force place; ``known`` are parts priced already."""
    n = len(value)
    plain = lower.translate(_UNSIGN)
    best: list[float] = [0.0] + [math.inf] * n
    back: list[tuple[str, int]] = [("", 0)] * (n + 1)
    piece = math.log10(2)
    # Least cost up to each position that ends inside a brute-force span, and that span's start.
    brute: list[tuple[float, int]] = [(math.inf, 0)] * (n + 1)
    # Lengths of the walk and of the run of one character that end at each position.
    walk = [1] * (n + 1)
    run = [1] * (n + 1)
    # Starts inside the present walk and run that may still be the cheapest, with their cost there.
    walks: list[tuple[float, int]] = []
    runs: list[tuple[float, int]] = []
    # Repeats that have begun, and of each the same by the place inside its period.
    coming = repeats_of(lower)
    repeats: list[tuple[int, int, int, dict[int, list[tuple[float, int]]]]] = []
    for end in range(1, n + 1):
        if end > 1:
            walk[end] = walk[end - 1] + 1 if _near(lower[end - 2], lower[end - 1]) else 1
            run[end] = run[end - 1] + 1 if lower[end - 2] == lower[end - 1] else 1

        def offer(kind: str, start: int, cost: float) -> None:
            total = best[start] + cost + (piece if start else 0.0)
            if total < best[end]:  # noqa: B023
                best[end], back[end] = total, (kind, start)  # noqa: B023

        cost, start = min(brute[end - 1], (best[end - 1] + (piece if end > 1 else 0.0), end - 1))
        brute[end] = cost + place, start
        best[end], back[end] = brute[end][0], ("brute", start)
        for kind, length, starts, least, first, each in (("repeat", run[end], runs, 3, place, 0.0), ("walk", walk[end], walks, 4, math.log10(len(_SPOT)), 1 / 3)):
            if length <= least:
                starts.clear()
            if length >= least:
                start = end - least
                _add_start(starts, best[start] + (piece if start else 0.0) - each * start, end, least)
                for _, start in starts:
                    offer(kind, start, first + math.log10(end - start) + each * (end - start))
        for start in range(max(0, end - longest), end - 2):
            text = plain[start:end]
            rank = words.get(text) or words.get(lower[start:end])
            if rank:
                own = value[start:end]
                capitals = sum(c.isupper() for c in own)
                shape = 0.0 if not capitals else math.log10(2) if own.istitle() or own.isupper() else math.log10(2) * min(capitals, len(own) - capitals) + 0.3
                signs = sum(a != b for a, b in zip(lower[start:end], text, strict=True)) if lower[start:end] not in words else 0
                offer("word", start, math.log10(rank) + shape + math.log10(2) * signs)
            size = end - start
            if 4 <= size <= DATE and lower[start].isdigit() and _DATE.match(lower, start, end):
                offer("date", start, math.log10(365 * 150 if size > 4 else 150))
        repeats += [(*x, {}) for x in coming.get(end, ())]
        repeats = [x for x in repeats if x[1] >= end]
        for _, _, period, phases in repeats:
            start = end - 2 * period
            starts = phases.setdefault(end % period, [])
            before = best[start] + (piece if start else 0.0)
            # What is repeated costs no less than what the best way gains over it.
            if before + max(0.0, best[start + period] - before) < limit:
                own = value[start : start + period]
                if own not in known:
                    known[own] = _least(own, lower[start : start + period], words, longest, place, limit, known)[0]
                _add_start(starts, before + known[own], end, 2 * period)
            for cost, start in starts:
                total = cost + math.log10((end - start) // period)
                if total < best[end]:
                    best[end], back[end] = total, ("repeat", start)
    pieces, end = [], n
    while end:
        kind, start = back[end]
        pieces.append((kind, start, end))
        end = start
    return best[n], pieces[::-1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base patterns' matches that are long enough, in order."""
    out = []
    for number, (kind, pattern, group, least) in enumerate(BASE):
        for match in _FAST.get(kind, pattern).finditer(text):
            if match.end(group) - match.start(group) >= least:
                out.append((match.start(), number, match.end()))
    return sorted(out)


def added_spans(text: str, base: list[tuple[int, int, int]], words: dict[str, int], longest: int | None = None) -> list[tuple[int, int, int]]:
    out = []
    for match in CONTEXT.finditer(text):
        start, end = match.span(1)
        end -= len(match[1]) - len(match[1].rstrip(".)]}!?:"))
        if end - start >= 6 and not any(s < end and start < e for s, _, e in base) and guess_log10(text[start:end], words, longest, MIN_LOG10)[0] >= MIN_LOG10:
            out.append((start, KINDS.index("guess"), end))
    return out


_DDL = "doc_id long, found array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame, words: dict[str, int]) -> DataFrame:
    """``doc_id`` and ``found``, the spans of its whole text in order of start and kind."""
    spark = docs.sparkSession
    small_batches(spark)
    if len(words) > MAX_WORDS:
        raise ValueError(f"{len(words)} words, more than the {MAX_WORDS} that may be broadcast")
    shared = spark.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked = shared.value
        longest = longest_word(ranked)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text) if text else []
                every = sorted(base + added_spans(text, base, ranked, longest)) if text else []
                found.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in every])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "found"])

    return docs.select("doc_id", "text").mapInArrow(run, _DDL)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of every document, base ones also counted and digested."""
    found = find_secrets(read_table(spark, sf_dir, "documents"), words_of_vocabulary(vocabulary_path()))
    base = F.filter("found", lambda s: s["kind"] != "guess")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.col("found")).alias("spans"),
    )

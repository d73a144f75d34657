"""Repair of conversations: faults of turns, the cheapest edits that leave legal roles, and the repaired turns.

Turns of a conversation are read by turn number (nulls first), then role and text. The first fault of each counts:
blank (no character but the six ASCII white-space ones), duplicate (role and text seen earlier) or truncated (its last other
character is none of ``.!?``). ``turn_alignment`` finds the edits.

One exchange brings ordinary conversations together, sorted; each is repaired as the sorted rows stream by. A conversation of more
than ``LONG`` turns or ``LONG_BYTES`` of text goes another way: what repeats in it comes from an aggregate, its rows are
dealt out in ranges of their order, every task sums up consecutive turns as audits between grammar states, and these sums are
put together. Its texts pass once more in order, because the digest of a text is sequential; no task holds them.

Defined cases: a null role or text is one space; a null conv_id is a conversation of its own; turns with equal numbers
go by role, then text; a conversation without turns has zeros, an empty audit and an empty text; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm.texts import BATCH_ROWS, read_table, small_batches
from cohortmill.llm.turn_alignment import FINAL, NEXT, START, STATES, Audit, add, begin, fold, repair_audit
from cohortmill.session import materialise, worker_partitions

# A conversation is long beyond so many turns, or so many bytes of text.
LONG, LONG_BYTES = 4096, 8 << 20
# Characters of a text that help to deal out the turns of a long conversation.
PREFIX = 32
_BLANKS = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
_NAMES = {"u": "user", "a": "assistant"}


class Faults:
    """Counts over consecutive turns, and their codes for the alignment."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = ""
        self.numbers: list[int | None] = [None, None]
        self.distinct = 0
        self.codes: list[str] = []

    def see(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        initial = role[:1]
        if self.turns == 0:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _LEGAL
        self.last = initial
        self.turns += 1
        if turn is not None:
            self.distinct += turn != self.numbers[1]
            self.numbers = [turn if self.numbers[0] is None else self.numbers[0], turn]
        code = initial if initial in NEXT_INITIALS else "o"
        stripped = text.rstrip(_BLANKS)
        if not stripped:
            self.blank += 1
            code = "x"
        elif seen:
            self.duplicate += 1
            code = "x"
        elif stripped[-1] not in ".!?":
            self.truncated += 1
            code = code.upper()
        self.codes.append(code)

    def follow(self, other: Faults) -> None:
        """Count ``other``, which comes right behind, as well; codes stay apart."""
        if not other.turns:
            return
        if self.turns:
            self.illegal += self.last + other.first not in _LEGAL
        else:
            self.first = other.first
        self.last = other.last
        for name in ("blank", "duplicate", "truncated", "illegal", "turns", "distinct"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if other.numbers[0] is not None:
            self.distinct -= other.numbers[0] == self.numbers[1]
            self.numbers = [other.numbers[0] if self.numbers[0] is None else self.numbers[0], other.numbers[1]]

    @property
    def gaps(self) -> int:
        low, high = self.numbers
        return 0 if low is None else high - low + 1 - self.distinct


NEXT_INITIALS = {role for _, role in NEXT}

Turn = tuple[int | None, str, str]


def repaired(audit: str, turns: Iterable[Turn]) -> Iterator[tuple[str, str, str]]:
    """``role``, ``text`` and edit letter of every turn that the edits of ``audit`` leave of ``turns``."""
    state, coming = START, iter(turns)
    for edit in audit:
        role = text = ""
        if edit != "I":
            _, role, text = next(coming)
        if edit == "D":
            continue
        if edit != "K":
            role = _NAMES["a" if (state, "a") in NEXT else "u"]
        state = NEXT[state, role[0]]
        yield role, text, edit


REPORT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
TURNS = "conv_id bigint, place bigint, role string, text string, edit string"
_SCHEMAS = {
    REPORT: pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in REPORT.split(", "))]),
    TURNS: pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in TURNS.split(", "))]),
}


def _rows(conv_id: int | None, faults: Faults, best: Audit, turns: Iterable[Turn], out: str) -> Iterator[tuple]:
    cost, audit = best
    left = repaired(audit, turns)
    if out == TURNS:
        for place, (role, text, edit) in enumerate(left):
            yield conv_id, place, role, text, edit
        return
    digest, between = hashlib.sha256(), b""
    for role, text, _ in left:
        digest.update(between + f"{role}:{text}".encode())
        between = b"\n"
    counts = (faults.gaps, faults.blank, faults.duplicate, faults.truncated, faults.illegal)
    yield conv_id, *counts, cost, audit, digest.hexdigest()


def _by_conversation(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Consecutive rows of one conversation, to be used up before the next one."""
    every = (row for batch in batches for row in zip(*(batch.column(n).to_pylist() for n in ("conv_id", *names)), strict=True))
    held: list[tuple] = []
    ended = False

    def own(conv_id: int | None) -> Iterator[tuple]:
        nonlocal ended
        while held:
            yield held.pop()[1:]
            row = next(every, None)
            if row is None:
                ended = True
                return
            held.append(row)
            if row[0] != conv_id:
                return

    if (row := next(every, None)) is not None:
        held.append(row)
    while held and not ended:
        conv_id = held[0][0]
        rows = own(conv_id)
        yield conv_id, rows
        for _ in rows:
            pass


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _whole(out: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Repair of conversations that each fit into memory."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        memory: dict = {}
        for conv_id, own in _by_conversation(batches, ("turn", "role", "text", "absent")):
            turns = [row[:3] for row in own if not row[3]]
            faults, seen = Faults(), set()
            for turn, role, text in turns:
                faults.see(turn, role, text, (role, text) in seen)
                seen.add((role, text))
            yield from _rows(conv_id, faults, repair_audit("".join(faults.codes), memory), turns, out)

    return lambda batches: _batched(rows(batches), _SCHEMAS[out])


_PART = pa.schema([("conv_id", pa.int64()), ("task", pa.int64()), ("part", pa.int64()), ("told", pa.string())])
_PART_DDL = "conv_id bigint, task bigint, part bigint, told string"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to ``LONG`` consecutive turns of a long conversation each: their counts, and audits between all states."""
    task = TaskContext.get().partitionId()
    memory: dict = {}

    def told(faults: Faults) -> str:
        codes = "".join(faults.codes)
        return json.dumps([{**vars(faults), "codes": []}, [fold(codes, entry, memory) for entry in STATES]])

    def rows() -> Iterator[tuple]:
        for conv_id, own in _by_conversation(batches, ("turn", "role", "text", "absent", "again", "often")):
            faults, part, before = Faults(), 0, None
            for turn, role, text, absent, again, often in own:
                if absent:
                    continue
                # Equal rows stand together, and all but the first of them are duplicates.
                faults.see(turn, role, text, again or (often and (turn, role, text) == before))
                before = (turn, role, text)
                if faults.turns == LONG:
                    yield conv_id, task, part, told(faults)
                    faults, part = Faults(), part + 1
            yield conv_id, task, part, told(faults)

    return _batched(rows(), _PART)


def _joined(out: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Repair of long conversations: their parts in order come first, then their turns in order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv_id, own in _by_conversation(batches, ("told", "turn", "role", "text")):
            faults, best, after = Faults(), begin(START), []
            for told, *turn in own:
                if told is None:
                    after.append(tuple(turn))
                    break
                counts, audits = json.loads(told)
                other = Faults()
                vars(other).update(counts)
                faults.follow(other)
                best = add(best, [tuple(tuple(x) if x else None for x in row) for row in audits])
            turns = (t for part in (after, (row[1:] for row in own)) for t in part)
            yield from _rows(conv_id, faults, min(best[x] for x in FINAL if best[x]), turns, out)

    return lambda batches: _batched(rows(batches), _SCHEMAS[out])


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def _long_ones(rows: DataFrame, long: DataFrame, out: str) -> DataFrame:
    """``out`` of the conversations of ``long`` (column ``of``)."""
    parts = worker_partitions(rows.sparkSession)
    own = rows.join(long, _same("conv_id", "of"), "left_semi")
    # Lengths in front keep role and text apart.
    own = own.withColumn("kind", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    there = own.where("NOT absent")
    number = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    often = there.groupBy(F.col("conv_id").alias("o_id"), F.col("kind").alias("o_kind")).agg(F.min(number).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    marked = own.join(often, _same("conv_id", "o_id") & (F.col("kind") == F.col("o_kind")), "left")
    marked = marked.select(
        "conv_id", "turn", "role", "text", "absent",
        (F.col("n").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("again"),
        F.col("n").isNotNull().alias("often"),
    )
    dealt = marked.repartitionByRange(parts, "conv_id", "turn", "role", F.substring("text", 1, PREFIX))
    told = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_parts, _PART_DDL)
    turns = there.select("conv_id", "turn", "role", "text")
    both = told.unionByName(turns, allowMissingColumns=True)
    order = [F.col("told").isNull(), "task", "part", "turn", "role", "text"]
    return both.repartition(parts, "conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(_joined(out), out)


def repair(turns: DataFrame, out: str = REPORT) -> DataFrame:
    """Faults, edits and digest of every conversation (``REPORT``), or the turns they leave (``TURNS``).

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``, and may have ``absent``: such a row only says that its conversation exists.
    """
    small_batches(turns.sparkSession)
    absent = F.coalesce("absent", F.lit(False)) if "absent" in turns.columns else F.lit(False)
    given = [F.col(c).cast("bigint").alias(c) for c in ("conv_id", "turn")] + [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = turns.select(*given, absent.alias("absent"))
    sizes = rows.groupBy(F.col("conv_id").alias("of")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = materialise(sizes.where((F.col("n") > LONG) | (F.col("bytes") > LONG_BYTES)).select("of"), "long")
    some = not long.isEmpty()
    ordinary = rows.join(long, _same("conv_id", "of"), "left_anti") if some else rows
    ordinary = ordinary.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_whole(out), out)
    return ordinary.unionByName(_long_ones(rows, long, out)) if some else ordinary


def damaged(turns: DataFrame) -> DataFrame:
    """The damage of the query, by the checksum of ``conv_id:turn``: dropped rows stay as ``absent``."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind, text, role = F.col("kind"), F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    changed = F.when(kind <= 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), (kind == 0).alias("absent"), copies
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every conversation, after the query's damage."""
    return repair(damaged(read_table(spark, sf_dir, "conversations")))

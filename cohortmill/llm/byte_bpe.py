"""Byte-level BPE encoding by a rank queue with a hierarchical bitmap, and exact decoding.

A text falls into pre-tokens by a pattern. A pre-token that is a token itself gets its id; any other one starts as
bytes in a linked list, and of all neighbours whose bytes together are a token those of the lowest rank merge
next, the leftmost ones first. Positions wait in buckets, one a rank, and a :class:`RankBitmap` of
three levels finds the lowest rank with a bucket in three find-first-set steps whatever the length. A
merge leaves the entries of its old neighbours where they are; they are skipped when they come up, because
their position no longer has that rank. So a pre-token of n bytes takes O(n log n), not O(n^2).

A long pre-token has a queue of its own (:class:`RankQueue`). New short ones share one: a bucket then holds positions of
many pre-tokens, and one step merges the leftmost of each of them (:class:`Together`). A task
remembers the ids of short pre-tokens, about ``REMEMBERED`` at a time. Ids come out packed as little-endian unsigned
32-bit integers; decoding joins the tokens' bytes.

Defined cases: a null text is empty (no ids, no bytes); a text of one unbroken run of any length is one pre-token; repeated
rows get equal results; an empty table gives no rows; extra columns are ignored unless asked for.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm.texts import read_table, small_batches

# Tokens a vocabulary may have and still be broadcast.
MAX_TOKENS = 1_000_000
# Pre-tokens a task remembers, and the longest of them in bytes.
REMEMBERED, LONGEST_REMEMBERED = 400_000, 64
# Pre-tokens, or ids, worked on at a time.
SLICE = 1 << 19


class RankBitmap:
    """A set of ranks. Bit r of the lowest level is rank r; bit w above says that word w of the level below is not zero."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.middle = [0] * ((ranks >> 12) + 1)
        self.top = 0

    def add(self, rank: int) -> None:
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.middle[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def lowest(self) -> int | None:
        bits = self.top
        if not bits:
            return None
        word = (bits & -bits).bit_length() - 1
        bits = self.middle[word]
        word = word << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return word << 6 | (bits & -bits).bit_length() - 1

    def discard(self, rank: int) -> None:
        word = rank >> 6
        self.low[word] &= ~(1 << (rank & 63))
        if not self.low[word]:
            self.middle[word >> 6] &= ~(1 << (word & 63))
            if not self.middle[word >> 6]:
                self.top &= ~(1 << (word >> 6))


class RankQueue:
    """Positions in buckets by rank; :meth:`pop` gives the lowest rank's leftmost position."""

    def __init__(self, ranks: int):
        self.held = RankBitmap(ranks)
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            self.held.add(rank)
        else:
            heappush(bucket, position)

    def pop(self) -> tuple[int, int] | None:
        rank = self.held.lowest()
        if rank is None:
            return None
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.held.discard(rank)
        return rank, position


class Together:
    """Merges in many pre-tokens at once: a bucket holds positions of all of them, as arrays."""

    _NONE = np.int64((1 << 31) - 1)

    def __init__(self, ranks: dict[bytes, int], pairs: tuple[np.ndarray, np.ndarray]):
        self.keys, self.made = pairs
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.held = RankBitmap(max(ranks.values()) + 1)
        self.buckets: dict[int, list[np.ndarray]] = {}

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of what each pair of ids makes together, -1 for nothing."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.made[at], -1)

    def _push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        some = ranks >= 0
        ranks, positions = ranks[some], positions[some]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, a, b in zip(ranks[[0, *cuts]].tolist(), [0, *cuts.tolist()], [*cuts.tolist(), len(ranks)], strict=True):
            if (bucket := self.buckets.get(rank)) is None:
                self.buckets[rank] = [positions[a:b]]
                self.held.add(rank)
            else:
                bucket.append(positions[a:b])

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each of the pre-tokens."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        n = int(ends[-1])
        # Position n stands for no part. Of the part at a position: id, pre-token, the parts beside it, rank with the next.
        ids = np.append(self.bytes[np.frombuffer(b"".join(pieces), np.uint8)], self._NONE)
        of = np.repeat(np.arange(len(pieces)), sizes)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = after[n] = before[ends - sizes] = n
        rank_at = self._find(ids, ids[after])
        rank_at[n] = -1
        self._push(rank_at, np.arange(n + 1))
        gone = np.zeros(n + 1, bool)
        while (rank := self.held.lowest()) is not None:
            self.held.discard(rank)
            held = self.buckets.pop(rank)
            at = held[0] if len(held) == 1 else np.concatenate(held)
            at = at[rank_at[at] == rank]
            if len(at) > 1:
                # The leftmost of each pre-token; what that makes may come before the others.
                at = np.sort(at)
                own = of[at]
                first = np.append(True, own[1:] != own[:-1])
                if not first.all():
                    later = at[~first]
                    self._push(np.full(len(later), rank), later)
                    at = at[first]
            elif not len(at):
                continue
            eaten = after[at]
            onward = after[eaten]
            ids[at] = rank
            after[at] = onward
            before[onward] = at
            rank_at[eaten] = -1
            gone[eaten] = True
            places = np.concatenate([at, before[at]])
            ranks = self._find(ids[places], ids[after[places]])
            rank_at[places] = ranks
            self._push(ranks, places)
        gone[n] = True
        packed = ids[~gone].astype("<u4").tobytes()
        stops = (4 * np.cumsum(np.bincount(of[~gone[:n]], minlength=len(pieces)))).tolist()
        return [packed[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids that make a token together, as sorted keys, and the token's id for each."""
    found = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                found[left << 32 | right] = rank
    keys = np.array(sorted(found) or [-1], np.int64)
    return keys, np.array([found.get(k, -1) for k in keys.tolist()], np.int64)


class Encoder:
    """Ids of pre-tokens under ``ranks`` (token bytes to rank), with a bounded memory."""

    def __init__(self, ranks: dict[bytes, int], pairs: tuple[np.ndarray, np.ndarray] | None = None):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.ranks = ranks
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.together = Together(ranks, pairs or pair_table(ranks))
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.known: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no token itself, with a queue of its own."""
        find, push, pop, n = self.ranks.get, self.queue.push, self.queue.pop, len(piece)
        # Of the part that starts at a position: where it ends, where the one before starts, its rank with the next.
        end, before, rank_at = list(range(1, n + 1)), list(range(-1, n - 1)), [-1] * n
        for at in range(n - 1):
            if (rank := find(piece[at : at + 2])) is not None:
                rank_at[at] = rank
                push(rank, at)
        while (lowest := pop()) is not None:
            rank, at = lowest
            if rank_at[at] != rank:
                continue
            eaten = end[at]
            stop = end[at] = end[eaten]
            rank_at[eaten] = rank_at[at] = -1
            if stop < n:
                before[stop] = at
                if (rank := find(piece[at : end[stop]])) is not None:
                    rank_at[at] = rank
                    push(rank, at)
            if (left := before[at]) >= 0:
                rank = find(piece[left:stop])
                rank_at[left] = -1 if rank is None else rank
                if rank is not None:
                    push(rank, left)
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[piece[at : end[at]]])
            at = end[at]
        return ids

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Remember the packed ids of short pre-tokens; those of long ones come back."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        short, long = [], {}
        for piece in pieces.difference(self.known):
            own = piece.encode()
            if (whole := self.ranks.get(own)) is not None:
                self.known[piece] = whole.to_bytes(4, "little")
            elif len(own) <= LONGEST_REMEMBERED:
                short.append((piece, own))
            else:
                long[piece] = np.array(self.merge(own), "<u4").tobytes()
        if short:
            self.known.update(zip([s[0] for s in short], self.together.merge([s[1] for s in short]), strict=True))
        return long

    def encode_all(self, texts: list[str], pattern) -> list[bytes]:
        """Packed ids of every text; new pre-tokens of about ``SLICE`` of them are merged together."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        count = 0

        def flush() -> None:
            long = self.learn({p for _, own in held for p in own})
            find = self.known.__getitem__ if not long else lambda p: long.get(p) or self.known[p]
            for k, own in held:
                out[k].append(b"".join(map(find, own)))
            held.clear()

        for k, text in enumerate(texts):
            for own in _pre_tokens(text, pattern):
                held.append((k, own))
                count += len(own)
                if count >= SLICE:
                    flush()
                    count = 0
        flush()
        return [b"".join(parts) for parts in out]

    def decode(self, ids: bytes) -> bytes:
        find = self.tokens.__getitem__
        numbers = np.frombuffer(ids, "<u4")
        return b"".join(b"".join(map(find, numbers[at : at + SLICE].tolist())) for at in range(0, len(numbers), SLICE))


def _pre_tokens(text: str, pattern) -> Iterator[list[str]]:
    """Pre-tokens of ``text``, some at a time if it is long."""
    if len(text) <= SLICE:
        yield pattern.findall(text)
        return
    matches = pattern.finditer(text)
    while some := [m.group() for m in islice(matches, SLICE)]:
        yield some


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file with a base64 token and its rank a line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if len(ranks) > MAX_TOKENS:
        raise ValueError(f"{len(ranks)} tokens, more than the {MAX_TOKENS} that may be broadcast")
    return ranks


def _mapped(rows: DataFrame, columns: tuple[str, ...], taken: str, made: str, shared: tuple, convert) -> DataFrame:
    """``columns`` of ``rows`` and ``made`` (binary): ``convert(*shared)`` applied to the values of ``taken``."""
    spark = rows.sparkSession
    small_batches(spark)
    # Plain data, so workers need nothing to read it.
    sent = spark.sparkContext.broadcast(shared)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*columns).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = convert(*sent.value)
        for batch in batches:
            values = pa.array(every(batch.column(len(columns)).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], values], names=[*columns, made])

    return rows.select(*columns, F.col(taken).alias("_taken")).mapInArrow(run, f"{kept}, {made} binary" if kept else f"{made} binary")


def encode_bytes(docs: DataFrame, ranks: dict[bytes, int], pattern: str, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` and ``ids``, the packed ids of its ``text``."""

    def convert(ranks: dict[bytes, int], pairs: tuple):
        import regex

        encoder, compiled = Encoder(ranks, pairs), regex.compile(pattern)
        return lambda texts: encoder.encode_all([t or "" for t in texts], compiled)

    return _mapped(docs, columns, "text", "ids", (ranks, pair_table(ranks)), convert)


def decode_bytes(rows: DataFrame, ranks: dict[bytes, int], columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``rows`` and ``decoded``, the bytes that its packed ``ids`` stand for."""

    def convert(ranks: dict[bytes, int]):
        encoder = Encoder(ranks, (np.array([-1]), np.array([-1])))
        return lambda lists: [encoder.decode(ids or b"") for ids in lists]

    return _mapped(rows, columns, "ids", "decoded", (ranks,), convert)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's ids, and digest of what they decode to."""
    import public_tokenizers

    ranks = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ids = encode_bytes(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    back = decode_bytes(ids, ranks, columns=("doc_id", "ids"))
    return back.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

"""SentencePiece encoding as N-best segmentation, and exact decoding.

The lattice of a text has an edge for every piece of the model that occurs in it, at the piece's
own score, and for a character that no piece covers one edge of its UTF-8 byte pieces, at the
lowest score less ``UNKNOWN_LESS``. The best segmentation has the largest sum of scores.

A text falls into segments wherever no piece of the model can cross: between two characters that
are neighbours in no piece. That cut is exact, so each distinct segment is segmented once: a
forward Viterbi pass gives the best score up to every position, and these are exact
heuristics for an A-star search from the end, which pops whole segmentations in
order of score. The N best of the text differ from the best one in the N - 1 segments whose second
choice costs least, at most, and are merged from these segments' own lists.

As in the model's own rules a text gets a space in front and spaces belong to the piece they
begin; pieces with a space further in (runs of spaces) stay out of the lattice. Decoding joins the
pieces, bytes as they are, and drops the first space: it gives every text back exactly.

Defined cases: a null text has null ids, an empty one has none (score 0, no alternatives); a text
with fewer than N segmentations has fewer alternatives; of equal scores the Viterbi choice leads and the others stand
by ids; an unbroken run of any length takes time and memory in proportion to it; repeated rows get equal
results; extra columns pass through.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cohortmill.llm.texts import read_table, small_batches

NBEST = 4
UNKNOWN_LESS = 10.0
MAX_PIECES = 1_000_000
# Distinct segments a task remembers, and those it segments together.
REMEMBERED = 400_000
TOGETHER = 4096
# Longest segment that is segmented together with others; longer ones go one by one.
WIDEST = 24
# Bytes of text whose new segments are looked up at a time.
ENCODE_BYTES = 1 << 19
_BLOCK = "▁"
_TABLE_BITS = 20


class Pieces:
    """The pieces of a model: costs, byte pieces, and the pairs of characters that pieces hold."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int], skip: set[int]):
        if len(pieces) > MAX_PIECES:
            raise ValueError(f"{len(pieces)} pieces, more than the {MAX_PIECES} that may be broadcast")
        #: What makes this object anew in a task, as plain data.
        self.plain = (pieces, byte_ids, skip)
        texts = [p.replace(_BLOCK, " ") for p, _ in pieces]
        inside = [k for k in range(len(pieces)) if k not in skip and texts[k] and " " not in texts[k][1:]]
        self.cost = {texts[k]: (-pieces[k][1], k) for k in inside}
        self.unknown = max(c for c, _ in self.cost.values()) + UNKNOWN_LESS
        #: Edges by text: cost, ids, size.
        self.edges = {text: (cost, (k,), len(text)) for text, (cost, k) in self.cost.items()}
        self.longest = max(map(len, self.cost))
        self.byte_ids = byte_ids
        self.texts = [t.encode() for t in texts]
        for value, k in enumerate(byte_ids):
            self.texts[k] = bytes([value])
        pairs = sorted({t[i : i + 2] for t in self.cost for i in range(len(t) - 1)})
        self.crossed = np.zeros(1 << _TABLE_BITS, bool)
        symbols = np.frombuffer("".join(pairs).encode("utf-32-le"), np.uint32)
        self.crossed[self._slot(symbols[0::2], symbols[1::2])] = True

    @staticmethod
    def _slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left * np.uint32(0x9E3779B1) ^ right * np.uint32(0x85EBCA77)) >> np.uint32(32 - _TABLE_BITS)

    def segments(self, text: str) -> list[str]:
        """``text`` cut wherever no piece crosses (a shared slot may spare a cut, which changes no result)."""
        symbols = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        cuts = (np.flatnonzero(~self.crossed[self._slot(symbols[:-1], symbols[1:])]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]

    def lattice(self, segment: str) -> list[list[tuple[float, tuple[int, ...], int]]]:
        """For every end the edges into it, longest first: cost, ids, size. Edges of one piece are one object."""
        into: list[list[tuple[float, tuple[int, ...], int]]] = [[] for _ in range(len(segment) + 1)]
        known, longest = self.edges, self.longest
        spelt: dict[str, tuple[float, tuple[int, ...], int]] = {}
        for end in range(1, len(segment) + 1):
            edges = into[end]
            for start in range(max(0, end - longest), end):
                if (found := known.get(segment[start:end])) is not None:
                    edges.append(found)
            if not edges or edges[-1][2] != 1:
                one = segment[end - 1]
                if one not in spelt:
                    spelt[one] = (self.unknown, tuple(self.byte_ids[b] for b in one.encode()), 1)
                edges.append(spelt[one])
        return into

    def viterbi(self, segment: str):
        """Lattice, least cost up to each position, best ids, and what the second choice costs more."""
        into, n = self.lattice(segment), len(segment)
        forward, back = [0.0] + [math.inf] * n, [into[-1][0]] * (n + 1)
        for end in range(1, n + 1):
            for edge in into[end]:
                cost = forward[end - edge[2]] + edge[0]
                if cost < forward[end]:
                    forward[end], back[end] = cost, edge
        # The best way through each edge that the best path leaves out; the least of them comes second.
        backward = [math.inf] * n + [0.0]
        best, at, second, taken = forward[n], n, math.inf, []
        for end in range(n, 0, -1):
            onward = backward[end]
            if onward == math.inf:
                continue
            on_path = back[end] if end == at else None
            for edge in into[end]:
                start, cost = end - edge[2], edge[0] + onward
                if cost < backward[start]:
                    backward[start] = cost
                if edge is not on_path and forward[start] + cost < second:
                    second = forward[start] + cost
            if on_path is not None:
                taken.append(on_path[1])
                at -= on_path[2]
        return into, forward, tuple(k for ids in reversed(taken) for k in ids), second - best

    def nbest(self, segment: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` cheapest segmentations in order: A-star from the end, the forward costs as heuristic.

        A path costs the best path and what each of its edges adds to that, which is nothing on a best path. Of equal
        paths the one nearest to the start goes on, so ties make no wave; and a position is left after ``n``
        visits, as no path among the ``n`` best needs a worse end than its ``n``-th. Entries point back
        to the one they come from, so an entry has the same size at any depth.
        """
        into, forward, first, _ = self.viterbi(segment)
        # What a path adds, where it stands, a number, its edge there, and the entry before.
        heap: list[tuple] = [(0.0, len(segment), 0, None, None)]
        visits = [0] * (len(segment) + 1)
        found: list[tuple[float, tuple[int, ...]]] = []
        pushed = 0
        while heap and len(found) < n:
            entry = heapq.heappop(heap)
            added, at = entry[0], entry[1]
            if at == 0:
                ids: list[int] = []
                while entry[3] is not None:
                    ids += entry[3][1]
                    entry = entry[4]
                found.append((forward[-1] + added, tuple(ids)))
                continue
            if visits[at] >= n:
                continue
            visits[at] += 1
            for edge in into[at]:
                start = at - edge[2]
                pushed += 1
                heapq.heappush(heap, (added + (forward[start] + edge[0] - forward[at]), start, pushed, edge, entry))
        # The Viterbi choice leads, also where others cost the same.
        rest = sorted(x for x in found if x[1] != first)
        return [(forward[-1], first), *rest][:n]

    def decode(self, ids: np.ndarray) -> str:
        texts = self.texts
        return b"".join([texts[k] for k in ids.tolist()])[1:].decode("utf-8", "replace")


class Together:
    """Viterbi over many short segments at once, position by position, for the same results as one by one.

    Pieces are found by 64-bit hashes in two tables: each piece has a slot of its own in the first
    or else in the second.
    """

    _BITS = 19
    _BASE = np.uint64(0x5851F42D4C957F2D)

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        texts = list(pieces.cost)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        symbols = np.zeros((len(texts), pieces.longest), np.uint64)
        for row, text in enumerate(texts):
            symbols[row, : len(text)] = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        hashed, keys = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
        for at in range(pieces.longest):
            hashed = hashed * self._BASE + symbols[:, at] + np.uint64(1)
            keys = np.where(lengths == at + 1, hashed, keys)
        costs = np.array([c for c, _ in pieces.cost.values()])
        ids = np.array([k for _, k in pieces.cost.values()], np.int32)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces share a hash")
        odd = 0x9E3779B97F4A7C15
        while True:
            self.odds, self.tables = [], []
            left = np.arange(len(keys))
            for _ in range(2):
                odd = (odd * 0xD1342543DE82EF95 + 2) & ((1 << 64) - 1) | 1
                slots = self._slots(keys[left], odd)
                _, first = np.unique(slots, return_index=True)
                table = np.full(1 << self._BITS, -1, np.int32)
                table[slots[first]] = left[first]
                self.odds.append(odd)
                self.tables.append(table)
                left = np.delete(left, first)
            if not len(left):
                break
        self.keys, self.costs, self.ids = np.append(keys, 0), np.append(costs, math.inf), np.append(ids, -1)

    def _slots(self, keys: np.ndarray, odd: int) -> np.ndarray:
        return (keys * np.uint64(odd)) >> np.uint64(64 - self._BITS)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, the last number (cost infinite) for none."""
        number = self.tables[0][self._slots(keys, self.odds[0])]
        wrong = np.flatnonzero(self.keys[number] != keys)
        other = self.tables[1][self._slots(keys[wrong], self.odds[1])]
        number[wrong] = np.where(self.keys[other] == keys[wrong], other, len(self.keys) - 1)
        return number

    def viterbi(self, segments: list[str]) -> tuple[list[bytes | None], np.ndarray, np.ndarray]:
        """Best ids (None where a byte piece takes part), costs and gaps of segments of one width at most."""
        count, wide = len(segments), max(map(len, segments))
        lengths = np.fromiter(map(len, segments), np.int64, count)
        flat = np.frombuffer("".join(s.ljust(wide) for s in segments).encode("utf-32-le"), np.uint32)
        symbols = np.ascontiguousarray(flat.reshape(count, wide).T).astype(np.uint64)
        longest = min(self.pieces.longest, wide)
        # cost[size][start], number[size][start]: the piece of that size at that position of every segment.
        cost, number, hashed = [None], [None], np.zeros_like(symbols)
        for size in range(1, longest + 1):
            hashed = hashed[: wide - size + 1] * self._BASE + symbols[size - 1 :] + np.uint64(1)
            found = self.find(hashed.ravel()).reshape(hashed.shape)
            cost.append(self.costs[found])
            number.append(found)
        cost[1] = np.where(np.isinf(cost[1]), self.pieces.unknown, cost[1])
        forward = np.full((wide + 1, count), np.inf)
        forward[0] = 0.0
        back = np.zeros((wide + 1, count), np.int64)
        for end in range(1, wide + 1):
            for size in range(min(end, longest), 0, -1):
                offer = forward[end - size] + cost[size][end - size]
                better = offer < forward[end]
                forward[end][better] = offer[better]
                back[end][better] = size
        backward = np.full((wide + 1, count), np.inf)
        backward[lengths, np.arange(count)] = 0.0
        second, at = np.full(count, np.inf), lengths.copy()
        chosen = np.full((wide, count), -2, np.int64)
        for end in range(wide, 0, -1):
            on_path = at == end
            taken = np.where(on_path, back[end], 0)
            for size in range(1, min(end, longest) + 1):
                onward = cost[size][end - size] + backward[end]
                np.minimum(backward[end - size], onward, out=backward[end - size])
                other = np.where(taken == size, np.inf, forward[end - size] + onward)
                np.minimum(second, other, out=second)
                mine = np.flatnonzero(taken == size)
                chosen[end - 1, mine] = self.ids[number[size][end - size, mine]]
            at = at - taken
        best = forward[lengths, np.arange(count)]
        rows = chosen.T
        used = rows != -2
        data = rows[used].astype(np.int32)
        stops = np.cumsum(used.sum(axis=1))
        raw, whole = data.tobytes(), ~(rows == -1).any(axis=1)
        ids = [raw[4 * a : 4 * b] if w else None for a, b, w in zip([0, *stops[:-1].tolist()], stops.tolist(), whole.tolist(), strict=True)]
        return ids, best, second - best


class Memory:
    """The number of each known segment; best ids (as bytes), costs and gaps stand by number."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.together = pieces, Together(pieces)
        self.lists: dict[str, list] = {}
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.lists.clear()
        self.ids: list[bytes] = []
        self.costs, self.gaps = np.zeros(0), np.zeros(0)

    def learn(self, segments: set[str]) -> None:
        """Segment what is new in ``segments``."""
        new = sorted(segments.difference(self.number), key=len)
        short = np.searchsorted(np.fromiter(map(len, new), np.int64, len(new)), WIDEST, side="right") if new else 0
        costs, gaps = [self.costs], [self.gaps]
        for at in range(0, short, TOGETHER):
            some = new[at : min(at + TOGETHER, short)]
            ids, cost, gap = self.together.viterbi(some)
            for k, own in enumerate(ids):
                if own is None:
                    ids[k] = np.array(self.pieces.viterbi(some[k])[2], np.int32).tobytes()
            self.number.update(zip(some, range(len(self.ids), len(self.ids) + len(some)), strict=True))
            self.ids += ids
            costs.append(cost)
            gaps.append(gap)
        for segment in new[short:]:
            _, forward, own, gap = self.pieces.viterbi(segment)
            self.number[segment] = len(self.ids)
            self.ids.append(np.array(own, np.int32).tobytes())
            costs.append(np.array([forward[-1]]))
            gaps.append(np.array([gap]))
        self.costs, self.gaps = np.concatenate(costs), np.concatenate(gaps)

    def nbest(self, segment: str, n: int):
        if segment not in self.lists:
            if len(segment) > WIDEST:
                return self.pieces.nbest(segment, n)
            self.lists[segment] = self.pieces.nbest(segment, n)
        return self.lists[segment]


def encode_all(texts: list[str], memory: Memory, n: int = NBEST) -> Iterator[tuple]:
    """:func:`encode` of every text, new segments of some texts together."""
    at = 0
    while at < len(texts):
        cut, size = [], 0
        while at + len(cut) < len(texts) and size < ENCODE_BYTES:
            text = texts[at + len(cut)]
            cut.append(memory.pieces.segments(" " + text) if text else [])
            size += len(text)
        if len(memory.number) > REMEMBERED:
            memory.forget()
        memory.learn({s for own in cut for s in own})
        for segments in cut:
            yield encode(segments, memory, n)
        at += len(cut)


def encode(segments: list[str], memory: Memory, n: int = NBEST):
    """Best ids, their score, and the next ``n - 1`` segmentations as ``(score, edits)``.

    An edit ``(at, drop, ids)`` replaces ``drop`` ids of the best segmentation from ``at`` on.
    """
    if not segments:
        return np.zeros(0, np.int32), 0.0, []
    numbers = list(map(memory.number.__getitem__, segments))
    own = list(map(memory.ids.__getitem__, numbers))
    ids = np.frombuffer(b"".join(own), np.int32)
    at = np.array(numbers)
    cost, gaps = float(memory.costs[at].sum()), memory.gaps[at]
    few = min(n - 1, len(gaps))
    kept = np.argpartition(gaps, few - 1)[:few] if 0 < few < len(gaps) else np.arange(len(gaps))
    if few and few < len(gaps):
        # Of equal gaps the earlier segments count.
        limit = gaps[kept].max()
        kept = np.concatenate([np.flatnonzero(gaps < limit), np.flatnonzero(gaps == limit)])[:few]
    ways: list[tuple[float, tuple]] = [(0.0, ())]
    starts = None
    for k in sorted(kept[np.isfinite(gaps[kept])].tolist()):
        if starts is None:
            sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
            starts = np.cumsum(sizes) - sizes
        choices = memory.nbest(segments[k], n)
        base = choices[0][0]
        more = []
        for spent, edits in ways:
            for price, chosen in choices:
                edit = () if chosen is choices[0][1] else ((int(starts[k]), int(sizes[k]), chosen),)
                more.append((spent + price - base, edits + edit))
        ways = sorted(more)[:n]
    return ids, -cost, [(-(cost + spent), edits) for spent, edits in ways[1:]]


def load_pieces(path: str) -> Pieces:
    """Pieces of a SentencePiece model file; control, unknown and byte pieces stay out of the lattice."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    byte_ids = [model.piece_to_id(f"<0x{value:02X}>") for value in range(256)]
    skip = {k for k in every if model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k)}
    return Pieces([(model.id_to_piece(k), model.get_score(k)) for k in every], byte_ids, skip)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_EDITS = pa.list_(pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))]))
_ALTERNATIVES = pa.list_(pa.struct([("score", pa.float64()), ("edits", _EDITS)]))
ENCODED = "ids array<int>, score double, alternatives array<struct<score:double,edits:array<struct<at:int,drop:int,ids:array<int>>>>>, round_trip boolean"
# Tokens in an output batch, about.
_OUT_TOKENS = 500_000


def encode_texts(docs: DataFrame, pieces: Pieces, n: int = NBEST, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` with ``ids``, ``score``, ``alternatives`` and ``round_trip`` of its ``text``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(pieces.plain)
    rows = docs.select(*columns, "text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")

    def packed(batch: pa.RecordBatch, first: int, out: list) -> pa.RecordBatch:
        ids = [x[0] for x in out]
        offsets = np.zeros(len(out) + 1, np.int32)
        np.cumsum([0 if x is None else len(x) for x in ids], out=offsets[1:])
        flat = pa.array(np.concatenate([x for x in ids if x is not None] or [np.zeros(0, np.int32)]))
        gone = pa.array([x is None for x in ids])
        whole = pa.ListArray.from_arrays(pa.array(offsets), flat, mask=gone)
        ways = [None if x[2] is None else [{"score": s, "edits": [{"at": a, "drop": d, "ids": list(i)} for a, d, i in e]} for s, e in x[2]] for x in out]
        made = [whole, pa.array([x[1] for x in out], pa.float64()), pa.array(ways, _ALTERNATIVES), pa.array([x[3] for x in out], pa.bool_())]
        own = [batch.column(c).slice(first, len(out)) for c in columns]
        return pa.RecordBatch.from_arrays([*own, *made], names=[*columns, "ids", "score", "alternatives", "round_trip"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(*shared.value)
        memory = Memory(pieces)
        for batch in batches:
            out, first, tokens = [], 0, 0
            texts = batch.column("text").to_pylist()
            for text, (ids, score, ways) in zip(texts, encode_all([t or "" for t in texts], memory, n), strict=True):
                if text is None:
                    out.append((None, None, None, None))
                else:
                    out.append((ids, score, ways, pieces.decode(ids) == text))
                    tokens += len(ids)
                if tokens >= _OUT_TOKENS:
                    yield packed(batch, first, out)
                    out, first, tokens = [], first + len(out), 0
            if out:
                yield packed(batch, first, out)

    return rows.mapInArrow(run, f"{kept}, {ENCODED}" if kept else ENCODED)


def decode_ids(rows: DataFrame, pieces: Pieces, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``rows`` with ``text``, decoded from ``ids``."""
    spark = rows.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(pieces.plain)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*columns).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(*shared.value)
        for batch in batches:
            texts = [None if ids is None else pieces.decode(np.array(ids, np.int32)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(texts, pa.string())], names=[*columns, "text"])

    return rows.select(*columns, "ids").mapInArrow(run, f"{kept}, text string")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, score and alternatives of every document, and whether decoding gives its text back."""
    return encode_texts(read_table(spark, sf_dir, "documents"), load_pieces(model_path()))

"""Byte-level BPE against the tiktoken library, quadratic merging and round trips."""

import hashlib
import random
import struct
import time

import public_tokenizers
import pytest
import regex
import tiktoken

from cohortmill.llm import byte_bpe
from llm.llm_entry import QUERIES
from llm.samples import no_docs, odd_docs, odd_rows, odd_texts

SF = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def unpacked(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


def slow_merge(ranks, piece):
    parts = [bytes([b]) for b in piece]
    while True:
        offers = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not offers:
            return [ranks[p] for p in parts]
        k = min(offers)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def random_texts():
    rng = random.Random(12)
    alphabets = ["ab", "the in", "aeiourst ", " \n\t\r", "0123 .,", "'srelvm ", "é日本語ℵ🙂", "".join(map(chr, range(1, 300))), "-=", "\x1c\x85　a"]
    return ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(1, 80))) for _ in range(800)] + [
        "".join(rng.choice(a) for _ in range(rng.randint(100, 3000))) for a in alphabets for _ in range(6)
    ]


def test_ids_equal_the_library(ranks, library):
    encoder, pattern = byte_bpe.Encoder(ranks), regex.compile(PATTERN)
    for text in [*random_texts(), *(t for t in odd_texts() if t is not None)]:
        ids = encoder.encode_all([text], pattern)[0]
        assert unpacked(ids) == library.encode_ordinary(text), text[:80]
        assert encoder.decode(ids) == text.encode()


def test_any_ranks_merge_lowest_and_leftmost_first():
    rng = random.Random(5)
    for _ in range(60):
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 300:
            tokens.add(bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))))
        numbers = rng.sample(range(5000), len(tokens))
        ranks = dict(zip(sorted(tokens), numbers, strict=True))
        encoder = byte_bpe.Encoder(ranks)
        for _ in range(40):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40)))
            assert encoder.merge(piece) == slow_merge(ranks, piece)
        pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40))) for _ in range(60)]
        assert [unpacked(ids) for ids in encoder.together.merge(pieces)] == [slow_merge(ranks, p) for p in pieces]
        for held in (encoder.queue, encoder.together):
            assert not held.buckets and not held.held.top and not any(held.held.low) and not any(held.held.middle)


def test_queue_gives_positions_by_rank_then_place():
    rng, queue = random.Random(9), byte_bpe.RankQueue(300_000)
    held = []
    for _ in range(4000):
        if held and rng.random() < 0.4:
            assert queue.pop() == min(held)
            held.remove(min(held))
        else:
            held.append((rng.choice([rng.randrange(300_000), rng.randrange(70)]), rng.randrange(1 << 40)))
            queue.push(*held[-1])
    assert [queue.pop() for _ in range(len(held) + 1)] == [*sorted(held), None]


def test_long_runs_take_time_in_proportion(ranks, library):
    encoder, pattern = byte_bpe.Encoder(ranks), regex.compile(PATTERN)
    rng = random.Random(2)
    for text in ("-" * 200_000, "ation" * 40_000, "".join(rng.choice("etaoinshr") for _ in range(200_000))):
        started = time.perf_counter()
        ids = encoder.encode_all([text], pattern)[0]
        assert time.perf_counter() - started < 20
        assert encoder.decode(ids) == text.encode()
        assert unpacked(encoder.encode_all([text[:20_000]], pattern)[0]) == library.encode_ordinary(text[:20_000])


def test_slices_and_memory_bound_change_nothing(ranks, monkeypatch):
    texts = [*random_texts()[:200], "x" * 300 + " " + "ab" * 500]
    texts.append(" ".join(texts))
    pattern = regex.compile(PATTERN)
    whole = byte_bpe.Encoder(ranks).encode_all(texts, pattern)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 2)
    monkeypatch.setattr(byte_bpe, "SLICE", 7)
    encoder = byte_bpe.Encoder(ranks)
    assert encoder.encode_all(texts, pattern) == whole
    assert [encoder.decode(ids) for ids in whole] == [t.encode() for t in texts]
    assert encoder.encode_all([], pattern) == []


def test_vocabulary_needs_every_byte():
    with pytest.raises(ValueError, match="bytes without a token"):
        byte_bpe.Encoder({b"a": 0})


def test_odd_documents(spark, ranks, library):
    got = byte_bpe.encode_bytes(odd_docs(spark), ranks, PATTERN, columns=("doc_id", "lang"))
    want = sorted(((r[0], r[2], library.encode_ordinary(r[1] or "")) for r in odd_rows()), key=repr)
    assert sorted(((r.doc_id, r.lang, unpacked(r["ids"])) for r in got.collect()), key=repr) == want
    back = byte_bpe.decode_bytes(got, ranks).collect()
    assert sorted(((r.doc_id, bytes(r.decoded)) for r in back), key=repr) == sorted(((r[0], (r[1] or "").encode()) for r in odd_rows()), key=repr)
    assert byte_bpe.encode_bytes(no_docs(spark), ranks, PATTERN).count() == 0


def test_query_equals_the_library(spark, library):
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want[r.doc_id] = (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    got = QUERIES["op12_byte_bpe"](spark, SF)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "string", "string"]
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()} == want

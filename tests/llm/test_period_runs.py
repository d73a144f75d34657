"""Runs, collapsed texts and the grammar below them against brute force."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from cohortmill.llm import period_runs
from cohortmill.llm.recompression import Grammar
from llm.llm_entry import QUERIES
from llm.samples import no_docs, odd_docs, odd_rows

SF = "/root/testdata/sf0.001"


def common(a, b):
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def random_strings():
    rng = random.Random(4)
    out = []
    for _ in range(60):
        n = rng.randint(0, 90)
        s = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(n)]
        while rng.random() < 0.6 and s:
            at, p = rng.randrange(len(s)), rng.randint(1, 9)
            s[at:at] = s[at : at + p] * rng.randint(2, 14)
        out.append(s)
    return out


def test_extensions_equal_brute_force():
    for s in random_strings():
        cut = len(s) // 2
        whole = [100, *s[:cut], 101, *s[cut:], 102, *s[:cut], 103]
        grammar = Grammar(np.array(whole), 100)
        pairs = [(i, j) for i in range(len(whole)) for j in range(0, len(whole), 3) if i != j]
        i, j = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        assert grammar.extend(i, j).tolist() == [common(whole[a:], whole[b:]) for a, b in pairs]
        assert grammar.extend_back(i, j).tolist() == [common(whole[a::-1], whole[b::-1]) for a, b in pairs]


def brute_runs(words):
    """Every maximal stretch by every period, kept where no smaller period fits it."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            stretch = words[start : start + length]
            if length >= max(24, 3 * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


def test_runs_equal_brute_force():
    texts = [[b"w%d" % k for k in s] for s in random_strings()]
    texts += [[b"a"] * n for n in (0, 1, 23, 24, 25, 400)] + [[b"a", b"b", b"c"] * 8, [b"x"] + [b"a", b"b"] * 11 + [b"a"], list(map(lambda k: b"%d" % (k % 9), range(27))), list(map(lambda k: b"%d" % (k % 9), range(26)))]
    got = period_runs.runs_of(texts)
    some = 0
    for words, runs in zip(texts, got, strict=True):
        want = brute_runs(words)
        some += len(want)
        assert list(map(tuple, runs.tolist())) == want, words
        assert period_runs.collapsed(words, runs) == brute_collapsed(words, want)
    assert some > 40


def test_small_blocks_change_nothing(monkeypatch):
    texts = [[b"w%d" % k for k in s] for s in random_strings()]
    whole = [r.tolist() for r in period_runs.runs_of(texts)]
    monkeypatch.setattr(period_runs, "BLOCK", 10)
    assert [r.tolist() for r in period_runs.runs_of(texts)] == whole


@pytest.mark.parametrize("words", [[b"a"] * 60_000, [b"a", b"b", b"c", b"d", b"e"] * 12_000, [b"%d" % (k % 2000) for k in range(60_000)], [b"%d" % (k * k % 60_013) for k in range(60_000)]])
def test_long_texts(words):
    started = time.perf_counter()
    runs = period_runs.runs_of([words])[0].tolist()
    assert time.perf_counter() - started < 20
    periods = {1: 1, 5: 5, 2000: 2000}
    expected = periods.get(len(set(words)))
    assert runs == ([[0, 60_000, expected]] if expected else [])


def test_fibonacci_words_have_their_runs():
    a, b = [b"b"], [b"a"]
    for _ in range(11):
        a, b = b, b + a
    assert list(map(tuple, period_runs.runs_of([b])[0].tolist())) == brute_runs(b)


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    sums = (hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(brute_collapsed(words, runs)).hexdigest())
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sums)


def test_query_equals_brute_force(spark):
    want = [expected_row(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text or "") < 20_000]
    got = QUERIES["op11_period_runs"](spark, SF)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 6 + ["string"] * 2
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = {r.doc_id: tuple(r[n] for n in names) for r in got.collect()}
    assert len(rows) >= 200 and sum(r[1] > 0 for r in rows.values()) > 10
    assert [rows[w[0]] for w in want] == want


def test_odd_documents(spark):
    got = period_runs.period_runs(odd_docs(spark), columns=("doc_id", "lines", "score")).collect()
    by_repr = lambda rows: sorted(rows, key=repr)
    want = []
    for r in odd_rows():
        words = (r[1] or "").encode().split()
        runs = brute_runs(words) if len(words) < 20_000 else []
        want.append((r[0], r[5], len(words), runs, brute_collapsed(words, runs).decode()))
    assert by_repr((r.doc_id, r.lines, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == by_repr(want)
    assert all((r.strongest is None) == (not r.runs) for r in got)
    assert period_runs.period_runs(no_docs(spark)).count() == 0

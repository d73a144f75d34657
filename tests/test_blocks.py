"""Copies by blocks: random edits against a plain scan of every position, and exact round trips."""

import random

import pytest

from cohortmill.operators import blocks

WIDTH = 8


def plainly(new, old, width):
    """Rows ``(start, length, target_start, data)`` found by comparing bytes at every position."""
    own = [old[at : at + width] for at in range(0, len(old), width)]
    rows, at, last, begun = [], 0, -1, 0
    while at < len(new):
        window = new[at : at + width]
        if window not in own:
            at += 1
            continue
        block = last + 1 if last + 1 < len(own) and own[last + 1] == window else own.index(window)
        if begun < at:
            rows.append([begun, at - begun, None, new[begun:at]])
        if rows and rows[-1][2] is not None and rows[-1][0] + rows[-1][1] == at and rows[-1][2] + rows[-1][1] == block * width:
            rows[-1][1] += len(window)
        else:
            rows.append([at, len(window), block * width, None])
        at, last = at + len(window), block
        begun = at
    if begun < at or not new:
        rows.append([begun, at - begun, None, new[begun:]])
    return [tuple(r) for r in rows]


def edited(rng, old):
    new = old
    for _ in range(rng.randint(0, 4)):
        a, b = sorted(rng.randint(0, len(new)) for _ in range(2))
        new = rng.choice([new[:a] + new[b:], new[:a] + bytes(rng.choices(b"ab", k=3)) + new[a:], new[a:] + new[:a], new[:b] + new[a:]])
    return new


def cases():
    rng = random.Random(3)
    for alphabet in (b"a", b"ab", bytes(range(256))):
        for _ in range(60):
            old = bytes(rng.choices(alphabet, k=rng.randint(0, 90)))
            yield edited(rng, old), old


@pytest.mark.parametrize("piece", [1, 7, 8, 20, 1 << 12])
def test_delta_equals_plain_scan(monkeypatch, piece):
    monkeypatch.setattr(blocks, "PIECE_BYTES", piece)
    rolling = blocks.Rolling(WIDTH)
    for new, old in cases():
        weak, strong = blocks._signature(old, blocks.Rolling(WIDTH)) if piece >= WIDTH else _signature_at(monkeypatch, old, piece)
        joined = []
        for row in blocks._delta(new, weak, strong, rolling):
            data = row[3] is not None and joined and joined[-1][3] is not None
            joined[-1:] = [(joined[-1][0], joined[-1][1] + row[1], None, joined[-1][3] + row[3])] if data else joined[-1:] + [row]
        assert joined == plainly(new, old, WIDTH), (new, old)


def _signature_at(monkeypatch, old, piece):
    monkeypatch.setattr(blocks, "PIECE_BYTES", 1 << 12)
    made = blocks._signature(old, blocks.Rolling(WIDTH))
    monkeypatch.setattr(blocks, "PIECE_BYTES", piece)
    return made


def test_equal_weak_checksums_do_not_copy(monkeypatch):
    monkeypatch.setattr(blocks.Rolling, "windows", lambda self, piece: blocks.np.zeros(max(0, len(piece) - self.width + 1), "uint64"))
    rolling = blocks.Rolling(WIDTH)
    for new, old in cases():
        assert list(blocks._delta(new, *blocks._signature(old, rolling), rolling)) == plainly(new, old, WIDTH)


def test_long_runs_are_one_copy():
    rolling = blocks.Rolling(blocks.BLOCK_BYTES)
    old = bytes(10_000_001)
    rows = list(blocks._delta(old + b"x", *blocks._signature(old, rolling), rolling))
    whole = len(old) // blocks.BLOCK_BYTES * blocks.BLOCK_BYTES
    assert rows == [(0, whole, 0, None), (whole, len(old) - whole + 1, None, old[whole:] + b"x")]


def test_round_trip(spark, rows):
    rng = random.Random(5)
    old = {f"sub-{k:02}/x": bytes(rng.choices(b"abcd", k=rng.randint(0, 5000))) for k in range(40)}
    new = {path: edited(rng, text) for path, text in old.items()}
    new |= {"sub-new/x": b"only here", "sub-empty/x": b"", "sub-00/x": b"", "sub-null/x": None}
    old |= {"sub-gone/x": b"only there", "sub-null/x": b"was something"}
    source = spark.createDataFrame(list(new.items()), "path string, content binary")
    target = spark.createDataFrame(list(old.items()), "path string, content binary")
    delta = blocks.block_delta(source, blocks.block_signatures(target, 64), 64).cache()
    changed = {p: c or b"" for p, c in new.items() if p not in old or (c or b"") != (old[p] or b"")}
    assert {r.path: bytes(r.content) for r in blocks.apply_delta(target, delta).collect()} == changed
    sizes = {r.path: (r.moved, r.kept) for r in blocks.moved_bytes(delta).collect()}
    assert all(sum(sizes[p]) == len(c) for p, c in changed.items())
    assert sizes["sub-new/x"] == (9, 0) and sizes["sub-empty/x"] == (0, 0)
    assert sum(moved for moved, _ in sizes.values()) < sum(len(c) for c in changed.values()) / 2
    delta.unpersist()


def test_null_paths_extra_columns_and_empty_tables(spark):
    source = spark.createDataFrame([(None, b"abc", 1), ("p", b"abc", 2)], "path string, content binary, weak int")
    target = spark.createDataFrame([(None, b"abc", "s"), ("p", None, "t")], "path string, content binary, whole string")
    delta = blocks.block_delta(source, blocks.block_signatures(target))
    assert sorted((r.path or "", r.start, r.length, r.target_start, bytes(r.data)) for r in delta.collect()) == [
        ("", 0, 3, None, b"abc"),
        ("p", 0, 3, None, b"abc"),
    ]
    assert blocks.block_delta(source.limit(0), blocks.block_signatures(target)).collect() == []
    assert blocks.block_delta(source, blocks.block_signatures(target.limit(0))).count() == 2

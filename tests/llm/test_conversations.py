"""Repair of conversations against enumeration and against a plain reading of the rules."""

import hashlib
import random
import zlib
from itertools import groupby, product

import pytest

from cohortmill.llm import conversations, turn_alignment
from cohortmill.llm.turn_alignment import ASSISTANT, START, STATES, align, best_audits, fold, repair_audit
from llm.llm_entry import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, cost string, audit string, kind string, n string, told string"


def legal(roles):
    body = roles[1:] if roles[:1] == "s" else roles
    return not roles or (len(body) > 0 and body == "ua" * (len(body) // 2))


def enumerate_audit(codes):
    """All edit sequences with at most two insertions between turns, the cheapest and of these the least."""
    found = []

    def go(at, cost, audit, roles, inserted):
        if found and cost > min(found)[0]:
            return
        if at == len(codes):
            if legal(roles):
                found.append((cost, audit))
        else:
            c = codes[at]
            extra = 5 if c.isupper() else 0
            if c != "x":
                go(at + 1, cost + extra, audit + "K", roles + c.lower(), 0)
                for role in "ua":
                    go(at + 1, cost + extra + 1, audit + "R", roles + role, 0)
            go(at + 1, cost + 2, audit + "D", roles, inserted)
        if inserted < 2:
            for role in "ua":
                go(at, cost + 5, audit + "I", roles + role, inserted + 1)

    go(0, 0, "", "", 0)
    return min(found)


def plain_audit(codes):
    """The same by states, from the end."""
    moves = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    later = {s: {0: (0, ""), 3: (0, "")}.get(s) for s in range(4)}

    def inserted(best):
        for _ in range(2):
            for state, role in ((0, "u"), (1, "u"), (2, "a"), (3, "u")):
                to = best[moves[state, role]]
                if to and (best[state] is None or (to[0] + 5, "I" + to[1]) < best[state]):
                    best[state] = (to[0] + 5, "I" + to[1])
        return best

    best = inserted(later)
    for c in reversed(codes):
        now = {}
        for state in range(4):
            offers = [(best[state][0] + 2, "D" + best[state][1])] if best[state] else []
            for (of, role), to in moves.items():
                if of == state and c != "x" and best[to]:
                    cost = best[to][0] + (5 if c.isupper() else 0)
                    if c.lower() == role:
                        offers.append((cost, "K" + best[to][1]))
                    elif role != "s":
                        offers.append((cost + 1, "R" + best[to][1]))
            now[state] = min(offers, default=None)
        best = inserted(now)
    return best[0]


def random_codes(rng, n):
    return "".join(rng.choice("suaouaxUASO") for _ in range(n))


def test_audits_equal_enumeration():
    rng = random.Random(1)
    for codes in ["", *map("".join, product("suoxA", repeat=2)), *(random_codes(rng, rng.randint(3, 5)) for _ in range(120))]:
        assert repair_audit(codes) == enumerate_audit(codes) == plain_audit(codes), codes


def test_long_audits_equal_states():
    rng = random.Random(2)
    for n in [*range(6, 40), 100, 333]:
        for _ in range(3):
            codes = random_codes(rng, n)
            assert repair_audit(codes) == plain_audit(codes), codes


@pytest.mark.parametrize("segment", [1, 3, 64])
def test_segments_change_nothing(monkeypatch, segment):
    rng = random.Random(3)
    monkeypatch.setattr(turn_alignment, "SEGMENT", segment)
    for _ in range(40):
        codes = random_codes(rng, rng.randint(1, 30))
        for entry in STATES:
            assert fold(codes, entry) == [best_audits(codes, entry, exit) for exit in STATES]


def test_alignment_within_a_limit():
    assert align("ua", "ua", 0) == (0, "KK")
    assert align("ua", "uaua", 9) is None and align("ua", "uaua", 10) == (10, "IIKK")
    assert best_audits("oo", START, ASSISTANT) == (2, "RR")


def plain_report(rows, break_rows=True):
    """Rules of the query read plainly; rows are ``(conv_id, turn, role, text)``."""
    out = []
    for conv_id in sorted({r[0] for r in rows}, key=lambda c: (c is not None, c or 0)):
        turns = []
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv_id), key=lambda r: (r[1] is not None, r[1] or 0)):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20 if break_rows else 19
            if kind == 0:
                continue
            if kind == 1:
                text = ""
            if kind == 2:
                text = "".join(c for c in text if c not in ".!?")
            if kind == 4:
                role = "user"
            turns += [(turn, role, text)] * (2 if kind == 3 else 1)
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        counts, seen, codes = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), ""
        for _, role, text in turns:
            code = role[:1] if role[:1] and role[:1] in "sua" else "o"
            solid = [c for c in text if c not in " \t\n\x0b\x0c\r"]
            if not solid:
                counts["blank"] += 1
                code = "x"
            elif (role, text) in seen:
                counts["duplicate"] += 1
                code = "x"
            elif solid[-1] not in ".!?":
                counts["truncated"] += 1
                code = code.upper()
            seen.add((role, text))
            codes += code
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, audit = plain_audit(codes)
        lines, at = [], 0
        for edit in audit:
            if edit != "I":
                role, text = turns[at][1:]
                at += 1
            if edit in "IR":
                role = "assistant" if lines and lines[-1][0] == "u" else "user"
            if edit == "I":
                text = ""
            if edit != "D":
                lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv_id, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest))
    return out


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def collected(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def odd_rows():
    rng, rows = random.Random(6), []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys", "User"])
            text = rng.choice(["Yes.", "No!", "cut off", "", " \n", None, "Is it?", "A.", "long " * 50, "x.\t"])
            rows.append((conv, rng.choice([turn, turn, turn * 2, None]), role, text))
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (-3, 5, "assistant", "é."), (-3, 5, "assistant", "é.")]
    rows += [(900, None, "user", "a"), (900, None, "user", "a"), (901, 7, "user", "Same."), (901, 7, "assistant", "Same.")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "a", "k", "n", "t") for r in rows], SCHEMA).repartition(5)


def test_odd_conversations_equal_plain_reading(spark):
    rows = odd_rows()
    assert collected(conversations.repair(frame(spark, rows))) == plain_report(rows, break_rows=False)
    assert collected(conversations.repair(conversations.damaged(frame(spark, rows)))) == plain_report(rows)
    assert conversations.repair(frame(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("long", [1, 3])
def test_long_conversations_equal_plain_reading(spark, monkeypatch, long):
    monkeypatch.setattr(conversations, "LONG", long)
    rows = odd_rows() + [(7000, k // 2, "user" if k % 3 else "assistant", f"Text {k % 40}" + ".?x"[k % 3]) for k in range(300)]
    rows += [(7001, None, "user", "Equal.")] * 50
    assert collected(conversations.repair(conversations.damaged(frame(spark, rows)))) == plain_report(rows)


def test_repaired_turns(spark, monkeypatch):
    rows = odd_rows()
    found = {}
    for long in (4096, 2):
        monkeypatch.setattr(conversations, "LONG", long)
        got = conversations.repair(frame(spark, rows), conversations.TURNS).collect()
        found[long] = sorted(((r.conv_id, r.place, r.role, r.text, r.edit) for r in got), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert found[2] == found[4096]
    by_conv = {k: list(v) for k, v in groupby(found[2], key=lambda r: r[0])}
    for conv_id, *_, audit, digest in plain_report(rows, break_rows=False):
        turns = by_conv.get(conv_id, [])
        assert legal("".join(t[2][0] for t in turns)) and "".join(t[4] for t in turns) == audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{t[2]}:{t[3]}" for t in turns).encode()).hexdigest() == digest


def test_query_equals_plain_reading(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_repair"](spark, SF)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 7 + ["string"] * 2
    assert collected(got) == plain_report(rows)

"""Cheapest edits that turn a row of conversation turns into one that a grammar of roles allows.

A turn is a code: the initial of its role where that is s, u or a, else ``o``; in upper case where it is truncated; and
``x`` where it must be deleted. Edits and their audit letters: ``K`` keep (0), ``R`` give another role (1), ``D``
delete (2), ``I`` insert an empty turn (5); a truncated turn that is kept or gets another role costs ``TRUNCATED`` more.
Roles that remain must read ``(s?(ua)+)?``. Only keeping yields an s.

The grammar's strings of one length are few: one or two. :func:`align` is Wagner and Fischer's table of turns
against one such string, filled from the end, within Ukkonen's band: cells whose diagonal alone costs more than the cheapest
alignment known so far are left out. :func:`best_audits` aligns with every feasible length, nearest
lengths first, so a good incumbent narrows the bands and rules lengths out, traces the ASCII-least audit of each table and
compares those of equal cost.

Grammar states let long conversations be aligned in segments: between a segment's ends the string begins in one state and
ends in another, and the cheapest audits of segments add up like matrices (:func:`fold`). That keeps
ties right as well: of two audits of equal cost between the same ends, neither begins with the other.
"""

from __future__ import annotations

from collections.abc import Iterable

DELETE, RENAME, INSERT, TRUNCATED = 2, 1, 5, 5
SEGMENT = 8
# Results a task remembers by their codes.
REMEMBERED = 1 << 16

#: States: nothing yet, behind a system turn, behind a user turn, behind an assistant turn; and where roles lead.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FINAL = (START, ASSISTANT)
_INF = 1 << 60

Audit = tuple[int, str]


def targets(entry: int, exit: int, length: int) -> list[str]:
    """The strings of roles of this length that lead from one state to the other."""
    found = [("", entry)]
    for _ in range(length):
        found = [(text + role, to) for text, state in found for (of, role), to in NEXT.items() if of == state]
    return [text for text, state in found if state == exit]


def diagonal(turns: int, roles: int) -> int:
    """What so many turns against so many roles cost at least."""
    return DELETE * (turns - roles) if turns > roles else INSERT * (roles - turns)


def align(codes: str, target: str, limit: int) -> Audit | None:
    """Least cost, if at most ``limit``, and the ASCII-least audit that makes ``target`` of the turns ``codes``."""
    n, m = len(codes), len(target)
    if diagonal(n, m) > limit:
        return None
    # Cells (i, j): j - i within the band on both sides of the way from corner to corner.
    bands = []
    for i in range(n + 1):
        bands.append([j for j in range(m + 1) if diagonal(i, j) + diagonal(n - i, m - j) <= limit])
    rest: list[dict[int, int]] = [{} for _ in range(n + 2)]
    for i in range(n, -1, -1):
        below, own = rest[i + 1], rest[i]
        code = codes[i] if i < n else "x"
        extra = TRUNCATED if code.isupper() else 0
        initial = code.lower()
        for j in reversed(bands[i]):
            if i == n and j == m:
                own[j] = 0
                continue
            least = below.get(j, _INF) + DELETE if i < n else _INF
            if j < m:
                role = target[j]
                if role != "s":
                    least = min(least, own.get(j + 1, _INF) + INSERT)
                if code != "x":
                    if initial == role:
                        least = min(least, below.get(j + 1, _INF) + extra)
                    elif role != "s":
                        least = min(least, below.get(j + 1, _INF) + RENAME + extra)
            if least < _INF:
                own[j] = least
    cost = rest[0].get(0, _INF)
    if cost > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        now = rest[i][j]
        code = codes[i] if i < n else "x"
        # In ASCII order; a letter is taken if it can begin a cheapest way on.
        if i < n and rest[i + 1].get(j, _INF) + DELETE == now:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and rest[i].get(j + 1, _INF) + INSERT == now:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if code.lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def best_audits(codes: str, entry: int, exit: int) -> Audit | None:
    """The cheapest audit, of equal ones the ASCII-least, whose roles lead from state ``entry`` to ``exit``."""
    forced = codes.count("x")
    usable = len(codes) - forced
    # Deleting everything and two insertions lead anywhere but to a lone s, which needs one turn kept instead.
    limit = DELETE * len(codes) + 2 * INSERT
    found: Audit | None = None
    longest = usable + (limit - DELETE * forced) // INSERT
    for length in sorted(range(longest + 1), key=lambda k: diagonal(usable, k)):
        if DELETE * forced + diagonal(usable, length) > limit:
            break
        for target in targets(entry, exit, length):
            offer = align(codes, target, limit)
            if offer and (found is None or offer < found):
                found, limit = offer, offer[0]
    return found


def segment_audits(codes: str, entry: int, memory: dict) -> tuple[Audit | None, ...]:
    """The best audit of one segment from ``entry`` to each state."""
    if (codes, entry) not in memory:
        if len(memory) >= REMEMBERED:
            memory.clear()
        memory[codes, entry] = tuple(best_audits(codes, entry, exit) for exit in STATES)
    return memory[codes, entry]


def add(before: list[Audit | None], own: Iterable[tuple[Audit | None, ...]]) -> list[Audit | None]:
    """Best audits to each state, ``before`` a part, carried on through that part's audits by entry and exit."""
    out: list[Audit | None] = [None] * len(STATES)
    for entry, row in zip(STATES, own, strict=True):
        head = before[entry]
        if head is None:
            continue
        for exit, tail in zip(STATES, row, strict=True):
            if tail is not None:
                offer = (head[0] + tail[0], head[1] + tail[1])
                if out[exit] is None or offer < out[exit]:
                    out[exit] = offer
    return out


def begin(entry: int) -> list[Audit | None]:
    return [(0, "") if state == entry else None for state in STATES]


def fold(codes: str, entry: int = START, memory: dict | None = None) -> list[Audit | None]:
    """Best audits from ``entry`` to each state over all of ``codes``, segment by segment; ``memory`` keeps those of segments."""
    state, memory = begin(entry), {} if memory is None else memory
    for at in range(0, len(codes), SEGMENT):
        part = codes[at : at + SEGMENT]
        state = add(state, [segment_audits(part, e, memory) if state[e] is not None else (None,) * len(STATES) for e in STATES])
    return state


def repair_audit(codes: str, memory: dict | None = None) -> Audit:
    """Cost and audit of the cheapest repair of a whole conversation."""
    last = fold(codes, START, memory)
    return min(x for x in (last[exit] for exit in FINAL) if x is not None)

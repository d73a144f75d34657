"""Ordered masks: which paths of a study or pack are wanted, the last rule that matches deciding.

A rule includes or excludes what a pattern names, and everything below it. Patterns are compared part by part of a path:
``*`` stands for any characters inside one part, ``?`` for one, ``[...]`` for one of some; a pattern that begins with ``/``
or ``sub-*`` like any other is anchored at the root. A path that no rule matches is wanted if the first
rule excludes, or if there are no rules: whoever starts with exceptions wants the rest.

A list of rules is one boolean expression, and one more that tells which subjects it can reach at all, so
reading a pack still prunes to the folders of these subjects.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortmill.sources.packs import FOLDERS, open_pack, shard_of


@dataclass(frozen=True)
class Rule:
    """``include`` or exclude what ``pattern`` names and what lies below."""

    include: bool
    pattern: str


def include(pattern: str) -> Rule:
    return Rule(True, pattern)


def exclude(pattern: str) -> Rule:
    return Rule(False, pattern)


def pattern_regex(pattern: str) -> str:
    """A regular expression for the paths that a pattern names or that lie below one it names."""
    out, at, text = [], 0, pattern.strip("/")
    while at < len(text):
        c = text[at]
        close = text.find("]", at + 2) if c == "[" else -1
        if c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif close > 0:
            inside = text[at + 1 : close]
            negated = inside[0] in "!^" and len(inside) > 1
            body = re.sub(r"([\\\[\]^&~])", r"\\\1", inside[1:] if negated else inside)
            out.append(f"(?!/)[{'^' if negated else ''}{body}]")
            at = close
        else:
            out.append(re.escape(c))
        at += 1
    return f"^{''.join(out)}(?:/.*)?$" if out else "^.*$"


def default_of(rules: Sequence[Rule]) -> bool:
    return not rules or not rules[0].include


def wanted(path: Column, rules: Sequence[Rule]) -> Column:
    """Whether the rules want ``path``; null for a null path."""
    chosen = [F.when(F.regexp_like(path, F.lit("(?s)" + pattern_regex(r.pattern))), F.lit(r.include)) for r in reversed(rules)]
    return F.when(path.isNotNull(), F.coalesce(*chosen, F.lit(default_of(rules))))


def _literal_subject(pattern: str) -> str | None:
    """The subject whose folder a pattern lies in, if it names one outright."""
    first = pattern.strip("/").split("/")[0]
    return first.removeprefix("sub-") if first.startswith("sub-") and not re.search(r"[*?\[]", first) else None


def _covers_subjects(rule: Rule) -> bool:
    return rule.pattern.strip("/") in ("", "*", "sub-*")


def reachable_subjects(rules: Sequence[Rule]) -> list[str] | None:
    """The only subjects the rules can want anything of; None if that may be any.

    After a rule that excludes all subjects, or from the start if nothing is wanted by default, only included names count.
    """
    known: list[str] | None = None if default_of(rules) else []
    for rule in rules:
        subject = _literal_subject(rule.pattern)
        if _covers_subjects(rule):
            known = None if rule.include else []
        elif rule.include and known is not None:
            if subject is not None:
                known.append(subject)
            elif rule.pattern.strip("/").startswith("sub-") or re.match(r"[*?\[]", rule.pattern.strip("/")) or "s".startswith(rule.pattern[:1]):
                known = None
    return known if known is None else sorted(set(known))


def extract_masked(spark: SparkSession, path: str, rules: Sequence[Rule]) -> DataFrame:
    """Rows of a pack whose paths the rules want; only folders of subjects they can reach, and the dataset's own, are read.

    Rows lie in the folder of their ``subject``, which must be the one their path names.
    """
    packed = open_pack(spark, path)
    subjects = reachable_subjects(rules)
    if subjects is not None:
        folder = F.col("shard") == -1
        for subject in subjects:
            folder = folder | (F.col("shard") == shard_of(F.lit(subject), F.col("shards")))
        mine = F.col("subject").isNull()
        packed = packed.filter(folder & (mine | F.col("subject").isin(subjects) if subjects else mine))
    return packed.filter(wanted(F.col("path"), rules)).drop(*FOLDERS)


def subject_rules(subject: str) -> list[Rule]:
    """Everything of one subject, and what belongs to no subject."""
    return [exclude("sub-*"), include(f"sub-{subject}")]


def session_rules(subject: str, sessions: Sequence[str]) -> list[Rule]:
    """Some sessions of one subject, what of it belongs to no session, and what belongs to no subject."""
    return [*subject_rules(subject), exclude(f"sub-{subject}/ses-*"), *(include(f"sub-{subject}/ses-{s}") for s in sorted(sessions))]

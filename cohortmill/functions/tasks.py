"""Task names, command text, walltimes and resource arithmetic."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F

# Limits the batch settings use.
MIN_LIFETIME_SECONDS = 3 * 3600
LIFETIME_MARGIN_SECONDS = 3600
MEMORY_BUFFER_GB = 3
MB_PER_GB = 1000
WALLTIME_PATTERN = r"^(?:(\d+)-)?(\d+):(\d+)(?::(\d+))?$"

Converter = Callable[[Column], Column]


def task_name(task: str | Column, *items: Column, sep: str | None = None) -> Column:
    """``<task>_<item>``; several item columns render as a quoted tuple.

    The tuple form is the one existing ledgers hold. With ``sep`` the parts are
    joined plainly instead. Null ids are written ``None`` in both forms, so two
    different items never share a name.
    """
    head = F.lit(task) if isinstance(task, str) else task
    text = [c.cast("string") for c in items]
    if sep is not None:
        return F.concat_ws(sep, head, *[F.coalesce(c, F.lit("None")) for c in text])
    if len(text) == 1:
        return F.concat(head, F.lit("_"), F.coalesce(text[0], F.lit("None")))
    quoted = [F.coalesce(F.concat(F.lit("'"), _escape(c), F.lit("'")), F.lit("None")) for c in text]
    return F.concat(head, F.lit("_("), F.concat_ws(", ", *quoted), F.lit(")"))


def _escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))


def one_line(text: Column) -> Column:
    """Newlines to spaces, then runs of four spaces removed."""
    return F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("    "), F.lit(""))


_PLACEHOLDER = re.compile(r"\{\{|\}\}|\{(\w+)\}")


def render_command(
    template: str, arguments: Mapping[str, Column], converters: Mapping[str, Converter] | None = None
) -> Column:
    """Fill ``{name}`` placeholders of ``template`` with columns.

    Converters run on their argument first; ``{{`` and ``}}`` are literal braces. A
    placeholder without an argument raises ``KeyError`` before any plan exists.
    """
    converters = converters or {}
    parts: list[Column] = []
    at = 0
    for match in _PLACEHOLDER.finditer(template):
        literal = template[at : match.start()]
        if match.group(1) is None:
            literal += match.group(0)[0]
        if literal:
            parts.append(F.lit(literal))
        if match.group(1) is not None:
            name = match.group(1)
            if name not in arguments:
                raise KeyError(f"template placeholder without argument: {name}")
            value = converters[name](arguments[name]) if name in converters else arguments[name]
            parts.append(value.cast("string"))
        at = match.end()
    if template[at:]:
        parts.append(F.lit(template[at:]))
    return one_line(F.concat(*parts)) if parts else F.lit("")


def walltime_seconds(text: Column) -> Column:
    """``[D-]HH:MM[:SS]`` in seconds; any other text raises at run time."""

    def number(group: int) -> Column:
        return F.coalesce(
            F.nullif(F.regexp_extract(text, WALLTIME_PATTERN, group), F.lit("")).cast("bigint"), F.lit(0)
        )

    seconds = number(1) * 86400 + number(2) * 3600 + number(3) * 60 + number(4)
    bad = F.raise_error(F.concat(F.lit("unexpected walltime format: "), text)).cast("bigint")
    return F.when(text.isNull(), F.lit(None)).when(text.rlike(WALLTIME_PATTERN), seconds).otherwise(bad)


def worker_lifetime(walltime: Column) -> Column:
    """How long a worker may live inside a walltime given in seconds."""
    return F.greatest(F.lit(MIN_LIFETIME_SECONDS).cast("bigint"), walltime - LIFETIME_MARGIN_SECONDS)


def usable_gb(memory_gb: Column) -> Column:
    return memory_gb - MEMORY_BUFFER_GB


def floor_gb(memory_gb: Column) -> Column:
    return F.floor(memory_gb).cast("bigint")


def floor_mb(memory_gb: Column) -> Column:
    return F.floor(memory_gb * MB_PER_GB).cast("bigint")

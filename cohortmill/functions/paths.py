"""Path text: normalising, variable expansion, ignore patterns."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, functions as F

# Files a derivative folder does not count as study data.
DEFAULT_IGNORES = (
    "*.html",
    "logs/",
    "figures/",
    "*_xfm.*",
    "*.surf.gii",
)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def finished(path: Column) -> Column:
    """``path`` as a generated column of that name, made once per row.

    Name parts and filters on it read the finished text. Spark would otherwise copy the expression that makes
    it into each of them, and move those copies before joins and groupings.
    """
    return F.inline(F.array(F.struct(path.alias("path"))))


def expand_variables(path: Column, variables: Mapping[str, str]) -> Column:
    """Replace ``$NAME`` and ``${NAME}``; names outside the mapping stay as they are.

    The text is cut at each ``$`` once, so a value that itself holds a ``$`` is not
    expanded again.
    """
    if not variables:
        return path
    table = F.create_map(*[F.lit(x) for pair in variables.items() for x in pair])
    pattern = r"^(?:\{(\w+)\}|(\w+))"

    def piece(text: Column) -> Column:
        name = F.concat(F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2))
        known = F.concat(F.try_element_at(table, name), F.regexp_replace(text, pattern, ""))
        return F.coalesce(known, F.concat(F.lit("$"), text))

    def join(cut: Column) -> Column:
        pieces = F.transform(F.slice(cut, 2, F.size(cut) - 1), piece)
        return F.concat(F.get(cut, F.lit(0)), F.array_join(pieces, ""))

    return F.when(F.instr(path, "$") > 0, _bind(F.split(path, r"\$"), join)).otherwise(path)


def collapse_dots(path: Column) -> Column:
    """Fold empty, ``.`` and ``..`` parts of a path away."""
    absolute = path.startswith("/")

    def step(kept: Column, part: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        return (
            F.when(part.isin("", "."), kept)
            .when(part != "..", F.array_append(kept, part))
            .when(last.isNotNull() & (last != ".."), F.slice(kept, 1, F.size(kept) - 1))
            .when(absolute, kept)
            .otherwise(F.array_append(kept, part))
        )

    parts = F.reduce(F.split(path, "/"), F.array().cast("array<string>"), step)
    joined = F.concat(F.when(absolute, F.lit("/")).otherwise(F.lit("")), F.array_join(parts, "/"))
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit("."))


MESSY = r"//|/$|(?:^|/)\.\.?(?:/|$)|^$"


def normalise_path(path: Column, variables: Mapping[str, str] | None = None) -> Column:
    """Expand variables, fold repeated and dotted parts, drop a trailing slash.

    Repeated slashes and single dots are replaced as text; the fold runs only on what still needs it,
    such as a ``..``.
    """
    short = F.regexp_replace(expand_variables(path, variables or {}), r"/(?:\.?/)+", "/")
    short = F.regexp_replace(F.regexp_replace(short, r"^(?:\./)+", ""), r"(?<=[^/])/\.?$", "")
    return _bind(short, lambda p: F.when(p.rlike(MESSY), collapse_dots(p)).otherwise(p))


def glob_regex(glob: str) -> str:
    """A Java regex for one ignore pattern.

    ``dir/`` matches a folder of that name anywhere; other patterns match the
    file name.
    """
    text = glob.rstrip("/")
    body = "".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in text)
    return rf"(?:^|/){body}/" if glob.endswith("/") else rf"(?:^|/){body}$"


def is_ignored(path: Column, globs: Iterable[str] = DEFAULT_IGNORES) -> Column:
    """True where any pattern matches; one alternation, so one pass per path."""
    patterns = [glob_regex(g) for g in globs]
    return path.rlike("|".join(patterns)) if patterns else F.lit(False)

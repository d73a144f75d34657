"""Name parts of a study path as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The vocabulary of the study's file naming standard.
DATATYPES = ("anat", "func", "fmap", "dwi", "perf", "eeg", "ieeg", "meg", "beh", "pet", "micr")
ENTITY_KEYS = {
    "run": "run",
    "space": "space",
    "label": "label",
    "desc": "desc",
    "mode": "mode",
    "from_": "from",
    "to_": "to",
    "hemi": "hemi",
}


def _part(path: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def subject_of(path: Column) -> Column:
    return _part(path, r"(?:^|/)sub-([^/_.]+)")


def session_of(path: Column) -> Column:
    return _part(path, r"(?:^|[/_])ses-([^/_.]+)")


def _file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def datatype_of(path: Column) -> Column:
    """The folder the file lies in, if it is one of the known data types."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(folder.isin(*DATATYPES), folder)


def entity_of(path: Column, key: str) -> Column:
    """The value of ``_key-value`` in the file name; null when absent.

    Most names lack most keys, so the pattern only runs where the key stands, and once.
    """
    name = _file_name(path)
    values = F.regexp_extract_all(name, F.lit(rf"_{key}-([^_.]+)"), F.lit(1))
    return F.when(F.contains(name, F.lit(f"_{key}-")), F.get(values, F.lit(0)))


def suffix_of(path: Column) -> Column:
    """The last ``_`` part before the first dot; null when it is a ``key-value``."""
    name = _file_name(path)
    last = F.substring_index(F.substring_index(name, ".", 1), "_", -1)
    plain = (F.instr(name, ".") > 0) & (F.instr(last, "-") == 0) & (last != "")
    return F.when(plain, last)


def extension_of(path: Column) -> Column:
    """Everything after the first dot of the file name, without the dot."""
    name = _file_name(path)
    dot = F.instr(name, ".")
    return F.when((dot > 1) & (dot < F.length(name)), F.substr(name, dot + 1))


def parse_entities(df: DataFrame, path: str = "path") -> DataFrame:
    """Add one column per name part of ``path``.

    One projection of built-in expressions; a part nobody selects is pruned.
    Ids stay strings, so ``01`` and ``1`` are different subjects.
    """
    p = F.col(path)
    columns = {
        "subject": subject_of(p),
        "session": session_of(p),
        "datatype": datatype_of(p),
        **{name: entity_of(p, key) for name, key in ENTITY_KEYS.items()},
        "suffix": suffix_of(p),
        "extension": extension_of(p),
    }
    return df.withColumns(columns)

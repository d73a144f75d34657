"""The derivative specification: which output files a finished subject should have."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# The expected derivatives and the order of name parts in their paths.
DEFAULT_SPEC = {
    "queries": {
        "baseline": {
            "preproc": {"datatype": "anat", "desc": "preproc", "suffix": "T1w"},
            "mask": {"datatype": "anat", "desc": "brain", "suffix": "mask"},
            "dseg": {"datatype": "anat", "suffix": "dseg"},
            "tpms": {"datatype": "anat", "label": ["CSF", "GM", "WM"], "suffix": "probseg"},
        },
        "std_xfms": {
            "anat2std_xfm": {
                "datatype": "anat", "extension": "h5", "from": "T1w", "to": [], "suffix": "xfm", "mode": "image",
            },
            "std2anat_xfm": {
                "datatype": "anat", "extension": "h5", "from": [], "to": "T1w", "suffix": "xfm", "mode": "image",
            },
        },
        "surfaces": {
            "t1w_aseg": {"datatype": "anat", "desc": "aseg", "suffix": "dseg"},
            "t1w_aparc": {"datatype": "anat", "desc": "aparcaseg", "suffix": "dseg"},
            "t1w2fsnative_xfm": {
                "datatype": "anat", "extension": "txt", "from": "T1w", "to": "fsnative", "suffix": "xfm",
                "mode": "image",
            },
            "fsnative2t1w_xfm": {
                "datatype": "anat", "extension": "txt", "from": "fsnative", "to": "T1w", "suffix": "xfm",
                "mode": "image",
            },
            "surfaces": {
                "datatype": "anat", "extension": "surf.gii", "hemi": ["L", "R"],
                "suffix": ["inflated", "midthickness", "pial", "smoothwm"],
            },
        },
    },
    "patterns": ["space", "hemi", "from", "to", "mode", "label", "desc"],
}
BASELINE_PREFIXES = ("t1w", "std")
BASELINE_EXTENSIONS = ("nii", "nii.gz")
DEFAULT_EXTENSION = "nii.gz"

SPEC_JSON_SCHEMA = "struct<queries:map<string,map<string,map<string,string>>>>"

ITEM_SCHEMA = (
    "array<struct<unit:int,grp:string,name:string,need_all:boolean,space:string,"
    "suffix:string,desc:string,label:string,mode:string,from_:string,to_:string,hemi:string,"
    "extensions:array<string>,folder:string,tail:string>>"
)


@dataclass(frozen=True)
class DerivativeSpec:
    """Query groups and path patterns; a caller may bring its own of either."""

    queries: Mapping[str, Mapping[str, Mapping[str, object]]]
    patterns: Sequence[str]

    @classmethod
    def load(cls, text: str | None = None, queries=None, patterns=None) -> DerivativeSpec:
        document = json.loads(text) if text else DEFAULT_SPEC
        return cls(
            queries=document["queries"] if queries is None else queries,
            patterns=document["patterns"] if patterns is None else patterns,
        )

    def output_fields(self) -> list[str]:
        """Names of the outputs, baseline ones once per prefix."""
        fields = [f"{prefix}_{name}" for prefix in BASELINE_PREFIXES for name in self.queries["baseline"]]
        return fields + [name for group in ("std_xfms", "surfaces") for name in self.queries[group]]

    def items(self, spaces: Sequence[str], surfaces: bool = False) -> list[dict]:
        """Every expected file of one subject, without the subject: a few dozen rows.

        ``unit`` numbers the (query, space) pairs that must each be found. Each pair
        gets its own ``from``/``to``, so spaces do not influence each other.
        """
        units: list[tuple[str, str, str | None, str | None]] = []
        for space in [None, *spaces]:
            prefix = BASELINE_PREFIXES[0] if space is None else BASELINE_PREFIXES[1]
            units += [("baseline", name, space, f"{prefix}_{name}") for name in self.queries["baseline"]]
        units += [("std_xfms", name, space, name) for space in spaces for name in self.queries["std_xfms"]]
        if surfaces:
            units += [("surfaces", name, None, name) for name in self.queries["surfaces"]]
        rows = []
        for unit, (group, name, space, output) in enumerate(units):
            query = self.queries[group][name]
            for values in _expand(query, space):
                rows.append(self._item(unit, group, output, space if group == "baseline" else None, values))
        return rows

    def _item(self, unit: int, group: str, output: str, space: str | None, values: Mapping[str, str]) -> dict:
        parts = {**values, **({"space": space} if space else {})}
        extension = values.get("extension", DEFAULT_EXTENSION)
        name = "".join(f"_{key}-{parts[key]}" for key in self.patterns if parts.get(key))
        return {
            "unit": unit,
            "grp": group,
            "name": output,
            "need_all": group == "surfaces",
            "space": space,
            "suffix": values["suffix"],
            "desc": values.get("desc"),
            "label": values.get("label"),
            "mode": values.get("mode"),
            "from_": values.get("from"),
            "to_": values.get("to"),
            "hemi": values.get("hemi"),
            "extensions": list(BASELINE_EXTENSIONS) if "extension" not in values else [extension],
            "folder": values.get("datatype", "anat"),
            "tail": f"{name}_{values['suffix']}.{extension}",
        }

    def item_column(self, spaces: Sequence[str], surfaces: bool = False) -> Column:
        """The expected files as one constant array of structs."""
        return F.from_json(F.lit(json.dumps(self.items(spaces, surfaces))), ITEM_SCHEMA)


def _expand(query: Mapping[str, object], space: str | None) -> Iterator[dict[str, str]]:
    """All single-valued forms of a query; an empty ``from``/``to`` takes the space."""
    choices: list[list[tuple[str, str]]] = []
    for key, value in query.items():
        values = list(value) if isinstance(value, (list, tuple)) else [value]
        if not values and key in ("from", "to"):
            values = [space]
        choices.append([(key, v) for v in values if v])
    for combination in itertools.product(*[c for c in choices if c]):
        yield dict(combination)


def spec_read(documents: DataFrame, column: str = "spec", keep: Sequence[str] = ()) -> DataFrame:
    """Specification documents as a long table ``grp, name, entity, values``.

    A scalar entity value gives a one-element array, an empty list an empty one.
    """
    value = F.col("item.value")
    listed = F.from_json(value, "array<string>")
    return (
        documents.select(*keep, F.from_json(column, SPEC_JSON_SCHEMA).alias("doc"))
        .select(*keep, F.explode("doc.queries").alias("grp", "queries"))
        .select(*keep, "grp", F.explode("queries").alias("name", "entities"))
        .select(*keep, "grp", "name", F.explode(F.map_entries("entities")).alias("item"))
        .select(
            *keep,
            "grp",
            "name",
            F.col("item.key").alias("entity"),
            F.when(F.startswith(value, F.lit("[")), listed).otherwise(F.array(value)).alias("values"),
        )
    )

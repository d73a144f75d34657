"""JSON documents: session filters and provenance descriptions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The form of the filter and description documents.
SESSION_BOUND_FILTERS = ("bold", "sbref")
FILTERS = {
    "fmap": {"datatype": "fmap"},
    "bold": {"datatype": "func", "suffix": "bold"},
    "sbref": {"datatype": "func", "suffix": "sbref"},
    "flair": {"datatype": "anat", "suffix": "FLAIR"},
    "t2w": {"datatype": "anat", "suffix": "T2w"},
    "t1w": {"datatype": "anat", "suffix": "T1w"},
    "roi": {"datatype": "anat", "suffix": "roi"},
}
STANDARD_VERSION = "1.4.0"
DATASET_TYPE = "derivative"
DOI_RESOLVER = "https://doi.org/"
DESCRIPTION_FILE = "dataset_description.json"
SOURCE_KEYS = {"doi": "DatasetDOI", "license": "License"}


def session_filters(sessions: DataFrame) -> DataFrame:
    """One JSON filter document per (subject, session).

    The functional filters are bound to the session, the others are not.
    """
    blocks = []
    for name, fixed in FILTERS.items():
        fields = [F.lit(value).alias(key) for key, value in fixed.items()]
        if name in SESSION_BOUND_FILTERS:
            fields.append(F.col("session").alias("session"))
        blocks.append(F.struct(*fields).alias(name))
    return sessions.select("subject", "session", F.to_json(F.struct(*blocks)).alias("filter_json"))


def write_session_filters(filters: DataFrame, path: str) -> None:
    """The documents as one text file per subject and session, where tools look for them."""
    (
        filters.select("subject", "session", F.col("filter_json").alias("value"))
        .repartitionByRange("subject", "session")
        .sortWithinPartitions("subject", "session")
        .write.mode("overwrite")
        .partitionBy("subject", "session")
        .text(path)
    )


@dataclass(frozen=True)
class Generator:
    """The program a derivative dataset names as its origin."""

    title: str
    name: str
    version: str
    code_url: str
    acknowledgement: str


def read_descriptions(spark: SparkSession, root: str) -> DataFrame:
    """``dataset`` and ``document`` of every description file below ``root``; ``dataset`` is the folder it lies in, from there."""
    files = spark.read.text(root, wholetext=True, pathGlobFilter=DESCRIPTION_FILE, recursiveFileLookup=True)
    folder = F.regexp_replace(F.col("_metadata.file_path"), f"/?{DESCRIPTION_FILE}$", "")
    rest = F.regexp_replace(folder, "^[a-z]+:/*(?=/)", "")
    start = F.lit("/" + root.partition("://")[2].partition("/")[2] if "://" in root else root.removeprefix("file:")).cast("string")
    dataset = F.ltrim(F.substr(rest, F.length(F.rtrim(start, F.lit("/"))) + 1), F.lit("/"))
    return files.select(F.when(dataset == "", ".").otherwise(dataset).alias("dataset"), F.col("value").alias("document"))


def source_descriptions(documents: DataFrame, key: str = "dataset", column: str = "document") -> DataFrame:
    """What a derivative copies from source descriptions: ``<key>, doi, license`` and ``odd``, the keys of another kind.

    Documents are parsed once, as variants. A key that is absent or null gives null. A text is taken as it stands and a number as
    its digits; a truth value, list or object gives null and is named in ``odd``. A document that is no JSON object has neither key; one
    that is no JSON raises. A null document is a dataset without one.
    """
    parsed = documents.select(key, F.parse_json(F.col(column)).alias("v"))

    def kind(name: str) -> Column:
        return F.coalesce(F.schema_of_variant(F.variant_get("v", f"$.{name}", "variant")), F.lit("VOID"))

    def usable(name: str) -> Column:
        return (kind(name) == "STRING") | F.regexp_like(kind(name), F.lit("^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|DOUBLE|FLOAT)"))

    taken = [F.when(usable(name), F.variant_get("v", f"$.{name}", "string")).alias(field) for field, name in SOURCE_KEYS.items()]
    odd = [F.when(~usable(name) & (kind(name) != "VOID"), F.lit(name)) for name in SOURCE_KEYS.values()]
    return parsed.select(key, *taken, F.array_compact(F.array(*odd)).alias("odd"))


def provenance_docs(
    datasets: DataFrame,
    sources: DataFrame,
    generator: Generator,
    key: str = "dataset",
    docker_image: Column | str | None = None,
    singularity_uri: Column | str | None = None,
) -> DataFrame:
    """A description document per dataset: ``<key>, description_json``.

    ``sources`` holds ``<key>, doi, license`` of the source datasets. Both are copied
    only if present, a singularity image wins over a docker one, and null fields drop
    out of the JSON.
    """

    def column(value: Column | str | None) -> Column:
        return value if isinstance(value, Column) else F.lit(value).cast("string")

    docker, uri = column(docker_image), column(singularity_uri)
    kind = F.when(uri.isNotNull(), "singularity").when(docker.isNotNull(), "docker")
    container = F.when(
        kind.isNotNull(),
        F.struct(kind.alias("Type"), F.when(uri.isNull(), docker).alias("Tag"), uri.alias("URI")),
    )
    origin = F.struct(
        F.lit(generator.name).alias("Name"),
        F.lit(generator.version).alias("Version"),
        F.lit(generator.code_url).alias("CodeURL"),
        container.alias("Container"),
    )
    doi = F.col("doi")
    source = F.when(
        doi.isNotNull(),
        F.array(F.struct(F.concat(F.lit(DOI_RESOLVER), doi).alias("URL"), doi.alias("DOI"))),
    )
    document = F.struct(
        F.lit(generator.title).alias("Name"),
        F.lit(STANDARD_VERSION).alias("BIDSVersion"),
        F.lit(DATASET_TYPE).alias("DatasetType"),
        F.array(origin).alias("GeneratedBy"),
        F.lit(generator.acknowledgement).alias("HowToAcknowledge"),
        source.alias("SourceDatasets"),
        F.col("license").alias("License"),
    )
    described = datasets.join(sources.select(key, "doi", "license"), key, "left")
    return described.select(key, F.to_json(document).alias("description_json"))

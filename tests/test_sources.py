import os

import pytest
from pyspark.sql import functions as F

from cohortmill.operators.studies import budget_check, capacity_plan, entity_query, first_k_sessions, first_sessions_list
from cohortmill.operators.studies import sessions, work_items
from cohortmill.operators.manifests import path_rules, validate_manifest
from cohortmill.sources import catalogs, documents, listings, packs, probes
from cohortmill.session import scratch_path, shared_dir

FILES = {
    "dataset_description.json": "{}",
    "participants.tsv": "p",
    "sub-01/ses-01/anat/sub-01_ses-01_T1w.nii.gz": "abc",
    "sub-01/ses-01/func/sub-01_ses-01_bold.nii.gz": "abcd",
    "sub-01/anat/sub-01_T2w.nii": "",
    "sub-1/func/sub-1_bold.nii.gz": "x",
}


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "study"
    for name, text in FILES.items():
        target = root / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text)
    return root


def test_scan_lists_names_sizes_and_times(spark, tree):
    (tree / ".hidden").write_text("h")
    (tree / "empty-folder").mkdir()
    scanned = catalogs.catalog_scan(spark, str(tree))
    assert {r.path: r["size"] for r in scanned.collect()} == {**{n: len(t) for n, t in FILES.items()}, ".hidden": 1}
    assert scanned.filter("abs(unix_timestamp(mtime) - unix_timestamp(current_timestamp())) > 600").count() == 0


def test_scan_expands_variables(spark, tree, monkeypatch):
    monkeypatch.setenv("STUDY_PARENT", str(tree.parent))
    assert catalogs.catalog_scan(spark, "${STUDY_PARENT}/./study/").count() == len(FILES)


def test_probed_manifest(spark, tree, rows):
    wanted = {
        "sub-01": ("input_dir", None),
        "sub-01/ses-01/": ("input_dir", None),
        "participants.tsv": ("input_dir", "not_a_dir"),
        "missing.tsv": ("input_file", "not_found"),
        "new/deep": ("output_dir", None),
        "participants.tsv/x": ("output_file", "parent_not_a_dir"),
        "sub-1": ("output_file", "not_a_file"),
    }
    data = [(f"{tree}/{p}", role) for p, (role, _) in wanted.items()] + [(f"file://{tree}/sub-1", "input_file")]
    probed = probes.probe_paths(spark.createDataFrame(data, "path string, role string"))
    want = [(f"{tree}/{p}", v) for p, (_, v) in wanted.items() if v] + [(f"file://{tree}/sub-1", "not_a_file")]
    assert rows(validate_manifest(probed, path_rules())) == sorted(want, key=repr)


def test_scan_survives_links_and_odd_names(spark, tree):
    (tree / "gone").symlink_to(tree / "nothing-here")
    (tree / "sub-01" / "up").symlink_to(tree)
    with open(os.path.join(os.fsencode(tree), b"bad-\xff"), "w") as f:
        f.write("abc")
    got = {r.path: r["size"] for r in catalogs.catalog_scan(spark, str(tree)).collect()}
    assert set(got) == {*FILES, "gone", "sub-01/up", "bad-\ufffd"} and got["bad-\ufffd"] == 3


def test_roots_expand_once_and_in_both_forms(monkeypatch):
    monkeypatch.setenv("STUDY_HOME", "/home")
    given = {"STUDYX": "/x", "Y": "$STUDYX"}
    assert catalogs.expand_root("$STUDYX/a", given) == catalogs.expand_root("${STUDYX}//./a", given) == "/x/a"
    assert catalogs.expand_root("/$Y/${STUDY_HOME}/$unknown_name", given) == "/$STUDYX/home/$unknown_name"


def test_catalog_is_kept_until_reset(spark, tree, tmp_path):
    kept = str(tmp_path / "kept")
    load = lambda reset=False: catalogs.catalog_load(spark, str(tree), kept, reset)
    assert load().count() == len(FILES)
    (tree / "sub-02").mkdir()
    (tree / "sub-02" / "sub-02_T1w.nii").write_text("n")
    assert load().count() == len(FILES)
    assert load(reset=True).count() == len(FILES) + 1
    assert catalogs.catalog_load(spark, str(tree), None).count() == len(FILES) + 1
    assert {r.subject for r in load().select("subject").distinct().collect()} == {None, "01", "1", "02"}


def test_listing_golden(spark, rows):
    lines = [
        "[Data ][D][ EA  ][FSA][Compr][S]| Permission | User  | Group | Size  | Date | filename",
        "--------------------------------+------------+-------+-------+-------+------+---------",
        "[Saved][-]       [-L-][     ][ ]  drwx------   user    group   0      Mon    sub-01",
        "[Saved][-]       [-L-][     ][ ]  drwx------   user    group   0      Mon    sub-01/ses-01",
        "[Saved][-] f sub-01/ses-01/anat/sub-01_ses-01_run-01_T1w.nii.gz",
        "[Saved][-] f sub-01/ses-01/anat/sub-01_ses-01_run-01_T1w.nii.gz",
        "[Saved][-] f sub-02/anat/sub-02_T1w.nii",
        "[Saved][-] f derivatives/sub-03/x",
        "[Saved][-] f README",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    parsed = listings.listing_ingest(df)
    text = [r.line for r in listings.listing_text(parsed).collect()]
    assert text == ["01", "01,01", "01,01,/anat/sub-01_ses-01_run-01_T1w.nii.gz", "02,,/anat/sub-02_T1w.nii"]
    assert rows(listings.rejected_lines(df)) == [(1,)]


def test_listing_file(spark, tmp_path, rows):
    path = tmp_path / "listing.txt"
    path.write_text("header\n----+----\nx sub-01\nx sub-01/ses-1/func/sub-01_ses-1_bold.nii\n")
    got = listings.listing_ingest(listings.read_listing(spark, str(path)))
    assert [tuple(r) for r in got.collect()] == [("01", None, None), ("01", "1", None)]


def test_listing_fields(spark, rows):
    lines = ["01", "01,01", "01,01,/anat/sub-01_ses-01_run-01_T1w.nii.gz", "02,,/anat/sub-02_T1w.nii.gz", ","]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = rows(listings.parse_listing(df))
    want = [("01", None, False), ("01", "01", False), ("01", "01", True), ("02", None, True), (None, None, False)]
    assert got == sorted(want, key=repr)
    assert ("01", "01", True) in rows(listings.listed_sessions(listings.parse_listing(df)))


def pack_rows(spark):
    data = [
        (None, None, "participants.tsv"), ("01", None, "sub-01/anat/a"), ("01", "1", "sub-01/ses-1/b"),
        ("01", "2", "sub-01/ses-2/c"), ("1", "1", "sub-1/ses-1/d"),
    ]
    return spark.createDataFrame(data, "subject string, session string, path string")


def test_extractions_nest(spark, tmp_path, rows):
    path = str(tmp_path / "pack")
    packs.pack(pack_rows(spark), path, max_bytes=20)
    everything = rows(packs.extract_all(spark, path).select("subject", "session", "path"))
    assert everything == rows(pack_rows(spark))
    subject = {r.path for r in packs.extract_subject(spark, path, "01").collect()}
    assert subject == {"participants.tsv", "sub-01/anat/a", "sub-01/ses-1/b", "sub-01/ses-2/c"}
    session = {r.path for r in packs.extract_sessions(spark, path, "01", {"2"}).collect()}
    assert session == {"participants.tsv", "sub-01/anat/a", "sub-01/ses-2/c"} and session < subject
    wanted = spark.createDataFrame([("01", "2"), ("1", "1")], "subject string, session string")
    assert {r.path for r in packs.extract_many(spark, path, wanted).collect()} == session | {"sub-1/ses-1/d"}
    assert packs.extract_sessions(spark, path).count() == 5


def test_extraction_arguments_are_checked_first(spark):
    with pytest.raises(ValueError, match="requires a subject"):
        packs.extract_sessions(spark, "/nowhere", None, ["1"])
    with pytest.raises(ValueError, match="no session"):
        packs.extract_sessions(spark, "/nowhere", "01", [])


def test_session_filter_files(spark, tmp_path):
    df = documents.session_filters(spark.createDataFrame([("01", "02")], "subject string, session string"))
    path = str(tmp_path / "filters")
    documents.write_session_filters(df, path)
    folder = os.path.join(path, "subject=01", "session=02")
    text = "".join(open(os.path.join(folder, f)).read() for f in os.listdir(folder) if f.startswith("part"))
    assert '"bold":{"datatype":"func","suffix":"bold","session":"02"}' in text and '"t1w"' in text
    assert text.count("session") == 2


@pytest.mark.parametrize(
    "docker,uri,container",
    [
        (None, None, None),
        ("img:1", None, '"Container":{"Type":"docker","Tag":"img:1"}'),
        ("img:1", "u", '"Container":{"Type":"singularity","URI":"u"}'),
    ],
)
def test_provenance_container(spark, docker, uri, container):
    g = documents.Generator("t", "n", "v", "u", "a")
    ids = spark.createDataFrame([("d",)], "dataset string")
    source = spark.createDataFrame([("x", "1", "l")], "dataset string, doi string, license string")
    text = documents.provenance_docs(ids, source, g, docker_image=docker, singularity_uri=uri).first().description_json
    assert (container in text) if container else ("Container" not in text)
    assert "SourceDatasets" not in text and "License" not in text


def test_source_descriptions_of_every_kind(spark, rows):
    data = {
        "both": ('{"DatasetDOI": "10.1/x", "License": "CC0", "Name": "n"}', "10.1/x", "CC0", []),
        "absent": ('{"Name": "n"}', None, None, []),
        "null": ('{"DatasetDOI": null, "License": null}', None, None, []),
        "number": ('{"DatasetDOI": 10.5, "License": 7}', "10.5", "7", []),
        "odd": ('{"DatasetDOI": ["10.1/x"], "License": {"a": 1}}', None, None, ["DatasetDOI", "License"]),
        "truth": ('{"DatasetDOI": true, "License": ""}', None, "", ["DatasetDOI"]),
        "nested": ('{"a": {"DatasetDOI": "x", "License": "y"}}', None, None, []),
        "list": ('["DatasetDOI"]', None, None, []),
        "text": ('"DatasetDOI"', None, None, []),
        "none": (None, None, None, []),
        "quotes": ('{"License": "a \\"b\\" \\u00e9"}', None, 'a "b" é', []),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in data.items()], "dataset string, document string")
    got = documents.source_descriptions(df)
    assert {r.dataset: (r.doi, r.license, r.odd) for r in got.collect()} == {k: v[1:] for k, v in data.items()}
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        documents.source_descriptions(spark.createDataFrame([("x", "{")], df.schema)).collect()


def test_descriptions_are_read_from_their_folders(spark, tmp_path, rows):
    for name, text in (("a/dataset_description.json", '{\n "License": "CC0"}'), ("b/c/dataset_description.json", "{}"), ("a/other.json", "x"), ("dataset_description.json", '{"License": "top"}')):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(text)
    for root in (str(tmp_path / "in"), f"file://{tmp_path}/in/"):
        read = documents.source_descriptions(documents.read_descriptions(spark, root))
        assert rows(read.select("dataset", "license")) == sorted([("a", "CC0"), ("b/c", None), (".", "top")], key=repr)


def study(spark):
    data = [("01", "1", "T1w", 10), ("01", "1", "bold", 5), ("01", None, "T1w", 1), ("02", "1", "bold", 7)]
    return spark.createDataFrame(data, "subject string, session string, suffix string, size long")


def test_work_items_and_budget(spark, rows):
    units = work_items(study(spark))
    assert rows(units) == sorted(
        [
            ("dataset", None, None, 4, 23), ("subject", "01", None, 3, 16), ("subject", "02", None, 1, 7),
            ("session", "01", "1", 2, 15), ("session", "02", "1", 1, 7),
        ],
        key=repr,
    )
    tight = budget_check(units, {"session": 7, "subject": 16, "dataset": 22})
    assert rows(tight.filter("NOT fits").select("granularity")) == [("dataset",), ("session",)]


def test_capacity(spark, rows):
    assert rows(capacity_plan(study(spark), -1).select("level", "workers")) == [("session", 1), ("subject", 1)]
    assert rows(capacity_plan(study(spark), 0).select("level", "workers")) == [("session", 0), ("subject", 0)]
    assert rows(capacity_plan(study(spark).limit(0), 3).select("level", "workers")) == [("session", 0), ("subject", 0)]


def test_entity_query_forms(spark):
    assert entity_query(study(spark), session=None).count() == 1
    assert entity_query(study(spark), suffix=["bold"], subject="01").count() == 1


def test_slice_equals_first_k(spark, rows):
    s = sessions(study(spark), None)
    assert rows(first_k_sessions(s, 1).select("subject", F.array("session"))) == rows(first_sessions_list(s, 1))


def test_scratch_lives_in_the_configured_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def file_bytes(spark, path, size):
    """Bytes and rows of every file of a pack."""
    read = spark.read.parquet(path).select(size.alias("b"), F.input_file_name().alias("file"))
    return {r.file: (r.b, r.n) for r in read.groupBy("file").agg(F.sum("b").alias("b"), F.count("b").alias("n")).collect()}


def test_no_file_of_a_pack_exceeds_the_bound(spark, tmp_path, rows):
    small = [(f"{i % 7:02d}", str(i % 3), f"p{i:05d}", "x" * (i % 90)) for i in range(3000)]
    large = [("03", str(i % 4), f"large-{i}", "y" * 50_000) for i in range(40)]
    giant = [("05", "1", "giant", "z" * 300_000), (None, None, "top", "t")]
    df = spark.createDataFrame(small + large + giant, "subject string, session string, path string, text string").repartition(7)
    path = str(tmp_path / "pack")
    size = packs.row_bytes(df)
    packs.pack(df, path, max_bytes=120_000)
    files = file_bytes(spark, path, size)
    assert all(b <= 120_000 or n == 1 for b, n in files.values())
    assert sum(b for b, _ in files.values()) == df.agg(F.sum(size)).first()[0]
    # Slices of small rows are at least half full on average, so there are few of them.
    assert len(files) < 3 * sum(b for b, _ in files.values()) / 120_000 + 30
    assert rows(packs.extract_all(spark, path)) == rows(df)


def test_a_hot_subject_is_packed_by_many_tasks(spark, tmp_path):
    hot = spark.range(20_000).select(F.lit("hot").alias("subject"), (F.col("id") % 9).cast("string").alias("session"), F.concat(F.lit("p"), "id").alias("path"), F.lit("x" * 100).alias("text"))
    path = str(tmp_path / "pack")
    # Small tables would be merged into one task otherwise.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    packs.pack(hot, path, max_bytes=100_000)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = file_bytes(spark, path, packs.row_bytes(hot))
    assert all(b <= 100_000 for b, _ in files.values()) and len(files) > 20
    tasks = {f.rsplit("/", 1)[-1].split("-")[1] for f in files}
    assert len(tasks) > 1
    assert packs.extract_sessions(spark, path, "hot", {"4"}).count() == 2222


def test_an_empty_pack(spark, tmp_path):
    packs.pack(pack_rows(spark).limit(0), str(tmp_path / "pack"))
    assert not [f for f in os.listdir(tmp_path / "pack") if f.startswith("shards")]

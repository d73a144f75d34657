"""Every operator as a query over the test tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortmill import fixtures as fx
from cohortmill.functions import tasks
from cohortmill.functions.entities import parse_entities
from cohortmill.functions.paths import finished, normalise_path
from cohortmill.operators import batches, blocks, derivatives, health, labels, ledgers, manifests, reports, studies
from cohortmill.plans.pending import pending_sessions
from cohortmill.plans.staged import Stage, run_study
from cohortmill.session import materialise, scratch_path
from cohortmill.sources import catalogs, documents, ledger_store, listings, masks, packs, scratch
from cohortmill.sources.journal import file_system
from cohortmill.sources.spec import DerivativeSpec, spec_read
from cohortmill.streaming import completions, heartbeats as beats

Query = Callable[[SparkSession, str], DataFrame]
SPEC = DerivativeSpec.load()
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# --- flagship -------------------------------------------------------------------


@query
def flagship_pending_sessions(spark, sf):
    return pending_sessions(fx.study(spark, sf), fx.ledger_sessions(spark, sf), "func", sep="|")


# --- sources and sinks ----------------------------------------------------------


@query
def s1_catalog_scan(spark, sf):
    """List a tree written from the customers, one folder per nation and segment."""
    root = scratch_path(spark, "tree")
    lines = fx.table(spark, sf, "customer").select(F.col("c_name").alias("value"), "c_nationkey", "c_mktsegment")
    lines.write.partitionBy("c_nationkey", "c_mktsegment").text(root)
    files = catalogs.catalog_scan(spark, root).filter(F.endswith("path", F.lit(".txt")))
    return files.groupBy(F.substring_index("path", "/", 2).alias("folder")).agg(F.sum("size").alias("bytes"))


@query
def s2_catalog_save_load(spark, sf):
    path = scratch_path(spark, "catalog")
    catalogs.catalog_save(fx.study(spark, sf), path)
    return catalogs.catalog_load(spark, sf, path).select("path", "subject", "session", "suffix", "size")


def listing_lines(spark, sf):
    files = fx.study_files(spark, sf)
    fields = F.concat_ws(" ", F.lit("[Saved][-] -rw-r--r-- user group"), F.col("size").cast("string"), F.col("path"))
    stray = F.concat(F.lit("[Saved][-] code/"), F.col("path"))
    return files.select(F.explode(F.array(fields, stray)).alias("line"))


@query
def s3_listing_ingest(spark, sf):
    return listings.listing_ingest(listing_lines(spark, sf))


@query
def s3_rejected_lines(spark, sf):
    return listings.rejected_lines(listing_lines(spark, sf))


@query
def m2_listed_sessions(spark, sf):
    text = listings.listing_text(listings.listing_ingest(listing_lines(spark, sf)))
    return listings.listed_sessions(listings.parse_listing(text))


def _catalogue(spark, sf) -> DataFrame:
    """The study stored once, for queries whose jobs read it several times."""
    return materialise(fx.study(spark, sf).select("path", "size", "mtime", "subject", "session", "suffix"), "study")


def _packed(spark, sf, catalog: DataFrame | None = None) -> str:
    path = scratch_path(spark, "pack")
    packs.pack(_catalogue(spark, sf) if catalog is None else catalog, path, max_bytes=1 << 20)
    return path


@query
def s4_pack_s5_extract_all(spark, sf):
    return packs.extract_all(spark, _packed(spark, sf)).select("path", "subject", "session", "suffix", "size")


@query
def s6_extract_subjects(spark, sf):
    catalog = _catalogue(spark, sf)
    wanted = studies.subjects(catalog)
    return packs.extract_subjects(spark, _packed(spark, sf, catalog), wanted).select("path", "subject", "session", "size")


@query
def s7_extract_sessions(spark, sf):
    catalog = _catalogue(spark, sf)
    path = _packed(spark, sf, catalog)
    wanted = studies.first_k_sessions(studies.sessions(catalog), 2)
    return packs.extract_many(spark, path, wanted).select("path", "subject", "session", "size")


@query
def s6_extract_subject(spark, sf):
    catalog = _catalogue(spark, sf)
    first = studies.subjects(catalog).agg(F.min("subject")).first()[0]
    return packs.extract_subject(spark, _packed(spark, sf, catalog), first).select("path", "subject", "session", "size")


@query
def s7_extract_some_sessions(spark, sf):
    """The first and last functional session of the subject that comes first."""
    catalog = _catalogue(spark, sf)
    have = studies.sessions(catalog).groupBy("subject").agg(F.min("session").alias("a"), F.max("session").alias("b"))
    one = have.orderBy("subject").first()
    chosen = packs.extract_sessions(spark, _packed(spark, sf, catalog), one["subject"], {one["a"], one["b"]})
    return chosen.select("path", "subject", "session", "size")


@query
def s7_extract_masked(spark, sf):
    """Subjects whose names begin with 1, without their anatomical folders, by ordered rules."""
    rules = [masks.exclude("sub-*"), masks.include("sub-1*"), masks.exclude("sub-*/ses-*/anat")]
    return masks.extract_masked(spark, _packed(spark, sf), rules).select("path", "subject", "session", "size")


@query
def s4_pack_contents(spark, sf):
    """Files with their contents, packed and read back whole."""
    content = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    documents = fx.table(spark, sf, "documents").select(
        F.col("source").alias("subject"),
        F.col("doc_id").cast("string").alias("session"),
        F.concat(F.lit("sub-"), "source", F.lit("/ses-"), F.col("doc_id").cast("string"), F.lit("/text.txt")).alias("path"),
        F.octet_length(content).cast("long").alias("size"),
        content.alias("content"),
    )
    path = scratch_path(spark, "pack")
    packs.pack(documents, path, max_bytes=1 << 20)
    return packs.extract_all(spark, path).select("path", "size", F.sha2("content", 256).alias("sha256"))


@query
def s8_sync_plan(spark, sf):
    plan = manifests.sync_plan(fx.study_files(spark, sf), fx.study_target(spark, sf))
    return plan.select("path", "size", "reason")


@query
def s8_sync_plan_back(spark, sf):
    plan = manifests.sync_plan(fx.study_target(spark, sf), fx.study_files(spark, sf))
    return plan.select("path", "size", "reason")


@query
def s8_sync_plan_times(spark, sf):
    """Copies of the same size whose times differ."""
    files = fx.study_files(spark, sf)
    later = F.when(F.col("size") % 17 == 0, F.col("mtime") + F.expr("INTERVAL 1 SECOND")).otherwise(F.col("mtime"))
    return manifests.sync_plan(files, files.withColumn("mtime", later)).select("path", "size", "reason")


def _text_versions(spark, sf):
    """The texts as files, and as they are after an edit; the last kind is new."""
    doc, kind, text, n = F.col("doc_id"), F.col("doc_id") % 5, F.col("text"), F.length("text")
    third, half = (n / 3).cast("int"), (n / 2).cast("int")
    inserted = F.concat(F.substring(text, F.lit(1), third), doc.cast("string"), F.substring(text, third + 1, n))
    cut = F.concat(F.substring(text, F.lit(1), half), F.substring(text, half + 8, n))
    turned = F.concat(F.substring(text, half + 1, n), F.substring(text, F.lit(1), half))
    after = F.when(kind == 1, inserted).when(kind == 2, cut).when(kind == 3, turned).otherwise(text)
    docs = fx.table(spark, sf, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    path = F.concat(F.lit("texts/"), doc.cast("string")).alias("path")
    old = docs.filter(kind != 4).select(path, F.col("text").cast("binary").alias("content"))
    return old, docs.select(path, after.cast("binary").alias("content"))


@query
def s8_block_delta(spark, sf):
    old, new = _text_versions(spark, sf)
    delta = blocks.block_delta(new, blocks.block_signatures(old, 128), 128)
    return delta.select("path", "start", "length", "target_start", F.md5("data").alias("data_md5"))


@query
def s8_apply_delta(spark, sf):
    old, new = _text_versions(spark, sf)
    made = blocks.apply_delta(old, blocks.block_delta(new, blocks.block_signatures(old)))
    return made.select("path", F.sha2("content", 256).alias("sha256"))


def _scratch(spark, sf):
    files = fx.study(spark, sf).filter("session IS NOT NULL")
    return files.select(
        tasks.task_name("func", F.col("subject"), F.col("session"), sep="|").alias("task_name"), "path", "size"
    )


@query
def s9_retire_scratch(spark, sf):
    return manifests.retire_scratch(_scratch(spark, sf), fx.ledger_sessions(spark, sf))


@query
def s9_keep_scratch(spark, sf):
    path = scratch_path(spark, "scratch")
    packs.rewrite_scratch(_scratch(spark, sf), fx.ledger_sessions(spark, sf), path)
    return spark.read.parquet(path)


@query
def s9_retire_in_place(spark, sf):
    """What stays in a store after the folders of finished items were replaced."""
    path = scratch_path(spark, "scratch-store")
    scratch.scratch_write(_scratch(spark, sf), path, folders=16)
    scratch.scratch_retire(spark, path, fx.ledger_sessions(spark, sf))
    return scratch.scratch_read(spark, path)


@query
def s10_ledger_csv(spark, sf):
    path = scratch_path(spark, "ledger-csv")
    ledger_store.ledger_write_csv(fx.ledger_sessions(spark, sf), path)
    return ledger_store.ledger_read(spark, path)


@query
def s11_ledger_record(spark, sf):
    records = fx.history(spark, sf)
    path = scratch_path(spark, "ledger")
    timed = records.withColumn("recorded_at", F.timestamp_micros("ts_us")).withColumn("position", F.col("event_id"))
    ledger_store.ledger_record(fx.before_run(timed), path, 0)
    ledger_store.ledger_record(fx.during_run(timed), path, 1)
    return ledger_store.ledger_current(spark, path).select("task_name", "did_succeed", "return_code")


@query
def s11_merge_records(spark, sf):
    records = fx.history(spark, sf)
    merged = ledgers.merge_records(fx.before_run(records), fx.during_run(records), fx.ORDER)
    return merged.select("task_name", "did_succeed", "return_code", "event_id")


@query
def s12_session_filters(spark, sf):
    return documents.session_filters(studies.sessions(fx.study(spark, sf)))


@query
def s13_spec_read(spark, sf):
    part = fx.table(spark, sf, "part")
    text = F.concat(
        F.lit('{"queries":{"baseline":{"part'), F.col("p_partkey").cast("string"),
        F.lit('":{"suffix":"'), F.col("p_type"),
        F.lit('","label":["'), F.col("p_brand"), F.lit('","'), F.col("p_name"), F.lit('"]}},'),
        F.lit('"std_xfms":{"part'), F.col("p_partkey").cast("string"),
        F.lit('":{"from":"T1w","to":[]}}},"patterns":[]}'),
    )
    rows = spec_read(part.select(F.col("p_partkey").alias("document"), text.alias("spec")), keep=["document"])
    return rows.withColumn("values", F.array_join("values", ","))


PROVENANCE = documents.Generator(
    title="cohortmill - staged study processing",
    name="cohortmill",
    version="1",
    code_url="https://example.org/cohortmill",
    acknowledgement="Please cite the software you used.",
)


@query
def s14_provenance_docs(spark, sf):
    datasets = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("dataset"), "o_custkey")
    customers = fx.table(spark, sf, "customer")
    sources = datasets.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "dataset",
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("10.1/"), F.col("c_custkey").cast("string"))).alias("doi"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("license"),
    )
    return documents.provenance_docs(datasets.select("dataset"), sources, PROVENANCE, docker_image="example/tool:1")


@query
def s14_source_documents(spark, sf):
    """The same from the sources' own description documents, in which keys may be absent, null or of another kind."""
    orders, customers = fx.table(spark, sf, "orders"), fx.table(spark, sf, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    doi = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit('"10.1/'), F.col("c_custkey").cast("string"), F.lit('"')))
    license = F.when(F.col("c_mktsegment") != "MACHINERY", F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit('"')))
    other = F.get(F.array(F.lit("null"), F.lit("true"), F.lit('["x"]'), F.lit('{"a":1}')), (F.col("o_orderkey") % 4).cast("int"))
    document = F.concat(F.lit('{"DatasetDOI":'), F.coalesce(doi, other), F.lit(',"Name":"source","License":'), F.coalesce(license, other), F.lit("}"))
    bare = F.when(doi.isNull() & license.isNull() & (F.col("o_orderkey") % 3 == 0), F.lit('{"Name":"source"}')).otherwise(document)
    read = documents.source_descriptions(joined.select(F.col("o_orderkey").alias("dataset"), bare.alias("document")))
    return documents.provenance_docs(joined.select(F.col("o_orderkey").alias("dataset")), read, PROVENANCE, docker_image="example/tool:1")


def mixed_files(spark, sf):
    """Study files with reports, logs, figures, transforms and surfaces among them, by run."""
    run, path = F.col("run"), F.col("path")
    other = (
        F.when(run == "1", F.replace(path, F.lit(".nii.gz"), F.lit(".html")))
        .when(run == "2", F.concat(F.lit("logs/"), path))
        .when(run == "3", F.concat(F.lit("sub/figures/"), path))
        .when(run == "4", F.replace(path, F.lit(".nii.gz"), F.lit("_xfm.h5")))
        .when(run == "5", F.replace(path, F.lit(".nii.gz"), F.lit(".surf.gii")))
        .when(run == "6", F.concat(F.lit("mylogs/"), path))
        .otherwise(path)
    )
    return fx.study(spark, sf).select(finished(other))


@query
def s15_apply_ignore(spark, sf):
    return manifests.apply_ignore(mixed_files(spark, sf))


# --- projections, filters, predicates -------------------------------------------


@query
def p1_parse_entities(spark, sf):
    return fx.study(spark, sf).select("path", "subject", "session", "datatype", "run", "suffix", "extension")


@query
def p1_parse_derivative_entities(spark, sf):
    found = parse_entities(fx.found_derivatives(spark, sf, SPEC))
    return found.select("path", "subject", "space", "label", "desc", "mode", "from_", "to_", "suffix", "extension")


@query
def p2_normalise_path(spark, sf):
    path = F.col("path")
    raw = (
        F.when(F.col("suffix") == "bold", F.concat(F.lit("$STUDY/./"), path, F.lit("//")))
        .when(F.col("suffix") == "T1w", F.concat(F.lit("${STUDY}//tmp/x/../../"), path))
        .otherwise(F.concat(F.lit("/data/study/"), path, F.lit("/")))
    )
    return fx.study(spark, sf).select(normalise_path(raw, {"STUDY": "/data/study"}).alias("path"))


@query
def p3_entity_query(spark, sf):
    found = studies.entity_query(fx.study(spark, sf), suffix=["T1w", "bold"], datatype="anat", session=None)
    return found.select("path")


@query
def p4_space_filter(spark, sf):
    catalog = parse_entities(fx.found_derivatives(spark, sf, SPEC))
    plain = derivatives.space_filter(catalog, None).select("path", F.lit("none").alias("asked"))
    return plain.unionByName(
        derivatives.space_filter(catalog, fx.SPACES[1]).select("path", F.lit("second").alias("asked"))
    )


@query
def p5_transform_filter(spark, sf):
    catalog = parse_entities(fx.found_derivatives(spark, sf, SPEC))
    wanted = derivatives.transform_matches(
        mode=F.lit("image"), from_=F.lit("T1w"), to_=F.lit(None).cast("string"), hemis=F.lit(None).cast("array<string>")
    )
    return catalog.filter(wanted).select("path", "to_")


def manifest(spark, sf):
    run = F.col("run").cast("int")
    roles = F.array(*[F.lit(r) for r in manifests.ROLES])
    size = F.col("size") % 3
    return fx.study(spark, sf).select(
        "path",
        F.get(roles, run % 4).alias("role"),
        F.when(size == 1, "file").when(size == 2, "dir").alias("kind"),
        F.when(F.col("suffix") == "sbref", "file").otherwise("dir").alias("parent_kind"),
    )


@query
def p6_validate_manifest(spark, sf):
    return manifests.validate_manifest(manifest(spark, sf), manifests.path_rules())


@query
def p6_manifest_passes(spark, sf):
    return manifests.manifest_passes(manifest(spark, sf), manifests.path_rules())


def misnamed(spark, sf):
    run, path = F.col("run"), F.col("path")
    other = (
        F.when(run == "2", F.regexp_replace(path, "/sub-([^/]+)$", "/sub-x$1"))
        .when(run == "3", F.regexp_replace(path, "/(anat|func)/", "/other/"))
        .when(run == "4", F.regexp_replace(path, "_ses-", "_ses-x"))
        .when(run == "5", F.replace(path, F.lit(".nii.gz"), F.lit("")))
        .otherwise(path)
    )
    return parse_entities(fx.study(spark, sf).select(other.alias("path")))


@query
def p6_naming_rules(spark, sf):
    return manifests.validate_manifest(misnamed(spark, sf), manifests.naming_rules())


TEMPLATE = """
    {tool}
        --participant "{subjectId}"
        --session "{sessionId}" --filter '{{}}'
        --memory {memMB}
"""


@query
def p7_render_jobs(spark, sf):
    sessions = studies.sessions(fx.study(spark, sf))
    command = tasks.render_command(
        TEMPLATE,
        {
            "tool": F.lit("process"),
            "subjectId": F.col("subject"),
            "sessionId": F.col("session"),
            "memMB": F.col("session").cast("bigint") / 8,
        },
        {"memMB": tasks.floor_mb, "subjectId": F.upper},
    )
    return sessions.select("subject", "session", command.alias("command"))


@query
def p8_walltime(spark, sf):
    orders = fx.table(spark, sf, "orders")

    def two(c):
        return F.lpad(c.cast("string"), 2, "0")

    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    hm = F.concat(two(customer % 24), F.lit(":"), two(key % 60))
    hms = F.concat(hm, F.lit(":"), two(customer % 60))
    text = (
        F.when(F.col("o_orderstatus") == "F", F.concat((key % 4).cast("string"), F.lit("-"), hms))
        .when(F.col("o_orderstatus") == "O", hms)
        .otherwise(hm)
    )
    seconds = tasks.walltime_seconds(text)
    return orders.select(
        "o_orderkey", seconds.alias("seconds"), tasks.worker_lifetime(seconds).alias("lifetime")
    )


@query
def p9_resource_budget(spark, sf):
    memory = tasks.usable_gb(F.col("p_retailprice"))
    return fx.table(spark, sf, "part").select(
        "p_partkey", tasks.floor_gb(memory).alias("mem_gb"), tasks.floor_mb(memory).alias("mem_mb")
    )


@query
def p10_task_name(spark, sf):
    subject, session = F.col("o_custkey"), F.col("o_orderkey")
    return fx.table(spark, sf, "orders").select(
        "o_orderkey",
        tasks.task_name("func", subject, session).alias("tuple_name"),
        tasks.task_name("anat", subject).alias("subject_name"),
        tasks.task_name("func", subject, session, sep="|").alias("joined_name"),
    )


# --- joins ----------------------------------------------------------------------


def session_items(spark, sf):
    return batches.name_items(studies.sessions(fx.study(spark, sf)), "func", ["subject", "session"], sep="|")


@query
def j1_skip_done(spark, sf):
    return ledgers.skip_done(session_items(spark, sf), fx.ledger_sessions(spark, sf))


@query
def j2_survivors(spark, sf):
    return ledgers.survivors(session_items(spark, sf), fx.ledger_sessions(spark, sf))


@query
def j3_subject_session_pairs(spark, sf):
    catalog = fx.study(spark, sf)
    return studies.subject_session_pairs(studies.subjects(catalog), studies.sessions(catalog))


@query
def j4_anat_sessions(spark, sf):
    return studies.anat_sessions(fx.study(spark, sf))


@query
def j4_sessions_in(spark, sf):
    catalog = fx.study(spark, sf)
    return studies.sessions_in(studies.sessions(catalog), studies.anat_sessions(catalog))


@query
def j5_session_has_anat(spark, sf):
    return studies.session_has_anat(fx.study(spark, sf))


@query
def j6_expand_spaces(spark, sf):
    items = derivatives.expand_spaces(fx.deriv_subjects(spark, sf), SPEC, fx.SPACES)
    return items.select("subject", "grp", "name", "space", "label", "from_", "to_")


@query
def j7_match_derivatives(spark, sf):
    catalog = parse_entities(fx.found_derivatives(spark, sf, SPEC))
    matches = derivatives.match_derivatives(catalog, SPEC, fx.SPACES)
    return matches.select("subject", "grp", "name", "space", "path")


def resolved(spark, sf):
    expected = derivatives.predict_derivatives(fx.deriv_subjects(spark, sf), SPEC, fx.SPACES)
    return derivatives.resolve_with_fallback(expected, fx.found_derivatives(spark, sf, SPEC))


@query
def j8_resolve_with_fallback(spark, sf):
    return resolved(spark, sf).select("subject", "name", "path", "resolved", "found")


@query
def j9_relabel(spark, sf):
    return labels.relabel(fx.voxels(spark, sf), fx.LUT)


@query
def j9_relabel_table(spark, sf):
    """The same through a table, in which every label stands twice."""
    rows = fx.table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("label")).distinct()
    lut = rows.select("label", F.get(F.array(*[F.lit(v) for v in fx.LUT]), F.col("label")).alias("new_label"))
    return labels.relabel(fx.voxels(spark, sf), lut.unionByName(lut))


def lock_parts(spark, sf):
    events = fx.table(spark, sf, "events").withColumn("subject", F.col("user_id").cast("string"))
    locks = events.filter((F.col("event_type") == "error") & (F.col("event_id") % 7 == 0)).select("subject")
    logs = events.filter(F.col("user_id") % 5 != 0).select("subject", F.col("ts").alias("mtime"))
    return events.select("subject"), locks, logs, events.agg(F.max("ts")).scalar()


@query
def j10_lock_status(spark, sf):
    subjects, locks, logs, now = lock_parts(spark, sf)
    return health.lock_status(subjects, locks, logs, now, fx.TIMEOUT)


@query
def j11_attach_items(spark, sf):
    return ledgers.attach_items(fx.ledger_sessions(spark, sf), session_items(spark, sf))


@query
def j12_pick_reference_session(spark, sf):
    index = studies.session_index(fx.study(spark, sf))
    return studies.pick_reference_session(index).select("subject", "session", "reference_session")


# --- aggregations ---------------------------------------------------------------


@query
def a1_subjects(spark, sf):
    return studies.subjects(fx.study(spark, sf))


@query
def a2_sessions(spark, sf):
    return studies.sessions(fx.study(spark, sf))


@query
def a3_sessions_by_subject(spark, sf):
    return studies.sessions_by_subject(fx.study(spark, sf))


def current_history(spark, sf):
    return fx.current(fx.history(spark, sf))


@query
def a4_batch_summary(spark, sf):
    return ledgers.batch_summary(current_history(spark, sf))


@query
def a4_batch_lists(spark, sf):
    return ledgers.batch_lists(current_history(spark, sf))


@query
def a5_group_report(spark, sf):
    report = reports.group_report(fx.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice")
    rounded = ("mean", "stddev", "quartile1", "median", "quartile3")
    return report.withColumns({c: F.round(c, 4) for c in rounded})


@query
def a6_work_items(spark, sf):
    return studies.work_items(fx.study(spark, sf))


@query
def a7_stage_gate(spark, sf):
    return ledgers.stage_gate(current_history(spark, sf), ["batch"])


@query
def a7_single_gate(spark, sf):
    return ledgers.stage_gate(current_history(spark, sf), single=True)


def found_units(spark, sf):
    catalog = parse_entities(fx.placed_derivatives(spark, sf, SPEC))
    return derivatives.found_units(fx.deriv_subjects(spark, sf), catalog, SPEC, fx.SPACES)


@query
def a8_derivatives_complete(spark, sf):
    return derivatives.derivatives_complete(fx.deriv_subjects(spark, sf), found_units(spark, sf), SPEC, fx.SPACES)


@query
def a8_surfaces_complete(spark, sf):
    subjects, catalog = fx.deriv_subjects(spark, sf), parse_entities(fx.found_surfaces(spark, sf, SPEC))
    found = derivatives.found_units(subjects, catalog, SPEC, fx.SPACES, surfaces=True)
    return derivatives.derivatives_complete(subjects, found, SPEC, fx.SPACES, surfaces=True)


@query
def a9_derivative_cache(spark, sf):
    return derivatives.derivative_cache(fx.deriv_subjects(spark, sf), found_units(spark, sf), SPEC, fx.SPACES)


@query
def a9_derivative_maps(spark, sf):
    cache = derivatives.derivative_cache(fx.deriv_subjects(spark, sf), found_units(spark, sf), SPEC, fx.SPACES)
    listed = derivatives.derivative_maps(cache).select("subject", F.explode("outputs").alias("name", "paths"))
    return listed.withColumn("paths", F.array_join("paths", ","))


@query
def a10_duplicate_keys(spark, sf):
    return ledgers.duplicate_keys(fx.history(spark, sf))


@query
def a11_capacity_plan(spark, sf):
    catalog = fx.study(spark, sf)
    every = studies.capacity_plan(catalog, -1).withColumn("asked", F.lit(-1).cast("bigint"))
    return every.unionByName(studies.capacity_plan(catalog, 2000).withColumn("asked", F.lit(2000).cast("bigint")))


def history_records(spark, sf):
    at = F.struct("ts_us", "event_id")
    before = F.col("ts_us") < F.unix_micros(F.lit(fx.RUN_START).cast("timestamp"))
    return fx.history(spark, sf).select("task_name", "item", F.col("batch").alias("stage"), "batch", "did_succeed", at.alias("at"), before.alias("before"))


@query
def a12_stage_funnel(spark, sf):
    return ledgers.stage_funnel(ledgers.stage_records(history_records(spark, sf), ["item", "stage"]), "item", ["stage0", "stage1", "stage2", "stage3"])


@query
def a13_budget_check(spark, sf):
    limits = {"session": 240, "subject": 1000, "dataset": 300_000_000}
    checked = studies.budget_check(studies.work_items(fx.study(spark, sf)), limits)
    return checked.select("granularity", "subject", "session", "bytes", "limit_bytes", "fits")


@query
def a14_output_fields(spark, sf):
    return derivatives.field_coverage(resolved(spark, sf), SPEC)


@query
def a15_predict_derivatives(spark, sf):
    subjects = fx.deriv_subjects(spark, sf)
    return derivatives.predict_derivatives(subjects, SPEC, fx.SPACES, surfaces=True).select("subject", "name", "path")


# --- windows --------------------------------------------------------------------


@query
def w1_first_k_sessions(spark, sf):
    anat = studies.anat_sessions(fx.study(spark, sf))
    return studies.first_k_sessions(anat, 2)


@query
def w2_latest_record(spark, sf):
    return current_history(spark, sf).select("task_name", "did_succeed", "return_code", "event_id")


@query
def w3_progress(spark, sf):
    tasks_of = ledgers.run_records(history_records(spark, sf), ["task_name", "batch"])
    completions = tasks_of.filter("NOT skipped AND first IS NOT NULL").select("batch", "task_name", "first.*")
    return ledgers.progress(completions, ledgers.batch_totals(tasks_of), order=fx.ORDER).select("batch", "task_name", "done", "total")


# --- sorts, sets ----------------------------------------------------------------


@query
def t1_sorted_distinct(spark, sf):
    return listings.listing_text(listings.listing_ingest(listing_lines(spark, sf)))


@query
def t2_sorted_paths(spark, sf):
    expected = derivatives.predict_derivatives(fx.deriv_subjects(spark, sf), SPEC, fx.SPACES)
    return derivatives.sorted_paths(expected)


@query
def t4_slice(spark, sf):
    lists = studies.first_sessions_list(studies.anat_sessions(fx.study(spark, sf)), 2)
    return lists.withColumn("sessions", F.array_join("sessions", ","))


@query
def g1_union_all(spark, sf):
    subjects = fx.deriv_subjects(spark, sf)
    groups = [
        derivatives.predict_derivatives(subjects, SPEC, []),
        derivatives.predict_derivatives(subjects, SPEC, fx.SPACES).filter("space IS NOT NULL OR grp <> 'baseline'"),
    ]
    return reduce(DataFrame.unionByName, groups).select("grp", "name", "path")


@query
def g2_except_failed(spark, sf):
    return ledgers.failed_items(session_items(spark, sf), fx.ledger_sessions(spark, sf))


@query
def g3_intersect_done(spark, sf):
    return ledgers.already_done(session_items(spark, sf), fx.ledger_sessions(spark, sf))


@query
def g4_distinct(spark, sf):
    return fx.study(spark, sf).select("subject", "datatype", "suffix").distinct()


# --- user functions -------------------------------------------------------------


def check_session(subject: str, session: str) -> batches.TaskResult:
    """A pure task: raises for some sessions, fails for others."""
    number = int(session)
    if number % 5 == 0:
        raise ValueError(f"cannot process {subject}/{session}")
    return batches.TaskResult(number % 3 == 0, number % 3)


@query
def u1_apply_batch(spark, sf):
    results = batches.apply_batch(
        session_items(spark, sf), fx.ledger_sessions(spark, sf), check_session, ["subject", "session"]
    )
    return results.select("task_name", "did_succeed", "return_code", "cached")


def count_rows(rows: int) -> batches.TaskResult:
    return batches.TaskResult(rows % 2 == 0, rows % 97)


@query
def u2_run_once(spark, sf):
    """One dataset-level item whose argument comes from the tables; a success on record is not repeated."""
    rows = fx.table(spark, sf, "orders").count()
    store = scratch_path(spark, "ledger")
    known = ledger_store.ledger_current(spark, store)
    first = batches.run_once(spark, "count", known, count_rows, rows=rows)
    ledger_store.ledger_record(first.unionByName(first.withColumn("task_name", F.lit("other")).withColumn("did_succeed", F.lit(True))), store, 0)
    again = batches.run_once(spark, "other", ledger_store.ledger_current(spark, store), count_rows, rows=rows + 1)
    return first.unionByName(again).select("task_name", "did_succeed", "return_code", "cached")


@query
def u3_cleanup_marks(spark, sf):
    """Marks that the clean-up of every subject left in the shared folder, read back as rows."""
    folder = scratch_path(spark, "marks")
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)

    def leave(did_succeed: bool, subject: str) -> None:
        system, path = file_system(folder)
        # One file per attempt of a task, so files do not grow in number with the subjects.
        with system.open_append_stream(f"{path}/{TaskContext.get().taskAttemptId()}.txt") as out:
            out.write(f"{subject},{did_succeed}\n".encode())

    subjects = batches.name_items(studies.subjects(fx.study(spark, sf)), "anat", ["subject"])
    nothing = ledger_store.ledger_current(spark, scratch_path(spark, "ledger"))
    batches.apply_batch(subjects, nothing, check_subject, ["subject"], leave)
    return spark.read.schema("subject string, did_succeed boolean").csv(folder).dropDuplicates(["subject"])


@query
def u4_struct_items(spark, sf):
    """Items that are one struct, whose fields become named arguments."""
    items = session_items(spark, sf).select("task_name", F.struct("subject", "session").alias("item"))
    results = batches.run_items(items, check_session, ["item"])
    return results.select("task_name", "did_succeed", "return_code")


def check_subject(subject: str) -> batches.TaskResult:
    return batches.TaskResult(int(subject) % 4 != 0, 0)


@query
def plan_staged_run(spark, sf):
    """Anatomical stage, then filters and functional sessions of its survivors."""
    stages = {
        "anatomical": Stage(check_subject),
        "session_functional": Stage(check_session),
    }
    run = run_study(spark, fx.study(spark, sf), scratch_path(spark, "ledger"), "session", stages)
    return run.passed.select("subject", "session", "reference_session")


# --- streams --------------------------------------------------------------------


@query
def x1_stalled_workers(spark, sf):
    seen = fx.heartbeats(spark, sf)
    return health.stalled_workers(seen, seen.agg(F.max("last_seen")).scalar(), fx.TIMEOUT).select("worker")


def event_stream(spark, sf) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def x1_stalled_worker_stream(spark, sf):
    now = fx.table(spark, sf, "events").agg(F.unix_micros(F.max("ts")).alias("now")).first()["now"] / 1_000_000
    seen = event_stream(spark, sf).select(F.col("user_id").cast("string").alias("worker"), F.col("ts").alias("last_seen"))
    out = scratch_path(spark, "alerts")
    beats.periodic_check(seen, out, scratch_path(spark, "cp"), fx.TIMEOUT, clock=lambda: now, once=True).awaitTermination()
    return beats.current_alerts(spark.read.schema(beats.ALERT_SCHEMA).parquet(out))


def _result_stream(spark, sf) -> DataFrame:
    failed = F.col("event_type") == "error"
    stage = F.concat(F.lit("stage"), (F.col("event_id") % 4).cast("string"))
    return event_stream(spark, sf).select(
        F.concat(stage, F.lit("|"), F.col("user_id").cast("string")).alias("task_name"),
        (~failed).alias("did_succeed"),
        failed.cast("int").alias("return_code"),
        F.col("ts").alias("recorded_at"),
        F.col("event_id").alias("position"),
        stage.alias("batch"),
    )


@query
def x2_completion_sink(spark, sf):
    store = scratch_path(spark, "ledger")
    completions.completion_sink(
        _result_stream(spark, sf), store, scratch_path(spark, "cp"), once=True
    ).awaitTermination()
    return ledger_store.ledger_current(spark, store).select("task_name", "did_succeed", "return_code")


@query
def x4_live_progress(spark, sf):
    out = scratch_path(spark, "progress")
    completions.live_progress(
        _result_stream(spark, sf), out, scratch_path(spark, "cp"), once=True
    ).awaitTermination()
    totals = fx.history(spark, sf).groupBy("batch").agg(F.count(F.lit(1)).alias("total"))
    return completions.latest_progress(spark.read.parquet(out), totals)

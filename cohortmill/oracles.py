"""SQL that answers each registered query from the source columns of the test tables."""

from __future__ import annotations

# Subjects, sessions and runs come from the keys; nothing is parsed out of a path.
STUDY = """
f AS (
  SELECT o_custkey AS sub, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_orderkey END AS ses,
         l_linenumber AS run,
         CASE l_returnflag WHEN 'A' THEN 'T1w' WHEN 'R' THEN 'bold' ELSE 'sbref' END AS suffix,
         CAST(sum(l_quantity) AS BIGINT) AS size, max(l_shipdate) AS mtime
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4),
study AS (
  SELECT CAST(sub AS VARCHAR) AS subject, CAST(ses AS VARCHAR) AS session, CAST(run AS VARCHAR) AS run, suffix,
         CASE suffix WHEN 'T1w' THEN 'anat' ELSE 'func' END AS datatype, size, mtime,
         concat('sub-', sub, CASE WHEN ses IS NULL THEN '' ELSE concat('/ses-', ses) END,
           CASE suffix WHEN 'T1w' THEN '/anat/' ELSE '/func/' END, 'sub-', sub,
           CASE WHEN ses IS NULL THEN '' ELSE concat('_ses-', ses) END,
           '_run-', run, '_', suffix, '.nii.gz') AS path,
         concat('sub-', sub, CASE WHEN ses IS NULL THEN '' ELSE concat('/ses-', ses) END) AS folder,
         concat('sub-', sub, CASE WHEN ses IS NULL THEN '' ELSE concat('_ses-', ses) END) AS stem
  FROM f)"""

SESSIONS = STUDY + """,
bold AS (SELECT DISTINCT subject, session FROM study WHERE suffix = 'bold' AND session IS NOT NULL),
anat AS (SELECT DISTINCT subject, session FROM study WHERE suffix = 'T1w' AND session IS NOT NULL),
anat_subjects AS (SELECT DISTINCT subject FROM study WHERE suffix = 'T1w'),
reference AS (SELECT subject, min(session) AS reference_session FROM anat GROUP BY 1)"""

LEDGER_SESSIONS = """
done AS (
  SELECT concat('func|', o_custkey, '|', o_orderkey) AS task_name, o_orderstatus = 'F' AS did_succeed,
         CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS return_code
  FROM orders WHERE o_orderstatus IN ('F', 'O'))"""

ITEMS = SESSIONS + "," + LEDGER_SESSIONS + """,
items AS (SELECT subject, session, concat('func|', subject, '|', session) AS task_name FROM bold)"""

HISTORY = """
history AS (
  SELECT concat('stage', event_id % 4, '|', user_id) AS task_name, event_type <> 'error' AS did_succeed,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS return_code, ts, event_id,
         concat('stage', event_id % 4) AS batch, CAST(user_id AS VARCHAR) AS item
  FROM events),
latest AS (
  SELECT * FROM history
  QUALIFY row_number() OVER (PARTITION BY task_name ORDER BY ts DESC, event_id DESC) = 1),
earlier AS (
  SELECT * FROM history WHERE ts < TIMESTAMP '2024-01-16 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY task_name ORDER BY ts DESC, event_id DESC) = 1)"""

TEXT_VERSIONS = """
versions AS (
  SELECT doc_id, was, CASE doc_id % 5
           WHEN 1 THEN concat(substr(was, 1, length(was) // 3), doc_id, substr(was, length(was) // 3 + 1))
           WHEN 2 THEN concat(substr(was, 1, length(was) // 2), substr(was, length(was) // 2 + 8))
           WHEN 3 THEN concat(substr(was, length(was) // 2 + 1), substr(was, 1, length(was) // 2))
           ELSE was END AS now
  FROM (SELECT doc_id, coalesce(text, '') AS was FROM documents))"""

DERIV = """
subj AS (SELECT CAST(c_custkey AS VARCHAR) AS subject, c_custkey AS key FROM customer),
q(k, base, suffix, descr, label) AS (VALUES
  (0, 'preproc', 'T1w', 'preproc', NULL), (1, 'mask', 'mask', 'brain', NULL), (2, 'dseg', 'dseg', NULL, NULL),
  (3, 'tpms', 'probseg', NULL, 'CSF'), (3, 'tpms', 'probseg', NULL, 'GM'), (3, 'tpms', 'probseg', NULL, 'WM')),
std(space) AS (VALUES ('MNI152NLin2009cAsym'), ('MNI152NLin6Asym')),
sp AS (SELECT space FROM std UNION ALL SELECT NULL),
expected AS (
  SELECT subject, key, k, 'baseline' AS grp, CASE WHEN space IS NULL THEN 't1w_' ELSE 'std_' END || base AS name,
         space, suffix, descr, label, CAST(NULL AS VARCHAR) AS from_, CAST(NULL AS VARCHAR) AS to_,
         concat('sub-', subject, '/anat/sub-', subject, CASE WHEN space IS NULL THEN '' ELSE '_space-' || space END,
           CASE WHEN label IS NULL THEN '' ELSE '_label-' || label END,
           CASE WHEN descr IS NULL THEN '' ELSE '_desc-' || descr END, '_', suffix, '.nii.gz') AS path
  FROM subj, q, sp
  UNION ALL
  SELECT subject, key, 4, 'std_xfms', 'anat2std_xfm', NULL, 'xfm', NULL, NULL, 'T1w', space,
         concat('sub-', subject, '/anat/sub-', subject, '_from-T1w_to-', space, '_mode-image_xfm.h5')
  FROM subj, std
  UNION ALL
  SELECT subject, key, 5, 'std_xfms', 'std2anat_xfm', NULL, 'xfm', NULL, NULL, space, 'T1w',
         concat('sub-', subject, '/anat/sub-', subject, '_from-', space, '_to-T1w_mode-image_xfm.h5')
  FROM subj, std),
resolved AS (
  SELECT *, CASE WHEN (key + k) % 7 = 0 THEN NULL
                 WHEN (key + k) % 5 = 0 THEN regexp_replace(path, '\\.gz$', '') ELSE path END AS resolved
  FROM expected),
complete AS (SELECT subject FROM resolved GROUP BY 1 HAVING count(*) = count(resolved))"""

# Where the files of complete subjects lie: every fourth subject's in a session, every fourth one's name a run.
PLACED = """
placed AS (
  SELECT subject, name, space, CASE key % 4
      WHEN 1 THEN replace(replace(resolved, '/anat/', '/ses-1/anat/'), concat('/sub-', subject, '_'), concat('/sub-', subject, '_ses-1_'))
      WHEN 2 THEN replace(resolved, concat('/sub-', subject, '_'), concat('/sub-', subject, '_run-1_'))
      ELSE resolved END AS path
  FROM resolved WHERE subject IN (SELECT subject FROM complete))"""

EXTENSION = "CASE WHEN grp = 'std_xfms' THEN 'h5' WHEN (key + k) % 5 = 0 THEN 'nii' ELSE 'nii.gz' END"

UNITS = STUDY + """,
units AS (
  SELECT 'dataset' AS granularity, NULL AS subject, NULL AS session, count(*) AS files,
         CAST(sum(size) AS BIGINT) AS bytes FROM study
  UNION ALL
  SELECT 'subject', subject, NULL, count(*), CAST(sum(size) AS BIGINT) FROM study GROUP BY subject
  UNION ALL
  SELECT 'session', subject, session, count(*), CAST(sum(size) AS BIGINT)
  FROM study WHERE session IS NOT NULL GROUP BY subject, session)"""

FILTER_JSON = (
    """concat('{"fmap":{"datatype":"fmap"},"bold":{"datatype":"func","suffix":"bold","session":"', session,"""
    """ '"},"sbref":{"datatype":"func","suffix":"sbref","session":"', session,"""
    """ '"},"flair":{"datatype":"anat","suffix":"FLAIR"},"t2w":{"datatype":"anat","suffix":"T2w"},"""
    """"t1w":{"datatype":"anat","suffix":"T1w"},"roi":{"datatype":"anat","suffix":"roi"}}')"""
)

PROVENANCE_JSON = (
    """concat('{"Name":"cohortmill - staged study processing","BIDSVersion":"1.4.0","DatasetType":"derivative","""
    """"GeneratedBy":[{"Name":"cohortmill","Version":"1","CodeURL":"https://example.org/cohortmill","""
    """"Container":{"Type":"docker","Tag":"example/tool:1"}}],"""
    """"HowToAcknowledge":"Please cite the software you used."',"""
    """ CASE WHEN c_acctbal >= 0 THEN concat(',"SourceDatasets":[{"URL":"https://doi.org/10.1/', c_custkey,"""
    """ '","DOI":"10.1/', c_custkey, '"}]') ELSE '' END,"""
    """ CASE WHEN c_mktsegment <> 'MACHINERY' THEN concat(',"License":"', c_mktsegment, '"') ELSE '' END, '}')"""
)

TARGET = STUDY + """,
target AS (SELECT path, CASE WHEN size % 13 = 0 THEN size + 1 ELSE size END AS size, mtime FROM study WHERE size % 11 <> 0)"""

ROLE = "CASE CAST(run AS INTEGER) % 4 WHEN 0 THEN 'input_dir' WHEN 1 THEN 'input_file' WHEN 2 THEN 'output_dir' ELSE 'output_file' END"
MANIFEST = STUDY + f""",
manifest AS (
  SELECT path, {ROLE} AS role, CASE size % 3 WHEN 1 THEN 'file' WHEN 2 THEN 'dir' END AS kind,
         CASE suffix WHEN 'sbref' THEN 'file' ELSE 'dir' END AS parent_kind FROM study),
violations AS (
  SELECT path, 'not_found' AS violation FROM manifest WHERE role LIKE 'input%' AND kind IS NULL
  UNION ALL SELECT path, 'not_a_dir' FROM manifest WHERE role LIKE '%dir' AND kind = 'file'
  UNION ALL SELECT path, 'not_a_file' FROM manifest WHERE role LIKE '%file' AND kind = 'dir'
  UNION ALL SELECT path, 'parent_not_a_dir' FROM manifest
            WHERE role LIKE 'output%' AND kind IS NULL AND parent_kind = 'file')"""

LISTING = STUDY + """,
listing AS (
  SELECT DISTINCT subject, session,
         CASE WHEN suffix = 'T1w' THEN concat('/anat/', stem, '_run-', run, '_T1w.nii.gz') END AS anat_path FROM study)"""

FUNNEL = "WITH " + HISTORY + """,
r AS (
  SELECT l.item, l.batch AS stage, coalesce(e.did_succeed, FALSE) AS skipped, l.did_succeed
  FROM latest l LEFT JOIN earlier e ON e.task_name = l.task_name),
all_items AS (SELECT DISTINCT item FROM r),
in0 AS (SELECT item FROM all_items),
in1 AS (SELECT item FROM in0 WHERE item IN (SELECT item FROM r WHERE stage = 'stage0' AND (skipped OR did_succeed))),
in2 AS (SELECT item FROM in1 WHERE item IN (SELECT item FROM r WHERE stage = 'stage1' AND (skipped OR did_succeed))),
in3 AS (SELECT item FROM in2 WHERE item IN (SELECT item FROM r WHERE stage = 'stage2' AND (skipped OR did_succeed))),
entered AS (
  SELECT 0 AS position, item FROM in0 UNION ALL SELECT 1, item FROM in1
  UNION ALL SELECT 2, item FROM in2 UNION ALL SELECT 3, item FROM in3)
SELECT CAST(position AS INTEGER) AS position, concat('stage', position) AS stage, count(*) AS items_in,
       count(*) FILTER (WHERE r.skipped) AS skipped,
       count(*) FILTER (WHERE NOT r.skipped AND r.did_succeed) AS successful,
       count(*) FILTER (WHERE NOT r.skipped AND NOT r.did_succeed) AS failed,
       count(*) FILTER (WHERE r.item IS NULL) AS pending
FROM entered e LEFT JOIN r ON r.item = e.item AND r.stage = concat('stage', position) GROUP BY 1, 2"""

STUDY_ROWS = f"WITH {STUDY} SELECT path, subject, session, suffix, size FROM study"
LATEST = f"WITH {HISTORY} SELECT task_name, did_succeed, CAST(return_code AS INTEGER) AS return_code"

ORACLES: dict[str, str] = {
    "flagship_pending_sessions": f"""WITH {ITEMS},
        funcs AS (SELECT subject, count(*) AS func_sessions FROM bold GROUP BY 1)
        SELECT i.subject, i.session, r.reference_session, n.func_sessions, i.task_name
        FROM items i JOIN anat_subjects USING (subject) LEFT JOIN reference r ON r.subject = i.subject
        JOIN funcs n ON n.subject = i.subject
        WHERE i.task_name NOT IN (SELECT task_name FROM done WHERE did_succeed)""",
    "s1_catalog_scan": """
        SELECT concat('c_nationkey=', c_nationkey, '/c_mktsegment=', c_mktsegment) AS folder,
               CAST(sum(length(c_name) + 1) AS BIGINT) AS bytes FROM customer GROUP BY 1""",
    "s2_catalog_save_load": STUDY_ROWS,
    "s3_listing_ingest": f"WITH {LISTING} SELECT subject, session, anat_path FROM listing",
    "s3_rejected_lines": f"WITH {STUDY} SELECT count(*) AS rejected FROM study",
    "m2_listed_sessions": f"""WITH {STUDY}
        SELECT subject, session, bool_or(suffix = 'T1w') AS has_anat FROM study GROUP BY 1, 2""",
    "s4_pack_s5_extract_all": STUDY_ROWS,
    "s6_extract_subjects": f"""WITH {SESSIONS}
        SELECT path, subject, session, size FROM study WHERE subject IN (SELECT subject FROM anat_subjects)""",
    "s7_extract_masked": f"""WITH {STUDY}
        SELECT path, subject, session, size FROM study
        WHERE (path NOT LIKE 'sub-%' OR path LIKE 'sub-1%') AND NOT regexp_matches(path, '^sub-[^/]*/ses-[^/]*/anat(/.*)?$')""",
    "s7_extract_sessions": f"""WITH {SESSIONS},
        wanted AS (SELECT * FROM bold QUALIFY row_number() OVER (PARTITION BY subject ORDER BY session) <= 2)
        SELECT path, subject, session, size FROM study s
        WHERE EXISTS (SELECT 1 FROM wanted w WHERE w.subject = s.subject
                      AND (s.session IS NULL OR w.session = s.session))""",
    "s6_extract_subject": f"""WITH {SESSIONS}
        SELECT path, subject, session, size FROM study WHERE subject = (SELECT min(subject) FROM anat_subjects)""",
    "s7_extract_some_sessions": f"""WITH {SESSIONS},
        one AS (SELECT subject, min(session) AS a, max(session) AS b FROM bold GROUP BY subject ORDER BY subject LIMIT 1)
        SELECT path, s.subject, session, size FROM study s JOIN one ON one.subject = s.subject
        WHERE session IS NULL OR session = a OR session = b""",
    "s4_pack_contents": """
        SELECT concat('sub-', source, '/ses-', doc_id, '/text.txt') AS path,
               CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS size, sha256(coalesce(text, '')) AS sha256
        FROM documents""",
    "s8_sync_plan": f"""WITH {TARGET}
        SELECT s.path, s.size, CASE WHEN t.path IS NULL THEN 'absent' ELSE 'changed' END AS reason
        FROM study s LEFT JOIN target t ON t.path = s.path WHERE t.path IS NULL OR t.size <> s.size""",
    "s8_sync_plan_back": f"""WITH {TARGET}
        SELECT t.path, t.size, 'changed' AS reason FROM target t JOIN study s ON t.path = s.path WHERE t.size <> s.size""",
    "s8_sync_plan_times": f"WITH {STUDY} SELECT path, size, 'changed' AS reason FROM study WHERE size % 17 = 0",
    "s8_block_delta": f"""WITH RECURSIVE {TEXT_VERSIONS},
        old AS (SELECT doc_id, hex(encode(was)) AS h FROM versions WHERE doc_id % 5 <> 4),
        new AS (SELECT doc_id, hex(encode(now)) AS h, octet_length(encode(now)) AS n FROM versions WHERE doc_id % 5 = 4 OR was <> now),
        parts AS (SELECT doc_id, unnest(range(0, (length(h) + 255) // 256)) AS block, h FROM old),
        blocks AS (
          SELECT doc_id, substr(h, 256 * block + 1, 256) AS part, list(block ORDER BY block) AS numbers FROM parts GROUP BY ALL),
        pieces AS (SELECT doc_id, n, base, substr(h, 2 * base + 1, 2048 + 256) AS piece FROM (SELECT *, unnest(range(0, n, 1024)) AS base FROM new)),
        windows AS (
          SELECT doc_id, place, substr(piece, 2 * (place - base) + 1, 256) AS part
          FROM (SELECT *, unnest(range(base, least(base + 1024, n))) AS place FROM pieces)),
        hits AS MATERIALIZED (SELECT doc_id, place, length(part) // 2 AS size, numbers FROM windows JOIN blocks USING (doc_id, part)),
        steps AS (
          SELECT doc_id, 0 AS step, CAST(0 AS BIGINT) AS place, CAST(0 AS BIGINT) AS size, CAST(-1 AS BIGINT) AS block FROM new
          UNION ALL
          SELECT s.doc_id, s.step + 1, min(h.place), arg_min(h.size, h.place),
                 arg_min(CASE WHEN list_contains(h.numbers, s.block + 1) THEN s.block + 1 ELSE h.numbers[1] END, h.place)
          FROM steps s JOIN hits h ON h.doc_id = s.doc_id AND h.place >= s.place + s.size
          GROUP BY s.doc_id, s.step, s.place, s.size, s.block),
        copies AS (
          SELECT *, lag(place + size, 1, -1) OVER w = place AND lag(block) OVER w + 1 = block AS goes_on FROM steps WHERE step > 0
          WINDOW w AS (PARTITION BY doc_id ORDER BY step)),
        runs AS (SELECT *, count(*) FILTER (NOT coalesce(goes_on, FALSE)) OVER (PARTITION BY doc_id ORDER BY step) AS run FROM copies),
        copied AS (
          SELECT doc_id, min(place) AS start, CAST(sum(size) AS BIGINT) AS length, 128 * min(block) AS target_start
          FROM runs GROUP BY doc_id, run),
        ends AS (SELECT doc_id, start, length FROM copied UNION ALL SELECT doc_id, n, 0 FROM new),
        gaps AS (
          SELECT doc_id, lag(start + length, 1, 0) OVER (PARTITION BY doc_id ORDER BY start, length DESC) AS start, start AS stop FROM ends),
        literals AS (
          SELECT doc_id, g.start, stop - g.start AS length, md5(unhex(substr(h, 2 * g.start + 1, 2 * (stop - g.start)))) AS data_md5
          FROM gaps g JOIN new USING (doc_id) WHERE stop > g.start OR n = 0)
        SELECT concat('texts/', doc_id) AS path, start, length, target_start, NULL AS data_md5 FROM copied
        UNION ALL SELECT concat('texts/', doc_id), start, length, NULL, data_md5 FROM literals""",
    "s8_apply_delta": f"""WITH {TEXT_VERSIONS}
        SELECT concat('texts/', doc_id) AS path, sha256(now) AS sha256 FROM versions WHERE doc_id % 5 = 4 OR was <> now""",
    "s9_retire_scratch": f"""WITH {ITEMS},
        scratch AS (SELECT concat('func|', subject, '|', session) AS task_name, path, size FROM study
                    WHERE session IS NOT NULL)
        SELECT * FROM scratch WHERE task_name IN (SELECT task_name FROM done WHERE did_succeed)""",
    "s9_keep_scratch": f"""WITH {ITEMS},
        scratch AS (SELECT concat('func|', subject, '|', session) AS task_name, path, size FROM study
                    WHERE session IS NOT NULL)
        SELECT * FROM scratch WHERE task_name NOT IN (SELECT task_name FROM done WHERE did_succeed)""",
    "s9_retire_in_place": f"""WITH {ITEMS},
        scratch AS (SELECT concat('func|', subject, '|', session) AS task_name, path, size FROM study
                    WHERE session IS NOT NULL)
        SELECT * FROM scratch WHERE task_name NOT IN (SELECT task_name FROM done WHERE did_succeed)""",
    "s10_ledger_csv": f"""WITH {LEDGER_SESSIONS}
        SELECT task_name, did_succeed, CAST(return_code AS INTEGER) AS return_code FROM done""",
    "s11_ledger_record": f"{LATEST} FROM latest",
    "s11_merge_records": f"{LATEST}, event_id FROM latest",
    "s12_session_filters": f"WITH {SESSIONS} SELECT subject, session, {FILTER_JSON} AS filter_json FROM bold",
    "s13_spec_read": """
        SELECT p_partkey AS document, 'baseline' AS grp, concat('part', p_partkey) AS name, 'suffix' AS entity,
               p_type AS values FROM part
        UNION ALL SELECT p_partkey, 'baseline', concat('part', p_partkey), 'label', concat(p_brand, ',', p_name) FROM part
        UNION ALL SELECT p_partkey, 'std_xfms', concat('part', p_partkey), 'from', 'T1w' FROM part
        UNION ALL SELECT p_partkey, 'std_xfms', concat('part', p_partkey), 'to', '' FROM part""",
    "s14_provenance_docs": f"""
        SELECT o_orderkey AS dataset, {PROVENANCE_JSON} AS description_json
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "s14_source_documents": f"""
        SELECT o_orderkey AS dataset, {PROVENANCE_JSON} AS description_json
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "s15_apply_ignore": f"""WITH {STUDY}
        SELECT CASE run WHEN '6' THEN 'mylogs/' || path ELSE path END AS path FROM study WHERE run IN ('6', '7')""",
    "p1_parse_entities": f"""WITH {STUDY}
        SELECT path, subject, session, datatype, run, suffix, 'nii.gz' AS extension FROM study""",
    "p1_parse_derivative_entities": f"""WITH {DERIV}
        SELECT resolved AS path, subject, space, label, descr AS desc, CASE WHEN grp = 'std_xfms' THEN 'image' END AS mode,
               from_, to_, suffix, {EXTENSION} AS extension FROM resolved WHERE resolved IS NOT NULL""",
    "p2_normalise_path": f"WITH {STUDY} SELECT '/data/study/' || path AS path FROM study",
    "p3_entity_query": f"WITH {STUDY} SELECT path FROM study WHERE suffix = 'T1w' AND session IS NULL",
    "p4_space_filter": f"""WITH {DERIV}
        SELECT resolved AS path, 'none' AS asked FROM resolved WHERE resolved IS NOT NULL AND space IS NULL
        UNION ALL SELECT resolved, 'second' FROM resolved WHERE resolved IS NOT NULL AND space = 'MNI152NLin6Asym'""",
    "p5_transform_filter": f"""WITH {DERIV}
        SELECT resolved AS path, to_ FROM resolved WHERE resolved IS NOT NULL AND from_ = 'T1w'""",
    "p6_validate_manifest": f"WITH {MANIFEST} SELECT path, violation FROM violations",
    "p6_manifest_passes": f"""WITH {MANIFEST}
        SELECT count(DISTINCT path) AS bad_paths, count(*) = 0 AS passes FROM violations""",
    "p6_naming_rules": f"""WITH {STUDY}
        SELECT concat(folder, '/', datatype, '/sub-x', substr(stem, 5), '_run-2_', suffix, '.nii.gz') AS path,
               'subject_mismatch' AS violation FROM study WHERE run = '2'
        UNION ALL SELECT concat(folder, '/other/', stem, '_run-3_', suffix, '.nii.gz'), 'no_datatype'
        FROM study WHERE run = '3'
        UNION ALL SELECT concat(folder, '/', datatype, '/', replace(stem, '_ses-', '_ses-x'), '_run-4_', suffix, '.nii.gz'),
               'session_mismatch' FROM study WHERE run = '4' AND session IS NOT NULL
        UNION ALL SELECT replace(path, '.nii.gz', ''), 'no_suffix' FROM study WHERE run = '5'""",
    "p7_render_jobs": f"""WITH {SESSIONS}
        SELECT subject, session, concat(' process --participant "', upper(subject), '" --session "', session,
               '" --filter ''{{}}'' --memory ', CAST(floor(CAST(session AS BIGINT) / 8.0 * 1000) AS BIGINT), ' ') AS command
        FROM bold""",
    "p8_walltime": """
        WITH w AS (
          SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 4 * 86400 ELSE 0 END
                 + o_custkey % 24 * 3600 + o_orderkey % 60 * 60
                 + CASE WHEN o_orderstatus IN ('F', 'O') THEN o_custkey % 60 ELSE 0 END AS seconds FROM orders)
        SELECT o_orderkey, CAST(seconds AS BIGINT) AS seconds,
               CAST(greatest(10800, seconds - 3600) AS BIGINT) AS lifetime FROM w""",
    "p9_resource_budget": """
        SELECT p_partkey, CAST(floor(p_retailprice - 3) AS BIGINT) AS mem_gb,
               CAST(floor((p_retailprice - 3) * 1000) AS BIGINT) AS mem_mb FROM part""",
    "p10_task_name": """
        SELECT o_orderkey, concat('func_(''', o_custkey, ''', ''', o_orderkey, ''')') AS tuple_name,
               concat('anat_', o_custkey) AS subject_name, concat('func|', o_custkey, '|', o_orderkey) AS joined_name
        FROM orders""",
    "j1_skip_done": f"""WITH {ITEMS}
        SELECT task_name, subject, session FROM items
        WHERE task_name NOT IN (SELECT task_name FROM done WHERE did_succeed)""",
    "j2_survivors": f"""WITH {ITEMS}
        SELECT task_name, subject, session FROM items
        WHERE task_name IN (SELECT task_name FROM done WHERE did_succeed)""",
    "j3_subject_session_pairs": f"""WITH {SESSIONS}
        SELECT subject, session FROM bold WHERE subject IN (SELECT subject FROM anat_subjects)""",
    "j4_anat_sessions": f"WITH {SESSIONS} SELECT subject, session FROM anat",
    "j4_sessions_in": f"WITH {SESSIONS} SELECT subject, session FROM bold INTERSECT SELECT subject, session FROM anat",
    "j5_session_has_anat": f"""WITH {STUDY}
        SELECT subject, session, bool_or(suffix = 'T1w') AS has_anat FROM study GROUP BY 1, 2""",
    "j6_expand_spaces": f"WITH {DERIV} SELECT subject, grp, name, space, label, from_, to_ FROM expected",
    "j7_match_derivatives": f"""WITH {DERIV}
        SELECT subject, grp, name, space, resolved AS path FROM resolved WHERE resolved IS NOT NULL""",
    "j8_resolve_with_fallback": f"""WITH {DERIV}
        SELECT subject, name, path, resolved, resolved IS NOT NULL AS found FROM resolved""",
    "j9_relabel": """
        SELECT l_orderkey AS volume_id, l_partkey AS voxel, l_linenumber AS label, CAST(new_label AS SMALLINT) AS new_label
        FROM lineitem JOIN (VALUES (0, 0), (1, 3), (2, 42), (3, 0), (4, 5), (5, 6), (6, 17), (7, 99))
             lut(label, new_label) ON label = l_linenumber""",
    "j9_relabel_table": """
        SELECT l_orderkey AS volume_id, l_partkey AS voxel, l_linenumber AS label, CAST(new_label AS SMALLINT) AS new_label
        FROM lineitem JOIN (VALUES (0, 0), (1, 3), (2, 42), (3, 0), (4, 5), (5, 6), (6, 17), (7, 99))
             lut(label, new_label) ON label = l_linenumber""",
    "j10_lock_status": """
        WITH n AS (SELECT max(ts) AS now FROM events),
        s AS (SELECT user_id, CAST(user_id AS VARCHAR) AS subject,
                     bool_or(event_type = 'error' AND event_id % 7 = 0) AS locked,
                     max(CASE WHEN user_id % 5 <> 0 THEN ts END) AS mtime FROM events GROUP BY 1, 2)
        SELECT subject, CASE WHEN NOT locked THEN 'clear'
               WHEN now - coalesce(mtime, TIMESTAMP '1970-01-01') < INTERVAL 21600 SECOND THEN 'blocked'
               ELSE 'stale' END AS status FROM s, n""",
    "j11_attach_items": f"""WITH {ITEMS}
        SELECT task_name, did_succeed, CAST(return_code AS INTEGER) AS return_code, subject, session
        FROM done JOIN items USING (task_name)""",
    "j12_pick_reference_session": f"""WITH {SESSIONS}
        SELECT subject, session, reference_session FROM bold LEFT JOIN reference USING (subject)""",
    "a1_subjects": f"WITH {STUDY} SELECT DISTINCT subject FROM study WHERE suffix = 'T1w'",
    "a2_sessions": f"WITH {SESSIONS} SELECT subject, session FROM bold",
    "a3_sessions_by_subject": f"""WITH {STUDY}, s AS (SELECT DISTINCT subject, session FROM study)
        SELECT subject, session FROM s WHERE session IS NOT NULL
        UNION ALL SELECT subject, NULL FROM s GROUP BY subject HAVING max(session) IS NULL""",
    "a4_batch_summary": f"""WITH {HISTORY}
        SELECT batch, count(*) AS items, count(*) FILTER (WHERE did_succeed) AS successful,
               count(*) FILTER (WHERE NOT did_succeed) AS failed FROM latest GROUP BY 1""",
    "a4_batch_lists": f"""WITH {HISTORY}
        SELECT batch, CASE WHEN did_succeed THEN 'successful' ELSE 'failed' END AS outcome, task_name FROM latest""",
    "a5_group_report": """
        SELECT l_returnflag, count(*) AS n, round(avg(l_extendedprice), 4) AS mean,
               round(stddev_samp(l_extendedprice), 4) AS stddev, min(l_extendedprice) AS low, max(l_extendedprice) AS high,
               round(quantile_cont(l_extendedprice, 0.25), 4) AS quartile1,
               round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
               round(quantile_cont(l_extendedprice, 0.75), 4) AS quartile3
        FROM lineitem GROUP BY 1""",
    "a6_work_items": f"WITH {UNITS} SELECT granularity, subject, session, files, bytes FROM units",
    "a7_stage_gate": f"WITH {HISTORY} SELECT batch, bool_or(did_succeed) AS go_on FROM latest GROUP BY 1",
    "a7_single_gate": f"WITH {HISTORY} SELECT coalesce(bool_and(did_succeed), FALSE) AS go_on FROM latest",
    "a8_derivatives_complete": f"""WITH {DERIV}
        SELECT subject, count(*) = count(resolved) AS complete FROM resolved GROUP BY 1""",
    "a8_surfaces_complete": "SELECT CAST(c_custkey AS VARCHAR) AS subject, c_custkey % 3 <> 0 AS complete FROM customer",
    "a9_derivative_cache": f"""WITH {DERIV}, {PLACED}
        SELECT subject, name, space, path FROM placed
        UNION ALL SELECT subject, 'template', space, NULL FROM complete, std""",
    "a9_derivative_maps": f"""WITH {DERIV}, {PLACED},
        entries AS (
          SELECT subject, name, path FROM placed
          UNION ALL SELECT subject, 'template', space FROM complete, std)
        SELECT subject, name, string_agg(path, ',' ORDER BY path) AS paths FROM entries GROUP BY 1, 2""",
    "a10_duplicate_keys": f"""WITH {HISTORY}
        SELECT task_name, count(*) AS records FROM history GROUP BY 1 HAVING count(*) > 1""",
    "a11_capacity_plan": f"""WITH {SESSIONS},
        counts AS (
          SELECT 'subject' AS level, count(*) AS items FROM anat_subjects
          UNION ALL SELECT 'session', count(*) FROM bold WHERE subject IN (SELECT subject FROM anat_subjects)),
        asked(asked) AS (VALUES (CAST(-1 AS BIGINT)), (CAST(2000 AS BIGINT)))
        SELECT level, items, CASE WHEN asked = -1 THEN items ELSE least(asked, items) END AS workers, asked
        FROM counts, asked""",
    "a12_stage_funnel": FUNNEL,
    "a13_budget_check": f"""WITH {UNITS},
        limited AS (SELECT *, CAST(CASE granularity WHEN 'session' THEN 240 WHEN 'subject' THEN 1000
                                   ELSE 300000000 END AS BIGINT) AS limit_bytes FROM units)
        SELECT granularity, subject, session, bytes, limit_bytes, bytes <= limit_bytes AS fits FROM limited""",
    "a14_output_fields": f"""WITH {DERIV},
        fields(position, field) AS (VALUES (0, 't1w_preproc'), (1, 't1w_mask'), (2, 't1w_dseg'), (3, 't1w_tpms'),
          (4, 'std_preproc'), (5, 'std_mask'), (6, 'std_dseg'), (7, 'std_tpms'), (8, 'anat2std_xfm'),
          (9, 'std2anat_xfm'), (10, 't1w_aseg'), (11, 't1w_aparc'), (12, 't1w2fsnative_xfm'),
          (13, 'fsnative2t1w_xfm'), (14, 'surfaces'))
        SELECT CAST(position AS INTEGER) AS position, field, count(DISTINCT subject) AS subjects
        FROM fields LEFT JOIN resolved ON name = field AND resolved IS NOT NULL GROUP BY 1, 2""",
    "a15_predict_derivatives": f"""WITH {DERIV},
        extra(name, tail) AS (VALUES ('t1w_aseg', '_desc-aseg_dseg.nii.gz'), ('t1w_aparc', '_desc-aparcaseg_dseg.nii.gz'),
          ('t1w2fsnative_xfm', '_from-T1w_to-fsnative_mode-image_xfm.txt'),
          ('fsnative2t1w_xfm', '_from-fsnative_to-T1w_mode-image_xfm.txt'),
          ('surfaces', '_hemi-L_inflated.surf.gii'), ('surfaces', '_hemi-L_midthickness.surf.gii'),
          ('surfaces', '_hemi-L_pial.surf.gii'), ('surfaces', '_hemi-L_smoothwm.surf.gii'),
          ('surfaces', '_hemi-R_inflated.surf.gii'), ('surfaces', '_hemi-R_midthickness.surf.gii'),
          ('surfaces', '_hemi-R_pial.surf.gii'), ('surfaces', '_hemi-R_smoothwm.surf.gii'))
        SELECT subject, name, path FROM expected
        UNION ALL SELECT subject, name, concat('sub-', subject, '/anat/sub-', subject, tail) FROM subj, extra""",
    "w1_first_k_sessions": f"""WITH {SESSIONS}
        SELECT subject, session, CAST(row_number() OVER (PARTITION BY subject ORDER BY session) AS INTEGER) AS position
        FROM anat QUALIFY row_number() OVER (PARTITION BY subject ORDER BY session) <= 2""",
    "w2_latest_record": f"{LATEST}, event_id FROM latest",
    "w3_progress": f"""WITH {HISTORY},
        i AS (SELECT n.task_name, n.batch, coalesce(e.did_succeed, FALSE) AS was_done
              FROM (SELECT DISTINCT task_name, batch FROM history) n LEFT JOIN earlier e ON e.task_name = n.task_name),
        t AS (SELECT batch, count(*) FILTER (WHERE was_done) AS initial, count(*) AS total FROM i GROUP BY 1),
        c AS (SELECT i.batch, i.task_name, h.ts, h.event_id FROM i JOIN history h ON h.task_name = i.task_name
              WHERE NOT was_done AND h.ts >= TIMESTAMP '2024-01-16 00:00:00'
              QUALIFY row_number() OVER (PARTITION BY i.task_name ORDER BY h.ts, h.event_id) = 1)
        SELECT c.batch, c.task_name, initial + row_number() OVER (PARTITION BY c.batch ORDER BY ts, event_id) AS done, total
        FROM c JOIN t ON t.batch = c.batch""",
    "t1_sorted_distinct": f"""WITH {LISTING}
        SELECT DISTINCT CASE WHEN anat_path IS NOT NULL THEN concat(subject, ',', coalesce(session, ''), ',', anat_path)
               WHEN session IS NOT NULL THEN concat(subject, ',', session) ELSE subject END AS line FROM listing""",
    "t2_sorted_paths": f"WITH {DERIV} SELECT path FROM expected ORDER BY path",
    "t4_slice": f"""WITH {SESSIONS},
        k AS (SELECT * FROM anat QUALIFY row_number() OVER (PARTITION BY subject ORDER BY session) <= 2)
        SELECT subject, string_agg(session, ',' ORDER BY session) AS sessions FROM k GROUP BY 1""",
    "g1_union_all": f"WITH {DERIV} SELECT grp, name, path FROM expected",
    "g2_except_failed": f"""WITH {ITEMS}
        SELECT task_name FROM items EXCEPT SELECT task_name FROM done WHERE did_succeed""",
    "g3_intersect_done": f"""WITH {ITEMS}
        SELECT task_name FROM items INTERSECT SELECT task_name FROM done WHERE did_succeed""",
    "g4_distinct": f"WITH {STUDY} SELECT DISTINCT subject, datatype, suffix FROM study",
    "u1_apply_batch": f"""WITH {ITEMS}
        SELECT task_name, coalesce(d.did_succeed, FALSE) OR (n % 5 <> 0 AND n % 3 = 0) AS did_succeed,
               CAST(CASE WHEN coalesce(d.did_succeed, FALSE) THEN 0 WHEN n % 5 = 0 THEN -1 ELSE n % 3 END AS INTEGER)
                 AS return_code,
               coalesce(d.did_succeed, FALSE) AS cached
        FROM (SELECT *, CAST(session AS BIGINT) AS n FROM items) LEFT JOIN done d USING (task_name)""",
    "u2_run_once": """WITH o AS (SELECT count(*) AS n FROM orders)
        SELECT 'count' AS task_name, n % 2 = 0 AS did_succeed, CAST(n % 97 AS INTEGER) AS return_code, FALSE AS cached FROM o
        UNION ALL SELECT 'other', TRUE, CAST(n % 97 AS INTEGER), TRUE FROM o""",
    "u3_cleanup_marks": f"WITH {SESSIONS} SELECT subject, CAST(subject AS BIGINT) % 4 <> 0 AS did_succeed FROM anat_subjects",
    "u4_struct_items": f"""WITH {ITEMS}
        SELECT task_name, n % 5 <> 0 AND n % 3 = 0 AS did_succeed,
               CAST(CASE WHEN n % 5 = 0 THEN -1 ELSE n % 3 END AS INTEGER) AS return_code
        FROM (SELECT *, CAST(session AS BIGINT) AS n FROM items)""",
    "plan_staged_run": f"""WITH {SESSIONS}
        SELECT subject, session, reference_session FROM bold LEFT JOIN reference USING (subject)
        WHERE subject IN (SELECT subject FROM anat_subjects) AND CAST(subject AS BIGINT) % 4 <> 0
          AND CAST(session AS BIGINT) % 5 <> 0 AND CAST(session AS BIGINT) % 3 = 0""",
    "x1_stalled_workers": """
        SELECT CAST(user_id AS VARCHAR) AS worker FROM events GROUP BY user_id
        HAVING (SELECT max(ts) FROM events) - max(ts) > INTERVAL 21600 SECOND""",
    "x1_stalled_worker_stream": """
        SELECT CAST(user_id AS VARCHAR) AS worker FROM events GROUP BY user_id
        HAVING (SELECT max(ts) FROM events) - max(ts) > INTERVAL 21600 SECOND""",
    "x2_completion_sink": f"{LATEST} FROM latest",
    "x4_live_progress": f"""WITH {HISTORY}
        SELECT batch, count(*) AS done, count(*) FILTER (WHERE did_succeed) AS successful, count(*) AS total
        FROM history GROUP BY 1""",
}

"""Piece encoding, repeated lines, near duplicates and the pipeline against brute force."""

import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from cohortmill.llm import line_dedup, near_dups, pieces
from cohortmill.llm.components import components
from llm.llm_entry import QUERIES
from llm.samples import no_docs, odd_docs, odd_rows, odd_texts, sentence

SF = "/root/testdata/sf0.001"


# --- pieces ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return pieces.load_pieces(pieces.model_path())


def brute_segmentations(model, text):
    out = []

    def go(at, cost, ids):
        if at == len(text):
            out.append((cost, ids))
            return
        for end in range(at + 1, min(len(text), at + model.longest) + 1):
            if (found := model.cost.get(text[at:end])) is not None:
                go(end, cost + found[0], (*ids, found[1]))
        if text[at] not in model.cost:
            go(at + 1, cost + model.unknown, (*ids, *(model.byte_ids[b] for b in text[at].encode())))

    go(0, 0.0, ())
    return sorted(out)


def edited(ids, edits):
    out = ids.tolist()
    for at, drop, own in reversed(edits):
        out[at : at + drop] = own
    return out


def test_nbest_of_texts_equals_all_segmentations(model):
    rng, memory = random.Random(3), pieces.Memory(model)
    parts = ["the", "in", "é", " ", "\n", "a", "▁", "xq", "  ", ",", "ℵ", "er"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 5))) for _ in range(250)]
    for text, (ids, score, ways) in zip(texts, pieces.encode_all(texts, memory, 4), strict=True):
        want = brute_segmentations(model, " " + text)[:4]
        every = [ids.tolist(), *(edited(ids, e) for _, e in ways)]
        assert [-score, *(-s for s, _ in ways)] == [c for c, _ in want], text
        assert len({tuple(x) for x in every}) == len(every)
        assert all(model.decode(np.array(x, np.int32)) == text for x in every)


def test_segments_together_equal_segments_alone(model):
    rng = random.Random(8)
    segments = sorted({"".join(rng.choice(" therinoné,ℵ") for _ in range(rng.randint(1, 24))) for _ in range(400)})
    memory = pieces.Memory(model)
    memory.learn(set(segments) | {"ab" * 40})
    for s in [*segments, "ab" * 40]:
        _, forward, ids, gap = model.viterbi(s)
        k = memory.number[s]
        assert (memory.ids[k], memory.costs[k], memory.gaps[k]) == (np.array(ids, np.int32).tobytes(), forward[-1], gap)


def test_nbest_of_tied_runs_equals_all_segmentations(model):
    rng = random.Random(11)
    segments = ["-" * 14, "=" * 11, " ation" * 2, "er" * 6, "....", "ationer", *("".join(rng.choice("-=") for _ in range(12)) for _ in range(20))]
    for segment in segments:
        want = brute_segmentations(model, segment)
        for n in (1, 2, 4, 9):
            got = model.nbest(segment, n)
            assert [c for c, _ in got] == [c for c, _ in want[:n]], segment
            assert len({ids for _, ids in got}) == len(got) and all(x in want for x in got)


@pytest.mark.parametrize("unit", ["-", "ationer", "=-", "a", "ℵ", "é "])
def test_long_runs_take_time_and_memory_in_proportion(model, unit):
    text = "Title " + (unit * 100_000)[:100_000] + " body"
    memory = pieces.Memory(model)
    tracemalloc.start()
    started = time.perf_counter()
    ids, score, ways = next(iter(pieces.encode_all([text], memory, 4)))
    took, most = time.perf_counter() - started, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 120 and most < 200 << 20, (took, most)
    assert model.decode(ids) == text and len(ways) == 3
    assert all(model.decode(np.array(edited(ids, e), np.int32)) == text for _, e in ways)


def test_cuts_never_split_a_piece(model):
    text = " " + "".join(odd_texts()[11:12]) + " 1,000.00 e.g. don't ▁▁ ℵℵ"
    segments = model.segments(text)
    assert "".join(segments) == text
    cuts = np.cumsum([len(s) for s in segments])[:-1]
    for cut in cuts.tolist():
        assert not any(text[a:b] in model.cost for a in range(max(0, cut - 16), cut) for b in range(cut + 1, min(len(text), a + 16) + 1))


def test_memory_bound_changes_nothing(model, monkeypatch):
    texts = [t for t in odd_texts() if t and len(t) < 2000] * 3
    whole = [(i.tolist(), s, w) for i, s, w in pieces.encode_all(texts, pieces.Memory(model))]
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    monkeypatch.setattr(pieces, "ENCODE_BYTES", 50)
    assert [(i.tolist(), s, w) for i, s, w in pieces.encode_all(texts, pieces.Memory(model))] == whole


def test_round_trip_of_odd_documents(spark, model):
    got = pieces.encode_texts(odd_docs(spark), model, columns=("doc_id", "n_chars"))
    rows = got.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows())
    assert all(r.round_trip is (None if r.n_chars is None else True) for r in rows)
    empty = next(r for r in rows if r.n_chars == 0)
    assert (empty["ids"], empty.score, empty.alternatives) == ([], 0.0, [])
    back = pieces.decode_ids(got, model, columns=("doc_id", "n_chars")).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((r[0], r[1]) for r in odd_rows())
    assert pieces.encode_texts(no_docs(spark), model).count() == 0


def test_query_encodes_every_document(spark):
    docs = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_sentencepiece"](spark, SF).collect()
    assert {r.doc_id for r in rows} == docs and all(r.round_trip for r in rows)
    for r in rows:
        scores = [r.score, *(w.score for w in r.alternatives)]
        assert scores == sorted(scores, reverse=True)


# --- lines ----------------------------------------------------------------------


def brute_lines(rows):
    """Rows as ``(id, text)`` in order; what is left of each text and how many lines went."""
    seen, out = set(), {}
    for i, text in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = text.split("\n")
        trimmed = [x.strip(" \t\r") for x in lines]
        gone = set()
        for at in range(len(lines) - 2):
            window = tuple(trimmed[at : at + 3])
            if any(window):
                gone |= {at, at + 1, at + 2} if window in seen else set()
                seen.add(window)
        out[i, text] = ("\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text, len(lines), len(gone))
    return out


def line_rows():
    rng = random.Random(6)
    shared = [f"line {k}" for k in range(6)]
    rows = []
    for i in range(40):
        own = [sentence(rng, 3) for _ in range(rng.randint(0, 4))]
        at = rng.randint(0, len(own))
        part = shared[rng.randint(0, 2) : rng.randint(3, 6)] if rng.random() < 0.8 else []
        rows.append((i, "\n".join(own[:at] + [x + rng.choice(["", " ", "\r"]) for x in part] + own[at:])))
    return [*rows, rows[5], (40, "a\na\na\na\na\na"), (41, "\n\n\n\n"), (42, "a\n\n\na\n\n\na\n\n"), (None, rows[3][1]), (43, None), (44, "")]


def test_lines_equal_brute_force(spark):
    rows = line_rows()
    docs = spark.createDataFrame([(i, t, "x", "y", "z", "q") for i, t in rows], "doc_id long, text string, lines string, starts string, at string, k1 string").repartition(4)
    want = brute_lines(rows)
    got = line_dedup.remove_repeated_lines(docs).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got) == Counter((i, *(want[i, t] if t is not None else (None, 0, 0))) for i, t in rows)


def test_lines_of_odd_and_no_documents(spark):
    docs = odd_docs(spark)
    got = line_dedup.remove_repeated_lines(docs)
    assert got.count() == len(odd_rows()) and got.columns == [*docs.columns, "n_lines", "n_removed"]
    left = line_dedup.deduplicated(docs)
    assert left.columns == docs.columns
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in left.collect())
    assert line_dedup.deduplicated(no_docs(spark)).count() == 0


def brute_pieces(rows):
    """What is left of each text by pieces of lines, as ``brute_lines`` for lines."""
    seen, out = set(), {}
    for i, text in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = []
        for line in text.split("\n"):
            words, own = re.findall(r"\s*\S+\s*", line, re.ASCII), [""]
            if len(words) <= line_dedup.PIECE:
                words, own = [], [line]
            count = 0
            for at, word in enumerate(words):
                # A piece ends at the first sentence end from the eighth word on, else after sixteen words.
                own[-1] += word
                count += 1
                ends = count >= line_dedup.SHORTEST and re.search(r"[.!?…][\"')\]»”]?\s*$", word)
                if (ends or count == line_dedup.PIECE) and at < len(words) - 1:
                    own.append("")
                    count = 0
            assert "".join(own) == line
            lines.append(own)
        pieces = [(k, p) for k, own in enumerate(lines) for p in own]
        trimmed = [p.strip(" \t\r") for _, p in pieces]
        windows = [(tuple(trimmed[a : a + 3]), range(a, a + 3)) for a in range(len(pieces) - 2) if any(trimmed[a : a + 3])]
        if 0 < len(short := [t for t in trimmed if t]) < 3:
            windows.insert(0, (("whole", *short), range(len(pieces))))
        gone = set()
        for window, covers in windows:
            gone |= set(covers) if window in seen else set()
            seen.add(window)
        kept = [["".join(p for at, (l, p) in enumerate(pieces) if l == k and at not in gone)] for k in range(len(lines)) if any(l == k and at not in gone for at, (l, _) in enumerate(pieces))]
        out[i, text] = ("\n".join(x for (x,) in kept), len(pieces), len(gone))
    return out


def piece_rows():
    rng = random.Random(16)
    prose = lambda n: " ".join(sentence(rng, rng.randint(1, 20)).capitalize() + rng.choice([".", "!", "?", '."', " …", ","]) for _ in range(n))
    passages = [prose(9) for _ in range(5)] + [sentence(rng, 60)]
    rows = []
    for i in range(60):
        parts = [rng.choice(["", prose(2), rng.choice(passages), "short line", " "]) for _ in range(rng.randint(1, 4))]
        rows.append((i, rng.choice(["\n", " ", "\n\n"]).join(parts)))
    two = f"{sentence(rng, 7)}\n{sentence(rng, 7)}"
    rows += [(60, two), (61, two), (62, two + "\n\n\n"), (63, "once"), (64, "once "), (65, passages[0]), (66, "before\n" + passages[0] + "\nafter"), (67, "\n \n"), (68, "\n \n"), (69, ""), (None, "once")]
    return [*rows, rows[3]]


def test_pieces_of_lines_equal_brute_force(spark):
    rows = piece_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_pieces(rows)
    got = line_dedup.remove_repeated_lines(docs, whole=True, cut=True).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got), key=repr) == sorted(((i, *want[i, t]) for i, t in rows), key=repr)


def test_short_documents_and_long_lines_that_repeat_go(spark):
    rows = piece_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id for r in line_dedup.deduplicated(docs).collect()}
    assert 60 in left and not {61, 62, 63, 64} & left and {67, 68, 69, None} <= left
    left = {r.doc_id: r.text for r in line_dedup.deduplicated(docs, cut=True).collect()}
    assert 60 in left and not {61, 62, 63, 64, 65} & set(left)
    assert left[66] == "before\nafter" and {67, 68, 69, None} <= set(left)
    long = next(t for i, t in rows if i == 65)
    assert sum(long in t for t in left.values()) <= 1


def test_what_is_left_of_documents_equals_brute_force_and_emptied_ones_go(spark):
    rows = piece_rows()
    want = brute_pieces(rows)
    left = line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), cut=True).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=repr) == sorted(((i, want[i, t][0]) for i, t in rows if not 0 < want[i, t][2] == want[i, t][1]), key=repr)


def test_lines_without_any_blank_take_time_in_proportion(spark):
    words = " ".join(f"w{k}" for k in range(100_000))
    rows = [(0, "x" * 1_000_000), (1, "y" * 1_000_000 + " z. " * 40), (2, words), (3, f"before\n{words}"), (4, "\u00e4" * 500_000 + "\n" + " " * 500_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    began = time.monotonic()
    left = {r.doc_id: r.text for r in line_dedup.deduplicated(docs, cut=True).collect()}
    assert time.monotonic() - began < 60
    assert left[0] == rows[0][1] and left[2] == rows[2][1] and left[4] == rows[4][1] and left[3] == "before"


# --- near duplicates ------------------------------------------------------------


def brute_groups(rows, percent):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    group = {i: i for i, _ in sets if i is not None}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and i is not None and j is not None and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((root(i), root(j)))
                group[y] = x
    return Counter((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets)


def similar_rows():
    """Families whose members differ from their base by rising numbers of words, chains, templates."""
    rng = random.Random(9)
    rows = []
    for family in range(4):
        base = sentence(rng, 150).split()
        for k in range(14):
            words = base.copy()
            for at in rng.sample(range(150), k):
                words[at] = sentence(rng, 1)
            rows.append((len(rows), " ".join(words)))
    chain = sentence(rng, 200).split()
    for k in range(12):
        chain = chain[3:] + sentence(rng, 3).split()
        rows.append((len(rows), " ".join(chain)))
    template = [sentence(rng, 20) for _ in range(5)]
    for _ in range(12):
        rows.append((len(rows), " ".join(x if rng.random() < 0.7 else sentence(rng, 20) for x in template)))
    long = sentence(rng, 160).split()
    for k in range(0, 60, 4):
        # Cut at either end, and some of them changed a little.
        words = long[: 160 - k] if k % 8 else long[k:]
        if k % 3 == 0:
            words = [*words[:50], sentence(rng, 1), *words[51:]]
        rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_groups_equal_brute_force(spark, percent):
    rows = similar_rows() + [(r[0] + 1000 if r[0] is not None else None, r[1]) for r in odd_rows()]
    docs = spark.createDataFrame([(i, t, "k", "c", "n", "f") for i, t in rows], "doc_id long, text string, set_key string, component string, node string, k string").repartition(5)
    got = near_dups.near_duplicates(docs, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute_groups(rows, percent)


def test_enough_collections_for_the_stated_miss():
    for percent in (80, 85, 95):
        m, p = near_dups.collections_for(percent), (percent / 100) ** near_dups.WIDTH
        assert (1 - p) ** m + m * p * (1 - p) ** (m - 1) <= near_dups.MISSED
    assert near_dups.collections_for(80) > near_dups.collections_for(95)


def test_one_of_each_group_stays(spark):
    docs = odd_docs(spark)
    left = near_dups.without_near_duplicates(docs, 80)
    assert left.columns == docs.columns
    ids = {r.doc_id for r in left.collect()}
    assert 8 in ids and not ids & {9, 10} and ids >= {0, 1, 2, 3, 4, 5, 6, 7, 11, 12, 13, None}
    assert near_dups.near_duplicates(no_docs(spark)).count() == 0


def test_removals_go_by_row_where_ids_repeat_or_lack(spark):
    rng = random.Random(21)
    x, y, z = (sentence(rng, 60) for _ in range(3))
    rows = [(1, x), (1, x), (3, y), (5, y), (5, z), (None, x), (None, x), (None, None), (None, None), (7, ""), (7, "")]
    docs = spark.createDataFrame([(i, t, f"k{k}", "r", "h") for k, (i, t) in enumerate(rows)], "doc_id long, text string, key string, row_number string, n_rows string").repartition(4)
    left = near_dups.without_near_duplicates(docs)
    assert left.columns == docs.columns
    want = [(1, x), (3, y), (5, z), (None, None), (None, None), (7, ""), (7, "")]
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(want)
    nobody = spark.createDataFrame([(None, x), (None, x), (None, z)], "doc_id long, text string")
    assert Counter(r.text for r in near_dups.without_near_duplicates(nobody).collect()) == Counter([x, z])


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 150), (150, 160), (160, 200)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}, 150: 150, 160: 150, 200: 150}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- pipeline -------------------------------------------------------------------


def test_stages_keep_their_columns_on_odd_and_no_documents(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        first = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF)
            assert after.columns == first.columns, name
            assert after.count() <= docs.count()
            docs = after
        assert "ids" in corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns


def test_run_equals_its_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # Every text of these tables has letters, so the first stage lets all pass.
    assert corpus_pipeline.languages(spark, docs, SF).count() == len(rows)
    left = [(i, t, n, k) for (i, _), (t, n, k) in brute_pieces(rows).items()]
    left = [(i, t) for i, t, n, k in left if not (k and k == n)]
    kept = {i for i, _, _, stays in brute_groups(left, 80) if stays}
    got = {r.doc_id for r in QUERIES["pipeline"](spark, SF).select("doc_id").collect()}
    assert got == kept

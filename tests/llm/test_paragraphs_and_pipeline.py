import importlib
import os
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpusloom.llm import catalog, langid, paragraphs as pg
from corpusloom.llm.text import buffers
from llm_data import DOCUMENT, text_of
from test_decontaminate import brute as contaminated
from test_near_dup import brute as near

FOLDER = "/root/testdata/sf0.001"


def planted():
    """Documents of their own words, five of which share a passage, near copies of it too."""
    passage = text_of(1000, 60)
    w = passage.split()
    w[30] = "Changed"
    rows = [(k, text_of(k, 150) + "\n" + text_of(300 + k, 90)) for k in range(40)]
    for k, body in ((3, passage), (8, passage), (15, passage), (22, " ".join(w)), (31, passage)):
        left, right = rows[k][1].split()[:70], rows[k][1].split()[70:]
        rows[k] = (k, " ".join([*left, body, *right]))
    return rows, passage


def test_planted_passages(spark):
    rows, passage = planted()
    frame = spark.createDataFrame([(k, t, None, None, None) for k, t in rows], DOCUMENT)
    got = pg.repeated_passages(frame).collect()
    assert {r.doc_id for r in got} == {3, 8, 15, 22, 31}
    texts = dict(rows)
    for r in got:
        assert texts[r.doc_id][r.start : r.start + r.length].split()[2] in texts[3]
    # The first place stays, the others go.
    assert {r.doc_id for r in got if r.kept} == {3}


def slow_clusters(spark, frame):
    """Clusters by the exact similarity of every pair of paragraphs."""
    units = pg.paragraph_rows(frame).collect()
    texts = {r.doc_id: r.text for r in frame.collect()}
    sets = []
    for u in units:
        w = texts[u.doc_id][u.start : u.start + u.length].encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)})
    root = list(range(len(units)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(units)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for k, u in enumerate(units):
        groups.setdefault(find(k), []).append((u.doc_id, u.unit))
    return sorted(sorted(g) for g in groups.values() if len(g) > 1)


@pytest.mark.parametrize("group", [1024, 4])
def test_clusters_match_every_pair(spark, monkeypatch, group):
    monkeypatch.setattr(pg, "GROUP", group)
    rows, _ = planted()
    base = text_of(77, 40)
    for k in range(12):  # one sentence long paragraph with an edit at a place of its own
        w = base.replace(".", "").lower().split()
        w[(3 * k) % 40] = f"other{k}" if k % 2 else w[(3 * k) % 40]
        rows.append((500 + k, " ".join(w)))
    frame = spark.createDataFrame([(k, t, None, None, None) for k, t in rows], DOCUMENT)
    found = {}
    for r in pg.repeated_paragraphs(frame).collect():
        found.setdefault(r.cluster, []).append((r.doc_id, r.unit))
    want = slow_clusters(spark, frame)
    got = sorted(sorted(g) for g in found.values())
    # Banding may miss a pair at the threshold, never join one that is not linked.
    assert all(any(set(g) <= set(w) for w in want) for g in got)
    assert sum(len(g) for g in got) >= 0.97 * sum(len(w) for w in want)


def test_cuts_follow_the_text():
    passage = text_of(2000, 60)
    alone = set()
    for around in ("", text_of(1, 33) + " ", text_of(2, 71).lower() + " "):
        raw, off = buffers(pa.array([around + passage + " tail of other words"]))
        row, number, x, y, _, _, k1, *_ = pg.units(raw, off, 5, 8)
        inside = {int(k) for k, a, b in zip(k1, x, y) if a >= len(around.encode()) and b <= len((around + passage).encode())}
        alone = alone & inside if alone else inside
    assert len(alone) >= 2


def passages_in(kind, k, size):
    w = text_of(9000 + k, size + 20).split()[:size]
    plain = [x.lower().strip(".") for x in w]
    if kind == "lines":
        return "\n".join(" ".join(plain[j : j + 5]) for j in range(0, size, 5))
    if kind == "german":
        return " ".join(x.capitalize() if j % 2 else x for j, x in enumerate(plain))
    return " ".join(plain)


@pytest.mark.parametrize("kind", ["inline", "lines", "german"])
def test_passages_of_any_form_are_whole(spark, kind):
    rows, want = [], {}
    for k in range(40):
        passage = passages_in(kind, k, 51 + k * 49 // 39)
        for copy in range(2):
            left, right = (text_of(20_000 + 4 * k + 2 * copy + j, 60).lower().replace(".", "") for j in range(2))
            rows.append((2 * k + copy, f"{left} x{k}y{copy} {passage} z{k}y{copy} {right}"))
            want[2 * k + copy] = passage
    frame = spark.createDataFrame([(k, t, None, None, None) for k, t in rows], DOCUMENT)
    texts, got = dict(rows), {}
    for r in pg.repeated_passages(frame).collect():
        got.setdefault(r.doc_id, []).append(texts[r.doc_id][r.start : r.start + r.length])
        assert r.n_words == len(got[r.doc_id][-1].split()) and r.kept == (r.doc_id % 2 == 0)
    assert got == {k: [p] for k, p in want.items()}


def test_ranges_of_runs_meet(spark, monkeypatch):
    """More ranges than rows: all neighbours are compared at the rims."""
    rows = [(k, f"{text_of(40 + k, 40)} a{k} {text_of(3000, 60)} b{k} {text_of(80 + k, 40)}") for k in range(6)]
    frame = spark.createDataFrame([(k, t, None, None, None) for k, t in rows], DOCUMENT)
    want = sorted(pg.repeated_passages(frame).collect())
    monkeypatch.setattr(pg, "parallelism", lambda _: 500)
    assert sorted(pg.repeated_passages(frame).collect()) == want and {r.n_words for r in want} == {60}


def test_repeated_ids_with_other_texts(spark):
    """A place of one text may lie beyond the end of another text of the same id."""
    shared = text_of(50, 60).lower()
    rows = [(1, "hi " + "x" * 5000), (1, f"{text_of(51, 30)} {shared} {text_of(52, 30)}"), (2, f"{text_of(53, 9)} {shared} {text_of(54, 12)}"),
            (2, "short"), (3, shared), (3, shared)]
    frame = spark.createDataFrame([(k, t, None, None, None) for k, t in rows], DOCUMENT)
    found = pg.repeated_passages(frame).collect()
    assert {r.doc_id for r in found} == {1, 2, 3} and max(r.n_words for r in found if r.doc_id < 3) >= 50


def equal_runs(texts, least):
    """Word ranges of each text that equal a run of at least `least` words elsewhere, by every pair of places."""
    lists = [t.lower().split() for t in texts]
    marked = [[False] * len(w) for w in lists]
    places = {}
    for d, w in enumerate(lists):
        for k in range(len(w) - least + 1):
            places.setdefault(tuple(w[k : k + least]), []).append((d, k))
    for found in places.values():
        for d, k in found if len(found) > 1 else ():
            marked[d][k : k + least] = [True] * least
    return marked


def test_stretches_cover_all_long_equal_runs(spark):
    """Against all equal runs: long ones are covered whole, and no other word is."""
    rng = random.Random(8)
    sources = [text_of(700 + k, 160).split() for k in range(8)]
    texts = []
    for k in range(60):
        own, parts = text_of(800 + k, 200).split(), []
        for j in range(rng.randint(1, 3)):
            source = rng.choice(sources)
            size = rng.randint(60, 110)
            at = rng.randint(0, len(source) - size)
            parts += own[20 * j : 20 * j + rng.randint(2, 19)] + source[at : at + size]
        texts.append(" ".join(parts + own[-rng.randint(1, 9) :]))
    frame = spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(texts)], DOCUMENT)
    found = [[False] * len(t.split()) for t in texts]
    for r in pg.repeated_passages(frame).collect():
        low = len(texts[r.doc_id][: r.start].split())
        size = len(texts[r.doc_id][r.start : r.start + r.length].split())
        assert size == r.n_words
        found[r.doc_id][low : low + size] = [True] * size
    long, short = equal_runs(texts, 60), equal_runs(texts, 5)
    missed = sum(a and not b for x, y in zip(long, found) for a, b in zip(x, y))
    wrong = sum(b and not a for x, y in zip(short, found) for a, b in zip(x, y))
    assert missed == 0 and sum(map(sum, long)) > 4000
    assert wrong <= 0.01 * sum(map(sum, found))  # near copies may differ in single words


def test_paragraph_edges(spark, edge, nothing):
    assert pg.repeated_passages(nothing).count() == 0
    assert {r.doc_id for r in pg.repeated_passages(edge).collect()} <= {4}
    # A text without marks is cut too.
    rows = pg.paragraph_rows(spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(2000)), None, None, None)], DOCUMENT))
    assert 10 < rows.count() < 120
    twice = spark.createDataFrame([(k, text_of(9, 80), None, None, None) for k in range(2)], DOCUMENT)
    assert {(r.doc_id, r.kept) for r in pg.repeated_passages(twice).collect()} == {(0, True), (1, False)}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_queries_match_sql(spark, db, name):
    frame = catalog.QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    got = sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({catalog.ORACLES[name]})").fetchall()
    assert got == sorted(want, key=repr)


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES)
    assert numbers == list(range(1, 14))


def brute_pipeline(rows, benchmark):
    """Kept ids and their texts before redaction, without Spark."""
    kept = {r.doc_id: r.text for r in rows if any(c.isalpha() for c in r.text or "")}
    groups = near(list(kept.items()), 5, 80)
    kept = {k: t for k, t in kept.items() if groups[k][1] == k}
    hit = {r[0] for r in contaminated(list(kept.items()), benchmark) if r[5]}
    return {k: t for k, t in kept.items() if k not in hit}


def test_pipeline(spark, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontaminate", "secrets", "packing"]
    bench = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = brute_pipeline(documents.collect(), bench)
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == documents.columns, name
        docs = spark.createDataFrame(docs.collect(), documents.schema)
    got = {r.doc_id: r for r in docs.collect()}
    assert set(got) == set(want)
    import re

    for key, text in want.items():
        assert got[key].text == re.sub(r'(token = ")[0-9a-f]{40}(")', r"\1[SECRET]\2", text)
        assert got[key].n_chars == len(got[key].text)
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in packed:
        ids = (tokenizer.encode(got[r.doc_id].text, add_special_tokens=False).ids + [1])[r.start : r.start + r.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
    assert {r.doc_id for r in packed} == set(want)


def test_stages_on_edges(spark, edge, nothing, tmp_path):
    spark.createDataFrame([(1, "zzz yyy xxx")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (edge, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, str(tmp_path))
            assert out.columns == frame.columns, name
            assert out.count() <= frame.count()
        corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).count()
    spoken = corpus_pipeline.identify_language(spark, edge, str(tmp_path))
    assert {r.doc_id for r in spoken.collect()}.isdisjoint({1, 2, 3})


def test_nothing_else_imports_this_package():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, files in os.walk(os.path.join(root, "corpusloom")):
        if os.path.basename(folder) == "llm":
            continue
        for name in files:
            if name.endswith(".py"):
                assert "corpusloom.llm" not in open(os.path.join(folder, name)).read()
    assert importlib.import_module("__spark_entry__").LLM_QUERIES["pipeline"] is corpus_pipeline.run


def test_langid_rejects_only_what_has_no_language(spark, documents):
    kept = corpus_pipeline.identify_language(spark, documents, FOLDER)
    want = {r.doc_id for r in documents.collect() if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in kept.collect()} == want
    assert langid.UNDETERMINED == "und"


def test_rims_are_a_row_a_match(spark, monkeypatch):
    written = {}
    real = pg.materialise
    monkeypatch.setattr(pg, "materialise", lambda df, name: written.setdefault(name, real(df, name)))
    kind = "doc_id long, start long, length long, first int, last int, total int, cluster long, kept boolean"
    # Cluster 5 stands amid two texts and fills a third, 6 stands at the start of its text.
    matches = [
        (1, 10, 90, 2, 20, 30, 5, True), (2, 50, 90, 9, 27, 40, 5, False), (3, 0, 90, 0, 18, 18, 5, False),
        (4, 0, 60, 0, 12, 50, 6, True), (5, 7, 60, 1, 13, 13, 6, False),
    ]
    found = pg.rim_matches(spark.createDataFrame(matches, kind))
    sides = sorted((r.doc_id, r.cluster, r.side, r.asked) for r in found.collect())
    assert sides == [(1, 5, 0, True), (1, 5, 1, True), (2, 5, 0, True), (2, 5, 1, True), (4, 6, 1, True), (5, 6, 0, True)]
    assert written["rims"].count() == 4


def test_lengths_in_planes_come_back():
    rng = np.random.default_rng(1)
    count = np.array([0, 3, 1, 0, 48, 2])
    values = rng.integers(0, 1 << 31, count.sum()).astype("<i4")
    values[:3] = 0, 255, (1 << 31) - 1
    data, start = pg._planes(values, count), np.cumsum(count) - count
    for row in np.flatnonzero(count):
        for at in range(count[row]):
            one = pg._from_planes(data, 4 * start[row : row + 1], count[row : row + 1], np.array([at]))
            assert one.tolist() == [values[start[row] + at]]

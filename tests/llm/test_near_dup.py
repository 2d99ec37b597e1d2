from collections import defaultdict

import pytest

from corpusloom.llm import near_dup
from corpusloom.llm.graph import components
from llm_data import DOCUMENT, text_of, words


def brute(rows, shingle, percent):
    """Sizes, components and the number of links by comparing every pair."""
    sets = {}
    for key, text in rows:
        w = (text or "").encode().lower().split()
        full = {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)}
        sets[key] = full or ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inverted = defaultdict(list)
    for key in sorted(sets):
        shared = defaultdict(int)
        for s in sets[key]:
            for other in inverted[s]:
                shared[other] += 1
            inverted[s].append(key)
        for other, n in shared.items():
            if 100 * n >= percent * (len(sets[key]) + len(sets[other]) - n):
                a, b = find(key), find(other)
                root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.mark.parametrize("shingle,percent", [(3, 85), (5, 80)])
def test_matches_every_pair(documents, shingle, percent):
    want = brute([tuple(r) for r in documents.select("doc_id", "text").collect()], shingle, percent)
    got = near_dup.near_duplicates(documents, shingle, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def crowd(copies):
    """Copies of one text, each with other edits: too many for one node or one group."""
    base = words(1, 120)
    rows = [(k, " ".join(base)) for k in range(20)]
    for k in range(20, copies):
        w = list(base)
        for step in range(k % 4):
            w[(17 * k + 31 * step) % len(w)] = f"edit{k}x{step}"
        rows.append((k, " ".join(w)))
    return rows + [(10_000 + k, text_of(500 + k, 60)) for k in range(30)]


def test_large_nodes_and_groups(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "SMALL_NODE", 6)
    monkeypatch.setattr(near_dup, "GROUP", 40)
    rows = crowd(160)
    frame = spark.createDataFrame([(k, t, None, None, None) for k, t in rows], DOCUMENT)
    want = brute(rows, 3, 85)
    got = near_dup.near_duplicates(frame, 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_edges(spark, edge, nothing):
    got = near_dup.near_duplicates(edge, 3, 85).collect()
    assert len(got) == edge.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].component_id is None and by_id[None].kept
    for key in (1, 2, 3):
        assert (by_id[key].n_shingles, by_id[key].component_id) == (0, key)
    assert by_id[5].n_shingles == 1 and by_id[8].n_shingles == 1
    kept = near_dup.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    # Of the repeated row one stays.
    assert kept.count() == edge.count() - 1
    assert near_dup.near_duplicates(nothing).count() == 0
    assert near_dup.drop_near_duplicates(nothing).count() == 0


def test_one_of_each_group_stays(spark):
    rows = crowd(60)
    frame = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], DOCUMENT)
    want = {k for k, (_, c) in brute(rows, 5, 80).items() if k == c}
    assert {r.doc_id for r in near_dup.drop_near_duplicates(frame).collect()} == want


def test_linked_sets_of_any_size():
    import numpy as np

    sets = [np.array(x, np.uint64) for x in ([1, 2, 3, 4, 5], [1, 2, 3, 4, 6], [9], [1, 2, 3, 4, 5, 7])]
    found = near_dup.linked(sets, range(4), 60)
    assert {frozenset(p) for p in found} <= {frozenset((0, 1)), frozenset((0, 3)), frozenset((1, 3))}
    assert len(found) == 2
    # Only what is asked is compared.
    assert near_dup.linked(sets, [2], 60) == []


@pytest.mark.parametrize("small", [True, False])
def test_components(spark, monkeypatch, small):
    from corpusloom.llm import graph

    monkeypatch.setattr(graph, "BROADCAST_LINKS", 10**6 if small else 0)
    # A long path, a star, a pair given twice, a self link and a null end.
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 40)] + [(1, 2), (2, 1), (5, 5), (None, 3)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.root for r in components(frame).collect()}
    want = {k: 100 for k in range(100, 141)} | {k: 7 for k in range(7, 40)} | {1: 1, 2: 1}
    assert got == want
    assert components(frame.limit(0)).count() == 0

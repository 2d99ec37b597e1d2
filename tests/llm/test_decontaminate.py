import hashlib
import re

import pytest

from corpusloom.llm import decontaminate as dc
from llm_data import DOCUMENT, text_of

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items, window=10):
    """Every word by looking at every window."""
    cut = lambda t: WORD.findall((t or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    wins = {}
    for key, text in items:
        w = cut(text)
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            wins.setdefault(tuple(w[k : k + m]), set()).update([] if key is None else [str(key)])
    out = []
    for key, text in docs:
        w, hit, found = cut(text), set(), set()
        for m in {len(x) for x in wins}:
            for k in range(len(w) - m + 1):
                owners = wins.get(tuple(w[k : k + m]))
                if owners is not None:
                    hit.update(range(k, k + m))
                    found |= owners
        names = ",".join(sorted(found))
        out.append((key, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def cases():
    item = text_of(7, 25)
    items = [(1, item), (2, "Two words"), (3, item + " and more of it"), (10, "été 日本"), (4, ""), (5, None),
             (None, "some words of no item id that are long enough"), (1, item), (6, "aa aa aa aa aa aa aa aa aa aa")]
    w = item.split()
    docs = [
        (1, " ".join(w)), (2, "start " + " ".join(w[3:13]) + " end"), (3, " ".join(w[3:12])), (4, None), (5, ""),
        (6, "TWO-words, two words"), (7, "x Été, 日本! y"), (8, " ".join(w + w[5:20])), (8, " ".join(w + w[5:20])),
        (None, " ".join(w)), (9, " ".join(["aa"] * 40)), (10, "Some words of no item id that are long enough."),
        (11, text_of(3, 3000) + " " + " ".join(w) + " " + text_of(4, 700)),
    ]
    return docs, items


@pytest.mark.parametrize("pass_words", [1_000_000, 20])
def test_matches_every_window(spark, monkeypatch, pass_words):
    monkeypatch.setattr(dc, "PASS_WORDS", pass_words)
    docs, items = cases()
    frame = spark.createDataFrame([(k, t, None, None, None) for k, t in docs], DOCUMENT)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in dc.contamination(frame, bench).collect()]
    assert sorted(got, key=repr) == brute(docs, items)


def test_test_tables(spark, documents):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = [tuple(r) for r in dc.contamination(documents, bench).collect()]
    assert sorted(got, key=repr) == brute(docs, [tuple(r) for r in bench.collect()])


def test_edges(spark, edge, nothing):
    bench = spark.createDataFrame([(1, "one"), (2, "zzz yyy")], "item_id long, text string")
    found = dc.find_passages(edge, bench)
    assert found.count() == edge.count() and len(set(found.columns)) == len(found.columns)
    assert {r.doc_id for r in found.collect() if r.spans} == {5}
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.spans for r in dc.find_passages(edge, none).collect())
    assert dc.contamination(nothing, bench).count() == 0


def test_shift_never_passes_an_occurrence():
    import numpy as np

    rng = np.random.default_rng(3)
    text = rng.integers(0, 3, 4000).astype(np.uint64)
    windows = np.unique(np.stack([text[k : k + 4] for k in (5, 900, 2000, 3996)]), axis=0)
    p = dc.Patterns(4, windows, [{str(k)} for k in range(len(windows))])
    bounds = np.array([0, 1500, 1503, 4000])
    start, which = dc.search(text, bounds, p)
    want = {
        (k, w) for w in range(len(p.windows)) for a, b in zip(bounds[:-1], bounds[1:])
        for k in range(a, b - 3) if (text[k : k + 4] == p.windows[w]).all()
    }
    assert set(zip(start.tolist(), which.tolist())) == want

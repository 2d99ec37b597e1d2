import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from corpusloom.llm import frames, text as tx

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aZ é\t\n-9日\U0001f600'", max_size=40)), max_size=8)


def rows_of(texts):
    return tx.buffers(pa.array(texts, pa.string()))


@settings(deadline=None, max_examples=150)
@given(TEXTS)
def test_words_are_those_of_bytes_split(texts):
    data, off = rows_of(texts)
    low, s, e, h, bounds = tx.words(data, off, tx.SOLID)
    got = [[low[a:b].tobytes() for a, b in zip(s[x:y], e[x:y])] for x, y in zip(bounds[:-1], bounds[1:])]
    want = [(t or "").encode().lower().split() for t in texts]
    # bytes.lower() and split() know ASCII only, as the rule does.
    assert got == want
    flat = [w for ws in want for w in ws]
    assert len({w: n for w, n in zip(flat, h.tolist())}) == len(set(flat))
    assert all(h[i] == h[j] for i, a in enumerate(flat) for j, b in enumerate(flat) if a == b)


def test_hash_does_not_depend_on_place():
    data, off = rows_of(["alpha beta", "x " * 300 + "beta", None, "beta"])
    _, s, e, h, bounds = tx.words(data, off, tx.SOLID)
    assert h[1] == h[bounds[2] - 1] == h[-1] and h[0] != h[1]


def test_long_texts_are_hashed_in_parts(monkeypatch):
    whole = rows_of([" ".join(f"w{k % 50}" for k in range(3000))])
    _, s, e, _, _ = tx.words(*whole, tx.SOLID)
    one = tx.hash_spans(whole[0], s, e)
    monkeypatch.setattr(tx, "BLOCK_BYTES", 64)
    assert (tx.hash_spans(whole[0], s, e) == one).all()


def test_slices_and_large_strings():
    column = pa.array(["no", "é b", None, "c"], pa.large_string()).slice(1)
    data, off = tx.buffers(column)
    assert [data[a:b].tobytes().decode() for a, b in zip(off[:-1], off[1:])] == ["é b", "", "c"]
    assert list(tx.blocks(off, 2)) == [(0, 1), (1, 3)]
    assert tx.buffers(pa.array([], pa.string()))[1].tolist() == [0]


def test_shingles():
    data, off = rows_of(["a b c d", "a b", "", "b a", "a b c a b c"])
    _, _, _, h, bounds = tx.words(data, off, tx.SOLID)
    sets = tx.shingle_sets(h, bounds, 3)
    assert [len(s) for s in sets] == [2, 1, 0, 1, 3]
    assert sets[1][0] != sets[3][0] and sets[0][0] in sets[4] or sets[0][1] in sets[4]


def test_groups_of_sorted_batches():
    def batch(keys):
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64())], ["k"])

    runs = [t.column("k").to_pylist() for t in frames.groups(iter([batch([1, 1, 2]), batch([]), batch([2, 3]), batch([3]), batch([4])]), "k")]
    assert runs == [[1, 1], [2, 2], [3, 3], [4]]


def test_spread_join_and_checked_sides(spark):
    left = spark.range(1000).selectExpr("if(id % 3 = 0, 7, id) as k", "id as v")
    right = spark.createDataFrame([(7, "hot"), (8, "one")], "k long, name string")
    got = {(r.k, r.v): r.name for r in frames.spread_join(left, right, "k").collect()}
    assert len(got) == 1000 and sum(n == "hot" for n in got.values()) == sum(1 for r in left.collect() if r.k == 7)
    assert frames.spread_join(left, right, "k", "inner").count() == sum(1 for r in left.collect() if r.k in (7, 8))
    assert frames.few(left, 1000) and not frames.few(left, 999)
    assert frames.without_keys(left, right.select("k"), "k").count() + frames.with_keys(left, right.select("k"), "k").count() == 1000

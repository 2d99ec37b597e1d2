import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import packing as pk
from corpusloom.llm.text import buffers
from llm_data import DOCUMENT, text_of

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "aBz9 .,'<|>!é É×日ñ́ \t\n\x1cßİ"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return pk.Encoder(open(PATH, encoding="utf-8").read())


def ids_of(encoder, texts):
    import pyarrow as pa

    ids, bounds = encoder.encode(*buffers(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


@settings(deadline=None, max_examples=300)
@given(st.lists(st.one_of(st.text(alphabet=ALPHABET, max_size=30), st.text(max_size=12)), min_size=1, max_size=6))
def test_ids_are_the_tokenizers(tokenizer, encoder, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(encoder, texts) == want


def test_special_cases(tokenizer, encoder, monkeypatch):
    texts = ["it's DON'T 'll", "<|endoftext|> <|ENDOFTEXT|>", "ÀÉÎ×÷ß ÿ", "a1b22 3.14!!", "", "ét x y", "ÑU 日本。"]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(encoder, texts) == want
    # The same when words are forgotten all the time.
    monkeypatch.setattr(pk, "MEMO_WORDS", 3)
    assert ids_of(encoder, texts * 3) == want * 3


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for parts in by.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by)


def test_documents(spark, documents, tokenizer):
    rows = pk.pack_documents(documents, PATH).collect()
    want = set()
    for r in documents.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want.add((r.doc_id, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    total = sum(r.length for r in rows)
    assert check_places(rows, 4096) <= -(-total // 4096) * 1.05 + 1


def test_edges(spark, edge, nothing):
    rows = pk.pack_documents(edge, PATH, capacity=64).collect()
    check_places(rows, 64)
    assert {r.doc_id for r in rows} == {r.doc_id for r in edge.collect()}
    # Null and white texts are the end id alone; the repeated row is packed twice.
    assert [r.length for r in rows if r.doc_id == 1] == [1]
    assert sum(r.doc_id == 5 for r in rows) == 2
    assert pk.pack_documents(nothing, PATH).count() == 0


def test_groups(spark):
    frame = spark.createDataFrame([(k, text_of(k, 20 + 7 * (k % 30)), "en", "s", 1) for k in range(300)], DOCUMENT)
    pieces = pk.tokenized_pieces(frame, PATH, 512).cache()
    rows = pk.pack(pieces, 512, group_pieces=60).collect()
    assert len(rows) == pieces.count()
    check_places(rows, 512)


def sums_of_squares(lengths, capacity):
    """The rule, by trying every place."""
    gaps, out = [], []
    for size in lengths:
        best = None
        for bin_, gap in [*enumerate(gaps), (len(gaps), capacity)]:
            if gap < size:
                continue
            after = gaps[:bin_] + [gap - size] + gaps[bin_ + 1 :]
            value = sum(after.count(g) ** 2 for g in set(after) if g)
            # Of equals, the smallest gap; a new sequence only if it is better.
            key = (value, gap == capacity, gap)
            if best is None or key < best[0]:
                best = (key, gap)
        gap = best[1]
        out.append(capacity - gap)
        if gap == capacity:
            gaps.append(capacity - size)
        else:
            gaps[gaps.index(gap)] = gap - size
    return out, len(gaps)


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(1, 12), max_size=25))
def test_rule(lengths):
    bins, offsets = pk.pack_lengths(np.array(lengths, dtype=np.int64), 12)
    want, count = sums_of_squares(lengths, 12)
    assert offsets.tolist() == want
    assert len(set(bins.tolist())) == count

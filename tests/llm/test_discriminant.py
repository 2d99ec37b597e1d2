"""Quality scores against a plain model of the same statistics, and on withheld labels."""

import collections
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import discriminant as D
from corpusloom.llm.text import buffers
from llm_data import text_of

LABELS = "doc_id long, quality int"


def plain_statistics(text):
    """The statistics of one text, word by word."""
    text = text or ""
    white = " \t\n\x0b\x0c\r"
    words = [w for w in re.split("[" + white + "]+", text) if w]
    lines = [[w for w in re.split("[" + white + "]+", line) if w] for line in text.split("\n")]
    spans = [re.sub("^[" + white + "]+|[" + white + "]+$", "", line) for line in text.split("\n")]
    spans = [s for s, line in zip(spans, lines) if line]
    lines = [line for line in lines if line]
    n, w, m = len(text), len(words), len(lines)
    symbols = set("#$%&*+/<=>@[\\]^_`{}~")
    odds = lambda a, b: np.log((a + 0.5) / (max(b - a, 0) + 0.5))
    letter = lambda c: c.isascii() and c.isalpha() or ord(c) > 127
    length = sum(map(len, words))
    ascii_letters = lambda x: [c for c in x if c.isascii() and c.isalpha()]
    upper = lambda x: sum("A" <= c <= "Z" for c in x)
    values = [
        np.log1p(n), np.log1p(w), np.log1p(m), np.log(length + 5) - np.log(w + 1), np.log1p(max(map(len, words), default=0)),
        np.log((w + 1) / (m + 1)), np.log((w + 1) / (sum(x[-1] in ".?" for x in words) + 1)),
        odds(upper(text), n), odds(sum("0" <= c <= "9" for c in text), n), odds(sum(c in ".?" for c in text), n),
        odds(sum(c in ",;:" for c in text), n), odds(text.count("!"), n), odds(sum(c in symbols for c in text), n),
        odds(text.count("|"), n), odds(n - length, n), odds(sum(ord(c) > 127 for c in text), n),
        odds(sum("A" <= x[0] <= "Z" for x in words), w),
        odds(sum(upper(x) > 1 and upper(x) == len(ascii_letters(x)) for x in words), w),
        odds(sum(not any(map(letter, x)) for x in words), w), odds(sum(x[-1] in symbols | {"!"} for x in words), w),
        odds(len(set(words)), w), odds(len(set(zip(words, words[1:]))), max(w - 1, 0)),
        odds(sum(len(line) <= D.SHORT_LINE for line in lines), m), odds(sum(line[-1][-1] not in ".?!" for line in lines), m),
        odds(len(set(spans)), m),
    ]
    return np.rint(np.array(values) * D.STEP).astype(np.int64)


TEXTS = [
    "", " \n\t ", "One", "Hello, World! It is 12:30.\n\nTHE END!! of $$$ it ***\n a | b | c\nHello, World! It is 12:30.",
    "été É ñ 日本語 \U0001f600 x", "a\n a \nb\r\na", text_of(4, 300), "x" * 5000, "I I I I. II. III? IV!\n-- ---\n(ok)",
]


def test_statistics_equal_the_plain_ones():
    data, off = buffers(pa.array(TEXTS))
    found = D.block_statistics(data, off)
    for text, row in zip(TEXTS, found):
        assert dict(zip(D.STATISTICS, row.tolist())) == dict(zip(D.STATISTICS, plain_statistics(text).tolist())), text[:30]
    for text in TEXTS:  # alone or among others
        data, off = buffers(pa.array([text]))
        assert (D.block_statistics(data, off)[0] == plain_statistics(text)).all()
    assert D.block_statistics(*buffers(pa.array([], pa.string()))).shape == (0, len(D.STATISTICS))


def plain_scores(x, y, query):
    """Shrunk quadratic discriminant by numpy's own covariance, solve and determinant."""
    x, query = x / D.STEP, query / D.STEP
    mean, scale = x.mean(axis=0), np.sqrt(np.maximum(x.var(axis=0), 1e-6))
    z, q = (x - mean) / scale, (query - mean) / scale
    logs = []
    for k in (0, 1):
        own = z[y == k]
        cov, _ = D.shrink(np.cov(own.T, bias=True), len(own))
        d = q - own.mean(axis=0)
        sign, logdet = np.linalg.slogdet(cov)
        logs.append(np.log(len(own)) - 0.5 * logdet - 0.5 * (d * np.linalg.solve(cov, d.T).T).sum(axis=1))
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def test_scores_equal_the_plain_model(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    found = {r.doc_id: r for r in D.score_quality(documents, labels).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    quality = {r.doc_id: r.quality for r in labels.collect()}
    out = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in texts}
    learned = [i for i in quality if not out[i]]
    x = np.array([plain_statistics(texts[i]) for i in learned])
    ids = sorted(texts)
    wanted = plain_scores(x, np.array([quality[i] for i in learned]), np.array([plain_statistics(texts[i]) for i in ids]))
    for i, score in zip(ids, wanted):
        assert found[i].held_out == out[i] and found[i].score == pytest.approx(score, rel=1e-6, abs=1e-9)
        assert found[i].predicted == int(found[i].score >= 0.7)


def test_withheld_labels_are_predicted(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = D.score_quality(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), labels)
    counts = collections.Counter(
        (r.quality, r.predicted) for r in found.filter("held_out").join(labels, "doc_id").select("quality", "predicted").collect()
    )
    assert counts[1, 1] >= 0.98 * (counts[1, 0] + counts[1, 1])
    assert counts[0, 0] >= 0.98 * (counts[0, 0] + counts[0, 1])


def test_the_model_does_not_depend_on_partitions_or_withheld_labels(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    first = {r.doc_id: r.score for r in D.score_quality(documents, labels).collect()}
    turned = labels.withColumn("quality", F.when(D.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = D.score_quality(documents.repartition(5, "n_chars"), turned.repartition(3))
    assert {r.doc_id: r.score for r in again.collect()} == pytest.approx(first, rel=1e-9)


def test_edge_rows(spark, edge, nothing):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (5, 1), (7, None), (8, 3), (None, 1), (9, 0), (99, 1)], LABELS)
    rows = D.score_quality(edge, labels).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert {"node", "part", "hashes"} <= set(rows[0].asDict()) and "text" not in rows[0].asDict()
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    assert D.score_quality(nothing, labels).collect() == []


def test_missing_classes(spark, documents):
    none = D.score_quality(documents, spark.createDataFrame([], LABELS))
    assert {r.score for r in none.collect()} == {0.5}
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 4 != 2]
    one = D.score_quality(documents, spark.createDataFrame([(i, 1) for i in ids], LABELS))
    assert {(r.score, r.predicted) for r in one.collect()} == {(1.0, 1)}


def test_repeated_labels_count_as_often(spark, documents):
    measured = D.text_statistics(documents.select("doc_id", "text")).cache()
    labels = [(i, int(i % 3 > 0)) for i in range(60)]
    once = D.learn(measured, spark.createDataFrame(labels * 3, LABELS))
    copies = measured.unionByName(measured).unionByName(measured)
    assert np.allclose(once.means, D.learn(copies, spark.createDataFrame(labels, LABELS)).means)
    assert once.logdets == pytest.approx(D.learn(copies, spark.createDataFrame(labels, LABELS)).logdets)

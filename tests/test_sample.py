import hashlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import evaluate, sample
from corpusloom.plans.prepare import capped_rows, prepare, split_rows
from corpusloom.session import scratch_path, shared_dir
from corpusloom.sources import tables

LABELLED = "doc_id bigint, text string, label int, source string"


def uniform(key):
    return int(hashlib.md5(f"42:{key}".encode()).hexdigest()[:8], 16) / 2**32


def quotas(sizes, cap):
    total = sum(sizes.values())
    cap = min(cap, total)
    exact = {k: Fraction(cap * n, total) for k, n in sizes.items()}
    out = {k: int(v) for k, v in exact.items()}
    order = sorted(sizes, key=lambda k: (out[k] - exact[k], k is not None, k or 0))
    for k in order[:cap - sum(out.values())]:
        out[k] += 1
    return out


@pytest.mark.parametrize("cap", [1, 7, 100, 10_000])
def test_stratified_cap_keeps_shares(spark, cap):
    """Skewed and null labels, a class of short texts, and a class of one row."""
    label = lambda k: 2 if k == 11 else None if k % 17 == 0 else 1 if k % 10 == 0 else 0
    text = lambda k: "short" if k % 3 == 0 and label(k) == 1 else "long enough a text"
    data = [(k, text(k), label(k), "IMDB") for k in range(1500)]
    frame = spark.createDataFrame(data, LABELLED)
    got = sorted(r.doc_id for r in capped_rows(frame, cap, "label").filter("split = 'train'").collect())
    train = [k for k in sorted(range(1500), key=uniform) if uniform(k) < 0.8]
    want = []
    for name, quota in quotas(Counter(map(label, train)), cap).items():
        want += [k for k in train if label(k) == name and text(k) != "short"][:quota]
    assert got == sorted(want)


def test_joined_and_listed_groups_agree(spark, folder, monkeypatch):
    labelled = tables.load_labelled(spark, folder)
    keys = [sorted(r.doc_id for r in capped_rows(labelled, 40, "label").select("doc_id").collect())]
    monkeypatch.setattr(sample, "LISTED_GROUPS", 0)
    keys.append(sorted(r.doc_id for r in capped_rows(labelled, 40, "label").select("doc_id").collect()))
    assert keys[0] == keys[1] and keys[0]


def test_edge_is_exact(spark):
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("g"))
    sketch = sample.order_sketch(frame, ["g"], cells=16)
    for wanted in (1, 100, 1500, 9000):
        for r in sample.with_edge(sketch, F.lit(wanted), cells=16).collect():
            cells = Counter(int(uniform(k) * 16) for k in range(3000) if k % 2 == r.g)
            edges = [e for e in range(1, 17) if sum(cells[c] for c in range(e)) >= wanted]
            assert r.edge == (edges[0] if edges else 16) and r.n == 1500


def test_no_rows(spark):
    assert capped_rows(spark.createDataFrame([], LABELLED), 10, "label").count() == 0


def test_preparing_leaves_nothing_in_between(spark, folder):
    import os

    scratch = os.path.join(shared_dir(spark).removeprefix("file:"), "corpusloom")
    before = set(os.listdir(scratch)) if os.path.exists(scratch) else set()
    path = prepare(tables.load_labelled(spark, folder), scratch_path(spark, "kept"), 2, samples=20, stratify="label")
    assert set(os.listdir(scratch)) - before == {os.path.basename(path)}
    assert spark.read.parquet(path).filter("split = 'train'").count() == 20 <= split_rows(
        tables.load_labelled(spark, folder)
    ).count()


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_equals_all_pairs(spark):
    """Ties, one class alone, nulls and NaN."""
    data = [("a", (k * 37 % 101) / 101, int(k * k % 7 < 3)) for k in range(300)]
    data += [("b", 0.5, k % 2) for k in range(40)] + [("c", k / 10, 1) for k in range(5)]
    data += [("d", 1e-6 * k, int(k > 5)) for k in range(10)]
    extra = [("a", None, 1), ("a", float("nan"), 0), ("a", 0.3, None)]
    frame = spark.createDataFrame(data + extra, "g string, score double, label int")
    got = {r.g: r for r in evaluate.auc(frame, "g").collect()}
    for g in "abcd":
        rows = [(round(s * 10**9), y) for h, s, y in data if h == g]
        assert got[g].auc == pytest.approx(brute_auc(rows)) if g != "c" else got[g].auc is None
        assert got[g].positives + got[g].negatives == len(rows)
    everything = evaluate.auc(frame).first()
    assert everything.auc == pytest.approx(brute_auc([(round(s * 10**9), y) for _, s, y in data]))
    assert evaluate.auc(frame.limit(0)).first().auc is None


def test_grouping_sets_agree_with_single_groupings(spark):
    data = [(None if k % 5 == 0 else k % 3, k % 2, k % 2, (k // 2) % 2, float(k)) for k in range(60)]
    frame = spark.createDataFrame(data, "split int, shard int, label int, pred int, loss double")
    got = evaluate.by_grouping_sets(frame, "split", "shard")
    for level, by in ((0, ["split", "shard"]), (1, ["split"]), (3, [])):
        single = frame.groupBy(*by).agg(
            F.count(F.lit(1)).alias("rows"), F.avg("loss").alias("loss"),
            F.avg((F.col("pred") == F.col("label")).cast("int")).alias("accuracy"),
        )
        columns = [*by, "rows", "loss", "accuracy"]
        key = lambda r: repr(tuple(r))
        assert sorted(got.filter(F.col("level") == level).select(*columns).collect(), key=key) == sorted(
            single.select(*columns).collect(), key=key
        )
    nothing = evaluate.by_grouping_sets(frame.limit(0), "split", "shard").collect()
    assert [(r.level, r.rows, r.loss) for r in nothing] in ([(3, 0, None)], [])

"""Centroid clustering against plain distances in whole numbers of any size."""

import hashlib
import math
import random

import numpy as np
import pytest

from corpusloom.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int"


def plain(rows, clusters=8, rounds=10):
    """All rounds in Python's whole numbers; one tuple per kept vector."""
    kept = [
        (i, [math.floor(1024 * x) if abs(x) < 2**52 else int(x) * 1024 for x in v]) for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "z"
    centres = [q for _, q in sorted(kept, key=lambda r: (digest(r), r[1]))[:clusters]]

    def place(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        own = [[] for _ in centres]
        for _, q in kept:
            own[place(q)[1]].append(q)
        centres = [[sum(col) // len(v) for col in zip(*v)] if v else c for v, c in zip(own, centres)]
    placed = [(i, *reversed(place(q))) for i, q in kept]
    whole = sum(d for _, _, d in placed)
    each = {k: sum(d for _, j, d in placed if j == k) for _, k, _ in placed}
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, k, d, each[k], whole, text[k]) for i, k, d in placed), key=str)


def vectors(seed, count, scale=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(i % 5, 1) * scale for _ in range(64)]) for i in range(count)]


def report(spark, rows):
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in C.cluster_report(frame.repartition(3)).collect()), key=str)


def test_transform_is_exact_and_ordered():
    x = np.random.default_rng(0).integers(-(2**23), 2**23, (20, 64))
    assert ((C.transform(x).astype(object) ** 2).sum(axis=1) == 64 * (x.astype(object) ** 2).sum(axis=1)).all()
    assert sorted(C.coarse_to_fine()) == list(range(64))
    rows = C.transform(np.eye(64, dtype=np.int64))[:, C.coarse_to_fine()]
    assert (np.diff((np.diff(rows, axis=0) != 0).sum(axis=0)) >= 0).all()


@pytest.mark.parametrize("spread", [1, 50, 3000])
def test_nearest_equals_all_distances(spread):
    rng = np.random.default_rng(spread)
    x, c = rng.integers(-spread, spread + 1, (400, 64)), rng.integers(-spread, spread + 1, (8, 64))
    c[5], x[:8] = c[2], c
    best, distance, added = C.nearest(x, c)
    plainly = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (best == plainly.argmin(axis=1)).all() and (distance == plainly.min(axis=1)).all()
    assert added <= x.size * len(c)


def test_smooth_vectors_are_decided_by_coarse_coefficients():
    rng = np.random.default_rng(2)
    c = np.repeat(rng.integers(-3000, 3000, (8, 4)), 16, axis=1)
    x = c[rng.integers(0, 8, 500)] + rng.integers(-5, 6, (500, 64))
    best, distance, added = C.nearest(x, c)
    assert (distance == ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1)).all()
    assert added < 0.3 * x.size * len(c)


def test_report_equals_plain_rounds(spark):
    rows = vectors(1, 120)
    assert report(spark, rows) == plain(rows)


def test_unfit_repeated_and_null_rows(spark):
    rows = vectors(2, 30)
    bad = [(90, None), (91, []), (92, [1.0] * 63), (93, [1.0] * 65), (94, [None] + [1.0] * 63), (95, [math.nan] + [0.0] * 63),
           (96, [math.inf] * 64), (97, [-math.inf] * 64)]
    more = [(3, rows[4][1]), (3, rows[3][1]), (None, rows[5][1]), (None, rows[9][1])]
    found = report(spark, rows + bad + more)
    assert len(found) == 34 and found == plain(rows + more)


def test_equal_vectors_and_empty_centroids(spark):
    rows = [(i, [0.25] * 64) for i in range(20)] + [(99, [-0.00049] * 64)]
    found = report(spark, rows)
    assert found == plain(rows) and {r[1] for r in found} <= {0, 1, 2, 3, 4, 5, 6, 7}


def test_few_vectors_and_none(spark):
    rows = vectors(3, 3)
    assert report(spark, rows) == plain(rows)
    assert report(spark, []) == [] and report(spark, [(1, [1.0])]) == []


def test_components_beyond_the_narrow_range(spark):
    # Distances of up to 64 x (2^27)^2 still fit a long.
    rows = vectors(4, 25, scale=2.0**15)
    assert max(abs(x) * 1024 for _, v in rows for x in v) > C._NARROW
    assert report(spark, rows) == plain(rows)


def test_too_large_a_distance_raises(spark):
    rows = [(i, [1e30 * i] * 64) for i in range(10)]
    with pytest.raises(Exception, match="(?i)overflow|too large|int64|int too|convert"):
        report(spark, rows)

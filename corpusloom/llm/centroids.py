"""Clustering around centroids, the nearest found by Walsh-Hadamard progressive search.

Vectors of 64 whole numbers and their centroids go through an exact Walsh-Hadamard
transform, which multiplies every squared distance by 64.  Squared differences of
coefficients are then added from the coarsest to the finest; what is added so far never
exceeds the whole distance, so a centroid whose part is already above the whole distance
of another is strictly worse and is left out.  The others are added up to all 64.

- Kept are vectors of exactly 64 components, none null, NaN or infinite.  A component x
  becomes floor(1024 x), x as double.
- Ties go to the smaller centroid number.  An empty centroid stays where it is.
- Fewer than 8 kept vectors give as many centroids; no kept vector gives no rows.
- Repeated ids are separate vectors; among the starting vectors a null id comes last and
  equal ids go by their components.
- Components beyond 2^24 after scaling are worked on as unbounded whole numbers; a
  distance or sum of distances over 2^63 raises.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.session import materialise

WIDTH = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
# Below this size of a component 64 squared distances of 64 components fit 63 bits.
_NARROW = 1 << 24
# Coefficients added between two looks at what can be left out.
_STEPS = (4, 8, 16, 32, 64)
_DECIMAL = pa.decimal128(38, 0)


def coarse_to_fine(width: int = WIDTH) -> np.ndarray:
    """The coefficients of the transform by the sign changes of their row."""
    rows = transform(np.eye(width, dtype=np.int64))
    return np.argsort((np.diff(rows, axis=1) != 0).sum(axis=1), kind="stable")


def transform(vectors: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, in whole numbers and natural order."""
    out = vectors.copy()
    half = 1
    while half < out.shape[1]:
        pairs = out.reshape(len(out), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(out.shape)
        half *= 2
    return out


def whole_numbers(column: pa.Array) -> np.ndarray:
    """floor(1024 x) of lists of 64 finite numbers, as int64 where that is safe."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), WIDTH)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * SCALE)
    if not scaled.size or np.abs(scaled).max() < _NARROW:
        return scaled.astype(np.int64)
    # Scaling is exact in doubles but for the largest, which whole numbers hold.
    exact = [int(np.floor(x)) * SCALE if abs(x) >= 2.0**53 else int(np.floor(x * SCALE)) for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each row's nearest centroid.

    The third value counts the squared differences that were added, for tests.
    """
    order = coarse_to_fine()
    x, c = transform(vectors)[:, order], transform(centroids)[:, order]
    rows, count = len(x), len(c)
    kind = object if x.dtype == object or c.dtype == object else np.int64
    total = np.zeros((rows, count), dtype=kind)
    done = np.zeros((rows, count), dtype=np.int64)
    added = 0

    def add(at: np.ndarray, which: np.ndarray, start: int, end: int) -> None:
        nonlocal added
        difference = x[at, start:end] - c[which, start:end]
        total[at, which] += (difference * difference).sum(axis=1)
        done[at, which] = end
        added += difference.size

    every = np.repeat(np.arange(rows), count)
    add(every, np.tile(np.arange(count), rows), 0, _STEPS[0])
    # The leader of the coarsest part is finished first; its distance bounds the others.
    row, leader = np.arange(rows), total.argmin(axis=1)
    add(row, leader, _STEPS[0], WIDTH)
    bound = total[row, leader]
    for start, end in zip(_STEPS[:-1], _STEPS[1:]):
        at, which = np.nonzero((done == start) & (total <= bound[:, None]))
        add(at, which, start, end)
        if end == WIDTH:
            bound = np.minimum(bound, np.where(done == WIDTH, total, bound[:, None]).min(axis=1)) if rows else bound
    found = (done == WIDTH) & (total == bound[:, None])
    best = found.argmax(axis=1)
    return best, bound // WIDTH, added


def kept_vectors(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The rows that take part, as `vec_id` and `embedding`."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.select(F.col(key).alias("vec_id"), F.col(vector).alias("embedding"))
    return rows.filter((F.size("embedding") == WIDTH) & finite)


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS, seed: int = 3) -> list[list[int]]:
    """The vectors with the least SHA-256 of `seed:vec_id`; at most `clusters` rows travel."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.withColumn("digest", digest).orderBy(F.asc_nulls_last("digest"), "embedding").limit(clusters).collect()
    vectors = pa.array([r.embedding for r in rows], pa.list_(pa.float64()))
    return [[int(v) for v in row] for row in whole_numbers(vectors)] if rows else []


def _as_array(centroids: list[list[int]]) -> np.ndarray:
    wide = max(abs(v) for row in centroids for v in row) >= _NARROW
    return np.array(centroids, dtype=object if wide else np.int64)


def _sums(centroids: list[list[int]]):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _as_array(centroids)
        sums: dict[int, list[int]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = whole_numbers(batch.column(0))
            best = nearest(vectors, table)[0]
            for k in np.unique(best).tolist():
                own = vectors[best == k]
                part = [*own.sum(axis=0).tolist(), len(own)]
                sums[k] = [a + b for a, b in zip(sums[k], part)] if k in sums else part
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k in sums for _ in range(WIDTH + 1)], pa.int32()),
                pa.array([d for _ in sums for d in range(WIDTH + 1)], pa.int32()),
                pa.array([Decimal(v) for k in sums for v in sums[k]], _DECIMAL),
            ],
            ["cluster", "part", "total"],
        )

    return add


def move_centroids(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: each centroid becomes the exact floor of its vectors' mean.

    A task sends 65 numbers per cluster, which are added before and after a small shuffle.
    """
    partial = kept.select("embedding").mapInArrow(_sums(centroids), "cluster int, part int, total decimal(38,0)")
    sums = {(r.cluster, r.part): int(r.total) for r in partial.groupBy("cluster", "part").agg(F.sum("total").alias("total")).collect()}
    return [
        [sums[k, d] // sums[k, WIDTH] for d in range(WIDTH)] if (k, WIDTH) in sums else own
        for k, own in enumerate(centroids)
    ]


def assign(kept: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """`vec_id`, `cluster` and `distance` of every vector."""
    names = ["vec_id", "cluster", "distance"]
    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _as_array(centroids)
        for batch in batches:
            if batch.num_rows:
                best, distance, _ = nearest(whole_numbers(batch.column(1)), table)
                columns = [batch.column(0), pa.array(best, pa.int32()), pa.array(distance.tolist(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return kept.select("vec_id", "embedding").mapInArrow(place, schema)


def cluster(
    embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3,
) -> tuple[DataFrame, list[list[int]]]:
    """Every kept vector with its cluster and distance, and the final centroids.

    The kept vectors are written once.  The driver holds `clusters` x 64 numbers; each
    round reads the written vectors and shuffles 65 numbers per task and cluster.
    """
    kept = materialise(kept_vectors(embeddings), "vectors")
    centroids = first_centroids(kept, clusters, seed)
    if not centroids:
        return kept.selectExpr("vec_id", "0 as cluster", "0L as distance").filter("false"), []
    for _ in range(rounds):
        centroids = move_centroids(kept, centroids)
    return materialise(assign(kept, centroids), "assigned"), centroids


def cluster_report(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3) -> DataFrame:
    """`cluster` with the distance summed per cluster and over all, and each centroid's digest.

    The driver and the table joined to the vectors have one row per cluster.
    """
    assigned, centroids = cluster(embeddings, clusters, rounds, seed)
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    own = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(exact).collect()}
    few = [
        (k, own[k], sum(own.values()), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for k, row in enumerate(centroids) if k in own
    ]
    table = assigned.sparkSession.createDataFrame(
        few, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

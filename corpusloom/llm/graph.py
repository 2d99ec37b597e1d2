"""Connected components by alternating stars, in a logarithmic number of rounds.

Every vertex ends up next to its component's least vertex.  Links are rows throughout;
nothing is collected but whether the links have become stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.frames import few, spread_join
from corpusloom.session import materialise, parallelism

# Up to this many links a round's least neighbours, at most twice as many, are broadcast.
BROADCAST_LINKS = 200_000


def forest_roots(pairs) -> dict:
    """Each end of the pairs with the least end of its component."""
    root: dict = {}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        root.setdefault(a, a)
        root.setdefault(b, b)
        a, b = find(a), find(b)
        if a < b:
            root[b] = a
        elif b < a:
            root[a] = b
    return {x: find(x) for x in root}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition's links as stars; it holds its own links only."""
    pairs, kind = [], None
    for batch in batches:
        kind = batch.schema.field(0).type
        pairs += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
    if kind is not None:
        stars = [(x, r) for x, r in forest_roots(pairs).items() if x != r]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in stars], kind), pa.array([r for _, r in stars], kind)], ["u", "v"]
        )


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _with_least(edges: DataFrame, least: DataFrame, small: bool) -> DataFrame:
    """Each link with the least of its `u`; hot vertices are spread, or not shuffled at all."""
    return edges.join(F.broadcast(least), "u") if small else spread_join(edges, least, "u", "inner")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each vertex has one link and none has links in both roles."""
    ends = F.explode(F.array(
        F.struct(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    ))
    roles = edges.select(ends.alias("e")).select("e.*").groupBy("id").agg(
        F.sum("up").alias("up"), F.max("down").alias("down")
    )
    return roles.filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`(id, root)` for each vertex of `links`; `root` is the least id of its component.

    Self links and repeated links are allowed; links with a null end are ignored.  Ids are
    binary, strings or numbers.
    """
    ends = [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]
    pairs = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*ends).filter("u <> v")
    kind = pairs.schema["u"].dataType.simpleString()
    # Stars within each partition first: most components are small and end here.
    placed = pairs.repartition(parallelism(links.sparkSession), "v")
    edges = materialise(placed.mapInArrow(_contract, f"u {kind}, v {kind}"), "links")
    while not _are_stars(edges):
        small_graph = few(edges, BROADCAST_LINKS)
        # Every larger neighbour moves to the least of the closed neighbourhood.
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).select("u", F.least("u", "m").alias("m"))
        large = _with_least(both, least, small_graph).filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).filter("u <> v")
        # Every smaller neighbour moves to the least of them.
        small = _with_least(large, _least(large), small_graph)
        moved = small.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
        )).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        edges = materialise(moved, "links")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)

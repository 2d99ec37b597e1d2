"""Samples of least order numbers, from a sketch of fixed size.

The sketch of a group is a count per cell of the order number.  Parts are merged by adding
(Spark does so before the shuffle), it never holds more than `CELLS` counts, and the cell in
which the k least order numbers end is exact, whatever the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.functions.hashing import order_uniform
from corpusloom.operators.numbering import default_buckets, hash_bucket, number_rows

CELLS = 4096
# Groups that a filter lists one by one; more are joined.
LISTED_GROUPS = 64


def order_sketch(df: DataFrame, groups: list[str], key: str = "doc_id", cells: int = CELLS) -> DataFrame:
    """Per group its rows `n`, and `cells`, the counts of the cells that are not empty."""
    counts = df.groupBy(*groups, hash_bucket(F.col(key), cells).alias("cell")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.groupBy(*groups).agg(
        F.sum("rows").alias("n"), F.array_sort(F.collect_list(F.struct("cell", "rows"))).alias("cells")
    )


def with_quota(sizes: DataFrame, cap: Column, within: list[str], by: list[str]) -> DataFrame:
    """Add `quota`, the share of each (`within`, `by`) group in the cap of its `within` group.

    Shares go by `n`.  Their whole parts are given first, then one each to the largest
    remainders, the least `by` values on ties.  A quota never exceeds `n`, and quotas add
    up to the cap or to all rows.
    """
    group = Window.partitionBy(*within)
    wide = "decimal(18,0)"
    whole = sizes.withColumn("total", F.sum("n").over(group)).withColumn("cap", F.least(cap.cast("long"), "total"))
    product = F.col("cap").cast(wide) * F.col("n").cast(wide)
    parted = whole.withColumn("product", product).withColumns({
        "base": F.expr("cast(product div total as bigint)"), "rest": F.expr("product % total"),
    })
    left = F.col("cap") - F.sum("base").over(group)
    place = F.row_number().over(group.orderBy(F.desc("rest"), *by))
    quota = F.col("base") + (place <= left).cast("long")
    return parted.withColumn("quota", quota).drop("total", "cap", "product", "base", "rest")


def with_edge(sketch: DataFrame, wanted: Column, cells: int = CELLS) -> DataFrame:
    """Replace `cells` by `edge`: at least `wanted` rows, or all, are in cells below it."""
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).alias("edge"))

    def step(at: Column, cell: Column) -> Column:
        further = F.struct((at.seen + cell.rows).alias("seen"), (cell.cell + 1).alias("edge"))
        return F.when(at.seen >= F.col("wanted"), at).otherwise(further)

    walked = F.aggregate("cells", start, step)
    found = sketch.withColumn("wanted", wanted.cast("long")).withColumn("walked", walked)
    edge = F.when(F.col("walked.seen") < F.col("wanted"), cells).otherwise(F.col("walked.edge"))
    return found.withColumn("edge", edge).drop("cells", "wanted", "walked")


def _matches(row: dict, groups: list[str]) -> Column:
    same = F.lit(True)
    for name in groups:
        same = same & F.col(name).eqNullSafe(F.lit(row[name]))
    return same


def join_groups(df: DataFrame, rows: list[dict], groups: list[str], columns: dict[str, str]) -> DataFrame:
    """Add driver-side `columns` of a row per group; rows of other groups go.

    There is one row per split and class, as in the weights of a head, so Spark
    broadcasts the table by its own size check.  Null group values match each other.
    """
    kinds = [f"`of_{g}` {df.schema[g].dataType.simpleString()}" for g in groups]
    kinds += [f"`{c}` {kind}" for c, kind in columns.items()]
    data = [tuple(r[c] for c in (*groups, *columns)) for r in rows]
    table = df.sparkSession.createDataFrame(data, ", ".join(kinds))
    same = [df[g].eqNullSafe(table[f"of_{g}"]) for g in groups]
    return df.join(table, same).drop(*[f"of_{g}" for g in groups])


def between_edges(
    df: DataFrame, rows: list[dict], groups: list[str], key: str = "doc_id", cells: int = CELLS
) -> DataFrame:
    """Rows in the cells from `low` up to `edge` of their group.

    Few groups are listed in the filter, which then reaches below joins and shuffles.
    """
    cell = hash_bucket(F.col(key), cells)
    if len(rows) > LISTED_GROUPS:
        joined = join_groups(df, rows, groups, {"low": "int", "edge": "int"})
        return joined.filter((cell >= F.col("low")) & (cell < F.col("edge"))).drop("low", "edge")
    wanted = F.lit(False)
    for row in rows:
        wanted = wanted | (_matches(row, groups) & (cell >= row["low"]) & (cell < row["edge"]))
    return df.filter(wanted)


def head_of_groups(df: DataFrame, rows: list[dict], groups: list[str], key: str = "doc_id") -> DataFrame:
    """The first `quota` rows of each group in the seeded order.  Reads `df` twice."""
    numbered = [{**r, "stratum": i} for i, r in enumerate(rows)]
    placed = join_groups(df, numbered, groups, {"stratum": "int", "quota": "bigint"})
    capped = number_rows(
        placed.withColumn("order_bucket", hash_bucket(F.col(key), default_buckets(df))),
        group=["stratum", "quota"],
        major=["order_bucket"],
        minor=[order_uniform(F.col(key)), key],
        below=F.col("quota"),
    )
    return capped.select(*df.columns)

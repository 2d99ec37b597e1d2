"""Left lookups by token into a table too large to broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Frequent tokens matched by broadcast, so that they are never shuffled to one task.
HOT_TOKENS = 10_000


def lookup(
    rows: DataFrame, token: str, spread: Column, table: DataFrame, value: str, hot_tokens: int = HOT_TOKENS
) -> DataFrame:
    """Add `value` of `table` to rows by their `token`, null where there is none.

    `table` has `token`, unique, and `value`.  The `hot_tokens` most frequent tokens of the
    rows are looked up once and broadcast, also those that the table lacks.  Their rows go
    on under a key of their own, `spread` after a space, which no token has; so only rows
    of rare tokens meet by value.  `rows` is read twice.
    """
    named = table.select(F.col("token").alias(token), F.col(value).alias("hot_value"))
    counts = rows.groupBy(token).agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.orderBy(F.desc("n"), token).limit(hot_tokens).select(token)
    hot = frequent.join(named, token, "left").withColumn("is_hot", F.lit(True))
    matched = rows.join(F.broadcast(hot), token, "left")
    apart = F.concat(F.lit(" "), spread.cast("string"))
    key = F.when(F.col("is_hot").isNull(), F.col(token)).otherwise(apart)
    rare = table.select(F.col("token").alias("lookup_key"), F.col(value).alias("rare_value"))
    found = matched.withColumn("lookup_key", key).join(rare, "lookup_key", "left")
    return found.withColumn(value, F.coalesce("hot_value", "rare_value")).drop(
        "lookup_key", "hot_value", "rare_value", "is_hot"
    )

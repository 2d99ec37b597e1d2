"""Losses and accuracies of scored rows: `split`, `shard`, `batch_id`, `label`, `pred`, `loss`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.operators.numbering import number_rows


def _correct():
    return F.sum((F.col("pred") == F.col("label")).cast("long"))


def accuracy(scored: DataFrame, *by: str) -> DataFrame:
    """`correct`, `total` and `accuracy` over all shards of each group.

    Without groups an empty input gives one row with a null accuracy, not an error.
    """
    counts = scored.groupBy(*by).agg(
        F.coalesce(_correct(), F.lit(0)).alias("correct"), F.count("pred").alias("total")
    )
    ratio = F.col("correct") / F.nullif(F.col("total"), F.lit(0))
    return counts.withColumn("accuracy", ratio)


def batch_loss(scored: DataFrame, *by: str) -> DataFrame:
    """Mean over batches of the mean loss over that batch's rows of all shards.

    A NaN loss makes its group's loss NaN.
    """
    per_shard = scored.groupBy(*by, "shard", "batch_id").agg(F.avg("loss").alias("loss"))
    per_batch = per_shard.groupBy(*by, "batch_id").agg(F.avg("loss").alias("loss"))
    return per_batch.groupBy(*by).agg(F.avg("loss").alias("loss"))


def shard_loss(scored: DataFrame) -> DataFrame:
    """Each shard's own mean loss."""
    return scored.groupBy("split", "shard").agg(F.avg("loss").alias("loss"))


def by_dataset(scored: DataFrame) -> DataFrame:
    """Rows, mean loss and accuracy of each split in one aggregation."""
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("loss").alias("loss"),
        (_correct() / F.count("pred")).alias("accuracy"),
    )


def by_grouping_sets(scored: DataFrame, *by: str) -> DataFrame:
    """Rows, correct rows, mean loss and accuracy of each group, of each coarser one, and of all.

    `level` tells them apart from groups of null values: its bits, the last column's lowest, mark
    the columns summed over.  Rows are added up per finest group before they are copied
    for the sets.  Empty input gives one row, of all, without a mean.
    """
    finest = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), _correct().alias("right"), F.count("pred").alias("predicted"),
        F.sum("loss").alias("loss_sum"), F.count("loss").alias("losses"),
    )
    sets = [[F.col(c) for c in by[:n]] for n in range(len(by), -1, -1)]
    summed = finest.groupingSets(sets, *by).agg(
        F.grouping_id().cast("int").alias("level"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("right"), F.lit(0)).alias("correct"),
        (F.sum("loss_sum") / F.nullif(F.sum("losses"), F.lit(0))).alias("loss"),
        (F.sum("right") / F.nullif(F.sum("predicted"), F.lit(0))).alias("accuracy"),
    )
    return summed.select(*by, "level", "rows", "correct", "loss", "accuracy")


def positive_score(loss: Column, label: Column) -> Column:
    """The probability of class 1 of two, from a row's cross entropy."""
    own = F.exp(-loss)
    return F.when(label == 1, own).otherwise(1 - own)


# Scores are ranked as whole numbers of a billionth; a block holds this many of them.
SCORE_STEPS = 10**9
BLOCK_STEPS = 2**15


def auc(scored: DataFrame, *by: str, score: str = "score", positive: int = 1) -> DataFrame:
    """Area under the ROC curve of each group: exact, ties counted half.

    Scores from 0 to 1 that agree to a billionth are ties.  Rows are added up per distinct
    score, ranked inside blocks of scores, and blocks are ranked by their sums: no task
    ranks more than `BLOCK_STEPS` sums or so, however rows and scores fall.  Rows without
    score or label do not count; a group that lacks one of the classes has no area.
    """
    usable = scored.filter(F.col("label").isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    place = F.round(F.col(score) * SCORE_STEPS).cast("long")
    hit = F.col("label") == positive
    values = usable.select(*by, place.alias("place"), hit.alias("hit")).groupBy(
        *by, F.expr(f"place div {BLOCK_STEPS}").alias("block"), "place"
    ).agg(F.count_if("hit").alias("pos"), F.count_if(~F.col("hit")).alias("neg"))
    inside = Window.partitionBy(*by, "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    outside = Window.partitionBy(*(by or [F.lit(0)])).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    none, wide = F.lit(0).cast("long"), "decimal(19,0)"

    def twice_below(pos: str, below: Column, tied: Column) -> Column:
        return F.col(pos).cast(wide) * (2 * below + tied).cast(wide)

    ranked = values.withColumn("below", F.coalesce(F.sum("neg").over(inside), none))
    blocks = ranked.groupBy(*by, "block").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
        F.sum(twice_below("pos", F.col("below"), F.col("neg"))).alias("wins"),
    ).withColumn("below", F.coalesce(F.sum("neg").over(outside), none))
    sums = blocks.groupBy(*by).agg(
        F.coalesce(F.sum("pos"), none).alias("positives"), F.coalesce(F.sum("neg"), none).alias("negatives"),
        F.sum(F.col("wins") + twice_below("pos", F.col("below"), none)).alias("wins"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    area = F.col("wins").cast("double") / F.nullif(2 * pairs, F.lit(0.0))
    return sums.select(*by, "positives", "negatives", area.alias("auc"))


def prediction_listing(scored: DataFrame, key: str) -> DataFrame:
    """Prediction, label and match of every row, with `seen`, the rows of its split up to it.

    Rows follow each other by batch, shard and key.  A batch's rows are numbered together.
    """
    rows = scored.select(
        key, "split", "shard", "batch_id", "pred", "label", (F.col("pred") == F.col("label")).alias("matched")
    )
    numbered = number_rows(rows, group=["split"], major=["batch_id"], minor=["shard", key], name="seen")
    return numbered.withColumn("seen", F.col("seen") + 1)

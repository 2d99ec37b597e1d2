"""Vocabularies: counted from a corpus or read from a file of one token per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusloom.operators.numbering import number_rows
from corpusloom.schemas import CLS, FIRST_ID, PAD, SEP, UNK
from corpusloom.session import materialise

SPECIAL = {"[PAD]": PAD, "[UNK]": UNK, "[CLS]": CLS, "[SEP]": SEP}

# Longer words are never split into pieces: the word-piece rule maps them to unknown.
MAX_WORD_CHARS = 100

def count_words(df: DataFrame, column: str = "text") -> DataFrame:
    """Occurrences of each word; counted before the shuffle, so a frequent word costs one
    row per task."""
    exploded = df.select(F.explode(F.split(column, " ")).alias("token")).filter("token <> ''")
    return exploded.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def least_count(counts: DataFrame, size: int) -> int:
    """The count from which on tokens can be among the `size` most frequent."""
    # At most `size` different counts matter, each with one token at least.
    histogram = counts.groupBy("n").agg(F.count(F.lit(1)).alias("tokens")).orderBy(F.desc("n")).limit(size)
    running = F.sum("tokens").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n")))
    reached = histogram.withColumn("reached", running).filter(F.col("reached") >= size)
    return reached.agg(F.max("n")).first()[0] or 0


def top_tokens(counts: DataFrame, size: int, first_id: int = FIRST_ID) -> DataFrame:
    """The `size` most frequent tokens with ids in order of (count descending, token).

    `counts` is read twice and should be a written table.  A histogram of the counts tells
    which tokens can be chosen, so only those are ordered, and the one task that ranks
    them sees `size` rows.
    """
    order = [F.desc("n"), F.asc("token")]
    top = counts.filter(F.col("n") >= least_count(counts, size)).orderBy(*order).limit(size)
    # The window sees at most `size` rows: the limit is applied first.
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    return top.select("token", (rank - 1 + first_id).cast("int").alias("id"), "n")


def build_vocab(df: DataFrame, size: int, column: str = "text", min_count: int = 1) -> DataFrame:
    """`(token, id, n)` of the most frequent words of a cleaned corpus."""
    counts = materialise(count_words(df, column).filter(F.col("n") >= min_count), "word-counts")
    return top_tokens(counts, size)


def count_pieces(word_counts: DataFrame) -> DataFrame:
    """Occurrences of each word piece.

    Pieces are cut from distinct words and weighted by the word's count, so a word is cut
    once however often it occurs.  A piece inside a word is marked `##`.  Words of over
    `MAX_WORD_CHARS` characters are never split, so they have no pieces.
    """
    cut = word_counts.filter(F.length("token") <= MAX_WORD_CHARS).select(
        "token", "n", F.explode(F.sequence(F.lit(1), F.length("token"))).alias("start")
    )
    room = F.length("token") - F.col("start") + 1
    pieces = cut.select(
        "token", "n", "start", F.explode(F.sequence(F.lit(1), room)).alias("chars")
    )
    text = F.substring(F.col("token"), F.col("start"), F.col("chars"))
    piece = F.when(F.col("start") == 1, text).otherwise(F.concat(F.lit("##"), text))
    return pieces.groupBy(piece.alias("token")).agg(F.sum("n").alias("n"))


def build_piece_vocab(
    df: DataFrame, size: int, pieces: int, column: str = "text"
) -> DataFrame:
    """The `size` most frequent words, then the `pieces` most frequent further pieces.

    The word counts are written once: the corpus is read once, not once per use.
    """
    counts = materialise(count_words(df, column), "word-counts")
    whole = top_tokens(counts, size)
    # Pieces that are words already keep the word's id.
    further = count_pieces(counts).join(whole.select("token"), "token", "left_anti")
    return whole.unionByName(top_tokens(materialise(further, "piece-counts"), pieces, FIRST_ID + size))


def read_vocab_file(spark: SparkSession, path: str) -> DataFrame:
    """A vocabulary file with one token per line; the id is the line number from 0.

    Lines are numbered within the block they were read from, and blocks by their place in
    the file, so a large file is read by many tasks.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("token"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    numbered = number_rows(lines, group=[], major=["block"], minor=["line"], name="id")
    return numbered.filter("token <> ''").select(
        "token", F.col("id").cast("int").alias("id"), F.lit(0).cast("long").alias("n")
    )

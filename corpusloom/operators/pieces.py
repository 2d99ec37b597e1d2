"""Word pieces by joins, for a vocabulary too large to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.wordpiece import accent_stripper
from corpusloom.operators.lookup import HOT_TOKENS, lookup
from corpusloom.operators.vocab import MAX_WORD_CHARS
from corpusloom.schemas import UNK


def split_words(
    words: DataFrame, vocab: DataFrame, strip_accents: bool = False, hot_tokens: int = HOT_TOKENS
) -> DataFrame:
    """Add `ids`, the pieces of each distinct word, longest first from the left.

    Every piece a word could have is looked up; the longest known one at each place is
    kept, and a walk over those places, at most a word's length, picks the pieces.  A
    word with a gap, or too long to split, is the unknown id.
    """
    base = accent_stripper()(F.col("token")) if strip_accents else F.col("token")
    based = words.withColumn("base", base)
    # The longest piece that can stand in a word, without the mark of inner pieces.
    bare = F.when(F.col("token").startswith("##"), F.length("token") - 2).otherwise(F.length("token"))
    longest = min(vocab.agg(F.max(bare)).first()[0] or 0, MAX_WORD_CHARS)
    places = based.filter(F.length("base").between(1, MAX_WORD_CHARS)).select(
        "token", "base", F.explode(F.sequence(F.lit(1), F.length("base"))).alias("start")
    )
    room = F.least(F.lit(longest), F.length("base") - F.col("start") + 1)
    cut = places.select("token", "base", "start", F.explode(F.sequence(F.lit(1), room)).alias("chars"))
    text = F.substring(F.col("base"), F.col("start"), F.col("chars"))
    piece = F.when(F.col("start") == 1, text).otherwise(F.concat(F.lit("##"), text))
    candidates = cut.select("token", "start", "chars", piece.alias("piece"))

    known = lookup(candidates, "piece", F.col("token"), vocab, "id", hot_tokens).filter("id is not null")
    longest_known = known.groupBy("token", "start").agg(F.max(F.struct("chars", "id")).alias("piece"))
    steps = longest_known.groupBy("token").agg(
        F.map_from_entries(F.collect_list(F.struct("start", "piece"))).alias("steps")
    )

    def walk(state, place):
        step = F.try_element_at("steps", place)
        here = state["next"] == place
        moved = F.struct(
            (place + step["chars"]).alias("next"), F.concat(state["ids"], F.array(step["id"])).alias("ids")
        )
        return F.when(here & step.isNotNull(), moved).otherwise(state)

    begin = F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("ids"))
    walked = based.join(steps, "token", "left").withColumn(
        "walked", F.aggregate(F.sequence(F.lit(1), F.length("base")), begin, walk)
    )
    whole = F.col("steps").isNotNull() & (F.col("walked.next") == F.length("base") + 1)
    ids = F.when(whole, F.col("walked.ids")).otherwise(F.array(F.lit(UNK)))
    return walked.select(*words.columns, ids.alias("ids"))

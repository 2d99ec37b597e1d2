"""Encoding a cleaned corpus against a vocabulary."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from corpusloom.functions import encode as fe, wordpiece as fw
from corpusloom.operators.lookup import HOT_TOKENS, lookup
from corpusloom.operators.pieces import split_words
from corpusloom.schemas import CLS, MAX_LENGTH, SEP, UNK
from corpusloom.session import materialise, small_batches

# A vocabulary is broadcast only below both bounds; beyond them the join form takes over.
BROADCAST_TOKENS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
_ROW, _BLOCK = "_row", "_block"
# Rows that share one list of words: 2 to the power of this.
BLOCK_BITS = 10


def broadcast_vocab(
    vocab: DataFrame, max_tokens: int = BROADCAST_TOKENS, max_bytes: int = BROADCAST_BYTES
):
    """A broadcast of (token array, id array), or None if the vocabulary is too large."""
    size = vocab.agg(
        F.count(F.lit(1)).alias("tokens"),
        F.coalesce(F.sum(F.octet_length("token")), F.lit(0)).alias("bytes"),
    ).first()
    if size.tokens > max_tokens or size.bytes > max_bytes:
        return None
    table = vocab.select("token", "id").toArrow().combine_chunks()
    tokens = table.column("token").combine_chunks()
    ids = table.column("id").to_numpy().astype(np.int32)
    return vocab.sparkSession.sparkContext.broadcast((tokens, ids))


def encode(
    df: DataFrame, vocab: DataFrame, max_length: int = MAX_LENGTH, text: str = "text",
    pieces: bool = False, pretrained_words: bool = False, max_tokens: int = BROADCAST_TOKENS,
    keep_text: bool = True,
) -> DataFrame:
    """Add the struct column `encoding` of `input_ids` and `attention_mask`.

    `vocab` is read twice and should be a written table.  `pieces` splits words that are
    not in the vocabulary; `pretrained_words` also sets marks and ideographs apart and
    strips accents, as an uncased pretrained vocabulary expects.  A vocabulary too large
    to broadcast is joined instead, with the same result.  `keep_text` False drops the
    text, which the join form would otherwise shuffle.
    """
    shared = broadcast_vocab(vocab, max_tokens)
    if shared is None:
        if pieces:
            return encode_pieces_by_join(df, vocab, max_length, text, pretrained_words, keep_text=keep_text)
        return encode_by_join(df, vocab, max_length, text, keep_text=keep_text)
    encoded = encode_with(df, shared, max_length, text, pieces, pretrained_words)
    return encoded if keep_text else encoded.drop(text)


def encode_with(
    df: DataFrame, shared, max_length: int = MAX_LENGTH, text: str = "text",
    pieces: bool = False, pretrained_words: bool = False,
) -> DataFrame:
    """`encode` against a vocabulary that `broadcast_vocab` accepted: narrow, order kept.

    The session then hands Python a bounded number of rows at once: what a worker holds is
    the words of those, however many rows a task has.
    """
    small_batches(df.sparkSession)
    column = fw.spread_marks(F.col(text)) if pretrained_words else F.col(text)
    words = fe.leading_words(column, max_length)
    if pieces:
        encoder = fw.piece_encoder(shared, max_length, strip_accents=pretrained_words)
    else:
        encoder = fe.word_encoder(shared, max_length)
    return df.withColumn("encoding", encoder(words))


def _numbered_rows(df: DataFrame) -> DataFrame:
    """The rows written with a number of this run, so that equal keys stay apart."""
    return materialise(df.withColumn(_ROW, F.monotonically_increasing_id()), "texts")


def encode_by_join(
    df: DataFrame, vocab: DataFrame, max_length: int = MAX_LENGTH, text: str = "text",
    hot_tokens: int = HOT_TOKENS, keep_text: bool = True,
) -> DataFrame:
    """The same column for a vocabulary of any size, by joining words to it.

    Rows are dealt into blocks, and each distinct word of a block meets the vocabulary
    once; at most `max_length` - 2 words of a row come together again.
    """
    rows = _numbered_rows(df)
    words = _blocked(rows, F.col(text), max_length)
    found = lookup(_block_tokens(words), "token", F.col(_BLOCK), vocab, "id", hot_tokens).filter("id is not null")
    ids = found.select(_BLOCK, "token", F.array("id").alias("ids"))
    return _assemble(rows if keep_text else rows.drop(text), words, ids, max_length)


def encode_pieces_by_join(
    df: DataFrame, vocab: DataFrame, max_length: int = MAX_LENGTH, text: str = "text",
    pretrained_words: bool = False, hot_tokens: int = HOT_TOKENS, keep_text: bool = True,
) -> DataFrame:
    """Word-piece encoding for a vocabulary of any size.

    The distinct words are split once, by joins; blocks of rows then look their words up.
    """
    rows = _numbered_rows(df)
    column = fw.spread_marks(F.col(text)) if pretrained_words else F.col(text)
    words = _blocked(rows, column, max_length)
    tokens = _block_tokens(words)
    distinct = materialise(tokens.select("token").distinct(), "distinct-words")
    split = materialise(split_words(distinct, vocab, pretrained_words, hot_tokens), "split-words")
    found = lookup(tokens, "token", F.col(_BLOCK), split, "ids", hot_tokens).select(_BLOCK, "token", "ids")
    return _assemble(rows if keep_text else rows.drop(text), words, found, max_length)


def _blocked(rows: DataFrame, text, max_length: int) -> DataFrame:
    """The part of numbered rows' texts that fits, with their block: rows next to each other as written."""
    block = F.shiftright(_ROW, BLOCK_BITS).alias(_BLOCK)
    return rows.select(_ROW, block, F.substring_index(text, " ", max_length - 2).alias("fitting"))


def _block_tokens(words: DataFrame) -> DataFrame:
    """The distinct words of each block, written: far fewer than its words in most texts."""
    tokens = words.filter("fitting <> ''").select(_BLOCK, F.explode(F.split("fitting", " ")).alias("token"))
    return materialise(tokens.distinct(), "block-words")


def _block_encoder(room: int):
    """Arrow function from the rows of a block and the ids of its known words to ids of rows."""

    def whole(table: pa.Table, name: str) -> pa.Array:
        column = table.column(name)
        return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)

    def encode_block(rows: pa.Table, known: pa.Table) -> pa.Table:
        texts, ids = whole(rows, "fitting"), whole(known, "ids")
        # An empty text has no words, not an empty one.
        words = pc.split_pattern(pc.if_else(pc.equal(texts, ""), None, texts), " ")
        # The word after the known ones is the unknown one.
        pool = np.append(ids.flatten().to_numpy(zero_copy_only=False), UNK).astype(np.int32)
        sizes = np.append(fe.row_lengths(ids), 1)
        found = pc.fill_null(pc.index_in(words.flatten(), value_set=whole(known, "token")), len(ids))
        row_ids, lengths = fe.gather_rows(
            found.to_numpy(zero_copy_only=False), fe.row_lengths(words), pool, sizes, room
        )
        ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
        return pa.table({_ROW: rows.column(_ROW), "found_ids": pa.ListArray.from_arrays(ends, pa.array(row_ids))})

    return encode_block


def _assemble(df: DataFrame, words: DataFrame, ids: DataFrame, max_length: int) -> DataFrame:
    """Rows with their encoding, from the id arrays `ids` of the known words of each block."""
    rows = words.groupBy(_BLOCK).cogroup(ids.groupBy(_BLOCK)).applyInArrow(
        _block_encoder(max_length - 2), f"{_ROW} bigint, found_ids array<int>"
    )
    found = F.coalesce(F.col("found_ids"), F.array().cast("array<int>"))
    whole = F.concat(F.array(F.lit(CLS)), found, F.array(F.lit(SEP)))
    encoding = F.struct(
        fe.pad(whole, max_length).alias("input_ids"),
        fe.attention_mask(F.size(whole), max_length).alias("attention_mask"),
    )
    return df.join(rows, _ROW, "left").withColumn("encoding", encoding).drop("found_ids", _ROW)


def encoded_rows(df: DataFrame, *keep: str) -> DataFrame:
    """Struct fields as columns, with the label cast and only the kept columns."""
    return df.select(*keep, F.col("label").cast("int").alias("label"), "encoding.*")

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.wordpiece import split_word
from corpusloom.operators import encode as oe, vocab as ov
from corpusloom.schemas import MAX_LENGTH
from corpusloom.session import BATCH_ROWS, scratch_path

SMALL = [("good", 104, 9), ("film", 105, 5)]
CASES = [
    ("good film", [101, 104, 105, 102, 0, 0, 0, 0], [1, 1, 1, 1, 0, 0, 0, 0]),
    ("good unknownword", [101, 104, 100, 102, 0, 0, 0, 0], [1, 1, 1, 1, 0, 0, 0, 0]),
    ("film " * 5 + "film", [101] + [105] * 6 + [102], [1] * 8),
    ("film " * 8 + "film", [101] + [105] * 6 + [102], [1] * 8),
    ("", [101, 102, 0, 0, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0, 0, 0]),
]


@pytest.mark.parametrize("form", ["broadcast", "join"])
def test_cases(spark, form):
    vocab = spark.createDataFrame(SMALL, "token string, id int, n bigint")
    texts = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "doc_id bigint, text string")
    tokens = oe.BROADCAST_TOKENS if form == "broadcast" else 0
    rows = oe.encode(texts, vocab, 8, max_tokens=tokens).orderBy("doc_id").collect()
    assert [(list(r.encoding.input_ids), list(r.encoding.attention_mask)) for r in rows] == [c[1:] for c in CASES]


def test_python_gets_a_bounded_number_of_rows_at_once(spark):
    """However many rows a task has, and whatever larger number the session allows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    try:
        vocab = spark.createDataFrame(SMALL, "token string, id int, n bigint")
        texts = spark.range(0, 6000, 1, 1).select(F.concat(F.lit("good film "), F.col("id")).alias("text"))
        encoded = oe.encode(texts, vocab, 8)

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

        seen = [r.n for r in texts.mapInArrow(sizes, "n long").collect()]
        assert sum(seen) == 6000 and max(seen) <= BATCH_ROWS
        assert encoded.filter("encoding.input_ids[2] = 105").count() == 6000
        spark.conf.set(name, "500")
        oe.encode(texts, vocab, 8)
        assert spark.conf.get(name) == "500"
    finally:
        spark.conf.set(name, before)


def test_no_rows(spark):
    vocab = spark.createDataFrame(SMALL, "token string, id int, n bigint")
    texts = spark.createDataFrame([], "doc_id bigint, text string")
    assert oe.encode(texts, vocab, 8).count() == 0
    assert oe.encode(texts, vocab, 8, pieces=True).count() == 0


def test_duplicate_rows_stay_apart(spark):
    vocab = spark.createDataFrame(SMALL, "token string, id int, n bigint")
    texts = spark.createDataFrame([(1, "good"), (1, "good")], "doc_id bigint, text string")
    assert oe.encode(texts, vocab, 8).count() == 2


def test_invariants(spark, folder):
    from corpusloom.catalog.queries import _corpus, _vocab

    corpus, vocab = _corpus(spark, folder), _vocab(spark, folder)
    encoded = oe.encode(corpus, vocab, MAX_LENGTH).select("doc_id", "text", "encoding.*")
    real = F.aggregate("attention_mask", F.lit(0), lambda a, m: a + m)
    words = F.least(F.size(F.split("text", " ")), F.lit(MAX_LENGTH - 2))
    bad = encoded.filter(
        (F.size("input_ids") != MAX_LENGTH) | (F.size("attention_mask") != MAX_LENGTH) | (real != words + 2)
    )
    assert bad.count() == 0 and encoded.count() == corpus.count()


def test_join_form_equals_broadcast_form(spark, folder):
    from corpusloom.catalog.queries import _corpus, _vocab

    corpus, vocab = _corpus(spark, folder), _vocab(spark, folder)
    narrow = oe.encode(corpus, vocab, 64).select("doc_id", "encoding")
    joined = oe.encode_by_join(corpus, vocab, 64, hot_tokens=20).select("doc_id", "encoding")
    assert narrow.exceptAll(joined).count() == 0 and joined.exceptAll(narrow).count() == 0


def test_split_word():
    known = {"un", "##aff", "##able", "##ab", "a"}
    assert split_word("unaffable", known) == ["un", "##aff", "##able"]
    assert split_word("a", known) == ["a"]
    assert split_word("unx", known) is None
    assert split_word("a" * 101, known) is None


def test_pretrained_words_match_a_published_tokenizer(spark, folder):
    """Ids over an uncased word-piece vocabulary file, next to an independent library."""
    tokenizers = pytest.importorskip("tokenizers")
    from corpusloom.catalog.queries import _corpus

    texts = [r.text for r in _corpus(spark, folder).collect()]
    texts += ["été snake_case x", "日本語テスト ab", "½ ² ⅷ plus", "한국어 단어", "a" * 120 + " tail words here"]
    # Pieces of the accent-free texts, so that all paths are taken: found, split, unknown.
    from corpusloom.functions.wordpiece import without_accents

    words = sorted({w for t in texts for w in re.findall(r"\w+", without_accents(t))})
    lines = ["[PAD]"] + [f"[unused{i}]" for i in range(99)] + ["[UNK]", "[CLS]", "[SEP]", "[MASK]", "_"]
    lines += words[::3] + sorted({p for w in words for p in (w[:2], w[:1])} - set(words[::3]) - {"_"})
    lines += sorted({"##" + w[i:i + 2] for w in words for i in range(1, min(len(w), 12))})[::2]
    path = scratch_path(spark, "vocab-file")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    vocab = ov.read_vocab_file(spark, path)
    assert {r.token: r.id for r in vocab.collect()} == {token: i for i, token in enumerate(lines)}

    from tokenizers.implementations import BertWordPieceTokenizer

    other = BertWordPieceTokenizer({t: i for i, t in enumerate(lines)}, lowercase=True)
    other.enable_truncation(64)
    other.enable_padding(length=64)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    wanted = [other.encode(text) for text in texts]
    for tokens in (oe.BROADCAST_TOKENS, 0):
        encoded = oe.encode(frame, vocab, 64, pieces=True, pretrained_words=True, max_tokens=tokens)
        rows = encoded.orderBy("doc_id").collect()
        for text, want, row in zip(texts, wanted, rows, strict=True):
            assert list(row.encoding.input_ids) == want.ids, text[:80]
            assert list(row.encoding.attention_mask) == want.attention_mask
    assert tokenizers.__version__


def test_vocabulary_file_in_many_blocks(spark):
    path = scratch_path(spark, "long-vocab")
    tokens = [f"token{i}" for i in range(5000)]
    tokens[17] = ""
    spark.createDataFrame([("\n".join(tokens),)], "value string").coalesce(1).write.text(path)
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        vocab = ov.read_vocab_file(spark, path)
        assert spark.read.text(path).select(F.spark_partition_id()).distinct().count() > 5
        assert {r.token: r.id for r in vocab.collect()} == {t: i for i, t in enumerate(tokens) if t}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)


def test_top_tokens_break_ties_by_token(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3), ("d", 1)], "token string, n bigint")
    got = [(r.token, r.id) for r in ov.top_tokens(counts, 3).orderBy("id").collect()]
    assert got == [("c", 104), ("a", 105), ("b", 106)]


def test_piece_counts(spark):
    counts = spark.createDataFrame([("abc", 2), ("ab", 1)], "token string, n bigint")
    got = {r.token: r.n for r in ov.count_pieces(counts).collect()}
    assert got == {"a": 3, "ab": 3, "abc": 2, "##b": 3, "##bc": 2, "##c": 2}


def test_repeated_keys_keep_their_texts(spark):
    vocab = spark.createDataFrame(SMALL, "token string, id int, n bigint")
    texts = spark.createDataFrame([(1, "good"), (1, "film good"), (None, "film")], "doc_id bigint, text string")
    want = sorted([[101, 104, 102, 0, 0], [101, 105, 104, 102, 0], [101, 105, 102, 0, 0]])
    for tokens in (oe.BROADCAST_TOKENS, 0):
        for pieces in (False, True):
            rows = oe.encode(texts, vocab, 5, pieces=pieces, max_tokens=tokens, keep_text=False)
            assert rows.columns == ["doc_id", "encoding"]
            assert sorted(list(r.encoding.input_ids) for r in rows.collect()) == want


def test_frequent_tokens_are_spread(spark):
    """One frequent word that the vocabulary lacks and one that it has, among rare ones."""
    from corpusloom.operators.lookup import lookup

    rows = spark.range(6000).selectExpr(
        "id", "case when id % 3 = 0 then 'unknown' when id % 3 = 1 then '##e' else concat('rare', id) end as token"
    )
    table = spark.createDataFrame([("##e", 7)], "token string, id_of int")
    found = lookup(rows, "token", F.col("id"), table, "id_of", hot_tokens=2)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 2 * 6000 / len(sizes)
    assert found.filter("id_of = 7").count() == 2000


@pytest.mark.parametrize("pieces", [False, True])
def test_long_batches_are_encoded_in_slices(spark, monkeypatch, pieces):
    """A batch of many rows gives the rows of its parts, and is not gathered whole."""
    import pyarrow as pa

    from corpusloom.functions import encode as fe, wordpiece as fw

    class Shared:
        value = (pa.array(["good", "film", "##s"]), np.array([104, 105, 106], np.int32))

    module, most = (fw if pieces else fe), []
    fill = module.fill_rows
    monkeypatch.setattr(module, "fill_rows", lambda ids, lengths, n: most.append(len(lengths)) or fill(ids, lengths, n))
    cases = [["good", "films"], [], None, ["film"] * 3, ["odd", "good"]]
    encoder = (fw.piece_encoder if pieces else fe.word_encoder)(Shared, 5).func
    batch = pa.array(cases * 400, pa.list_(pa.string()))
    got = [row["input_ids"] for part in encoder(iter([batch, batch.slice(3, 2)])) for row in part.to_pylist()]
    films = [105, 106, 102] if pieces else [100, 102, 0]
    want = [[101, 104, *films], [101, 102, 0, 0, 0], [101, 102, 0, 0, 0], [101, 105, 105, 105, 102], [101, 100, 104, 102, 0]]
    assert got == want * 400 + want[3:]
    assert sum(most) == 2002 and max(most) <= fe.SLICE_ROWS


@pytest.mark.parametrize("pieces", [False, True])
def test_a_word_of_many_rows_meets_the_vocabulary_once_a_block(spark, monkeypatch, pieces):
    met = []
    lookup = oe.lookup
    monkeypatch.setattr(oe, "lookup", lambda rows, *rest: met.append(rows.count()) or lookup(rows, *rest))
    vocab = spark.createDataFrame(SMALL, "token string, id int, n bigint")
    text = F.concat_ws(" ", F.lit("good film"), F.col("id") % 2, F.lit("good"))
    texts = spark.range(0, 2000, 1, 2).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows = oe.encode(texts, vocab, 6, pieces=pieces, max_tokens=0).select("encoding.*").distinct().collect()
    assert [(r.input_ids, r.attention_mask) for r in rows] == [([101, 104, 105, 100, 104, 102], [1] * 6)]
    # Two blocks of four distinct words, not 8,000 words.
    assert met == [8]

"""The preparation of new files as they arrive.

Cleaning, the length filter, the key-hash split and encoding are row-local, so they stream without
state, watermark or shuffle, and give each row the same split as a batch run would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.encode import BROADCAST_TOKENS, broadcast_vocab, encode, encode_with
from corpusloom.plans.prepare import split_rows
from corpusloom.schemas import LABELLED, MAX_LENGTH
from corpusloom.session import path_exists, scratch


def read_arrivals(spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int = 1000) -> DataFrame:
    """Labelled rows from files added to a folder."""
    reader = spark.readStream.schema(LABELLED).format(fmt)
    return reader.option("maxFilesPerTrigger", files_per_trigger).load(path)


def append_arrivals(
    rows: DataFrame, store: str, checkpoint: str, vocab: DataFrame | None = None, max_length: int = MAX_LENGTH,
    pieces: bool = False, max_tokens: int = BROADCAST_TOKENS,
) -> StreamingQuery:
    """Append prepared rows to the store by split; the checkpoint makes each file count once.

    With a vocabulary, a written table, rows are stored encoded: without a shuffle while it
    can be broadcast, else by joins.  Either way a micro-batch is stored whole under its
    own number `batch`, so that a repeated one replaces itself and a store whose vocabulary
    outgrows the bound between two runs goes on in the same layout.  What a batch writes
    in between is deleted when it is stored.
    """
    prepared = split_rows(rows)
    if vocab is not None:
        spark = rows.sparkSession
        if path_exists(spark, f"{store}/_spark_metadata"):
            raise ValueError(f"{store} was written by a file sink, whose log hides other files")
        shared = broadcast_vocab(vocab, max_tokens)

        def store_batch(batch: DataFrame, number: int) -> None:
            with scratch(spark):
                if shared is None:
                    encoded = encode(batch, vocab, max_length, pieces=pieces, max_tokens=max_tokens, keep_text=False)
                else:
                    encoded = encode_with(batch, shared, max_length, pieces=pieces)
                numbered = encoded.select("doc_id", "split", "label", "encoding.*", F.lit(number).alias("batch"))
                writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy("batch", "split").parquet(store)

        return prepared.writeStream.foreachBatch(store_batch).option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start()
    return (
        prepared.writeStream.format("parquet").outputMode("append")
        .partitionBy("split").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(store)
    )

"""Headline timings as one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

`prepare_corpus` takes every document through cleaning, filter, encoding and the split
write; `prepare_2500` is the same work under a cap of 2,500 training rows; `train_2500`
is ten epochs on those rows with both test splits scored after each.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from corpusloom.catalog import queries as catalog
from corpusloom.functions.head import Features
from corpusloom.operators.vocab import build_vocab
from corpusloom.plans.prepare import prepare
from corpusloom.plans.train import fit
from corpusloom.schemas import IN_DOMAIN, OUT_DOMAIN
from corpusloom.session import build_session, materialise, release, scratch_path
from corpusloom.sources import tables

QUERIES = (
    "tag_and_union", "clean_text", "min_length_clean", "build_vocab", "encode_ids", "encode_ids_join",
    "wordpiece_encode", "wordpiece_encode_join", "seeded_shuffle", "split_counts", "sample_cap",
    "partition_balance", "batch_truncate", "gradient_step", "accuracy", "eval_by_dataset", "stream_append",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        result = action()
        took[name] = round(time.perf_counter() - start, 3)
        return result

    def drain(frame):
        frame.write.format("noop").mode("overwrite").save()

    # Start the JVM's code paths and the Python workers outside the timings.
    for name in ("encode_ids", "train_history_text"):
        drain(catalog.QUERIES[name](spark, folder))

    # All documents as a labelled corpus: a language tells the corpus, a hash the label.
    documents = tables.read_texts(spark, folder, "documents")
    labelled = documents.select(
        "doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("label"),
        F.when(F.col("lang") == "en", IN_DOMAIN).otherwise(OUT_DOMAIN).alias("source"),
    )
    vocab = timed("build_vocab_30k", lambda: materialise(build_vocab(catalog._corpus(spark, folder), 30_000), "vocab"))
    whole = scratch_path(spark, "bench-whole")
    timed("prepare_corpus", lambda: prepare(labelled, whole, cpus, vocab=vocab))
    capped = scratch_path(spark, "bench-2500")
    timed("prepare_2500", lambda: prepare(labelled, capped, cpus, vocab=vocab, samples=2500))
    features = Features("input_ids", 1024, hashed=True)
    timed("train_2500", lambda: fit(spark.read.parquet(capped), features, epochs=10, lr=0.01))
    for name in QUERIES:
        timed(name, lambda: drain(catalog.QUERIES[name](spark, folder)))

    rows = documents.count()
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus,
        "prepared_docs_per_sec": round(rows / took["prepare_corpus"], 1),
    }))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()

"""Declared schemas and the fixed values every module shares."""

from __future__ import annotations

from pyspark.sql import types as T

# Corpus tags, split names, encoding ids and defaults.
IN_DOMAIN = "IMDB"
OUT_DOMAIN = "SST-2"
TRAIN, TEST, OUT_TEST = "train", "test", "sst2"
SPLITS = (TRAIN, TEST, OUT_TEST)
TRAIN_FRACTION = 0.8
SEED = 42
MIN_CHARS = 10
MAX_LENGTH = 256
PAD, UNK, CLS, SEP, FIRST_ID = 0, 100, 101, 102, 104
TRAIN_LOSS = "train_losses"
EVAL_LOSS = {TEST: "imdb_eval_losses", OUT_TEST: "sst2_eval_losses"}
EVAL_ACC = {TEST: "imdb_eval_acc", OUT_TEST: "sst2_eval_acc"}

LABELLED = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("source", T.StringType()),
])

ENCODING = "struct<input_ids:array<int>,attention_mask:array<int>>"

WEIGHTS = "run_id string, epoch int, k int, j int, w double"
OPTIMIZER_STATE = "run_id string, epoch int, k int, j int, m double, v double, step bigint"
HISTORY = "run_id string, epoch int, series string, value double"
RUN_METRICS = (
    "run_id string, at timestamp, stage string, cpus int, files int, world int, "
    "samples bigint, shard int, seconds double"
)
MANIFEST = "run_id string, split string, path string, created_at timestamp, rows bigint, request string"

# Declared schemas of the given tables this package reads.
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}

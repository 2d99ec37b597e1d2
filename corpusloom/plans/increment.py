"""Preparation of only what changed since the last run.

Rows fall into buckets by key hash.  A manifest of each run holds a hash per bucket (count
and order-free sum of row hashes) and one over all of them.  A later run compares the two,
prepares the buckets that differ, and leaves the files of all others as they are.

    root/data/run=N/bucket=B/split=S/    encoded rows that run N prepared
    root/manifest/run=N/                 every bucket's hash, and the run that its files are from

Readers go by the newest manifest.  It is one file, so it appears as a whole when a run is done;
until then, and if the run is lost, readers see the run before.  One writer at a time.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.functions.hashing import file_number
from corpusloom.plans.prepare import content_identity, encode_arranged, split_rows
from corpusloom.schemas import MAX_LENGTH
from corpusloom.session import delete_path, list_folders, materialise, path_exists, scratch

MANIFEST = "bucket int, rows bigint, hash string, made int, request string, run int"
# The manifest's row for all buckets together; also there when there are no rows at all.
ROOT = -1
COLUMNS = ("doc_id", "text", "label", "source")


def bucket_hashes(labelled: DataFrame, buckets: int) -> DataFrame:
    """Rows and hash of each bucket that has rows: one pass, added up before the shuffle."""
    return labelled.groupBy(file_number(F.col("doc_id"), buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*COLUMNS).cast("decimal(38,0)")).cast("string").alias("hash"),
    )


def root_hash(leaves: DataFrame) -> str:
    """One hash over the buckets in order; there are as many as the writer chose."""
    leaf = F.concat_ws(":", "bucket", "rows", "hash")
    return leaves.agg(F.md5(F.array_join(F.sort_array(F.collect_list(leaf)), " "))).first()[0]


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The newest run's manifest; no rows before the first run."""
    if not path_exists(spark, f"{root}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    runs = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    newest = runs.agg(F.max("run")).first()[0]
    return runs.filter(F.col("run") == newest)


def prepare_increment(
    labelled: DataFrame, root: str, buckets: int, vocab: DataFrame, max_length: int = MAX_LENGTH,
    pieces: bool = False, pretrained_words: bool = False,
) -> int:
    """Bring the dataset under `root` up to date with `labelled`; the buckets prepared anew.

    The vocabulary is given, so that a bucket depends on its own rows alone; with another
    one, another length or another number of buckets all are prepared anew.  A cap does
    depend on other rows: take it with `prepare`.  Reads the corpus once for the hashes, and
    the rows of changed buckets once more.
    """
    spark = labelled.sparkSession
    request = json.dumps({
        "buckets": buckets, "max_length": max_length, "pieces": pieces, "pretrained_words": pretrained_words,
        "vocab": content_identity(vocab.select("token", "id")),
    }, sort_keys=True)
    with scratch(spark):
        old = read_manifest(spark, root)
        first = old.filter(F.col("bucket") == ROOT).first()
        same_request = first is not None and first.request == request
        number = 1 if first is None else first.run + 1
        leaves = materialise(bucket_hashes(labelled, buckets), "leaves")
        whole = root_hash(leaves)
        if same_request and first.hash == whole:
            return 0
        known = old.filter(F.lit(same_request) & (F.col("bucket") != ROOT)).select("bucket", "rows", "hash", "made")
        joined = leaves.join(known, ["bucket", "rows", "hash"], "left")
        # At most `buckets` rows.
        changed = F.broadcast(joined.filter("made is null").select("bucket"))
        count = changed.count()
        bucket = file_number(F.col("doc_id"), buckets)
        rows = split_rows(labelled.withColumn("bucket", bucket).join(changed, "bucket", "left_semi"))
        encoded = encode_arranged(rows, vocab, buckets, max_length, pieces, pretrained_words)
        out = encoded.select("doc_id", "label", "encoding.*", bucket.alias("bucket"), "split")
        # A run that was lost before its manifest left files under the same number.
        out.write.mode("overwrite").partitionBy("bucket", "split").parquet(f"{root}/data/run={number}")
        top = leaves.agg(F.lit(ROOT).alias("bucket"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).select(
            "bucket", "rows", F.lit(whole).alias("hash"), F.lit(number).alias("made")
        )
        made = F.coalesce("made", F.lit(number)).alias("made")
        all_rows = joined.select("bucket", "rows", "hash", made).unionByName(top)
        all_rows.withColumn("request", F.lit(request)).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/run={number}")
    return count


def read_increment(spark: SparkSession, root: str) -> DataFrame:
    """The current rows, with the `run` that prepared them.

    Folders of replaced buckets are pruned by the join on their partition columns.
    """
    schema = "doc_id bigint, label int, input_ids array<int>, attention_mask array<int>, run int, bucket int, split string"
    data = spark.read.schema(schema).option("basePath", f"{root}/data").parquet(f"{root}/data")
    current = read_manifest(spark, root).select("bucket", F.col("made").alias("run"))
    return data.join(F.broadcast(current), ["run", "bucket"], "left_semi").select(
        "doc_id", "split", "label", "input_ids", "attention_mask", "bucket", "run"
    )


def drop_replaced(spark: SparkSession, root: str) -> int:
    """Delete the folders of buckets that later runs replaced, and older manifests.

    For when no reader goes by an older manifest any more.
    """
    current = {(r.made, r.bucket) for r in read_manifest(spark, root).select("made", "bucket").collect()}
    newest = read_manifest(spark, root).select("run").first().run
    gone = [p for p in list_folders(spark, f"{root}/data/run=*/bucket=*") if _numbers(p) not in current]
    gone += [p for p in list_folders(spark, f"{root}/manifest/run=*") if int(p.rsplit("=", 1)[1]) != newest]
    for path in gone:
        delete_path(spark, path)
    return len(gone)


def _numbers(path: str) -> tuple[int, int]:
    run, bucket = path.split("/")[-2:]
    return int(run.removeprefix("run=")), int(bucket.removeprefix("bucket="))

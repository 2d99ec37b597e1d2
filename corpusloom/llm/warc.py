"""WARC archives of pages and a two-level capture index over them.

Records are written as text files whose rows end in the blank lines that end a WARC record,
so any file system that Spark writes to holds valid, uncompressed archives.  The index sorts
captures by reversed host and cuts them into compressed blocks; a sparse directory has the
first key of each block.  A lookup searches the directory, then the block, and reads the
range of the archive that the entry names.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.frames import by_key, few, groups, scan_groups
from corpusloom.session import materialise, parallelism, scratch_path

VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Bytes of an archive file that the writer aims at, and index entries in a block.
ARCHIVE_BYTES = 16 << 20
BLOCK_ENTRIES = 1000
DATE = "1970-01-01T00:00:00Z"

_FIELD = re.compile(rb"^([^:\r\n]+):[ \t]*(.*?)\r?$", re.M)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def sort_key(url: str | None) -> str:
    """The URL with its host reversed, lower-cased, without scheme, port and fragment.

    What is no URL is its own key; a null is empty.  A leading `www.` goes.
    """
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = parts.hostname or ""
    except ValueError:
        return url
    if not host:
        return url
    names = host.lower().split(".")
    if names[0] == "www" and len(names) > 2:
        names = names[1:]
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(names)) + ")" + path


def _base32_sha1(column):
    """Bare base32 of SHA-1: groups of twenty bits, four letters each."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    hexed = F.sha1(column)
    out = []
    for group in range(8):
        number = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1
            out.append(F.substring(F.lit(letters), place, F.lit(1)))
    return F.concat(*out)


def _clean(url):
    """A header value on one line."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x1F\x7F]", " ")


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """One WARC record per page under `path`, payload the html in UTF-8, null as empty.

    Of records with equal payloads of at least `least_bytes` the one with the largest
    `page_id` is a response, the others revisit it and have no payload of their own; a
    null id is a response.  Payloads are equal if size and SHA-1 are.  Files hold about
    `archive_bytes`; pages stay in their partitions, so only digests are shuffled.
    """
    body = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id", "url", body.alias("html"), F.octet_length(body).cast("long").alias("payload_bytes"),
        _base32_sha1(body).alias("payload_digest"),
    )
    sums = materialise(rows.drop("url", "html"), "digests")
    shared = sums.filter(F.col("page_id").isNotNull() & (F.col("payload_bytes") >= least_bytes))
    key = ["payload_digest", "payload_bytes"]
    largest = shared.groupBy(*key).agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).filter(
        "refers_to <> least"
    ).drop("least")
    # Pages with a copy elsewhere are few, so they are mostly broadcast.
    largest = materialise(largest, "responses")
    revisits = materialise(
        shared.join(F.broadcast(largest) if few(largest) else largest, key)
        .filter("page_id < refers_to").select("page_id", *key, "refers_to").distinct(), "revisits"
    )
    side = F.broadcast(revisits) if few(revisits, 100_000) else revisits
    joined = rows.join(side, ["page_id", *key], "left")
    named = F.col("page_id").cast("string")
    head = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(named, F.lit("")),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), _clean(F.col("url")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes").cast("string"),
        F.when(F.col("refers_to").isNull(), F.lit("")).otherwise(F.concat(
            F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")
        )),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(F.col("refers_to").isNull(), F.col("payload_bytes")).otherwise(F.lit(0)).cast("string"), F.lit(END),
    )
    record = F.concat(head, F.when(F.col("refers_to").isNull(), F.col("html")).otherwise(F.lit("")))
    mean = sums.agg(F.avg("payload_bytes")).first()[0] or 0
    per_file = max(1, int(archive_bytes // (mean + 400)))
    writer = joined.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", per_file)
    writer.text(path)


def parse_header(head: bytes) -> dict[str, str]:
    return {k.decode().lower(): v.decode("utf-8", "replace") for k, v in _FIELD.findall(head)}


def read_record(content: bytes, at: int) -> tuple[dict[str, str], int, int]:
    """Header of the record at a byte, and where its payload starts and ends."""
    if not content.startswith(b"WARC/", at):
        raise ValueError(f"no WARC record at byte {at}")
    start = content.index(b"\r\n\r\n", at) + 4
    head = parse_header(content[at:start])
    return head, start, start + int(head["content-length"])


def archive_files(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(
        F.col("path").alias("file"), "content"
    )


ENTRY = "key string, id string, file string, offset long, length long"


def capture_entries(spark, path: str) -> DataFrame:
    """`(key, id, file, offset, length)` of each record, by reading the archives through."""
    schema = pa.schema([
        ("key", pa.string()), ("id", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for file, content in zip(*batch.columns):
                    name, raw, at = file.as_py(), content.as_py(), 0
                    while at < len(raw):
                        head, _, end = read_record(raw, at)
                        yield {
                            "key": sort_key(head.get("warc-target-uri")), "id": head["warc-record-id"],
                            "file": name, "offset": at, "length": end + 4 - at,
                        }
                        at = end + 4

        yield from scan_groups(schema, rows())

    return archive_files(spark, path).mapInArrow(walk, ENTRY)


def write_index(entries: DataFrame, path: str, block_entries: int = BLOCK_ENTRIES) -> None:
    """Blocks of entries in order of (key, id): `first_key`, `first_id` and the packed lines.

    Ids take part in the order, so captures of one URL may fill many blocks and ranges.
    """
    parts = parallelism(entries.sparkSession)
    ordered = entries.repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[tuple] = []

        def block():
            text = "\n".join("\t".join(map(str, line)) for line in lines)
            return pa.RecordBatch.from_pylist([{
                "first_key": lines[0][0], "first_id": lines[0][1], "entries": len(lines),
                "packed": zlib.compress(text.encode("utf-8", "surrogatepass")),
            }], pa.schema([
                ("first_key", pa.string()), ("first_id", pa.string()), ("entries", pa.int64()), ("packed", pa.binary()),
            ]))

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                lines.append(line)
                if len(lines) == block_entries:
                    yield block()
                    lines = []
        if lines:
            yield block()

    ordered.mapInArrow(pack, "first_key string, first_id string, entries long, packed binary").write.parquet(path)


# Directory entries that are broadcast: one per block, so this bounds a lookup's tables to
# 100 MB; a larger directory is searched in parts.
DIRECTORY_ROWS = 500_000


def find_captures(index: DataFrame, wanted: DataFrame, every: bool = False) -> DataFrame:
    """`wanted` `(key, id)` with `file`, `offset` and `length`; unknown ones are left out,
    repeated ones stay and are each the first capture of their key and id.

    With `every`, all captures of each different key and id, once: records that share both
    may stand in several blocks, from the one before the first that begins with them on.

    The block of a capture is found by binary search in the directory, the entry by binary
    search in the block.  The directory is searched a part at a time, so its size in a
    task is bounded; only blocks that are asked for are unpacked.
    """
    directory = index.select("first_key", "first_id")
    spark = wanted.sparkSession
    wanted = wanted.select("key", "id").distinct() if every else wanted
    rows = directory.count()
    parts = max(1, -(-rows // DIRECTORY_ROWS))
    cuts: list = []
    if parts > 1:
        ordered = directory.repartitionByRange(parts, "first_key", "first_id").sortWithinPartitions("first_key", "first_id")
        ordered = materialise(ordered.withColumn("part", F.spark_partition_id()), "directory")
        cuts = [ordered.filter(F.col("part") == k).drop("part") for k in range(parts)]
    else:
        cuts = [directory]
    located = None
    for number, part in enumerate(cuts):
        firsts = sorted((r.first_key, r.first_id) for r in part.collect())
        shared = spark.sparkContext.broadcast(firsts)

        def locate(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            order = shared.value
            for batch in batches:
                row, firsts = [], []
                for number, pair in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                    last = bisect.bisect_right(order, pair) - 1
                    # Blocks that begin alike have one number, so each is named once.
                    low = max(bisect.bisect_left(order, pair) - 1, 0) if every else last
                    named = dict.fromkeys(order[low : last + 1]) if last >= 0 else ()
                    firsts += named
                    row += [number] * len(named)
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at), batch.column(1).take(at), pa.array([f[0] for f in firsts], pa.string()),
                        pa.array([f[1] for f in firsts], pa.string()),
                    ],
                    ["key", "id", "first_key", "first_id"],
                )

        schema = "key string, id string, first_key string, first_id string"
        found = wanted.select("key", "id").mapInArrow(locate, schema)
        found = found.withColumn("part", F.lit(number))
        located = found if located is None else located.unionByName(found)
    if every:
        # A part of the directory can name a block that holds nothing of what it is asked.
        located = located.drop("part")
    elif parts > 1:  # of the blocks that each part names, the last one holds the capture
        # A part that names a block does so for every copy of a row, so it counts the copies.
        counted = located.groupBy("key", "id", "part").agg(
            F.max(F.struct("first_key", "first_id")).alias("f"), F.count(F.lit(1)).alias("n")
        ).groupBy("key", "id").agg(F.max("f").alias("f"), F.max("n").alias("n"))
        located = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).select("key", "id", "f.*")
    # Blocks and what is asked of them meet by block; a block has a bounded number of entries.
    block = F.xxhash64("first_key", "first_id").alias("block")
    asked = located.select(block, "key", "id", F.lit(None).cast("binary").alias("packed"))
    blocks = index.select(block, F.lit("").alias("key"), F.lit("").alias("id"), "packed")
    schema = pa.schema([
        ("key", pa.string()), ("id", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            number, held = None, []
            for batch in batches:
                for b, _, key, name, packed in zip(*(c.to_pylist() for c in batch.columns)):
                    if packed is not None:
                        lines = [x.split("\t") for x in zlib.decompress(packed).decode("utf-8", "surrogatepass").split("\n")]
                        # Blocks that begin with the same capture share a number.
                        held = [*(held if b == number else ()), ([(x[0], x[1]) for x in lines], lines)]
                        number = b
                        continue
                    for keys, lines in held if b == number else ():
                        low = bisect.bisect_left(keys, (key, name))
                        high = bisect.bisect_right(keys, (key, name))
                        for _, _, file, offset, length in lines[low : high if every else min(low + 1, high)]:
                            yield {"key": key, "id": name, "file": file, "offset": int(offset), "length": int(length)}
                        if low < high and not every:
                            break

        yield from scan_groups(schema, rows())

    together = blocks.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1)))
    placed = by_key(together.select("block", "kind", "key", "id", "packed"), "block", then=("kind",))
    return placed.mapInArrow(search, ENTRY)


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"


def read_captures(spark, path: str, captures: DataFrame, payloads: bool = True) -> DataFrame:
    """The records at the ranges that `captures` name, digests recomputed where there is a payload."""
    files = archive_files(spark, path)
    # A file's ranges are bounded by the records of one archive; archives stay in place
    # while the ranges are few enough to broadcast.
    ranges = materialise(
        captures.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("ranges"), F.count(F.lit(1)).alias("n")),
        "ranges",
    )
    total = ranges.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = ranges.drop("n")
    wanted = files.join(F.broadcast(ranges) if total <= 1_000_000 else ranges, "file")
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string()),
    ])

    def number(text: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
        return int(found[1]) if found else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for content, spans in zip(batch.column(1), batch.column(2)):
                    raw = memoryview(content.as_buffer())
                    for span in spans.as_py():
                        part = bytes(raw[span["offset"] : span["offset"] + span["length"]])
                        head, start, end = read_record(part, 0)
                        kind, body = head["warc-type"], part[start:end]
                        told = head["warc-payload-digest"].removeprefix("sha1:")
                        size = int(head["x-payload-length"])
                        if kind == "response" and (digest(body) != told or len(body) != size):
                            raise ValueError(f"damaged record {head['warc-record-id']}")
                        yield {
                            "page_id": number(head["warc-record-id"]), "url": head["warc-target-uri"],
                            "payload_bytes": size, "payload_digest": told, "record_type": kind,
                            "refers_to": number(head.get("warc-refers-to")),
                            "payload": body.decode("utf-8", "surrogatepass") if payloads and kind == "response" else None,
                        }

        yield from scan_groups(schema, rows(), 512)

    return wanted.select("file", "content", "ranges").mapInArrow(read, RECORD)


def archive_and_read(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages written as archives, indexed, looked up by the index and read back.

    Per page: `page_id, payload_bytes, payload_digest, record_type, refers_to`.  A null URL
    is empty.  Rows of equal id and URL are looked up once and give all of their records.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, f"{path}/archives", least_bytes)
    entries = materialise(capture_entries(spark, f"{path}/archives"), "captures")
    write_index(entries, f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    found = find_captures(index, _wanted(pages), every=True)
    return read_captures(spark, f"{path}/archives", found, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def _wanted(pages: DataFrame) -> DataFrame:
    """The index keys of pages."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [sort_key(re.sub(r"[\x00-\x1f\x7f]", " ", u or "")) for u in batch.column(1).to_pylist()]
            names = [f"<urn:page:{'' if p is None else p}>" for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(names, pa.string())], ["key", "id"])

    return pages.select("page_id", "url").mapInArrow(make, "key string, id string")

"""Repeated passages: paragraph MinHash banding with exact confirmation.

A paragraph here is a stretch of a line between cuts that the text itself sets, so a passage
pasted into other text is cut like its source.  Each band is one minwise shingle; at the
threshold of 0.8 three bands miss 0.8 in a hundred pairs.  Paragraphs that collide in a band
are confirmed on their full shingle sets, links are closed to clusters, and the first
paragraph of a cluster stays.  Equal passages are found by short pieces too, cut where a
word pair has the least hash around, so that neither lines nor marks matter.  Matches that
touch are one stretch, and the matches at a stretch's rims are extended word by word to
their whole equal runs; a rim at the end of its text has nothing to be extended by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.llm.frames import by_key, groups, scan_groups
from corpusloom.llm.graph import components
from corpusloom.llm.near_dup import GROUP, linked
from corpusloom.llm.text import SOLID, blocks, buffers, mix, numbers, words
from corpusloom.session import materialise, parallelism, scratch

SHINGLE, PERCENT = 5, 80
BANDS = 3
# Shorter paragraphs are not compared, and shorter repeated stretches not reported.
MIN_WORDS, MIN_RUN = 8, 20
# Of the places where a sentence starts or ends every second is a cut, of all others one in 64.
_SENTENCE_CUT, _WORD_CUT = np.uint64(2), np.uint64(64)
# A piece starts where a word pair has the least hash among this many on either side, and
# this many words after the last start if there is none.  Equal runs are followed so far
# beyond a match: more than a piece, its lengthening and what lies around its cuts.
AROUND, LONGEST, FOLLOWED = 4, 32, 48
# Matches that end so many words before a rim, or fewer, can have a run that goes beyond it.
RIM = 12
_SEEDS = numbers(BANDS, 909) | np.uint64(1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

_MATCH = ["doc_id", "start", "length", "first", "last", "total", "cluster", "kept"]
UNIT = "doc_id long, unit int, start long, length long, first int, last int, total int, k1 long, k2 long, mins array<long>"


def cuts(low: np.ndarray, raw: np.ndarray, s: np.ndarray, e: np.ndarray, h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Marks the words that a paragraph starts with."""
    n = len(s)
    start = np.zeros(n, dtype=bool)
    if not n:
        return start
    start[bounds[:-1][bounds[:-1] < n]] = True
    lines = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum((raw == 0x0A) | (raw == 0x0D), out=lines[1:])
    start[1:] |= lines[s[1:]] > lines[s[:-1]]
    # Capitals of ASCII and of the two-byte letters; a run of capitals starts one sentence.
    capital = raw[s] != low[s]
    wide = (raw[s] == 0xC3) & (s + 1 < len(raw))
    capital |= wide & (raw[np.minimum(s + 1, len(raw) - 1)] < 0x9F)
    opens = capital.copy()
    opens[1:] &= ~capital[:-1]
    ends = np.zeros(n, dtype=bool)
    ends[1:] = raw[e[:-1] - 1] == 0x2E
    before = np.zeros(n, dtype=np.uint64)
    before[1:] = h[:-1]
    chosen = np.uint64(0)
    start |= opens & (mix(h) % _SENTENCE_CUT == chosen)
    start |= ends & (mix(before) % _SENTENCE_CUT == chosen)
    start |= mix(h + _FACTOR) % _WORD_CUT == chosen
    return start


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def units(data: np.ndarray, off: np.ndarray, shingle: int, least: int, bands: int = BANDS):
    """Paragraphs of at least `least` words in a block of texts.

    Row, number in the row, first and last byte, first word and the one after the last, two
    64-bit sums that identify the shingle set, the minwise shingle of each band, the sorted
    shingles with bounds, and the words of each row.
    """
    low, s, e, h, bounds = words(data, off, SOLID)
    first = np.flatnonzero(cuts(low, data, s, e, h, bounds))
    count = np.diff(np.append(first, len(s)))
    row = np.searchsorted(bounds, first, "right") - 1
    number = np.arange(len(first)) - np.searchsorted(row, row)
    keep = count >= max(least, shingle)
    first, count, row, number = first[keep], count[keep], row[keep], number[keep]
    empty = np.zeros(0, np.uint64)
    if not len(first):
        none = np.zeros((0, bands), np.uint64)
        return row, number, first, first, first, first, empty, empty, none, empty, np.zeros(1, np.int64), np.diff(bounds)
    rolled = h[: len(h) - shingle + 1].copy()
    for k in range(1, shingle):
        rolled = rolled * _FACTOR + h[k : len(h) - shingle + 1 + k]
    rolled = mix(rolled)
    size = count - shingle + 1
    owner = np.repeat(np.arange(len(first)), size)
    at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    value = rolled[at]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.r_[True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]
    owner, value = owner[new], value[new]
    starts = np.searchsorted(owner, np.arange(len(first)))
    k1 = np.add.reduceat(mix(value + np.uint64(1)), starts)
    k2 = np.add.reduceat(mix(value ^ _FACTOR), starts)
    mins = np.stack([np.minimum.reduceat(mix(value * seed), starts) for seed in _SEEDS[:bands]], axis=1)
    inside = first - bounds[row]
    return (
        row, number, s[first], e[first + count - 1], inside, inside + count, k1, k2, mins, value,
        np.append(starts, len(value)), np.diff(bounds),
    )


def paragraph_rows(documents: DataFrame, shingle: int = SHINGLE, least: int = MIN_WORDS) -> DataFrame:
    """One row per paragraph; `start` and `length` count code points."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(1))
            for a, b in blocks(off):
                part, raw = off[a : b + 1] - off[a], data[off[a] : off[b]]
                row, number, x, y, first, last, k1, k2, mins, _, _, total = units(raw, part, shingle, least)
                lead = np.zeros(len(raw) + 1, dtype=np.int64)
                np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
                flat = pa.array(_signed(np.ascontiguousarray(mins)).reshape(-1))
                edges = pa.array(np.arange(len(row) + 1, dtype=np.int32) * BANDS)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(a + row)), pa.array(number.astype(np.int32)),
                        pa.array(lead[x] - lead[part[row]]), pa.array(lead[y] - lead[x]),
                        *(pa.array(c.astype(np.int32)) for c in (first, last, total[row])),
                        pa.array(_signed(k1)), pa.array(_signed(k2)),
                        pa.ListArray.from_arrays(edges, flat),
                    ],
                    ["doc_id", "unit", "start", "length", "first", "last", "total", "k1", "k2", "mins"],
                )

    return documents.select("doc_id", "text").mapInArrow(cut, UNIT)


def _full_sets(documents: DataFrame, wanted: DataFrame, shingle: int, least: int) -> DataFrame:
    """`(k1, k2, members)` once for each wanted paragraph, recomputed from its texts."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(1))
            for a, b in blocks(off):
                part, raw = off[a : b + 1] - off[a], data[off[a] : off[b]]
                row, number, _, _, _, _, k1, k2, _, value, bounds, _ = units(raw, part, shingle, least)
                asked = [set(u) for u in batch.column(2).slice(a, b - a).to_pylist()]
                pick = [k for k, (r, n) in enumerate(zip(row.tolist(), number.tolist())) if n in asked[r]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_signed(k1[pick])), pa.array(_signed(k2[pick])),
                        pa.array([value[bounds[k] : bounds[k + 1]].tobytes() for k in pick], pa.binary()),
                    ],
                    ["k1", "k2", "members"],
                )

    docs = wanted.groupBy("doc_id").agg(F.collect_set("unit").alias("units"))
    docs = materialise(docs, "wanted")
    # The texts are shuffled once, at every size: wanted documents grow with the corpus.
    texts = documents.select("doc_id", "text").join(docs.hint("shuffle_hash"), "doc_id")
    return texts.mapInArrow(build, "k1 long, k2 long, members binary").dropDuplicates(["k1", "k2"])


def _confirm(rows: DataFrame, percent: int) -> DataFrame:
    """Links between the sets of each task, by the exact Jaccard similarity."""
    schema = pa.schema([("a1", pa.int64()), ("a2", pa.int64()), ("b1", pa.int64()), ("b2", pa.int64())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links():
            for table in groups(batches, "task"):
                if table.num_rows < 2:
                    continue
                one, two = table.column("k1").to_pylist(), table.column("k2").to_pylist()
                sets = [np.frombuffer(m, np.uint64) for m in table.column("members").to_pylist()]
                asked = np.flatnonzero(table.column("asked").to_numpy(zero_copy_only=False))
                for a, b in linked(sets, asked, percent):
                    yield {"a1": one[a], "a2": two[a], "b1": one[b], "b2": two[b]}

        yield from scan_groups(schema, links())

    return by_key(rows, "task", then=("k1", "k2")).mapInArrow(check, "a1 long, a2 long, b1 long, b2 long")


def _join(one: str, two: str):
    """Both sums as one string key."""
    return F.concat_ws(":", one, two)


def _part(key: str, at: int):
    return F.split(F.col(key), ":")[at].cast("long")


def _held(keys: DataFrame) -> DataFrame:
    """A side with one row a key, to be joined to a much longer one: a task holds its share of the keys and the
    long side is not sorted."""
    return keys.hint("shuffle_hash")


def candidate_buckets(paragraphs: DataFrame) -> DataFrame:
    """`(k1, k2, bucket)` of the band buckets with more than one shingle set.

    Copies of a paragraph are added up before they are shuffled.  Where rows of a frequent
    one are joined, here and below, the adaptive plan splits its partition: the other side
    has one row a key, and copying all of those to every salt would cost more than the rows.
    """
    bands = F.array(*[F.xxhash64(F.lit(b), F.col("mins")[b]) for b in range(BANDS)])
    rows = paragraphs.select("k1", "k2", F.explode(bands).alias("bucket"))
    mixed = rows.groupBy("bucket").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).filter(
        "low <> high"
    ).select("bucket")
    return rows.join(_held(materialise(mixed, "buckets")), "bucket").distinct()


def cluster_paragraphs(
    documents: DataFrame, members: DataFrame, places: DataFrame, shingle: int, percent: int, least: int
) -> DataFrame:
    """`(k1, k2, c1, c2)`: the cluster of each distinct paragraph that is like another one.

    `members` are the sets of the candidate buckets, `places` has the first document of each
    and a number there.  The sets of a bucket are counted in tasks of about `GROUP`, every pair
    of parts of a larger bucket in its own, so no candidate is left out.
    """
    wanted = places.join(members.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi").select("doc_id", "unit")
    sets = materialise(_full_sets(documents, wanted, shingle, least), "sets")

    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    sized = members.join(sizes, "bucket")
    half = GROUP // 2
    parts = F.ceil(F.col("n") / half).cast("int")
    cut = sized.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("k1", "k2"), F.col("parts")).cast("int"))
    # A set is in a task with each part of its bucket; alone if the bucket is small.
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    paired = cut.withColumn("other", F.when(F.col("n") <= GROUP, F.lit(0)).otherwise(F.lit(-1)))
    small = paired.filter("other = 0").select("k1", "k2", F.xxhash64("bucket").alias("task"))
    large = paired.filter("other = -1").withColumn("other", other).select(
        "k1", "k2", F.xxhash64("bucket", F.least("part", "other"), F.greatest("part", "other")).alias("task")
    )
    tasks = small.unionByName(large).distinct()
    rows = tasks.join(sets, ["k1", "k2"]).withColumn("asked", F.lit(True))
    found = components(_confirm(rows, percent).select(_join("a1", "a2").alias("a"), _join("b1", "b2").alias("b")))
    return found.select(
        _part("id", 0).alias("k1"), _part("id", 1).alias("k2"), _part("root", 0).alias("c1"), _part("root", 1).alias("c2")
    )


def repeated_paragraphs(
    documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, least: int = MIN_WORDS
) -> DataFrame:
    """Paragraphs that occur more than once, with `cluster` and `kept`.

    `kept` marks the first of a cluster, by document id and place.  Null ids and texts
    without words have no rows.
    """
    paragraphs = materialise(paragraph_rows(documents.filter("doc_id is not null"), shingle, least), "paragraphs")
    members = materialise(candidate_buckets(paragraphs), "members")
    # One pass over the paragraphs for what occurs twice and where candidates stand first.
    ones = members.select("k1", "k2").distinct().withColumn("candidate", F.lit(True))
    # Any place in the first document does: all paragraphs with these sums have the same set.
    counted = paragraphs.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id"), F.min_by("unit", "doc_id").alias("unit")
    )
    needed = materialise(counted.join(_held(ones), ["k1", "k2"], "left").filter("n > 1 or candidate"), "needed")
    near = materialise(
        cluster_paragraphs(documents, members, needed.filter("candidate"), shingle, percent, least), "clusters"
    )
    repeated = materialise(
        needed.filter("n > 1").select("k1", "k2").join(near, ["k1", "k2"], "full").select(
            F.xxhash64("k1", "k2").alias("_key"), F.coalesce("c1", "k1").alias("c1"), F.coalesce("c2", "k2").alias("c2")
        ).dropDuplicates(["_key"]),
        "repeated",
    )
    slim = paragraphs.withColumn("_key", F.xxhash64("k1", "k2")).drop("mins", "k1", "k2")
    found = materialise(slim.join(_held(repeated), "_key").drop("_key"), "found")
    first = found.groupBy("c1", "c2").agg(F.min(F.struct("doc_id", "unit")).alias("leader"))
    keyed = found.withColumn("_c", F.xxhash64("c1", "c2"))
    firsts = first.select(F.xxhash64("c1", "c2").alias("_c"), "leader").dropDuplicates(["_c"])
    return keyed.join(_held(firsts), "_c").select(
        "doc_id", "unit", "start", "length", "first", "last", "total", (F.col("last") - F.col("first")).alias("n_words"),
        F.col("_c").alias("cluster"),
        (F.struct("doc_id", "unit") == F.col("leader")).alias("kept"),
    )


def pieces(data: np.ndarray, off: np.ndarray, least: int):
    """Overlapping pieces of at least `least` words: first and last word, hash, row; the words.

    Each piece runs from a cut to the first cut `least` words on, so it depends on the words
    in and next to it alone.  Shorter ones are only left at the end of a text.
    """
    _, s, e, h, bounds = words(data, off, SOLID)
    n = len(s)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    pair = h * _FACTOR
    pair[:-1] += np.where(row[1:] == row[:-1], h[1:], np.uint64(0))
    pair = mix(pair)
    start = np.ones(n, dtype=bool)
    for d in range(1, min(AROUND, n - 1) + 1):
        same = row[d:] == row[:-d]
        start[d:] &= ~same | (pair[d:] < pair[:-d])
        start[:-d] &= ~same | (pair[:-d] <= pair[d:])
    start[bounds[:-1][bounds[:-1] < n]] = True
    first = np.flatnonzero(start)
    gap = np.diff(np.append(first, n))
    more = (gap - 1) // LONGEST
    if more.any():
        rank = np.arange((more + 1).sum()) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
        first = np.repeat(first, more + 1) + rank * LONGEST
    last = np.append(first, n)[np.searchsorted(first, first + least)]
    last = np.minimum(last, bounds[1:][row[first]] if n else last)
    keep = last - first >= least
    first, last = first[keep], last[keep]
    key = np.zeros(len(first), np.uint64)
    for k in range(int((last - first).max()) if len(first) else 0):
        inside = first + k < last
        key[inside] = key[inside] * _FACTOR + h[first[inside] + k]
    return first, last, mix(key + (last - first).astype(np.uint64)), row[first], s, e, h, bounds


def piece_rows(documents: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """Every piece: its place in code points, its first word and the one after its last, the
    words of its text, and its key."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(1))
            for a, b in blocks(off):
                part, raw = off[a : b + 1] - off[a], data[off[a] : off[b]]
                first, last, key, row, s, e, _, bounds = pieces(raw, part, least)
                lead = np.zeros(len(raw) + 1, dtype=np.int64)
                np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
                x, y = s[first], e[last - 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(a + row)), pa.array(lead[x] - lead[part[row]]),
                        pa.array(lead[y] - lead[x]),
                        *(pa.array(c.astype(np.int32)) for c in (first - bounds[row], last - bounds[row], np.diff(bounds)[row])),
                        pa.array(_signed(key)),
                    ],
                    ["doc_id", "start", "length", "first", "last", "total", "key"],
                )

    schema = "doc_id long, start long, length long, first int, last int, total int, key long"
    return documents.select("doc_id", "text").mapInArrow(cut, schema)


def repeated_pieces(documents: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """Pieces that occur more than once, with `cluster` and `kept` as for paragraphs."""
    rows = materialise(piece_rows(documents.filter("doc_id is not null"), least), "pieces")
    counted = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "start")).alias("leader")
    )
    repeated = materialise(counted.filter("n > 1").drop("n"), "repeated_pieces")
    return rows.join(_held(repeated), "key").select(
        *_MATCH[:-2], F.col("key").alias("cluster"), (F.struct("doc_id", "start") == F.col("leader")).alias("kept"),
    )


_PLACE = "doc_id long, first int, last int, start long, length long, cluster long, kept boolean"
_PLACES = [x.split()[0] for x in _PLACE.split(", ")]
# Sides that are looked up at once.
_SIDES = 8192


def rim_matches(found: DataFrame) -> DataFrame:
    """Sides of matches that are to be looked at: `side` 0 before, 1 after, and `asked`.

    Asked are the matches near a rim of their stretch that has words beyond it; beside
    them stand the other members of their clusters, which they are compared with.
    """
    of_doc = Window.partitionBy("doc_id").orderBy("first", "last", "cluster", "kept", "start")
    reached = F.max("last").over(of_doc.rowsBetween(Window.unboundedPreceding, -1))
    broken = F.coalesce(F.col("first") > reached, F.lit(True)).cast("int")
    chained = found.withColumn("broken", broken).withColumn("stretch", F.sum("broken").over(of_doc))
    whole = Window.partitionBy("doc_id", "stretch")
    ends = chained.withColumn("low", F.min("first").over(whole)).withColumn("high", F.max("last").over(whole))
    before, after = F.col("first") > 0, F.col("last") < F.col("total")
    asks = (
        before & (F.col("low") > 0) & (F.col("first") - F.col("low") < RIM),
        after & (F.col("high") < F.col("total")) & (F.col("high") - F.col("last") < RIM),
    )
    flags = [c.alias(f"{name}{k}") for name, both in (("has", (before, after)), ("ask", asks)) for k, c in enumerate(both)]
    # A row a match is shuffled, whatever its sides; they part after the join.
    rows = materialise(ends.filter(before | after).select(*_PLACES, *flags), "rims")
    wanted = rows.filter("ask0 or ask1").groupBy("cluster").agg(*[F.max(f"ask{k}").alias(f"wanted{k}") for k in (0, 1)])
    sides = F.array(*[
        F.when(F.col(f"has{k}") & F.col(f"wanted{k}"), F.struct(F.lit(k).alias("side"), F.col(f"ask{k}").alias("asked")))
        for k in (0, 1)
    ])
    one = F.explode(F.filter(sides, lambda x: x.isNotNull()))
    return rows.join(_held(materialise(wanted, "wanted_rims")), "cluster").select(*_PLACES, one.alias("one")).select(*_PLACES, "one.*")


def _surroundings(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """Sides, in one array per document, with the hashes of up to `FOLLOWED` words beyond them, those before backwards;
    asked ones also with how many code points the words take."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(1))
            listed = batch.column(2)
            upto = np.append(0, np.cumsum(pc.list_value_length(listed).to_numpy()))
            every = listed.flatten()
            for a, b in blocks(off):
                part, raw = off[a : b + 1] - off[a], data[off[a] : off[b]]
                _, s, e, h, bounds = words(raw, part, SOLID)
                lead = np.zeros(len(raw) + 1, dtype=np.int64)
                np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
                begin, end, short = lead[s], lead[e], (h >> np.uint64(32)).astype(">u4")
                owner = np.repeat(np.arange(a, b), np.diff(upto[a : b + 1]))
                for k in range(upto[a], upto[b], _SIDES):
                    size = min(_SIDES, upto[b] - k)
                    row = owner[k - upto[a] :][:size]
                    sides = pa.RecordBatch.from_struct_array(every.slice(k, size))
                    yield _beyond(batch.column(0).take(pa.array(row)), sides, row - a, begin, end, short, bounds, lead[part])

    # Texts of documents without such a side stay where they are; the others move once.
    texts = documents.select("doc_id", "text").join(spans.hint("shuffle_hash"), "doc_id")
    return texts.mapInArrow(look, f"{_PLACE}, side int, asked boolean, words binary, reach binary")


def _binary(values: np.ndarray, count: np.ndarray) -> pa.Array:
    """Rows of `count` values of four bytes each."""
    edges = np.append(0, np.cumsum(count * 4)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(edges), pa.py_buffer(values.tobytes())])


def _planes(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The bytes of `_binary` with those of equal weight next to each other in a row: small numbers then pack well."""
    start = np.cumsum(count) - count
    place = np.repeat(3 * start, count) + np.arange(len(values))
    wide, out = np.repeat(count, count), np.empty(4 * len(values), np.uint8)
    for k in range(4):
        out[place + k * wide] = values >> (8 * k) & 0xFF
    return out


def _from_planes(data: np.ndarray, start: np.ndarray, count: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number `at` of each row of `count` values whose planes start at byte `start`."""
    return sum(data[start + k * count + at].astype(np.int64) << (8 * k) for k in range(4))


def _beyond(ids, sides: pa.RecordBatch, row, begin, end, short, bounds, origin) -> pa.RecordBatch:
    """`sides` of the rows `row` of a block of texts, with the words beyond them."""
    first, last, start, length, side = (
        sides.column(c).to_numpy().astype(np.int64) for c in ("first", "last", "start", "length", "side")
    )
    asked = sides.column("asked").to_numpy(zero_copy_only=False)
    # Rows of one id may have other texts: a place counts where it fits.
    fits = last <= bounds[row + 1] - bounds[row]
    f, l = (bounds[row] + first)[fits], (bounds[row] + last)[fits]
    at = start[fits] + origin[row[fits]]
    fits[fits] = (begin[f] == at) & (end[l - 1] == at + length[fits])
    row, first, last, side, asked = row[fits], first[fits], last[fits], side[fits], asked[fits]
    f, l = bounds[row] + first, bounds[row] + last
    count = np.minimum(np.where(side == 1, bounds[row + 1] - l, first), FOLLOWED)
    of = np.repeat(np.arange(len(f)), count)
    step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    after = side[of] == 1
    word = np.where(after, l[of] + step, f[of] - 1 - step)
    reach = np.where(after, end[word] - end[l[of] - 1], begin[f[of]] - begin[word])[asked[of]]
    told = np.where(asked, count, 0)
    keep = pa.array(fits)
    found = sides.select([*_PLACES[1:], "side", "asked"]).filter(keep)
    columns = [ids.filter(keep), *found.columns, _binary(short[word], count), _binary(_planes(reach, told), told)]
    return pa.RecordBatch.from_arrays(columns, [*_PLACES, "side", "asked", "words", "reach"])


def _common(a: bytes, b: bytes) -> int:
    """Equal words at the start of two rows of hashes of four bytes."""
    size = min(len(a), len(b)) // 4
    x, y = np.frombuffer(a, ">u4", size), np.frombuffer(b, ">u4", size)
    other = np.flatnonzero(x != y)
    return int(other[0]) if len(other) else size


def extended(documents: DataFrame, found: DataFrame) -> DataFrame:
    """Matches with the words `more0`, `more1` and code points `chars0`, `chars1` by which
    the equal run with any other member of the cluster goes on before and after them.

    In order of the words beyond them, the longest run of each match is with a neighbour.
    The order is cut into ranges, so a passage that every document has is many tasks' work;
    the rows at the rims of the ranges, two a range, are compared on the driver.
    """
    order = ["cluster", "side", "words", "doc_id", "first", "last"]
    with scratch(documents.sparkSession, keep=True) as kept:
        span = F.struct(*_PLACES[1:], "side", "asked")
        spans = kept(rim_matches(found).groupBy("doc_id").agg(F.collect_set(span).alias("spans")), "spans")
    around = materialise(_surroundings(documents, spans), "surroundings")
    ranged = around.repartitionByRange(parallelism(around.sparkSession), *order).sortWithinPartitions(*order)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row waits for the one after it; the first and the last of all are rims.
        held, before, rims = None, 0, 1
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.concat_batches([held, batch])
            equal = _equal_runs(rows)
            more = np.maximum(np.append(before, equal[:-1]), equal) if len(equal) else equal
            if len(equal):
                yield from _measured_rows(rows.slice(0, len(equal)), more, rims)
                rims, before = 0, int(equal[-1])
            held = rows.slice(len(equal))
        if held is not None:
            yield from _measured_rows(held, np.array([before]), 1)

    names = [*_PLACES, "side", "more", "chars"]
    fields = f"{_PLACE}, side int, asked boolean, more int, chars int, words binary, reach binary"
    done = materialise(ranged.select(*_PLACES, "side", "asked", "words", "reach").mapInArrow(measure, fields), "measured")
    rims = sorted((r.asDict() for r in done.filter("words is not null").collect()), key=lambda r: [r[c] for c in order])
    late = []
    for a, b in zip(rims, rims[1:]):
        if (a["cluster"], a["side"]) == (b["cluster"], b["side"]):
            equal = _common(a["words"], b["words"])
            late += [_measured(r, equal) for r in (a, b) if r["asked"]]
    both = done.filter("asked").select(*names)
    if late:
        types = f"{_PLACE}, side int, more int, chars int"
        both = both.unionByName(documents.sparkSession.createDataFrame([tuple(r[c] for c in names) for r in late], types))
    # All matches, those that were not asked about as they are.
    every = found.select(*_PLACES).unionByName(both, allowMissingColumns=True)
    # Dealt by document once, for the sums here and the stretches of each document after them.
    return every.repartition(parallelism(around.sparkSession), "doc_id").groupBy(*_PLACES).agg(
        *[F.coalesce(F.max(F.when(F.col("side") == k, F.col(c))), F.lit(0)).alias(f"{c}{k}") for k in (0, 1) for c in ("more", "chars")]
    )


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of four bytes of a binary column, and where each row's start."""
    _, edges, data = column.buffers()
    off = np.frombuffer(edges, np.int32)[column.offset : column.offset + len(column) + 1] // 4
    values = np.frombuffer(data, np.uint32, len(data) // 4) if data is not None else np.zeros(0, np.uint32)
    return values, off.astype(np.int64)


def _equal_runs(rows: pa.RecordBatch) -> np.ndarray:
    """How many words each row has in common with the next one, if both are of one cluster and side."""
    values, off = _flat(rows.column("words"))
    inside = np.arange(FOLLOWED) < np.diff(off)[:, None]
    table = np.zeros(inside.shape, np.uint32)
    table[inside] = values[off[0] : off[-1]]
    same = (table[1:] == table[:-1]) & inside[1:] & inside[:-1]
    for name in ("cluster", "side"):
        key = rows.column(name).to_numpy()
        same &= (key[1:] == key[:-1])[:, None]
    return np.where(same.all(axis=1), FOLLOWED, np.argmin(same, axis=1)).astype(np.int64)


def _measured_rows(rows: pa.RecordBatch, more: np.ndarray, rims: int) -> Iterator[pa.RecordBatch]:
    """Asked rows with their runs; the first `rims` rows, asked or not, keep their words to be compared once more."""
    values, off = _flat(rows.column("reach"))
    chars, count = np.zeros(len(more), np.int64), np.diff(off)
    told = (more > 0) & (count > 0)
    chars[told] = _from_planes(values.view(np.uint8), 4 * off[:-1][told], count[told], more[told] - 1)
    rim = np.arange(len(more)) < rims
    for part, rest in ((rim, False), (~rim & rows.column("asked").to_numpy(zero_copy_only=False), True)):
        if part.any():
            kept = rows.select([*_PLACES, "side", "asked"]).filter(pa.array(part))
            tail = [pa.nulls(int(part.sum()), pa.binary()) if rest else rows.column(c).filter(pa.array(part)) for c in ("words", "reach")]
            lengths = [pa.array(x[part].astype(np.int32)) for x in (more, chars)]
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *lengths, *tail], [*_PLACES, "side", "asked", "more", "chars", "words", "reach"]
            )


def _measured(row: dict, more: int) -> dict:
    """A rim with its run."""
    data = np.frombuffer(row["reach"] or b"", np.uint8)
    chars = int(_from_planes(data, 0, len(data) // 4, more - 1)) if more and len(data) else 0
    return {**row, "more": more, "chars": chars}


def repeated_passages(
    documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, least: int = MIN_WORDS, run: int = MIN_RUN
) -> DataFrame:
    """Per repeated stretch: `doc_id, start, length, n_words, n_removed, cluster, kept`.

    Repeated paragraphs and pieces, extended to their equal runs at the rims, that touch or
    overlap are one stretch; stretches of fewer than `run` words are left out.  `start` and `length` are
    code points, `n_removed` the words of its matches that are not first of their cluster
    (of overlapping matches the earlier one's), `cluster` that of its first match, and
    `kept` is true if nothing is removed.  Documents without such a stretch have no row.
    Repeated rows of one id are told apart by their places only.
    """
    spark = documents.sparkSession
    with scratch(spark, keep=True) as kept:
        near = kept(repeated_paragraphs(documents, shingle, percent, least).select(*_MATCH), "near")
    with scratch(spark, keep=True) as kept:
        equal = kept(repeated_pieces(documents, least), "equal")
    found = near.unionByName(equal)
    order = ["low", "high", "cluster", "kept"]
    of_doc = Window.partitionBy("doc_id").orderBy(*order)
    runs = extended(documents, found).select(
        "doc_id", "cluster", "kept", (F.col("first") - F.col("more0")).alias("low"), (F.col("last") + F.col("more1")).alias("high"),
        (F.col("start") - F.col("chars0")).alias("start"), (F.col("start") + F.col("length") + F.col("chars1")).alias("end"),
    )
    reached = F.max("high").over(of_doc.rowsBetween(Window.unboundedPreceding, -1))
    placed = runs.withColumn("reached", reached).withColumn(
        "broken", F.coalesce(F.col("low") > F.col("reached"), F.lit(True)).cast("int")
    )
    new = F.greatest(F.col("high") - F.greatest("low", F.coalesce("reached", "low")), F.lit(0))
    return (
        placed.withColumn("n", new).withColumn("stretch", F.sum("broken").over(of_doc)).groupBy("doc_id", "stretch").agg(
            F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"),
            (F.max("high") - F.min("low")).cast("long").alias("n_words"),
            F.sum(F.when(~F.col("kept"), F.col("n")).otherwise(0)).cast("long").alias("n_removed"),
            F.min_by("cluster", F.struct(*order)).alias("cluster"),
        ).filter(F.col("n_words") >= run).withColumn("kept", F.col("n_removed") == 0).drop("stretch")
    )

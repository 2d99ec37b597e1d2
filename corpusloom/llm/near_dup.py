"""Near-duplicate documents: a chosen-path set similarity join over minwise tokens.

A document's shingle set selects one token per minwise hash function.  In each tree,
documents that share the selected token of a seeded function form a node; a node that is
too large branches on further functions, as many times as a pair at the threshold needs to
be expected once on every level.  Small nodes are compared
exhaustively by sketch, independent trees repeat this, and what the trees bring together
is confirmed on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.frames import by_key, few, groups, scan_groups, spread_join, with_keys
from corpusloom.llm.graph import components, forest_roots
from corpusloom.llm.text import SOLID, blocks, buffers, numbers, shingle_sets, words
from corpusloom.session import materialise

# Minwise functions; each keeps 32 bits for the trees and 8 bits for the sketch.
FUNCTIONS = 64
# Independent trees.  A pair at the threshold stays together over all levels of one with
# probability 0.6 or more, so ten leave 1 in 10^4 pairs of the largest nodes, and fewer of
# others: 0.15 to the tenth in nodes that are small at once.
TREES = 10
# Tokens selected at once below the first level, and levels: ten tokens at the deepest.
STEP, LEVELS = 3, 4
# Nodes up to this size are compared exhaustively.
SMALL_NODE = 48
# In a large node: agreement with the center from which a member is linked to it, and from
# which it leaves the recursion.  The gap is the distance of a match plus three deviations.
LIKE_CENTER, SETTLED = 0.5, 0.8
PICKED = 15
# Sets checked against each other in one task.
GROUP = 1024
# A sketch may fall short of the threshold by this much: over five standard deviations.
SLACK = 0.24

RECORD = "doc_id long, text_hash long, n_shingles long, set_key binary, sig binary"


def shingle_records(documents: DataFrame, shingle: int, functions: int = FUNCTIONS) -> DataFrame:
    """Per document: set size, a 128-bit key of the set, and its minwise tokens.

    Key and tokens are null for an empty set.
    """
    factors = numbers(functions, 101) | np.uint64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(2))
            sizes, keys, sigs = [], [], []
            for a, b in blocks(off):
                part = off[a : b + 1]
                _, _, _, hashes, bounds = words(data[part[0] : part[-1]], part - part[0], SOLID)
                sets = shingle_sets(hashes, bounds, shingle)
                lengths = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(lengths)
                sig = np.zeros((len(sets), functions), dtype=np.uint32)
                if len(full):
                    flat = np.concatenate(sets)
                    starts = (np.cumsum(lengths) - lengths)[full]
                    for k in range(functions):
                        token = (flat * factors[k]) >> np.uint64(32)
                        sig[full, k] = np.minimum.reduceat(token, starts)
                for at, s in enumerate(sets):
                    sizes.append(len(s))
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sigs.append(sig[at].astype(">u4").tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()),
                ],
                ["doc_id", "text_hash", "n_shingles", "set_key", "sig"],
            )

    keyed = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return keyed.mapInArrow(sign, RECORD)


def full_sets(documents: DataFrame, shingle: int) -> DataFrame:
    """`(set_key, members)`: each document's sorted shingle hashes, recomputed."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(0))
            for a, b in blocks(off):
                part = off[a : b + 1]
                _, _, _, hashes, bounds = words(data[part[0] : part[-1]], part - part[0], SOLID)
                raw = [s.tobytes() for s in shingle_sets(hashes, bounds, shingle) if len(s)]
                keys = [hashlib.blake2b(r, digest_size=16).digest() for r in raw]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], ["set_key", "members"]
                )

    return documents.select("text").mapInArrow(build, "set_key binary, members binary")


def _token(function) -> F.Column:
    return F.substring(F.col("sig"), 4 * function + 1, 4)


def _nodes(level: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of small nodes of two or more, and members of larger nodes."""
    sizes = level.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    sized = materialise(spread_join(level, sizes, "node", "inner"), "nodes")
    small = sized.filter(F.col("size") <= SMALL_NODE).select("set_key", "node")
    return small, sized.filter(F.col("size") > SMALL_NODE).drop("size")


def _agreement(a: str, b: str):
    """Share of the minwise functions that select the same token."""
    same = F.filter(
        F.sequence(F.lit(0), F.lit(FUNCTIONS - 1)),
        lambda k: F.substring(F.col(a), 4 * k + 1, 4) == F.substring(F.col(b), 4 * k + 1, 4),
    )
    return F.size(same) / FUNCTIONS


def _majority(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each node, the token most of its picked members select, and the member most like that."""
    for batch in batches:
        centers, sigs = [], []
        for picked in batch.column(1).to_pylist():
            tokens = np.stack([np.frombuffer(p["sig"], ">u4") for p in picked])
            equal = (tokens[:, None, :] == tokens[None, :, :]).sum(axis=1)
            middle = tokens[equal.argmax(axis=0), np.arange(tokens.shape[1])]
            centers.append(picked[int((tokens == middle).sum(axis=1).argmax())]["set_key"])
            sigs.append(middle.astype(">u4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(centers, pa.binary()), pa.array(sigs, pa.binary())],
            ["node", "center", "center_sig"],
        )


def _middles(rows: DataFrame) -> DataFrame:
    """`(node, center, center_sig)`: the majority of `PICKED` seeded members of each node,
    and the picked member most like it."""
    picks = [
        F.min(F.struct(F.xxhash64("set_key", "node", F.lit(k)).alias("h"), "set_key", "sig")).alias(f"p{k}")
        for k in range(PICKED)
    ]
    picked = rows.groupBy("node").agg(*picks).select("node", F.array(*[f"p{k}" for k in range(PICKED)]).alias("picked"))
    return picked.mapInArrow(_majority, "node long, center binary, center_sig binary")


def _around_centers(large: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of large nodes with the node's `center` and their `share` of equal tokens
    with the node's middle."""
    rows = large if "sig" in large.columns else large.join(classes.select("set_key", "sig"), "set_key")
    joined = spread_join(rows, _middles(rows), "node", "inner")
    return joined.withColumn("share", _agreement("sig", "center_sig")).drop("center_sig")


def tree_nodes(classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """`(node, set_key)` of all small nodes, and links `(a, b)` from large ones.

    In a large node, members like its center are linked to it, to be confirmed with their
    group.  The most like ones then leave the recursion: whatever matches one of them
    differs from the center by little more, and so is linked to the center too.  The others
    branch.  Nodes that stay large after the last level are linked to their centers whole.
    """
    extra = 1.0 / threshold**STEP - 1.0
    least, more = int(extra) + 1, int(round((extra % 1.0) * 1000))
    first = [F.xxhash64(F.lit(t), F.lit(0), _token(F.lit(t % FUNCTIONS))) for t in range(TREES)]
    level = classes.select("set_key", F.explode(F.array(*first)).alias("node"))
    found, links = None, None
    for depth in range(1, LEVELS + 1):
        small, large = _nodes(level)
        found = small if found is None else found.unionByName(small)
        if large.isEmpty():
            break
        rows = materialise(_around_centers(large, classes), "centers")
        like = rows if depth == LEVELS else rows.filter(F.col("share") >= LIKE_CENTER)
        linked_now = like.select(F.col("set_key").alias("a"), F.col("center").alias("b"))
        links = linked_now if links is None else links.unionByName(linked_now)
        if depth == LEVELS:
            break
        # Functions are chosen by the node, so all its members branch alike.
        lucky = F.pmod(F.xxhash64("node", F.lit(depth)), F.lit(1000)) < more
        branches = F.sequence(F.lit(1), F.lit(least) + lucky.cast("int"))
        branched = rows.filter(F.col("share") < SETTLED).withColumn("branch", F.explode(branches))
        tokens = []
        for k in range(STEP):
            function = F.pmod(F.xxhash64("node", "branch", F.lit(k)), F.lit(FUNCTIONS)).cast("int")
            tokens += [function, _token(function)]
        level = branched.select("set_key", "sig", F.xxhash64("node", "branch", *tokens).alias("node"))
    return found, links


def candidate_links(nodes: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Links `(a, b)` between members of a node whose sketches and sizes allow a match.

    Every pair of a node is looked at; its matches are kept as stars, since
    the confirmation takes whole groups.  Nodes have at most `SMALL_NODE` members.
    """
    sketch = F.concat(*[F.substring(F.col("sig"), 4 * k + 4, 1) for k in range(FUNCTIONS)])
    slim = classes.select("set_key", "n_shingles", sketch.alias("sketch"))
    least = int(np.floor((threshold - SLACK) * FUNCTIONS))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_nodes(batches):
            node = table.column("node").to_numpy()
            size = table.column("n_shingles").to_numpy()
            keys = table.column("set_key").combine_chunks()
            sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, FUNCTIONS)
            rows = len(node)
            start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            span = np.diff(np.append(start, rows))
            pairs_a, pairs_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for step in range(1, int(span.max())):
                i = np.flatnonzero(node[step:] == node[:-step])
                j = i + step
                small, big = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
                fits = small >= threshold * big - 1e-9
                i, j = i[fits], j[fits]
                alike = (sketches[i] == sketches[j]).sum(axis=1) >= least
                pairs_a.append(i[alike])
                pairs_b.append(j[alike])
            stars = forest_roots(zip(np.concatenate(pairs_a).tolist(), np.concatenate(pairs_b).tolist()))
            stars = [(x, r) for x, r in stars.items() if x != r]
            a, b = (pa.array([x[k] for x in stars], pa.int64()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([keys.take(a), keys.take(b)], ["a", "b"])

    rows = nodes.join(slim, "set_key")
    return by_key(rows, "node", then=("set_key",)).mapInArrow(compare, "a binary, b binary")


def _whole_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that end where a node ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        node = batch.column(batch.schema.get_field_index("node")).to_numpy()
        other = np.flatnonzero(node != node[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut or held and held[-1].column(held[-1].schema.get_field_index("node"))[-1].as_py() != node[0]:
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def confirm(rows: DataFrame, percent: int) -> DataFrame:
    """Links `(a, b)` of the sets in each `task` that reach the threshold, on full sets.

    `rows` has `task`, `set_key`, `members` and `asked`.  Each asked set is counted against
    all sets of the task by an inverted list; a task ends when it is one component.  Links
    come as stars around the least key of each component.  A task holds `GROUP` sets or so.
    """
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links():
            for table in groups(batches, "task"):
                if table.num_rows < 2:
                    continue
                keys = table.column("set_key").to_pylist()
                asked = np.flatnonzero(table.column("asked").to_numpy(zero_copy_only=False))
                sets = [np.frombuffer(m, np.uint64) for m in table.column("members").to_pylist()]
                found = [(keys[a], keys[b]) for a, b in linked(sets, asked, percent)]
                for a, b in forest_roots(found).items():
                    yield {"a": a, "b": b}

        yield from scan_groups(schema, links())

    return by_key(rows, "task", then=("set_key",)).mapInArrow(check, "a binary, b binary")


def linked(sets: list[np.ndarray], asked, percent: int) -> list[tuple[int, int]]:
    """Enough of the matching pairs `(asked, other)` to connect all that match."""
    size = np.array([len(s) for s in sets])
    out: list[tuple[int, int]] = []
    if len(sets) == 2:
        inter = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if 100 * inter >= percent * (size.sum() - inter) and inter else []
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(codes, kind="stable")
    posting = owner[order]
    bounds = np.searchsorted(codes[order], np.arange(codes.max() + 2))
    first = np.cumsum(size) - size
    part = np.arange(len(sets))
    for q in asked:
        mine = codes[first[q] : first[q] + size[q]]
        low, count = bounds[mine], bounds[mine + 1] - bounds[mine]
        spread = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        inter = np.bincount(posting[spread], minlength=len(sets))
        hit = np.flatnonzero((inter > 0) & (100 * inter >= percent * (size[q] + size - inter)))
        for other in hit:
            if part[other] != part[q]:
                out.append((int(q), int(other)))
                part[part == part[other]] = part[q]
        if (part == part[0]).all():
            break
    return out


def confirmed_components(
    documents: DataFrame, classes: DataFrame, links: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """`(set_key, grp)`: components of the exact links within each candidate group.

    A group of up to `GROUP` sets is checked in one task, which knows its components.  A
    larger one is first checked against its hub, the set most like the group's majority
    of tokens, in parts; sets that are not linked to the hub are then checked against all
    parts.  No pair is left out, and no task holds more than two parts.
    """
    grouped = components(links).select(F.col("id").alias("set_key"), F.col("root").alias("grp"))
    sizes = grouped.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    placed = materialise(spread_join(grouped, sizes, "grp", "inner"), "groups")
    ids = placed.join(classes.select("set_key", "rep"), "set_key").select(F.col("rep").alias("doc_id")).distinct()
    picked = with_keys(documents.select("doc_id", "text"), ids, "doc_id")
    # Copies of a picked document have the same key: one of them is enough.
    sets = full_sets(picked, shingle).dropDuplicates(["set_key"])
    members = materialise(sets.join(placed, "set_key"), "sets")

    small = members.filter(F.col("n") <= GROUP)
    found = confirm(small.select(F.col("grp").alias("task"), "set_key", "members", F.lit(True).alias("asked")), percent)
    large = members.filter(F.col("n") > GROUP)
    found = found.select(F.col("a").alias("set_key"), F.col("b").alias("grp"))
    if large.isEmpty():
        return found

    half = GROUP // 2
    parts = F.ceil(F.col("n") / half).cast("int")
    cut = large.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("set_key"), F.col("parts")).cast("int"))
    keyed = large.select(F.xxhash64("grp").alias("node"), "set_key").join(classes.select("set_key", "sig"), "set_key")
    hubs = _middles(keyed).select(F.col("center").alias("set_key"))

    def tasks(asked: DataFrame) -> DataFrame:
        """Each asked set beside every part of its group, a part's worth of them at a time."""
        key = F.sha1(F.concat_ws("|", F.hex("grp"), "part", "chunk"))
        every = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        chunks = asked.select("grp", "chunk").distinct()
        others = cut.join(chunks, "grp")
        both = every.select("grp", "part", "chunk", "set_key", "members", F.lit(True).alias("asked")).unionByName(
            others.select("grp", "part", "chunk", "set_key", "members", F.lit(False).alias("asked"))
        )
        return both.withColumn("task", key).groupBy("task", "set_key").agg(
            F.first("members").alias("members"), F.max("asked").alias("asked")
        )

    hub = cut.join(hubs, "set_key", "left_semi").withColumn("chunk", F.lit(0))
    star = materialise(confirm(tasks(hub), percent), "star")
    near = star.select(F.col("a").alias("set_key")).unionByName(star.select(F.col("b").alias("set_key"))).distinct()
    left = cut.join(near, "set_key", "left_anti")
    waiting = left.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / half).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("set_key", F.lit(1)), F.col("chunks")).cast("int")
    chunked = spread_join(left, waiting, "grp", "inner").withColumn("chunk", chunk).drop("chunks")
    rest = confirm(tasks(chunked), percent)
    joined = components(star.unionByName(rest)).withColumnsRenamed({"id": "set_key", "root": "grp"})
    return found.unionByName(joined)


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per document: `doc_id, n_shingles, component_id, kept, text_hash`.

    Documents are linked when 100 x shared shingles >= `percent` x all shingles of both;
    `component_id` is the smallest `doc_id` reachable by links.  Words are what stands
    between white space, A to Z lower-cased.  A text of fewer words than a shingle is one
    shingle; without words it is linked with nothing.  Equal sets are one class, so copies
    cost one row each.  A row without id is linked with nothing, has no `component_id` and
    is kept.  Rows that share an id are linked by their own texts.  `documents` is read
    twice.
    """
    threshold = percent / 100.0
    records = materialise(shingle_records(documents, shingle), "records")
    usable = records.filter("set_key is not null and doc_id is not null")
    classes = materialise(
        usable.groupBy("set_key").agg(
            F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.max("sig").alias("sig")
        ),
        "classes",
    )
    nodes, starred = tree_nodes(classes, threshold)
    links = candidate_links(nodes, classes, threshold)
    links = materialise(links if starred is None else links.unionByName(starred), "candidates")
    joined = materialise(confirmed_components(documents, classes, links, shingle, percent), "components")
    reps = classes.select("set_key", "rep")
    linked_reps = joined.join(reps, "set_key")
    least = linked_reps.groupBy("grp").agg(F.min("rep").alias("least"))
    by_class = spread_join(linked_reps.select("set_key", "grp"), least, "grp", "inner").select("set_key", "least")
    # The least id of every class, linked or not.
    ids = reps.join(by_class, "set_key", "left").select("set_key", F.coalesce("least", "rep").alias("component_id"))
    out = spread_join(records.drop("sig"), ids, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.withColumn("component_id", component).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "text_hash",
    )


def drop_near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, that with the smallest id; all columns are kept.

    A row is known by its id and text: of repeated rows one stays.  Rows without id stay.
    The texts stay in place while the rows to remove are few enough to broadcast.
    """
    marked = materialise(near_duplicates(documents, shingle, percent).filter("doc_id is not null"), "marked")
    key = ["doc_id", "_text_hash"]
    marked = marked.select("doc_id", F.col("text_hash").alias("_text_hash"), "kept")
    removed = marked.filter("not kept").select(*key).distinct()
    hashed = documents.withColumn("_text_hash", F.xxhash64("text"))
    kept = hashed.join(F.broadcast(removed) if few(removed) else removed, key, "left_anti")
    repeated = materialise(
        marked.filter("kept").groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key), "repeated"
    )
    if not repeated.isEmpty():
        side = F.broadcast(repeated) if few(repeated) else repeated
        once = kept.join(side, key, "left_semi").dropDuplicates(key)
        kept = kept.join(side, key, "left_anti").unionByName(once)
    return kept.select(*documents.columns)

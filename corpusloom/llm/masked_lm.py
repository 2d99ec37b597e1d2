"""Masked pseudo-likelihood of documents under a bidirectional window network.

A small network reads the words on both sides of a masked position and predicts the class of
the word; the word within its class follows the corpus counts, of rare words too.  It is trained in numpy, each
task on the masked positions of its own rows, and the tasks' networks are averaged.  A score
is the sum of the conditional log probabilities of all words of a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.frames import spread_join
from corpusloom.llm.text import ALNUM, blocks, buffers, words
from corpusloom.session import materialise, parallelism

# Words with an id of their own in the network; all others share as many ids by hash, a
# power of two, and are told apart by their counts.
VOCABULARY, BUCKETS = 20_000, 64
CLASSES, WIDTH, HIDDEN, REACH = 64, 16, 32, 2
# The words of each document are dealt to this many rounds, and each is masked in one of
# them; networks are averaged after each.
ROUNDS = 2
BATCH, RATE = 4096, 0.08
# Words are found by this many leading bits of their hash, which few of them share.
_PREFIX = 18
_SLICES, _PARTS = 8, 16


def count_words(documents: DataFrame, text: str = "text") -> DataFrame:
    """`(h, n, tail)` of every distinct word of all documents: hash, count, last two bytes.

    A task adds up its own words before they are shuffled, in parts of bounded size.
    """

    def sums(parts):
        h, tail, n = (np.concatenate(x) for x in zip(*parts))
        keys, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        return keys, tail[first], np.bincount(inverse, weights=n, minlength=len(keys)).astype(np.int64)

    def batch_of(part) -> pa.RecordBatch:
        h, tail, n = part
        return pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(tail.astype(np.int32))], ["h", "n", "tail"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            data, off = buffers(batch.column(0))
            for a, b in blocks(off):
                part = off[a : b + 1]
                low, s, e, h, _ = words(data[part[0] : part[-1]], part - part[0], ALNUM)
                if not len(h):
                    continue
                keys, first, n = np.unique(h, return_index=True, return_counts=True)
                last = e[first] - 1
                before = np.where(last > s[first], low[np.maximum(last - 1, 0)], 0).astype(np.int64)
                held.append((keys, low[last].astype(np.int64) * 256 + before, n))
                if sum(len(x[0]) for x in held) > 1_000_000:
                    held = [sums(held)]
                    if len(held[0][0]) > 500_000:
                        yield batch_of(held[0])
                        held = []
        if held:
            yield batch_of(sums(held))

    counts = documents.select(F.col(text).alias("text")).mapInArrow(count, "h long, n long, tail int")
    return counts.groupBy("h").agg(F.sum("n").alias("n"), F.max("tail").alias("tail"))


class Words:
    """Ids and classes of words; `inside` is each id's log share of its class.

    A rare word shares its id with others; `alone` is the log share that one occurrence of
    its word has in the class.  `other` counts the rare words by bucket, and each bucket
    has one more for words that the corpus does not have.  `counts` is the written table of
    all words; it stays on the driver.
    """

    counts: DataFrame | None = None

    def __init__(self, h: np.ndarray, n: np.ndarray, tail: np.ndarray, other: np.ndarray):
        order = np.argsort(h)
        self.h, n, tail = h[order], n[order].astype(np.float64), tail[order]
        size = len(h)
        # Where the hashes of each prefix start; a last one ends the search.
        self.ends = np.append(self.h, np.uint64(0xFFFFFFFFFFFFFFFF))
        prefixes = np.arange(1 << _PREFIX, dtype=np.uint64) << np.uint64(64 - _PREFIX)
        self.first = np.searchsorted(self.h, prefixes).astype(np.int32)
        mass = np.concatenate([n, other + 1.0])
        total = mass.sum()
        self.size = size + BUCKETS
        self.kind = np.zeros(self.size + 1, dtype=np.int64)
        # Frequent words are classes; the others are cut by their endings into even shares.
        # The buckets of rare words are one class.
        heads = np.flatnonzero(n > total / CLASSES)
        self.kind[heads] = np.arange(len(heads))
        rest = np.flatnonzero(n <= total / CLASSES)
        rest = rest[np.argsort(tail[rest], kind="stable")]
        room = max(CLASSES - len(heads) - 1, 1)
        if len(rest):
            share = np.cumsum(n[rest]) / n[rest].sum()
            self.kind[rest] = len(heads) + np.minimum((share * room).astype(np.int64), room - 1)
        self.kind[size : self.size] = CLASSES - 1
        whole = np.bincount(self.kind[: self.size], weights=mass, minlength=CLASSES)
        self.inside = np.log(mass / whole[self.kind[: self.size]])
        self.alone = self.inside.copy()
        self.alone[size:] -= np.log(mass[size:])

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "counts"}

    def ids(self, h: np.ndarray) -> np.ndarray:
        rare = len(self.h) + (h & np.uint64(BUCKETS - 1)).astype(np.int64)
        if not len(self.h):
            return rare
        at = self.first[(h >> np.uint64(64 - _PREFIX)).view(np.int64)]
        behind = np.flatnonzero(self.ends[at] < h)
        while len(behind):
            at[behind] += 1
            behind = behind[self.ends[at[behind]] < h[behind]]
        return np.where((self.ends[at] == h) & (at < len(self.h)), at, rare)


def build_words(documents: DataFrame, text: str = "text", size: int = VOCABULARY) -> Words:
    """The vocabulary from counts over all documents; the driver gets `size` words."""
    counts = materialise(count_words(documents, text), "words")
    # Hashes are signed here; their low bits are the bucket either way.
    sums = counts.groupBy(F.col("h").bitwiseAND(BUCKETS - 1).alias("b")).agg(F.sum("n").alias("n")).collect()
    other = np.zeros(BUCKETS, np.int64)
    for r in sums:
        other[r.b] = r.n
    # Merged by a task and written, so the driver gets `size` rows, not as many from each task.
    top = materialise(counts.orderBy(F.desc("n"), "h").limit(size), "vocabulary").collect()
    h = np.array([r.h for r in top], dtype=np.int64).view(np.uint64)
    n = np.array([r.n for r in top], dtype=np.int64)
    np.subtract.at(other, (h % np.uint64(BUCKETS)).astype(np.int64), n)
    known = Words(h, n, np.array([r.tail for r in top], dtype=np.int64), other)
    known.counts = counts
    return known


def first_network(size: int) -> dict[str, np.ndarray]:
    """A seeded start; the last row of `e` stands for positions outside the document."""
    rng = np.random.default_rng(5)
    return {
        "e": rng.normal(0, 0.1, (size + 1, WIDTH)).astype(np.float32),
        "w": rng.normal(0, 0.15, (2 * REACH * WIDTH, HIDDEN)).astype(np.float32),
        "b": np.zeros(HIDDEN, np.float32),
        "u": rng.normal(0, 0.1, (HIDDEN, CLASSES)).astype(np.float32),
        "c": np.zeros(CLASSES, np.float32),
    }


def contexts(ids: np.ndarray, bounds: np.ndarray, outside: int) -> np.ndarray:
    """For every word the ids of its neighbours on both sides."""
    n = len(ids)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    out = np.full((n, 2 * REACH), outside, dtype=np.int64)
    column = 0
    for step in [*range(-REACH, 0), *range(1, REACH + 1)]:
        a, b = max(0, -step), min(n, n - step)
        if b > a:
            same = row[a:b] == row[a + step : b + step]
            out[a:b, column] = np.where(same, ids[a + step : b + step], outside)
        column += 1
    return out


def _largest(z: np.ndarray) -> np.ndarray:
    """The largest of each row as a column, by halves: whole columns are compared at once."""
    while z.shape[1] > 1:
        half = (z.shape[1] + 1) // 2
        z = np.maximum(z[:, :half], z[:, -half:])
    return z


def forward(net: dict, around: np.ndarray):
    x = net["e"].take(around.reshape(-1), axis=0).reshape(len(around), -1)
    hidden = x @ net["w"]
    hidden += net["b"]
    np.tanh(hidden, out=hidden)
    z = hidden @ net["u"]
    z += net["c"]
    z -= _largest(z)
    e = np.exp(z)
    return x, hidden, z, e, e.sum(axis=1)


def train_step(net: dict, square: dict, around: np.ndarray, target: np.ndarray) -> float:
    """One Adagrad step on a batch; the mean loss before it."""
    x, hidden, z, e, total = forward(net, around)
    each = np.arange(len(target))
    loss = float(np.mean(np.log(total) - z[each, target]))
    dz = np.divide(e, total[:, None], out=e)
    dz[each, target] -= 1.0
    dz /= len(target)
    dh = (dz @ net["u"].T) * (1.0 - hidden * hidden)
    dx = (dh @ net["w"].T).reshape(-1, WIDTH)
    grads = {"u": hidden.T @ dz, "c": dz.sum(axis=0), "w": x.T @ dh, "b": dh.sum(axis=0)}
    for name, g in grads.items():
        square[name] += g * g
        net[name] -= RATE * g / np.sqrt(square[name])
    # Only the vectors of the batch's own words move.
    flat = around.reshape(-1)
    rows = np.flatnonzero(np.bincount(flat, minlength=len(net["e"])))
    at = np.zeros(len(net["e"]), np.int64)
    at[rows] = np.arange(0, len(rows) * WIDTH, WIDTH)
    place = (at[flat][:, None] + np.arange(WIDTH)).reshape(-1)
    g = np.bincount(place, weights=dx.reshape(-1), minlength=len(rows) * WIDTH).reshape(-1, WIDTH).astype(np.float32)
    own = square["e"][rows] + g * g
    square["e"][rows] = own
    net["e"][rows] -= RATE * g / np.sqrt(own)
    return loss


def _block_ids(data, off, a, b, known: Words):
    part = off[a : b + 1]
    _, _, _, h, bounds = words(data[part[0] : part[-1]], part - part[0], ALNUM)
    return known.ids(h), bounds, h


def masked(bounds: np.ndarray, phase: np.ndarray, turn: int, turns: int) -> np.ndarray:
    """The words that are masked in one of `turns` turns, every word in one of them."""
    size = np.diff(bounds)
    inside = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size)
    return np.flatnonzero((inside + np.repeat(phase, size)) % turns == turn)


def train_round(
    documents: DataFrame, known, net, text: str = "text", turn: int = 0, turns: int = 1
) -> dict[str, np.ndarray]:
    """The average of the networks that tasks train from `net`, each on its own rows.

    Of `turns` rounds that mask every word once, this is number `turn`.
    A word's vector is averaged by how often tasks met it, the rest by trained positions.
    Networks travel in slices and are added in two steps.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((known, net))
    names = ["w", "b", "u", "c"]
    schema = "slice int, part int, total binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, start = shared.value
        own = {k: v.copy() for k, v in start.items()}
        square = {k: np.full(v.shape, 1e-4, np.float32) for k, v in own.items()}
        met, trained, waiting = np.zeros(len(own["e"]), np.int64), 0, []

        def learn(least: int) -> None:
            nonlocal met, trained, waiting
            if sum(len(t) for _, t in waiting) < least or not waiting:
                return
            around, target = (np.concatenate(x) for x in zip(*waiting))
            whole = len(target) if least == 1 else len(target) // BATCH * BATCH
            for k in range(0, whole, BATCH):
                part = slice(k, min(k + BATCH, whole))
                train_step(own, square, around[part], target[part])
                met += np.bincount(around[part].reshape(-1), minlength=len(met))
                trained += part.stop - part.start
            waiting = [(around[whole:], target[whole:])] if whole < len(target) else []

        for batch in batches:
            data, off = buffers(batch.column(0))
            phase = batch.column(1).to_numpy()
            for a, b in blocks(off):
                ids, bounds, _ = _block_ids(data, off, a, b, vocabulary)
                if not len(ids):
                    continue
                chosen = masked(bounds, phase[a:b], turn, turns)
                around = contexts(ids, bounds, vocabulary.size)[chosen]
                waiting.append((around, vocabulary.kind[ids[chosen]]))
                learn(BATCH)
        learn(1)
        dense = np.concatenate([own[k].reshape(-1) for k in names]).astype(np.float64) * trained
        vectors = (own["e"] * met[:, None]).reshape(-1)
        total = np.concatenate([[trained], dense, met, vectors])
        part = TaskContext.get().partitionId() % _PARTS
        pieces = np.array_split(total, _SLICES)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(_SLICES), pa.int32()), pa.array([part] * _SLICES, pa.int32()),
                pa.array([p.tobytes() for p in pieces], pa.binary()),
            ],
            ["slice", "part", "total"],
        )

    few = min(64, parallelism(spark))
    phase = F.pmod(F.xxhash64(F.col(text)), F.lit(turns)).alias("phase")
    tasks = documents.select(F.col(text).alias("text"), phase).mapInArrow(run, schema)
    added = tasks.repartition(few, "slice", "part").mapInArrow(_add, schema)
    merged = added.withColumn("part", F.lit(0)).repartition(few, "slice").mapInArrow(_add, schema)
    rows = {r.slice: np.frombuffer(r.total) for r in merged.collect()}
    if not rows:
        return net
    total = np.concatenate([rows[k] for k in range(_SLICES)])
    trained, at, out = total[0], 1, {}
    if trained == 0:
        return net
    for name in names:
        size = net[name].size
        out[name] = (total[at : at + size] / trained).reshape(net[name].shape).astype(np.float32)
        at += size
    met = total[at : at + len(net["e"])]
    vectors = total[at + len(met) :].reshape(net["e"].shape)
    seen = met > 0
    out["e"] = net["e"].copy()
    out["e"][seen] = (vectors[seen] / met[seen, None]).astype(np.float32)
    return out


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple, np.ndarray] = {}
    for batch in batches:
        for row in batch.to_pylist():
            key, values = (row["slice"], row["part"]), np.frombuffer(row["total"])
            sums[key] = sums[key] + values if key in sums else values
    keys = list(sums)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
            pa.array([sums[k].tobytes() for k in keys], pa.binary()),
        ],
        ["slice", "part", "total"],
    )


def train(documents: DataFrame, text: str = "text", rounds: int = ROUNDS):
    """Vocabulary and network from every word of all documents, each masked in one of the rounds."""
    known = build_words(documents, text)
    net = first_network(known.size)
    for k in range(rounds):
        net = train_round(documents, known, net, text, k, rounds)
    return known, net


def score(documents: DataFrame, known: Words, net: dict, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`(doc_id, n_tokens, log_likelihood, mean_log_likelihood)` of every document.

    Words are runs of letters, digits and non-ASCII characters, A to Z lower-cased.  A text
    without words, or null, has 0 tokens, a sum of 0 and no mean.  The counts of rare words
    are joined to the words of the documents, counted within each; a word that the corpus
    has once or never needs none, since the log of its count is 0.
    """
    shared = documents.sparkSession.sparkContext.broadcast((known, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, model = shared.value
        for batch in batches:
            data, off = buffers(batch.column(2))
            count, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            owners, rare, times = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for a, b in blocks(off):
                ids, bounds, h = _block_ids(data, off, a, b, vocabulary)
                count[a:b] = np.diff(bounds)
                if not len(ids):
                    continue
                around, target = contexts(ids, bounds, vocabulary.size), vocabulary.kind[ids]
                each = vocabulary.alone[ids].copy()
                for k in range(0, len(ids), 8192):
                    part = slice(k, min(k + 8192, len(ids)))
                    _, _, z, _, sums = forward(model, around[part])
                    each[part] += z[np.arange(part.stop - k), target[part]] - np.log(sums)
                row = np.repeat(np.arange(b - a), np.diff(bounds))
                total[a:b] = np.bincount(row, weights=each, minlength=b - a)
                few = ids >= len(vocabulary.h)
                if few.any():
                    order = np.lexsort((h[few], row[few]))
                    owner, word = row[few][order], h[few][order]
                    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (word[1:] != word[:-1])])
                    owners.append(a + owner[first])
                    rare.append(word[first])
                    times.append(np.diff(np.append(first, len(owner))))
            edges = np.searchsorted(np.concatenate(owners), np.arange(batch.num_rows + 1))
            lists = [
                pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values)
                for values in (pa.array(np.concatenate(rare).view(np.int64)), pa.array(np.concatenate(times), pa.int32()))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(count), pa.array(total), *lists],
                ["row", "doc_id", "n_tokens", "total", "rare", "times"],
            )

    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, n_tokens long, total double, rare array<long>, times array<int>"
    # Written, so the numbers of the rows stay.
    done = materialise(rows.mapInArrow(run, schema), "scored")
    listed = done.filter("size(rare) > 0").select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    terms = listed.select("row", F.col("w.rare").alias("h"), F.col("w.times").alias("times"))
    counts = known.counts.filter("n > 1").select("h", "n")
    more = spread_join(terms, counts, "h", "inner").groupBy("row").agg(F.sum(F.col("times") * F.log("n")).alias("more"))
    whole = F.col("total") + F.coalesce("more", F.lit(0.0))
    return done.drop("rare", "times").join(more, "row", "left").select(
        "doc_id", "n_tokens", whole.alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, whole / F.col("n_tokens")).alias("mean_log_likelihood"),
    )


def pseudo_likelihood(documents: DataFrame) -> DataFrame:
    """Every document scored by a network trained on all of them."""
    known, net = train(documents)
    return score(documents, known, net)

"""Secret scans: candidates found in texts, false positives removed by a random forest.

A candidate is a long run of key characters with a digit in it, or a whole value of any form that
is assigned to a credential name or stands as the password of a URL.  The forest sees its length, how likely its character transitions are
in the corpus, how much of it dictionary words cover, the path, and the words next to it.
It is trained from labelled findings.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.frames import few
from corpusloom.llm.text import ALNUM, LOWER, blocks, buffers, hash_spans, row_starts, runs
from corpusloom.session import materialise, parallelism

# A run is a candidate from the first length, a value assigned to a credential name from the second.
MIN_LENGTH, MIN_ASSIGNED = 12, 4
# Labelled findings that the forest is trained on at most.
TRAINING_ROWS = 20_000
TREES, DEPTH = 40, 8
# Dictionary: words of three to eight letters, this many of the most frequent.
DICTIONARY = 50_000
_SHORT, _LONG = 3, 8
# Words on either side that the forest sees, hashed to two to the power of this many columns a side.
NEIGHBOURS, NEIGHBOUR_BITS = 3, 5
PATH_BITS = 3

# Names that credentials are assigned to, and words that stand beside harmless values.
CREDENTIAL_WORDS = (
    "token", "secret", "password", "passwd", "pwd", "key", "apikey", "api", "auth",
    "authorization", "bearer", "credential", "credentials", "access", "private", "client",
)
HARMLESS_WORDS = (
    "sha", "sha1", "sha256", "md5", "commit", "checksum", "hash", "uuid", "guid", "id",
    "version", "phone", "tel", "card", "isbn", "date", "example", "sample", "placeholder",
)
# Published prefixes of issued keys, anywhere in a run; the short ones not inside a word.
ISSUED = re.compile(
    rb"(AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|gho_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{16,}"
    rb"|(?<![A-Za-z0-9])(xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{10,}))"
)
PLACEHOLDER = re.compile(rb"(?i)(x{6,}|0{8,}|1234567|changeme|example|placeholder|your[_-]?)")
UUID = re.compile(rb"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")

_KEY = np.zeros(256, dtype=bool)
_KEY[list(b"+/=_-")] = True
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _KEY[_low:_high] = True
_SIGN, _BLANK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_SIGN[list(b":=")] = True
_BLANK[list(b" \t\n\v\f\r\"'")] = True
_NAME = _KEY.copy()
_NAME[list(b"+/=")] = False
# Bytes on either side of a candidate that its neighbours are looked for in.
CONTEXT = 80
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_LOWER_LETTER = np.zeros(256, dtype=bool)
_LOWER_LETTER[0x61:0x7B] = True
# Classes of characters whose transitions are counted: letters, digits, the rest.
_CLASS = np.full(256, 37, dtype=np.int64)
_CLASS[0x61:0x7B] = np.arange(26)
_CLASS[0x30:0x3A] = 26 + np.arange(10)
_CLASS[list(b"+/=_-")] = 36
CLASSES = 38

FINDING = (
    "start long, length long, value string, assigned boolean, before array<string>, after array<string>"
)


_WORD = re.compile(rb"[A-Za-z0-9\x80-\xff]+")


def _near(body: bytes, low: int, high: int, forward: bool) -> list[str]:
    """Words in the context after `low` or before `high`, nearest first; a word that the context cuts is left out."""
    if forward:
        found = list(_WORD.finditer(body, low, min(high, low + CONTEXT)))[:NEIGHBOURS]
        whole = [m for m in found if not _WORD.match(body, m.end(), high)]
    else:
        found = list(_WORD.finditer(body, max(low, high - CONTEXT), high))[::-1][:NEIGHBOURS]
        whole = [m for m in found if m.start() == low or not _WORD.match(body, m.start() - 1, high)]
    return [m[0].decode("utf-8", "replace").lower() for m in whole]


# The name that a value is assigned to, the sign with what may open a value, and the ends of values.
_NAMED = re.compile(rb"([A-Za-z0-9_-]+)[\"']?\s*$")
_OPENED = re.compile(rb"(?:=>|:=|:(?!:)|=(?!=))\s*(?i:(?:bearer|basic)\s+)?([\"'`]?)")
_QUERY = re.compile(rb"[?&][A-Za-z0-9_-]+$")
_SOLID_RUN, _QUERY_RUN = re.compile(rb"[([{<]*(\S*)"), re.compile(rb"([^\s&#]*)")
_ENDS = b".,;:)]}>\"'`"
_LOGIN = re.compile(rb"://[^\s/?#@:]*:([^\s/@]+)@")


def _quoted_end(body: bytes, quote: bytes, start: int, end: int) -> int:
    """Where the quote that was opened closes, on its line and not escaped; -1 if it does not."""
    line = body.find(b"\n", start, end)
    end = end if line < 0 else line
    at = body.find(quote, start, end)
    while at > start and body[at - 1] == 0x5C:
        at = body.find(quote, at + 1, end)
    return at


def _assigned_span(body: bytes, low: int, sign: int, high: int, names: set) -> tuple[int, int] | None:
    """The whole value that the sign assigns to a credential name or a URL gives as password, within a row.

    A value in quotes runs to the closing one.  Others run to white space, without brackets
    before and marks after them, and in the query of a URL to the next parameter.
    """
    login = _LOGIN.match(body, sign, high)
    if login:
        return login.span(1)
    left = body[max(low, sign - CONTEXT) : sign]
    name = _NAMED.search(left)
    if name is None or not names & {w.decode() for w in re.split(rb"[_-]+", name[1].lower())}:
        return None
    opened = _OPENED.match(body, sign, high)
    if opened is None:
        return None
    start = opened.end()
    if opened[1]:
        end = _quoted_end(body, opened[1], start, high)
        if end >= 0:
            return start, end
    run = (_QUERY_RUN if _QUERY.search(left) else _SOLID_RUN).match(body, start, high)
    start = run.start(1)
    return start, start + len(run[1].rstrip(_ENDS))


def _key_runs(raw: np.ndarray, part: np.ndarray):
    """Runs of key characters in rows; a `=` is in one only as padding at its end."""
    mask = _KEY[raw]
    s, e, bounds = runs(raw == 0x3D, part)
    row = np.searchsorted(bounds, np.arange(len(s)), "right") - 1
    follows = (e < part[row + 1]) & _KEY[raw[np.minimum(e, max(len(raw) - 1, 0))]] if len(s) else np.zeros(0, bool)
    inner = np.zeros(len(raw) + 1, dtype=np.int64)
    inner[s[follows]] += 1
    inner[e[follows]] -= 1
    return runs(mask & (np.cumsum(inner)[:-1] == 0), part)


def find_candidates(documents: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """`(doc_id, path, start, length, value, assigned, before, after)` of every candidate.

    `start` and `length` count code points.  A candidate is a run of `MIN_LENGTH` key characters
    with a digit, or a value of `MIN_ASSIGNED` bytes or more assigned to a credential name or given as
    the password of a URL; a run inside such a value is no finding of its own.  `before` and
    `after` hold the words on either side, nearest first.  Empty and null texts have none.
    """
    names = set(CREDENTIAL_WORDS)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(2))
            rows, out = [], []
            for a, b in blocks(off):
                part = off[a : b + 1] - off[a]
                raw = data[off[a] : off[b]]
                s, e, bounds = _key_runs(raw, part)
                digits = np.zeros(len(raw) + 1, dtype=np.int64)
                np.cumsum(_DIGIT[raw], out=digits[1:])
                long = np.flatnonzero((e - s >= MIN_LENGTH) & (digits[e] > digits[s]))
                # A sign assigns where a name stands before it, blanks and quotes aside, or `//` after it.
                signs = np.flatnonzero(_SIGN[raw])
                owner = np.searchsorted(part, signs, "right") - 1
                solid = np.maximum.accumulate(np.where(_BLANK[raw], -1, np.arange(len(raw))))
                before = np.where(signs > part[owner], solid[signs - 1], -1)
                named = (before >= part[owner]) & _NAME[raw[before]]
                if not len(long) and not named.any():
                    continue
                body, spans = raw.tobytes(), []
                for p, r in zip(signs[named].tolist(), owner[named].tolist()):
                    span = _assigned_span(body, int(part[r]), p, int(part[r + 1]), names)
                    if span and span[1] - span[0] >= MIN_ASSIGNED:
                        spans.append((r, *span, True))
                # Runs that start inside a value are left out.
                covered = np.zeros(len(raw) + 1, dtype=np.int64)
                for _, x, y, _ in spans:
                    covered[x] += 1
                    covered[y] -= 1
                covered = np.cumsum(covered)
                row = np.searchsorted(bounds, long, "right") - 1
                alone = covered[s[long]] == 0
                spans += [(r, int(s[k]), int(e[k]), False) for k, r in zip(long[alone].tolist(), row[alone].tolist())]
                lead = np.zeros(len(raw) + 1, dtype=np.int64)
                np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
                for r, x, y, asked in sorted(set(spans)):
                    low, high = int(part[r]), int(part[r + 1])
                    rows.append(a + r)
                    out.append({
                        "start": int(lead[x] - lead[low]), "length": int(lead[y] - lead[x]),
                        "value": body[x:y].decode(), "assigned": asked,
                        "before": _near(body, low, x, False), "after": _near(body, y, high, True),
                    })
            at = pa.array(rows, pa.int64())
            found = pa.RecordBatch.from_pylist(out, pa.schema([
                ("start", pa.int64()), ("length", pa.int64()), ("value", pa.string()), ("assigned", pa.bool_()),
                ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string())),
            ]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *found.columns],
                ["doc_id", "path", *found.schema.names],
            )

    where = F.col(path).cast("string") if path in documents.columns else F.lit(None).cast("string")
    narrow = documents.select("doc_id", where.alias("path"), F.col(text).alias("text"))
    return narrow.mapInArrow(find, f"doc_id long, path string, {FINDING}")


def corpus_statistics(documents: DataFrame, text: str = "text") -> tuple[np.ndarray, list[str]]:
    """Log probabilities of character transitions, and the dictionary, over all texts.

    A task sends `CLASSES`^2 counts and its distinct short words; the driver gets the sums
    and the `DICTIONARY` most frequent words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        total: dict[bytes, int] = {}
        for batch in batches:
            data, off = buffers(batch.column(0))
            for a, b in blocks(off):
                part = off[a : b + 1] - off[a]
                low = LOWER[data[off[a] : off[b]]]
                kind = _CLASS[low]
                if len(kind) > 1:
                    inside = ~row_starts(part, len(low))[1:]
                    pairs += np.bincount((kind[:-1] * CLASSES + kind[1:])[inside], minlength=len(pairs))
                s, e, _ = runs(ALNUM[low], part)
                size = e - s
                letters = np.zeros(len(low) + 1, dtype=np.int64)
                np.cumsum(_LOWER_LETTER[low], out=letters[1:])
                short = (size >= _SHORT) & (size <= _LONG) & (letters[e] - letters[s] == size)
                s, e = s[short], e[short]
                key, first, n = np.unique(hash_spans(low, s, e), return_index=True, return_counts=True)
                body = low.tobytes()
                for k, times in zip(first.tolist(), n.tolist()):
                    word = body[s[k] : e[k]]
                    total[word] = total.get(word, 0) + times
                if len(total) > 200_000:  # sent in parts: a task's memory stays bounded
                    yield _counts([w.decode() for w in total], list(total.values()))
                    total = {}
        yield _counts([w.decode() for w in total], list(total.values()))
        yield _counts([f"#{k}" for k in range(len(pairs))], pairs.tolist())

    counts = documents.select(F.col(text).alias("text")).mapInArrow(count, "word string, n long")
    sums = materialise(counts.groupBy("word").agg(F.sum("n").alias("n")), "letters")
    pairs = np.zeros(CLASSES * CLASSES)
    for row in sums.filter("word like '#%'").collect():
        pairs[int(row.word[1:])] = row.n
    pairs = pairs.reshape(CLASSES, CLASSES) + 0.5
    logp = np.log(pairs / pairs.sum(axis=1, keepdims=True))
    # Merged by a task and written, so the driver gets the dictionary alone.
    top = sums.filter("word not like '#%'").orderBy(F.desc("n"), "word").limit(DICTIONARY)
    top = materialise(top, "dictionary").collect()
    return logp, [r.word for r in top]


def _counts(words: list[str], n: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])


def _bucket(word: str, bits: int) -> int:
    return hashlib.blake2b(word.encode(), digest_size=2).digest()[0] & ((1 << bits) - 1)


def _coverage(value: bytes, dictionary: set) -> float:
    """Share of the characters that dictionary words cover, longest first from the left."""
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        for size in range(min(_LONG, len(low) - at), _SHORT - 1, -1):
            if low[at : at + size] in dictionary:
                covered += size
                at += size
                break
        else:
            at += 1
    return covered / len(low)


def features(value: bytes, path: str | None, assigned: bool, before, after, logp, dictionary) -> list[float]:
    kinds = _CLASS[np.frombuffer(value.lower(), np.uint8)]
    steps = logp[kinds[:-1], kinds[1:]] if len(kinds) > 1 else np.zeros(1)
    turns = float((np.diff(np.digitize(kinds, [26, 36])) != 0).mean()) if len(kinds) > 1 else 0.0
    _, n = np.unique(np.frombuffer(value, np.uint8), return_counts=True)
    share = n / n.sum()
    out = [
        float(len(value)), float(steps.mean()), float(steps.min()), turns, float(-(share * np.log2(share)).sum()),
        float((kinds < 26).mean()), float(((kinds >= 26) & (kinds < 36)).mean()),
        float(value != value.lower() and value != value.upper()), _coverage(value, dictionary), float(assigned),
        float(bool(set(before) & set(CREDENTIAL_WORDS))), float(bool(set(before) & set(HARMLESS_WORDS))),
    ]
    parts = [p for p in re.split(r"[^a-z]+", (path or "").lower()) if p]
    out.append(float(bool({"test", "tests", "example", "examples", "fixture", "docs", "sample"} & set(parts))))
    out.append(float((path or "").count("/")))
    place = [0.0] * (1 << PATH_BITS)
    for p in parts:
        place[_bucket(p, PATH_BITS)] = 1.0
    left, right = [0.0] * (1 << NEIGHBOUR_BITS), [0.0] * (1 << NEIGHBOUR_BITS)
    for side, near in ((left, before), (right, after)):
        for word in near[:NEIGHBOURS]:
            side[_bucket(word, NEIGHBOUR_BITS)] = 1.0
    return out + place + left + right


def with_features(findings: DataFrame, logp: np.ndarray, dictionary: list[str]) -> DataFrame:
    """Add the array column `features`."""
    shared = findings.sparkSession.sparkContext.broadcast((logp, {w.encode() for w in dictionary}))
    names = findings.columns
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in findings.schema.fields)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, words = shared.value
        for batch in batches:
            rows = batch.select(["value", "path", "assigned", "before", "after"]).to_pylist()
            made = [
                features(r["value"].encode(), r["path"], r["assigned"], r["before"] or [], r["after"] or [], table, words)
                for r in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.list_(pa.float64()))], [*names, "features"]
            )

    return findings.mapInArrow(add, f"{head}, features array<double>")


def label_findings(findings: DataFrame) -> DataFrame:
    """Findings with a `label` where a published rule settles it: 1 a secret, 0 none.

    Secret: an issued key's form, or letters and digits assigned to a credential name.
    No secret: digits only, a UUID, a placeholder, or a value next to a harmless word and
    not assigned to a credential name; with `features`, also a plain word of the dictionary.
    Others stay unlabelled and are left out.
    """
    value = F.col("value")
    issued = value.rlike(ISSUED.pattern.decode())
    fake = value.rlike(PLACEHOLDER.pattern.decode()) | value.rlike(UUID.pattern.decode())
    harmless = F.arrays_overlap("before", F.array(*[F.lit(w) for w in HARMLESS_WORDS])) & ~F.col("assigned")
    # As in prose: "the key: everyone agrees".
    plain = value.rlike("^[A-Z]?[a-z]+$") & (F.length("value") <= _LONG)
    plain &= (F.col("features")[8] == 1.0) if "features" in findings.columns else F.lit(False)
    mixed = value.rlike("[A-Za-z]") & value.rlike("[0-9]")
    label = (
        F.when(fake, 0).when(issued, 1).when(value.rlike("^[0-9+/=_-]+$") | plain, 0)
        .when(harmless, 0).when(F.col("assigned") & mixed, 1)
    )
    return findings.withColumn("label", label).filter("label is not null")


def train(labelled: DataFrame, limit: int = TRAINING_ROWS):
    """A forest from findings with `features` and `label`; None without both labels.

    At most `limit` rows are used, an even share of each label, chosen by the hash of the
    value, so the model is the same for any order of the rows.
    """
    order = F.xxhash64("value", "doc_id", "start")
    parts = [labelled.filter(F.col("label") == k).orderBy(order, "value").limit(limit // 2) for k in (0, 1)]
    rows = parts[0].unionByName(parts[1]).select(
        "label", array_to_vector("features").alias("vector"), order.alias("o"), "value"
    )
    rows = materialise(rows.withColumn("label", F.col("label").cast("double")), "findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=11, subsamplingRate=0.8
    )
    return forest.fit(rows.repartition(min(8, parallelism(rows.sparkSession)), "o").sortWithinPartitions("o", "value"))


def scan_secrets(
    documents: DataFrame, labelled: DataFrame | None = None, text: str = "text", path: str = "source"
) -> DataFrame:
    """Every candidate with the forest's verdict: `doc_id, start, length, value_sha256,
    value, assigned, score, is_secret`.

    `labelled` has columns of `find_candidates` and a 0/1 `label`; without it the corpus's
    own candidates are labelled by `label_findings`.  If the labels are all alike, the
    score is that label, and 0 if there are none.  Repeated documents have repeated
    findings; a null id or path is allowed.
    """
    logp, dictionary = corpus_statistics(documents, text)
    # Written in between: two Python functions in one stage would hold two workers a task.
    candidates = materialise(find_candidates(documents, text, path), "values")
    found = materialise(with_features(candidates, logp, dictionary), "candidates")
    known = label_findings(found) if labelled is None else with_features(labelled, logp, dictionary)
    model = train(known)
    if model is None:
        only = known.agg(F.max("label").alias("label")).first().label
        scored = found.withColumn("score", F.lit(float(only or 0)))
    else:
        scored = model.transform(found.withColumn("vector", array_to_vector("features"))).withColumn(
            "score", vector_to_array("probability")[1]
        )
    return scored.select(
        "doc_id", "start", "length", F.sha2("value", 256).alias("value_sha256"), "value", "assigned", "score",
        (F.col("score") > 0.5).alias("is_secret"),
    )


def redact(documents: DataFrame, findings: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """`documents` with the text of every finding that is a secret replaced by `mark`.

    A value is replaced wherever it was found.  Rows of equal id have their own texts and
    findings; a finding is applied only where its text stands.
    """
    spans = findings.filter("is_secret and doc_id is not null").select(
        "doc_id", F.struct("start", "length", "value").alias("s")
    )
    grouped = materialise(
        spans.groupBy("doc_id").agg(F.array_sort(F.collect_set("s")).alias("_spans")), "spans"
    )
    # Texts stay in place while the documents with secrets are few.
    joined = documents.join(F.broadcast(grouped) if few(grouped, 100_000) else grouped, "doc_id", "left")

    def cut(state, s):
        here = F.substring(F.col("text"), (s["start"] + 1).cast("int"), s["length"].cast("int")) == s["value"]
        piece = F.substring(
            F.col("text"), (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")
        )
        done = F.struct(
            F.concat(state["out"], piece, F.lit(mark)).alias("out"), (s["start"] + s["length"]).alias("at")
        )
        return F.when(here & (s["start"] >= state["at"]), done).otherwise(state)

    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    walked = F.aggregate("_spans", begin, cut)
    rest = F.substring(F.col("text"), (walked["at"] + 1).cast("int"), F.lit(2**31 - 1))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.concat(walked["out"], rest))
    return joined.withColumn("text", text).drop("_spans").select(*documents.columns)

"""The same results as SQL over the given tables, for the check against another engine."""

from __future__ import annotations

from corpusloom.catalog.queries import (
    ADAM_LR, ARRIVED, BATCH, BUCKETS, CAP, FEW_FILES, FILES, FROZEN, HEAD_LR, MAX_LENGTH, MINI_STEPS, PIECE_WORDS, PIECES, REUSE_LENGTH,
    SHORT_LENGTH, SMALL_BATCH, STEPS, SWEEP_FILES, SWEEP_SAMPLES, TEXT_DIM, TEXT_LR, VOCAB, WORLD,
)


def _clean(text: str) -> str:
    kept = rf"regexp_replace(coalesce({text}, ''), '[^\p{{L}}\p{{N}}_\s]', '', 'g')"
    return rf"trim(regexp_replace(lower({kept}), '\s+', ' ', 'g'))"


def _uniform(key: str, first: int = 1) -> str:
    return f"(('0x' || substr(md5('42:' || {key}::varchar), {first}, 8))::bigint / 4294967296::double)"


def _file(key: str, files: int = FILES) -> str:
    return f"floor({_uniform(key, 9)} * {files})::int"


def _number(value: str, places: int = 6) -> str:
    return f"round({value}, {places}) + 0.0::double"


def _with(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


LABELLED = """labelled AS (
  SELECT d.doc_id, d.text, l.quality AS label, CASE WHEN d.lang = 'en' THEN 'IMDB' ELSE 'SST-2' END AS source
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.lang IS NOT NULL)"""

CLEANED = f"""cleaned AS (
  SELECT * FROM (SELECT doc_id, {_clean('text')} AS text, label, source FROM labelled) WHERE length(text) >= 10)"""

_SPLIT = f"""CASE WHEN source = 'IMDB' AND {_uniform('doc_id')} < 0.8 THEN 'train'
  WHEN source = 'IMDB' THEN 'test' ELSE 'sst2' END"""

ROWS = f"rows_ AS (SELECT *, {_uniform('doc_id')} AS u, {_SPLIT} AS split FROM cleaned)"

CORPUS = f"""corpus AS (
  SELECT * FROM (SELECT doc_id, {_clean('text')} AS text FROM documents) WHERE length(text) >= 10)"""

COUNTS = """counts AS (
  SELECT token, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS token FROM corpus)
  WHERE token <> '' GROUP BY token)"""


def _top(name: str, source: str, size: int, first: int = 104) -> str:
    return f"""{name} AS (
  SELECT token, ({first - 1} + row_number() OVER (ORDER BY n DESC, token))::int AS id, n
  FROM (SELECT * FROM {source} ORDER BY n DESC, token LIMIT {size}))"""


VOCAB_CTES = (CORPUS, COUNTS, _top("vocab", "counts", VOCAB))


def _encoded(rows: str, room: int) -> str:
    return f"""words AS (
  SELECT doc_id, unnest(parts) AS token, generate_subscripts(parts, 1) AS pos
  FROM (SELECT doc_id, string_split(text, ' ')[1:{room}] AS parts FROM {rows})),
found AS (
  SELECT w.doc_id, list(coalesce(v.id, 100) ORDER BY w.pos) AS ids
  FROM words w LEFT JOIN vocab v ON w.token = v.token GROUP BY w.doc_id)"""


def _ids(length: int) -> str:
    return f"array_to_string(list_resize(list_concat([101], ids, [102]), {length}, 0), ',')"


def _mask(length: int) -> str:
    return f"array_to_string(list_resize(list_transform(range(len(ids) + 2), lambda i: 1), {length}, 0), ',')"


PIECE_CTES = (
    CORPUS, COUNTS, _top("whole", "counts", PIECE_WORDS),
    f"""cut AS (
  SELECT token AS word, n, s, unnest(range(1, length(token) - s + 2)) AS c
  FROM (SELECT token, n, unnest(range(1, length(token) + 1)) AS s FROM counts WHERE length(token) <= 100)),
further AS (
  SELECT token, sum(n)::bigint AS n
  FROM (SELECT CASE WHEN s = 1 THEN substr(word, s, c) ELSE '##' || substr(word, s, c) END AS token, n FROM cut)
  WHERE token NOT IN (SELECT token FROM whole) GROUP BY token)""",
    _top("further_top", "further", PIECES, 104 + PIECE_WORDS),
    "vocab AS (SELECT * FROM whole UNION ALL SELECT * FROM further_top)",
)

# The longest known piece at every place of every word, then the walk from the left.
WALK_CTES = (
    """spans AS (
  SELECT word, s, unnest(range(1, length(word) - s + 2)) AS c
  FROM (SELECT token AS word, unnest(range(1, length(token) + 1)) AS s FROM counts WHERE length(token) <= 100)),
steps AS (
  SELECT p.word, p.s, arg_max(p.piece, p.c) AS piece, arg_max(v.id, p.c) AS id, max(p.c) AS c
  FROM (SELECT word, s, c, CASE WHEN s = 1 THEN substr(word, s, c) ELSE '##' || substr(word, s, c) END AS piece
        FROM spans) p
  JOIN vocab v ON v.token = p.piece GROUP BY p.word, p.s)""",
    """walk(word, s, pieces, ids) AS (
  SELECT token, 1::bigint, []::varchar[], []::int[] FROM counts
  UNION ALL
  SELECT w.word, w.s + t.c, list_append(w.pieces, t.piece), list_append(w.ids, t.id)
  FROM walk w JOIN steps t ON t.word = w.word AND t.s = w.s)""",
    """split_words AS (
  SELECT c.token, c.n, coalesce(w.pieces, ['[UNK]']) AS pieces, coalesce(w.ids, [100]) AS ids
  FROM counts c LEFT JOIN walk w ON w.word = c.token AND w.s = length(c.token) + 1)""",
)

FILED = f"filed AS (SELECT doc_id, label, {_SPLIT} AS split, {_file('doc_id')} AS file FROM labelled)"


def _positions(rows: str) -> str:
    return f"""positions AS (
  SELECT split, file, (row_number() OVER (PARTITION BY split ORDER BY file) - 1)::int AS file_position,
    count(*) OVER (PARTITION BY split) AS files
  FROM (SELECT DISTINCT split, file FROM {rows}))"""


def _sharded(rows: str, drop: bool = False) -> str:
    if drop:
        shard = f"floor(file_position / greatest(1, floor(files / {WORLD})))"
        kept = f"shard < {WORLD}"
    else:
        shard = (f"CASE WHEN floor(files / {WORLD}) = 0 THEN {WORLD - 1} "
                 f"ELSE least({WORLD - 1}, floor(file_position / floor(files / {WORLD}))) END")
        kept = "true"
    return f"""{_positions(rows)},
sharded AS (
  SELECT * FROM (SELECT r.*, p.file_position, ({shard})::int AS shard
                 FROM {rows} r JOIN positions p ON r.split = p.split AND r.file = p.file) WHERE {kept})"""


def _numbered(size: int = BATCH) -> str:
    return f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY split, shard
    ORDER BY file_position, {_uniform('doc_id')}, doc_id) - 1 AS row_in_shard FROM sharded),
batched AS (SELECT *, (row_in_shard // {size})::bigint AS batch_id FROM numbered),
per_shard AS (SELECT split, shard, (count(*) // {size})::bigint AS batches FROM sharded GROUP BY ALL),
fewest AS (
  SELECT split, CASE WHEN count(*) < {WORLD} THEN 0 ELSE min(batches) END AS min_batches
  FROM per_shard GROUP BY split)"""


SHARDS = _with(LABELLED, FILED, _sharded("filed"), _numbered())
_BATCHED = "doc_id, split, shard, row_in_shard, batch_id"

# Two-class rows from embeddings, features with a bias of one, logits under weights w.
VECTOR_ROWS = f"""tagged AS (
  SELECT vec_id AS doc_id, embedding, label % 2 AS label,
    CASE WHEN label < 8 THEN 'IMDB' ELSE 'SST-2' END AS source FROM embeddings),
vectors AS (SELECT doc_id, embedding, label, {_SPLIT} AS split, {_file('doc_id')} AS file FROM tagged)"""

VECTORS = f"""{VECTOR_ROWS},
x AS (
  SELECT doc_id, label, split, 0 AS step, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) - 1 AS j
  FROM vectors
  UNION ALL SELECT doc_id, label, split, 0, 1.0::double, 64 FROM vectors)"""

# The same rows in the steps of batches sized so that the longest shard has `MINI_STEPS`.
_MINI_X = f"""sized AS (
  SELECT ceil(max(n) / {MINI_STEPS}::double)::bigint AS size
  FROM (SELECT count(*) AS n FROM numbered WHERE split = 'train' GROUP BY shard)),
stepped AS (SELECT n.*, (row_in_shard // size)::int AS step FROM numbered n, sized),
x AS MATERIALIZED (
  SELECT doc_id, label, split, step, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) - 1 AS j
  FROM stepped
  UNION ALL SELECT doc_id, label, split, step, 1.0::double, 64 FROM stepped)"""

FIXED_W = """w AS (
  SELECT k::int AS k, j::int AS j, ((7 * k + 3 * j) % 11 - 5) / 50::double AS w
  FROM range(2) a(k), range(65) b(j))"""


def _plain_w(name: str = "w", lr: float = HEAD_LR) -> str:
    return f"""{name} AS (
  SELECT k::int AS k, j, -{lr}::double * avg((0.5 - (label = k)::int) * x) AS w
  FROM x, range(2) a(k) WHERE split = 'train' GROUP BY k, j)"""


def _scored(name: str = "scored", weights: str = "w") -> str:
    return f"""{name}_z AS (
  SELECT doc_id, any_value(label) AS label, any_value(split) AS split,
    sum(x * w) FILTER (k = 0) AS z0, sum(x * w) FILTER (k = 1) AS z1
  FROM x JOIN {weights} w ON x.j = w.j GROUP BY doc_id),
{name} AS (
  SELECT *, greatest(z0, z1) + ln(exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1)))
      - CASE WHEN label = 0 THEN z0 ELSE z1 END AS loss,
    (z1 > z0)::int AS pred FROM {name}_z)"""


HEAD = _with(VECTORS, _plain_w(), _scored())
# Scored rows in their batches.
BATCHED_HEAD = _with(
    VECTORS, _plain_w(), _scored(), _sharded("vectors"), _numbered(),
    """rows_ AS (
  SELECT s.*, b.shard, b.batch_id FROM scored s JOIN batched b ON s.doc_id = b.doc_id)""",
    """batch_losses AS (
  SELECT split, batch_id, avg(loss) AS loss
  FROM (SELECT split, shard, batch_id, avg(loss) AS loss FROM rows_ GROUP BY ALL) GROUP BY ALL)""",
)
_GRADIENT = f"""p AS (
  SELECT doc_id, split, label, 1 / (1 + exp(z1 - z0)) AS p0, 1 / (1 + exp(z0 - z1)) AS p1 FROM scored),
g AS (
  SELECT k::int AS k, j::int AS j, avg((CASE WHEN k = 0 THEN p0 ELSE p1 END - (p.label = k)::int) * x) AS g
  FROM x JOIN p ON x.doc_id = p.doc_id, range(2) a(k) WHERE p.split = 'train' GROUP BY k, j)"""

_EVAL = """SELECT {epoch} AS epoch,
    CASE split WHEN 'test' THEN 'imdb_eval_' ELSE 'sst2_eval_' END || series AS series, value
  FROM (SELECT split, 'losses' AS series, avg(loss) AS value FROM {scored} WHERE split <> 'train' GROUP BY split
        UNION ALL SELECT split, 'acc', avg((pred = label)::int) FROM {scored} WHERE split <> 'train' GROUP BY split)"""


def _adam_w0(dim: int) -> str:
    return f"""w0 AS MATERIALIZED (
  SELECT k::int AS k, j::int AS j, ((7 * k + 3 * j) % 11 - 5) / 50::double AS w, 0::double AS m, 0::double AS v
  FROM range(2) a(k), range({dim + 1}) b(j))"""


def _training(epochs: int, lr: float, steps: int = 1, mask: str = "true") -> list[str]:
    """AdamW from w0 over x(doc_id, label, split, step, j, x), one set of tables per update;
    `trained` has the history, w<n> the state after n updates.  `mask` says which weights
    are trained."""
    ctes, parts = [], []
    for n in range(epochs * steps + 1):
        ctes.append(f"""z{n} AS MATERIALIZED (
  SELECT doc_id, any_value(label) AS label, any_value(split) AS split, any_value(step) AS step,
    sum(x * w) FILTER (k = 0) AS z0, sum(x * w) FILTER (k = 1) AS z1
  FROM x JOIN w{n} w ON x.j = w.j GROUP BY doc_id),
s{n} AS MATERIALIZED (
  SELECT *, greatest(z0, z1) + ln(exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1)))
      - CASE WHEN label = 0 THEN z0 ELSE z1 END AS loss, (z1 > z0)::int AS pred,
    1 / (1 + exp(z1 - z0)) AS p0, 1 / (1 + exp(z0 - z1)) AS p1 FROM z{n})""")
        epoch, step = divmod(n, steps)
        if n and step == 0:
            parts.append(_EVAL.format(epoch=epoch, scored=f"s{n}"))
        if n == epochs * steps:
            break
        taken = f"split = 'train' AND step = {step}"
        ctes.append(f"""g{n} AS (
  SELECT k::int AS k, x.j::int AS j, sum((CASE WHEN k = 0 THEN p0 ELSE p1 END - (s.label = k)::int) * x)
    / (SELECT count(*) FROM s{n} WHERE {taken}) AS g
  FROM x JOIN (SELECT doc_id, label, p0, p1 FROM s{n} WHERE {taken}) s ON x.doc_id = s.doc_id, range(2) a(k)
  GROUP BY ALL),
w{n + 1} AS MATERIALIZED (
  SELECT k, j, CASE WHEN {mask} THEN m ELSE 0 END AS m, CASE WHEN {mask} THEN v ELSE 0 END AS v,
    CASE WHEN {mask} THEN w * (1 - {lr}::double * 0.01)
      - {lr}::double * (m / (1 - 0.9::double ^ {n + 1})) / (sqrt(v / (1 - 0.999::double ^ {n + 1})) + 1e-8)
    ELSE w END AS w
  FROM (SELECT w.k, w.j, w.w, 0.9::double * w.m + 0.1::double * coalesce(g, 0) AS m,
          0.999::double * w.v + 0.001::double * coalesce(g, 0) * coalesce(g, 0) AS v
        FROM w{n} w LEFT JOIN g{n} g ON w.k = g.k AND w.j = g.j))""")
        parts.append(
            f"SELECT {epoch + 1} AS epoch, 'train_losses' AS series, avg(loss) AS value FROM s{n} WHERE {taken}"
        )
    losses = "\nUNION ALL ".join(parts)
    ctes.append(f"trained AS (SELECT epoch::int AS epoch, series, avg(value) AS value FROM ({losses}) GROUP BY ALL)")
    return ctes


# Prepared documents as sparse counts of hashed ids, with a bias, in batches of a step.
_TEXT_X = f"""batch_rows AS (
  SELECT b.doc_id, b.label, b.split, (b.batch_id % {STEPS})::int AS step FROM batched b),
x AS MATERIALIZED (
  SELECT r.doc_id, label, split, step, j, count(*)::double AS x
  FROM batch_rows r JOIN (SELECT doc_id, unnest(list_concat([101], ids, [102])) % {TEXT_DIM} AS j FROM found) i
    ON r.doc_id = i.doc_id GROUP BY ALL
  UNION ALL SELECT doc_id, label, split, step, {TEXT_DIM}, 1.0::double FROM batch_rows)"""

_SERIES = ("CASE split WHEN 'train' THEN 'train_losses' WHEN 'test' THEN 'imdb_eval_losses' "
           "ELSE 'sst2_eval_losses' END")


def _history(run: str, lr: float) -> tuple[str, ...]:
    return (
        _plain_w(f"w_{run}", lr), _scored(f"first_{run}", "w"), _scored(f"second_{run}", f"w_{run}"),
        f"""history_{run} AS (
  SELECT 1 AS epoch, {_SERIES} AS series, avg(loss) AS value FROM first_{run} GROUP BY split
  UNION ALL SELECT 2, {_SERIES}, avg(loss) FROM second_{run} GROUP BY split)""",
    )


def _loader(condition: str, source: str) -> str:
    return (f"SELECT d.doc_id, d.text, l.quality AS label, '{source}' AS source "
            f"FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE {condition}")


_IN, _OUT = _loader("d.lang = 'en'", "IMDB"), _loader("d.lang <> 'en'", "SST-2")

ORACLES = {
    "load_in_domain": _IN,
    "load_out_domain": _OUT,
    "concat_splits": f"{_IN} AND l.toxic = 0 UNION ALL {_IN} AND l.toxic = 1",
    "tag_and_union": f"{_IN} UNION ALL {_OUT}",
    "select_source": _OUT,
    "store_append_roundtrip": f"{_IN} UNION ALL {_OUT}",
    "store_append_run": f"SELECT *, 'in' AS run_id FROM ({_IN}) UNION ALL SELECT *, 'out' FROM ({_OUT})",
    "store_overwrite_named": _with(LABELLED, CLEANED) + "SELECT * FROM cleaned",
    "jsonl_sample": _with(LABELLED, CLEANED) + """
      SELECT * FROM (SELECT *, 'raw' AS stage FROM labelled ORDER BY doc_id LIMIT 200)
      UNION ALL SELECT * FROM (SELECT *, 'processed' AS stage FROM cleaned ORDER BY doc_id LIMIT 200)""",
    "parquet_roundtrip_counts": _with(
        LABELLED, CLEANED, ROWS, f"filed AS (SELECT *, {_file('doc_id')} AS file FROM rows_)", _positions("filed"),
    ) + f"""SELECT f.split, p.file_position, count(*) AS rows,
      sum(least(len(string_split(text, ' ')), {MAX_LENGTH - 2}) + 2)::bigint AS tokens,
      sum(label)::bigint AS positives
      FROM filed f JOIN positions p ON f.split = p.split AND f.file = p.file GROUP BY ALL""",
    "prepare_reuse": _with(LABELLED, CLEANED, ROWS, "sizes AS (SELECT split, count(*) AS n FROM rows_ GROUP BY split)") + f"""
      SELECT 'capped' AS request, false AS reused, split,
        least(n, CASE WHEN split = 'train' THEN {CAP} ELSE {int(CAP * 0.2)} END)::bigint AS rows, {REUSE_LENGTH} AS length
      FROM sizes
      UNION ALL SELECT 'full', false, split, n, {MAX_LENGTH} FROM sizes
      UNION ALL SELECT 'again', true, split, n, {MAX_LENGTH} FROM sizes""",
    "shard_rows_few_files": _with(LABELLED, CLEANED, ROWS) + f"""
      SELECT r::int AS rank, CASE WHEN r = {WORLD - 1} THEN (SELECT count(*) FROM rows_ WHERE split = 'train') ELSE 0 END
        AS rows FROM range({WORLD}) a(r)""",
    "keyless_corpus": f"""SELECT text, label, source, 2 * count(*) AS keys FROM ({_IN}) GROUP BY text, label, source""",
    "manifest_lookup": _with(
        LABELLED, f"splits AS (SELECT doc_id, {_SPLIT} AS split FROM labelled)",
        "runs AS (SELECT s.doc_id, d.source AS run_id, s.split FROM splits s JOIN documents d ON s.doc_id = d.doc_id)",
        "manifest AS (SELECT run_id, split, run_id || '/' || split AS path, max(doc_id) AS created_at, "
        "count(*) AS rows FROM runs GROUP BY ALL)",
    ) + """SELECT run_id, max(created_at) AS created_at, max(path) FILTER (split = 'train') AS train_path,
      max(path) FILTER (split = 'test') AS test_path, max(path) FILTER (split = 'sst2') AS sst2_path,
      sum(rows)::bigint AS rows FROM manifest GROUP BY run_id HAVING count(*) = 3""",
    "clean_text": f"""
      SELECT 'documents' AS kind, doc_id AS id, 0::bigint AS turn, {_clean('text')} AS text FROM documents
      UNION ALL SELECT 'benchmark', item_id, 0::bigint, {_clean('text')} FROM benchmark
      UNION ALL SELECT 'conversations', conv_id, turn, {_clean('text')} FROM conversations""",
    "clean_text_edge": f"""SELECT doc_id, text, length(text)::int AS chars FROM (
      SELECT d.doc_id, {_clean('b.text')} AS text FROM documents d LEFT JOIN benchmark b ON d.doc_id = b.item_id)""",
    "strip_punct": r"SELECT doc_id, regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g') AS text FROM documents",
    "min_length_clean": _with(CORPUS) + "SELECT * FROM corpus",
    "min_length_raw": "SELECT doc_id, text FROM documents WHERE length(text) >= 10",
    "build_vocab": _with(*VOCAB_CTES) + "SELECT * FROM vocab",
    "build_piece_vocab": _with(*PIECE_CTES) + "SELECT * FROM vocab",
    "encode_ids": _with(*VOCAB_CTES, _encoded("corpus", MAX_LENGTH - 2))
    + f"SELECT doc_id, {_ids(MAX_LENGTH)} AS input_ids FROM found",
    "encode_repeated_keys": _with(
        CORPUS, COUNTS, _top("vocab", "counts", VOCAB),
        """both_ AS (
  SELECT doc_id * 2 AS doc_id, text FROM corpus
  UNION ALL SELECT doc_id * 2 + 1, array_to_string(list_reverse(string_split(text, ' ')), ' ') FROM corpus)""",
        _encoded("both_", MAX_LENGTH - 2),
    ) + f"""SELECT form, doc_id // 2 AS doc_id, {_ids(MAX_LENGTH)} AS input_ids
      FROM found, (VALUES ('broadcast'), ('join')) f(form)""",
    "encode_truncation": _with(*VOCAB_CTES, _encoded("corpus", SHORT_LENGTH - 2))
    + f"""SELECT f.doc_id, (len(string_split(c.text, ' ')) > {SHORT_LENGTH - 2})::int AS truncated,
      {_ids(SHORT_LENGTH)} AS input_ids FROM found f JOIN corpus c ON f.doc_id = c.doc_id""",
    "attention_mask": _with(*VOCAB_CTES, _encoded("corpus", MAX_LENGTH - 2))
    + f"SELECT doc_id, {_mask(MAX_LENGTH)} AS attention_mask FROM found",
    "encoded_projection": _with(*VOCAB_CTES, LABELLED, CLEANED, _encoded("cleaned", MAX_LENGTH - 2))
    + f"""SELECT f.doc_id, c.source, c.label, {_ids(MAX_LENGTH)} AS input_ids, {_mask(MAX_LENGTH)} AS attention_mask
      FROM found f JOIN cleaned c ON f.doc_id = c.doc_id""",
    "wordpiece_words": _with(*PIECE_CTES, *WALK_CTES, recursive=True)
    + "SELECT token, n, array_to_string(pieces, ' ') AS pieces FROM split_words",
    "wordpiece_encode": _with(
        *PIECE_CTES, *WALK_CTES,
        f"""words AS (
  SELECT doc_id, unnest(parts) AS token, generate_subscripts(parts, 1) AS pos
  FROM (SELECT doc_id, string_split(text, ' ') AS parts FROM corpus)),
found AS (
  SELECT w.doc_id, flatten(list(s.ids ORDER BY w.pos))[1:{MAX_LENGTH - 2}] AS ids
  FROM words w JOIN split_words s ON w.token = s.token GROUP BY w.doc_id)""", recursive=True)
    + f"SELECT doc_id, {_ids(MAX_LENGTH)} AS input_ids FROM found",
    "seeded_shuffle": f"""SELECT doc_id, row_number() OVER (ORDER BY {_uniform('doc_id')}, doc_id) - 1 AS row_index
      FROM documents""",
    "hash_split": _with(LABELLED, CLEANED, ROWS) + f"SELECT doc_id, source, split, {_number('u', 9)} AS u FROM rows_",
    "split_counts": _with(LABELLED, CLEANED, ROWS)
    + "SELECT split, label, count(*) AS rows, round(avg(length(text)), 6) AS mean_chars FROM rows_ GROUP BY ALL",
    "sample_cap": _with(LABELLED, CLEANED, ROWS) + f"""SELECT doc_id, split, label, text FROM (
      SELECT *, row_number() OVER (PARTITION BY split ORDER BY u, doc_id) AS i FROM rows_)
      WHERE i <= CASE WHEN split = 'train' THEN {CAP} ELSE {int(CAP * 0.2)} END""",
    "prepare_increment": _with(*VOCAB_CTES, LABELLED, CLEANED, ROWS, _encoded("cleaned", MAX_LENGTH - 2))
    + f"""SELECT r.doc_id, r.split, r.label, {_ids(MAX_LENGTH)} AS input_ids, {_file('r.doc_id', BUCKETS)} AS bucket,
        CASE WHEN {_file('r.doc_id', BUCKETS)} IN (
          SELECT {_file('doc_id', BUCKETS)} FROM labelled WHERE {_uniform('doc_id')} >= {ARRIVED}) THEN 2 ELSE 1 END AS run
      FROM found f JOIN rows_ r ON f.doc_id = r.doc_id""",
    "sample_cap_stratified": _with(
        LABELLED, CLEANED, ROWS,
        f"""sizes AS (SELECT split, label, count(*) AS n FROM (SELECT label, {_SPLIT} AS split FROM labelled) GROUP BY ALL),
shares AS (
  SELECT split, label, n, sum(n) OVER (PARTITION BY split)::bigint AS total,
    least(sum(n) OVER (PARTITION BY split), CASE WHEN split = 'train' THEN {CAP} ELSE {int(CAP * 0.2)} END)::bigint AS cap
  FROM sizes),
parted AS (SELECT split, label, cap, (cap * n) // total AS base, (cap * n) % total AS rest FROM shares),
quotas AS (
  SELECT split, label, base + (row_number() OVER (PARTITION BY split ORDER BY rest DESC, label)
    <= cap - sum(base) OVER (PARTITION BY split))::int AS quota FROM parted)""",
    ) + """SELECT doc_id, split, label, text FROM (
      SELECT *, row_number() OVER (PARTITION BY split, label ORDER BY u, doc_id) AS i FROM rows_)
      JOIN quotas USING (split, label) WHERE i <= quota""",
    "partition_balance": f"""SELECT {_file('doc_id')} AS part, count(*) AS rows, sum(length(text))::bigint AS chars
      FROM documents GROUP BY ALL""",
    "shard_drop_remainder": _with(LABELLED, FILED, _sharded("filed", drop=True))
    + "SELECT doc_id, split, file_position, shard FROM sharded",
    "shard_last_takes_rest": SHARDS + "SELECT doc_id, split, file_position, shard FROM sharded",
    "batch_drop_last": SHARDS + f"""SELECT {_BATCHED} FROM batched JOIN per_shard USING (split, shard)
      WHERE batch_id < batches""",
    "batch_keep_last": SHARDS + f"SELECT {_BATCHED} FROM batched",
    "batch_few_files": _with(
        LABELLED, f"filed AS (SELECT doc_id, label, {_SPLIT} AS split, {_file('doc_id', FEW_FILES)} AS file FROM labelled)",
        _sharded("filed"), _numbered(),
    ) + f"SELECT {_BATCHED} FROM batched",
    "batches_per_shard": SHARDS + "SELECT split, shard, batches FROM per_shard",
    "min_batches": SHARDS + "SELECT split, min_batches FROM fewest",
    "batch_truncate": SHARDS + f"SELECT {_BATCHED} FROM batched JOIN fewest USING (split) WHERE batch_id < min_batches",
    "batch_by_length": _with(
        *VOCAB_CTES, LABELLED, CLEANED, ROWS, _encoded("cleaned", MAX_LENGTH - 2),
        f"""placed AS (
  SELECT r.doc_id, split, label, ids, len(ids) + 2 AS tokens,
    row_number() OVER (PARTITION BY split ORDER BY len(ids), u, r.doc_id) - 1 AS place
  FROM rows_ r JOIN found f ON r.doc_id = f.doc_id),
wide AS (SELECT *, place // {BATCH} AS batch_id, max(tokens) OVER (PARTITION BY split, place // {BATCH}) AS padded FROM placed)""",
    ) + f"""SELECT doc_id, split, label, tokens::int AS tokens, batch_id, (place % {BATCH})::int AS batch_row,
        padded::int AS padded, {_ids('padded')} AS input_ids FROM wide""",
    "head_init_loss": _with(VECTORS, FIXED_W, _scored())
    + f"SELECT doc_id, split, {_number('loss')} AS loss FROM scored",
    "gradient_step": _with(VECTORS, FIXED_W, _scored(), _GRADIENT)
    + f"SELECT k, j, {_number('g', 9)} AS gradient FROM g",
    "adamw_step": _with(VECTORS, FIXED_W, _scored(), _GRADIENT) + f"""
      SELECT k, j, {_number(f'w * (1 - {ADAM_LR}::double * 0.01) - {ADAM_LR}::double * g / (abs(g) + 1e-8)')} AS w,
        {_number('0.1::double * g', 9)} AS m, {_number('0.001::double * g * g', 9)} AS v, 1::bigint AS step
      FROM w JOIN g USING (k, j)""",
    "train_history": _with(VECTORS, _adam_w0(64), *_training(3, ADAM_LR))
    + f"SELECT 'vectors' AS run_id, epoch, series, {_number('value')} AS value FROM trained",
    "train_history_masked": _with(VECTORS, _adam_w0(64), *_training(3, ADAM_LR, mask=f"j >= {FROZEN}"))
    + f"SELECT 'masked' AS run_id, epoch, series, {_number('value')} AS value FROM trained",
    "train_history_text": _with(
        *VOCAB_CTES, LABELLED, CLEANED, _encoded("cleaned", MAX_LENGTH - 2), ROWS,
        f"filed AS (SELECT doc_id, label, split, {_file('doc_id')} AS file FROM rows_)", _sharded("filed"),
        _numbered(SMALL_BATCH), _TEXT_X, _adam_w0(TEXT_DIM), *_training(2, TEXT_LR, STEPS),
    ) + f"SELECT 'text' AS run_id, epoch, series, {_number('value')} AS value FROM trained",
    "train_history_minibatch": _with(
        VECTOR_ROWS, _sharded("vectors"), _numbered(), _MINI_X, _adam_w0(64), *_training(2, ADAM_LR, MINI_STEPS),
    ) + f"SELECT 'minibatch' AS run_id, epoch, series, {_number('value')} AS value FROM trained",
    "checkpoint_roundtrip": _with(VECTORS, _adam_w0(64), *_training(2, ADAM_LR))
    + f"""SELECT k, j, {_number('w')} AS w, {_number('m')} AS m, {_number('v')} AS v, 2::bigint AS step, true AS same
      FROM w2""",
    "resume_equals_straight": _with(VECTORS, _adam_w0(64), *_training(4, ADAM_LR))
    + f"SELECT epoch, series, {_number('value')} AS value, true AS same FROM trained",
    "run_metrics_append": _with(
        LABELLED, CLEANED, ROWS, "sizes AS (SELECT split, count(*) AS n FROM rows_ GROUP BY split)",
    ) + "\nUNION ALL ".join(
        f"""SELECT 'f{f}-s{s}' AS run_id, {s}::bigint AS samples, {f} AS files, 2::bigint AS stages, 1 AS timed,
      sum(least(n, CASE WHEN split = 'train' THEN {s} ELSE {int(s * 0.2)} END))::bigint AS rows FROM sizes"""
        for f in SWEEP_FILES for s in SWEEP_SAMPLES
    ),
    "latest_checkpoint": """SELECT run_id, path FROM (
      SELECT event_type AS run_id, 'state/' || event_type || '/' || event_id AS path,
        row_number() OVER (PARTITION BY event_type
          ORDER BY ts DESC, 'state/' || event_type || '/' || event_id DESC) AS i FROM events) WHERE i = 1""",
    "max_wall_time": """SELECT 'user-' || user_id AS run_id, event_type AS stage, max(value) AS seconds
      FROM events GROUP BY ALL""",
    "predict_argmax": HEAD + "SELECT doc_id, pred FROM scored",
    "accuracy": BATCHED_HEAD + f"""SELECT split, sum((pred = label)::int)::bigint AS correct, count(*) AS total,
      {_number('avg((pred = label)::int)')} AS accuracy FROM rows_ GROUP BY split""",
    "accuracy_per_shard": BATCHED_HEAD + f"""SELECT split, shard, sum((pred = label)::int)::bigint AS correct,
      count(*) AS total, {_number('avg((pred = label)::int)')} AS accuracy FROM rows_ GROUP BY split, shard""",
    "eval_loss": BATCHED_HEAD + f"""SELECT split, {_number('avg(loss)')} AS loss FROM batch_losses
      WHERE split <> 'train' GROUP BY split""",
    "epoch_train_loss": BATCHED_HEAD + f"""SELECT split, {_number('avg(loss)')} AS loss FROM batch_losses
      WHERE split = 'train' GROUP BY split""",
    "loss_per_shard": BATCHED_HEAD + f"SELECT split, shard, {_number('avg(loss)')} AS loss FROM rows_ GROUP BY ALL",
    "eval_by_dataset": HEAD + f"""SELECT split, count(*) AS rows, {_number('avg(loss)')} AS loss,
      {_number('avg((pred = label)::int)')} AS accuracy FROM scored GROUP BY split""",
    "eval_grouping_sets": BATCHED_HEAD + f"""SELECT split, shard, grouping(split, shard)::int AS level, count(*) AS rows,
      sum((pred = label)::int)::bigint AS correct, {_number('avg(loss)')} AS loss,
      {_number('avg((pred = label)::int)')} AS accuracy
      FROM rows_ GROUP BY GROUPING SETS ((split, shard), (split), ())""",
    "eval_auc": HEAD + f"""SELECT split, sum(label)::bigint AS positives, sum(1 - label)::bigint AS negatives,
      {_number('(sum(label * place) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label))')} AS auc
      FROM (SELECT split, label, rank() OVER (PARTITION BY split ORDER BY score)
              + (count(*) OVER (PARTITION BY split, score) - 1) / 2 AS place
            FROM (SELECT split, label::bigint AS label,
                    round(1e9 * CASE WHEN label = 1 THEN exp(-loss) ELSE 1 - exp(-loss) END)::bigint AS score FROM scored))
      GROUP BY split""",
    "prediction_listing": BATCHED_HEAD
    + """SELECT doc_id, split, shard, batch_id, pred, label, pred = label AS matched,
      row_number() OVER (PARTITION BY split ORDER BY batch_id, shard, doc_id) AS seen FROM rows_""",
    "loss_curves_long": _with(VECTORS, FIXED_W, *_history("a", 1.0))
    + f"SELECT epoch, series, {_number('value')} AS value FROM history_a",
    "history_rounded": _with(VECTORS, FIXED_W, *_history("a", 1.0), *_history("b", 0.5)) + f"""
      SELECT epoch, series, {_number('a.value', 4)} AS a, {_number('b.value', 4)} AS b
      FROM history_a a JOIN history_b b USING (epoch, series)""",
    "stream_encode": _with(*VOCAB_CTES, LABELLED, CLEANED, ROWS, _encoded("cleaned", MAX_LENGTH - 2))
    + f"""SELECT f.doc_id, r.label, r.split, {_ids(MAX_LENGTH)} AS input_ids
      FROM found f JOIN rows_ r ON f.doc_id = r.doc_id""",
    "stream_running_accuracy": BATCHED_HEAD + f"""SELECT split, shard, batch_id, correct, total,
        sum(correct) OVER so_far::bigint AS seen_correct, sum(total) OVER so_far::bigint AS seen,
        {_number('sum(correct) OVER so_far / sum(total) OVER so_far')} AS accuracy
      FROM (SELECT split, shard, batch_id, sum((pred = label)::int)::bigint AS correct, count(*) AS total
            FROM rows_ GROUP BY ALL)
      WINDOW so_far AS (PARTITION BY split, shard ORDER BY batch_id)""",
    "stream_append": _with(LABELLED, CLEANED, ROWS) + "SELECT doc_id, text, label, source, split FROM rows_",
}
ORACLES["encode_ids_join"] = ORACLES["encode_ids"]
ORACLES["stream_encode_join"] = ORACLES["stream_encode_grown"] = ORACLES["stream_encode"]
ORACLES["wordpiece_encode_join"] = ORACLES["wordpiece_encode"]

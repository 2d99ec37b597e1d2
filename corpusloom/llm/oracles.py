"""The SQL of the operators that are written out by rules rather than as one statement."""

from __future__ import annotations

_WHITE = r"\x20\x09-\x0D"


def _crc32(text: str) -> str:
    """The CRC-32 of an ASCII text, byte by byte and bit by bit."""
    bits = "lambda x, y: xor(x >> 1, 3988292384 * (x & 1))"
    each = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], {bits})"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {each}), 4294967295)"


def _lead(letter: str, cost: str, line: str | None, value: str) -> str:
    """One more edit in front of a value: nine digits of cost, letters, chr(1), repaired lines."""
    place = f"instr({value}, chr(1))"
    rest = f"substr({value}, {place} + 1)"
    said = rest if line is None else f"{line} || CASE WHEN {rest} = '' THEN '' ELSE chr(10) || {rest} END"
    return (
        f"lpad((substr({value}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{letter}' || "
        f"substr({value}, 10, {place} - 10) || chr(1) || {said}"
    )


# The state after each state, and the role that leads there.
_NEXT = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))


def conversation_repair() -> str:
    """Values of four states carried from the last row of each conversation to its first."""

    def row_value(s: int) -> str:
        after, role = _NEXT[s]
        kept = [f"WHEN initial = '{role[0]}' THEN {_lead('K', 'more', "role || ':' || text", f'v{after}')}"]
        if s == 0:
            kept.append(f"WHEN initial = 's' THEN {_lead('K', 'more', "role || ':' || text", 'v1')}")
        edits = [
            _lead("D", "3", None, f"v{s}"),
            f"CASE WHEN gone THEN NULL {' '.join(kept)} END",
            f"CASE WHEN NOT gone THEN {_lead('R', '(2 + more)', f"'{role}:' || text", f'v{after}')} END",
        ]
        return f"least({', '.join(edits)}) AS w{s}"

    def inserted(s: int, source: str) -> str:
        after, role = _NEXT[s]
        return f"least(w{s}, {_lead('I', '2', f"'{role}:'", f'{source}{after}')})"

    states = range(4)
    return f"""
WITH RECURSIVE src AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS d
  FROM conversations),
damaged AS (
  SELECT c, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM src),
placed AS (
  SELECT c, turn, role, text, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(c || chr(31) || role || chr(31) || text)) AS i
  FROM damaged),
heard AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS k FROM placed),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_WHITE}]') THEN 'blank' WHEN k > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][{_WHITE}]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY c ORDER BY i) AS before
  FROM heard),
edits AS (SELECT c, i, role, text, initial, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS more FROM faults),
all_convs AS (SELECT DISTINCT conv_id, c FROM src),
sizes AS (SELECT a.c, count(p.i) AS n FROM all_convs a LEFT JOIN placed p ON p.c = a.c GROUP BY a.c),
walk AS (
  SELECT c, n + 1 AS i, '000000000' || chr(1) AS v0, '000000004II' || chr(1) || 'user:' || chr(10) || 'assistant:' AS v1,
    '000000002I' || chr(1) || 'assistant:' AS v2, '000000000' || chr(1) AS v3
  FROM sizes
  UNION ALL
  SELECT c, i, {', '.join(f"{inserted(s, 'x')} AS v{s}" for s in states)} FROM (
    SELECT *, {', '.join(f"{inserted(s, 'w')} AS x{s}" for s in states)} FROM (
      SELECT e.c, e.i, {', '.join(row_value(s) for s in states)}
      FROM walk w JOIN edits e ON e.c = w.c AND e.i = w.i - 1) r) t),
best AS (SELECT c, v0 FROM walk WHERE i = 1),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (WHERE fault = 'blank')::BIGINT AS blank, count(*) FILTER (WHERE fault = 'duplicate')::BIGINT AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated')::BIGINT AS truncated,
    count(*) FILTER (WHERE i > 1 AND (before || initial) NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal
  FROM faults GROUP BY c)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, substr(v0, 1, 9)::BIGINT AS cost,
  substr(v0, 10, instr(v0, chr(1)) - 10) AS audit, sha256(substr(v0, instr(v0, chr(1)) + 1)) AS repaired_sha256
FROM all_convs a JOIN best b ON b.c = a.c LEFT JOIN counts n ON n.c = a.c
"""


def centroid_clusters(width: int = 64, clusters: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024) -> str:
    """Rounds written out one after another over vectors as whole numbers."""
    parts = [f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}),
c0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR) NULLS LAST, q) - 1)::INTEGER AS k, q AS c
  FROM kept QUALIFY k < {clusters}),
coords AS (SELECT r, unnest(range({width})) AS d, unnest(q) AS x FROM kept)"""]
    for n in range(rounds + 1):
        parts.append(f"""near{n} AS (
  SELECT r, arg_min(k, distance * 64 + k)::INTEGER AS cluster, min(distance)::BIGINT AS distance
  FROM (SELECT r, k, list_sum(list_transform(list_zip(q, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
    FROM kept, c{n}) GROUP BY r)""")
        if n < rounds:
            parts.append(f"""c{n + 1} AS (
  SELECT k, coalesce(m, c) AS c FROM c{n} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS m
    FROM (SELECT cluster, d, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM near{n} JOIN coords USING (r) GROUP BY cluster, d)
    GROUP BY cluster) ON cluster = k)""")
    return ",\n".join(parts) + f"""
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near{rounds} JOIN kept USING (r) JOIN c{rounds} ON k = cluster
"""

"""DuckDB SQL of the operators over conversations and vectors."""

from __future__ import annotations


def centroids_sql(size: int = 64, scale: int = 256, centroids: int = 40, rounds: int = 5, seed: int = 2) -> str:
    """Every round computes all distances anew."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda v: floor({scale} * v::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = {size}
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS cluster, x
  FROM kept QUALIFY cluster < {centroids})"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT n, vec_id, v.x AS x, min((list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))),
         c.cluster)) AS best
  FROM kept v CROSS JOIN c{r} c GROUP BY n, vec_id, v.x)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
  SELECT cluster, list(moved ORDER BY place) AS x
  FROM (SELECT best[2] AS cluster, place, floor(sum(x[place])::DOUBLE / count(*))::BIGINT AS moved
        FROM a{r} CROSS JOIN range(1, {size + 1}) AS places(place) GROUP BY ALL) GROUP BY cluster),
c{r + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (cluster))""")
    return f"""WITH {', '.join(steps)}
SELECT vec_id, best[2]::INTEGER AS cluster, best[1]::BIGINT AS distance,
       sum(best[1]) OVER (PARTITION BY best[2])::BIGINT AS cluster_inertia, sum(best[1]) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.cluster = best[2]"""


def _least(*stacks: str) -> str:
    return f"least({', '.join(stacks)})"


def _after(stack: str, cost: str, letter: str) -> str:
    return f"{{'c': {stack}.c + {cost}, 'a': {stack}.a || '{letter}'}}"


def _inserted(columns: str, source: str) -> str:
    """The four stacks (start, system, pair, user on top) after any insertions."""
    with_user = _least("s3", *(_after(s, "2", "I") for s in ("s0", "s1", "s2")))
    with_pair = f"SELECT {columns}, s0, s1, s2, {with_user} AS s3 FROM ({source})"
    return f"SELECT {columns}, s0, s1, {_least('s2', _after('s3', '2', 'I'))} AS s2, s3 FROM ({with_pair})"


def conversations_sql() -> str:
    """Damage, faults and the cheapest repair, row by row over the four possible tops of the parse."""
    bits = "list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    none = "{'c': 1000000000000, 'a': ''}"
    extra = "CASE WHEN fault = 't' THEN 1 ELSE 0 END"
    before_user = _least("s0", "s1", "s2")

    def to(top: str, letter: str, stack: str) -> str:
        options = [_after(top, "3", "D")]
        free = "fault NOT IN ('b', 'd')"
        options.append(f"CASE WHEN {free} AND initial = '{letter}' THEN {_after(stack, extra, 'K')} ELSE {none} END")
        if letter != "s":
            options.append(f"CASE WHEN {free} THEN {_after(stack, f'2 + {extra}', 'R')} ELSE {none} END")
        return _least(*options)

    step = f"""SELECT r.g, r.n, {_after('s0', '3', 'D')} AS s0, {to('s1', 's', 's0')} AS s1, {to('s2', 'a', 's3')} AS s2,
      {to('s3', 'u', before_user)} AS s3 FROM p JOIN r ON r.g = p.g AND r.n = p.n + 1"""
    start = f"SELECT DISTINCT g, 0::BIGINT AS n, {{'c': 0::BIGINT, 'a': ''}} AS s0, {none} AS s1, {none} AS s2, {none} AS s3 FROM r"
    return f"""WITH RECURSIVE crc AS (
  SELECT list(xor({bits}, 0) ORDER BY i) AS t FROM range(256) AS r(i)),
marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda z: ord(z)::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS damage
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE damage WHEN 3 THEN 2 WHEN 0 THEN 0 ELSE 1 END)) AS copy
  FROM marked),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n,
         dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, left(role, 1) AS initial,
         regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) AS last_mark
  FROM damaged),
r AS MATERIALIZED (
  SELECT *, CASE WHEN last_mark = '' THEN 'b'
                 WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY n) > 1 THEN 'd'
                 WHEN last_mark NOT IN ('.', '!', '?') THEN 't' ELSE '.' END AS fault,
         lag(initial) OVER (PARTITION BY g ORDER BY n) || initial AS pair
  FROM placed),
p AS (
  {_inserted('g, n', start)}
  UNION ALL
  {_inserted('g, n', step)}),
counted AS (
  SELECT g, any_value(conv_id) AS conv_id, count(*) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY g),
best AS MATERIALIZED (
  SELECT counted.*, {_least('s0', 's2')} AS best FROM counted JOIN p USING (g, n)),
letters AS (
  SELECT g, best.a[i] AS letter, i,
         len(regexp_replace(best.a[:i], 'I', '', 'g')) AS n, len(regexp_replace(best.a[:i], 'D', '', 'g')) AS place
  FROM best, range(1, len(best.a) + 1) AS places(i)),
turns AS (
  SELECT letters.g, place, letter, r.role, r.text,
         max(CASE WHEN place = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY letters.g) AS head
  FROM letters LEFT JOIN r ON r.g = letters.g AND r.n = letters.n AND letter <> 'I'
  WHERE letter <> 'D'),
texts AS (
  SELECT g, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - head) % 2 = 1 THEN 'user' ELSE 'assistant' END
                              || ':' || coalesce(text, ''), chr(10) ORDER BY place)) AS sha
  FROM turns GROUP BY g)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts USING (g)"""

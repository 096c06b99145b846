"""SQL (DuckDB dialect) of the operators whose results take more than a few lines to express."""

from __future__ import annotations


def vector_codes_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Lloyd's rounds as one view of entries and one of assignments after the other."""
    views = [
        f"""kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
          [CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"""parts AS MATERIALIZED (SELECT r, vec_id, p, len(v) // {parts} AS w,
          v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) t(p))""",
        f"""entries0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY r) - 1 AS e, x AS c
          FROM parts QUALIFY e < {entries})""",
    ]
    for i in range(rounds + 1):
        views.append(
            f"""assigned{i} AS MATERIALIZED (SELECT r, vec_id, p, any_value(w) AS w, any_value(x) AS x,
              min((d, e)) AS best FROM (SELECT r, vec_id, p, w, x, e, CAST(list_sum([(x[i] - c[i]) * (x[i] - c[i])
              FOR i IN range(1, w + 1)]) AS BIGINT) AS d FROM parts JOIN entries{i} USING (p)) GROUP BY r, vec_id, p)"""
        )
        if i < rounds:
            views.append(
                f"""entries{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, o.c) AS c FROM entries{i} o LEFT JOIN (
                  SELECT p, e, list((s - ((s % n + n) % n)) // n ORDER BY i) AS c FROM (
                    SELECT p, best[2] AS e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n
                    FROM (SELECT p, best, x, unnest(range(1, w + 1)) AS i FROM assigned{i}) GROUP BY 1, 2, 3)
                  GROUP BY p, e) m USING (p, e))"""
            )
    views.append(
        f"""coded AS (SELECT r, vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code,
          CAST(sum(best[1]) AS BIGINT) AS error FROM assigned{rounds} GROUP BY r, vec_id)"""
    )
    views.append(
        f"""books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS digest
          FROM (SELECT p, e, unnest(c) AS x, unnest(range(1, len(c) + 1)) AS i FROM entries{rounds}))"""
    )
    return f"""WITH {", ".join(views)}
SELECT c.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  digest AS codebooks_sha256 FROM coded c JOIN kept USING (r) CROSS JOIN books"""


def embedding_dedup_sql(cosine: float) -> str:
    """Every pair compared, and everything that links reach."""
    return f"""
WITH RECURSIVE fine AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {cosine}),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, lowest) AS component_id, least(vec_id, lowest) = vec_id AS kept
FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
  LEFT JOIN (SELECT a AS vec_id, min(b) AS lowest FROM reached GROUP BY a) USING (vec_id)"""


def _hashed(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


# CRC-32 of an id's decimal text, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))))"""


def _tree_sql(name: str, leaves: str) -> str:
    """Nodes of all levels, and the runs of 16 that become one."""
    return f"""
{name}(lvl, g, pos, total, d) AS (SELECT 0, g, pos, total, d FROM {leaves} UNION ALL
  SELECT lvl + 1, g, pos // 16, (total + 15) // 16, sha256(string_agg(d, '' ORDER BY pos)) FROM {name}
  WHERE total > 1 GROUP BY lvl, g, pos // 16, total),
{name}_runs AS MATERIALIZED (SELECT lvl, g, pos // 16 AS up, list(d ORDER BY pos) AS ds FROM {name}
  WHERE total > 1 GROUP BY ALL)"""


def _walk_sql(name: str, start: str, tree: str) -> str:
    """From a leaf to the root: the node on the way, and the siblings so far."""
    return f"""
{name}(r, lvl, g, pos, total, d, siblings) AS (SELECT r, 0, g, pos, total, d, siblings FROM {start} UNION ALL
  SELECT r, n.lvl + 1, n.g, pos // 16, (total + 15) // 16,
    sha256(array_to_string(ds[1 : pos % 16], '') || d || array_to_string(ds[pos % 16 + 2 :], '')),
    siblings || array_to_string(ds[1 : pos % 16], '') || array_to_string(ds[pos % 16 + 2 :], '')
  FROM {name} n JOIN {tree}_runs t ON t.lvl = n.lvl AND t.g = n.g AND t.up = pos // 16 WHERE total > 1)"""


def merkle_sql() -> str:
    leaf = "sha256(" + " || ".join(_hashed(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    changed = "sha256(" + " || ".join(
        [*(_hashed(c) for c in ("doc_id", "source", "lang", "n_chars")), _hashed(lower)]
    ) + ")"
    return f"""
WITH RECURSIVE leaf AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS g, {leaf} AS d,
  CASE WHEN {_CRC} % 5 = 0 THEN {changed} ELSE {leaf} END AS altered FROM documents),
leaves AS MATERIALIZED (SELECT *, row_number() OVER () AS r,
  row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS pos,
  count(*) OVER (PARTITION BY g) AS total FROM leaf),
{_tree_sql("nodes", "leaves")},
subroots AS MATERIALIZED (SELECT g AS key, '' AS g, d, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS total
  FROM nodes WHERE total = 1),
{_tree_sql("tops", "subroots")},
own AS (SELECT r, g, pos, total, altered AS d, '' AS siblings FROM leaves),
{_walk_sql("climb", "own", "nodes")},
over AS (SELECT r, s.g, s.pos, s.total, c.d, siblings FROM climb c JOIN subroots s ON s.key = c.g WHERE c.total = 1),
{_walk_sql("finish", "over", "tops")}
SELECT doc_id, l.d AS leaf, s.d AS subroot, t.d AS root, sha256(siblings) AS proof_sha256, f.d AS folded_root,
  f.d = t.d AS verified
FROM leaves l JOIN subroots s ON s.key = l.g JOIN finish f ON f.r = l.r AND f.total = 1
CROSS JOIN (SELECT d FROM tops WHERE total = 1) t"""

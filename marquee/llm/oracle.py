"""DuckDB SQL for the ``opN_`` queries that SQL can express, whole tables."""

from __future__ import annotations

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


def mixing_sql() -> str:
    """Budgets in closed form: sources in order of size / weight stop at twice
    their size as long as the next share would be above it."""
    return f"""
WITH d AS (
    SELECT doc_id, source, coalesce(len({WORDS}), 0)::BIGINT AS size,
           md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key
    FROM documents
),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
    FROM d GROUP BY source
),
o AS (
    SELECT *, sum(source_size) OVER () AS every, sum(w) OVER () AS ws,
           coalesce(sum(2 * source_size) OVER before, 0) AS held, coalesce(sum(w) OVER before, 0) AS gone,
           row_number() OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST) AS place
    FROM s
    WINDOW before AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
f AS (
    SELECT held, gone FROM o WHERE (3 * every - 2 * held) * w <= 2 * (2 * source_size) * (ws - gone)
    ORDER BY place LIMIT 1
),
t AS (
    SELECT o.source, o.source_size,
           CASE WHEN 2 * (2 * o.source_size) * (o.ws - f.gone) < (3 * o.every - 2 * f.held) * o.w
                THEN (2 * o.source_size)::DOUBLE
                ELSE (3 * o.every - 2 * f.held)::DOUBLE * o.w / (2 * (o.ws - f.gone))::DOUBLE END AS target
    FROM o, f
),
r AS (
    SELECT d.doc_id, d.source, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
           (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, source,
       (CASE WHEN source_size > 0
             THEN budget // source_size * size + least(greatest(budget % source_size - before, 0), size)
             ELSE 0 END)::BIGINT AS taken
FROM r
"""


def centroids_sql(k: int = 16, rounds: int = 3, width: int = 64) -> str:
    def distance(a: str, b: str) -> str:
        return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

    out = [
        f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e
    FROM embeddings
    WHERE len(embedding) = {width} AND list_count(embedding) = {width}
      AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = {width}
),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY code) - 1 AS c, e
    FROM (SELECT sha256('1:' || vec_id::VARCHAR) AS code, e FROM v ORDER BY code LIMIT {k})
)"""
    ]
    for r in range(rounds + 1):
        out.append(f"""
a{r} AS MATERIALIZED (
    SELECT rid, min([{distance("v.e", "m.e")}, m.c]) AS near FROM v, c{r} AS m GROUP BY rid
)""")
        if r < rounds:
            out.append(f"""
c{r + 1} AS MATERIALIZED (
    SELECT m.c, coalesce(n.e, m.e) AS e FROM c{r} AS m LEFT JOIN (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS e FROM (
            SELECT a.near[2] AS c, u.i, sum(v.e[u.i])::BIGINT AS s, count(*) AS n
            FROM v JOIN a{r} AS a USING (rid), range(1, {width + 1}) AS u(i) GROUP BY 1, 2
        ) GROUP BY c
    ) AS n ON n.c = m.c
)""")
    out.append(f"""
named AS (SELECT c, sha256(array_to_string(e, ',')) AS centroid_sha256 FROM c{rounds}),
p AS (SELECT v.vec_id, a.near[2]::INTEGER AS cluster, a.near[1]::BIGINT AS distance FROM v JOIN a{rounds} AS a USING (rid))
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM p JOIN named ON named.c = p.cluster
""")
    head, *rest = out
    return ",".join([head, *rest])


def _windows(words: str, size: str) -> str:
    """One struct (k, win) per run of ``size`` words: its place, from 1, and its words."""
    run = f"array_to_string({words}[k:k + {size} - 1], ' ')"
    return f"unnest(list_transform(range(1, len({words}) - {size} + 2), lambda k: {{'k': k, 'win': {run}}}))"


def rules_sql() -> str:
    """The measurements and the mask of the six rules, in their bits' order."""
    return f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce({WORDS}, []) AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents
),
x AS MATERIALIZED (SELECT rid, {_windows("w", "5")} AS s FROM d WHERE len(w) >= 5),
r AS (SELECT rid, s.k AS k, count(*) OVER (PARTITION BY rid, s.win) AS n FROM x),
c AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest(range(k, k + 5)) AS p FROM r WHERE n > 1) GROUP BY rid),
m AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           len(lines) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
    FROM d LEFT JOIN c USING (rid)
),
f AS (
    SELECT *, ((n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT
        + 8 * (100 * n_dup_lines > 40 * n_lines)::BIGINT + 16 * (100 * n_capitals > 30 * word_chars)::BIGINT
        + 32 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT)::BIGINT AS failed
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed
FROM f
"""


def phrases_sql() -> str:
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
x AS MATERIALIZED (SELECT doc_id, {_windows("w", "13")} AS s FROM d WHERE len(w) >= 13),
f AS (SELECT s.win AS win, min(doc_id) AS first FROM x GROUP BY 1),
h AS (SELECT DISTINCT doc_id, p FROM (SELECT x.doc_id, unnest(range(x.s.k, x.s.k + 13)) AS p FROM x JOIN f ON f.win = x.s.win WHERE f.first < x.doc_id)),
g AS (SELECT doc_id, list(p) AS gone FROM h GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(w, lambda v, i: NOT list_contains(coalesce(gone, []), i)), ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""


def jaccard_sql() -> str:
    """Links by counting shared shingles of every pair that shares one, then all
    documents reachable from each."""
    words = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, coalesce({words}, []) AS w FROM documents),
s AS MATERIALIZED (
    SELECT DISTINCT doc_id, s.win AS t FROM (
        SELECT doc_id, {_windows("w", "least(5, len(w))")} AS s FROM d WHERE len(w) > 0
    )
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n, sha256(string_agg(t, chr(10) ORDER BY t)) AS code FROM s GROUP BY doc_id),
link AS MATERIALIZED (
    SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS met FROM s x JOIN s y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
    JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * met >= 80 * (na.n + nb.n - met)
),
reach AS (
    SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       coalesce(min(d.doc_id) OVER (PARTITION BY coalesce(n.code, d.doc_id::VARCHAR)), d.doc_id) AS class_id, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""


def winnowing_sql() -> str:
    words = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce({words}, []) AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item_id, {words} AS w FROM benchmark),
iw AS MATERIALIZED (SELECT DISTINCT item_id, least(10, len(w)) AS size, s.win AS win FROM (
    SELECT item_id, w, {_windows("w", "least(10, len(w))")} AS s FROM i WHERE len(w) > 0)),
z AS (SELECT DISTINCT size FROM iw),
x AS MATERIALIZED (SELECT rid, size, {_windows("w", "size")} AS s FROM d JOIN z ON len(w) >= size),
h AS MATERIALIZED (SELECT rid, x.size, x.s.k AS k, item_id FROM x JOIN iw ON iw.size = x.size AND iw.win = x.s.win),
c AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + size)) AS p FROM h) GROUP BY rid),
t AS (SELECT rid, list_sort(list(DISTINCT item_id)) AS items FROM h GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""


SQL: dict[str, str] = {
    "op2_rule_ledger": rules_sql(),
    "op8_phrases": phrases_sql(),
    "op9_jaccard": jaccard_sql(),
    "op10_winnowing": winnowing_sql(),
    "op11_mixing": mixing_sql(),
    "op12_centroids": centroids_sql(),
}

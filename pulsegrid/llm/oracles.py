"""DuckDB SQL of the training-data queries whose whole result SQL can state.

The others have columns beyond it: record ids hashed from archive offsets (op3),
CRC-32 (op5, op10), look-around patterns (op6), fitted models (op7, op8), seeded
64-bit hashes (op13).
"""

from __future__ import annotations

from pulsegrid.llm import codes
from pulsegrid.llm.audit import steps
from pulsegrid.llm.secrets import BASE_RULES, RULES, Rule

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACE = r"[^\x20\x09-\x0D]+"


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _kind_spans(rank: int, rule: Rule) -> str:
    """(rid, start, rank, stop, kind) of one rule: a match starts after all pieces and matches before it."""
    pattern = _literal(rule.pattern)
    return f"""
SELECT rid, start, {rank} AS rank, start + length(hits[i]) AS stop, '{rule.kind}' AS kind
FROM (SELECT rid, hits, parts, i,
             list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda h: length(h))), 0) AS start
      FROM (SELECT rid, hits, parts, gaps, unnest(range(1, len(hits) + 1)) AS i
            FROM (SELECT rid, regexp_extract_all(body, {pattern}, 0) AS hits, regexp_extract_all(body, {pattern}, {rule.group}) AS parts,
                         string_split_regex(body, {pattern}) AS gaps FROM d)))
WHERE length(parts[i]) >= {rule.least}"""


def _secrets() -> str:
    base = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
    joined = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank){}, '')"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
s AS ({" UNION ALL ".join(_kind_spans(i, r) for i, r in enumerate(RULES))})
SELECT doc_id, {counts}, sha256({joined.format(f" FILTER (kind IN ({base}))")}) AS base_sha256, {joined.format("")} AS spans
FROM d LEFT JOIN s USING (rid) GROUP BY rid, doc_id"""


_DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 10) AS k FROM (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i+k-1], ' ') AS win FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
dw AS (SELECT rid, k, i, array_to_string(w[i:i+k-1], ' ') AS win
       FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM b) WHERE len(w) >= k)),
h AS (SELECT rid, k, i, item_id FROM dw JOIN bw USING (k, win)),
words AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS pos FROM h) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM h) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""

# Copies are one set, so they never become pairs.
_NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACE}') AS w FROM documents),
e AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                          ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')))) END AS s FROM d),
c AS (SELECT s, len(s) AS n, min(doc_id) AS cid FROM e WHERE len(s) > 0 GROUP BY s),
x AS (SELECT cid, n, unnest(s) AS shingle FROM c),
p AS (SELECT a.cid AS a, b.cid AS b, any_value(a.n) + any_value(b.n) - count(*) AS total, count(*) AS both
      FROM x a JOIN x b ON a.shingle = b.shingle AND a.cid <> b.cid AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
r AS (SELECT cid AS u, cid AS v FROM c UNION SELECT r.u, p.b FROM r JOIN p ON r.v = p.a AND 100 * p.both >= 80 * p.total),
comp AS (SELECT u AS cid, min(v) AS component_id FROM r GROUP BY u)
SELECT doc_id, len(e.s) AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM e LEFT JOIN c ON e.s = c.s LEFT JOIN comp USING (cid)"""

_TOP_K = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.rid <> c.rid)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""



def _audit() -> str:
    orders = ", ".join(f"('{s['filter_order']}', {s['step']}, {s['bit']}, {s['before']})" for s in steps())
    total = "coalesce(sum({}) FILTER ({}), 0)::BIGINT"
    fails, here = "bits & bit <> 0", "bits & bit <> 0 AND bits & before = 0"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
w AS (SELECT *, regexp_extract_all(body, '{_SPACE}') AS words FROM d),
f AS (SELECT doc_id, part, CASE WHEN len(words) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN min(doc_id) OVER (PARTITION BY body) < doc_id THEN 16 ELSE 0 END AS bits FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
m AS (SELECT part, bits, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM f LEFT JOIN l USING (doc_id) GROUP BY part, bits),
s(filter_order, step, bit, before) AS (VALUES {orders})
SELECT part, filter_order, step::INTEGER AS step, {total.format("n", "bits & (before | bit) = 0")} AS kept, {total.format("n", here)} AS removed,
       {total.format("n", "bits & bit <> 0 AND bits & before <> 0")} AS redundant, {total.format("n", "bits = bit")} AS unique_fails,
       {total.format("good", here)} AS good_lost, {total.format("bad", here)} AS toxic_lost,
       {total.format("n * (120 // greatest(bit_count(bits), 1))", fails)} AS shapley
FROM m, s GROUP BY part, filter_order, step, bit, before"""


def _codes() -> str:
    """The rounds one after another; floor(sum / count) is written with remainders, as integer division cuts towards zero."""
    width = f"(len(v) // {codes.PARTS})"
    assigned = """SELECT rid, position, x, least_of[1] AS far, least_of[2] AS entry
FROM (SELECT rid, p.position, any_value(p.x) AS x, min([list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, c.entry]) AS least_of
      FROM p JOIN c{r} c ON p.position = c.position GROUP BY rid, p.position)"""
    moved = """SELECT c.position, c.entry, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
  SELECT position, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x
  FROM (SELECT position, entry, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM (SELECT position, entry, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY ALL) GROUP BY position, entry) m
  ON c.position = m.position AND c.entry = m.entry"""
    rounds = ",\n".join(f"a{r} AS MATERIALIZED ({assigned.format(r=r)}),\nc{r + 1} AS MATERIALIZED ({moved.format(r=r)})" for r in range(codes.ROUNDS))
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)),
p AS MATERIALIZED (SELECT rid, position, v[position * {width} + 1 : (position + 1) * {width}] AS x FROM (SELECT rid, v, unnest(range({codes.PARTS})) AS position FROM k)),
c0 AS MATERIALIZED (SELECT position, row_number() OVER (PARTITION BY position ORDER BY vec_id) - 1 AS entry, x FROM p JOIN (SELECT rid, vec_id FROM k ORDER BY vec_id LIMIT {codes.ENTRIES}) USING (rid)),
{rounds},
a AS ({assigned.format(r=codes.ROUNDS)}),
e AS (SELECT rid, string_agg(format('{{:02x}}', entry), '' ORDER BY position) AS code, sum(far)::BIGINT AS error FROM a GROUP BY rid),
h AS (SELECT sha256(string_agg(v, ',' ORDER BY position, entry, i)) AS codebooks_sha256
      FROM (SELECT position, entry, i, x[i]::VARCHAR AS v FROM (SELECT position, entry, x, unnest(range(1, len(x) + 1)) AS i FROM c{codes.ROUNDS})))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM k JOIN e USING (rid), h"""


ORACLES = {
    "op1_secret_scan": _secrets(),
    "op2_decontamination": _DECONTAMINATION,
    "op4_near_duplicates": _NEAR_DUPLICATES,
    "op9_max_score": _TOP_K,
    "op11_filter_audit": _audit(),
    "op12_vector_codes": _codes(),
}

"""DuckDB statements of the numbered queries that SQL can express on whole tables."""

from __future__ import annotations

from tontine.llm.license_scan import templates

_OP1 = """
WITH RECURSIVE good AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
          AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS c FROM reach GROUP BY a), n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, c AS component_id, e.vec_id = c AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN n USING (vec_id)
"""

_OP2 = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM docs, unnest(range(1, len(w) - 11)) AS t(i)),
later AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS least FROM windows) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, j FROM later, unnest(range(i, i + 13)) AS t(j)),
words AS (SELECT doc_id, j, w[j] AS word FROM docs, unnest(range(1, len(w) + 1)) AS t(j)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS body FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

_OP5 = r"""
WITH given AS (SELECT conv_id, turn, role AS speaker, coalesce(text, '') AS body FROM conversations),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, speaker NULLS LAST, body) - 1 AS seq FROM given),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM given WHERE speaker <> 'system'),
roles AS (SELECT n.*, perspective, CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS r
          FROM numbered n JOIN people p ON n.conv_id IS NOT DISTINCT FROM p.conv_id),
heads AS (SELECT *, '<|im_start|>' || r || CASE WHEN r = 'user' AND speaker IS NOT NULL THEN ' name=' || speaker ELSE '' END || chr(10) AS head FROM roles),
messages AS (SELECT *, head || body || '<|im_end|>' || chr(10) AS message FROM heads),
placed AS (SELECT *, CAST(coalesce(sum(length(message)) OVER (PARTITION BY conv_id, perspective ORDER BY seq
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS p FROM messages)
SELECT conv_id, perspective, seq, turn, r AS role, CASE WHEN r = 'user' THEN speaker END AS name, message, p AS start,
       p + length(message) AS "end", CASE WHEN r = 'assistant' THEN p + length(head) END AS train_start,
       CASE WHEN r = 'assistant' THEN p + length(message) END AS train_end
FROM placed
"""

_OP8 = r"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
             FROM docs, unnest(range(1, greatest(len(w) - 3, least(len(w) + 1, 2)))) AS t(i)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
          JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM docs d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) m USING (doc_id)
"""

_OP12 = r"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
              min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
marks AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good, max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic
          FROM labels GROUP BY doc_id),
failed AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN least < doc_id THEN 'E' ELSE '' END AS fails
           FROM docs LEFT JOIN marks USING (doc_id)),
counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, k AS step, o[k] AS f, o[1:k - 1] AS before FROM orders, unnest(range(1, 6)) AS t(k)),
placed AS (SELECT part, o, step, f, n, good, toxic, contains(fails, f) AS bad, length(translate(before, fails, '')) < length(before) AS gone,
       fails = f AS alone FROM counted, steps),
summed AS (SELECT part, o AS filter_order, step, f, coalesce(sum(n) FILTER (NOT bad AND NOT gone), 0) AS kept,
           coalesce(sum(n) FILTER (bad AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (bad AND gone), 0) AS redundant,
           coalesce(sum(n) FILTER (alone), 0) AS unique_fails, coalesce(sum(good) FILTER (bad AND NOT gone), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (bad AND NOT gone), 0) AS toxic_lost FROM placed GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM summed
"""

_TEMPLATES = ", ".join(f"({n}, '{t.label}', {t.base}, {t.gram}, {t.slack}, {t.least}, string_split('{' '.join(t.words)}', ' '))"
                       for n, t in enumerate(templates()))

_OP13 = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
templates(t, label, base, k, slack, least, tw) AS (VALUES {_TEMPLATES}),
marks AS (SELECT t, q, array_to_string(tw[q + 1:q + k], ' ') AS g FROM templates, unnest(range(0, len(tw) - k + 1)) AS u(q)),
grams AS (SELECT doc_id, p, array_to_string(w[p + 1:p + k], ' ') AS g FROM docs, (SELECT DISTINCT k FROM templates), unnest(range(0, len(w) - k + 1)) AS u(p)),
hits AS (SELECT doc_id, t, p, q, p - q AS d FROM grams JOIN marks USING (g)),
voted AS (SELECT doc_id, t, d, min(p) AS lo FROM hits GROUP BY ALL),
apart AS (SELECT v.*, CASE WHEN d - lag(d) OVER (PARTITION BY doc_id, v.t ORDER BY d) <= slack THEN 0 ELSE 1 END AS b FROM voted v JOIN templates USING (t)),
runs AS (SELECT *, sum(b) OVER (PARTITION BY doc_id, t ORDER BY d) AS run FROM apart),
spans AS (SELECT doc_id, t, run, min(lo) AS lo FROM runs GROUP BY doc_id, t, run),
places AS (SELECT doc_id, t, run, list(q) AS qs FROM runs JOIN hits USING (doc_id, t, d) GROUP BY doc_id, t, run),
checked AS (SELECT doc_id, label, base, least, lo,
            CAST(len(list_distinct(flatten(list_transform(qs, lambda q: range(q, q + k))))) AS DOUBLE) / len(tw) AS share
            FROM spans JOIN places USING (doc_id, t, run) JOIN templates USING (t)),
found AS (SELECT doc_id, count(*) FILTER (base AND share >= least) AS n, min(lo) FILTER (base AND share >= least) AS a,
          max(lo) FILTER (base AND share >= least) AS z, list(label) FILTER (base AND share >= least) AS bl,
          list(label) FILTER (share >= least) AS l, max(share) AS s FROM checked GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(a AS BIGINT) AS first_word,
       CAST(z AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(list_distinct(bl)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(l)), ','), '') AS labels, coalesce(s, 0.0) AS score
FROM docs LEFT JOIN found USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_vector_dedup": _OP1,
    "op2_substring_dedup": _OP2,
    "op5_perspectives": _OP5,
    "op8_minhash_dedup": _OP8,
    "op12_filter_audit": _OP12,
    "op13_license_scan": _OP13,
}

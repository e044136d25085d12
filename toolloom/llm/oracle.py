"""DuckDB SQL for the queries of this package that SQL can express at the size of whole small tables."""

SQL: dict[str, str] = {}

SQL["op1_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(0, len(w) - 12)) AS s FROM d WHERE len(w) >= 13),
k AS (SELECT p.doc_id, p.s, md5(array_to_string(d.w[p.s + 1 : p.s + 13], ' ')) AS h FROM p JOIN d USING (doc_id)),
f AS (SELECT h, min(doc_id) AS least FROM k GROUP BY h),
g AS (SELECT DISTINCT k.doc_id, k.s + o.o AS i FROM k JOIN f USING (h), range(0, 13) AS o(o) WHERE f.least < k.doc_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM d),
r AS (SELECT x.doc_id, count(g.i) AS n_removed, coalesce(string_agg(CASE WHEN g.i IS NULL THEN x.word END, ' ' ORDER BY x.i), '') AS kept
      FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.i = x.i GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(r.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(r.kept, '')) AS kept_sha256
FROM d LEFT JOIN r ON r.doc_id = d.doc_id
"""

SQL["op2_decontaminate"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
m AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
i AS (SELECT item_id, n, unnest(range(0, len(w) - n + 1)) AS s, w FROM m),
v AS (SELECT DISTINCT item_id, n, array_to_string(w[s + 1 : s + n], ' ') AS t FROM i),
z AS (SELECT DISTINCT n FROM v),
p AS (SELECT d.doc_id, z.n, unnest(range(0, len(d.w) - z.n + 1)) AS s, d.w FROM d, z WHERE len(d.w) >= z.n),
h AS (SELECT p.doc_id, p.s, p.n, v.item_id FROM p JOIN v ON v.n = p.n AND v.t = array_to_string(p.w[p.s + 1 : p.s + p.n], ' ')),
y AS (SELECT doc_id, unnest(range(s, s + n)) AS i FROM (SELECT DISTINCT doc_id, s, n FROM h)),
c AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM y GROUP BY doc_id),
q AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(q.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(q.names, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN q ON q.doc_id = d.doc_id
"""

SQL["op7_chat_format"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
      UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) AS v(conv_id, turn, role, text)),
e AS (SELECT *, lag(role, 1, '') OVER w AS before, replace(role, '\', '\\') AS r, replace(text, '\', '\\') AS t FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
n AS (SELECT *, 17 + length(r) + len(regexp_extract_all(r, '\[INST\]|\[/INST\]|</s>')) + length(t) + len(regexp_extract_all(t, '\[INST\]|\[/INST\]|</s>')) AS chars,
      before || '>' || role IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user') AS legal FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, bool_and(legal) AS valid_order
FROM n GROUP BY conv_id
"""

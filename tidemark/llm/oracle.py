"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op2_suffix_dedup"] = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT doc_id, unnest(range(0, length(x) // 2 - 99)) AS i FROM d),
h AS (SELECT s.doc_id, i, md5(substr(x, 2 * i + 1, 200)) AS k FROM s JOIN d USING (doc_id)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM h) WHERE n > 1),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM r),
p AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM g),
m AS (SELECT doc_id, span, min(i) AS a, max(i) + 100 AS b FROM p GROUP BY doc_id, span),
e AS (SELECT d.doc_id, x, coalesce(span, 0) AS span, a, b,
             coalesce(lag(b) OVER (PARTITION BY d.doc_id ORDER BY a), 0) AS before,
             row_number() OVER (PARTITION BY d.doc_id ORDER BY a DESC NULLS LAST) AS last
      FROM d LEFT JOIN m USING (doc_id)),
k AS (SELECT doc_id, x, a, b, CASE WHEN a IS NULL THEN x ELSE substr(x, 2 * before + 1, 2 * (a - before)) || CASE WHEN last = 1 THEN substr(x, 2 * b + 1) ELSE '' END END AS part FROM e)
SELECT doc_id, (length(any_value(x)) // 2)::BIGINT AS n_bytes, coalesce(sum(b - a), 0)::BIGINT AS n_removed, count(a)::BIGINT AS n_spans,
       sha256(unhex(string_agg(part, '' ORDER BY a))) AS kept_sha256
FROM k GROUP BY doc_id
"""

ORACLE["op5_embedding_near_dedup"] = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS u, vec_id AS c FROM embeddings UNION SELECT l.w, r.c FROM r JOIN l ON l.u = r.u),
c AS (SELECT u, min(c) AS component_id FROM r GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings e JOIN c ON c.u = e.vec_id LEFT JOIN n ON n.u = e.vec_id
"""

ORACLE["op6_decontaminate"] = r"""
WITH words AS (SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0),
ik AS (SELECT DISTINCT item_id, n, md5(array_to_string(list_slice(w, i, i + n - 1), ' ')) AS k FROM iw),
dw AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM ik) WHERE len(w) >= n),
dk AS (SELECT doc_id, n, i, md5(array_to_string(list_slice(w, i, i + n - 1), ' ')) AS k FROM dw),
found AS (SELECT doc_id, item_id, n, i FROM dk JOIN ik USING (n, k)),
per AS (SELECT doc_id, len(list_distinct(flatten(list(range(i, i + n))))) AS n_hit FROM found GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN per USING (doc_id) LEFT JOIN its USING (doc_id)
"""

ORACLE["op7_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i FROM d),
h AS (SELECT s.doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS k FROM s JOIN d USING (doc_id)),
r AS (SELECT doc_id, i FROM h WHERE k IN (SELECT k FROM h GROUP BY k HAVING count(*) > 1)),
c AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 35)))) AS gone FROM r GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w
              ELSE list_transform(list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(gone, x)), lambda x: w[x]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""

ORACLE["op12_conversation_trie"] = r"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos,
       md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
       len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT c, count(*) AS n, c - c % 20 AS base, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
        lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))))  % 4 AS h FROM t GROUP BY c),
s AS (SELECT c.c, n, base, h, least(h, (SELECT count(*) FROM t WHERE t.c = c.base)) AS taken FROM c),
r AS (SELECT s.c, t.pos, k, words FROM s JOIN t ON t.c = s.base AND t.pos < s.h
      UNION ALL SELECT s.c, t.pos - h + taken, k, words FROM s JOIN t ON t.c = s.c AND t.pos >= s.h),
m AS (SELECT c, pos + 1 AS d, words, md5(string_agg(k, ',') OVER (PARTITION BY c ORDER BY pos)) AS name FROM r
      UNION ALL SELECT c, 0, 0, 'root' FROM s),
p AS (SELECT *, lag(name) OVER (PARTITION BY c ORDER BY d) AS parent, max(d) OVER (PARTITION BY c) AS length FROM m),
n AS (SELECT name, min(c) AS conv_id, min(d) AS depth, min(parent) AS parent, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
             coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = length), '') AS ends FROM p GROUP BY name),
ch AS (SELECT parent AS name, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
u AS (SELECT p.name, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE n.name NOT IN (SELECT name FROM ch)) AS n_leaves
      FROM n JOIN p ON p.c = n.conv_id AND p.d <= n.depth GROUP BY p.name)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN u USING (name) LEFT JOIN ch USING (name) LEFT JOIN n up ON up.name = n.parent
"""

ORACLE["op13_collocations"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
      FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
cuts AS (SELECT c.lang, c.phrase, c.a, i, lf.f AS l, rf.f AS r, n.n, (1000 * c.a * n.n) // (lf.f * rf.f) AS score
         FROM (SELECT *, unnest(range(1, k)) AS i FROM c) c JOIN n USING (lang)
         JOIN f lf ON lf.lang = c.lang AND lf.phrase = array_to_string(list_slice(w, 1, i), ' ')
         JOIN f rf ON rf.lang = c.lang AND rf.phrase = array_to_string(list_slice(w, i + 1, c.k), ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inner_ AS (SELECT lang, a, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
           FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))),
gone AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN inner_ i ON i.lang = c.lang AND i.phrase = c.phrase WHERE 100 * i.a >= 100 * c.a),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
           FROM best b ANTI JOIN gone USING (lang, phrase))
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

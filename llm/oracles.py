"""DuckDB SQL of the operators that SQL can express.

Tokenizers, trained models and approximate search have none; tests hold these against the
libraries, brute force or held-out rows.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all({x}, '[^\x20\x09-\x0D]+')"
_TEXTS = "d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)"

OP1 = f"""WITH {_TEXTS}, w AS (SELECT doc_id, {_WORDS.format(x='text')} AS w FROM d),
t AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM t),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM g) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM later),
own AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM own ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""

OP3 = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)"""

OP6 = rf"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(x="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
 ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""

OP8 = """WITH s AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS x FROM documents),
l AS (SELECT r, doc_id, unnest(x) AS line, generate_subscripts(x, 1) - 1 AS i FROM s),
p AS (SELECT a.r, a.doc_id, a.i, a.line AS a, b.line AS b FROM l a JOIN l b ON a.r = b.r AND a.i + 1 = b.i WHERE a.doc_id IS NOT NULL),
f AS (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY a, b) AS first, min(i) OVER (PARTITION BY r, a, b) AS own FROM p),
gone AS (SELECT DISTINCT r, unnest([i, i + 1]) AS i FROM f WHERE first < doc_id OR i >= own + 2),
kept AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS kept FROM l ANTI JOIN gone USING (r, i) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END AS text, coalesce(len(x), 0)::BIGINT AS n_lines,
coalesce(n, 0)::BIGINT AS n_removed_lines FROM s LEFT JOIN kept USING (r) LEFT JOIN n USING (r)"""

OP10 = rf"""WITH {_TEXTS}, w AS (SELECT doc_id, text, {_WORDS.format(x='text')} AS w,
list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
t AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 2], ' ')) AS n FROM t),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM c, (VALUES (0), (1), (2)) v(k) WHERE n > 1 GROUP BY doc_id),
b AS (SELECT doc_id, text, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
len(lines) AS n_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, len(regexp_extract_all(text, '\p{{L}}')) AS letters,
len(regexp_extract_all(text, '\p{{Lu}}')) AS upper, len(regexp_extract_all(text, '!')) AS shouts FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND n_symbols * 10 <= n_words AND n_dup_lines * 2 <= n_lines
AND upper * 2 <= letters AND letters * 2 >= word_chars AND shouts * 5 <= n_words AS kept FROM f"""

_BYTES = "list_transform(range(0, octet_length(encode({x}))), lambda i: ('0x' || substr(hex(encode({x})), 2 * i + 1, 2))::BIGINT)"
_CRC_TABLE = """k AS (SELECT list(list_reduce([i::BIGINT] || range(8), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS k
FROM range(256) r(i))"""
_CRC = "xor(list_reduce([4294967295::BIGINT] || {b}, lambda c, b: xor(c >> 8, k[(xor(c, b) & 255) + 1])), 4294967295)"

OP11 = rf"""WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')) AS u FROM documents),
l AS (SELECT translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u, doc_id FROM r),
h AS (SELECT u, doc_id::VARCHAR || ':' || u AS x FROM l),
b AS (SELECT u, {_BYTES.format(x="x")} AS b FROM h),
c AS (SELECT u, {_CRC.format(b="b")} AS h FROM b, k),
d AS (SELECT CASE WHEN h % 31 = 0 THEN substr(u, 1, (h % length(u))::BIGINT) || substr(u, (h % length(u))::BIGINT + 2) ELSE u END AS word FROM c),
w AS (SELECT word, count(*) AS n FROM d WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
x AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
v AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM x),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM v a JOIN v b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
 UNION SELECT a.word, b.word, b.n FROM v a JOIN w b ON a.less = b.word UNION SELECT b.word, a.word, a.n FROM v a JOIN w b ON a.less = b.word),
m AS (SELECT word, count(*) AS n_near, min((-near_n, near)) AS best FROM p GROUP BY word),
f AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 10 * n THEN best[2] END AS form,
 CASE WHEN -best[1] >= 10 * n THEN -best[1] END AS form_n FROM w LEFT JOIN m USING (word)),
t(word, root, next) AS (SELECT word, word, form FROM f UNION ALL SELECT t.word, f.word, f.form FROM t JOIN f ON t.next = f.word)
SELECT f.word, f.form, t.root, n, n_near, form_n FROM f JOIN t ON f.word = t.word AND t.next IS NULL"""

_FOLDED = r"regexp_extract_all(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP12 = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_FOLDED.format(x="coalesce(text, '')")} AS w FROM documents),
i AS (SELECT item_id, {_FOLDED.format(x="coalesce(text, '')")} AS w FROM benchmark),
s AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda k: array_to_string(w[k:k + 9], ' '))) AS g
 FROM i WHERE len(w) > 0),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS k FROM d),
g AS (SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM p, (SELECT DISTINCT n FROM s) WHERE k + n - 1 <= len(w)),
o AS (SELECT r, k, s.n, item_id FROM g JOIN s ON g.n = s.n AND g.g = s.g),
h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(k, k + n)) FROM o) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM o WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(x, '')) AS items_sha256,
n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)"""

OP13 = f"""WITH {_CRC_TABLE},
o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i,
 coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT c, max(i) AS n FROM o GROUP BY c),
y AS (SELECT c, {_BYTES.format(x="c::VARCHAR")} AS b FROM s),
a AS (SELECT c, ({_CRC.format(b="b")}) % 9 AS h FROM y, k),
e AS (SELECT a.c, h, least(h, coalesce(n, 0)) AS have FROM a LEFT JOIN s ON s.c = a.c - a.c % 5),
u AS (SELECT e.c, o.i AS d, role, text FROM e JOIN o ON o.c = e.c - e.c % 5 AND o.i <= e.have
 UNION ALL SELECT e.c, o.i - h + have, role, text FROM e JOIN o ON o.c = e.c AND o.i > h
 UNION ALL SELECT c, 0, '', '' FROM e),
z AS (SELECT c, d, md5(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '|') OVER (PARTITION BY c ORDER BY d)) AS name, strlen(text) AS size FROM u),
q AS (SELECT *, max(d) OVER (PARTITION BY c) AS last, lag(name) OVER (PARTITION BY c ORDER BY d) AS up FROM z),
nodes AS (SELECT d, name, min(up) AS up, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * min(size) AS own,
 coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = last), '') AS ends FROM q GROUP BY d, name),
kids AS (SELECT d - 1 AS d, up AS name, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
t AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (d, name)),
sums AS (SELECT q.d, q.name, count(*) FILTER (t.n_children = 0) AS n_leaves, sum(t.own) AS saved FROM t JOIN q ON q.c = t.c AND q.d <= t.d GROUP BY ALL)
SELECT t.c AS conv_id, t.d AS depth, p.c AS parent_conv_id, t.n_convs, t.n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(t.ends) AS ends_sha256
FROM t JOIN sums USING (d, name) LEFT JOIN nodes p ON p.d = t.d - 1 AND p.name = t.up"""

ORACLES = {"op1_substring_dedup": OP1, "op3_warc": OP3, "op6_ngram_join": OP6, "op8_line_dedup": OP8, "op10_quality_rules": OP10, "op11_spelling_variants": OP11, "op12_decontamination": OP12, "op13_prefix_trie": OP13}

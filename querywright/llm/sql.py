"""The queries in DuckDB SQL, where SQL can express them."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"

OP1 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
arcs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, arcs.b FROM reach JOIN arcs ON reach.b = arcs.a),
lowest AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN lowest USING (doc_id)
"""

OP5 = rf"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS k FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_UPPER.lower()}') AS key
  FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, k, line, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN frequent USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP7 = f"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
      FROM (SELECT doc_id, {_LOWERED} AS norm FROM documents))
"""

# Windows are cut out of pieces of 200 starts, since a substring costs time in the length of its text.
OP11 = """
WITH b AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (
  SELECT r, o, substr(h, 2 * o + 1, 2 * (200 + 399)) AS g
  FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 399, 200)) AS o FROM b WHERE len(h) >= 800)),
w AS (
  SELECT r, o + j AS p, md5(substr(g, 2 * j + 1, 800)) AS m
  FROM (SELECT r, o, g, unnest(range(0, len(g) // 2 - 399)) AS j FROM pieces)),
again AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1),
hit AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS q FROM w JOIN again USING (m)),
runs AS (SELECT r, p, sum(CASE WHEN q >= p - 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS run FROM hit),
spans AS (SELECT r, run, min(p) AS a, max(p) + 400 AS z FROM runs GROUP BY r, run),
gaps AS (SELECT r, run, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY run), 0) AS before FROM spans),
cut AS (
  SELECT r, sum(z - a) AS gone, count(*) AS n, max(z) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY run) AS head
  FROM gaps JOIN b USING (r) GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM b LEFT JOIN cut USING (r)
"""

OP13 = r"""
WITH own AS (
  SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
sums AS (
  SELECT c, l, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: ascii(s)::UBIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), list_transform(range(8), lambda i: i::UBIGINT)),
      lambda v, i: xor(v >> 1, 3988292384::UBIGINT * (v & 1::UBIGINT)))) AS state FROM own),
sized AS (SELECT c, l, CAST(xor(state, 4294967295::UBIGINT) % 4 AS BIGINT) AS h FROM sums),
built AS (
  SELECT a.c, list_concat(coalesce(p.l, [])[1:a.h], a.l[a.h + 1:]) AS s FROM sized a LEFT JOIN own p ON p.c = a.c - a.c % 20),
steps AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM built),
nodes AS (
  SELECT s[1:d] AS k, d, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(s) = d), '')) AS ends_sha256
  FROM steps GROUP BY 1, 2),
kids AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
valued AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(k[d].x, '[^\x20\x09-\x0D]+')) END AS own
  FROM nodes LEFT JOIN kids USING (k)),
up AS (SELECT k, own, n_children, unnest(range(0, d + 1)) AS e FROM valued),
below AS (SELECT k[1:e] AS k, CAST(sum(own) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM up GROUP BY 1)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM valued v JOIN below USING (k) LEFT JOIN nodes p ON v.d > 0 AND p.k = v.k[1:v.d - 1]
"""

SQL = {"op1_near_dedup": OP1, "op5_line_dedup": OP5, "op7_exact_dedup": OP7, "op11_suffix_dedup": OP11, "op13_prefix_trie": OP13}

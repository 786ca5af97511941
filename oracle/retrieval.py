"""Retrieval queries in SQL."""


def wl(c):
    return f"list_filter(string_split_regex({c}, '\\s+'), lambda w: w <> '')"


def any_of(c, words):
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


BM25 = f"""
dt AS (SELECT doc_id AS id, {wl('text')} AS tk FROM documents),
st AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(len(tk)) AS avgdl FROM dt),
po AS (SELECT id, dl, term, CAST(count(*) AS DOUBLE) AS f FROM (SELECT id, len(tk) AS dl, unnest(tk) AS term FROM dt) GROUP BY ALL),
df AS (SELECT term, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) AS idf FROM po, st GROUP BY term, n),
fl AS (SELECT avg(idf) * 0.25 AS floor FROM df),
qt AS (SELECT item_id AS qid, term, count(*) AS qtf FROM (SELECT item_id, unnest({wl('text')}) AS term FROM benchmark) GROUP BY ALL),
sc AS (SELECT qid, id, round(sum(qtf * CASE WHEN idf < 0 THEN floor ELSE idf END * f * 2.5 / (f + 1.5 * (0.25 + 0.75 * dl / avgdl))), 9) AS score FROM qt JOIN df USING (term) JOIN po USING (term), st, fl GROUP BY ALL),
bm AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM sc WHERE score > 0 QUALIFY rank <= 10)"""

DENSE = """
un AS (SELECT vec_id AS id, list_transform(v, lambda x: x / nrm) AS v FROM (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS nrm FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))),
dq AS (SELECT item_id AS qid, v AS qv FROM benchmark JOIN un ON id = item_id),
ds AS (SELECT qid, id, round(list_dot_product(v, qv), 9) AS score FROM dq, {pool}),
de AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM ds QUALIFY rank <= 10)"""
POOL = "(SELECT un.* FROM un JOIN documents ON doc_id = id)"

NORM = "SELECT qid, id, rank, CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS score FROM {} WINDOW w AS (PARTITION BY qid)"

FUSED = f"""{BM25}, {DENSE.format(pool=POOL)},
nb AS (SELECT qid, id, score * 0.5 / (1 + 0.1 * (rank - 1)) AS b FROM ({NORM.format('bm')})),
nd AS (SELECT qid, id, score * 0.5 / (1 + 0.1 * (rank - 1)) AS d FROM ({NORM.format('de')})),
fu AS (SELECT qid, id, (coalesce(b, 0) + coalesce(d, 0)) * CASE WHEN b IS NOT NULL AND d IS NOT NULL THEN 1.2 ELSE 1.0 END AS score FROM nb FULL JOIN nd USING (qid, id))"""

HYBRID = f"""{FUSED},
rr AS (SELECT qid, id, d.text AS content, lang, n_chars, b.text AS qtext, CASE WHEN lang = 'en' THEN 'table' ELSE 'column' END AS type,
  round(score * (1 + 0.1 * len(list_intersect(list_distinct({wl('lower(b.text)')}), list_distinct({wl('lower(d.text)')})))) * CASE WHEN lang = 'en' THEN 1.15 ELSE 1.0 END * 1.05, 9) AS score
  FROM fu JOIN documents d ON d.doc_id = id JOIN benchmark b ON item_id = qid),
hy AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM rr QUALIFY rank <= 5)"""

CONTEXT = f"""{HYBRID},
cx AS (SELECT item_id AS qid, text, id, coalesce(type, 'none') AS type, coalesce(content, '') AS content, coalesce(score, 0.0) AS score FROM benchmark LEFT JOIN (SELECT * FROM hy WHERE rank = 1) ON qid = item_id)"""

_RULES = [(["from", "table", "in"], ["table"]), (["select", "where", "column", "field"], ["column"]),
          (["count", "sum", "average", "max", "min", "total"], ["count", "sum", "avg", "aggregate"]),
          (["join", "combine", "merge", "across", "between"], ["join", "foreign", "relationship"])]


def cover(q, c):
    q, c = f"lower({q})", f"lower({c})"
    hits = " + ".join(f"CASE WHEN {any_of(q, a)} AND {any_of(c, b)} THEN 1.0 ELSE 0.0 END" for a, b in _RULES)
    checks = " + ".join(f"CASE WHEN {any_of(q, a)} THEN 1 ELSE 0 END" for a, _ in _RULES)
    return f"CAST(coalesce(({hits}) / nullif({checks}, 0), 0.8) AS DOUBLE)"


_LEX = f"(len(list_intersect(list_distinct({wl('lower(text)')}), list_distinct({wl('lower(content)')}))) / CAST(len(list_distinct({wl('lower(text)')})) AS DOUBLE))"
RELEVANCE = f"""{CONTEXT},
re AS (SELECT qid, CASE WHEN content = '' THEN 0.0 ELSE least(1, 0.4 * lex + 0.4 * coalesce(greatest(0, least(1, cs)), lex) + 0.2 * cov) END AS relevance
  FROM (SELECT cx.qid, content, {_LEX} AS lex, {cover('text', 'content')} AS cov, list_dot_product(un.v, dq.qv) AS cs FROM cx LEFT JOIN un ON un.id = cx.id LEFT JOIN dq ON dq.qid = cx.qid))"""


def W(ctes, body):
    return f"WITH {ctes.strip()} {body}"


SQL = {
    "RET01": W(BM25, "SELECT term, count(*) AS df FROM po GROUP BY 1"),
    "RET01_postings": W(BM25, "SELECT id, max(dl) AS dl, count(*) AS terms, CAST(max(f) AS BIGINT) AS top_f FROM po GROUP BY 1"),
    "RET01_corpus": W(BM25, "SELECT CAST(n AS BIGINT) AS n_docs, round(avgdl, 6) AS avgdl FROM st"),
    "RET02": W(BM25, "SELECT qid, id, round(score, 6) AS score, rank FROM bm"),
    "RET03": W(DENSE.format(pool="un"), "SELECT qid, id, round(score, 6) AS score, rank FROM de"),
    "RET04": W(BM25, f"SELECT qid, id, round(score, 6) AS score FROM ({NORM.format('bm')})"),
    "RET05": W(FUSED, "SELECT qid, id, round(score, 6) AS score FROM fu"),
    "RET06": W(HYBRID, "SELECT qid, id, type, round(score, 6) AS score, rank FROM hy"),
    "RET07": W(CONTEXT, "SELECT qid, id, type, md5(content) AS content_md5, round(score, 6) AS score FROM cx"),
    "RET08": W(RELEVANCE, "SELECT qid, round(relevance, 6) AS relevance FROM re"),
    "RET09": W(CONTEXT, f"SELECT qid, round({cover('text', 'content')}, 6) AS coverage FROM cx"),
    "RET09_documents": f"SELECT doc_id, round({cover(chr(39) + 'count rows from a table where they join' + chr(39), 'text')}, 6) AS coverage FROM documents",
    "RET10": W(CONTEXT, "SELECT round(p, 6) AS precision, round(p, 6) AS recall, round(p, 6) AS f1, round(p, 6) AS accuracy FROM (SELECT avg(CASE WHEN contains(lower(content), lower(text)) THEN 1.0 ELSE 0.0 END) AS p FROM cx)"),
    "RET11": W(HYBRID, "SELECT qid, coalesce(string_agg('doc_' || id, ',' ORDER BY rank) FILTER (type = 'table'), '') AS tables, coalesce(string_agg('doc_' || id, ',' ORDER BY rank) FILTER (type = 'column'), '') AS columns, count(*) AS n_items FROM hy GROUP BY 1"),
    "RET12": W(HYBRID + """, ty AS (SELECT *, row_number() OVER (PARTITION BY qid, type ORDER BY rank) AS tr FROM hy),
tx AS (SELECT qid, string_agg(printf('- doc_%d: %d columns' || chr(10), id, n_chars), '' ORDER BY rank) FILTER (type = 'table' AND tr <= 3) AS a, string_agg(printf('- doc_%d (%s)' || chr(10), id, lang), '' ORDER BY rank) FILTER (type = 'column' AND tr <= 5) AS b FROM ty GROUP BY 1)""",
               "SELECT item_id AS qid, 'Answer: ' || text || chr(10) || chr(10) || '## Retrieved Schema Context:' || chr(10) || coalesce('### Relevant Tables:' || chr(10) || a, '') || coalesce('### Relevant Columns:' || chr(10) || b, '') || chr(10) AS prompt FROM benchmark LEFT JOIN tx ON qid = item_id"),
    "RET13": W(RELEVANCE, "SELECT round(avg(relevance), 6) AS avg_relevance, round(min(relevance), 6) AS min_relevance, round(max(relevance), 6) AS max_relevance, round(stddev_pop(relevance), 6) AS std_relevance, (SELECT round(avg(coalesce(n, 0)), 6) FROM benchmark LEFT JOIN (SELECT qid, count(*) AS n FROM hy GROUP BY 1) ON qid = item_id) AS avg_context_items, (SELECT count(*) FROM documents) AS total_cards, avg(relevance) >= 0.75 AS target_achieved FROM re"),
    "RET14": W(RELEVANCE, "SELECT qid, row_number() OVER (ORDER BY qid) AS ordinal, round(relevance * 100, 6) AS relevance_percent FROM re"),
}

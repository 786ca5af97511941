"""Catalog and pair-curation queries in SQL."""

from oracle.fixtures import QA, with_
from oracle.profiles import _KEYS, _REFS, _TABLES, each
from oracle.scoring import complexity, strip

_CARDS = """
SELECT 'table_' || table_name AS id, 'table' AS type, table_name AS name, 'Table: ' || table_name AS content, table_name, count(*) AS n_columns,
  NULL AS data_type, NULL AS nullable, NULL AS is_primary_key, NULL AS is_foreign_key FROM columns_catalog GROUP BY table_name
UNION ALL SELECT concat_ws('_', 'column', table_name, column_name), 'column', concat_ws('.', table_name, column_name),
  'Column: ' || table_name || '.' || column_name || ' (' || data_type || ')', table_name, NULL, data_type, nullable, is_primary_key,
  {fk} FROM columns_catalog
"""
CARDS = _CARDS.format(fk="false")
_HIT = "(contains(lower(content), lower(query)) OR contains(lower(name), lower(query)))"

_PK_LIST = "[" + ", ".join(f"'{t}.{c}'" for t, cs in _KEYS.items() for c in cs.split(",")) + "]"
_TYPE = "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' ELSE data_type END"

MSG = "'Item ' || pair_id || ': "
# DuckDB's JSON functions raise on text that is not JSON, so only valid objects reach them
_OBJ = "CASE WHEN json_valid(schema_context) AND trim(schema_context)[1] = '{' THEN schema_context END"
CONTEXT = f"""
SELECT *, CASE WHEN from_text THEN list_transform(found, lambda x: regexp_extract(x, '(\\w+)\\s*\\(', 1)) ELSE rt END AS relevant_tables,
  CASE WHEN from_text THEN flatten(list_transform(found, lambda x: list_transform(string_split(regexp_extract(x, '\\(([^)]+)\\)', 1), ','), lambda c: regexp_extract(x, '(\\w+)\\s*\\(', 1) || '.' || trim(c)))) ELSE rc END AS relevant_columns,
  CASE WHEN other OR bad_t OR bad_c THEN list_filter([CASE WHEN bad_t THEN {MSG}relevant_tables should be a list' END, CASE WHEN len(rt) = 0 THEN {MSG}relevant_tables is empty' END,
    CASE WHEN bad_c THEN {MSG}relevant_columns should be a list' END, CASE WHEN other THEN {MSG}Invalid schema_context type' END], lambda x: x IS NOT NULL) ELSE [] END AS context_issues
FROM (SELECT *, schema_context IS NOT NULL AND obj IS NULL AND NOT other AS from_text, regexp_extract_all(schema_context, '\\w+\\s*\\([^)]+\\)') AS found,
        CASE WHEN json_type(obj, '$.relevant_tables') = 'ARRAY' THEN CAST(json_extract(obj, '$.relevant_tables') AS VARCHAR[]) END AS rt,
        CASE WHEN json_type(obj, '$.relevant_columns') = 'ARRAY' THEN CAST(json_extract(obj, '$.relevant_columns') AS VARCHAR[]) END AS rc,
        coalesce(json_type(obj, '$.relevant_tables') <> 'ARRAY', false) AS bad_t, coalesce(json_type(obj, '$.relevant_columns') <> 'ARRAY', false) AS bad_c
      FROM (SELECT *, {_OBJ} AS obj, coalesce(json_valid(schema_context) AND trim(schema_context)[1] NOT IN ('{{', '"'), false) AS other FROM raw_pairs))"""

_Q, _S = strip("question"), strip("upper(coalesce(sql, ''))")
PLAUSIBLE = f"(regexp_matches({_S}, '^(SELECT|INSERT|UPDATE|DELETE|WITH)') AND (NOT starts_with({_S}, 'SELECT') OR contains({_S}, 'FROM') OR contains({_S}, 'DUAL')) AND len(string_split({_S}, '(')) = len(string_split({_S}, ')')))"
TIDY = f"rtrim(regexp_replace({strip('sql')}, '\\s+', ' ', 'g'), ';')"
CHECKED = f"""
SELECT pair_id, category, relevant_tables, relevant_columns,
  CASE WHEN complete THEN substring({_Q}, 1, 500) ELSE question END AS question, CASE WHEN complete THEN {TIDY} ELSE sql END AS sql,
  complete AND length({_Q}) >= 5 AND {PLAUSIBLE} AS is_valid,
  CASE WHEN NOT complete THEN list_filter([CASE WHEN coalesce(question, '') = '' THEN {MSG}Missing or empty ''question'' field' END, CASE WHEN coalesce(sql, '') = '' THEN {MSG}Missing or empty ''sql'' field' END], lambda x: x IS NOT NULL)
  ELSE list_concat(list_filter([CASE WHEN length({_Q}) < 5 THEN {MSG}Question too short (' || length({_Q}) || ' chars)' END, CASE WHEN length({_Q}) > 500 THEN {MSG}Question too long (' || length({_Q}) || ' chars)' END, CASE WHEN NOT {PLAUSIBLE} THEN {MSG}Invalid SQL syntax' END], lambda x: x IS NOT NULL), context_issues) END AS issues
FROM (SELECT *, coalesce(question, '') <> '' AND coalesce(sql, '') <> '' AS complete FROM ({CONTEXT}))"""
ISSUES = "SELECT pair_id, CAST(i AS BIGINT) AS ordinal, issues[i] AS issue FROM ck, LATERAL unnest(range(1, len(issues) + 1)) u(i)"

_RULES = [("show me", "display"), ("find", "get"), ("what is", "what are"), ("how many", "count"), ("list all", "show all")]


def para(q):
    low = "CASE " + " ".join(f"WHEN contains(lower({q}), '{a}') THEN replace(lower({q}), '{a}', '{b}')" for a, b in _RULES) + f" ELSE lower({q}) END"
    return f"CASE WHEN {low} = '' THEN {q} ELSE upper(({low})[1]) || ({low})[2:] END"


def alias(s):
    calls = " ".join(f"WHEN regexp_extract({s}, '(?i){f}\\([^)]+\\)') <> '' THEN replace({s}, regexp_extract({s}, '(?i){f}\\([^)]+\\)'), regexp_extract({s}, '(?i){f}\\([^)]+\\)') || ' AS {f.lower()}_result')"
                     for f in ("COUNT", "SUM", "AVG", "MAX", "MIN"))
    return f"CASE WHEN NOT starts_with(upper({s}), 'SELECT') OR contains(upper({s}), 'AS ') THEN {s} {calls} ELSE {s} END"


def draw(n, salt):
    return f"CAST('0x' || substr(md5(concat_ws(':', i, '0', '{salt}')), 1, 12) AS BIGINT) % {n}"


def ck(body):
    return with_("raw_pairs", f"WITH ck AS ({CHECKED}) {body}")


_VARIANT = "CASE {v} WHEN 'upper' THEN upper(sql) WHEN 'lower' THEN lower(sql) WHEN 'collapse' THEN regexp_replace(sql, '\\s+', ' ', 'g') ELSE replace(sql, ',', ', ') END"


_ASKED = """asked AS (
  SELECT row_id, regexp_replace(lower(trim(coalesce(question, ''))), '[ ]+', ' ', 'g') AS grp FROM (
    SELECT 'q' || pair_id AS row_id, question FROM qa_pairs UNION ALL SELECT 'r' || pair_id, question FROM raw_pairs))"""

SQL = {
    "CAT01": "SELECT table_name, column_name, CAST(ordinal_position - 1 AS BIGINT) AS position, " + _TYPE + " AS data_type, list_contains(" + _PK_LIST + ", table_name || '.' || column_name) AS is_primary_key, rows FROM information_schema.columns JOIN (" + each(_TABLES, lambda x: f"SELECT '{x}' AS table_name, count(*) AS rows FROM {x}") + ") USING (table_name)",
    "CAT02": each(_REFS, lambda r: f"SELECT '{r[0]}' AS table_name, '{r[1]}' AS column_name, '{r[2]}' AS ref_table, '{r[3]}' AS ref_column, count({r[1]}) AS rows, count(DISTINCT {r[1]}) AS distinct_values FROM {r[0]}"),
    "CAT03": with_("columns_catalog", "WITH top AS (SELECT table_name, count(*) AS n_columns FROM columns_catalog GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5), few AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY position) AS rn FROM columns_catalog JOIN top USING (table_name)) SELECT table_name, n_columns, string_agg(column_name || ':' || data_type || CASE WHEN is_primary_key THEN '*' ELSE '' END, ', ' ORDER BY position) AS columns FROM few WHERE rn <= 6 GROUP BY 1, 2"),
    "CAT04": with_("edges_catalog", "SELECT table_name, table_name || '.' || column_name || ' → ' || ref_table || '.' || ref_column AS line FROM edges_catalog"),
    "CAT04_text": with_("edges_catalog", "SELECT table_name, string_agg(line, chr(10) ORDER BY line) AS schema_graph FROM (SELECT table_name, table_name || '.' || column_name || ' → ' || ref_table || '.' || ref_column AS line FROM edges_catalog) GROUP BY 1"),
    "CAT05": with_("columns_catalog", "SELECT 'names' AS style, table_name, table_name || '(' || string_agg(column_name, ', ' ORDER BY position) || ')' AS text FROM columns_catalog GROUP BY 2 UNION ALL SELECT 'typed', table_name, '- ' || table_name || ': ' || string_agg(column_name || '(' || data_type || ')', ', ' ORDER BY position) FROM columns_catalog GROUP BY 2 UNION ALL SELECT 'keys', table_name, '  ' || table_name || '(' || string_agg(column_name || ':' || data_type || CASE WHEN is_primary_key THEN ' (PK)' ELSE '' END, ', ' ORDER BY position) || ')' FROM columns_catalog GROUP BY 2"),
    "CAT06": with_("columns_catalog", "SELECT table_name AS \"table\", table_name || '.' || column_name AS \"column\" FROM columns_catalog"),
    "CAT07": with_("columns_catalog edges_catalog", _CARDS.format(fk="(table_name, column_name) IN (SELECT (table_name, column_name) FROM edges_catalog)")),
    "CAT08": with_("columns_catalog search_terms", f"WITH cards AS ({CARDS}) SELECT query, id FROM search_terms, cards WHERE {_HIT}"),
    "CAT08_tables": with_("columns_catalog search_terms", f"WITH cards AS ({CARDS}) SELECT query, id FROM search_terms, cards WHERE type = 'table' AND {_HIT}"),
    "CAT09": with_("columns_catalog questions", f"WITH cards AS ({CARDS}), qw AS (SELECT DISTINCT qid, unnest(list_filter(string_split_regex(lower(question), '\\s+'), lambda w: w <> '')) AS word FROM questions), wc AS (SELECT word, name, type <> 'table' AS late, id FROM (SELECT DISTINCT word FROM qw), cards WHERE contains(lower(content), word) QUALIFY row_number() OVER (PARTITION BY word ORDER BY late, id) <= 3) SELECT qid, name, rank FROM (SELECT qid, name, row_number() OVER (PARTITION BY qid ORDER BY late, id) AS rank FROM (SELECT DISTINCT qid, name, late, id FROM qw JOIN wc USING (word))) WHERE rank <= 3"),
    "CUR01": ck("SELECT pair_id, array_to_string(list_filter(issues, lambda x: contains(x, 'Missing or empty')), '; ') AS missing FROM ck"),
    "CUR02": with_("raw_pairs", f"SELECT pair_id, md5(q) AS question_md5, length(q) AS length FROM (SELECT pair_id, substring({_Q}, 1, 500) AS q FROM raw_pairs WHERE question <> '' AND sql <> '')"),
    "CUR03": with_("raw_pairs", f"SELECT pair_id, {PLAUSIBLE} AS plausible FROM raw_pairs"),
    "CUR04": with_("raw_pairs", f"SELECT pair_id, {TIDY} AS sql FROM raw_pairs"),
    "CUR05": with_("raw_pairs", f"SELECT pair_id, array_to_string(relevant_tables, ',') AS tables, array_to_string(relevant_columns, ',') AS columns, array_to_string(context_issues, '; ') AS issues FROM ({CONTEXT})"),
    "CUR06": ck(f"SELECT * FROM ({ISSUES} WHERE NOT is_valid)"),
    "CUR06_warnings": ck(ISSUES),
    "CUR07": ck("SELECT count(*) AS total_samples, count(*) FILTER (is_valid) AS valid_samples, count(*) FILTER (NOT is_valid) AS invalid_samples, round(avg(length(question)) FILTER (is_valid), 6) AS avg_question_length, round(avg(length(sql)) FILTER (is_valid), 6) AS avg_sql_length, count(DISTINCT lower(question)) FILTER (is_valid) AS unique_questions, count(*) FILTER (is_valid) - count(DISTINCT lower(question)) FILTER (is_valid) AS duplicate_questions, CAST(coalesce(sum(len(issues)) FILTER (NOT is_valid), 0) AS BIGINT) AS quality_issues FROM ck"),
    "CUR08": ck("SELECT unnest(relevant_tables) AS table_name, count(*) AS n FROM ck WHERE is_valid GROUP BY 1"),
    "CUR09": with_("raw_pairs", f"SELECT 'category' AS \"column\", category AS value, count(*) AS n FROM raw_pairs GROUP BY 2 UNION ALL SELECT 'complexity', {complexity('sql')[0]}, count(*) FROM (SELECT {complexity('sql')[1]} AS pts FROM raw_pairs) GROUP BY 2"),
    "CUR10": with_("raw_pairs", f"SELECT pair_id, md5(p) AS paraphrase_md5, length(p) AS length FROM (SELECT pair_id, {para('question')} AS p FROM (SELECT pair_id, question FROM raw_pairs UNION ALL SELECT pair_id, question FROM ({QA})) WHERE question IS NOT NULL)"),
    "CUR11": with_("raw_pairs", f"SELECT pair_id, variant, {_VARIANT.format(v='variant')} AS sql FROM raw_pairs, (VALUES ('upper'), ('lower'), ('collapse'), ('commas')) v(variant)"),
    "CUR12": with_("raw_pairs", f"SELECT pair_id, {alias('s')} AS sql FROM (SELECT pair_id, replace(sql, ' AS n', '') AS s FROM raw_pairs)"),
    "CUR13": ck(f""", ok AS (SELECT pair_id, question, sql, row_number() OVER (ORDER BY md5(concat_ws(':', pair_id, '0')), pair_id) - 1 AS r FROM ck WHERE is_valid),
n AS (SELECT count(*) AS n FROM ok), ex AS (SELECT i, {draw('n', 'row')} AS r, {draw(3, 'technique')} AS k, ['upper', 'lower', 'collapse', 'commas'][{draw(4, 'variant')} + 1] AS v FROM n, LATERAL unnest(range(CAST(floor(n * CAST(1.5 AS DOUBLE)) AS BIGINT) - n)) u(i)),
aug AS (SELECT pair_id, ['paraphrase', 'format', 'alias'][k + 1] AS origin, CASE WHEN k = 0 THEN {para('question')} ELSE question END AS question, CASE k WHEN 1 THEN {_VARIANT.format(v='v')} WHEN 2 THEN {alias('sql')} ELSE sql END AS sql FROM ex JOIN ok USING (r))
SELECT pair_id, origin, md5(concat_ws('|', question, sql)) AS content_md5 FROM (SELECT pair_id, 'original' AS origin, question, sql FROM ok UNION ALL SELECT * FROM aug)"""),
    "CUR17": with_("qa_pairs raw_pairs", f"WITH {_ASKED}, g AS (SELECT md5(concat_ws(':', grp, '0')) AS group_key, count(*) AS n FROM asked GROUP BY 1), p AS (SELECT group_key, n, sum(n) OVER (ORDER BY group_key) - n AS a, sum(n) OVER () AS t FROM g) SELECT row_id, group_key, CASE WHEN a < floor(t * CAST(0.8 AS DOUBLE)) THEN 'train' WHEN a < floor(t * CAST(0.8 AS DOUBLE)) + floor(t * CAST(0.1 AS DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM asked JOIN p ON group_key = md5(concat_ws(':', grp, '0'))"),
    "CUR17_leaks": with_("qa_pairs raw_pairs", f"WITH {_ASKED}, s AS (SELECT md5(grp) AS group_key, CASE WHEN r < floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' WHEN r < floor(n * CAST(0.8 AS DOUBLE)) + floor(n * CAST(0.1 AS DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM (SELECT grp, row_number() OVER (ORDER BY md5(concat_ws(':', row_id, '0')), row_id) - 1 AS r, count(*) OVER () AS n FROM asked)) SELECT group_key, count(*) AS n_rows, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM s GROUP BY 1 HAVING count(DISTINCT split) > 1"),
    "CUR14": with_("qa_pairs", "SELECT pair_id, CASE WHEN r < floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' WHEN r < floor(n * CAST(0.8 AS DOUBLE)) + floor(n * CAST(0.1 AS DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM (SELECT pair_id, row_number() OVER (ORDER BY md5(concat_ws(':', pair_id, '0')), pair_id) - 1 AS r, count(*) OVER () AS n FROM qa_pairs)"),
    "CUR15": ck("SELECT pair_id, md5(concat_ws(' | ', 'Generate SQL for the following question:', 'Question: ' || question, 'Tables: ' || array_to_string(relevant_tables, ', '), 'Columns: ' || array_to_string(relevant_columns, ', '))) AS input_md5 FROM ck WHERE is_valid"),
    "CUR16": with_("raw_pairs", "SELECT pair_id, md5('translate English to SQL: ' || question || CASE WHEN coalesce(schema_context, '') <> '' THEN ' | schema: ' || schema_context ELSE '' END) AS input_md5 FROM raw_pairs WHERE question IS NOT NULL"),
}
SQL = {k: v.replace("FROM ck) , ", "FROM ck), ").replace(") , ok AS", "), ok AS") for k, v in SQL.items()}

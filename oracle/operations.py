"""Files, sinks, streams and user code in SQL."""

from oracle.curation import CARDS
from oracle.curation import SQL as CURATION
from oracle.fixtures import with_
from oracle.profiles import SQL as PROFILES
from oracle.profiles import contents
from oracle.prompting import prompt
from oracle.scoring import SQL as SCORING
from oracle.scoring import STRAT, norm

_LOADED = "SELECT count(*) AS n, count(question) AS questions, count({sql}) AS statements, count(schema_context) AS contexts, CAST(sum(length(sql)) AS BIGINT) AS sql_chars FROM raw_pairs"

SQL = {
    "SRC01": with_("raw_pairs", _LOADED.format(sql="sql")),
    "SRC04": with_("raw_pairs", " UNION ALL ".join(
        f"SELECT *, '{kind}' AS kind FROM ({_LOADED.format(sql=sql)}{rows})" for kind, sql, rows in (
            ("json", "sql", ""), ("jsonl", "sql", ""), ("csv", "nullif(sql, '')", ""), ("xml", "sql", " WHERE false"),
            ("missing", "sql", " WHERE false")))),
    "SRC02": with_("raw_pairs", _LOADED.format(sql="sql")),
    # an empty text and no text are the same in CSV
    "SRC03": with_("raw_pairs", _LOADED.format(sql="nullif(sql, '')")),
    "SRC07": with_("eval_rows", f"WITH s AS ({STRAT}) SELECT 'now' AS timestamp, max(total_questions) OVER () AS total_questions, strategy, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("success_rate", "avg_confidence", "avg_execution_time", "avg_bleu_score", "execution_accuracy", "schema_compliance_rate")) + " FROM s"),
    "SNK01": f"SELECT split, count(*) AS n FROM ({CURATION['CUR14']}) GROUP BY 1",
    "SNK02": with_("dirty_docs", f"WITH st AS ({PROFILES['CLN07']}), c AS ({contents()}) SELECT c.*, original_rows, final_rows, duplicates_removed FROM c JOIN st USING (table_name)"),
    "SNK03": f"SELECT strategy, avg_bleu_score, total_questions FROM ({SCORING['ANA18']})",
    "SNK04": with_("eval_rows", "SELECT question_id // 5 AS question_id, count(*) AS n_results FROM eval_rows GROUP BY 1"),
    "SNK05": "SELECT o_orderstatus, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1",
    "SNK06": with_("columns_catalog", f"SELECT id, content, type FROM ({CARDS})"),
    "SNK07": f"SELECT (SELECT best_technique FROM ({SCORING['ANA14']})) AS best_technique, (SELECT count(*) FROM ({SCORING['ANA15']})) AS n_recommendations",
    "UDF01": with_("questions", "SELECT qid, CASE WHEN contains(question, 'How many') THEN 'SELECT COUNT(*) FROM orders' ELSE 'SELECT * FROM orders' END AS response FROM questions"),
    "UDF02": with_("sql_pairs", f"SELECT question_id, 'careful' AS technique, {norm('truth_sql')} AS sql, CAST(0.9 AS DOUBLE) AS confidence_score, false AS failed FROM sql_pairs UNION ALL SELECT question_id, 'sloppy', CASE WHEN question_id % 4 = 0 THEN '' ELSE {norm('lower(truth_sql)')} END, CASE WHEN question_id % 4 = 0 THEN 0.0 ELSE 0.5 END, question_id % 4 = 0 FROM sql_pairs"),
    "UDF03": with_("questions", f"SELECT qid, 'zero_shot' AS strategy, md5({prompt('zero_shot')}) AS prompt_md5 FROM questions UNION ALL SELECT qid, 'terse', md5('SQL for: ' || question) FROM questions"),
    "UDF04": with_("eval_rows", "SELECT technique, round(avg(CASE WHEN response_time > 1 THEN 1.0 ELSE 0.0 END), 6) AS slow_share, round(max(response_time) FILTER (NOT isinf(response_time)), 6) AS longest FROM eval_rows GROUP BY 1"),
    "STR01": "SELECT * FROM events",
    "STR02": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type AS strategy, count(*) AS calls, count(*) FILTER (event_id % 3 <> 0) AS correct, CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_id % 97 <> 0) AS DOUBLE) / 1e2 / count(*) FILTER (event_id % 97 <> 0) AS avg_time FROM events GROUP BY 1, 2",
}


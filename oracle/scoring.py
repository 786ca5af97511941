"""SQL text, safety, evaluation and analytics queries in SQL."""

from itertools import combinations

from oracle.fixtures import EVAL, PAIRS as PAIR_SQL, with_

STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
W = r"[\p{L}\p{N}_]"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(c):
    flat = f"regexp_replace(upper({STRIP.format(f'coalesce({c}, {chr(39)*2})')}), '\\s+', ' ', 'g')"
    return f"rtrim(rtrim({flat}, ';'))"


def strip(c):
    return STRIP.format(c)


def toks(c):
    return rf"regexp_extract_all(lower({c}), '{W}+|[^\p{{L}}\p{{N}}_\s]')"


def word_set(c):
    return rf"list_distinct(list_filter(string_split_regex({c}, '\s+'), lambda w: w <> ''))"


def jac(a, b):
    return (f"coalesce(len(list_intersect({a}, {b})) / nullif(CAST(len(list_distinct(list_concat({a}, {b}))) AS DOUBLE), 0), 0)")


def like_any(c, words):
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


def tables_in(c):
    return rf"list_distinct(list_concat(regexp_extract_all(upper({c}), 'FROM\s+(\w+)', 1), regexp_extract_all(upper({c}), 'JOIN\s+(\w+)', 1)))"


def complies(c):
    known = "[" + ", ".join(f"'{t.upper()}'" for t in TABLES) + "]"
    return f"({strip(c)} <> '' AND len(list_filter({tables_in(c)}, lambda x: NOT list_contains({known}, x))) = 0)"


def complexity(c):
    u = f"upper({c})"
    return (f"CASE WHEN pts >= 4 THEN 'complex' WHEN pts >= 2 THEN 'medium' ELSE 'simple' END", (
        f"(CASE WHEN contains({u}, 'JOIN') THEN 2 ELSE 0 END + CASE WHEN len(string_split({u}, 'SELECT')) - 1 > 1 THEN 2 ELSE 0 END "
        f"+ CASE WHEN {like_any(u, ['SUM', 'COUNT', 'AVG', 'MAX', 'MIN', 'GROUP BY'])} THEN 1 ELSE 0 END "
        f"+ CASE WHEN {like_any(u, ['OVER', 'PARTITION BY', 'ROW_NUMBER', 'RANK'])} THEN 2 ELSE 0 END "
        f"+ CASE WHEN contains({u}, 'WHERE') AND {like_any(u, ['AND', 'OR'])} THEN 1 ELSE 0 END)"))


def query_type(c):
    u = strip(f"upper({c})")
    return (f"CASE WHEN starts_with({u}, 'SELECT') THEN CASE WHEN {like_any(u, ['GROUP BY', 'SUM', 'COUNT', 'AVG', 'MAX', 'MIN'])} THEN 'select_aggregate' "
            f"WHEN contains({u}, 'JOIN') THEN 'select_join' ELSE 'select_simple' END "
            + " ".join(f"WHEN starts_with({u}, '{v}') THEN '{v.lower()}'" for v in ("INSERT", "UPDATE", "DELETE", "CREATE")) + " ELSE 'unknown' END")


def length_class(c):
    return f"CASE WHEN length({c}) < 50 THEN 'Short (<50)' WHEN length({c}) < 150 THEN 'Medium (50-150)' ELSE 'Long (>150)' END"


_TYPES = [("complex_aggregation", ["average", "more than", "less than", "compare", "ratio"]),
          ("multi_table_analysis", ["join", "across", "between", "relationship", "combined"]),
          ("temporal_comparison", ["monthly", "yearly", "trend", "over time", "period", "growth"]),
          ("conditional_logic", ["if", "when", "where", "classify", "categorize", "based on"])]


def question_type(c, word=False):
    def test(ws):
        return like_any(f"lower({c})", ws) if not word else f"regexp_matches(lower({c}), '\\b({'|'.join(ws)})\\b')"
    return "CASE " + " ".join(f"WHEN {test(ws)} THEN '{n}'" for n, ws in _TYPES) + " ELSE 'multi_table_analysis' END"


CATEGORIES = [("customer_analysis,delivery_analysis", ["customer", "city", "state", "user"]),
              ("product_analysis,payment_analysis", ["product", "category", "item", "revenue", "sales"]),
              ("delivery_analysis,temporal_analysis", ["delivery", "shipping", "time", "days"]),
              ("payment_analysis,product_analysis", ["payment", "pay", "method", "value"])]


def categories(c):
    return "CASE " + " ".join(f"WHEN {like_any(f'lower({c})', ws)} THEN '{n}'" for n, ws in CATEGORIES) + " ELSE 'customer_analysis,product_analysis' END"


_BLOCK = ["INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER", "TRUNCATE", "REPLACE", "MERGE"]
STATEMENTS = """
SELECT question_id, CASE question_id % 8 WHEN 1 THEN 'DROP TABLE t; ' || pred_sql WHEN 2 THEN 'UPDATE t SET created_at = 1'
  WHEN 3 THEN ' with x as (' || pred_sql || ') select * from x' WHEN 4 THEN 'CALL refresh()' WHEN 5 THEN 'SELECT created_at FROM t'
  ELSE pred_sql END AS sql FROM sql_pairs
"""


def bleu_ctes(source):
    """BLEU by exploding n-grams and joining their counts, the textbook way."""
    grams = "\n".join(
        f"{'UNION ALL ' if n > 1 else ''}SELECT question_id, side, {n} AS n, array_to_string(list_slice(t, i, i + {n - 1}), ' ') AS g FROM tk, LATERAL unnest(range(1, len(t) - {n} + 2)) u(i)"
        for n in range(1, 5))
    return f"""
tk AS (SELECT question_id, 'p' AS side, {toks('pred_sql')} AS t FROM {source} UNION ALL SELECT question_id, 't', {toks('truth_sql')} FROM {source}),
gr AS ({grams}),
gc AS (SELECT question_id, side, n, g, count(*) AS c FROM gr GROUP BY ALL),
hit AS (SELECT p.question_id, p.n, sum(least(p.c, t.c)) AS m FROM gc p JOIN gc t USING (question_id, n, g) WHERE p.side = 'p' AND t.side = 't' GROUP BY 1, 2),
ln_ AS (SELECT question_id, max(len(t)) FILTER (side = 'p') AS np, max(len(t)) FILTER (side = 't') AS nt FROM tk GROUP BY 1),
bl AS (SELECT l.question_id, CASE WHEN np = 0 OR nt = 0 OR coalesce(max(m) FILTER (h.n = 1), 0) = 0 THEN 0.0 ELSE
  (CASE WHEN np > nt THEN 1.0 ELSE exp(1 - nt / CAST(np AS DOUBLE)) END)
  * exp((SELECT avg(ln(coalesce(nullif(CAST(h2.m AS DOUBLE), 0), 0.1) / greatest(1, np - k + 1))) FROM range(1, 5) r(k) LEFT JOIN hit h2 ON h2.n = k AND h2.question_id = l.question_id)) END AS bleu_score
  FROM ln_ l LEFT JOIN hit h ON h.question_id = l.question_id GROUP BY l.question_id, np, nt)"""


OUTER = r"regexp_extract(response, '(?s)(\{.*\})', 1)"
LAST = r"regexp_extract(response, '(\{[^{]*\})[^{}]*$', 1)"
_FIELD = "CASE WHEN strategy IN ('self_consistency', 'least_to_most') THEN '$.final_sql' ELSE '$.sql' END"
_CFIELD = "CASE WHEN strategy = 'self_consistency' THEN '$.final_confidence' ELSE '$.confidence' END"
_MISSING = "CASE strategy WHEN 'zero_shot' THEN 0.5 WHEN 'chain_of_thought' THEN 0.5 WHEN 'few_shot' THEN 0.8 WHEN 'self_consistency' THEN 0.9 ELSE 0.85 END"
_FAILED = "CASE strategy WHEN 'zero_shot' THEN 0.5 WHEN 'chain_of_thought' THEN 0.3 WHEN 'few_shot' THEN 0.7 WHEN 'self_consistency' THEN 0.85 ELSE 0.75 END"


def _regex_sql(stops):
    hit = f"regexp_extract(response, '(?is)(SELECT\\s+.*?(?:{stops}|$))', 1)"
    return f"CASE WHEN {hit} = '' THEN 'SELECT 1' ELSE rtrim({strip(hit)}, ';') END"


_LINE = (f"coalesce(list_filter(list_transform(string_split(response, chr(10)), lambda x: {strip('x')}), "
         f"lambda x: regexp_matches(upper(x), 'SELECT|FROM|WHERE|JOIN|GROUP BY|ORDER BY'))[1], '')")
FALLBACK = (f"CASE WHEN strategy = 'chain_of_thought' THEN {_LINE} WHEN strategy IN ('self_consistency', 'least_to_most') "
            f"THEN {_regex_sql(';|' + chr(10))} ELSE {_regex_sql(';')} END")


def parsed(body):
    return with_("responses", f"""
WITH b AS (SELECT *, CASE WHEN {body} <> '' AND json_valid({body}) THEN {body} END AS j FROM responses),
v AS (SELECT *, json_extract_string(j, {_FIELD}) AS s, TRY_CAST(json_extract_string(j, {_CFIELD}) AS DOUBLE) AS c FROM b),
w AS (SELECT *, j IS NOT NULL AND (strategy NOT IN ('self_consistency', 'least_to_most') OR s IS NOT NULL) AS parsed FROM v)
SELECT question_id, strategy, parsed,
  CASE WHEN parsed THEN coalesce(s, CASE WHEN strategy = 'chain_of_thought' THEN '' ELSE {FALLBACK} END) ELSE {FALLBACK} END AS sql,
  CAST(CASE WHEN parsed THEN coalesce(c, {_MISSING}) ELSE {_FAILED} END AS DOUBLE) AS confidence FROM w""")


R6 = "round({}, 6)"
F_ = "CAST({} AS DOUBLE)"
OKT = "CASE WHEN response_time <> CAST('Infinity' AS DOUBLE) THEN response_time END"
LOG = f"SELECT e.*, p.truth_sql, p.pred_sql AS predicted_sql FROM ({EVAL}) e LEFT JOIN ({PAIR_SQL}) p USING (question_id)"


def log_(body):
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH log AS ({LOG}), {body[5:]}"
    return f"WITH log AS ({LOG}) {body}"


def corr(x, y):
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


CAL = f"greatest(0, coalesce({corr('confidence_score', F_.format('execution_correct'))}, 0))"
HEAD = {"total_samples": "count(*)", "execution_accuracy": "avg(CAST(execution_correct AS DOUBLE))",
        "exact_match_accuracy": "avg(CAST(exact_match AS DOUBLE))", "schema_compliance_rate": "avg(CAST(schema_compliant AS DOUBLE))",
        "average_bleu_score": "avg(bleu_score)", "average_response_time": "avg(response_time)", "average_confidence": "avg(confidence_score)",
        "error_rate": "avg(CASE WHEN error_message IS NOT NULL THEN 1.0 ELSE 0.0 END)"}
TIMES = {"min": f"min({OKT})", "max": f"max({OKT})", "median": f"median({OKT})", "std": f"stddev_pop({OKT})",
         "p95": f"quantile_cont({OKT}, 0.95)", "p99": f"quantile_cont({OKT}, 0.99)"}
BLEUS = {"min": "min(bleu_score)", "max": "max(bleu_score)", "median": "median(bleu_score)", "std": "stddev_pop(bleu_score)",
         "p25": "quantile_cont(bleu_score, 0.25)", "p75": "quantile_cont(bleu_score, 0.75)"}
CONFS = {"min": "min(confidence_score)", "max": "max(confidence_score)", "std": "stddev_pop(confidence_score)",
         "median": "median(confidence_score)", "calibration_score": CAL}
TYPES_ = {"count": "count(*)", "execution_correct": "count(*) FILTER (execution_correct)", "exact_match": "count(*) FILTER (exact_match)",
          "execution_accuracy": HEAD["execution_accuracy"], "exact_match_accuracy": HEAD["exact_match_accuracy"],
          "avg_bleu_score": "avg(bleu_score)", "avg_response_time": f"coalesce(sum({OKT}), 0) / count(*)"}


def cols(spec):
    return ", ".join(f"{v if v.startswith('count') else R6.format(v)} AS {k}" for k, v in spec.items())


def longform(spec, section, source, item="'all'", group=""):
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {item} AS item, '{k}' AS metric, round(CAST({v} AS DOUBLE), 6) AS value FROM {source} {group}"
        for k, v in spec.items())


_CX = complexity("coalesce(predicted_sql, '')")
COMPLEX = (f"(SELECT k.complexity, count(question_id) AS count, round(coalesce(avg(CAST(execution_correct AS DOUBLE)), 0), 6) AS accuracy "
           f"FROM (VALUES ('simple'), ('medium'), ('complex')) k(complexity) LEFT JOIN "
           f"(SELECT *, {_CX[0]} AS complexity FROM (SELECT *, {_CX[1]} AS pts FROM log)) l USING (complexity) GROUP BY 1)")
TYPED = f"(SELECT *, {query_type(chr(99) + 'oalesce(predicted_sql, ' + chr(39) * 2 + ')')} AS query_type FROM log)"

TECHNIQUES = ["click", "error", "purchase", "signup", "view"]
COMBOS = ", ".join(f"('{a}', '{b}')" for a, b in combinations(TECHNIQUES, 2))


def t_test(metric, where=""):
    return f"""
m AS (SELECT technique, count(*) AS n, avg(v) AS mean, stddev_pop(v) AS sd, var_samp(v) AS vr FROM (SELECT technique, CAST({metric} AS DOUBLE) AS v FROM eval_rows {where}) GROUP BY 1),
pr AS (SELECT * FROM (VALUES {COMBOS}) p(a, b)),
tt AS (SELECT a, b, '{metric}' AS metric, x.n AS sample_size_a, y.n AS sample_size_b, x.mean AS mean_a, y.mean AS mean_b, x.sd AS std_a, y.sd AS std_b,
  (x.mean - y.mean) / (sqrt(((x.n - 1) * x.vr + (y.n - 1) * y.vr) / (x.n + y.n - 2)) * sqrt(1.0 / x.n + 1.0 / y.n)) AS t_statistic,
  (x.mean - y.mean) / sqrt(((x.n - 1) * x.vr + (y.n - 1) * y.vr) / (x.n + y.n - 2)) AS cohens_d
  FROM pr JOIN m x ON x.technique = a JOIN m y ON y.technique = b)"""


U_TEST = f"""
WITH pr AS (SELECT * FROM (VALUES {COMBOS}) p(a, b)),
r AS (SELECT a, b, technique, response_time AS v FROM pr JOIN eval_rows ON technique IN (a, b) WHERE response_time <> CAST('Infinity' AS DOUBLE)),
k AS (SELECT *, rank() OVER (PARTITION BY a, b ORDER BY v) + (count(*) OVER (PARTITION BY a, b, v) - 1) / 2.0 AS mid FROM r),
s AS (SELECT a, b, sum(mid) FILTER (technique = a) AS r1, CAST(count(*) FILTER (technique = a) AS DOUBLE) AS n1, CAST(count(*) FILTER (technique = b) AS DOUBLE) AS n2 FROM k GROUP BY 1, 2),
ties AS (SELECT a, b, sum(CAST(c AS DOUBLE) ** 3 - c) AS t FROM (SELECT a, b, v, count(*) AS c FROM r GROUP BY 1, 2, 3) GROUP BY 1, 2),
u AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u1 FROM s JOIN ties USING (a, b))
SELECT a, b, 'response_time' AS metric, u1 AS u_statistic,
  (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - t / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM u"""



def simpson(top, density):
    """Two-sided tail beyond ``top``: Simpson's rule over 2,000 steps from 0 to it."""
    return (f"(SELECT greatest(0.0, 1 - 2 * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * ({density.format(x=f'({top} * i / 2000.0)')})) "
            f"* {top} / 6000) FROM range(2001) g(i))")


SIGNIFICANCE = f"""
WITH {t_test('response_time', "WHERE response_time <> CAST('Infinity' AS DOUBLE)").strip()},
un AS ({U_TEST}),
x AS (SELECT tt.*, u_statistic, abs(t_statistic) AS ta, z, sample_size_a + sample_size_b - 2 AS v FROM tt JOIN un USING (a, b)),
d AS (SELECT *, exp(lgamma((v + 1) / 2.0) - lgamma(v / 2.0)) / sqrt(v * pi()) AS front FROM x),
p AS (SELECT *, {simpson('ta', 'front * pow(1 + {x} * {x} / v, -(v + 1) / 2.0)')} AS t_pvalue,
  CASE WHEN z <= 0 THEN 1.0 ELSE {simpson('z', 'exp(-{x} * {x} / 2) / sqrt(2 * pi())')} END AS u_pvalue FROM d)
SELECT a, b, metric, sample_size_a, sample_size_b, {', '.join(f'round({c}, 6) AS {c}' for c in
  ('u_statistic', 'mean_a', 'mean_b', 'std_a', 'std_b', 't_statistic', 'cohens_d', 't_pvalue', 'u_pvalue'))},
  least(t_pvalue, u_pvalue) < 0.05 AS significant_at_05, least(t_pvalue, u_pvalue) < 0.01 AS significant_at_01 FROM p"""

STRICT = f"CAST(upper({strip('coalesce(predicted_sql, ' + chr(39) * 2 + ')')}) = upper({strip('coalesce(truth_sql, ' + chr(39) * 2 + ')')}) AS DOUBLE)"
TECH = f"""
SELECT technique, avg(CAST(execution_correct AS DOUBLE)) AS execution_accuracy, avg(CAST(exact_match AS DOUBLE)) AS exact_match_accuracy,
  avg(CAST(schema_compliant AS DOUBLE)) AS schema_compliance_rate, avg(bleu_score) AS avg_bleu_score, avg(response_time) AS avg_response_time,
  CASE WHEN bool_or(response_time = CAST('Infinity' AS DOUBLE)) THEN NULL ELSE stddev_pop({OKT}) END AS response_time_std, avg({OKT}) AS avg_time_ok,
  avg(confidence_score) AS avg_confidence, stddev_pop(confidence_score) AS confidence_std,
  avg(CASE WHEN response_time <> CAST('Infinity' AS DOUBLE) THEN 1.0 ELSE 0.0 END) AS success_rate, count(*) AS total_queries,
  avg(length(predicted_sql)) FILTER (predicted_sql <> '') AS prediction_length_avg,
  count(*) FILTER ({strip('coalesce(predicted_sql, ' + chr(39) * 2 + ')')} <> '') AS non_empty_predictions,
  quantile_cont(response_time, 0.5) AS median_response_time FROM log GROUP BY 1"""
SCORES = f"""
SELECT technique, 0.3 * execution_accuracy + 0.2 * exact_match_accuracy + 0.15 * schema_compliance_rate + 0.1 * avg_bleu_score
  - 0.1 * (1 - t / (SELECT max(CASE WHEN isinf(avg_response_time) THEN avg_time_ok ELSE avg_response_time END) FROM tech)) + 0.1 * success_rate + 0.05 * avg_confidence AS score
FROM (SELECT *, CASE WHEN isinf(avg_response_time) THEN avg_time_ok ELSE avg_response_time END AS t FROM tech)"""
STRAT = f"""
SELECT technique AS strategy, avg(CASE WHEN error_message IS NULL THEN 1.0 ELSE 0.0 END) AS success_rate, avg(confidence_score) AS avg_confidence,
  avg({OKT}) AS avg_execution_time, avg(bleu_score) AS avg_bleu_score, avg(CAST(execution_correct AS DOUBLE)) AS execution_accuracy,
  avg(CAST(schema_compliant AS DOUBLE)) AS schema_compliance_rate, count(*) AS total_questions FROM eval_rows GROUP BY 1"""
OVERALL = "SELECT arg_max(strategy, avg_bleu_score) AS best_strategy, round(avg(success_rate), 6) AS avg_success_rate, round(avg(avg_bleu_score), 6) AS avg_bleu_score, round(avg(execution_accuracy), 6) AS avg_execution_accuracy, count(*) AS total_strategies, max(total_questions) AS total_questions FROM s"
BOARD = {"total_queries": "count(*)", "execution_accuracy": HEAD["execution_accuracy"], "exact_match_accuracy": HEAD["exact_match_accuracy"],
         "schema_compliance_rate": HEAD["schema_compliance_rate"], "avg_bleu_score": "avg(bleu_score)", "avg_response_time": "avg(response_time)", "error_rate": HEAD["error_rate"]}
RAWBOARD = "SELECT technique AS model, " + ", ".join(f"{v} AS {k}" for k, v in BOARD.items()) + " FROM eval_rows GROUP BY 1"


def pct(c, d=1):
    return f"printf('%.{d}f%%', {c} * 100)"


def sec(c):
    return f"CASE WHEN isinf({c}) THEN 'inf' ELSE printf('%.3f', {c}) END"


def P(body):
    return with_("sql_pairs", body)


# the pairs by their kind: same statement, no predicate, missing table, same rows through a join
EVL04 = """
WITH counted AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL),
own AS (SELECT o_custkey, list((o_orderstatus, n) ORDER BY o_orderstatus) AS l FROM counted GROUP BY o_custkey),
whole AS (SELECT list((o_orderstatus, n) ORDER BY o_orderstatus) AS l FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)),
linked AS (
  SELECT c_custkey, list((o_orderstatus, n) ORDER BY o_orderstatus) AS l
  FROM (SELECT c_custkey, o_orderstatus, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL) GROUP BY 1)
SELECT o_orderkey AS question_id, CASE o_orderkey % 6 WHEN 3 THEN own.l = whole.l WHEN 4 THEN false
  WHEN 5 THEN coalesce(own.l = linked.l, false) ELSE true END AS execution_correct
FROM orders JOIN own USING (o_custkey) CROSS JOIN whole LEFT JOIN linked ON c_custkey = o_custkey
"""

SQL = {
    "TXT01": P(f"SELECT question_id, {norm('pred_sql')} AS normalised FROM sql_pairs"),
    "TXT02": P(f"SELECT question_id, array_to_string({toks('pred_sql')}, ' ') AS tokens FROM sql_pairs"),
    "TXT02_documents": f"SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM (SELECT doc_id, {toks('text')} AS t FROM documents)",
    "TXT03": P(f"SELECT question_id, {complexity('pred_sql')[0]} AS complexity FROM (SELECT question_id, {complexity('pred_sql')[1]} AS pts FROM sql_pairs)"),
    "TXT04": P(f"SELECT question_id, {query_type('pred_sql')} AS query_type FROM sql_pairs"),
    "TXT05": P(f"SELECT question_id, array_to_string(list_sort({tables_in('pred_sql')}), ',') AS tables FROM sql_pairs"),
    "TXT06": P(f"SELECT question_id, {length_class('pred_sql')} AS length_class FROM sql_pairs"),
    "TXT07": with_("questions", f"SELECT qid, {question_type('question')} AS question_type, {question_type('question', True)} AS question_type_word FROM questions"),
    "TXT08": with_("questions", f"SELECT qid, {categories('question')} AS categories FROM questions"),
    "TXT09": P(f"SELECT question_id, CAST(CASE WHEN n < 10 THEN 0.5 WHEN n < 20 THEN 0.8 ELSE 0.9 END AS DOUBLE) AS confidence FROM (SELECT question_id, len({toks('pred_sql')}) AS n FROM sql_pairs)"),
    "TXT10": parsed(LAST),
    "TXT10_outer": parsed(OUTER),
    "TXT11": with_("responses", f"SELECT question_id, strategy, {FALLBACK} AS sql FROM responses"),
    "TXT12": with_("responses", f"""
WITH b AS (SELECT *, {OUTER} AS body FROM responses), v AS (SELECT *, CASE WHEN body <> '' AND json_valid(body) THEN body END AS j FROM b),
m AS (SELECT *, array_to_string(list_filter(['sql', 'used_tables', 'used_columns', 'reason_short', 'confidence'], lambda f: NOT list_contains(json_keys(j), f)), ',') AS missing FROM v)
SELECT question_id, strategy, CASE WHEN body = '' THEN 'no_json' WHEN j IS NULL THEN 'bad_json' WHEN missing <> '' THEN 'missing_field' ELSE 'ok' END AS status,
  CASE WHEN j IS NOT NULL THEN missing END AS missing_fields, json_extract_string(j, '$.sql') AS sql FROM m"""),
    "SAF01": P(f"WITH st AS ({STATEMENTS}) SELECT question_id, NOT {like_any('upper(sql)', _BLOCK + ['EXEC'])} AND regexp_matches({strip('upper(sql)')}, '^(SELECT|WITH)\\b') AS is_safe FROM st"),
    "SAF02": P(f"WITH st AS ({STATEMENTS}) SELECT question_id, NOT {like_any('upper(sql)', _BLOCK + ['CALL', 'EXEC'])} AS is_safe FROM st"),
    "SAF03": P(f"WITH st AS ({STATEMENTS}) SELECT question_id, regexp_matches(lower({strip('sql')}), '^(select|with)') AS is_safe FROM st"),
    "SAF04": "SELECT 'SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus' AS sql, true AS success, (SELECT count(DISTINCT o_orderstatus) FROM orders) AS row_count UNION ALL SELECT 'WITH big AS (SELECT * FROM lineitem WHERE l_quantity > 49) SELECT l_returnflag, COUNT(*) AS n FROM big GROUP BY 1', true, (SELECT count(DISTINCT l_returnflag) FROM lineitem WHERE l_quantity > 49) UNION ALL SELECT 'SELECT * FROM customer', true, (SELECT count(*) FROM customer) UNION ALL SELECT unnest(['DROP TABLE orders', 'WITH a AS (SELECT 1) INSERT INTO orders SELECT * FROM a', 'SELECT * FROM missing_table', '']), false, NULL",
    "SAF05": "SELECT *, (SELECT count(*) FROM orders) AS total_rows FROM orders ORDER BY o_orderkey LIMIT 100",
    "EVL01": P(f"SELECT question_id, {norm('pred_sql')} = {norm('truth_sql')} AS exact_match FROM sql_pairs"),
    "EVL02": P(f"SELECT question_id, round(j, 6) AS similarity, j > 0.7 AS similar FROM (SELECT question_id, {jac('a', 'b')} AS j FROM (SELECT question_id, {word_set(norm('pred_sql'))} AS a, {word_set(norm('truth_sql'))} AS b FROM sql_pairs))"),
    "EVL03": """
WITH f AS (SELECT l_returnflag AS x, l_linestatus AS y FROM lineitem), g AS (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'R' ELSE l_returnflag END AS x, l_linestatus AS y FROM lineitem),
k AS (SELECT o_orderkey FROM orders WHERE o_totalprice > 1000)
SELECT 'same' AS comparison, unnest(['set', 'bag']) AS mode, true AS same
UNION ALL SELECT 'copies', 'set', NOT EXISTS (SELECT * FROM f EXCEPT SELECT * FROM g) AND NOT EXISTS (SELECT * FROM g EXCEPT SELECT * FROM f)
UNION ALL SELECT 'copies', 'bag', NOT EXISTS (SELECT * FROM f EXCEPT ALL SELECT * FROM g) AND NOT EXISTS (SELECT * FROM g EXCEPT ALL SELECT * FROM f)
UNION ALL SELECT 'fewer', unnest(['set', 'bag']), (SELECT count(*) FROM k) = (SELECT count(*) FROM orders)""",
    "EVL04": EVL04,
    "EVL05": P(f"WITH {bleu_ctes('sql_pairs').strip()} SELECT question_id, round(bleu_score, 6) AS bleu_score FROM bl"),
    "EVL06": P(f"WITH {bleu_ctes('sql_pairs').strip()} SELECT round(avg(bleu_score), 6) AS mean_bleu FROM bl"),
    "EVL07": P(f"SELECT question_id, {complies('pred_sql')} AS schema_compliant FROM sql_pairs"),
    "EVL08": P(f"SELECT round(avg(CAST({complies('pred_sql')} AS DOUBLE)), 6) AS compliance_rate FROM sql_pairs"),
    "EVL09": P(f"WITH {bleu_ctes('sql_pairs').strip()} SELECT question_id, NOT gone AND {jac(word_set(norm('pred_sql')), word_set(norm('truth_sql')))} > 0.7 AS execution_correct, NOT gone AND {norm('pred_sql')} = {norm('truth_sql')} AS exact_match, NOT gone AND {complies('pred_sql')} AS schema_compliant, round(CASE WHEN gone THEN 0.0 ELSE bleu_score END, 6) AS bleu_score, CASE WHEN gone THEN 'no prediction' END AS error_message FROM (SELECT *, question_id % 10 = 0 AS gone FROM sql_pairs) JOIN bl USING (question_id)"),
    "EVL10": P("SELECT question_id, CASE WHEN question_id % 7 = 0 THEN 'truth only' WHEN question_id % 11 = 0 THEN 'prediction only' ELSE 'aligned' END AS side FROM sql_pairs WHERE NOT (question_id % 7 = 0 AND question_id % 11 = 0)"),
    "EVL11": P(f"SELECT round(avg(CASE WHEN x = y OR (len(a) > 0 AND len(b) > 0 AND {jac('a', 'b')} > 0.7) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM (SELECT x, y, {word_set('x')} AS a, {word_set('y')} AS b FROM (SELECT replace(upper({strip('pred_sql')}), ';', '') AS x, replace(upper({strip('truth_sql')}), ';', '') AS y FROM sql_pairs))"),
    "EVL12": P(f"SELECT round(avg(CAST(upper({strip('pred_sql')}) = upper({strip('truth_sql')}) AS DOUBLE)), 6) AS exact_match FROM sql_pairs"),
    "EVL13": P("SELECT question_id, upper(pred_sql) AS output, true AS timed FROM sql_pairs"),
    "ANA01": with_("eval_rows", f"SELECT technique, {cols(HEAD)} FROM eval_rows GROUP BY 1"),
    "ANA02": with_("eval_rows", f"SELECT technique, {cols(TIMES)} FROM eval_rows GROUP BY 1"),
    "ANA03": with_("eval_rows", f"SELECT technique, {cols(BLEUS)} FROM eval_rows GROUP BY 1"),
    "ANA04": with_("eval_rows", f"SELECT technique, {cols(CONFS)} FROM eval_rows GROUP BY 1"),
    "ANA05": with_("eval_rows", f"SELECT technique, round({CAL}, 6) AS calibration_score FROM eval_rows GROUP BY 1"),
    "ANA06": log_(f"SELECT * FROM {COMPLEX}"),
    "ANA07": log_(f"SELECT query_type, {cols(TYPES_)} FROM {TYPED} GROUP BY 1"),
    "ANA08": log_(" UNION ALL ".join([longform(HEAD, "overall", "log"), longform(TIMES, "response_time", "log"), longform(BLEUS, "bleu_score", "log"),
                                      longform(CONFS, "confidence", "log"), longform({"count": "count", "accuracy": "accuracy"}, "complexity", COMPLEX, "complexity"),
                                      longform(TYPES_, "query_type", TYPED, "query_type", "GROUP BY query_type")])),
    "ANA09": with_("eval_rows", f"WITH {t_test('bleu_score').strip()} SELECT a, b, metric, sample_size_a, sample_size_b, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("mean_a", "mean_b", "std_a", "std_b", "t_statistic", "cohens_d")) + " FROM tt"),
    "ANA10": with_("eval_rows", f"SELECT a, b, metric, round(u_statistic, 6) AS u_statistic, round(z, 6) AS z FROM ({U_TEST})"),
    "ANA11": with_("eval_rows", SIGNIFICANCE),
    "ANA12": log_(f"WITH tech AS ({TECH}) SELECT technique, total_queries, non_empty_predictions, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("execution_accuracy", "exact_match_accuracy", "schema_compliance_rate", "avg_bleu_score", "avg_response_time", "response_time_std", "avg_time_ok", "avg_confidence", "confidence_std", "success_rate", "prediction_length_avg", "median_response_time")) + " FROM tech"),
    "ANA13": log_(f"SELECT technique, round(coalesce({corr('confidence_score', STRICT)}, 0), 6) AS confidence_accuracy_correlation FROM log GROUP BY 1"),
    "ANA14": log_(f"WITH tech AS ({TECH}), sc AS ({SCORES}) SELECT technique AS best_technique, round(score, 6) AS score FROM sc ORDER BY score DESC, technique LIMIT 1"),
    "ANA14_scores": log_(f"WITH tech AS ({TECH}), sc AS ({SCORES}) SELECT technique, round(score, 6) AS score FROM sc"),
    "ANA15": log_(f"""WITH tech AS ({TECH})
SELECT section, technique, seq, text FROM (
 SELECT 1 AS section, '' AS technique, 0 AS seq, CASE WHEN avg(execution_accuracy) < 0.7 THEN 'Overall accuracy is below 70%. Consider improving training data quality or model architecture.' END AS text FROM tech
 UNION ALL SELECT 1, '', 1, CASE WHEN avg(avg_response_time) > 2.0 THEN 'Average response time exceeds 2 seconds. Consider model optimization or caching strategies.' END FROM tech
 UNION ALL SELECT 2, technique, 0, CASE WHEN execution_accuracy < 0.6 THEN printf('%s: Low accuracy (%.1f%%). Consider technique-specific improvements or parameter tuning.', technique, execution_accuracy * 100) END FROM tech
 UNION ALL SELECT 2, technique, 1, CASE WHEN avg_response_time > 3.0 THEN technique || ': High response time (' || CASE WHEN isinf(avg_response_time) THEN 'inf' ELSE printf('%.1f', avg_response_time) END || 's). Optimize for faster inference.' END FROM tech
 UNION ALL SELECT 2, technique, 2, CASE WHEN avg_confidence < 0.5 THEN printf('%s: Low confidence scores (%.2f). Review confidence calibration.', technique, avg_confidence) END FROM tech
 UNION ALL SELECT 3, '', 0, printf('For highest accuracy, use %s. For fastest response, use %s.', (SELECT technique FROM tech ORDER BY execution_accuracy DESC, technique LIMIT 1), (SELECT technique FROM tech ORDER BY avg_response_time, technique LIMIT 1))
) WHERE text IS NOT NULL"""),
    "ANA16": with_("eval_rows", f"SELECT technique AS model, {cols(BOARD)} FROM eval_rows GROUP BY 1"),
    "ANA17": with_("eval_rows", f"WITH b AS ({RAWBOARD}) SELECT model, concat_ws(chr(10), 'Model: ' || model, '  Execution Accuracy: ' || {pct('execution_accuracy')}, '  Exact Match: ' || {pct('exact_match_accuracy')}, '  Schema Compliance: ' || {pct('schema_compliance_rate')}, '  BLEU Score: ' || printf('%.3f', avg_bleu_score), '  Response Time: ' || {sec('avg_response_time')} || 's', '  Error Rate: ' || {pct('error_rate')}) AS text FROM b"),
    "ANA18": with_("eval_rows", f"WITH s AS ({STRAT}) SELECT strategy, total_questions, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("success_rate", "avg_confidence", "avg_execution_time", "avg_bleu_score", "execution_accuracy", "schema_compliance_rate")) + " FROM s"),
    "ANA19": with_("eval_rows", f"WITH s AS ({STRAT}) {OVERALL}"),
    "ANA20": log_("SELECT technique, round(avg(CASE WHEN contains(upper(coalesce(predicted_sql, '')), 'SELECT') AND contains(upper(coalesce(predicted_sql, '')), 'FROM') THEN 1.0 ELSE 0.0 END), 6) AS execution_accuracy FROM log GROUP BY 1"),
    "ANA21": with_("eval_rows", "SELECT 'outcome' AS chart, CASE WHEN error_message IS NOT NULL THEN 'Error' ELSE 'Success' END AS label, count(*) AS n FROM eval_rows GROUP BY 2 UNION ALL SELECT 'compliance', CASE WHEN schema_compliant THEN 'Compliant' ELSE 'Non-Compliant' END, count(*) FROM eval_rows GROUP BY 2"),
    "ANA22": with_("eval_rows", "SELECT technique, actual, predicted, count(*) FILTER (execution_correct = actual AND exact_match = predicted) AS n FROM eval_rows, (VALUES (false), (true)) a(actual), (VALUES (false), (true)) b(predicted) GROUP BY 1, 2, 3"),
    "ANA23": log_(f"SELECT k.length_class, count(question_id) AS n, round(coalesce(avg(CASE WHEN execution_correct THEN 0.0 WHEN NOT execution_correct THEN 1.0 END), 0), 6) AS error_rate FROM (VALUES ('Short (<50)'), ('Medium (50-150)'), ('Long (>150)')) k(length_class) LEFT JOIN (SELECT *, {length_class('coalesce(predicted_sql, ' + chr(39) * 2 + ')')} AS length_class FROM log) l USING (length_class) GROUP BY 1"),
    "ANA24": with_("eval_rows", "WITH r AS (SELECT technique, confidence_score AS v FROM eval_rows WHERE error_message IS NULL), b AS (SELECT technique, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM r GROUP BY 1) SELECT technique, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_low, round(max(v) FILTER (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high, count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers, count(*) AS n FROM r JOIN b USING (technique) GROUP BY technique, q1, median, q3"),
    "ANA25": with_("eval_rows", "SELECT question_id // 5 AS entry, max(ts) AS ts, count(*) FILTER (error_message IS NULL) AS successful, count(*) AS total FROM eval_rows GROUP BY 1 ORDER BY ts DESC, entry DESC LIMIT 10"),
    "ANA26": with_("eval_rows", f"WITH s AS ({STRAT}) SELECT upper(strategy[1]) || strategy[2:] AS strategy, printf('%.3f', avg_bleu_score) AS bleu_score, {pct('success_rate')} AS success_rate, {pct('execution_accuracy')} AS execution_accuracy, {pct('schema_compliance_rate')} AS schema_compliance, printf('%.3f', avg_confidence) AS avg_confidence, printf('%.2f', avg_execution_time * 1000) AS avg_time_ms FROM s"),
    "CHT14": with_("eval_rows", f"WITH b AS ({RAWBOARD}) SELECT model, metric, round(value, 6) AS value FROM (UNPIVOT (SELECT model, execution_accuracy, exact_match_accuracy, schema_compliance_rate, avg_bleu_score, avg_response_time, CAST(error_rate AS DOUBLE) AS error_rate FROM b) ON execution_accuracy, exact_match_accuracy, schema_compliance_rate, avg_bleu_score, avg_response_time, error_rate INTO NAME metric VALUE value)"),
    "CHT15": with_("eval_rows", f"WITH b AS (SELECT technique, avg(CAST(execution_correct AS DOUBLE)) AS acc, avg(CAST(exact_match AS DOUBLE)) AS ex, avg(bleu_score) AS bleu, avg(CAST(schema_compliant AS DOUBLE)) AS comp, avg({OKT}) AS rt FROM eval_rows GROUP BY 1) SELECT round(avg(acc), 6) AS avg_execution_accuracy, round(avg(ex), 6) AS avg_exact_match, round(avg(bleu), 6) AS avg_bleu_score, round(avg(comp), 6) AS avg_schema_compliance, (SELECT technique FROM b ORDER BY acc DESC, technique LIMIT 1) AS best_model, (SELECT technique FROM b ORDER BY rt, technique LIMIT 1) AS fastest_model, (SELECT round(count(*) FILTER (error_message IS NULL) / CAST(count(*) AS DOUBLE), 6) FROM eval_rows) AS success_share FROM b"),
    "SNK08": with_("eval_rows", "SELECT question_id // 5 AS question_id, " + ", ".join(f"round(max({c}) FILTER (technique = '{n}'), 6) AS {n}_{c}" for n in TECHNIQUES for c in ("bleu_score", "confidence_score")) + " FROM eval_rows GROUP BY 1"),
    "SNK08_results": with_("eval_rows", "SELECT question_id // 5 AS question_id, technique, round(max(bleu_score), 6) AS bleu_score, round(max(confidence_score), 6) AS confidence_score FROM eval_rows GROUP BY 1, 2"),
    "SNK08_summary": with_("eval_rows", f"WITH s AS ({STRAT}) {OVERALL}"),
}

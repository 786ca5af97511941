"""Profiling, chart and cleaning queries in SQL."""

from oracle.fixtures import with_

_LINE_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_DIRTY_COLS = ["doc_id", "lang", "source", "n_chars", "created_timestamp", "quality", "toxic"]
_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations"]
_WIDTH = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
          "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4}


def each(items, form, glue=" UNION ALL "):
    return glue.join(form(x) for x in items)


def describe(table, c):
    return (f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
            f"CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, "
            f"round(quantile_cont({c}, 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {table}")


def categorical(table, names):
    def one(c):
        return (f"SELECT '{c}' AS \"column\", count({c}) AS unique_count, "
                f"arg_max({c}, -rk) FILTER (rk = 1) AS most_common, CAST(max(n) FILTER (rk = 1) AS BIGINT) AS most_common_count, "
                f"CAST(max(n) FILTER (rk = 1) AS DOUBLE) / sum(n) AS share "
                f"FROM (SELECT {c}, n, row_number() OVER (ORDER BY CASE WHEN {c} IS NULL THEN 1 ELSE 0 END, n DESC, {c}) AS rk "
                f"FROM (SELECT {c}, count(*) AS n FROM {table} GROUP BY 1))")
    return each(names, one)


_DOM = ("CASE WHEN share > 0.8 THEN 'dominated' WHEN share < 0.2 AND unique_count > 5 THEN 'well distributed' END")
_MISSING = each(list(enumerate(_DIRTY_COLS)), lambda x: f"SELECT {x[0]} AS i, '{x[1]}' AS \"column\", count(*) FILTER ({x[1]} IS NULL) AS missing FROM dirty_docs")

_INSIGHT_NUM = ["doc_id", "n_chars", "quality", "toxic"]
_INSIGHT_TXT = ["lang", "source", "created_timestamp"]
_POS = {c: i for i, c in enumerate(_DIRTY_COLS)}


def _num_insights(c):
    i = _POS[c]
    return f"""
SELECT 1 AS section, {i} AS ordinal, seq, text FROM (
  SELECT avg({c}) AS m, median({c}) AS md, stddev_samp({c}) AS s, min({c}) AS lo, max({c}) AS hi FROM dirty_docs) a,
  LATERAL (SELECT count(*) AS o FROM dirty_docs WHERE abs({c} - m) > 2 * s) b,
  LATERAL (VALUES (1, printf('{c}: Average is %.2f', m)), (2, printf('{c}: Range from %.2f to %.2f', CAST(lo AS DOUBLE), CAST(hi AS DOUBLE))),
    (3, CASE WHEN o > 0 THEN printf('{c}: Found %d potential outliers', o) END),
    (4, CASE WHEN abs(m - md) > 0.1 * s THEN CASE WHEN m > md THEN '{c}: Data appears right-skewed' ELSE '{c}: Data appears left-skewed' END END)) v(seq, text)
WHERE text IS NOT NULL"""


def _txt_insights(c):
    i = _POS[c]
    return f"""
SELECT 2, {i}, seq, text FROM (SELECT *, {_DOM} AS dom FROM ({categorical('dirty_docs', [c])})) a,
  LATERAL (VALUES (0, printf('{c}: %d unique values', unique_count)),
    (1, printf('{c}: Most common value is ''%s'' (%.1f%%)', most_common, share * 100)),
    (2, CASE dom WHEN 'dominated' THEN '{c}: Highly dominated by one value' WHEN 'well distributed' THEN '{c}: Values are well distributed' END)) v(seq, text)
WHERE text IS NOT NULL"""


def _bins(table, value, n, digits, keys="", right=False):
    """Bins by comparison with the edges lo + i * (hi - lo) / n."""
    key = f"{keys}, " if keys else ""
    op = ">" if right else ">="
    slot = " + ".join(f"CASE WHEN x {op} lo + {i} * ((hi - lo) / {n}) THEN 1 ELSE 0 END" for i in range(1, n))
    low = f"lo + i * ((hi - lo) / {n})"
    if right:
        low = f"CASE WHEN i = 0 THEN lo - 0.001 * (hi - lo) ELSE {low} END"
    keyed = f"(SELECT DISTINCT {keys} FROM {table}) k, " if keys else ""
    using = f"USING ({keys}, i)" if keys else "USING (i)"
    return (f"WITH e AS (SELECT CAST(min({value}) AS DOUBLE) AS lo, CAST(max({value}) AS DOUBLE) AS hi FROM {table}), "
            f"c AS (SELECT {key}{slot} AS i, count(*) AS n FROM (SELECT {key}CAST({value} AS DOUBLE) AS x FROM {table} WHERE {value} IS NOT NULL), e GROUP BY ALL), "
            f"s AS (SELECT {key}CAST(range AS INTEGER) AS i, lo, hi FROM {keyed}range({n}), e) "
            f"SELECT {key}CAST(i + 1 AS BIGINT) AS bin, round({low}, {digits}) AS lower, round(lo + (i + 1) * ((hi - lo) / {n}), {digits}) AS upper, "
            f"coalesce(n, 0) AS n FROM s LEFT JOIN c {using}")


_DEDUPED = "SELECT DISTINCT * FROM dirty_docs"


def _med(c):
    return f"coalesce(CAST({c} AS DOUBLE), (SELECT CAST(median({c}) AS DOUBLE) FROM src)) AS {c}"


def _mod(c):
    return (f"coalesce({c}, (SELECT {c} FROM src WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), 'unknown') AS {c}")


_CLEAN = (f"SELECT doc_id, lower(trim(lang)) AS lang, lower(trim(source)) AS source, n_chars, "
          f"TRY_CAST(created_timestamp AS TIMESTAMP) AS created_timestamp, quality, toxic FROM "
          f"(SELECT doc_id, {_mod('lang')}, {_mod('source')}, {_med('n_chars')}, {_mod('created_timestamp')}, {_med('quality')}, {_med('toxic')} FROM src)")
_NULLS = "+".join(f"count(*) FILTER ({c} IS NULL)" for c in _DIRTY_COLS)
_STATS = (f"SELECT 'dirty_docs' AS table_name, b.n AS original_rows, a.n AS final_rows, b.n - a.n AS duplicates_removed, "
          f"b.g AS original_nulls, a.g AS final_nulls, CAST(7 AS BIGINT) AS columns "
          f"FROM (SELECT count(*) AS n, {_NULLS} AS g FROM dirty_docs) b, (SELECT count(*) AS n, {_NULLS} AS g FROM ({_CLEAN})) a")
# columns of the given tables by kind: keys (never filled), numbers, texts, others
_KINDS = {
    "region": ("r_regionkey", "", "r_name", ""),
    "nation": ("n_nationkey", "n_regionkey", "n_name", ""),
    "customer": ("c_custkey", "c_nationkey c_acctbal", "c_name c_mktsegment", ""),
    "supplier": ("s_suppkey", "s_nationkey s_acctbal", "s_name", ""),
    "part": ("p_partkey", "p_size p_retailprice", "p_name p_brand p_type", ""),
    "orders": ("o_orderkey", "o_custkey o_totalprice", "o_orderstatus o_orderpriority", "o_orderdate"),
    "lineitem": ("l_orderkey l_linenumber", "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax",
                 "l_returnflag l_linestatus", "l_shipdate"),
    "events": ("event_id", "user_id value", "event_type props", "ts"),
    "documents": ("doc_id", "n_chars", "text lang source", ""),
    "embeddings": ("vec_id", "label", "", "embedding"),
    "pages": ("page_id", "", "url html", ""),
    "benchmark": ("item_id", "", "text", ""),
    "labels": ("doc_id", "quality toxic", "", ""),
    "conversations": ("conv_id turn", "", "role text", ""),
}


def _kinds(table):
    return [k.split() for k in _KINDS[table]]


def _filled(table):
    keys, numbers, texts, others = _kinds(table)
    return ", ".join([*keys, *others, *[_med(c) for c in numbers],
                      *[f"lower(trim({c})) AS {c}" for c in texts]]), ", ".join([*keys, *others, *numbers, *[_mod(c) for c in texts]])


def cleaned(table):
    """A given table after all cleaning steps; none has dates as text."""
    done, first = _filled(table)
    return f"WITH src AS (SELECT DISTINCT * FROM {table}) SELECT {done} FROM (SELECT {first} FROM src)"


def _gaps(table):
    return " + ".join(f"count(*) FILTER ({c} IS NULL)" for kind in _kinds(table) for c in kind)


def _table_stats(x):
    return (f"SELECT '{x}', b.n, a.n, b.n - a.n, b.g, a.g, {_WIDTH[x]} FROM (SELECT count(*) AS n, {_gaps(x)} AS g FROM {x}) b, "
            f"(SELECT count(*) AS n, {_gaps(x)} AS g FROM ({cleaned(x)})) a")


_PLAIN = each(_TABLES, _table_stats)


def _contents(name, rows, numbers, texts, others):
    def one(c):
        if c in others:
            total = "CAST(NULL AS BIGINT)"
        else:
            total = f"sum(length({c}))" if c in texts else f"sum(CAST(floor(CAST({c} AS DOUBLE) * 100 + 0.5) AS BIGINT))"
        return f"SELECT '{name}' AS table_name, '{c}' AS \"column\", count({c}) AS n, CAST({total} AS BIGINT) AS total FROM ({rows})"
    return each([*numbers, *texts, *others], one)


def contents():
    """Values and totals per column of every cleaned table."""
    dirty = _contents("dirty_docs", f"WITH src AS ({_DEDUPED}) {_CLEAN}", ["doc_id", "n_chars", "quality", "toxic"],
                      ["lang", "source"], ["created_timestamp"])
    def one(x):
        keys, numbers, texts, others = _kinds(x)
        return _contents(x, cleaned(x), keys + numbers, texts, others)
    return f"{dirty} UNION ALL {each(_TABLES, one)}"


_KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey",
         "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey,l_linenumber", "events": "event_id",
         "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id",
         "labels": "doc_id", "conversations": "conv_id,turn"}
_REFS = [("nation", "n_regionkey", "region", "r_regionkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
         ("supplier", "s_nationkey", "nation", "n_nationkey"), ("orders", "o_custkey", "customer", "c_custkey"),
         ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
         ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("labels", "doc_id", "documents", "doc_id")]

_METRICS = ["execution_correct", "bleu_score", "schema_compliant"]


def _r(a, b):
    a, b = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)"


def _trend(y):
    y_, x = f"CAST({y} AS DOUBLE)", "confidence_score"
    slope = f"covar_pop({x}, {y_}) / var_pop({x})"
    return f"SELECT '{y}' AS target, round({slope}, 6) AS slope, round(avg({y_}) - {slope} * avg({x}), 6) AS intercept FROM eval_rows"


SQL = {
    "SRC05": each(_TABLES, lambda x: f"SELECT '{x}' AS table_name, count(*) AS rows, CAST({_WIDTH[x]} AS BIGINT) AS columns FROM {x}"),
    "PRF01": each(_LINE_NUM, lambda c: describe("lineitem", c)),
    "PRF02": with_("dirty_docs", each(_INSIGHT_NUM, lambda c: f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, CAST(max({c}) - min({c}) AS DOUBLE) AS range FROM dirty_docs")),
    "PRF03": each(_LINE_NUM, lambda c: f"SELECT '{c}' AS \"column\", count(*) AS outliers FROM lineitem, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM lineitem) WHERE s > 0 AND abs({c} - m) > 2 * s"),
    "PRF04": each(["event_id", "user_id", "value"], lambda c: f"SELECT '{c}' AS \"column\", CASE WHEN abs(avg({c}) - median({c})) > 0.1 * stddev_samp({c}) THEN CASE WHEN avg({c}) > median({c}) THEN 'right' ELSE 'left' END END AS skew FROM events"),
    "PRF05": with_("dirty_docs", f"SELECT * REPLACE (round(share, 6) AS share) FROM ({categorical('dirty_docs', _INSIGHT_TXT)})"),
    "PRF06": f"WITH u AS (SELECT url, 'y' AS kind FROM pages UNION ALL SELECT 'none', 'x' FROM pages UNION ALL SELECT 'none', 'x' FROM customer) SELECT \"column\", {_DOM} AS dominance FROM ({categorical('u', ['url', 'kind'])})",
    "PRF07": with_("dirty_docs", f"SELECT \"column\", missing, CAST(sum(missing) OVER () AS BIGINT) AS total_missing, missing > 0 AND row_number() OVER (ORDER BY missing DESC, i) = 1 AS is_worst FROM ({_MISSING})"),
    "PRF08": with_("dirty_docs", "SELECT (SELECT count(*) FROM dirty_docs) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty_docs)) AS duplicate_rows"),
    "PRF09": "SELECT table_name, row_count, CASE WHEN row_count = 1 THEN 'single row' WHEN row_count < 10 THEN 'small' WHEN row_count > 1000 THEN 'large' ELSE 'medium' END AS size_class FROM (SELECT 'region' AS table_name, count(*) AS row_count FROM region UNION ALL SELECT 'benchmark', count(*) FROM benchmark UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'total', count(*) FROM (SELECT sum(o_totalprice) FROM orders))",
    "PRF10": with_("dirty_docs", f"SELECT * FROM ({each(_INSIGHT_NUM, _num_insights)} UNION ALL {each(_INSIGHT_TXT, _txt_insights)}) ORDER BY 1, 2, 3 LIMIT 10"),
    "PRF11": "SELECT count(*) AS row_count, CAST(6 AS BIGINT) AS column_count, printf('Query returned %d rows and 6 columns. This appears to be an aggregation query. This query involves multiple tables. Results are sorted. Found 3 numeric columns for analysis.', count(*)) AS summary FROM orders",
    "PRF12": with_("dirty_docs", f"SELECT row_number() OVER (ORDER BY i) AS ordinal, text AS recommendation FROM (SELECT count(*) AS n, {_NULLS} AS gaps FROM dirty_docs), LATERAL (VALUES (1, CASE WHEN n > 100 THEN 'Consider adding LIMIT clause for large result sets' END), (2, CASE WHEN n > 10 THEN 'Consider adding ORDER BY for consistent results' END), (3, 'Multiple numeric columns found - consider correlation analysis'), (4, 'Numeric data available - consider aggregations (SUM, AVG, MAX)'), (5, 'Categorical data found - consider GROUP BY analysis'), (6, CASE WHEN gaps > 0 THEN 'Missing values detected - consider data cleaning' END)) v(i, text) WHERE text IS NOT NULL ORDER BY i LIMIT 5"),
    "PRF13": with_("eval_rows", each([(a, b) for a in _METRICS for b in _METRICS], lambda p: f"SELECT '{p[0]}' AS x, '{p[1]}' AS y, round({_r(*p)}, 6) AS r FROM eval_rows")),
    "INT01": each(list(_KEYS.items()), lambda k: f"SELECT 'primary_key' AS \"check\", '{k[0]}' AS table_name, '{k[1]}' AS columns, count(*) AS violations FROM (SELECT {k[1]} FROM {k[0]} GROUP BY {k[1]} HAVING count(*) > 1)") + " UNION ALL "
             + each(_REFS, lambda r: f"SELECT 'foreign_key', '{r[0]}', '{r[1]}', count(*) FROM {r[0]} WHERE {r[1]} IS NOT NULL AND {r[1]} NOT IN (SELECT {r[3]} FROM {r[2]})"),
    "CHT01": "SELECT 'orders' AS frame, 'scatter' AS chart_type UNION ALL SELECT 'nation_sizes', CASE WHEN count(*) <= 10 THEN 'pie' ELSE 'bar' END FROM nation UNION ALL SELECT 'region', CASE WHEN count(*) <= 10 THEN 'pie' ELSE 'bar' END FROM region UNION ALL SELECT 'prices', 'histogram' UNION ALL SELECT 'languages', 'bar'",
    "CHT02": "SELECT p_brand AS label, p_retailprice AS value FROM part",
    "CHT02_counts": "SELECT o_orderpriority AS label, count(*) AS value FROM orders GROUP BY 1",
    "CHT02_numeric": "SELECT p_partkey AS row, 'p_size' AS series, CAST(p_size AS DOUBLE) AS value FROM part UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part",
    "CHT03": "SELECT o_orderkey AS x, 'o_custkey' AS series, CAST(o_custkey AS DOUBLE) AS y FROM orders UNION ALL SELECT o_orderkey, 'o_totalprice', o_totalprice FROM orders",
    "CHT04": "SELECT label, value, round(value / sum(value) OVER (), 6) AS share FROM (SELECT o_orderpriority AS label, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1)",
    "CHT04_counts": "SELECT label, value, round(value / sum(value) OVER (), 6) AS share FROM (SELECT lang AS label, count(*) AS value FROM documents GROUP BY 1)",
    "CHT05": _bins("orders", "o_totalprice", 5, 4, right=True),
    "CHT06": "SELECT CAST(user_id AS DOUBLE) AS x, value AS y, event_type AS colour FROM events",
    "CHT07": _bins("lineitem", "l_extendedprice", 20, 4),
    "CHT08": "SELECT * FROM (VALUES ('orders', CAST(1 AS BIGINT), 'bar'), ('orders', 2, 'line'), ('orders', 3, 'histogram'), ('orders', 4, 'pie'), ('orders', 5, 'scatter'), ('prices', 1, 'bar'), ('prices', 2, 'line'), ('prices', 3, 'histogram'), ('languages', 1, 'bar'), ('languages', 2, 'pie')) v(frame, ordinal, chart_type)",
    "CHT09": with_("eval_rows", _bins("eval_rows", "bleu_score", 20, 6, keys="execution_correct")),
    "CHT09_length": with_("sql_pairs", "WITH l AS (SELECT upper(trim(pred_sql)) = upper(trim(truth_sql)) AS correct, length(pred_sql) AS len FROM sql_pairs), " + _bins("l", "len", 20, 6, keys="correct")[5:]),
    "CHT10": with_("eval_rows", "SELECT technique, round(response_time, 6) AS response_time, count(*) AS n, round(min(y), 6) AS first_step, round(max(y), 6) AS last_step FROM (SELECT technique, response_time, row_number() OVER (PARTITION BY technique ORDER BY response_time) / CAST(count(*) OVER (PARTITION BY technique) AS DOUBLE) AS y FROM eval_rows WHERE response_time <> CAST('Infinity' AS DOUBLE)) GROUP BY technique, response_time"),
    "CHT11": with_("eval_rows", "SELECT technique, " + each([50, 75, 90, 95, 99], lambda p: f"round(quantile_cont(response_time, {p / 100}), 6) AS p{p}", ", ") + " FROM eval_rows WHERE response_time <> CAST('Infinity' AS DOUBLE) GROUP BY 1"),
    "CHT12": with_("eval_rows", "WITH r AS (SELECT technique, response_time AS v FROM eval_rows WHERE response_time <> CAST('Infinity' AS DOUBLE)), b AS (SELECT technique, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM r GROUP BY 1) SELECT technique, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_low, round(max(v) FILTER (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high, count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers, count(*) AS n FROM r JOIN b USING (technique) GROUP BY technique, q1, median, q3"),
    "CHT13": with_("eval_rows", each(["execution_correct", "bleu_score"], _trend)),
    "CAT10": "SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns, CAST(8 AS BIGINT) AS numeric_columns, CAST(2 AS BIGINT) AS categorical_columns, 'l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate' AS column_names FROM lineitem",
    "CLN01": with_("dirty_docs", _DEDUPED),
    "CLN02": with_("dirty_docs", f"WITH src AS (SELECT * FROM dirty_docs) SELECT doc_id, lang, source, {_med('n_chars')}, created_timestamp, {_med('quality')}, {_med('toxic')} FROM src"),
    "CLN03": with_("dirty_docs", f"WITH src AS (SELECT * FROM dirty_docs) SELECT doc_id, {_mod('lang')}, {_mod('source')}, n_chars, {_mod('created_timestamp')}, quality, toxic FROM src"),
    "CLN04": with_("dirty_docs", "SELECT * REPLACE (TRY_CAST(created_timestamp AS TIMESTAMP) AS created_timestamp) FROM dirty_docs"),
    "CLN05": with_("dirty_docs", "SELECT * REPLACE (lower(trim(lang)) AS lang, lower(trim(source)) AS source) FROM dirty_docs"),
    "CLN06": with_("dirty_docs", f"WITH src AS ({_DEDUPED}) {_STATS}"),
    "CLN07": with_("dirty_docs", f"WITH src AS ({_DEDUPED}), s AS ({_STATS} UNION ALL {_PLAIN}) SELECT * FROM s UNION ALL SELECT 'TOTAL', CAST(sum(original_rows) AS BIGINT), CAST(sum(final_rows) AS BIGINT), CAST(sum(duplicates_removed) AS BIGINT), CAST(sum(original_nulls) AS BIGINT), CAST(sum(final_nulls) AS BIGINT), CAST(sum(columns) AS BIGINT) FROM s"),
    "CLN_all_steps": with_("dirty_docs", f"WITH src AS ({_DEDUPED}) {_CLEAN}"),
    "CLN_dates_first": with_("dirty_docs", f"WITH src AS ({_DEDUPED}) SELECT doc_id, lower(trim(lang)) AS lang, lower(trim(source)) AS source, n_chars, created_timestamp, quality, toxic FROM (SELECT doc_id, {_mod('lang')}, {_mod('source')}, {_med('n_chars')}, TRY_CAST(created_timestamp AS TIMESTAMP) AS created_timestamp, {_med('quality')}, {_med('toxic')} FROM src)"),
}

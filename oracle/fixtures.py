"""The derived inputs as common table expressions."""

ITEM = """
SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id, l_suppkey AS seller_id,
       l_quantity AS quantity, l_extendedprice AS price, l_extendedprice * l_tax AS freight_value,
       CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS review_score,
       l_shipdate AS order_delivered_timestamp, o_custkey AS customer_id, o_totalprice AS total_payment_value,
       o_orderpriority AS payment_type, o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp,
       CAST(datediff('day', o_orderdate, l_shipdate) AS INTEGER) AS delivery_days,
       CAST(datediff('day', o_orderdate, l_shipdate) - 30 AS INTEGER) AS delivery_delay_days,
       p_type AS product_category_name, p_brand AS product_brand, p_name AS product_name,
       p_size AS product_weight_g, p_retailprice AS product_retail_price,
       n_name AS customer_city, r_name AS customer_state
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""

ORDER = """
SELECT o_orderkey AS order_id, any_value(o_custkey) AS customer_id, any_value(o_orderstatus) AS order_status,
       any_value(o_orderdate) AS order_purchase_timestamp, any_value(o_totalprice) AS total_payment_value,
       count(*) AS n_items, count(DISTINCT l_partkey) AS n_products, count(DISTINCT l_suppkey) AS n_sellers,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS total_freight,
       CAST(sum(datediff('day', o_orderdate, l_shipdate)) AS DOUBLE) / count(*) AS avg_delivery_days,
       CAST(sum(datediff('day', o_orderdate, l_shipdate)) AS DOUBLE) / count(*) - 30 AS avg_delivery_delay_days,
       avg(CASE WHEN l_returnflag <> 'N' THEN l_quantity END) AS avg_review_score
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey
"""

EVAL = """
SELECT event_id AS question_id, event_type AS technique,
       CASE WHEN event_id % 97 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE value / 100.0 END AS response_time,
       event_id % 3 <> 0 AS execution_correct, event_id % 5 = 0 AS exact_match,
       user_id % 7 <> 0 AS schema_compliant, CAST(event_id % 101 AS DOUBLE) / 100.0 AS bleu_score,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) / 100.0 AS confidence_score,
       CASE WHEN event_id % 11 = 0 THEN 'failed' END AS error_message, ts
FROM events
"""

PAIRS = """
SELECT question_id, truth_sql,
       CASE question_id % 6
         WHEN 0 THEN truth_sql
         WHEN 1 THEN lower(truth_sql)
         WHEN 2 THEN concat('  ', replace(truth_sql, ' ', '   '), ' ;')
         WHEN 3 THEN 'SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus'
         WHEN 4 THEN replace(truth_sql, 'FROM orders', 'FROM missing_table')
         ELSE concat('SELECT o.o_orderstatus, COUNT(*) AS n FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey WHERE c.c_custkey = ', CAST(o_custkey AS VARCHAR), ' GROUP BY o.o_orderstatus')
       END AS pred_sql
FROM (SELECT o_orderkey AS question_id, o_custkey,
             concat('SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_custkey = ', CAST(o_custkey AS VARCHAR), ' GROUP BY o_orderstatus') AS truth_sql
      FROM orders) s
"""

RESPONSES = f"""
SELECT question_id,
       CASE question_id % 5 WHEN 0 THEN 'zero_shot' WHEN 1 THEN 'chain_of_thought' WHEN 2 THEN 'few_shot'
            WHEN 3 THEN 'self_consistency' ELSE 'least_to_most' END AS strategy,
       CASE (question_id // 5) % 7
         WHEN 0 THEN '{{' || sp || ', ' || cp || '}}'
         WHEN 1 THEN 'Here is the answer:' || chr(10) || '{{' || sp || ', ' || cp || '}}' || chr(10) || 'Hope this helps.'
         WHEN 2 THEN '{{' || sp || '}}'
         WHEN 3 THEN '{{' || cp || '}} from ' || truth_sql || ';'
         WHEN 4 THEN '{{' || sp || ', oops}}'
         WHEN 5 THEN 'First think.' || chr(10) || 'Then ' || truth_sql || ';' || chr(10) || 'Done.'
         ELSE '{{"used_tables": ["orders"], "used_columns": [], "reason_short": "r", ' || sp || ', ' || cp || ', "note": {{"depth": 2}}}}'
       END AS response
FROM (SELECT question_id, truth_sql,
             '"' || CASE WHEN question_id % 5 >= 3 THEN 'final_sql' ELSE 'sql' END || '": "' || truth_sql || '"' AS sp,
             '"' || CASE WHEN question_id % 5 = 3 THEN 'final_confidence' ELSE 'confidence' END || '": 0.'
                 || lpad(CAST(question_id % 100 AS VARCHAR), 2, '0') AS cp
      FROM ({PAIRS}) p) q
"""

QA = """
SELECT conv_id * 1000 + turn AS pair_id, text AS question, answer
FROM (SELECT conv_id, turn, role, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer
      FROM conversations) s
WHERE role = 'user'
"""

RAW_PAIRS = f"""
SELECT k AS pair_id,
       CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN ' ab '
            WHEN k % 13 = 0 THEN '  Show me ' || text || '  '
            WHEN k % 3 = 0 THEN 'How many orders has customer ' || cust || '?'
            WHEN k % 3 = 1 THEN 'Find the status of customer ' || cust
            ELSE 'list ALL orders of customer ' || cust END AS question,
       CASE WHEN k % 23 = 0 THEN '' WHEN k % 29 = 0 THEN 'EXPLAIN everything' WHEN k % 31 = 0 THEN 'SELECT 1'
            WHEN k % 37 = 0 THEN 'SELECT COUNT(* FROM orders' ELSE pred_sql END AS sql,
       CASE k % 7 WHEN 0 THEN 'orders(o_orderkey, o_custkey), customer(c_custkey)'
            WHEN 1 THEN '{{"relevant_tables": ["orders"], "relevant_columns": ["orders.o_custkey"]}}'
            WHEN 2 THEN '{{"relevant_tables": [], "relevant_columns": ["o_custkey"]}}'
            WHEN 3 THEN '{{"relevant_tables": "orders"}}'
            WHEN 4 THEN '{{"relevant_tables": ["orders", "customer"], "relevant_columns": "x"}}'
            WHEN 5 THEN '42' END AS schema_context,
       CASE WHEN k % 2 = 0 THEN 'customer_analysis' ELSE 'payment_analysis' END AS category
FROM (SELECT question_id AS k, pred_sql, regexp_extract(truth_sql, 'o_custkey = ([0-9]+)', 1) AS cust
      FROM ({PAIRS}) p) q
LEFT JOIN documents ON doc_id = k % (SELECT max(doc_id) + 1 FROM documents) AND k % 13 = 0
"""

_DIRTY = """
SELECT d.doc_id, CASE WHEN d.doc_id % 4 = 0 THEN concat('  ', upper(d.lang), ' ') ELSE d.lang END AS lang,
       CASE WHEN d.doc_id % 6 = 0 THEN NULL ELSE d.source END AS source,
       CASE WHEN d.doc_id % 5 = 0 THEN NULL ELSE d.n_chars END AS n_chars,
       CASE WHEN d.doc_id % 7 = 0 THEN 'not a date' WHEN d.doc_id % 7 = 1 THEN NULL ELSE '2024-01-15 10:00:00' END AS created_timestamp,
       l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
DIRTY = f"{_DIRTY} UNION ALL {_DIRTY} WHERE d.doc_id % 10 = 0"

COLUMNS = """
SELECT 't' || CAST(p_partkey // 40 AS VARCHAR) || '_' || lower(p_type) AS table_name,
       replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS VARCHAR) AS column_name, p_partkey AS position,
       CASE p_size % 5 WHEN 0 THEN 'INTEGER' WHEN 1 THEN 'VARCHAR' WHEN 2 THEN 'DECIMAL' WHEN 3 THEN 'TIMESTAMP' ELSE 'TEXT' END AS data_type,
       p_size % 2 = 0 AS nullable, p_size = 1 AS is_primary_key
FROM part
"""

EDGES = f"""
SELECT a.table_name, a.column_name, b.table_name AS ref_table, b.column_name AS ref_column
FROM (SELECT DISTINCT l_partkey, head FROM lineitem
      JOIN (SELECT l_orderkey AS ok, min(l_partkey) AS head FROM lineitem GROUP BY l_orderkey) f ON ok = l_orderkey
      WHERE l_partkey <> head) e
JOIN ({COLUMNS}) a ON a.position = e.l_partkey JOIN ({COLUMNS}) b ON b.position = e.head
"""

TERMS = "SELECT replace(p_name, ' ', '_') AS query FROM part UNION SELECT p_type FROM part"

QUESTIONS = """
SELECT o_orderkey * 2 AS qid,
       replace(CASE o_orderkey % 8
         WHEN 0 THEN 'Show the total revenue for customer {}'
         WHEN 1 THEN 'Compare the average order value between months for customer {}'
         WHEN 2 THEN 'Why is the delivery time for customer {} so long?'
         WHEN 3 THEN 'Which product category has the highest sales in region {}?'
         WHEN 4 THEN 'Classify items when payments are more than {} across products'
         WHEN 5 THEN 'Explain the payment method trend of buyer {}'
         WHEN 6 THEN 'Total freight {}'
         ELSE 'How many products did user {} join and combine over time?' END, '{}', CAST(o_custkey AS VARCHAR)) AS question
FROM orders
UNION ALL
SELECT (conv_id * 1000 + turn) * 2 + 1, text FROM conversations WHERE role = 'user'
"""


def with_(names: str, body: str) -> str:
    """Prefix a statement with the named fixtures."""
    known = {"item_level": ITEM, "order_level": ORDER, "eval_rows": EVAL, "sql_pairs": PAIRS,
             "responses": RESPONSES, "qa_pairs": QA, "raw_pairs": RAW_PAIRS, "dirty_docs": DIRTY,
             "columns_catalog": COLUMNS, "edges_catalog": EDGES, "questions": QUESTIONS, "search_terms": TERMS}
    ctes = ", ".join(f"{n} AS ({known[n]})" for n in names.split())
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"

"""Golden business questions in SQL."""

from oracle.fixtures import with_

D = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"
_FREIGHT = "CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_tax AS DECIMAL(4,2))"
_PLACES = ("customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
_SPEND = f"SELECT o_custkey, count(*) AS order_count, {D.format('o_totalprice')} AS total_spent FROM orders GROUP BY o_custkey"

SQL = {
    "G01": with_("item_level", "SELECT product_category_name, round(avg(freight_value), 4) AS avg_freight FROM item_level GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "G02": with_("item_level", "SELECT CASE WHEN delivery_delay_days > 0 THEN 'Late' ELSE 'On Time' END AS delivery_status, round(avg(review_score), 6) AS avg_score FROM item_level WHERE review_score IS NOT NULL GROUP BY 1"),
    "G03": with_("item_level", "SELECT payment_type, count(*) AS payment_count FROM item_level GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"),
    "G04": with_("item_level", "SELECT product_category_name, round(avg(delivery_days), 6) AS avg_delivery_days FROM item_level WHERE delivery_days IS NOT NULL GROUP BY 1 ORDER BY 2, 1"),
    "G05": with_("item_level", "SELECT order_id, total_payment_value FROM item_level ORDER BY 2 DESC, 1 LIMIT 10"),
    "G06": with_("item_level", "SELECT product_id, product_weight_g, product_retail_price, product_brand, product_name FROM item_level WHERE product_weight_g IS NOT NULL ORDER BY product_weight_g DESC, product_id LIMIT 5"),
    "G07": with_("order_level", "SELECT count(*) AS delivered_orders FROM order_level WHERE order_status = 'F'"),
    "G08": with_("order_level", "SELECT round(avg(n_products), 6) AS avg_products_per_order FROM order_level"),
    "G09": with_("order_level", "SELECT order_id, n_sellers FROM order_level WHERE n_sellers > 1 ORDER BY 2 DESC, 1"),
    "G10": with_("order_level", "SELECT CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP) AS month, count(*) AS order_count FROM order_level WHERE EXTRACT(year FROM order_purchase_timestamp) = 1997 GROUP BY 1 ORDER BY 1"),
    "G11": with_("order_level", "SELECT CASE WHEN avg_delivery_delay_days > 0 THEN 'Delayed' ELSE 'On Time' END AS delivery_status, round(avg(avg_review_score), 6) AS avg_score, count(*) AS order_count FROM order_level WHERE avg_review_score IS NOT NULL GROUP BY 1"),
    "G12": "SELECT n_name AS customer_city, count(*) AS customer_count FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    "G13": "SELECT o_orderpriority AS payment_type, round(avg(o_totalprice), 4) AS avg_value FROM orders GROUP BY 1 ORDER BY 2 DESC, 1",
    "G14": f"SELECT p_type AS product_category_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2)) + {_FREIGHT}) AS DOUBLE) AS total_revenue FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    "G15": f"SELECT c_custkey AS customer_id, n_name AS customer_city, count(o_orderkey) AS order_count FROM {_PLACES} JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2 HAVING count(o_orderkey) > 3",
    "G16": with_("item_level", "SELECT customer_state, round(avg(datediff('day', order_purchase_timestamp, order_delivered_timestamp)), 6) AS avg_delivery_days FROM item_level WHERE order_delivered_timestamp IS NOT NULL GROUP BY 1 ORDER BY 2, 1"),
    "G17": "SELECT o_orderpriority AS payment_type, count(*) AS usage_count, round(avg(o_totalprice), 4) AS avg_payment_value FROM orders WHERE o_totalprice > 200000 GROUP BY 1 ORDER BY 2 DESC, 1",
    "G18": "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS order_count FROM orders WHERE year(o_orderdate) IN (1997, 1998) GROUP BY 1, 2 ORDER BY 1, 2",
    "G19": "SELECT p_partkey AS product_id, p_type AS product_category_name FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND year(l_shipdate) = 1998) s ON p_partkey = l_partkey WHERE l_partkey IS NULL",
    "G20": f"SELECT r_name AS customer_state, {D.format('o_totalprice')} AS total_revenue FROM {_PLACES} JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'F' GROUP BY 1 ORDER BY 2 DESC, 1",
    "G21": "SELECT l_linenumber AS payment_installments, count(*) AS n, round(avg(l_extendedprice), 4) AS avg_value FROM lineitem GROUP BY 1 ORDER BY 1",
    "G22": f"SELECT p_type AS product_category_name, CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * ({_FREIGHT}) AS DECIMAL(28,6))) AS DOUBLE) AS total_revenue FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1 ORDER BY 2 DESC, 1",
    "G23": f"SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS order_count, {D.format('l_extendedprice')} AS total_value FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE year(o_orderdate) = 1997 GROUP BY 1 ORDER BY 1",
    "G24": f"SELECT {D.format('o_totalprice')} AS total_sales FROM orders WHERE o_orderdate >= TIMESTAMP '1998-08-01' AND o_orderdate < TIMESTAMP '1998-09-01'",
    "G25": f"SELECT {D.format('o_totalprice')} AS total_sales FROM orders WHERE date_trunc('month', o_orderdate) = TIMESTAMP '1998-08-01'",
    "G26": "WITH product_revenue AS (SELECT p_partkey AS product_id, p_name AS name, CAST(sum(CAST(l_quantity * p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate >= date_trunc('quarter', TIMESTAMP '1998-08-15') GROUP BY 1, 2) SELECT * FROM product_revenue ORDER BY revenue DESC, product_id LIMIT 5",
    "G27": f"SELECT n_name AS customer_city, {D.format('l_extendedprice')} AS total_value FROM {_PLACES} JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey WHERE year(o_orderdate) = 1998 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
    "G28": "SELECT o_orderkey AS order_id, c_name AS name, o_totalprice AS total_amount FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 400000 ORDER BY 1 LIMIT 100",
    "G29": f"SELECT o_custkey AS customer_id, order_count, total_spent FROM ({_SPEND}) WHERE order_count > 5 AND total_spent > 500000",
    "G30": f"SELECT region, customer_id, total_spent, rank FROM (SELECT r_name AS region, c_custkey AS customer_id, total_spent, row_number() OVER (PARTITION BY r_name ORDER BY total_spent DESC, c_custkey) AS rank FROM {_PLACES} JOIN ({_SPEND}) ON c_custkey = o_custkey) WHERE rank <= 3",
    "G31": f"SELECT customer_id, customer_city, total_spent, round(city_avg, 4) AS city_avg FROM (SELECT c_custkey AS customer_id, n_name AS customer_city, total_spent, avg(total_spent) OVER (PARTITION BY n_name) AS city_avg FROM {_PLACES} JOIN ({_SPEND}) ON c_custkey = o_custkey) WHERE total_spent > city_avg",
    "G32": f"WITH m AS (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, {D.format('o_totalprice')} AS total FROM orders GROUP BY 1, 2) SELECT a.year, a.month, a.total, b.total AS previous_total, round((a.total - b.total) / b.total, 6) AS growth FROM m a LEFT JOIN m b ON a.year = b.year + 1 AND a.month = b.month",
    "G33": f"SELECT c_custkey AS customer_id, CASE WHEN total_spent >= 2500000 THEN 'VIP' WHEN order_count >= 5 THEN 'Regular' ELSE 'New' END AS segment, coalesce(order_count, 0) AS order_count FROM customer LEFT JOIN ({_SPEND}) ON c_custkey = o_custkey",
    "G34": f"SELECT p_brand AS product_brand, {D.format('l_extendedprice')} AS total_revenue, round(avg(l_extendedprice), 4) AS avg_value, count(*) AS order_count FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1 HAVING avg(l_extendedprice) > 50 AND count(*) >= 100 ORDER BY 2 DESC, 1 LIMIT 3",
    "G35": with_("item_level", "SELECT * REPLACE (round(freight_value, 4) AS freight_value) FROM item_level"),
    "G36": with_("order_level", "SELECT * REPLACE (round(avg_delivery_days, 6) AS avg_delivery_days, round(avg_delivery_delay_days, 6) AS avg_delivery_delay_days, round(avg_review_score, 6) AS avg_review_score) FROM order_level"),
    "G37": f"SELECT r_name AS region, {D.format('o_totalprice')} AS total_sales FROM {_PLACES} JOIN orders ON c_custkey = o_custkey GROUP BY 1",
    "G37_top_customer": f"SELECT c_name AS name, total_spent FROM customer JOIN ({_SPEND}) ON c_custkey = o_custkey ORDER BY total_spent DESC, c_custkey LIMIT 1",
    "G37_latest_orders": "SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_totalprice AS total_amount FROM orders ORDER BY 2 DESC, 1 LIMIT 10",
    "G37_in_stock": "SELECT p_partkey AS product_id, p_name AS name, p_size AS stock_quantity FROM part WHERE p_size > 0",
}

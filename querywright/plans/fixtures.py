"""Inputs derived from the given tables. Each is a plain DataFrame plan over whole tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querywright.scale import SMALL_SPLIT_BYTES, spread
from querywright.sources.tables import Tables

# The promise made to customers (days) and the part of lines without a review.
PROMISED_DAYS = 30
UNREVIEWED_FLAG = "N"

_ITEM_COLUMNS = {
    # output column -> (tables it needs besides lineitem, expression)
    "order_id": ((), "l_orderkey"),
    "line_number": ((), "l_linenumber"),
    "product_id": ((), "l_partkey"),
    "seller_id": ((), "l_suppkey"),
    "quantity": ((), "l_quantity"),
    "price": ((), "l_extendedprice"),
    "freight_value": ((), "l_extendedprice * l_tax"),
    "review_score": ((), f"CASE WHEN l_returnflag <> '{UNREVIEWED_FLAG}' THEN l_quantity END"),
    "order_delivered_timestamp": ((), "l_shipdate"),
    "customer_id": (("orders",), "o_custkey"),
    "total_payment_value": (("orders",), "o_totalprice"),
    "payment_type": (("orders",), "o_orderpriority"),
    "order_status": (("orders",), "o_orderstatus"),
    "order_purchase_timestamp": (("orders",), "o_orderdate"),
    "delivery_days": (("orders",), "datediff(l_shipdate, o_orderdate)"),
    "delivery_delay_days": (("orders",), f"datediff(l_shipdate, o_orderdate) - {PROMISED_DAYS}"),
    "product_category_name": (("part",), "p_type"),
    "product_brand": (("part",), "p_brand"),
    "product_name": (("part",), "p_name"),
    "product_weight_g": (("part",), "p_size"),
    "product_retail_price": (("part",), "p_retailprice"),
    "customer_city": (("orders", "place"), "city"),
    "customer_state": (("orders", "place"), "state"),
}


def places(t: Tables) -> DataFrame:
    """Customer with city (nation) and state (region)."""
    return (t.customer
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", "c_name", "c_mktsegment", "c_acctbal",
                    F.col("n_name").alias("city"), F.col("r_name").alias("state")))


def item_level(t: Tables, *columns: str) -> DataFrame:
    """One row per order line. Only the dimensions behind the requested columns are joined:
    the declared foreign keys make the other inner joins neutral (INT01 checks them)."""
    columns = columns or tuple(_ITEM_COLUMNS)
    needed = {dim for c in columns for dim in _ITEM_COLUMNS[c][0]}
    df = t.lineitem
    if "orders" in needed:
        df = df.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "part" in needed:
        df = df.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    if "place" in needed:
        df = df.join(places(t), F.col("o_custkey") == F.col("c_custkey"))
    return df.select(*[F.expr(_ITEM_COLUMNS[c][1]).alias(c) for c in columns])


def order_level(t: Tables) -> DataFrame:
    """One row per order, rolled up from its lines. Lines are aggregated before the join, so the
    join sees one row per order on both sides."""
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_items"),
        # an order has few lines: sets need no second copy of the rows, as two distinct counts would
        F.size(F.collect_set("l_partkey")).cast("long").alias("n_products"),
        F.size(F.collect_set("l_suppkey")).cast("long").alias("n_sellers"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("total_price"),
        F.sum((F.col("l_extendedprice").cast("decimal(14,2)") * F.col("l_tax").cast("decimal(4,2)")))
        .cast("double").alias("total_freight"),
        F.avg(F.expr(_ITEM_COLUMNS["review_score"][1])).alias("avg_review_score"),
        F.sum(F.expr("datediff(l_shipdate, DATE '1970-01-01')").cast("long")).alias("_ship"))
    days = (F.col("_ship") / F.col("n_items")
            - F.expr("datediff(o_orderdate, DATE '1970-01-01')"))
    return (lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderstatus").alias("order_status"),
                    F.col("o_orderdate").alias("order_purchase_timestamp"),
                    F.col("o_totalprice").alias("total_payment_value"),
                    "n_items", "n_products", "n_sellers", "total_price", "total_freight",
                    days.alias("avg_delivery_days"),
                    (days - PROMISED_DAYS).alias("avg_delivery_delay_days"), "avg_review_score"))


def eval_rows(t: Tables) -> DataFrame:
    """Evaluation log: one row per (technique, question), from the event table."""
    e = F.col("event_id")
    return t.events.select(
        e.alias("question_id"), F.col("event_type").alias("technique"),
        F.when(e % 97 == 0, F.lit(float("inf"))).otherwise(F.col("value") / 100.0).alias("response_time"),
        (e % 3 != 0).alias("execution_correct"), (e % 5 == 0).alias("exact_match"),
        (F.col("user_id") % 7 != 0).alias("schema_compliant"),
        ((e % 101).cast("double") / 100.0).alias("bleu_score"),
        (F.get_json_object("props", "$.k").cast("double") / 100.0).alias("confidence_score"),
        F.when(e % 11 == 0, F.lit("failed")).alias("error_message"), "ts")


def with_run_outcome(events: DataFrame) -> DataFrame:
    """Whether the run behind an event went through and was correct, by the rules of ``eval_rows``."""
    e = F.col("event_id")
    return events.withColumns({"ok": e % 97 != 0, "correct": e % 3 != 0})


def sql_pairs(t: Tables) -> DataFrame:
    """Predicted and true statements, one pair per order."""
    return _statements(t.orders).select("question_id", "truth_sql", "pred_sql")


def _statements(orders: DataFrame) -> DataFrame:
    """The pair of every order beside its columns."""
    key = F.col("o_custkey").cast("string")
    truth = F.concat(F.lit("SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_custkey = "), key,
                     F.lit(" GROUP BY o_orderstatus"))
    kind = F.col("question_id") % 6
    pred = (F.when(kind == 0, F.col("truth_sql"))
            .when(kind == 1, F.lower("truth_sql"))
            .when(kind == 2, F.concat(F.lit("  "), F.replace("truth_sql", F.lit(" "), F.lit("   ")), F.lit(" ;")))
            .when(kind == 3, F.lit("SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus"))
            .when(kind == 4, F.replace("truth_sql", F.lit("FROM orders"), F.lit("FROM missing_table")))
            .otherwise(F.concat(
                F.lit("SELECT o.o_orderstatus, COUNT(*) AS n FROM customer c JOIN orders o "
                      "ON c.c_custkey = o.o_custkey WHERE c.c_custkey = "), F.col("_key"),
                F.lit(" GROUP BY o.o_orderstatus"))))
    return (orders.select("*", F.col("o_orderkey").alias("question_id"), key.alias("_key"), truth.alias("truth_sql"))
            .select("*", pred.alias("pred_sql")))


def responses(t: Tables) -> DataFrame:
    """Raw model answers to parse: clean JSON, JSON in prose, missing fields, broken JSON, plain
    text and nested objects, one per order, spread over the five strategies."""
    names = F.array(*[F.lit(s) for s in
                      ("zero_shot", "chain_of_thought", "few_shot", "self_consistency", "least_to_most")])
    pairs = sql_pairs(t)
    field = F.when(F.col("question_id") % 5 >= 3, F.lit("final_sql")).otherwise(F.lit("sql"))
    conf_field = F.when(F.col("question_id") % 5 == 3, F.lit("final_confidence")).otherwise(F.lit("confidence"))
    shape = F.floor(F.col("question_id") / 5) % 7
    sql_part = F.concat(F.lit('"'), field, F.lit('": "'), F.col("truth_sql"), F.lit('"'))
    conf_part = F.concat(F.lit('"'), conf_field, F.lit('": 0.'),
                         F.lpad((F.col("question_id") % 100).cast("string"), 2, "0"))
    text = (F.when(shape == 0, F.concat(F.lit("{"), sql_part, F.lit(", "), conf_part, F.lit("}")))
            .when(shape == 1, F.concat(F.lit("Here is the answer:\n{"), sql_part, F.lit(", "), conf_part,
                                       F.lit("}\nHope this helps.")))
            .when(shape == 2, F.concat(F.lit("{"), sql_part, F.lit("}")))
            .when(shape == 3, F.concat(F.lit("{"), conf_part, F.lit("} from "), F.col("truth_sql"), F.lit(";")))
            .when(shape == 4, F.concat(F.lit("{"), sql_part, F.lit(", oops}")))
            .when(shape == 5, F.concat(F.lit("First think.\nThen "), F.col("truth_sql"), F.lit(";\nDone.")))
            .otherwise(F.concat(F.lit('{"used_tables": ["orders"], "used_columns": [], "reason_short": "r", '),
                                sql_part, F.lit(", "), conf_part, F.lit(', "note": {"depth": 2}}'))))
    return pairs.select("question_id", F.get(names, (F.col("question_id") % 5).cast("int")).alias("strategy"),
                        text.alias("response"))


def qa_pairs(t: Tables) -> DataFrame:
    """Each user turn with the turn that follows it in the conversation."""
    following = t.conversations.select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    dense = t.conversations.filter(F.col("role") == "user")
    return (dense.join(following, ["conv_id", "turn"], "left")
            .select((F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"),
                    F.col("text").alias("question"), "answer"))


def raw_pairs(t: Tables) -> DataFrame:
    """Question/SQL records to validate, one per order, with the defects the checks look for.
    The question quotes a document; the schema context is text, a JSON object or malformed."""
    k, order = F.col("question_id"), F.col("o_orderkey")
    docs = t.documents.select("doc_id", F.col("text").alias("_doc"))
    n_docs = t.documents.agg((F.max("doc_id") + 1).alias("n")).scalar()
    question = (F.when(k % 17 == 0, F.lit(None).cast("string"))
                .when(k % 19 == 0, F.lit(" ab "))
                .when(k % 13 == 0, F.concat(F.lit("  Show me "), F.col("_doc"), F.lit("  ")))
                .when(k % 3 == 0, F.concat(F.lit("How many orders has customer "), F.col("_cust"), F.lit("?")))
                .when(k % 3 == 1, F.concat(F.lit("Find the status of customer "), F.col("_cust")))
                .otherwise(F.concat(F.lit("list ALL orders of customer "), F.col("_cust"))))
    sql = (F.when(k % 23 == 0, F.lit(""))
           .when(k % 29 == 0, F.lit("EXPLAIN everything"))
           .when(k % 31 == 0, F.lit("SELECT 1"))
           .when(k % 37 == 0, F.lit("SELECT COUNT(* FROM orders"))
           .otherwise(F.col("pred_sql")))
    context = (F.when(k % 7 == 0, F.lit("orders(o_orderkey, o_custkey), customer(c_custkey)"))
               .when(k % 7 == 1, F.lit('{"relevant_tables": ["orders"], "relevant_columns": ["orders.o_custkey"]}'))
               .when(k % 7 == 2, F.lit('{"relevant_tables": [], "relevant_columns": ["o_custkey"]}'))
               .when(k % 7 == 3, F.lit('{"relevant_tables": "orders"}'))
               .when(k % 7 == 4, F.lit('{"relevant_tables": ["orders", "customer"], "relevant_columns": "x"}'))
               .when(k % 7 == 5, F.lit("42")))
    category = F.when(k % 2 == 0, F.lit("customer_analysis")).otherwise(F.lit("payment_analysis"))
    # only the keys of orders that quote a document meet the texts; the merge lays rows with one text side by side
    orders, quotes = spread(t.orders.select("o_orderkey", "o_custkey"), SMALL_SPLIT_BYTES), F.coalesce(order % 13 == 0, F.lit(False))
    quoting = orders.filter(quotes).withColumn("_slot", order % n_docs)
    quoting = quoting.join(docs.hint("merge"), F.col("_slot") == F.col("doc_id"), "left").select("o_orderkey", "o_custkey", "_doc")
    others = orders.filter(~quotes).withColumn("_doc", F.lit(None).cast("string"))
    return (_statements(others.unionByName(quoting)).withColumn("_cust", F.regexp_extract("truth_sql", r"o_custkey = (\d+)", 1))
            .select(k.alias("pair_id"), question.alias("question"), sql.alias("sql"),
                    context.alias("schema_context"), category.alias("category")))


def dirty_docs(t: Tables) -> DataFrame:
    """Documents with nulls, untrimmed text, bad dates and exact copies."""
    d = F.col("doc_id")
    rows = t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left").select(
        "doc_id",
        F.when(d % 4 == 0, F.concat(F.lit("  "), F.upper("lang"), F.lit(" "))).otherwise(F.col("lang")).alias("lang"),
        F.when(d % 6 != 0, F.col("source")).alias("source"),
        F.when(d % 5 != 0, F.col("n_chars")).alias("n_chars"),
        F.when(d % 7 == 0, F.lit("not a date")).when(d % 7 != 1, F.lit("2024-01-15 10:00:00"))
        .alias("created_timestamp"),
        "quality", "toxic",
        F.when(d % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("_copies"))
    return rows.withColumn("_copy", F.explode("_copies")).drop("_copies", "_copy")


def columns_catalog(t: Tables) -> DataFrame:
    """A catalog to search: every part is a column, and a table holds the parts of one type among
    forty neighbours. It grows with ``part`` while a table never exceeds forty columns."""
    kinds = F.array(*[F.lit(x) for x in ("INTEGER", "VARCHAR", "DECIMAL", "TIMESTAMP", "TEXT")])
    table = F.concat(F.lit("t"), F.floor(F.col("p_partkey") / 40).cast("string"), F.lit("_"), F.lower("p_type"))
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.col("p_partkey").cast("string"))
    return t.part.select(
        table.alias("table_name"), name.alias("column_name"), F.col("p_partkey").alias("position"),
        F.get(kinds, (F.col("p_size") % 5).cast("int")).alias("data_type"),
        (F.col("p_size") % 2 == 0).alias("nullable"), (F.col("p_size") == 1).alias("is_primary_key"))


def edges_catalog(t: Tables) -> DataFrame:
    """Foreign-key edges between the catalog's tables: parts bought in the same order as the
    order's first part refer to it."""
    cat = columns_catalog(t)
    first = t.lineitem.groupBy("l_orderkey").agg(F.min("l_partkey").alias("head"))
    pairs = (t.lineitem.join(first, "l_orderkey").filter(F.col("l_partkey") != F.col("head"))
             .select("l_partkey", "head").distinct())
    left = cat.select(F.col("position").alias("l_partkey"), F.col("table_name"), F.col("column_name"))
    right = cat.select(F.col("position").alias("head"), F.col("table_name").alias("ref_table"),
                       F.col("column_name").alias("ref_column"))
    return pairs.join(left, "l_partkey").join(right, "head").select(
        "table_name", "column_name", "ref_table", "ref_column")


def user_questions(t: Tables) -> DataFrame:
    """Questions to route and render: all user turns plus one business question per order, whose
    wording is chosen by the order (so that every routing rule has rows)."""
    stems = (
        "Show the total revenue for customer {}",
        "Compare the average order value between months for customer {}",
        "Why is the delivery time for customer {} so long?",
        "Which product category has the highest sales in region {}?",
        "Classify items when payments are more than {} across products",
        "Explain the payment method trend of buyer {}",
        "Total freight {}",
        "How many products did user {} join and combine over time?",
    )
    stem = F.get(F.array(*[F.lit(s) for s in stems]), (F.col("o_orderkey") % len(stems)).cast("int"))
    business = t.orders.select((F.col("o_orderkey") * 2).alias("qid"),
                               F.replace(stem, F.lit("{}"), F.col("o_custkey").cast("string")).alias("question"))
    turns = t.conversations.filter(F.col("role") == "user").select(
        ((F.col("conv_id") * 1000 + F.col("turn")) * 2 + 1).alias("qid"), F.col("text").alias("question"))
    return business.unionByName(turns)


def search_terms(t: Tables) -> DataFrame:
    """Search strings for the catalog: the product names and types in use."""
    names = t.part.select(F.replace("p_name", F.lit(" "), F.lit("_")).alias("query"))
    return names.unionByName(t.part.select(F.col("p_type").alias("query"))).distinct()

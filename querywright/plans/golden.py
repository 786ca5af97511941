"""The golden business questions, each as one declarative plan over the star schema."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from querywright.plans.fixtures import item_level, order_level, places
from querywright.scale import checked_broadcast, sum_by_dimension, top_k

ANCHOR_DATE = "1998-08-15"


def exact_sum(col) -> Column:
    """Money total in decimal arithmetic: independent of the order rows arrive in."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def freight() -> Column:
    return F.col("l_extendedprice").cast("decimal(14,2)") * F.col("l_tax").cast("decimal(4,2)")


def ntz(col: Column) -> Column:
    return col.cast("timestamp_ntz")


def ship_days() -> Column:
    return F.datediff("l_shipdate", "o_orderdate")


def lines_with_orders(t):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


def spend_per_customer(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("order_count"), exact_sum("o_totalprice").alias("total_spent"))


MONEY = "decimal(18,2)"


def between(col, lo, hi):
    """Half-open timestamp range in the form the parquet scan can push down."""
    return (F.col(col) >= F.lit(lo).cast("timestamp_ntz")) & (F.col(col) < F.lit(hi).cast("timestamp_ntz"))


def by_product(t, lines, group, **sums):
    return sum_by_dimension(lines, "l_partkey", t.part, "p_partkey", group, sums)


def by_customer(t, rows, group, **sums):
    return sum_by_dimension(rows, "o_custkey", places(t), "c_custkey", group, sums, sized_by=t.customer)


def g01(t):
    sums = by_product(t, t.lineitem, [F.col("p_type").alias("product_category_name")], total=freight(), n=F.lit(1))
    return (sums.select("product_category_name", F.round(F.col("total").cast("double") / F.col("n"), 4).alias("avg_freight"))
            .orderBy(F.desc("avg_freight"), "product_category_name").limit(10))


def g02(t):
    status = F.when(F.col("delivery_delay_days") > 0, "Late").otherwise("On Time")
    return (item_level(t, "delivery_delay_days", "review_score").filter(F.col("review_score").isNotNull())
            .groupBy(status.alias("delivery_status")).agg(F.round(F.avg("review_score"), 6).alias("avg_score")))


def g03(t):
    return (item_level(t, "payment_type").groupBy("payment_type").agg(F.count(F.lit(1)).alias("payment_count"))
            .orderBy(F.desc("payment_count"), "payment_type").limit(1))


def g04(t):
    sums = by_product(t, lines_with_orders(t).filter(ship_days().isNotNull()),
                      [F.col("p_type").alias("product_category_name")], total=ship_days().cast("long"), n=F.lit(1))
    return (sums.select("product_category_name", F.round(F.col("total") / F.col("n"), 6).alias("avg_delivery_days"))
            .orderBy("avg_delivery_days", "product_category_name"))


def g05(t):
    return (item_level(t, "order_id", "total_payment_value")
            .orderBy(F.desc("total_payment_value"), "order_id").limit(10))


def g06(t):
    return (item_level(t, "product_id", "product_weight_g", "product_retail_price", "product_brand", "product_name")
            .filter(F.col("product_weight_g").isNotNull()).orderBy(F.desc("product_weight_g"), "product_id").limit(5))


def g07(t):
    orders = t.orders.filter(F.col("o_orderstatus") == "F").join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    return orders.agg(F.countDistinct("o_orderkey").alias("delivered_orders"))


def g08(t):
    return (t.lineitem.groupBy("l_orderkey").agg(F.countDistinct("l_partkey").alias("n_products"))
            .agg(F.round(F.avg("n_products"), 6).alias("avg_products_per_order")))


def g09(t):
    return (t.lineitem.groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(F.countDistinct("l_suppkey").alias("n_sellers"))
            .filter(F.col("n_sellers") > 1).orderBy(F.desc("n_sellers"), "order_id"))


def g10(t):
    has_lines = t.orders.filter(between("o_orderdate", "1997-01-01", "1998-01-01")).join(
        t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return (has_lines.groupBy(ntz(F.date_trunc("month", "o_orderdate")).alias("month"))
            .agg(F.count(F.lit(1)).alias("order_count")).orderBy("month"))


def g11(t):
    status = F.when(F.col("avg_delivery_delay_days") > 0, "Delayed").otherwise("On Time")
    return (order_level(t).filter(F.col("avg_review_score").isNotNull())
            .groupBy(status.alias("delivery_status"))
            .agg(F.round(F.avg("avg_review_score"), 6).alias("avg_score"), F.count(F.lit(1)).alias("order_count")))


def g12(t):
    counts = sum_by_dimension(t.customer, "c_nationkey", t.nation, "n_nationkey",
                              [F.col("n_name").alias("customer_city")], {"customer_count": F.lit(1)})
    return counts.orderBy(F.desc("customer_count"), "customer_city").limit(1)


def g13(t):
    return (t.orders.groupBy(F.col("o_orderpriority").alias("payment_type"))
            .agg(F.round(F.avg("o_totalprice"), 4).alias("avg_value")).orderBy(F.desc("avg_value"), "payment_type"))


def g14(t):
    revenue = F.col("l_extendedprice").cast("decimal(14,2)") + freight()
    sums = by_product(t, t.lineitem, [F.col("p_type").alias("product_category_name")], total_revenue=revenue)
    return (sums.withColumn("total_revenue", F.col("total_revenue").cast("double"))
            .orderBy(F.desc("total_revenue"), "product_category_name").limit(5))


def g15(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("order_count")).filter("order_count > 3")
    return (counts.join(places(t), F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("c_custkey").alias("customer_id"), F.col("city").alias("customer_city"), "order_count"))


def g16(t):
    sums = by_customer(t, lines_with_orders(t).filter(ship_days().isNotNull()),
                       [F.col("state").alias("customer_state")], total=ship_days().cast("long"), n=F.lit(1))
    return (sums.select("customer_state", F.round(F.col("total") / F.col("n"), 6).alias("avg_delivery_days"))
            .orderBy("avg_delivery_days", "customer_state"))


def g17(t):
    return (t.orders.filter(F.col("o_totalprice") > 200000).groupBy(F.col("o_orderpriority").alias("payment_type"))
            .agg(F.count(F.lit(1)).alias("usage_count"), F.round(F.avg("o_totalprice"), 4).alias("avg_payment_value"))
            .orderBy(F.desc("usage_count"), "payment_type"))


def g18(t):
    y, m = F.year("o_orderdate").cast("long"), F.month("o_orderdate").cast("long")
    return (t.orders.filter(between("o_orderdate", "1997-01-01", "1999-01-01")).groupBy(y.alias("year"), m.alias("month"))
            .agg(F.count(F.lit(1)).alias("order_count")).orderBy("year", "month"))


def g19(t):
    sold = t.lineitem.filter((F.col("l_returnflag") == "R") & between("l_shipdate", "1998-01-01", "1999-01-01"))
    return (t.part.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left_anti")
            .select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name")))


def g20(t):
    sums = by_customer(t, t.orders.filter(F.col("o_orderstatus") == "F"), [F.col("state").alias("customer_state")],
                       total_revenue=F.col("o_totalprice").cast(MONEY))
    return (sums.withColumn("total_revenue", F.col("total_revenue").cast("double"))
            .orderBy(F.desc("total_revenue"), "customer_state"))


def g21(t):
    return (t.lineitem.groupBy(F.col("l_linenumber").alias("payment_installments"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("l_extendedprice"), 4).alias("avg_value"))
            .orderBy("payment_installments"))


def g22(t):
    product = (F.col("l_extendedprice").cast("decimal(12,2)") * freight()).cast("decimal(28,6)")
    sums = by_product(t, t.lineitem, [F.col("p_type").alias("product_category_name")], total_revenue=product)
    return (sums.withColumn("total_revenue", F.col("total_revenue").cast("double"))
            .orderBy(F.desc("total_revenue"), "product_category_name"))


def g23(t):
    return (lines_with_orders(t).filter(between("o_orderdate", "1997-01-01", "1998-01-01"))
            .groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
            .agg(F.count(F.lit(1)).alias("order_count"), exact_sum("l_extendedprice").alias("total_value"))
            .orderBy("month"))


def g24(t):
    return t.orders.filter(between("o_orderdate", "1998-08-01", "1998-09-01")).agg(
        exact_sum("o_totalprice").alias("total_sales"))


def g25(t):
    month = ntz(F.date_trunc("month", "o_orderdate"))
    return t.orders.filter(between("o_orderdate", "1998-08-01", "1998-09-01")  # implied range, pushed to the scan
                           & (month == F.lit("1998-08-01").cast("timestamp_ntz"))).agg(
        exact_sum("o_totalprice").alias("total_sales"))


def g26(t, anchor=ANCHOR_DATE):
    start = ntz(F.date_trunc("quarter", F.lit(anchor).cast("timestamp_ntz")))
    quantities = (lines_with_orders(t).filter(F.col("o_orderdate") >= start).groupBy("l_partkey")
                  .agg(F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("quantity")))
    price = F.col("p_retailprice").cast("decimal(12,2)")
    product_revenue = quantities.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
        (F.col("quantity") * price).cast("double").alias("revenue"))
    return product_revenue.orderBy(F.desc("revenue"), "product_id").limit(5)


def g27(t):
    rows = lines_with_orders(t).filter(between("o_orderdate", "1998-01-01", "1999-01-01"))
    sums = by_customer(t, rows, [F.col("city").alias("customer_city")],
                       total_value=F.col("l_extendedprice").cast(MONEY))
    return (sums.withColumn("total_value", F.col("total_value").cast("double"))
            .orderBy(F.desc("total_value"), "customer_city").limit(3))


def g28(t):
    return (t.orders.filter(F.col("o_totalprice") > 400000)
            .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").alias("order_id"), F.col("c_name").alias("name"),
                    F.col("o_totalprice").alias("total_amount")).orderBy("order_id").limit(100))


def g29(t):
    return spend_per_customer(t).filter((F.col("order_count") > 5) & (F.col("total_spent") > 500000)).select(
        F.col("o_custkey").alias("customer_id"), "order_count", "total_spent")


def g30(t):
    totals = spend_per_customer(t).join(places(t), F.col("o_custkey") == F.col("c_custkey"))
    ranked = top_k(totals, ["state"], [F.desc("total_spent"), F.asc("c_custkey")], 3)
    return ranked.select(F.col("state").alias("region"), F.col("c_custkey").alias("customer_id"), "total_spent",
                         F.col("rank").cast("long").alias("rank"))


def g31(t):
    """Above the average of the own city: averages are aggregated and joined back, so a city with
    a third of all customers is never one window partition."""
    totals = spend_per_customer(t).join(places(t), F.col("o_custkey") == F.col("c_custkey"))
    averages = totals.groupBy("city").agg(F.avg("total_spent").alias("city_avg"))
    return (totals.join(checked_broadcast(averages), "city").filter(F.col("total_spent") > F.col("city_avg"))
            .select(F.col("c_custkey").alias("customer_id"), F.col("city").alias("customer_city"), "total_spent",
                    F.round("city_avg", 4).alias("city_avg")))


def g32(t):
    monthly = t.orders.groupBy(F.year("o_orderdate").cast("long").alias("year"),
                               F.month("o_orderdate").cast("long").alias("month")).agg(
        exact_sum("o_totalprice").alias("total"))
    before = monthly.select((F.col("year") + 1).alias("year"), "month", F.col("total").alias("previous_total"))
    growth = F.try_divide(F.col("total") - F.col("previous_total"), F.col("previous_total"))
    return monthly.join(before, ["year", "month"], "left").select(
        "year", "month", "total", "previous_total", F.round(growth, 6).alias("growth"))


def g33(t):
    label = (F.when(F.col("total_spent") >= 2500000, "VIP").when(F.col("order_count") >= 5, "Regular")
             .otherwise("New"))
    return (t.customer.join(spend_per_customer(t), F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(F.col("c_custkey").alias("customer_id"), label.alias("segment"),
                    F.coalesce("order_count", F.lit(0)).alias("order_count")))


def g34(t):
    sums = by_product(t, t.lineitem, [F.col("p_brand").alias("product_brand")],
                      total_revenue=F.col("l_extendedprice").cast(MONEY), order_count=F.lit(1))
    total = F.col("total_revenue").cast("double")
    return (sums.select("product_brand", total.alias("total_revenue"),
                        F.round(total / F.col("order_count"), 4).alias("avg_value"), "order_count")
            .filter((F.col("avg_value") > 50) & (F.col("order_count") >= 100))
            .orderBy(F.desc("total_revenue"), "product_brand").limit(3))


def g35(t):
    return item_level(t).withColumn("freight_value", F.round("freight_value", 4))


def g36(t):
    o = order_level(t)
    return o.select(*[F.round(c, 6).alias(c) if c.startswith("avg_") else F.col(c) for c in o.columns])


def g37(t):
    sums = by_customer(t, t.orders, [F.col("state").alias("region")], total_sales=F.col("o_totalprice").cast(MONEY))
    return sums.withColumn("total_sales", F.col("total_sales").cast("double"))


def g37_top_customer(t):
    best = spend_per_customer(t).orderBy(F.desc("total_spent"), "o_custkey").limit(1)
    return (t.customer.join(F.broadcast(best), F.col("c_custkey") == F.col("o_custkey"))
            .select(F.col("c_name").alias("name"), "total_spent"))


def g37_latest_orders(t):
    return (t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date"),
                            F.col("o_totalprice").alias("total_amount"))
            .orderBy(F.desc("order_date"), "order_id").limit(10))


def g37_in_stock(t):
    return t.part.filter(F.col("p_size") > 0).select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_size").alias("stock_quantity"))


PLANS = {f"G{i:02d}": globals()[f"g{i:02d}"] for i in range(1, 38)}
PLANS.update(G37_top_customer=g37_top_customer, G37_latest_orders=g37_latest_orders, G37_in_stock=g37_in_stock)

"""Order analytics job: revenue by category, top products, daily trends.

Scale notes: lineitem is pre-aggregated per part key (map-side partial
aggregate, ~30× fewer rows at TPC-H ratios) before it meets ``part``; the
join itself is left to Catalyst/AQE, which broadcasts ``part`` only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
uses a sort-merge join with skew splitting.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.money import cents_bigint, exact_sum, from_cents, sql_sum_2dp
from cairn.plans._registry import query
from cairn.session import load


def _qty_by_part(spark: SparkSession, sf: str) -> DataFrame:
    # BIGINT buffers, exact past the BIGINT range; decimals once per part
    li = load(spark, sf, "lineitem")
    return (li.groupBy("l_partkey")
            .agg(from_cents(exact_sum(cents_bigint("l_quantity"))).alias("qty"),
                 F.count("l_orderkey").alias("n_lines")))


def _line_revenue(qty, price):
    # exact: quantity and unit price carry at most two decimals
    return qty * F.col(price).cast("decimal(18,2)")


@query("revenue_by_category", f"""
SELECT p_type AS category,
       {sql_sum_2dp('l_quantity * p_retailprice')} AS total_revenue,
       COUNT(l_orderkey) AS total_orders
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_type ORDER BY total_revenue DESC, category""")
def revenue_by_category(spark: SparkSession, sf: str) -> DataFrame:
    per_part = _qty_by_part(spark, sf)
    pa = load(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice")
    return (per_part.join(pa, per_part.l_partkey == pa.p_partkey)
            .groupBy(F.col("p_type").alias("category"))
            .agg(F.round(F.sum(_line_revenue(F.col("qty"), "p_retailprice")), 2)
                 .cast("double").alias("total_revenue"),
                 F.sum("n_lines").alias("total_orders"))
            .orderBy(F.desc("total_revenue"), "category"))


@query("top_products", f"""
SELECT p_partkey AS product_id, p_name AS product_name,
       {sql_sum_2dp('l_quantity * p_retailprice')} AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_partkey, p_name ORDER BY revenue DESC, product_id LIMIT 10""")
def top_products(spark: SparkSession, sf: str) -> DataFrame:
    per_part = _qty_by_part(spark, sf)
    pa = load(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return (per_part.join(pa, per_part.l_partkey == pa.p_partkey)
            .groupBy(F.col("p_partkey").alias("product_id"),
                     F.col("p_name").alias("product_name"))
            .agg(F.round(F.sum(_line_revenue(F.col("qty"), "p_retailprice")), 2)
                 .cast("double").alias("revenue"))
            # top-N is the feature: TakeOrderedAndProject keeps 10 rows per task
            .orderBy(F.desc("revenue"), "product_id")
            .limit(10))


@query("daily_order_trends", f"""
SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(l_orderkey) AS num_orders,
       {sql_sum_2dp('l_quantity * p_retailprice')} AS daily_revenue
FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN orders ON l_orderkey = o_orderkey
GROUP BY 1 ORDER BY order_date""")
def daily_order_trends(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    pa = load(spark, sf, "part").select("p_partkey", "p_retailprice")
    # revenue per order first: the orders join then sees one row per order
    # line revenue in exact units of 1/10,000 (cents × cents, BIGINT)
    units = cents_bigint("l_quantity") * cents_bigint("p_retailprice")
    per_order = (li.join(pa, li.l_partkey == pa.p_partkey)
                 .groupBy("l_orderkey")
                 .agg(F.count("l_orderkey").alias("n_lines"),
                      exact_sum(units).alias("rev_units")))
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return (per_order.join(o, per_order.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_orderdate").cast("date").alias("order_date"))
            .agg(F.sum("n_lines").alias("num_orders"),
                 F.round(F.sum("rev_units") * F.lit(Decimal("0.0001")), 2)
                 .cast("double").alias("daily_revenue"))
            .orderBy("order_date"))

"""Retail notebook: counts, distinct statuses, top dates, order totals, SQL and API.

Retail ``orders`` = driver orders, ``order_items`` = lineitem (subtotal =
extended price).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.money import avg_2dp, sum_2dp
from cairn.plans._registry import query
from cairn.session import load


def retail_orders(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("order_customer_id"),
        F.col("o_orderstatus").alias("order_status"))


def retail_items(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_item_order_id"),
        F.col("l_partkey").alias("order_item_product_id"),
        F.col("l_quantity").alias("order_item_quantity"),
        F.col("l_extendedprice").alias("order_item_subtotal"))


@query("row_count", "SELECT COUNT(*) AS n FROM lineitem")
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").select(F.count(F.lit(1)).alias("n"))


@query("distinct_status", "SELECT DISTINCT o_orderstatus AS order_status FROM orders")
def distinct_status(spark: SparkSession, sf: str) -> DataFrame:
    return retail_orders(spark, sf).select("order_status").distinct()


@query("distinct_status_count",
       "SELECT COUNT(DISTINCT o_orderstatus) AS n_status FROM orders")
def distinct_status_count(spark: SparkSession, sf: str) -> DataFrame:
    return retail_orders(spark, sf).select(F.count_distinct("order_status").alias("n_status"))


_TOP_DATES = """
SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS order_count
FROM orders GROUP BY 1 ORDER BY order_count DESC, order_date LIMIT 5"""


@query("top_dates_sql", _TOP_DATES)
def top_dates_sql(spark: SparkSession, sf: str) -> DataFrame:
    """Top 5 order dates, SQL spelling over a temp view."""
    retail_orders(spark, sf).createOrReplaceTempView("retail_orders")
    return spark.sql("""
        SELECT date(order_date) AS order_date, count(*) AS order_count
        FROM retail_orders GROUP BY date(order_date)
        ORDER BY order_count DESC, order_date LIMIT 5""")


@query("top_dates_df", _TOP_DATES)
def top_dates_df(spark: SparkSession, sf: str) -> DataFrame:
    """Top 5 order dates, DataFrame spelling (same physical plan)."""
    return (retail_orders(spark, sf)
            .groupBy(F.col("order_date").cast("date").alias("order_date"))
            .agg(F.count(F.lit(1)).alias("order_count"))
            .orderBy(F.desc("order_count"), "order_date")
            .limit(5))


_ORDER_TOTALS = """
SELECT o_orderkey AS order_id,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(38,2))) AS DOUBLE) AS total_sales
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY o_orderkey ORDER BY total_sales DESC, order_id"""


@query("order_totals_sql", _ORDER_TOTALS)
def order_totals_sql(spark: SparkSession, sf: str) -> DataFrame:
    retail_orders(spark, sf).createOrReplaceTempView("o")
    retail_items(spark, sf).createOrReplaceTempView("oi")
    return spark.sql("""
        SELECT o.order_id, CAST(t.total AS DOUBLE) AS total_sales
        FROM o INNER JOIN (
            SELECT order_item_order_id, sum(CAST(order_item_subtotal AS DECIMAL(38,2))) AS total
            FROM oi GROUP BY order_item_order_id) t ON o.order_id = t.order_item_order_id
        ORDER BY total_sales DESC, o.order_id""")


@query("order_totals_df", _ORDER_TOTALS)
def order_totals_df(spark: SparkSession, sf: str) -> DataFrame:
    o, oi = retail_orders(spark, sf), retail_items(spark, sf)
    # lines summed per order first (map-side partial sums); order ids are unique
    totals = (oi.groupBy("order_item_order_id")
              .agg(sum_2dp("order_item_subtotal", scale=2).alias("total_sales")))
    return (o.join(totals, o.order_id == totals.order_item_order_id)
            .select("order_id", "total_sales")
            .orderBy(F.desc("total_sales"), "order_id"))


@query("select_columns", """
SELECT o_orderkey AS order_id, o_custkey AS order_customer_id,
       o_orderstatus AS order_status, o_orderdate AS order_date FROM orders""")
def select_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The four equivalent column spellings: name, index, attribute, ``col``."""
    o = retail_orders(spark, sf)
    return o.select("order_id", o["order_customer_id"], o.order_status, F.col("order_date"))


@query("select_expr", """
SELECT o_orderkey AS order_id,
       TRY_CAST(CAST(o_custkey AS VARCHAR) AS INTEGER) + 100 AS customer_plus_100
FROM orders""")
def select_expr(spark: SparkSession, sf: str) -> DataFrame:
    """``col.cast("int") + 100`` on a text column (never fails: try_cast)."""
    o = retail_orders(spark, sf).withColumn("cid", F.col("order_customer_id").cast("string"))
    return o.select("order_id",
                    (F.col("cid").try_cast("int") + F.lit(100)).alias("customer_plus_100"))


@query("sql_temp_view", """
SELECT o_orderstatus AS order_status, COUNT(*) AS n FROM orders GROUP BY 1""")
def sql_temp_view(spark: SparkSession, sf: str) -> DataFrame:
    retail_orders(spark, sf).createOrReplaceTempView("dft")
    return spark.sql("SELECT order_status, count(*) AS n FROM dft GROUP BY order_status")


_SIGNED = """(SELECT l_linestatus, CASE l_returnflag WHEN 'R' THEN -1 ELSE 1 END
    * CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(6,2)) * CAST(l_tax AS DECIMAL(6,2)) AS fee,
    CAST(l_discount AS DECIMAL(6,2)) * CAST(l_tax AS DECIMAL(6,2)) * CAST(0.1 AS DECIMAL(2,1)) AS rate
    FROM lineitem)"""


@query("fees_any_scale", f"""
SELECT l_linestatus AS linestatus, CAST(ROUND(SUM(fee), 2) AS DOUBLE) AS total_fee,
       CAST(ROUND(SUM(rate), 2) AS DOUBLE) AS total_rate,
       sign(SUM(fee)) * CAST((200 * CAST(abs(SUM(fee)) * 1000000 AS HUGEINT) + COUNT(fee) * CAST(1000000 AS HUGEINT))
            // (2 * COUNT(fee) * CAST(1000000 AS HUGEINT)) AS DOUBLE) / 100 AS avg_fee
FROM {_SIGNED} f GROUP BY 1""")
def fees_any_scale(spark, sf):
    """Signed amounts of six decimals, rounded after the sum."""
    li = load(spark, sf, "lineitem")
    two = lambda c: F.col(c).cast("decimal(18,2)")
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    f = li.select("l_linestatus", (sign * two("l_extendedprice") * two("l_discount") * two("l_tax")).alias("fee"),
                  (two("l_discount") * two("l_tax") * F.lit(Decimal("0.1"))).alias("rate"))
    return f.groupBy(F.col("l_linestatus").alias("linestatus")).agg(
        sum_2dp("fee", scale=6).alias("total_fee"), sum_2dp("rate", scale=5).alias("total_rate"),
        avg_2dp("fee", scale=6).alias("avg_fee"))

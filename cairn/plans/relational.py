"""Joins, dedupe, latest-per-key, union, upsert and plain SQL queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.casting import apply_mapping
from cairn.operators.joins import join_frames
from cairn.operators.rows import dedupe, latest_per_key, merge_upsert, union_frames
from cairn.operators.shape import select_fields
from cairn.plans._registry import query
from cairn.session import load

_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            "l_shipdate"]


@query("dedupe_by_key", f"""
SELECT {', '.join(_LI_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
     ORDER BY {', '.join(c + ' NULLS FIRST' for c in _LI_COLS[:3] + _LI_COLS[4:])}) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedupe_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """``dropDuplicates([keys])`` made reproducible: first row by all other columns."""
    return dedupe(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("latest_per_key", """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey
                            ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""")
def latest_per_key_q(spark: SparkSession, sf: str) -> DataFrame:
    """Latest order per customer (window semantics, computed as an aggregate)."""
    o = load(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("union_all", """
SELECT o_orderkey, o_orderstatus, o_totalprice, NULL::TIMESTAMP AS o_orderdate
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_orderstatus, NULL::DOUBLE AS o_totalprice, o_orderdate
FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'""")
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    """Union by name of two frames with different columns (missing → NULL)."""
    o = load(spark, sf, "orders")
    a = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus", "o_totalprice")
    b = o.filter(~F.col("o_orderstatus").eqNullSafe("F")).select("o_orderkey", "o_orderstatus", "o_orderdate")
    return union_frames(a, b)


# Stage of changed and new customers, derived from the customer table itself:
# building-segment customers get a balance change; automobile-segment customers
# re-appear as new keys (negated: existing keys are not negative).


def customer_stage(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer")
    changed = (c.filter(F.col("c_mktsegment") == "BUILDING")
               .withColumn("c_acctbal", F.round(F.col("c_acctbal") + 100.0, 2)))
    new = (c.filter(F.col("c_mktsegment") == "AUTOMOBILE")
           .withColumn("c_custkey", -F.col("c_custkey") - 1))
    return changed.unionByName(new)


SQL_STAGE = """(SELECT c_custkey, c_name, c_nationkey, ROUND(c_acctbal + 100.0, 2) AS c_acctbal,
        c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
 UNION ALL
 SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment
 FROM customer WHERE c_mktsegment = 'AUTOMOBILE')"""


@query("merge_upsert", f"""
SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM {SQL_STAGE})
UNION ALL SELECT * FROM {SQL_STAGE}""")
def merge_upsert_q(spark: SparkSession, sf: str) -> DataFrame:
    return merge_upsert(load(spark, sf, "customer"), customer_stage(spark, sf), ["c_custkey"])


@query("join_keys", """
SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name, c_nationkey
FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_keys(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return join_frames(o, c, ["o_custkey"], ["c_custkey"])


def subscriber_sources(spark: SparkSession, sf: str):
    """Plans / assignments / subscribers as all-text frames (CSV-like).

    plan = nation (price = 10 × region + 5), assignment = customer → nation,
    subscriber = customer (gender stand-in = segment, VIP = balance ≥ 5000).
    """
    n = load(spark, sf, "nation")
    plans = n.select(F.col("n_nationkey").cast("string").alias("plan_id"),
                     F.col("n_name").alias("plan_desc"),
                     (F.col("n_regionkey") * 10 + 5).cast("string").alias("plan_price"))
    c = load(spark, sf, "customer")
    assign = c.select(F.col("c_custkey").cast("string").alias("msisdn"),
                      F.col("c_nationkey").cast("string").alias("plan_id"))
    subs = c.select(F.col("c_custkey").cast("string").alias("msisdn"),
                    F.col("c_mktsegment").alias("gender"),
                    F.concat(F.lit("19"), F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0"),
                             F.lit("-01-01")).alias("birth_date"),
                    F.when(F.col("c_acctbal") >= 5000, "true").otherwise("false").alias("is_vip"))
    return plans, assign, subs


SUBSCRIBER_MAPPING = [
    ("plan_id", "string", "plan_id", "bigint"),
    ("gender", "string", "gender", "string"),
    ("birth_date", "string", "birth_date", "string"),
    ("is_vip", "string", "is_vip", "boolean"),
    ("plan_desc", "string", "plan_desc", "string"),
    ("plan_price", "string", "plan_price", "int"),
]


def subscriber_plans_frame(plans, assign, subs) -> DataFrame:
    j1 = join_frames(assign, subs, ["msisdn"], ["msisdn"])
    j2 = join_frames(j1, plans, ["plan_id"], ["plan_id"])
    sel = select_fields(j2, ["plan_id", "gender", "birth_date", "is_vip", "plan_desc", "plan_price"])
    return apply_mapping(sel, SUBSCRIBER_MAPPING)


SQL_SUBSCRIBER_PLANS = """
SELECT CAST(c_nationkey AS BIGINT) AS plan_id, c_mktsegment AS gender,
       '19' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '-01-01' AS birth_date,
       c_acctbal >= 5000 AS is_vip, n_name AS plan_desc,
       CAST(n_regionkey * 10 + 5 AS INTEGER) AS plan_price
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


@query("subscriber_plans", SQL_SUBSCRIBER_PLANS)
def subscriber_plans(spark: SparkSession, sf: str) -> DataFrame:
    """assignments ⋈ subscribers ⋈ plans → select_fields → apply_mapping."""
    return subscriber_plans_frame(*subscriber_sources(spark, sf))


@query("join_left", """
SELECT c_custkey, c_name, o_orderkey, o_totalprice
FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select(
        "c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query("join_right", """
SELECT l_orderkey, l_linenumber, p_partkey, p_name
FROM lineitem RIGHT JOIN part ON l_partkey = p_partkey""")
def join_right(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = load(spark, sf, "part").select("p_partkey", "p_name")
    return li.join(p, li.l_partkey == p.p_partkey, "right").select(
        "l_orderkey", "l_linenumber", "p_partkey", "p_name")


@query("sales_by_product", """
SELECT p_name AS product, CAST(SUM(CAST(l_extendedprice AS DECIMAL(38,2))) AS DOUBLE) AS total_sales
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_name ORDER BY total_sales DESC, product""")
def sales_by_product(spark: SparkSession, sf: str) -> DataFrame:
    """``SELECT product, SUM(amount) … GROUP BY product ORDER BY …`` over a view."""
    li = load(spark, sf, "lineitem").select("l_partkey", "l_extendedprice")
    p = load(spark, sf, "part").select("p_partkey", "p_name")
    li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("p_name").alias("product"), F.col("l_extendedprice").alias("amount")
    ).createOrReplaceTempView("sales_orders")
    return spark.sql("""
        SELECT product, CAST(SUM(CAST(amount AS DECIMAL(38,2))) AS DOUBLE) AS total_sales
        FROM sales_orders GROUP BY product ORDER BY total_sales DESC, product""")


@query("sql_having", """
SELECT o_custkey, COUNT(*) AS n_orders, MIN(o_totalprice) AS min_price,
       MAX(o_totalprice) AS max_price
FROM orders GROUP BY o_custkey HAVING COUNT(*) >= 15""")
def sql_having(spark: SparkSession, sf: str) -> DataFrame:
    load(spark, sf, "orders").createOrReplaceTempView("orders_v")
    return spark.sql("""
        SELECT o_custkey, count(*) AS n_orders, min(o_totalprice) AS min_price,
               max(o_totalprice) AS max_price
        FROM orders_v GROUP BY o_custkey HAVING count(*) >= 15""")


@query("sql_cte_subquery", """
WITH cust_totals AS (
  SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(38,2))) AS DOUBLE) AS spend
  FROM orders GROUP BY o_custkey)
SELECT c_custkey, c_name, spend FROM customer JOIN cust_totals ON c_custkey = o_custkey
WHERE spend > (SELECT AVG(spend) FROM cust_totals)""")
def sql_cte_subquery(spark: SparkSession, sf: str) -> DataFrame:
    """CTE + scalar subquery: customers spending above the average customer."""
    load(spark, sf, "orders").createOrReplaceTempView("orders_v")
    load(spark, sf, "customer").createOrReplaceTempView("customer_v")
    return spark.sql("""
        WITH cust_totals AS (
          SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(38,2))) AS DOUBLE) AS spend
          FROM orders_v GROUP BY o_custkey)
        SELECT c_custkey, c_name, spend
        FROM customer_v JOIN cust_totals ON c_custkey = o_custkey
        WHERE spend > (SELECT avg(spend) FROM cust_totals)""")

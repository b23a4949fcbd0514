"""Whole jobs, from source to sink: order analytics, airlines, clean orders,
and the load that appends new files to one target.

The analytics jobs read catalog tables, scan and join each fact table once,
and compute their three results in one aggregate over grouping sets; the
result is written once (it is as small as its groups) and published as three
CSV outputs of one version: all of them, or none.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.money import avg_from_parts, cents_bigint, exact_sum, pct_2dp, sql_avg_2dp, sql_pct_2dp, sql_sum_2dp, sum_2dp
from cairn.incremental.bookmark import Bookmark
from cairn.plans._registry import query
from cairn.operators.choice import resolve_choice, text_to_choice
from cairn.plans.shaping import (RUN_DATE, SQL_CLEAN_ORDERS, SQL_ITEM_DISCOUNT, clean_orders_frame,
                                 discounted_items, order_items, order_lines)
from cairn.plans.standins import (FLIGHT_STATUS, SQL_EVENTS_TEXT, SQL_STATUS, events_text,
                                  status_expr)
from cairn.session import load, scratch, table_path, unique_name
from cairn.sinks.files import write_frame
from cairn.sinks.publish import publish, published
from cairn.sources.catalog import create_database, create_external_table
from cairn.sources.files import read_csv, read_parquet


def catalogued(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    """Driver tables as external tables of a fresh database, read through the catalog."""
    db = unique_name("jobs")
    create_database(spark, db, scratch(spark, "db", db))
    return {n: create_external_table(spark, f"{db}.{n}", "parquet", table_path(sf, n), schema=load(spark, sf, n).schema) for n in names}


def _stored(df: DataFrame, name: str) -> DataFrame:
    """The groups of all results, written once below one folder per result."""
    path = scratch(df.sparkSession, "jobs", name)
    write_frame(df, path, "parquet", partition_by=["output"])
    return read_parquet(df.sparkSession, path)


def _outputs(spark: SparkSession, root: str, schemas: dict[str, str]) -> dict[str, DataFrame]:
    return {n: read_csv(spark, published(spark, root, n), schema=s) for n, s in schemas.items()}


def _both(outputs: dict[str, DataFrame], shape) -> DataFrame:
    """The outputs read back, one below the other: output, key and figures."""
    out = None
    for n, df in outputs.items():
        rows = df.select(F.lit(n).alias("output"), *shape[n])
        out = rows if out is None else out.unionByName(rows)
    return out


def order_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Lines and revenue per category, per product and per day: one scan of
    lineitem and of orders, one join with each dimension, one aggregate."""
    t = catalogued(spark, sf, "lineitem", "part", "orders")
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_quantity")
    pa = t["part"].select("p_partkey", "p_name", "p_type", "p_retailprice")
    o = t["orders"].select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    lines = li.join(pa, li.l_partkey == pa.p_partkey).join(o, li.l_orderkey == o.o_orderkey, "left")
    lines = lines.select("l_orderkey", F.col("p_type").alias("category"), F.col("p_partkey").alias("product_id"),
                         F.col("p_name").alias("product_name"), "order_date", o.o_orderkey.isNotNull().alias("dated"),
                         (cents_bigint("l_quantity") * cents_bigint("p_retailprice")).alias("units"))
    sets = [["category"], ["product_id", "product_name"], ["dated", "order_date"]]
    g = lines.groupingSets(sets, "category", "product_id", "product_name", "dated", "order_date").agg(
        F.grouping("category").alias("g1"), F.grouping("product_id").alias("g2"),
        F.count("l_orderkey").alias("n"), (exact_sum("units") * F.lit(Decimal("0.0001"))).alias("revenue"))
    output = F.when(F.col("g1") == 0, "revenue_by_category").when(F.col("g2") == 0, "top_products").otherwise("daily_trends")
    # lines of no known order count for products and categories, not for days
    return g.where("g1 = 0 OR g2 = 0 OR dated").select(
        output.alias("output"), "category", "product_id", "product_name", "order_date", "n",
        F.round("revenue", 2).cast("double").alias("revenue"))


@query("order_analytics_job", f"""
WITH s AS (SELECT l_orderkey, p_type, p_partkey, p_name, l_quantity * p_retailprice AS amount FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT 'revenue_by_category' AS output, p_type AS key, {sql_sum_2dp('amount')} AS revenue, COUNT(l_orderkey) AS n FROM s GROUP BY p_type
UNION ALL SELECT * FROM (SELECT 'top_products', p_partkey || ' ' || p_name, {sql_sum_2dp('amount')} AS revenue, CAST(NULL AS BIGINT)
    FROM s GROUP BY p_partkey, p_name ORDER BY revenue DESC, p_partkey LIMIT 10)
UNION ALL SELECT 'daily_trends', strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d'), {sql_sum_2dp('amount')}, COUNT(l_orderkey)
    FROM s JOIN orders ON l_orderkey = o_orderkey GROUP BY CAST(o_orderdate AS DATE)""")
def order_analytics_job(spark, sf):
    """Catalog tables → three results from one scan → three CSV outputs, read back."""
    g = _stored(order_groups(spark, sf), "order-analytics")
    of = lambda name: g.where(F.col("output") == name)
    root = scratch(spark, "order_analytics")
    publish(spark, root, {
        "revenue_by_category": of("revenue_by_category").select("category", F.col("revenue").alias("total_revenue"), F.col("n").alias("total_orders"))
                               .orderBy(F.desc("total_revenue"), "category"),
        # top-N is the feature
        "top_products": of("top_products").select("product_id", "product_name", "revenue").orderBy(F.desc("revenue"), "product_id").limit(10),
        "daily_trends": of("daily_trends").select("order_date", F.col("n").alias("num_orders"), F.col("revenue").alias("daily_revenue")).orderBy("order_date")})
    outputs = _outputs(spark, root, {
        "revenue_by_category": "category STRING, total_revenue DOUBLE, total_orders BIGINT",
        "top_products": "product_id BIGINT, product_name STRING, revenue DOUBLE",
        "daily_trends": "order_date DATE, num_orders BIGINT, daily_revenue DOUBLE"})
    return _both(outputs, {
        "revenue_by_category": [F.col("category").alias("key"), F.col("total_revenue").alias("revenue"), F.col("total_orders").alias("n")],
        "top_products": [F.concat_ws(" ", F.col("product_id").cast("string"), "product_name").alias("key"), "revenue", F.lit(None).cast("bigint").alias("n")],
        "daily_trends": [F.date_format("order_date", "yyyy-MM-dd").alias("key"), F.col("daily_revenue").alias("revenue"), F.col("num_orders").alias("n")]})


def flight_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Flight figures per airline, per route and per day: one scan of orders
    (a flight each), one join with customers, one aggregate. A route leads from
    the customer's nation to the nation of the order's number."""
    t = catalogued(spark, sf, "orders", "customer", "nation")
    o = t["orders"].select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("flight_date"),
                           F.col("o_orderpriority").alias("airline"), status_expr().alias("status"),
                           cents_bigint("o_totalprice").alias("dep"), (F.col("o_custkey") % 180 * 100).cast("bigint").alias("arr"))
    c = t["customer"].select("c_custkey", F.col("c_nationkey").alias("origin"))
    f = o.join(c, o.o_custkey == c.c_custkey, "left").withColumn("target", (F.col("o_orderkey") % 25).cast("int"))
    flown = F.col("status") != F.lit(FLIGHT_STATUS["P"])
    of = lambda c, cond: F.when(cond, F.col(c))
    g = f.groupingSets([["airline"], ["origin", "target"], ["flight_date"]], "airline", "origin", "target", "flight_date").agg(
        F.grouping("airline").alias("g1"), F.grouping("target").alias("g2"),
        F.count("o_orderkey").alias("n"), F.count(of("o_orderkey", flown)).alias("n_flown"),
        F.count_if(F.col("status") == FLIGHT_STATUS["F"]).alias("n_delayed"), F.count_if(F.col("status") == FLIGHT_STATUS["P"]).alias("n_cancelled"),
        F.count("dep").alias("n_dep"), exact_sum("dep").alias("dep"),
        F.count(of("dep", flown)).alias("n_dep_flown"), exact_sum(of("dep", flown)).alias("dep_flown"),
        F.count(of("arr", flown)).alias("n_arr_flown"), exact_sum(of("arr", flown)).alias("arr_flown"))
    output = F.when(F.col("g1") == 0, "delay_by_airline").when(F.col("g2") == 0, "top_routes").otherwise("daily_trends")
    n = t["nation"].select("n_nationkey", "n_name")
    # groups are named after the aggregate: at most |nation|² routes
    a = n.select(F.col("n_nationkey").alias("origin"), F.col("n_name").alias("origin_name"))
    b = n.select(F.col("n_nationkey").alias("target"), F.col("n_name").alias("target_name"))
    return g.withColumn("output", output).join(a, "origin", "left").join(b, "target", "left").drop("g1", "g2", "origin", "target")


_FLIGHTS = f"""(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS flight_date, o_orderpriority AS airline, {SQL_STATUS} AS status,
    o_totalprice AS dep, CAST(o_custkey % 180 AS DOUBLE) AS arr, a.n_name || ' -> ' || b.n_name AS route
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON o_orderkey % 25 = b.n_nationkey)"""


@query("airlines_job", f"""
WITH f AS (SELECT * FROM {_FLIGHTS})
SELECT 'delay_by_airline' AS output, airline AS key, COUNT(o_orderkey) AS n, {sql_avg_2dp('dep')} AS avg_dep, {sql_avg_2dp('arr')} AS avg_arr,
       {sql_pct_2dp("COUNT(*) FILTER (WHERE status = 'Delayed')", 'COUNT(o_orderkey)')} AS delay_pct, CAST(NULL AS BIGINT) AS cancellations
FROM f WHERE status <> 'Cancelled' GROUP BY airline
UNION ALL SELECT * FROM (SELECT 'top_routes', route, COUNT(o_orderkey) AS n, {sql_avg_2dp('dep')}, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT)
    FROM f GROUP BY route ORDER BY n DESC, route LIMIT 10)
UNION ALL SELECT 'daily_trends', strftime(flight_date, '%Y-%m-%d'), COUNT(o_orderkey), {sql_avg_2dp('dep')}, NULL, NULL, COUNT(*) FILTER (WHERE status = 'Cancelled')
    FROM f GROUP BY flight_date""")
def airlines_job(spark, sf):
    """Catalog tables → three results from one scan → three CSV outputs, read back."""
    g = _stored(flight_groups(spark, sf), "airlines")
    of = lambda name: g.where(F.col("output") == name)
    root = scratch(spark, "airlines")
    publish(spark, root, {
        "delay_by_airline": of("delay_by_airline").where("n_flown > 0").select(
            "airline", avg_from_parts(F.col("dep_flown"), F.col("n_dep_flown")).alias("avg_dep_delay_mins"),
            avg_from_parts(F.col("arr_flown"), F.col("n_arr_flown")).alias("avg_arr_delay_mins"), F.col("n_flown").alias("total_flights"),
            pct_2dp(F.col("n_delayed"), F.col("n_flown")).alias("delay_pct")).orderBy(F.desc("avg_dep_delay_mins"), "airline"),
        # top-N is the feature
        "top_routes": of("top_routes").where("origin_name IS NOT NULL").select(
            F.concat_ws(" -> ", "origin_name", "target_name").alias("route"), F.col("n").alias("total_flights"),
            avg_from_parts(F.col("dep"), F.col("n_dep")).alias("avg_dep_delay_mins")).orderBy(F.desc("total_flights"), "route").limit(10),
        "daily_trends": of("daily_trends").select(
            "flight_date", F.col("n").alias("total_flights"), avg_from_parts(F.col("dep"), F.col("n_dep")).alias("avg_dep_delay_mins"),
            F.col("n_cancelled").alias("cancellations")).orderBy("flight_date")})
    outputs = _outputs(spark, root, {
        "delay_by_airline": "airline STRING, avg_dep_delay_mins DOUBLE, avg_arr_delay_mins DOUBLE, total_flights BIGINT, delay_pct DOUBLE",
        "top_routes": "route STRING, total_flights BIGINT, avg_dep_delay_mins DOUBLE",
        "daily_trends": "flight_date DATE, total_flights BIGINT, avg_dep_delay_mins DOUBLE, cancellations BIGINT"})
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    n, dep = F.col("total_flights").alias("n"), F.col("avg_dep_delay_mins").alias("avg_dep")
    return _both(outputs, {
        "delay_by_airline": [F.col("airline").alias("key"), n, dep, F.col("avg_arr_delay_mins").alias("avg_arr"), "delay_pct", none("bigint", "cancellations")],
        "top_routes": [F.col("route").alias("key"), n, dep, none("double", "avg_arr"), none("double", "delay_pct"), none("bigint", "cancellations")],
        "daily_trends": [F.date_format("flight_date", "yyyy-MM-dd").alias("key"), n, dep, none("double", "avg_arr"), none("double", "delay_pct"), "cancellations"]})


@query("clean_orders_job", SQL_CLEAN_ORDERS)
def clean_orders_job(spark, sf):
    """CSV landing → parse → clean → one row per order → Parquet partitioned by the run's date, read back."""
    raw = scratch(spark, "clean_orders", "raw")
    write_frame(order_lines(spark, sf), raw, "csv")
    rows = read_csv(spark, raw, schema="order_id BIGINT, customer_name STRING, product BIGINT, amount STRING, order_date STRING")
    out = scratch(spark, "clean_orders", "out")
    write_frame(clean_orders_frame(rows, RUN_DATE), out, "parquet", partition_by=["processed_date"], dynamic=True)
    return read_parquet(spark, out).select("order_id", "customer_name", "product", "amount", "order_date", "processed_date")


@query("messy_orders_job", f"""
SELECT event_id, event_type, CAST(amount AS DOUBLE) AS amount FROM {SQL_EVENTS_TEXT} e
WHERE regexp_full_match(amount, '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?')""")
def messy_orders_job(spark, sf):
    """CSV, all text → choice column → cast:double → rows with an amount → Parquet, read back."""
    raw = scratch(spark, "messy_orders", "raw")
    write_frame(events_text(spark, sf).select("event_id", "event_type", "amount"), raw, "csv")
    rows = read_csv(spark, raw).withColumn("amount", text_to_choice("amount"))
    clean = resolve_choice(rows, specs=[("amount", "cast:double")]).where(F.col("amount").isNotNull())
    out = scratch(spark, "messy_orders", "out")
    write_frame(clean.withColumn("event_id", F.col("event_id").try_cast("bigint")), out, "parquet")
    return read_parquet(spark, out)


@query("retail_job", """
SELECT 'top dates' AS result, strftime(order_date, '%Y-%m-%d') AS key, CAST(order_count AS DOUBLE) AS value
FROM (SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS order_count FROM orders GROUP BY 1 ORDER BY order_count DESC, order_date LIMIT 5)
UNION ALL SELECT 'status', o_orderstatus, CAST(COUNT(*) AS DOUBLE) FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'order total', CAST(o_orderkey AS VARCHAR), CAST(SUM(CAST(l_extendedprice AS DECIMAL(38,2))) AS DOUBLE)
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def retail_job(spark, sf):
    """Headerless CSV of orders and items with declared schemas → top dates, status counts, order totals."""
    base = scratch(spark, "retail")
    o = load(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "o_custkey", "o_orderstatus")
    write_frame(o, f"{base}/orders", "csv", header=False)
    write_frame(load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice"), f"{base}/items", "csv", header=False)
    orders = read_csv(spark, f"{base}/orders", header=False,
                      schema="order_id BIGINT, order_date TIMESTAMP_NTZ, order_customer_id BIGINT, order_status STRING")
    items = read_csv(spark, f"{base}/items", header=False, schema="order_item_order_id BIGINT, product_id BIGINT, subtotal DOUBLE")
    # top-N is the feature
    dates = (orders.groupBy(F.col("order_date").cast("date").alias("d")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "d").limit(5))
    totals = items.groupBy("order_item_order_id").agg(sum_2dp("subtotal", scale=2).alias("total"))
    totals = orders.join(totals, orders.order_id == totals.order_item_order_id)
    shape = lambda result, key, value: [F.lit(result).alias("result"), key.alias("key"), value.cast("double").alias("value")]
    return (dates.select(*shape("top dates", F.date_format("d", "yyyy-MM-dd"), F.col("n")))
            .unionByName(orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("n")).select(*shape("status", F.col("order_status"), F.col("n"))))
            .unionByName(totals.select(*shape("order total", F.col("order_id").cast("string"), F.col("total")))))


@query("item_discount_job", SQL_ITEM_DISCOUNT)
def item_discount_job(spark, sf):
    """CSV of order items → discount, ingestion time → CSV sink, read back."""
    base = scratch(spark, "item_discount")
    write_frame(order_items(spark, sf), f"{base}/raw", "csv")
    rows = read_csv(spark, f"{base}/raw", schema=order_items(spark, sf).schema)
    write_frame(discounted_items(rows), f"{base}/out", "csv")
    return read_csv(spark, f"{base}/out", schema=discounted_items(rows).schema)


_EV_COLS = "event_id, ts, user_id, event_type, value, props"


@query("incremental_append_job", f"""
SELECT CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' OR ts IS NULL THEN 2 ELSE 1 END AS run, {_EV_COLS} FROM events""")
def incremental_append_job(spark, sf):
    """Runs that append new files to one target and commit in the same step;
    the second run is repeated after it failed before its commit, and the
    last one finds nothing new."""
    e = load(spark, sf, "events")
    late = (F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")) | F.col("ts").isNull()
    base = scratch(spark, "append_job")
    src, target = f"{base}/source", f"{base}/target"

    def run(number: int, fail: bool = False) -> None:
        bm = Bookmark(spark, f"{base}/state", job="append")
        rows = bm.read_new(src, "parquet", e.schema, glob="*.parquet").withColumn("run", F.lit(number))
        if fail:
            write_frame(rows, f"{target}/_staged/{bm.run_id}", "parquet")
        else:
            bm.append(rows, target)

    write_frame(e.where(~late), f"{src}/batch1", "parquet")
    run(1)
    write_frame(e.where(late), f"{src}/batch2", "parquet")
    run(2, fail=True)
    run(2)
    run(3)
    return read_parquet(spark, target).drop("batch")

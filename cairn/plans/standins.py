"""Driver tables re-shaped into the reference's business inputs.

Every builder is a lazy projection/join over the given parquet tables, so its
work grows with them (see FIXTURES.md §6 for the mapping).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.session import load

# Flight status per TPC-H order status (stand-in mapping).
FLIGHT_STATUS = {"F": "Delayed", "O": "On Time", "P": "Cancelled"}


def sales_lines(spark: SparkSession, sf: str) -> DataFrame:
    """E-commerce order lines: lineitem ⋈ part."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    pa = load(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    return li.join(pa, li.l_partkey == pa.p_partkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
    )


def status_expr(col: str = "o_orderstatus"):
    e = None
    for k, v in FLIGHT_STATUS.items():
        e = (F.when(F.col(col) == k, v) if e is None else e.when(F.col(col) == k, v))
    return e


SQL_STATUS = ("CASE o_orderstatus WHEN 'F' THEN 'Delayed' WHEN 'O' THEN 'On Time' "
              "WHEN 'P' THEN 'Cancelled' END")


def flights(spark: SparkSession, sf: str) -> DataFrame:
    """Flights: one per order; airline = priority, delay = total price."""
    o = load(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("flight_id"),
        F.col("o_orderdate").cast("date").alias("flight_date"),
        F.col("o_orderpriority").alias("airline"),
        status_expr().alias("status"),
        F.col("o_totalprice").alias("departure_delay_mins"),
        (F.col("o_custkey") % 180).cast("double").alias("arrival_delay_mins"),
    )


SQL_FLIGHTS = f"""(SELECT o_orderkey AS flight_id, CAST(o_orderdate AS DATE) AS flight_date,
    o_orderpriority AS airline, {SQL_STATUS} AS status,
    o_totalprice AS departure_delay_mins,
    CAST(o_custkey % 180 AS DOUBLE) AS arrival_delay_mins FROM orders)"""


def events_text(spark: SparkSession, sf: str) -> DataFrame:
    """Messy text amounts: events.value as text, 'N/A' for errors, NULL for views."""
    e = load(spark, sf, "events")
    txt = (F.when(F.col("event_type") == "error", F.lit("N/A"))
           .when(F.col("event_type") == "view", F.lit(None).cast("string"))
           .otherwise(F.col("value").cast("string")))
    return e.select("event_id", "ts", "user_id", "event_type", txt.alias("amount"), "props")


SQL_EVENTS_TEXT = """(SELECT event_id, ts, user_id, event_type,
    CASE WHEN event_type = 'error' THEN 'N/A' WHEN event_type = 'view' THEN NULL
         ELSE CAST(value AS VARCHAR) END AS amount, props FROM events)"""


def _doc_part():
    """Document of a line within its order: supplier and ship date, both taken
    from the line itself, so the document does not depend on how many lines
    the order has."""
    return F.concat(F.coalesce(F.col("l_suppkey").cast("string"), F.lit("")), F.lit("-"),
                    F.coalesce(F.date_format("l_shipdate", "yyyyMMdd"), F.lit("")))


def nested_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as documents: customer struct + items array of structs.

    One document per (order, supplier, ship date); an order without lines is
    one document with part ``''`` and no items. The line items meet the
    order-sized frame in an inner join (AQE can split a hot order on the line
    side) and documents are built per (order, part), which spreads a hot order
    over many tasks. Order and customer keys are primary keys. Arrays are
    sorted by every field (``sort_array``: natural struct order), so each
    item's index is deterministic.
    """
    li = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        _doc_part().alias("part"))
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = (o.join(c, o.o_custkey == c.c_custkey, "left")
              .select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment"))
    doc_keys = ["o_orderkey", "part", "o_totalprice", "c_name", "c_mktsegment"]
    # cluster on (order, part), not on the order alone
    docs = (li.join(orders, li.l_orderkey == orders.o_orderkey)
            .repartition("o_orderkey", "part").groupBy(*doc_keys)
            .agg(F.sort_array(F.collect_list(F.struct(
                F.col("l_linenumber").alias("line"),
                F.col("l_partkey").alias("product"),
                F.col("l_quantity").alias("quantity"),
                F.col("l_extendedprice").alias("price"),
            ))).alias("items")))
    with_lines = li.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    no_lines = (orders.join(with_lines, "o_orderkey", "left_anti")
                .select("o_orderkey", F.lit("").alias("part"), "o_totalprice", "c_name", "c_mktsegment",
                        F.lit(None).cast(docs.schema["items"].dataType).alias("items")))
    return (docs.unionByName(no_lines)
            .select(F.concat_ws("/", F.col("o_orderkey").cast("string"), "part").alias("doc_id"),
                    F.col("o_orderkey").alias("order_id"), "part",
                    F.struct(F.col("c_name").alias("name"),
                             F.col("c_mktsegment").alias("segment")).alias("customer"),
                    F.col("o_totalprice").alias("total"),
                    "items"))


# The same documents in DuckDB SQL: line rows with their document.
SQL_DOC_LINES = """(SELECT l.*, COALESCE(CAST(l_suppkey AS VARCHAR), '') || '-'
      || COALESCE(strftime(l_shipdate, '%Y%m%d'), '') AS part
   FROM lineitem l WHERE l_orderkey IN (SELECT o_orderkey FROM orders))"""

SQL_DOCS = f"""(SELECT CAST(o_orderkey AS VARCHAR) || '/' || COALESCE(d.part, '') AS doc_id,
       o_orderkey AS order_id, COALESCE(d.part, '') AS part, c_name, c_mktsegment,
       o_totalprice AS total, d.l_orderkey IS NOT NULL AS has_items
   FROM orders LEFT JOIN customer ON o_custkey = c_custkey
   LEFT JOIN (SELECT DISTINCT l_orderkey, part FROM {SQL_DOC_LINES}) d ON o_orderkey = d.l_orderkey)"""

SQL_DOC_ITEMS = f"""(SELECT CAST(l_orderkey AS VARCHAR) || '/' || part AS id,
   CAST(row_number() OVER (PARTITION BY l_orderkey, part
        ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 AS INTEGER) AS "index",
   l_linenumber AS "items.line", l_partkey AS "items.product",
   l_quantity AS "items.quantity", l_extendedprice AS "items.price"
 FROM {SQL_DOC_LINES})"""

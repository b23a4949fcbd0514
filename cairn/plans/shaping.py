"""Projection, filters, mapping, splits, cleaning jobs and Python row functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.casting import apply_mapping
from cairn.functions.dates import parse_date
from cairn.operators.rowfn import map_partitions, map_rows
from cairn.operators.rows import dedupe, split_rows
from cairn.operators.shape import (drop_fields, filter_rows, rename_field, select_fields,
                                   split_fields, with_frame_schema)
from cairn.plans._registry import query
from cairn.plans.standins import SQL_DOCS, nested_orders
from cairn.session import load, scratch

# A fixed run timestamp stands in for "now" so reruns are reproducible; a
# scheduled job passes its own logical run time.
RUN_TS = "2024-02-01 00:00:00"
RUN_DATE = "2024-02-01"


def _nested_customer(spark, sf) -> DataFrame:
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = load(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "o_totalprice",
        F.struct("c_name", "c_mktsegment",
                 F.struct("c_nationkey", "c_acctbal").alias("account")).alias("customer"))


_NESTED_SQL = """(SELECT o_orderkey, o_totalprice, c_name, c_mktsegment, c_nationkey, c_acctbal
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query("select_fields", f"""
SELECT o_orderkey, c_name AS "customer.c_name", c_acctbal AS "customer.account.c_acctbal"
FROM {_NESTED_SQL}""")
def select_fields_q(spark, sf):
    """Top-level and nested paths; nested output flattened for comparison."""
    df = select_fields(_nested_customer(spark, sf),
                       ["o_orderkey", "customer.c_name", "customer.account.c_acctbal"])
    return df.select("o_orderkey", F.col("customer.c_name").alias("customer.c_name"),
                     F.col("customer.account.c_acctbal").alias("customer.account.c_acctbal"))


@query("drop_fields", """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders""")
def drop_fields_q(spark, sf):
    return drop_fields(load(spark, sf, "orders"), ["o_totalprice", "o_orderpriority"])


@query("drop_fields_nested", f"""
SELECT o_orderkey, o_totalprice, c_name AS "customer.c_name",
       c_mktsegment AS "customer.c_mktsegment", c_nationkey AS "customer.account.c_nationkey"
FROM {_NESTED_SQL}""")
def drop_fields_nested(spark, sf):
    df = drop_fields(_nested_customer(spark, sf), ["customer.account.c_acctbal"])
    assert df.schema["customer"].dataType["account"].dataType.fieldNames() == ["c_nationkey"]
    return df.select("o_orderkey", "o_totalprice",
                     F.col("customer.c_name").alias("customer.c_name"),
                     F.col("customer.c_mktsegment").alias("customer.c_mktsegment"),
                     F.col("customer.account.c_nationkey").alias("customer.account.c_nationkey"))


@query("rename_field", f"""
SELECT o_orderkey AS order_id, o_totalprice, c_name AS "customer.name",
       c_acctbal AS "customer.account.balance"
FROM {_NESTED_SQL}""")
def rename_field_q(spark, sf):
    df = rename_field(_nested_customer(spark, sf), "o_orderkey", "order_id")
    df = rename_field(df, "customer.c_name", "customer.name")
    df = rename_field(df, "customer.account.c_acctbal", "customer.account.balance")
    return df.select("order_id", "o_totalprice",
                     F.col("customer.name").alias("customer.name"),
                     F.col("customer.account.balance").alias("customer.account.balance"))


def _text_orders(spark, sf) -> DataFrame:
    """Orders as an all-text frame, as read from a CSV without inference."""
    o = load(spark, sf, "orders")
    return o.select(*[F.col(c).cast("string").alias(c) for c in o.columns])


@query("apply_mapping", """
SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_totalprice AS DOUBLE) AS amount,
       CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status
FROM orders""")
def apply_mapping_q(spark, sf):
    """Text columns → typed targets, renamed, in mapping order; priority dropped."""
    return apply_mapping(_text_orders(spark, sf), [
        ("o_orderkey", "string", "order_id", "bigint"),
        ("o_totalprice", "string", "amount", "double"),
        ("o_orderdate", "string", "order_date", "date"),
        ("o_orderstatus", "string", "status", "string"),
    ])


@query("filter_positive", """
SELECT * FROM lineitem WHERE l_extendedprice * (1 - l_discount) - 50000 > 0""")
def filter_positive(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.filter((F.col("l_extendedprice") * (1 - F.col("l_discount")) - 50000) > 0)


@query("filter_not_equal", "SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def filter_not_equal(spark, sf):
    return load(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")


@query("filter_not_null", """
SELECT event_id, TRY_CAST(amount AS DOUBLE) AS amount FROM (SELECT event_id,
  CASE WHEN event_type = 'error' THEN 'N/A' WHEN event_type = 'view' THEN NULL
       ELSE CAST(value AS VARCHAR) END AS amount FROM events)
WHERE TRY_CAST(amount AS DOUBLE) IS NOT NULL""")
def filter_not_null(spark, sf):
    from cairn.plans.standins import events_text
    e = events_text(spark, sf).select("event_id", F.col("amount").try_cast("double").alias("amount"))
    return e.filter(F.col("amount").isNotNull())


@query("filter_row_fn", "SELECT * FROM orders WHERE o_totalprice > 400000")
def filter_row_fn(spark, sf):
    """Python predicate (``lambda row: row['amount'] > 400``) run vectorised."""
    return filter_rows(load(spark, sf, "orders"), lambda pdf: pdf["o_totalprice"] > 400000)


@query("split_fields_left", "SELECT o_orderkey, o_totalprice FROM orders")
def split_fields_left(spark, sf):
    return split_fields(load(spark, sf, "orders"), ["o_orderkey", "o_totalprice"])[0]


@query("split_fields_right", """
SELECT o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders""")
def split_fields_right(spark, sf):
    return split_fields(load(spark, sf, "orders"), ["o_orderkey", "o_totalprice"])[1]


_SPLIT_COND = "o_totalprice > 200000 AND o_orderpriority <> '5-LOW'"


@query("split_rows_match", f"SELECT * FROM orders WHERE {_SPLIT_COND}")
def split_rows_match(spark, sf):
    return split_rows(load(spark, sf, "orders"), _SPLIT_COND)[0]


@query("split_rows_rest", f"SELECT * FROM orders WHERE NOT COALESCE({_SPLIT_COND}, FALSE)")
def split_rows_rest(spark, sf):
    return split_rows(load(spark, sf, "orders"), _SPLIT_COND)[1]


@query("with_schema", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, CAST(NULL AS VARCHAR) AS o_comment
FROM orders""")
def with_schema(spark, sf):
    """Conform text orders to a declared schema (missing column → NULL)."""
    return with_frame_schema(_text_orders(spark, sf),
                             "o_orderkey bigint, o_totalprice decimal(12,2), "
                             "o_orderdate date, o_comment string")


@query("parse_dates", """
SELECT o_orderkey, TRY_CAST(TRY_STRPTIME(
   CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d/%m/%Y')
        ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS order_date
FROM orders""")
def parse_dates(spark, sf):
    """``to_date(text, 'yyyy-MM-dd')`` that yields NULL for other layouts."""
    o = load(spark, sf, "orders")
    txt = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd/MM/yyyy")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", parse_date(txt, "yyyy-MM-dd").alias("order_date"))


SQL_ITEM_DISCOUNT = f"""
SELECT l_orderkey AS order_item_order_id, l_linenumber AS order_item_line,
       l_extendedprice AS order_item_subtotal,
       CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.9, 2) AS DOUBLE) AS discounted_subtotal,
       '{RUN_TS}' AS ingestion_time
FROM lineitem"""


def order_items(spark, sf) -> DataFrame:
    """Order items with their subtotal, quantity and product price."""
    return load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_item_order_id"),
        F.col("l_linenumber").alias("order_item_line"),
        F.col("l_extendedprice").alias("order_item_subtotal"),
        F.col("l_quantity").alias("order_item_quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("order_item_product_price"))


def discounted_items(items: DataFrame) -> DataFrame:
    """subtotal × 0.9 rounded (exact decimal), ingestion time, product price dropped."""
    return (items.withColumn("discounted_subtotal",
                          F.round(F.col("order_item_subtotal").cast("decimal(18,2)")
                                  * F.lit(0.9).cast("decimal(2,1)"), 2).cast("double"))
            .withColumn("ingestion_time", F.lit(RUN_TS))
            .drop("order_item_product_price", "order_item_quantity"))


@query("order_item_discount", SQL_ITEM_DISCOUNT)
def order_item_discount(spark, sf):
    return discounted_items(order_items(spark, sf))


def order_lines(spark, sf) -> DataFrame:
    """Raw order rows: one per line item, so order ids repeat; returned lines
    carry negative amounts; amounts are text.

    Orders meet customers first (order-sized), then the line items join on
    the order key, so the later one-row-per-order step reuses that
    partitioning instead of shuffling the line items again."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    oc = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_orderdate", "c_name")
    amt = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    return (li.join(oc, li.l_orderkey == oc.o_orderkey)
            .select(F.col("l_orderkey").alias("order_id"), F.lower("c_name").alias("customer_name"),
                    F.col("l_partkey").alias("product"), amt.cast("string").alias("amount"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date")))


def clean_orders_frame(raw: DataFrame, run_date: str = RUN_DATE) -> DataFrame:
    """upper(name), processed date, amount > 0, one row per order id."""
    df = (raw.withColumn("customer_name", F.upper("customer_name"))
          .filter(F.col("amount").try_cast("double") > 0))
    return dedupe(df, ["order_id"]).withColumn("processed_date", F.lit(run_date).cast("date"))


SQL_CLEAN_ORDERS = f"""
SELECT order_id, customer_name, product, amount, order_date, DATE '{RUN_DATE}' AS processed_date
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY customer_name, product,
                                   amount, order_date) AS rn
      FROM (SELECT l_orderkey AS order_id, upper(lower(c_name)) AS customer_name,
                   l_partkey AS product,
                   CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END
                        AS VARCHAR) AS amount,
                   strftime(o_orderdate, '%Y-%m-%d') AS order_date
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON o_custkey = c_custkey)
      WHERE TRY_CAST(amount AS DOUBLE) > 0)
WHERE rn = 1"""


@query("clean_orders", SQL_CLEAN_ORDERS)
def clean_orders(spark, sf):
    return clean_orders_frame(order_lines(spark, sf))


def _upper_name(rec: dict) -> dict:
    rec["c_name"] = rec["c_name"].upper()
    return rec


@query("map_rows", "SELECT c_custkey, upper(c_name) AS c_name, c_acctbal FROM customer")
def map_rows_q(spark, sf):
    """Record function ``map(f)``: upper-case the name, per record, in Arrow batches."""
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return map_rows(c, _upper_name, c.schema).frame


def _balance_band(records):
    for r in records:
        yield {"c_custkey": r["c_custkey"], "band": int(r["c_acctbal"] // 1000)}


@query("map_partitions", """
SELECT c_custkey, CAST(floor(c_acctbal / 1000) AS BIGINT) AS band FROM customer""")
def map_partitions_q(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return map_partitions(c, _balance_band, "c_custkey bigint, band bigint").frame


@query("map_partitions_index", """
SELECT c_custkey, CAST(0 AS INTEGER) AS below, CAST(3 AS INTEGER) AS partitions FROM customer""")
def map_partitions_index(spark, sf):
    """``mapPartitionsWithIndex``: each row tagged with its partition number.
    Which row lies where is the engine's choice, so the result tells, per row,
    whether its number is out of range and how many partitions there are."""
    c = load(spark, sf, "customer").select("c_custkey").repartition(3, "c_custkey")

    def tag(pid, records):
        for r in records:
            yield {"c_custkey": r["c_custkey"], "partition": pid}

    out = map_partitions(c, tag, "c_custkey bigint, partition int", with_index=True).frame
    seen = out.agg(F.count_distinct("partition").cast("int").alias("partitions"))
    return out.select("c_custkey", (~F.col("partition").between(0, 2)).cast("int").alias("below")).join(F.broadcast(seen))


def _parse_amount(rec: dict) -> dict:
    return {"event_id": rec["event_id"], "amount": float(rec["amount"])}


_EVENTS_AMOUNT = """(SELECT event_id, CASE WHEN event_type = 'error' THEN 'N/A'
   WHEN event_type = 'view' THEN NULL ELSE CAST(value AS VARCHAR) END AS amount FROM events)"""


@query("good_rows", f"""
SELECT event_id, CAST(amount AS DOUBLE) AS amount FROM {_EVENTS_AMOUNT}
WHERE TRY_CAST(amount AS DOUBLE) IS NOT NULL""")
def good_rows(spark, sf):
    from cairn.plans.standins import events_text
    e = events_text(spark, sf).select("event_id", "amount")
    return map_rows(e, _parse_amount, "event_id bigint, amount double", stage="parse").frame


@query("error_rows", f"""
SELECT 'parse' AS stage, event_id, amount FROM {_EVENTS_AMOUNT}
WHERE TRY_CAST(amount AS DOUBLE) IS NULL""")
def error_rows(spark, sf):
    """Failing records land in the error set with their record text."""
    from cairn.plans.standins import events_text
    e = events_text(spark, sf).select("event_id", "amount")
    err = map_rows(e, _parse_amount, "event_id bigint, amount double", stage="parse").errors
    return err.select("stage",
                      F.get_json_object("record", "$.event_id").cast("bigint").alias("event_id"),
                      F.get_json_object("record", "$.amount").alias("amount"))


# Three stages over messy events: ids, amounts, rules.
_CHECKED = """(SELECT event_id, event_type, amount, value,
    CASE WHEN event_id % 50 = 0 THEN 'ids' WHEN amount = 'N/A' THEN 'amounts'
         WHEN amount IS NULL OR value >= 90 THEN 'rules' END AS stage,
    CASE WHEN event_id % 50 = 0 THEN 'code: ' || event_id || 'x is no bigint' WHEN amount = 'N/A' THEN 'amount: N/A is no double'
         WHEN amount IS NULL THEN 'amount is missing; amount is too large' WHEN value >= 90 THEN 'amount is too large' END AS message
    FROM (SELECT event_id, event_type, value, CASE WHEN event_type = 'error' THEN 'N/A'
          WHEN event_type = 'view' THEN NULL ELSE CAST(value AS VARCHAR) END AS amount FROM events))"""


def checked_events(spark, sf):
    """The outcome of the three stages, evaluated once."""
    from cairn.operators.checked import Checked
    from cairn.plans.standins import events_text
    e = events_text(spark, sf)
    i = F.col("event_id")
    code = F.when(i % 50 == 0, F.concat(i.cast("string"), F.lit("x"))).otherwise(i.cast("string"))
    return (Checked(e.select(code.alias("code"), "event_type", "amount"))
            .cast([("code", "string", "id", "bigint"), ("event_type", "string", "kind", "string"),
                   ("amount", "string", "amount", "string")], stage="ids")
            .cast([("id", "bigint", "id", "bigint"), ("kind", "string", "kind", "string"),
                   ("amount", "string", "amount", "double")], stage="amounts")
            .require({"amount is missing": "amount IS NOT NULL", "amount is too large": F.col("amount") < 90}, stage="rules")
            .run(scratch(spark, "checked_events")))


@query("errors_of_casts", f"""
SELECT stage, message, event_type AS kind, COUNT(*) AS n FROM {_CHECKED} c WHERE stage IS NOT NULL GROUP BY ALL""")
def errors_of_casts(spark, sf):
    """Failing records of JVM casts and rules, with the stage each failed in."""
    err = checked_events(spark, sf).errors
    kind = F.coalesce(F.get_json_object("record", "$.event_type"), F.get_json_object("record", "$.kind"))
    return err.groupBy("stage", "message", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("good_of_casts", f"SELECT event_id AS id, event_type AS kind, CAST(amount AS DOUBLE) AS amount FROM {_CHECKED} c WHERE stage IS NULL")
def good_of_casts(spark, sf):
    return checked_events(spark, sf).frame


@query("stage_counts", f"""
SELECT 'ids' AS stage, COUNT(*) AS seen, COUNT(*) FILTER (WHERE stage = 'ids') AS errors FROM {_CHECKED} c
UNION ALL SELECT 'amounts', COUNT(*) FILTER (WHERE stage IS NULL OR stage <> 'ids'), COUNT(*) FILTER (WHERE stage = 'amounts') FROM {_CHECKED} c
UNION ALL SELECT 'rules', COUNT(*) FILTER (WHERE stage IS NULL OR stage = 'rules'), COUNT(*) FILTER (WHERE stage = 'rules') FROM {_CHECKED} c""")
def stage_counts(spark, sf):
    """Records seen and failed per stage, from the observed metrics of the one write."""
    counts = checked_events(spark, sf).counts
    return spark.createDataFrame([(s, c.seen, c.errors) for s, c in counts.items()], "stage string, seen bigint, errors bigint")


@query("unnest_structs", """
SELECT doc_id, order_id, part, c_name AS "customer.name", c_mktsegment AS "customer.segment", total
FROM DOCS d""".replace("DOCS", SQL_DOCS))
def unnest_structs(spark, sf):
    from cairn.operators.nested import flatten_struct_columns
    return flatten_struct_columns(nested_orders(spark, sf).drop("items"))

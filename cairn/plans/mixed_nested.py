"""Choice columns, relationalize, unbox, DynamoDB JSON, arrays and maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.operators.choice import choice_profile, resolve_choice, resolve_column, text_to_choice
from cairn.operators.nested import (explode_array, explode_map, relationalize, unbox,
                                    unnest_ddb_json)
from cairn.plans._registry import query
from cairn.plans.standins import (SQL_DOC_ITEMS, SQL_DOCS, SQL_EVENTS_TEXT, events_text,
                                  nested_orders)
from cairn.session import load, scratch
from cairn.sinks.files import write_frame
from cairn.sources.files import read_parquet


def messy_events(spark, sf) -> DataFrame:
    """Events whose ``amount`` (and ``user``) are choice columns."""
    e = events_text(spark, sf)
    user = F.when(F.col("event_type") == "signup", F.lit("new")).otherwise(F.col("user_id").cast("string"))
    return e.select("event_id", "event_type",
                    text_to_choice("amount").alias("amount"),
                    text_to_choice(user).alias("user"))


_ET = SQL_EVENTS_TEXT
_DOUBLE = "TRY_CAST(amount AS DOUBLE)"


@query("choice_profile", f"""
SELECT 'amount' AS "column",
       CASE WHEN amount IS NULL THEN NULL WHEN {_DOUBLE} IS NOT NULL THEN 'DOUBLE'
            ELSE 'STRING' END AS value_type,
       COUNT(*) AS n
FROM {_ET} e GROUP BY 2""")
def choice_profile_q(spark, sf):
    return choice_profile(messy_events(spark, sf), ["amount"])


@query("resolve_cast_double", f"SELECT event_id, {_DOUBLE} AS amount FROM {_ET} e")
def resolve_cast_double(spark, sf):
    return resolve_column(messy_events(spark, sf).select("event_id", "amount"),
                          "amount", "cast:double")


@query("resolve_cast_string", f"""
SELECT event_id, amount FROM {_ET} e""")
def resolve_cast_string(spark, sf):
    return resolve_column(messy_events(spark, sf).select("event_id", "amount"),
                          "amount", "cast:string")


@query("resolve_project_double", f"""
SELECT event_id, {_DOUBLE} AS amount FROM {_ET} e
WHERE amount IS NULL OR {_DOUBLE} IS NOT NULL""")
def resolve_project_double(spark, sf):
    return resolve_column(messy_events(spark, sf).select("event_id", "amount"),
                          "amount", "project:double")


@query("resolve_make_struct", f"""
SELECT event_id, {_DOUBLE} AS amount_double,
       CASE WHEN {_DOUBLE} IS NULL THEN amount END AS amount_string
FROM {_ET} e""")
def resolve_make_struct(spark, sf):
    df = resolve_column(messy_events(spark, sf).select("event_id", "amount"),
                        "amount", "make_struct")
    return df.select("event_id", F.col("amount.double").alias("amount_double"),
                     F.col("amount.string").alias("amount_string"))


@query("resolve_make_array", f"""
SELECT event_id, CASE WHEN amount IS NULL THEN NULL ELSE 1 END AS n_values,
       amount AS first_value
FROM {_ET} e""")
def resolve_make_array(spark, sf):
    df = resolve_column(messy_events(spark, sf).select("event_id", "amount"),
                        "amount", "make_array")
    return df.select("event_id", F.size("amount").alias("n_values"),
                     F.element_at("amount", 1).alias("first_value"))


@query("resolve_mixed_specs", f"""
SELECT event_id, event_type, {_DOUBLE} AS amount, CAST(user_id AS DOUBLE) AS "user"
FROM {_ET} e WHERE event_type <> 'signup'""")
def resolve_mixed_specs(spark, sf):
    """specs for ``amount`` (cast:double); default ``project:double`` for the rest."""
    return resolve_choice(messy_events(spark, sf), specs=[("amount", "cast:double")],
                          choice="project:double")


# Texts that a detour through DOUBLE alters: leading zeros, a type letter, a
# trailing zero, a 20-digit id, an exponent, words of numbers.
_SPELLED = """(SELECT event_id, CASE event_id % 8
    WHEN 0 THEN lpad(CAST(event_id AS VARCHAR), 12, '0') WHEN 1 THEN CAST(event_id AS VARCHAR) || 'D'
    WHEN 2 THEN CAST(user_id AS VARCHAR) || '.50' WHEN 3 THEN '1234567890' || lpad(CAST(event_id AS VARCHAR), 10, '0')
    WHEN 4 THEN CAST(event_id AS VARCHAR) || 'e2' WHEN 5 THEN 'NaN' WHEN 6 THEN ' -' || CAST(user_id AS VARCHAR) || '. '
    END AS code FROM events)"""
_PLAIN = "regexp_matches(code, '^ *[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)? *$')"


def spelled_events(spark, sf) -> DataFrame:
    i, u = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    k = F.col("event_id") % 8
    code = (F.when(k == 0, F.lpad(i, 12, "0")).when(k == 1, F.concat(i, F.lit("D")))
            .when(k == 2, F.concat(u, F.lit(".50"))).when(k == 3, F.concat(F.lit("1234567890"), F.lpad(i, 10, "0")))
            .when(k == 4, F.concat(i, F.lit("e2"))).when(k == 5, F.lit("NaN")).when(k == 6, F.concat(F.lit(" -"), u, F.lit(". "))))
    return load(spark, sf, "events").select("event_id", text_to_choice(code).alias("code"))


@query("resolve_text_kept", f"""
SELECT event_id, code AS as_string, code AS first_value,
       CASE WHEN {_PLAIN} THEN CAST(trim(code) AS DOUBLE) END AS as_double,
       CASE WHEN event_id % 8 = 3 THEN CAST(code AS DECIMAL(38,0)) WHEN {_PLAIN} THEN CAST(CAST(trim(code) AS DOUBLE) AS DECIMAL(38,0)) END AS as_decimal
FROM {_SPELLED} s""")
def resolve_text_kept(spark, sf):
    """Every spelling comes back from ``cast:string`` and ``make_array``; numbers are plain numerals only, exact from the text."""
    e = spelled_events(spark, sf).withColumns({c: F.col("code") for c in ("as_string", "first_value", "as_double", "as_decimal")})
    e = resolve_choice(e.drop("code"), [("as_string", "cast:string"), ("first_value", "make_array"),
                                        ("as_double", "cast:double"), ("as_decimal", "cast:decimal(38,0)")])
    return e.withColumn("first_value", F.element_at("first_value", 1))


@query("choice_profile_spelled", f"""
SELECT 'code' AS "column", CASE WHEN code IS NULL THEN NULL WHEN {_PLAIN} THEN 'DOUBLE' ELSE 'STRING' END AS value_type,
       COUNT(*) AS n FROM {_SPELLED} s GROUP BY 2""")
def choice_profile_spelled(spark, sf):
    return choice_profile(spelled_events(spark, sf), ["code"])


@query("resolve_project_spelled", f"""
SELECT event_id, CAST(trim(code) AS DOUBLE) AS code FROM {_SPELLED} s WHERE code IS NULL OR {_PLAIN}""")
def resolve_project_spelled(spark, sf):
    return resolve_column(spelled_events(spark, sf), "code", "project:double")


@query("relationalize_root", f"""
SELECT doc_id, order_id, part, c_name AS "customer.name", c_mktsegment AS "customer.segment",
       total, CASE WHEN has_items THEN doc_id END AS items
FROM {SQL_DOCS} d""")
def relationalize_root(spark, sf):
    return relationalize(nested_orders(spark, sf), "orders", key="doc_id")["orders"]


@query("relationalize_items", f"SELECT * FROM {SQL_DOC_ITEMS} i")
def relationalize_items(spark, sf):
    return relationalize(nested_orders(spark, sf), "orders", key="doc_id")["orders_items"]


@query("relationalize_roundtrip", f"""
SELECT order_id, c_name AS "customer.name", i."index", i."items.product"
FROM {SQL_DOCS} d JOIN {SQL_DOC_ITEMS} i ON d.doc_id = i.id""")
def relationalize_roundtrip(spark, sf):
    """Joining the child back on the join id restores the nesting."""
    t = relationalize(nested_orders(spark, sf), "orders", key="doc_id")
    root, items = t["orders"], t["orders_items"]
    return root.join(items, root["items"] == items["id"]).select(
        "order_id", "`customer.name`", "index", "`items.product`")


@query("unbox_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def unbox_json(spark, sf):
    """JSON text column → struct, schema learned from all values."""
    e = unbox(load(spark, sf, "events").select("event_id", "props"), "props", "json")
    return e.select("event_id", F.col("props.k").alias("k"))


@query("unbox_csv", "SELECT event_id, user_id, event_type, value FROM events")
def unbox_csv(spark, sf):
    e = load(spark, sf, "events").select(
        "event_id", F.concat_ws(",", "user_id", "event_type", "value").alias("line"))
    e = unbox(e, "line", "csv", schema="user_id BIGINT, event_type STRING, value DOUBLE")
    return e.select("event_id", "line.user_id", "line.event_type", "line.value")


@query("unbox_csv_learnt", """
SELECT event_id, CAST(user_id AS BIGINT) + 3000000000 AS _c0, event_type AS _c1, value AS _c2, lpad(CAST(event_id AS VARCHAR), 9, '0') AS _c3
FROM events""")
def unbox_csv_learnt(spark, sf):
    """CSV lines without a schema: each field's type is learnt from all values;
    a quoted field holds the separator, codes with leading zeros stay text."""
    quoted = F.concat(F.lit('"'), F.concat_ws(",", "event_type", F.lit("x")), F.lit('"'))
    e = load(spark, sf, "events").select(
        "event_id", F.concat_ws(",", F.col("user_id").cast("bigint") + 3000000000, quoted,
                                F.coalesce(F.col("value").cast("decimal(18,4)").cast("string"), F.lit("")),
                                F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("line"))
    e = unbox(e, "line", "csv").select("event_id", "line.*")
    return e.withColumn("_c1", F.regexp_replace("_c1", ",x$", "")).withColumn("_c2", F.col("_c2").cast("double"))


def ddb_customers(spark, sf) -> DataFrame:
    """Customers as DynamoDB-JSON items (type-tagged attribute values)."""
    c = load(spark, sf, "customer")
    item = F.struct(
        F.struct(F.col("c_custkey").cast("string").alias("N")).alias("custkey"),
        F.struct(F.col("c_name").alias("S")).alias("name"),
        F.struct(F.col("c_acctbal").cast("string").alias("N")).alias("balance"),
        F.struct(F.struct(
            F.struct(F.col("c_mktsegment").alias("S")).alias("segment"),
            F.struct((F.col("c_acctbal") >= 5000).alias("BOOL")).alias("vip"),
        ).alias("M")).alias("info"))
    return c.select(F.to_json(item).alias("item"))


@query("unnest_ddb", """
SELECT CAST(c_custkey AS DOUBLE) AS custkey, c_name AS name, c_acctbal AS balance,
       c_mktsegment AS "info.segment", c_acctbal >= 5000 AS "info.vip" FROM customer""")
def unnest_ddb(spark, sf):
    return unnest_ddb_json(ddb_customers(spark, sf), "item", numbers="double")


def ddb_orders(spark, sf) -> DataFrame:
    """Orders as DynamoDB-JSON items: a number past 2^53, a list of maps with a
    list inside each, a number set and a list whose elements differ in tag."""
    tag = lambda t, c: F.struct(c.alias(t))
    num = lambda c: tag("N", c.cast("string"))
    li = load(spark, sf, "lineitem")
    item = lambda x: F.struct(F.struct(
        num(x["l_linenumber"]).alias("line"),
        num(x["l_quantity"].cast("decimal(18,2)")).alias("quantity"),
        tag("L", F.array(tag("S", x["l_returnflag"]), tag("S", x["l_linestatus"]))).alias("flags")).alias("M"))
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus"))).alias("lines"))
    o = load(spark, sf, "orders")
    o = o.join(lines, o.o_orderkey == lines.l_orderkey)
    big = F.col("o_orderkey").cast("decimal(38,0)") + F.lit(9007199254740993)
    mixed = F.array(F.to_json(tag("S", F.col("o_orderstatus"))), F.to_json(num(F.col("o_custkey"))))
    text = F.concat(
        F.lit('{"id":'), F.to_json(num(big)),
        F.lit(',"lines":'), F.to_json(tag("L", F.transform("lines", item))),
        F.lit(',"codes":'), F.to_json(tag("NS", F.array((F.col("o_orderkey") / 4).cast("decimal(18,2)").cast("string")))),
        F.lit(',"mixed":{"L":['), F.array_join(mixed, ","), F.lit("]}}"))
    return o.select(text.alias("item"))


@query("unnest_ddb_lists", """
WITH l AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_linenumber) AS line_sum, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
         string_agg(l_returnflag || l_linestatus, ',' ORDER BY l_linenumber, l_partkey, l_quantity, l_returnflag, l_linestatus) AS flags
  FROM lineitem GROUP BY l_orderkey)
SELECT CAST(o_orderkey AS BIGINT) + 9007199254740993 AS id, n_lines, CAST(line_sum AS BIGINT) AS line_sum, quantity, flags,
       CAST(CAST(CAST(o_orderkey AS DECIMAL(18,2)) / 4 AS DECIMAL(18,2)) AS DOUBLE) AS code, o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS cust
FROM orders JOIN l ON o_orderkey = l_orderkey""")
def unnest_ddb_lists(spark, sf):
    """Lists of maps become arrays of structs; numbers keep every digit.

    The items are written once: learning the layout, learning the numbers'
    types and reading the values are three passes over them."""
    path = scratch(spark, "ddb", "orders")
    write_frame(ddb_orders(spark, sf), path, "parquet", compression="zstd")
    i = unnest_ddb_json(read_parquet(spark, path), "item")
    total = lambda f, kind: F.aggregate(F.transform("lines", lambda x: x[f].cast(kind)), F.lit(0).cast(kind), lambda a, x: (a + x).cast(kind))
    return i.select(
        "id", F.size("lines").cast("bigint").alias("n_lines"), total("line", "bigint").alias("line_sum"),
        total("quantity", "decimal(38,2)").cast("double").alias("quantity"),
        F.array_join(F.transform("lines", lambda x: F.array_join(x["flags"], "")), ",").alias("flags"),
        F.col("codes")[0].cast("double").alias("code"), F.col("mixed")[0].alias("status"), F.col("mixed")[1].alias("cust"))


@query("explode_tags", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part""")
def explode_tags(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("tags"))
    return explode_array(p, "tags", alias="tag")


@query("map_entries", """
SELECT o_orderkey, 'priority' AS key, o_orderpriority AS value FROM orders
UNION ALL SELECT o_orderkey, 'status', o_orderstatus FROM orders""")
def map_entries(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey", F.create_map(F.lit("priority"), F.col("o_orderpriority"),
                                   F.lit("status"), F.col("o_orderstatus")).alias("meta"))
    return explode_map(o, "meta")


@query("messy_orders_clean", f"""
SELECT event_id, event_type, {_DOUBLE} AS amount FROM {_ET} e WHERE {_DOUBLE} IS NOT NULL""")
def messy_orders_clean(spark, sf):
    """Messy-orders job: text → choice column → cast:double → drop NULL
    amounts → Parquet, read back from the written folder."""
    df = resolve_choice(messy_events(spark, sf).select("event_id", "event_type", "amount"),
                        specs=[("amount", "cast:double")])
    path = scratch(spark, "messy_orders")
    write_frame(df.filter(F.col("amount").isNotNull()), path, "parquet")
    return read_parquet(spark, path)

"""Catalogued external tables: DDL, partitions, repair, crawl, catalog sink.

Each query writes a driver table into a fresh folder under the shared
checkpoint root, declares a table over it in a fresh database and reads it
through the catalog.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.plans._registry import query
from cairn.session import load, scratch, unique_name
from cairn.sinks.files import insert_into_table, write_frame
from cairn.sources.catalog import (add_partitions, catalog_sink, crawl, create_database,
                                   create_external_table, describe_table, drop_partition, repair_table,
                                   show_create_table, show_databases, show_partitions, show_tables)

_ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING, o_orderstatus STRING")
_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority",
                "o_orderstatus"]


def _db(spark, prefix: str) -> str:
    db = unique_name(prefix)
    create_database(spark, db, scratch(spark, "db", db))
    return db


@query("ext_csv_table", "SELECT * FROM customer")
def ext_csv_table(spark, sf):
    path = scratch(spark, "ext", "customer_csv")
    c = load(spark, sf, "customer")
    write_frame(c, path, "csv")
    db = _db(spark, "ext")
    return create_external_table(
        spark, f"{db}.customer", "csv", path,
        schema="c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
        options={"header": "true", "sep": ","})


@query("ext_parquet_table", "SELECT * FROM orders")
def ext_parquet_table(spark, sf):
    path = scratch(spark, "ext", "orders_parquet")
    write_frame(load(spark, sf, "orders"), path, "parquet")
    db = _db(spark, "ext")
    return create_external_table(spark, f"{db}.orders", "parquet", path)


@query("ext_json_table", "SELECT event_id, user_id, event_type, value, props FROM events")
def ext_json_table(spark, sf):
    path = scratch(spark, "ext", "events_json")
    write_frame(load(spark, sf, "events").drop("ts"), path, "json")
    db = _db(spark, "ext")
    return create_external_table(
        spark, f"{db}.events", "json", path,
        schema="event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")


def _partitioned_orders(spark, sf) -> str:
    path = scratch(spark, "ext", "orders_by_status")
    write_frame(load(spark, sf, "orders"), path, "parquet", partition_by=["o_orderstatus"])
    return path


@query("partitioned_table_pruned", f"""
SELECT {', '.join(_ORDERS_COLS)} FROM orders WHERE o_orderstatus = 'F'""")
def partitioned_table_pruned(spark, sf):
    """Filter on the partition column: only the ``o_orderstatus=F`` folder is
    scanned (``PartitionFilters`` in the plan)."""
    path = _partitioned_orders(spark, sf)
    db = _db(spark, "part")
    create_external_table(spark, f"{db}.orders", "parquet", path, schema=_ORDERS_DDL,
                          partition_by=["o_orderstatus"])
    repair_table(spark, f"{db}.orders")
    return spark.sql(f"SELECT * FROM {db}.orders WHERE o_orderstatus = 'F'")


@query("repair_partitions", """
SELECT o_orderstatus, COUNT(*) AS n, 0 AS n_before_repair FROM orders GROUP BY 1""")
def repair_partitions(spark, sf):
    """A table over existing partition folders is empty until repaired."""
    path = _partitioned_orders(spark, sf)
    db = _db(spark, "repair")
    t = f"{db}.orders"
    create_external_table(spark, t, "parquet", path, schema=_ORDERS_DDL, partition_by=["o_orderstatus"])
    before = spark.table(t).count()
    repair_table(spark, t)
    return (spark.table(t).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("n_before_repair", F.lit(before).cast("int")))


@query("add_partition", f"""
SELECT {', '.join(_ORDERS_COLS)} FROM orders WHERE o_orderstatus IS DISTINCT FROM 'P'""")
def add_partition(spark, sf):
    """Targeted ``ADD PARTITION`` of every status; a dropped partition keeps its files
    but leaves the table."""
    path = _partitioned_orders(spark, sf)
    db = _db(spark, "addpart")
    t = f"{db}.orders"
    create_external_table(spark, t, "parquet", path, schema=_ORDERS_DDL, partition_by=["o_orderstatus"])
    statuses = load(spark, sf, "orders").select("o_orderstatus").distinct().collect()  # one row per partition
    add_partitions(spark, t, [(r.asDict(), None) for r in statuses])
    drop_partition(spark, t, {"o_orderstatus": "P"})
    return spark.table(t)


@query("show_partitions", """
SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS "partition" FROM orders""")
def show_partitions_q(spark, sf):
    path = _partitioned_orders(spark, sf)
    db = _db(spark, "show")
    t = f"{db}.orders"
    create_external_table(spark, t, "parquet", path, schema=_ORDERS_DDL, partition_by=["o_orderstatus"])
    repair_table(spark, t)
    return show_partitions(spark, t)


@query("shared_location_views", """
SELECT l_orderkey, l_partkey, l_quantity, NULL AS l_extendedprice, 'quantities' AS view_name FROM lineitem
UNION ALL SELECT l_orderkey, NULL, NULL, l_extendedprice, 'prices' FROM lineitem""")
def shared_location_views(spark, sf):
    """Several by-name projections over one CSV location (contract 16:
    delimited text binds by position, so each view selects columns by name
    from one header-aware table instead of re-declaring a column subset)."""
    path = scratch(spark, "shared", "lineitem")
    write_frame(load(spark, sf, "lineitem"), path, "csv")
    db = _db(spark, "shared")
    create_external_table(spark, f"{db}.lineitem_all", "csv", path,
                          schema=load(spark, sf, "lineitem").schema, options={"header": "true"})
    spark.sql(f"CREATE OR REPLACE VIEW {db}.quantities AS "
              f"SELECT l_orderkey, l_partkey, l_quantity FROM {db}.lineitem_all")
    spark.sql(f"CREATE OR REPLACE VIEW {db}.prices AS "
              f"SELECT l_orderkey, l_extendedprice FROM {db}.lineitem_all")
    q = spark.table(f"{db}.quantities").withColumn("view_name", F.lit("quantities"))
    p = spark.table(f"{db}.prices").withColumn("view_name", F.lit("prices"))
    return q.unionByName(p, allowMissingColumns=True).select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "view_name")


@query("crawl_table", f"""
SELECT {', '.join(_ORDERS_COLS)} FROM orders""")
def crawl_table(spark, sf):
    """Crawl a folder: format from suffixes, schema and partitions inferred,
    table created (a second crawl of the same folder changes nothing)."""
    path = _partitioned_orders(spark, sf)
    db = _db(spark, "crawl")
    first = crawl(spark, f"{db}.orders", path)
    second = crawl(spark, f"{db}.orders", path)
    assert first["action"] == "created" and second["action"] == "unchanged", (first, second)
    return spark.table(f"{db}.orders").select(*_ORDERS_COLS)


@query("sink_updates_catalog", """
SELECT CAST(c_nationkey AS BIGINT) AS plan_id, c_mktsegment AS gender,
       '19' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '-01-01' AS birth_date,
       c_acctbal >= 5000 AS is_vip, n_name AS plan_desc,
       CAST(n_regionkey * 10 + 5 AS INTEGER) AS plan_price
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def sink_updates_catalog(spark, sf):
    """Subscriber job end to end: three gzip CSV sources → joins → select →
    mapping → partitioned snappy Parquet sink that creates/updates the table."""
    from cairn.plans.relational import subscriber_plans_frame, subscriber_sources
    from cairn.sources.files import read_csv
    base = scratch(spark, "subscribers")
    frames = []
    for name, df in zip(("plans", "assign", "subs"), subscriber_sources(spark, sf)):
        write_frame(df, f"{base}/{name}", "csv", compression="gzip")
        frames.append(read_csv(spark, f"{base}/{name}", recurse=True, quote='"'))
    out = subscriber_plans_frame(*frames)
    db = _db(spark, "sink")
    return catalog_sink(out, f"{db}.subscriber_plans", f"{base}/out", partition_by=["plan_id"])


@query("write_catalog_table", f"""
SELECT {', '.join(_ORDERS_COLS)} FROM orders""")
def write_catalog_table(spark, sf):
    """``insertInto`` by the table's declared column order (input columns in
    another order are re-ordered by name first)."""
    db = _db(spark, "ins")
    t = f"{db}.orders"
    path = scratch(spark, "ins", "orders")
    create_external_table(spark, t, "parquet", path, schema=_ORDERS_DDL)
    o = load(spark, sf, "orders")
    insert_into_table(o.select(*reversed(o.columns)), t)
    return spark.table(t)


@query("drop_header_rows", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
       o_orderstatus FROM orders""")
def drop_header_rows(spark, sf):
    """A table declared without header over files that have one sees the
    header line as data; ``where order_date != 'order_date'`` scrubs it."""
    path = scratch(spark, "hdr", "orders")
    o = load(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"), "o_orderstatus")
    write_frame(o, path, "csv", header=True)
    db = _db(spark, "hdr")
    t = create_external_table(spark, f"{db}.orders", "csv", path,
                              schema="o_orderkey STRING, order_date STRING, o_orderstatus STRING",
                              options={"header": "false"})
    return t.where(F.col("order_date") != "order_date")


@query("scan_catalog_table", """
SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1""")
def scan_catalog_table(spark, sf):
    """``SELECT … FROM db.table`` through the session catalog."""
    path = scratch(spark, "cat", "orders")
    write_frame(load(spark, sf, "orders"), path, "parquet")
    db = _db(spark, "cat")
    create_external_table(spark, f"{db}.orders", "parquet", path)
    return spark.sql(f"SELECT o_orderpriority, count(*) AS n FROM {db}.orders GROUP BY o_orderpriority")


@query("ext_quoted_csv_table", """
SELECT o_orderkey, 'said "' || o_orderstatus || '", then left' AS remark, o_totalprice FROM orders""")
def ext_quoted_csv_table(spark, sf):
    """An external table over quoted CSV: separators and doubled quotes inside fields."""
    path = scratch(spark, "ext", "orders_quoted")
    o = load(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit('said "'), "o_orderstatus", F.lit('", then left')).alias("remark"), "o_totalprice")
    write_frame(o, path, "csv", quoteAll=True, escape='"')
    db = _db(spark, "ext")
    return create_external_table(spark, f"{db}.orders", "csv", path, schema="o_orderkey BIGINT, remark STRING, o_totalprice DOUBLE",
                                 options={"header": "true", "quote": '"', "escape": '"'})


@query("list_and_describe", """
SELECT 'column' AS what, column_name AS name,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS detail
FROM (DESCRIBE SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus FROM orders) t(column_name, data_type, a, b, c, d)
UNION ALL SELECT 'partition column', 'o_orderstatus', 'string'
UNION ALL SELECT 'partition', 'o_orderstatus=' || o_orderstatus, NULL FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'database', 'ours', NULL UNION ALL SELECT 'table', 'orders', NULL UNION ALL SELECT 'table made again', 'orders', NULL""")
def list_and_describe(spark, sf):
    """SHOW DATABASES / TABLES / PARTITIONS / CREATE TABLE and DESCRIBE of one table."""
    from cairn.sources.catalog import drop_table
    path = _partitioned_orders(spark, sf)
    db = _db(spark, "shown")
    t = f"{db}.orders"
    create_external_table(spark, t, "parquet", path, schema=_ORDERS_DDL, partition_by=["o_orderstatus"])
    ddl = show_create_table(spark, t)
    drop_table(spark, t)
    spark.sql(ddl)  # the statement makes the same table again
    repair_table(spark, t)
    none = F.lit(None).cast("string").alias("detail")
    columns = describe_table(spark, t)
    out = columns.select(F.lit("column").alias("what"), F.col("column").alias("name"), F.col("type").alias("detail"))
    out = out.unionByName(columns.where("partition").select(F.lit("partition column").alias("what"), F.col("column").alias("name"), F.col("type").alias("detail")))
    out = out.unionByName(show_partitions(spark, t).select(F.lit("partition").alias("what"), F.col("partition").alias("name"), none))
    out = out.unionByName(show_databases(spark, db).select(F.lit("database").alias("what"), F.when(F.col("namespace") == db, "ours").alias("name"), none))
    for what in ("table", "table made again"):
        out = out.unionByName(show_tables(spark, db, "ord*").select(F.lit(what).alias("what"), F.col("tableName").alias("name"), none))
    return out


@query("sales_by_product_table", """
SELECT p_name AS product, CAST(SUM(CAST(l_extendedprice AS DECIMAL(38,2))) AS DOUBLE) AS total_sales
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name""")
def sales_by_product_table(spark, sf):
    """``SELECT product, SUM(amount) … GROUP BY product`` over a catalog table."""
    path = scratch(spark, "sales", "lines")
    li = load(spark, sf, "lineitem").select("l_partkey", "l_extendedprice")
    p = load(spark, sf, "part").select("p_partkey", "p_name")
    write_frame(li.join(p, li.l_partkey == p.p_partkey).select(F.col("p_name").alias("product"), F.col("l_extendedprice").alias("amount")), path, "parquet")
    db = _db(spark, "sales")
    create_external_table(spark, f"{db}.sales", "parquet", path)
    return spark.sql(f"""SELECT product, CAST(SUM(CAST(amount AS DECIMAL(38,2))) AS DOUBLE) AS total_sales
                         FROM {db}.sales GROUP BY product ORDER BY total_sales DESC, product""")


@query("crawl_grown", f"""
SELECT {', '.join(_ORDERS_COLS)}, CASE WHEN o_orderstatus = 'P' THEN o_orderkey % 7 END AS note FROM orders""")
def crawl_grown(spark, sf):
    """A folder that grows between crawls: first a partition more, then a column more."""
    path = scratch(spark, "crawl", "grown")
    o = load(spark, sf, "orders")
    part = lambda cond, df=o: write_frame(df.where(cond), path, "parquet", mode="append", partition_by=["o_orderstatus"])
    db = _db(spark, "crawl")
    part("o_orderstatus = 'F'")
    actions = [crawl(spark, f"{db}.orders", path)["action"]]
    part("o_orderstatus = 'O' OR o_orderstatus IS NULL")
    actions.append(crawl(spark, f"{db}.orders", path)["action"])
    part("o_orderstatus NOT IN ('F', 'O')", o.withColumn("note", F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey") % 7)))
    actions.append(crawl(spark, f"{db}.orders", path)["action"])
    if actions != ["created", "updated", "updated"]:
        raise AssertionError(actions)
    return spark.table(f"{db}.orders").select(*_ORDERS_COLS, "note")


@query("sink_grows_catalog", """
SELECT o_orderkey, o_totalprice, o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority FROM orders""")
def sink_grows_catalog(spark, sf):
    """The catalog sink twice: the second write brings partitions and a column."""
    path = scratch(spark, "sink", "grown")
    db = _db(spark, "sink")
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.col("o_orderpriority").alias("priority"))
    even = F.col("o_orderkey") % 2 == 0
    catalog_sink(o.where(even).drop("priority"), f"{db}.orders", path, partition_by=["o_orderstatus"])
    t = catalog_sink(o.where(~even), f"{db}.orders", path, partition_by=["o_orderstatus"])
    return t.select("o_orderkey", "o_totalprice", "o_orderstatus", "priority")

"""Sources and sinks checked by round trips: the driver tables are written in
the source format into a fresh folder under the shared checkpoint root, then
read back with the operator under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.plans._registry import query
from cairn.plans.standins import SQL_DOC_ITEMS, SQL_DOCS, events_text
from cairn.session import load, scratch
from cairn.sinks.files import convert_format, land_by_date, write_frame
from cairn.sources.listing import list_tree
from cairn.sources.files import (Source, audit_empty_files, read_csv, read_json, read_orc,
                                 read_parquet)

_CUSTOMER_SQL = "SELECT * FROM customer"
_CUSTOMER_TEXT_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
  CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
  c_mktsegment FROM customer"""


def _customer_csv(spark, sf, **kw) -> str:
    path = scratch(spark, "csv", "customer")
    write_frame(load(spark, sf, "customer"), path, "csv", **kw)
    return path


@query("scan_csv_strings", _CUSTOMER_TEXT_SQL)
def scan_csv_strings(spark, sf):
    """Header, no inference: every column is text."""
    return read_csv(spark, _customer_csv(spark, sf))


@query("scan_csv_inferred", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def scan_csv_inferred(spark, sf):
    return read_csv(spark, _customer_csv(spark, sf), infer=True)


CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])


@query("scan_csv_schema", _CUSTOMER_SQL)
def scan_csv_schema(spark, sf):
    return read_csv(spark, _customer_csv(spark, sf), schema=CUSTOMER_SCHEMA)


@query("scan_csv_gz", _CUSTOMER_SQL)
def scan_csv_gz(spark, sf):
    """Gzip CSV, '|' separator, single-quote quoting, nested folders (recurse)."""
    path = scratch(spark, "csvgz", "customer")
    c = load(spark, sf, "customer")
    write_frame(c, f"{path}/by_segment", "csv", partition_by=["c_mktsegment"], compression="gzip",
                sep="|", quote="'")
    df = read_csv(spark, path, schema=T.StructType(CUSTOMER_SCHEMA.fields[:4]), sep="|",
                  quote="'", recurse=True, glob="*.csv.gz")
    # with recursive lookup the partition folder is not a column: recover it
    seg = F.regexp_extract(F.col("_metadata.file_path"), r"c_mktsegment=([^/]+)/", 1)
    return df.select("*", seg.alias("c_mktsegment"))


def _events_amount_csv(spark, sf) -> str:
    path = scratch(spark, "csv", "events_amount")
    write_frame(events_text(spark, sf).select("event_id", "event_type", "amount"), path, "csv")
    return path


_AMOUNT_SCHEMA = "event_id BIGINT, event_type STRING, amount DOUBLE"


@query("scan_permissive", """
SELECT event_id, event_type, TRY_CAST(amount AS DOUBLE) AS amount FROM (SELECT event_id,
  event_type, CASE WHEN event_type = 'error' THEN 'N/A' WHEN event_type = 'view' THEN NULL
  ELSE CAST(value AS VARCHAR) END AS amount FROM events)""")
def scan_permissive(spark, sf):
    """PERMISSIVE: an unparseable field becomes NULL, the row stays."""
    return read_csv(spark, _events_amount_csv(spark, sf), schema=_AMOUNT_SCHEMA, mode="PERMISSIVE")


@query("scan_dropmalformed", """
SELECT event_id, event_type, CAST(value AS DOUBLE) AS amount FROM events
WHERE event_type <> 'error' AND event_type <> 'view'
UNION ALL SELECT event_id, event_type, NULL FROM events WHERE event_type = 'view'""")
def scan_dropmalformed(spark, sf):
    """DROPMALFORMED: rows with 'N/A' under a DOUBLE column are dropped
    (an empty field is NULL, not malformed)."""
    return read_csv(spark, _events_amount_csv(spark, sf), schema=_AMOUNT_SCHEMA,
                    mode="DROPMALFORMED")


@query("scan_csv_quoted", """
SELECT c_custkey AS customer_id, c_name AS customer_name,
       c_mktsegment || ', nation ' || CAST(c_nationkey AS VARCHAR) AS address, c_acctbal AS amount
FROM customer""")
def scan_csv_quoted(spark, sf):
    """Fields with commas inside double quotes stay one field."""
    c = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.concat_ws(", nation ", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("address"),
        F.col("c_acctbal").alias("amount"))
    path = scratch(spark, "csv", "quoted")
    write_frame(c, path, "csv", quoteAll=True)
    return read_csv(spark, path, schema="customer_id BIGINT, customer_name STRING, "
                                        "address STRING, amount DOUBLE")


@query("scan_json_nested", f"""
SELECT d.doc_id, order_id, c_name AS customer_name, n_items, first_product
FROM {SQL_DOCS} d LEFT JOIN (SELECT id, COUNT(*) AS n_items,
        MAX(CASE WHEN "index" = 0 THEN "items.product" END) AS first_product
     FROM {SQL_DOC_ITEMS} GROUP BY id) i ON d.doc_id = i.id""")
def scan_json_nested(spark, sf):
    """JSON lines with a struct and an array of structs, read back.

    The lines are compressed: as plain text they were most of what the job
    wrote. A gzip file is read by one task, so a file holds at most a million."""
    from cairn.plans.standins import nested_orders
    path = scratch(spark, "json", "orders")
    docs = nested_orders(spark, sf)
    write_frame(docs, path, "json", compression="gzip", max_records_per_file=1_000_000)
    df = read_json(spark, path, schema=docs.schema)
    return df.select("doc_id", "order_id", F.col("customer.name").alias("customer_name"),
                     F.size("items").alias("n_items"),
                     F.col("items")[0]["product"].alias("first_product"))


@query("scan_orc", "SELECT * FROM orders")
def scan_orc(spark, sf):
    path = scratch(spark, "orc", "orders")
    write_frame(load(spark, sf, "orders"), path, "orc")
    return read_orc(spark, path)


@query("scan_prefix_growth", """
SELECT 'before' AS phase, o_orderstatus, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 2
UNION ALL SELECT 'after', o_orderstatus, COUNT(*) FROM orders GROUP BY 2""")
def scan_prefix_growth(spark, sf):
    """New files under a table's prefix show up without DDL (after a refresh
    of the cached listing)."""
    from cairn.sources.catalog import create_database, create_external_table, refresh
    from cairn.session import unique_name
    o = load(spark, sf, "orders")
    path = scratch(spark, "growth", "orders")
    write_frame(o.filter("o_orderstatus = 'F'"), path, "parquet", mode="append")
    db = unique_name("growth")
    create_database(spark, db)
    t = create_external_table(spark, f"{db}.orders", "parquet", path, schema=o.schema)
    before = (t.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("phase", F.lit("before")))
    # state at this moment: one row per status value
    before = spark.createDataFrame(before.collect(), before.schema)
    write_frame(o.filter(~F.col("o_orderstatus").eqNullSafe("F")), path, "parquet", mode="append")
    refresh(spark, f"{db}.orders")
    after = (spark.table(f"{db}.orders").groupBy("o_orderstatus")
             .agg(F.count(F.lit(1)).alias("n")).withColumn("phase", F.lit("after")))
    return before.unionByName(after).select("phase", "o_orderstatus", "n")


@query("scan_suffix_filter", "SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def scan_suffix_filter(spark, sf):
    """Only ``*.csv`` keys under the prefix are read; other files beside them are not."""
    o = load(spark, sf, "orders")
    path = scratch(spark, "suffix", "raw")
    write_frame(o.filter("o_orderstatus <> 'P'"), f"{path}/orders", "csv")
    write_frame(o.filter("o_orderstatus = 'P'"), f"{path}/orders_json", "json")
    return read_csv(spark, path, schema=o.schema, recurse=True, glob="*.csv")


@query("scan_generic_source", "SELECT * FROM supplier")
def scan_generic_source(spark, sf):
    """``Source(...).format(fmt, **options).frame(path)`` builder."""
    path = scratch(spark, "generic", "supplier")
    s = load(spark, sf, "supplier")
    write_frame(s, path, "csv", sep=";")
    return Source(spark).format("csv", header=True, sep=";").schema(s.schema).frame(path)


@query("audit_empty_files", """
SELECT 'full/o_orderstatus=' || o_orderstatus AS folder, FALSE AS has_empty, TRUE AS has_full FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'empty', TRUE, FALSE""")
def audit_empty_files_q(spark, sf):
    """Zero-length objects under a prefix (CSV parts of empty partitions), per folder."""
    path = scratch(spark, "audit", "orders")
    o = load(spark, sf, "orders")
    write_frame(o, f"{path}/full", "csv", header=False, partition_by=["o_orderstatus"])
    write_frame(o.filter(F.lit(False)), f"{path}/empty", "csv", header=False)
    folder = F.regexp_extract("path", r"/orders/[^/]+/(.*)/[^/]+$", 1).alias("folder")
    files = list_tree(spark, path, glob="*.csv").select(folder, "length")
    empty = audit_empty_files(spark, path, glob="*.csv").select(folder.alias("e")).distinct()
    return (files.groupBy("folder").agg(F.max("length").alias("most")).join(empty, F.col("folder") == F.col("e"), "left")
            .select("folder", F.col("e").isNotNull().alias("has_empty"), (F.col("most") > 0).alias("has_full")))


# -- sinks --------------------------------------------------------------

@query("sink_csv_roundtrip", "SELECT * FROM orders")
def sink_csv_roundtrip(spark, sf):
    o = load(spark, sf, "orders")
    path = scratch(spark, "sink", "csv")
    write_frame(o, path, "csv", mode="overwrite")
    return read_csv(spark, path, schema=o.schema)


@query("sink_parquet_roundtrip", "SELECT * FROM lineitem")
def sink_parquet_roundtrip(spark, sf):
    path = scratch(spark, "sink", "parquet")
    write_frame(load(spark, sf, "lineitem"), path, "parquet", compression="snappy")
    return read_parquet(spark, path)


@query("sink_append", "SELECT * FROM orders")
def sink_append(spark, sf):
    o = load(spark, sf, "orders")
    path = scratch(spark, "sink", "append")
    write_frame(o.filter("o_orderstatus = 'F'"), path, "parquet", mode="append")
    write_frame(o.filter("o_orderstatus <> 'F' OR o_orderstatus IS NULL"), path, "parquet", mode="append")
    return read_parquet(spark, path)


@query("sink_partitioned", "SELECT * FROM orders")
def sink_partitioned(spark, sf):
    o = load(spark, sf, "orders")
    path = scratch(spark, "sink", "partitioned")
    write_frame(o, path, "parquet", partition_by=["o_orderstatus"])
    return read_parquet(spark, path).select(*o.columns)


@query("sink_dynamic_overwrite", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END
  AS o_totalprice, o_orderdate, o_orderpriority, o_orderstatus FROM orders""")
def sink_dynamic_overwrite(spark, sf):
    """Re-writing one partition with dynamic overwrite leaves the others."""
    o = load(spark, sf, "orders")
    path = scratch(spark, "sink", "dynamic")
    write_frame(o, path, "parquet", partition_by=["o_orderstatus"])
    fix = o.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    write_frame(fix, path, "parquet", mode="overwrite", partition_by=["o_orderstatus"], dynamic=True)
    return read_parquet(spark, path)


@query("convert_to_orc", """
SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def convert_to_orc(spark, sf):
    """JSON lines → ORC (row format to columnar), then read the ORC."""
    e = load(spark, sf, "events")
    src = scratch(spark, "convert", "json")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    write_frame(e, src, "json", timestampNTZFormat=micros)
    dest = scratch(spark, "convert", "orc")
    convert_format(spark, src, "json", dest, "orc",
                   read_options={"timestampNTZFormat": micros, "prefersDecimal": "false"})
    return read_orc(spark, dest).select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type",
        "value", "props")


@query("land_by_date", """
SELECT event_id, event_type, 'events' AS prefix, strftime(ts, '%Y') AS year,
       strftime(ts, '%m') AS month, strftime(ts, '%d') AS day FROM events""")
def land_by_date_q(spark, sf):
    """Files of ``raw/events/`` land under ``prefix=events/year=/month=/day=``."""
    e = load(spark, sf, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"))
    base = scratch(spark, "landing")
    write_frame(e, f"{base}/raw/events", "csv")
    dest = f"{base}/curated"
    land_by_date(spark, f"{base}/raw", dest, glob="*.csv", ts_col="event_time")
    schema = ("event_id BIGINT, event_type STRING, event_time STRING, prefix STRING, "
              "year STRING, month STRING, day STRING")
    back = spark.read.option("header", True).option("basePath", dest).schema(schema).csv(dest)
    return back.select("event_id", "event_type", "prefix", "year", "month", "day")

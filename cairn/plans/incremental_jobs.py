"""Incremental loads (bookmarks), streaming ETL, and the data-engineering
jobs from the course outline: quality, schema evolution, SCD 1/2/3,
idempotent re-runs, medallion layers, multi-day backfill."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.money import cents_bigint, exact_sum, sum_2dp
from cairn.incremental.bookmark import Bookmark
from cairn.operators import quality as Q
from cairn.operators.scd import scd1, scd2, scd3
from cairn.plans._registry import query
from cairn.plans.relational import SQL_STAGE, customer_stage
from cairn.session import load, scratch
from cairn.sinks.files import write_frame
from cairn.sources.files import read_parquet
from cairn.streaming.etl import enrich_stream, run_stream_to_files, stream_files

# The event batches are cut at this instant (mid-January).
CUT = "2024-01-16 00:00:00"
_EV_COLS = "event_id, ts, user_id, event_type, value, props"


def _events_batches(spark, sf, base: str) -> tuple[DataFrame, DataFrame]:
    e = load(spark, sf, "events")
    cut = F.lit(CUT).cast("timestamp_ntz")
    return e.filter(F.col("ts") < cut), e.filter((F.col("ts") >= cut) | F.col("ts").isNull())


def _land(df: DataFrame, path: str) -> None:
    write_frame(df, path, "parquet", mode="overwrite")


def _bookmark_setup(spark, sf):
    base = scratch(spark, "bookmark")
    src, state = f"{base}/source", f"{base}/state"
    a, b = _events_batches(spark, sf, base)
    return base, src, state, a, b, load(spark, sf, "events").schema


def _run(spark, src, state, schema, mode="enable", commit=True) -> DataFrame:
    bm = Bookmark(spark, state, job="events_load", mode=mode)
    delta = bm.read_new(src, "parquet", schema, glob="*.parquet")
    # the "sink" of a real job: the delta is written once, so the returned
    # rows are those this run saw, whatever later runs change
    rows = _materialise(spark, delta)
    if commit:
        bm.commit()
    return rows


def _materialise(spark, df: DataFrame) -> DataFrame:
    """Write the run's output into the shared folder and read it back (a sink)."""
    path = scratch(spark, "bookmark_out")
    write_frame(df, path, "parquet")
    return read_parquet(spark, path)


@query("bookmark_second_run", f"SELECT {_EV_COLS} FROM events WHERE ts >= TIMESTAMP '{CUT}' OR ts IS NULL")
def bookmark_second_run(spark, sf):
    """Run 1 reads January's first half and commits; run 2 sees only the new file."""
    base, src, state, a, b, schema = _bookmark_setup(spark, sf)
    _land(a, f"{src}/batch1")
    _run(spark, src, state, schema)
    _land(b, f"{src}/batch2")
    return _run(spark, src, state, schema)


@query("bookmark_uncommitted_rerun", f"SELECT {_EV_COLS} FROM events WHERE ts < TIMESTAMP '{CUT}'")
def bookmark_uncommitted_rerun(spark, sf):
    """A run that does not commit leaves the state: the next run reads the same delta."""
    base, src, state, a, b, schema = _bookmark_setup(spark, sf)
    _land(a, f"{src}/batch1")
    _run(spark, src, state, schema, commit=False)
    return _run(spark, src, state, schema)


@query("bookmark_third_run", f"SELECT {_EV_COLS} FROM events WHERE FALSE")
def bookmark_third_run(spark, sf):
    """No new file: the run finishes quietly with an empty frame of the source schema."""
    base, src, state, a, b, schema = _bookmark_setup(spark, sf)
    _land(a, f"{src}/batch1")
    _run(spark, src, state, schema)
    _land(b, f"{src}/batch2")
    _run(spark, src, state, schema)
    return _run(spark, src, state, schema)


@query("bookmark_disabled", f"SELECT {_EV_COLS} FROM events")
def bookmark_disabled(spark, sf):
    """Disabled: all data every run, no tracking."""
    base, src, state, a, b, schema = _bookmark_setup(spark, sf)
    _land(a, f"{src}/batch1")
    _run(spark, src, state, schema)
    _land(b, f"{src}/batch2")
    return _run(spark, src, state, schema, mode="disable")


@query("bookmark_paused", f"""
SELECT 'paused' AS run, {_EV_COLS} FROM events
UNION ALL SELECT 'next', {_EV_COLS} FROM events WHERE ts >= TIMESTAMP '{CUT}' OR ts IS NULL""")
def bookmark_paused(spark, sf):
    """Paused: reads all data and leaves the state; the next enabled run
    still sees only what was never committed."""
    base, src, state, a, b, schema = _bookmark_setup(spark, sf)
    _land(a, f"{src}/batch1")
    _run(spark, src, state, schema)
    _land(b, f"{src}/batch2")
    paused = _run(spark, src, state, schema, mode="pause")
    nxt = _run(spark, src, state, schema)
    return (paused.select(F.lit("paused").alias("run"), "*")
            .unionByName(nxt.select(F.lit("next").alias("run"), "*")))


@query("bookmark_reset", f"SELECT {_EV_COLS} FROM events")
def bookmark_reset(spark, sf):
    """After a reset the next run reads everything again."""
    base, src, state, a, b, schema = _bookmark_setup(spark, sf)
    _land(a, f"{src}/batch1")
    _run(spark, src, state, schema)
    _land(b, f"{src}/batch2")
    _run(spark, src, state, schema)
    Bookmark(spark, state, job="events_load").reset()
    return _run(spark, src, state, schema)


@query("bookmark_state", f"""
SELECT DISTINCT 'events_load' AS job, 'file' AS kind,
       CASE WHEN ts >= TIMESTAMP '{CUT}' OR ts IS NULL THEN 'batch2' ELSE 'batch1' END AS batch FROM events""")
def bookmark_state(spark, sf):
    """What the bookmark holds after two committed runs: files of both batches."""
    base, src, state, a, b, schema = _bookmark_setup(spark, sf)
    _land(a, f"{src}/batch1")
    _run(spark, src, state, schema)
    _land(b, f"{src}/batch2")
    _run(spark, src, state, schema)
    return (Bookmark(spark, state, job="events_load").state()
            .select("job", "kind", F.regexp_extract("path", r"/(batch\d)/", 1).alias("batch")).distinct())


@query("bookmark_by_key", """
SELECT * FROM orders WHERE o_orderkey > (SELECT MAX(o_orderkey) FROM orders
   WHERE o_orderkey <= (SELECT MAX(o_orderkey) // 2 FROM orders))""")
def bookmark_by_key(spark, sf):
    """Table source: a key high-water mark; run 2 reads keys above run 1's max."""
    o = load(spark, sf, "orders")
    half = o.agg((F.max("o_orderkey") / 2).cast("bigint").alias("h")).first().h
    base = scratch(spark, "bookmark_key")
    src, state = f"{base}/orders", f"{base}/state"
    write_frame(o.filter(F.col("o_orderkey") <= half), src, "parquet", mode="append")
    bm = Bookmark(spark, state, job="orders_load")
    _materialise(spark, bm.read_by_key(read_parquet(spark, src), "orders", "o_orderkey"))
    bm.commit()
    write_frame(o.filter(F.col("o_orderkey") > half), src, "parquet", mode="append")
    bm2 = Bookmark(spark, state, job="orders_load")
    out = _materialise(spark, bm2.read_by_key(read_parquet(spark, src), "orders", "o_orderkey"))
    bm2.commit()
    return out


@query("bookmark_key_paused", """
SELECT 'paused' AS run, * FROM orders
UNION ALL SELECT 'next', * FROM orders WHERE o_orderkey > (SELECT MAX(o_orderkey) FROM orders
   WHERE o_orderkey <= (SELECT MAX(o_orderkey) // 2 FROM orders))""")
def bookmark_key_paused(spark, sf):
    """Paused key bookmark: all rows, mark unchanged; the next enabled run
    reads what lies above the mark."""
    o = load(spark, sf, "orders")
    half = o.agg((F.max("o_orderkey") / 2).cast("bigint").alias("h")).first().h
    base = scratch(spark, "bookmark_key_paused")
    src, state = f"{base}/orders", f"{base}/state"
    low = F.coalesce(F.col("o_orderkey") <= half, F.lit(False))

    def run(mode):
        bm = Bookmark(spark, state, job="orders_load", mode=mode)
        rows = _materialise(spark, bm.read_by_key(read_parquet(spark, src), "orders", "o_orderkey"))
        bm.commit()
        return rows

    write_frame(o.filter(low), src, "parquet", mode="append")
    run("enable")
    write_frame(o.filter(~low), src, "parquet", mode="append")
    paused = run("pause")
    return (paused.select(F.lit("paused").alias("run"), "*")
            .unionByName(run("enable").select(F.lit("next").alias("run"), "*")))


# -- streaming ----------------------------------------------------------

def _stream_source(spark, sf) -> tuple[str, object]:
    base = scratch(spark, "stream")
    a, b = _events_batches(spark, sf, base)
    _land(a, f"{base}/in/batch1")
    _land(b, f"{base}/in/batch2")
    return base, load(spark, sf, "events").schema


@query("stream_etl", f"""
SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS event_date
FROM events WHERE event_type <> 'error'""")
def stream_etl(spark, sf):
    """File stream → drop error events, add the date → Parquet files (checkpointed)."""
    base, schema = _stream_source(spark, sf)
    s = stream_files(spark, f"{base}/in", "parquet", schema, max_files_per_trigger=4,
                     recursiveFileLookup="true")

    def transform(df):
        return (df.filter(F.col("event_type") != "error")
                .select("event_id", "ts", "user_id", "event_type", "value",
                        F.col("ts").cast("date").alias("event_date")))

    run_stream_to_files(s, transform, f"{base}/out", f"{base}/checkpoint")
    return read_parquet(spark, f"{base}/out")


@query("stream_enrich", """
SELECT event_id, user_id, event_type, c_name, c_mktsegment
FROM events LEFT JOIN customer ON user_id = c_custkey""")
def stream_enrich(spark, sf):
    """Stream–static join: each event gets its customer's name and segment."""
    base, schema = _stream_source(spark, sf)
    s = stream_files(spark, f"{base}/in", "parquet", schema, recursiveFileLookup="true")
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")

    def transform(df):
        return enrich_stream(df, c, "user_id", "c_custkey").select(
            "event_id", "user_id", "event_type", "c_name", "c_mktsegment")

    run_stream_to_files(s, transform, f"{base}/out", f"{base}/checkpoint")
    return read_parquet(spark, f"{base}/out")


# -- quality ------------------------------------------------------------

# The order rules checked by the quality queries.
ORDER_RULES = [
    Q.not_null("o_orderdate"),
    Q.in_range("o_totalprice", 1000, 400000),
    Q.in_set("o_orderstatus", ["F", "O"]),
    Q.unique("o_orderkey"),
    Q.unique("o_custkey", "o_orderdate"),
]


@query("quality_report", """
SELECT 'not_null(o_orderdate)' AS rule, COUNT(*) AS n_checked,
       COUNT(*) FILTER (WHERE o_orderdate IS NULL) AS n_failed FROM orders
UNION ALL SELECT 'range(o_totalprice)', COUNT(*),
       COUNT(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000) FROM orders
UNION ALL SELECT 'in_set(o_orderstatus)', COUNT(*),
       COUNT(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders
UNION ALL SELECT 'unique(o_orderkey)', (SELECT COUNT(*) FROM orders),
       COALESCE((SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM orders GROUP BY o_orderkey
                                     HAVING COUNT(*) > 1)), 0)
UNION ALL SELECT 'unique(o_custkey,o_orderdate)', (SELECT COUNT(*) FROM orders),
       COALESCE((SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM orders GROUP BY o_custkey, o_orderdate
                                     HAVING COUNT(*) > 1)), 0)""")
def quality_report_q(spark, sf):
    return Q.quality_report(load(spark, sf, "orders"), ORDER_RULES).drop("passed")


@query("quality_quarantine", """
SELECT o.*, concat_ws(';',
   CASE WHEN o_orderdate IS NULL THEN 'not_null(o_orderdate)' END,
   CASE WHEN o_totalprice < 1000 OR o_totalprice > 400000 THEN 'range(o_totalprice)' END,
   CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'in_set(o_orderstatus)' END,
   CASE WHEN d1.k IS NOT NULL THEN 'unique(o_orderkey)' END,
   CASE WHEN d2.c IS NOT NULL THEN 'unique(o_custkey,o_orderdate)' END) AS failed_rules
FROM orders o
LEFT JOIN (SELECT o_orderkey AS k FROM orders GROUP BY 1 HAVING COUNT(*) > 1) d1 ON o.o_orderkey = d1.k
LEFT JOIN (SELECT o_custkey AS c, o_orderdate AS d FROM orders GROUP BY 1, 2 HAVING COUNT(*) > 1) d2
  ON o.o_custkey = d2.c AND o.o_orderdate = d2.d
WHERE o_orderdate IS NULL OR o_totalprice < 1000 OR o_totalprice > 400000
   OR o_orderstatus NOT IN ('F', 'O') OR d1.k IS NOT NULL OR d2.c IS NOT NULL""")
def quality_quarantine(spark, sf):
    return Q.quarantine(load(spark, sf, "orders"), ORDER_RULES)[1]


# -- schema evolution ---------------------------------------------------

@query("schema_evolution_union", """
SELECT o_orderkey, o_custkey, o_totalprice, NULL::VARCHAR AS o_orderpriority,
       o_orderstatus FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_custkey, NULL, o_orderpriority, o_orderstatus
FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'""")
def schema_evolution_union(spark, sf):
    """Files written with different columns read as one table (``mergeSchema``)."""
    from cairn.operators.evolution import schema_diff
    o = load(spark, sf, "orders")
    base = scratch(spark, "evolution")
    v1 = o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    v2 = o.filter(~F.col("o_orderstatus").eqNullSafe("F")).select("o_orderkey", "o_custkey", "o_orderpriority",
                                                 "o_orderstatus")
    write_frame(v1, f"{base}/v1", "parquet")
    write_frame(v2, f"{base}/v2", "parquet")
    diff = schema_diff(v1.schema, v2.schema)
    assert diff["added"] == ["o_orderpriority"] and diff["removed"] == ["o_totalprice"], diff
    return read_parquet(spark, [f"{base}/v1", f"{base}/v2"], merge_schema=True).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")


# -- slowly changing dimensions -----------------------------------------

@query("scd1", f"""
SELECT * FROM customer t WHERE NOT EXISTS (SELECT 1 FROM {SQL_STAGE} s WHERE s.c_custkey = t.c_custkey)
UNION ALL SELECT * FROM {SQL_STAGE}""")
def scd1_q(spark, sf):
    return scd1(load(spark, sf, "customer"), customer_stage(spark, sf), ["c_custkey"])


_START, _EFF = "2024-01-01", "2024-02-01"


@query("scd2", f"""
WITH s AS {SQL_STAGE},
chg AS (SELECT t.c_custkey FROM customer t JOIN s ON t.c_custkey = s.c_custkey
        WHERE t.c_acctbal IS DISTINCT FROM s.c_acctbal OR t.c_mktsegment IS DISTINCT FROM s.c_mktsegment)
SELECT c_custkey, c_acctbal, c_mktsegment, DATE '{_START}' AS valid_from,
       CASE WHEN c_custkey IN (SELECT c_custkey FROM chg) THEN DATE '{_EFF}' END AS valid_to,
       c_custkey NOT IN (SELECT c_custkey FROM chg) AS is_current
FROM customer
UNION ALL
SELECT c_custkey, c_acctbal, c_mktsegment, DATE '{_EFF}', NULL, TRUE FROM s
WHERE c_custkey IN (SELECT c_custkey FROM chg)
   OR c_custkey NOT IN (SELECT c_custkey FROM customer)""")
def scd2_q(spark, sf):
    """History with validity ranges: changed balances close the old version."""
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    hist = c.select("*", F.lit(_START).cast("date").alias("valid_from"),
                    F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    return scd2(hist, customer_stage(spark, sf), ["c_custkey"], ["c_acctbal", "c_mktsegment"], _EFF)


@query("scd3", f"""
SELECT c_custkey, c_name, c_acctbal, NULL::DOUBLE AS prev_c_acctbal
FROM customer t WHERE NOT EXISTS (SELECT 1 FROM {SQL_STAGE} s WHERE s.c_custkey = t.c_custkey)
UNION ALL
SELECT s.c_custkey, s.c_name, s.c_acctbal,
       CASE WHEN t.c_acctbal IS DISTINCT FROM s.c_acctbal THEN t.c_acctbal END
FROM {SQL_STAGE} s LEFT JOIN customer t ON t.c_custkey = s.c_custkey""")
def scd3_q(spark, sf):
    """Current balance plus the balance it replaced."""
    t = load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    s = customer_stage(spark, sf).select("c_custkey", "c_name", "c_acctbal")
    return scd3(t, s, ["c_custkey"], "c_acctbal")


# -- idempotent re-run, medallion, backfill ----------------------------

@query("idempotent_rerun", """
SELECT o_orderkey, o_totalprice, o_orderstatus, strftime(o_orderdate, '%Y-%m') AS run_month
FROM orders""")
def idempotent_rerun(spark, sf):
    """Each monthly run overwrites only its own ``run_month`` partition, so
    running the same months again (here: every month twice, the second time
    in one job) leaves exactly one copy."""
    o = load(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus",
        F.date_format("o_orderdate", "yyyy-MM").alias("run_month"))
    path = scratch(spark, "idempotent")
    write_frame(o, path, "parquet", partition_by=["run_month"])
    write_frame(o, path, "parquet", mode="overwrite", partition_by=["run_month"], dynamic=True)
    return spark.read.option("basePath", path).schema(o.schema).parquet(path).select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "run_month")


@query("medallion_gold", """
SELECT o_orderstatus AS status, YEAR(o_orderdate) AS order_year, COUNT(DISTINCT o_orderkey) AS n_orders,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(38,2)) * (1 - CAST(l_discount AS DECIMAL(38,2))))
            AS DOUBLE) AS net_revenue
FROM (SELECT DISTINCT * FROM lineitem) l JOIN orders ON l_orderkey = o_orderkey
GROUP BY 1, 2""")
def medallion_gold(spark, sf):
    """raw (text CSV) → bronze (as read, plus ingestion columns) → silver
    (typed, exact duplicates removed) → gold (net revenue per status and year)."""
    base = scratch(spark, "medallion")
    li, o = load(spark, sf, "lineitem"), load(spark, sf, "orders")
    write_frame(li, f"{base}/raw/lineitem", "csv")
    write_frame(o, f"{base}/raw/orders", "csv")
    for name in ("lineitem", "orders"):
        raw = spark.read.option("header", True).csv(f"{base}/raw/{name}")
        bronze = raw.select("*", F.col("_metadata.file_path").alias("_source_file"))
        write_frame(bronze, f"{base}/bronze/{name}", "parquet")
    from cairn.operators.shape import with_frame_schema
    s_li = (with_frame_schema(read_parquet(spark, f"{base}/bronze/lineitem"), li.schema)
            .dropDuplicates())
    s_o = with_frame_schema(read_parquet(spark, f"{base}/bronze/orders"), o.schema)
    write_frame(s_li, f"{base}/silver/lineitem", "parquet")
    write_frame(s_o, f"{base}/silver/orders", "parquet")
    sl, so = read_parquet(spark, f"{base}/silver/lineitem"), read_parquet(spark, f"{base}/silver/orders")
    # net revenue per order first (exact units of 1/10,000, map-side partial
    # sums), so the join and the count see one row per order instead instead of every line; summing per-order values over the joined
    # rows gives the same total as summing the lines
    units = cents_bigint("l_extendedprice") * (F.lit(100) - cents_bigint("l_discount"))
    per_order = sl.groupBy("l_orderkey").agg(exact_sum(units).alias("net_units"))
    gold = (per_order.join(so, per_order.l_orderkey == so.o_orderkey)
            .groupBy(F.col("o_orderstatus").alias("status"),
                     F.year("o_orderdate").alias("order_year"))
            .agg(F.count("o_orderkey").alias("n_orders"),
                 (F.sum("net_units") * F.lit(Decimal("0.0001"))).cast("double")
                 .alias("net_revenue")))
    write_frame(gold, f"{base}/gold/revenue", "parquet")
    return read_parquet(spark, f"{base}/gold/revenue")


@query("backfill_days", """
SELECT CAST(ts AS DATE) AS event_date, event_type, COUNT(*) AS n_events,
       CAST(SUM(CAST(value AS DECIMAL(38,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2""")
def backfill_days(spark, sf):
    """All days in one run (instead of one job run per day): the day is a
    column, the aggregate is computed once, and the write lands one partition
    per day."""
    e = load(spark, sf, "events")
    daily = (e.groupBy(F.col("ts").cast("date").alias("event_date"), "event_type")
             .agg(F.count(F.lit(1)).alias("n_events"),
                  sum_2dp("value", scale=2).alias("total_value")))
    path = scratch(spark, "backfill")
    write_frame(daily, path, "parquet", partition_by=["event_date"])
    return read_parquet(spark, path).select(
        F.col("event_date").cast("date").alias("event_date"), "event_type", "n_events", "total_value")

"""Bookmarks (run counts 200/100/0, reset, rewrite), landing paths, catalog
side effects, sinks and streaming."""

import os
import time

import pytest
from pyspark.sql import functions as F

from cairn.incremental.bookmark import Bookmark
from cairn.sinks.files import land_by_date, write_frame, write_single_file
from cairn.sources.catalog import (create_database, create_external_table, drop_partition,
                                   drop_table, repair_table, show_partitions)
from cairn.session import path_exists, unique_name

SCHEMA = "order_id bigint, amount double"


def _month(spark, path, start, n):
    write_frame(spark.range(start, start + n).select(F.col("id").alias("order_id"),
                                                     (F.col("id") * 1.5).alias("amount")),
                path, "parquet")


def _local(p):
    return p.replace("file:", "")


def test_bookmark_runs_200_100_0(spark, tmp):
    src, state = f"{tmp}/src", f"{tmp}/state"
    _month(spark, f"{src}/jan", 0, 100)
    _month(spark, f"{src}/feb", 100, 100)
    counts = []
    for month in (None, "mar", None):
        if month:
            _month(spark, f"{src}/{month}", 200, 100)
        bm = Bookmark(spark, state, "orders_job")
        counts.append(bm.read_new(src, "parquet", SCHEMA, glob="*.parquet").count())
        bm.commit()
    assert counts == [200, 100, 0]
    # reset: the next run reads all three months again
    Bookmark(spark, state, "orders_job").reset()
    assert Bookmark(spark, state, "orders_job").read_new(src, "parquet", SCHEMA, glob="*.parquet").count() == 300


def test_bookmark_modes_and_rewritten_file(spark, tmp):
    src, state = f"{tmp}/src", f"{tmp}/state"
    _month(spark, f"{src}/jan", 0, 10)
    bm = Bookmark(spark, state, "j")
    bm.read_new(src, "parquet", SCHEMA, glob="*.parquet")
    bm.commit()
    before = Bookmark(spark, state, "j").state().count()
    for mode in ("pause", "disable"):
        b = Bookmark(spark, state, "j", mode=mode)
        assert b.read_new(src, "parquet", SCHEMA, glob="*.parquet").count() == 10
        b.commit()
    assert Bookmark(spark, state, "j").state().count() == before
    time.sleep(1.1)
    _month(spark, f"{src}/jan", 0, 12)  # rewritten: new mtime/length → read again
    assert Bookmark(spark, state, "j").read_new(src, "parquet", SCHEMA, glob="*.parquet").count() == 12


def test_landing_paths(spark, tmp):
    raw = f"{tmp}/raw/orders"
    os.makedirs(_local(raw), exist_ok=True)
    with open(os.path.join(_local(raw), "orders.csv"), "w") as f:
        f.write("order_id,ts\n1,2026-04-22 10:00:00\n")
    land_by_date(spark, f"{tmp}/raw", f"{tmp}/target", glob="*.csv", ts_col="ts")
    assert os.path.isdir(os.path.join(_local(tmp), "target", "prefix=orders", "year=2026",
                                      "month=04", "day=22"))


def test_landing_with_bookmark_lands_each_file_once(spark, tmp):
    raw = _local(f"{tmp}/raw/orders")
    os.makedirs(raw, exist_ok=True)

    def put(name, rows):
        with open(os.path.join(raw, name), "w") as f:
            f.write("order_id,ts\n" + "".join(f"{i},2026-04-2{i % 3} 10:00:00\n" for i in rows))

    def landed():
        return (spark.read.option("header", True).option("basePath", f"{tmp}/target")
                .csv(f"{tmp}/target").select("order_id").collect())

    put("a.csv", [1, 2]); put("b.csv", [3])
    bm = lambda: Bookmark(spark, f"{tmp}/state", "landing")
    land_by_date(spark, f"{tmp}/raw", f"{tmp}/target", glob="*.csv", ts_col="ts", bookmark=bm())
    assert sorted(int(r.order_id) for r in landed()) == [1, 2, 3]
    put("c.csv", [4, 5])
    land_by_date(spark, f"{tmp}/raw", f"{tmp}/target", glob="*.csv", ts_col="ts", bookmark=bm())
    land_by_date(spark, f"{tmp}/raw", f"{tmp}/target", glob="*.csv", ts_col="ts", bookmark=bm())
    assert sorted(int(r.order_id) for r in landed()) == [1, 2, 3, 4, 5]


def test_suffix_filter_keys(spark, tmp):
    from cairn.sources.files import read_csv
    base = _local(tmp)
    for rel, body in [("raw/orders/a.csv", "x\n1\n"), ("raw/orders/b.csv", "x\n2\n"),
                      ("raw/orders/c.json", '{"x": 3}\n')]:
        os.makedirs(os.path.dirname(os.path.join(base, rel)), exist_ok=True)
        with open(os.path.join(base, rel), "w") as f:
            f.write(body)
    df = read_csv(spark, f"{tmp}/raw/orders", schema="x int", glob="*.csv")
    assert sorted(r.x for r in df.collect()) == [1, 2]


def test_catalog_drop_keeps_data(spark, tmp):
    db = unique_name("t")
    create_database(spark, db)
    path = f"{tmp}/by_status"
    write_frame(spark.range(30).select("id", (F.col("id") % 3).cast("string").alias("s")), path,
                "parquet", partition_by=["s"])
    t = f"{db}.x"
    create_external_table(spark, t, "parquet", path, schema="id bigint, s string", partition_by=["s"])
    assert spark.table(t).count() == 0
    repair_table(spark, t)
    assert spark.table(t).count() == 30 and show_partitions(spark, t).count() == 3
    drop_partition(spark, t, {"s": "0"})
    assert spark.table(t).count() == 20
    assert path_exists(spark, f"{path}/s=0")
    drop_table(spark, t)
    assert path_exists(spark, path) and spark.read.parquet(path).count() == 30


def test_partition_pruning_in_plan(spark, tmp):
    db = unique_name("p")
    create_database(spark, db)
    path = f"{tmp}/pp"
    write_frame(spark.range(30).select("id", (F.col("id") % 3).cast("string").alias("s")), path,
                "parquet", partition_by=["s"])
    create_external_table(spark, f"{db}.x", "parquet", path, schema="id bigint, s string",
                          partition_by=["s"])
    repair_table(spark, f"{db}.x")
    plan = spark.sql(f"SELECT id FROM {db}.x WHERE s = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(s" in plan and "= 1)" in plan


def test_codec_single_file_and_spigot(spark, tmp):
    from cairn.operators.rowfn import spigot
    df = spark.range(100)
    write_frame(df, f"{tmp}/snappy", "parquet", compression="snappy")
    assert any(n.endswith(".snappy.parquet") for n in os.listdir(_local(f"{tmp}/snappy")))
    write_single_file(df, f"{tmp}/one", "csv")
    assert len([n for n in os.listdir(_local(f"{tmp}/one")) if n.endswith(".csv")]) == 1
    write_single_file(df.orderBy(F.desc("id")), f"{tmp}/sorted", "csv")
    assert [r.id for r in spark.read.schema("id long").option("header", True).csv(f"{tmp}/sorted").collect()] == list(range(99, -1, -1))
    with pytest.raises(ValueError):
        write_single_file(df, f"{tmp}/large", "csv", max_bytes=10)
    assert not os.path.exists(_local(f"{tmp}/large"))
    out = spigot(df, f"{tmp}/spigot", fraction=0.1)
    assert out.count() == 100 and 0 < spark.read.json(f"{tmp}/spigot").count() < 100


def test_repartition_coalesce_cache(spark):
    df = spark.range(1000).repartition(6)
    assert df.rdd.getNumPartitions() == 6
    assert df.coalesce(2).rdd.getNumPartitions() == 2
    c = df.cache()
    assert c.count() == 1000 and c.is_cached
    c.unpersist()


def test_error_threshold(spark):
    from cairn.operators.rowfn import map_rows
    df = spark.createDataFrame([("1",), ("x",), ("3",)], "v string")
    m = map_rows(df, lambda r: {"v": int(r["v"])}, "v int", stage="parse")
    assert m.errors_count() == 1 and m.frame.count() == 2
    m.assert_error_threshold(1)
    import pytest
    with pytest.raises(RuntimeError):
        m.assert_error_threshold(0)


def test_ingestion_time_format(spark):
    from cairn.functions.dates import ingestion_time
    v = spark.range(1).select(ingestion_time().alias("t")).first().t
    assert len(v) == 19 and v[4] == "-" and v[13] == ":"
    assert spark.range(1).select(ingestion_time("2024-01-01 00:00:00").alias("t")).first().t == "2024-01-01 00:00:00"


def test_error_set_materialized_once(spark, tmp):
    from cairn.operators.rowfn import map_rows
    df = spark.createDataFrame([("1",), ("x",), ("3",)], "v string")
    m = map_rows(df, lambda r: {"v": int(r["v"])}, "v int").materialize(f"{tmp}/mapped")
    assert sorted(r.v for r in m.frame.collect()) == [1, 3]
    assert m.errors.count() == 1 and "ValueError" in m.errors.first().message


def test_stream_restart_reads_only_new_files(spark, tmp):
    """The checkpoint in the shared folder makes a restarted stream resume:
    files already processed are not read again."""
    from cairn.streaming.etl import run_stream_to_files, stream_files
    schema = "order_id bigint, amount double"
    _month(spark, f"{tmp}/in/jan", 0, 50)
    s = stream_files(spark, f"{tmp}/in", "parquet", spark.read.parquet(f"{tmp}/in/jan").schema,
                     recursiveFileLookup="true")
    run_stream_to_files(s, lambda d: d, f"{tmp}/out", f"{tmp}/ckpt")
    _month(spark, f"{tmp}/in/feb", 50, 30)
    s2 = stream_files(spark, f"{tmp}/in", "parquet", spark.read.parquet(f"{tmp}/in/jan").schema,
                      recursiveFileLookup="true")
    run_stream_to_files(s2, lambda d: d, f"{tmp}/out", f"{tmp}/ckpt")
    out = spark.read.parquet(f"{tmp}/out")
    assert out.count() == 80 and out.select("order_id").distinct().count() == 80
    del schema


def test_stream_timeout_raises_and_rerun_completes(spark, tmp):
    """A run that outlives its timeout raises instead of returning part of
    the output; the next run resumes from the checkpoint, exactly once."""
    import time

    import pandas as pd
    from pyspark.sql.functions import pandas_udf
    from cairn.streaming.etl import run_stream_to_files, stream_files

    @pandas_udf("bigint")
    def slow(v: pd.Series) -> pd.Series:
        time.sleep(1.5)
        return v

    for i in range(4):
        _month(spark, f"{tmp}/in/m{i}", i * 10, 10)
    schema = spark.read.parquet(f"{tmp}/in/m0").schema

    def transform(d):
        return d.withColumn("order_id", slow("order_id"))

    s = stream_files(spark, f"{tmp}/in", "parquet", schema, max_files_per_trigger=1,
                     recursiveFileLookup="true")
    with pytest.raises(TimeoutError):
        run_stream_to_files(s, transform, f"{tmp}/out", f"{tmp}/ckpt", timeout_s=1)
    s2 = stream_files(spark, f"{tmp}/in", "parquet", schema, max_files_per_trigger=1,
                      recursiveFileLookup="true")
    run_stream_to_files(s2, transform, f"{tmp}/out", f"{tmp}/ckpt")
    out = spark.read.parquet(f"{tmp}/out")
    assert out.count() == 40 and out.select("order_id").distinct().count() == 40


def test_catalog_sink_adds_partitions_and_follows_schema(spark, tmp):
    from cairn.sources.catalog import catalog_sink
    db = unique_name("cs")
    create_database(spark, db)
    t = f"{db}.plans"
    a = spark.range(10).select("id", (F.col("id") % 2).alias("p"))
    catalog_sink(a, t, f"{tmp}/out", partition_by=["p"])
    b = spark.range(10, 15).select("id", F.lit(7).cast("bigint").alias("p"))
    catalog_sink(b, t, f"{tmp}/out", partition_by=["p"])
    assert spark.table(t).count() == 15 and show_partitions(spark, t).count() == 3
    c = spark.range(15, 17).select("id", F.lit("x").alias("extra"), F.lit(7).cast("bigint").alias("p"))
    catalog_sink(c, t, f"{tmp}/out", partition_by=["p"])
    assert "extra" in spark.table(t).columns
    assert spark.table(t).count() == 17 and spark.table(t).filter("extra = 'x'").count() == 2
    catalog_sink(a, t, f"{tmp}/out", partition_by=["p"])  # a missing column reads as NULL
    assert spark.table(t).count() == 27 and "extra" in spark.table(t).columns
    with pytest.raises(ValueError):
        catalog_sink(a, t, f"{tmp}/elsewhere", partition_by=["p"])
    with pytest.raises(ValueError):
        catalog_sink(a.withColumn("id", F.lit("t")), t, f"{tmp}/out", partition_by=["p"])
    assert spark.table(t).count() == 27


def test_catalog_sink_keeps_odd_partition_values(spark, tmp):
    from cairn.sources.catalog import catalog_sink
    db = unique_name("odd")
    create_database(spark, db)
    rows = [(1, "a b"), (2, "x:y"), (3, None), (4, "50%"), (5, "ok"), (6, "a=b/c'd")]
    df = spark.createDataFrame(rows, "id int, p string")
    out = catalog_sink(df, f"{db}.t", f"{tmp}/out", partition_by=["p"])
    assert sorted(map(tuple, out.collect())) == sorted(rows)
    dates = spark.createDataFrame([(1, "2024-01-01"), (2, None)], "id int, d string").select(
        "id", F.col("d").cast("date").alias("d"))
    assert catalog_sink(dates, f"{db}.d", f"{tmp}/dates", partition_by=["d"]).count() == 2


def test_second_crawl_finds_new_partitions_and_columns(spark, tmp):
    from cairn.sources.catalog import crawl
    db = unique_name("cr")
    create_database(spark, db)
    spark.range(1).withColumn("p", F.lit("a")).write.partitionBy("p").parquet(f"{tmp}/c")
    assert crawl(spark, f"{db}.t", f"{tmp}/c")["action"] == "created"
    spark.range(1).withColumn("p", F.lit("b")).write.mode("append").partitionBy("p").parquet(f"{tmp}/c")
    assert crawl(spark, f"{db}.t", f"{tmp}/c")["action"] == "updated"
    assert spark.table(f"{db}.t").count() == 2
    assert crawl(spark, f"{db}.t", f"{tmp}/c")["action"] == "unchanged"
    (spark.range(1).withColumn("x", F.lit(1)).withColumn("p", F.lit("c"))
     .write.mode("append").partitionBy("p").parquet(f"{tmp}/c"))
    assert crawl(spark, f"{db}.t", f"{tmp}/c")["action"] == "updated"
    assert spark.table(f"{db}.t").count() == 3 and "x" in spark.table(f"{db}.t").columns


def test_key_bookmark_mark_is_fixed_at_read(spark, tmp):
    from cairn.incremental.bookmark import Bookmark
    src = f"{tmp}/src"

    def read(mode="enable", late=None):
        bm = Bookmark(spark, f"{tmp}/state", "j", mode=mode)
        got = sorted(r.id for r in bm.read_by_key(spark.read.schema("id bigint").parquet(src), "s", "id").collect())
        if late is not None:  # arrives between the sink and the commit
            spark.range(late, late + 1).write.mode("append").parquet(src)
        bm.commit()
        return got

    spark.range(3).write.parquet(src)
    assert read(late=7) == [0, 1, 2]
    assert read("pause") == [0, 1, 2, 7]
    assert read() == [7] and read() == []


def test_row_functions_keep_values_and_records(spark):
    from cairn.operators.rowfn import map_partitions, map_rows, spigot
    from cairn.operators.shape import filter_rows
    big = 9007199254740993
    df = spark.createDataFrame([(big, 1.0), (None, float("nan")), (5, 2.0)], "id bigint, v double").coalesce(1)
    assert {r.id for r in filter_rows(df, lambda p: p["id"].isna() | (p["id"] > 5)).collect()} == {big, None}

    def fail_on_five(r):
        if r["id"] == 5 or (r["id"] is None and r["v"] != r["v"]):
            raise ValueError("no")
        return r

    m = map_rows(df, fail_on_five, df.schema)
    assert [r.id for r in m.frame.collect()] == [big]
    assert {(r.message, r.record) for r in m.errors.collect()} == {
        ("ValueError: no", '{"id": 5, "v": 2.0}'), ("ValueError: no", '{"id": null, "v": "nan"}')}

    bad = map_rows(df, lambda r: {"id": "text" if r["id"] == 5 else r["id"]}, "id bigint")
    assert bad.frame.count() == 2 and bad.errors.first().record == '{"id": 5, "v": 2.0}'

    many = spark.range(25000).coalesce(1)
    one = map_partitions(many, lambda recs: [{"n": sum(1 for _ in recs)}], "n bigint")
    assert [r.n for r in one.frame.collect()] == [25000]

    def halve(recs):
        for r in recs:
            yield {"n": r["id"] // (0 if r["id"] == 12345 else 2)}

    half = map_partitions(many, halve, "n bigint")
    assert half.frame.count() == 24999 and half.errors.first().record == '{"id": 12345}'

    def broken(recs):
        raise RuntimeError("at once")

    assert map_partitions(many, broken, "n bigint").errors.count() == 25000
    for kw in ({}, {"fraction": 0.5, "top": 3}):
        with pytest.raises(ValueError):
            spigot(df, "unused", **kw)


def test_null_rules(spark, tmp):
    from cairn.operators.quality import quality_report, quarantine, unique
    from cairn.operators.rows import merge_upsert
    from cairn.operators.scd import scd1, scd3
    from cairn.operators.nested import relationalize
    from cairn.sinks.files import write_frame
    t = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, v int")
    s = spark.createDataFrame([(1, None), (3, None)], "k int, v int")
    assert sorted(map(tuple, scd1(t.filter("k > 0"), s, ["k"]).collect())) == [(1, None), (2, 20), (3, None)]
    assert {tuple(r) for r in scd3(t.filter("k > 0"), s, ["k"], "v").collect()} == {
        (1, None, 10), (2, 20, None), (3, None, None)}
    assert scd1(t, s.union(s), ["k"]).count() == 4  # equal changes count once
    two = spark.createDataFrame([(1, 5), (1, 6)], "k int, v int")
    for run in (lambda: scd1(t, two, ["k"]), lambda: scd3(t, two, ["k"], "v")):
        with pytest.raises(Exception, match="different changes"):
            run().collect()
    assert merge_upsert(t, t, ["k"]).count() == 3
    from cairn.functions.dates import date_folders
    texts = spark.createDataFrame([("2024-03-05",), ("no date",)], "d string")
    assert [tuple(r) for r in texts.select(*date_folders("d")).collect()] == [
        ("2024", "03", "05"), (None, None, None)]
    d = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert quality_report(d, [unique("k")]).first().n_failed == 2
    good, bad = quarantine(d, [unique("k")])
    assert good.count() == 1 and bad.count() == 2
    write_frame(t, f"{tmp}/o", partition_by=["v"])
    write_frame(t.filter("v = 10"), f"{tmp}/o", partition_by=["v"])
    assert spark.read.parquet(f"{tmp}/o").count() == 1
    clash = spark.sql("select 1 as id, named_struct('b', array(1)) as a, array(2) as a_b")
    with pytest.raises(ValueError):
        relationalize(clash, "r", key="id")


def test_error_count_observed_by_the_write(spark, tmp):
    """Writing the good rows reports the error count from the same job: the
    row function runs once per record."""
    from cairn.operators.rowfn import map_rows
    calls = spark.sparkContext.accumulator(0)

    def parse(r):
        calls.add(1)
        return {"v": int(r["v"])}

    df = spark.createDataFrame([("1",), ("x",), ("3",), ("y",)], "v string").repartition(2)
    m = map_rows(df, parse, "v int", stage="parse")
    assert m.write(f"{tmp}/good") == 2
    assert m.errors_count() == 2 and calls.value == 4
    assert sorted(r.v for r in spark.read.parquet(f"{tmp}/good").collect()) == [1, 3]
    with pytest.raises(RuntimeError):
        m.assert_error_threshold(1)


def test_catalog_sink_computes_input_once(spark, tmp):
    """The written partitions come from an observed metric of the write, so
    the input is not computed a second time to list them."""
    import pandas as pd
    from pyspark.sql.functions import pandas_udf
    from cairn.sources.catalog import catalog_sink
    calls = spark.sparkContext.accumulator(0)

    @pandas_udf("bigint")
    def counted(v: pd.Series) -> pd.Series:
        calls.add(len(v))
        return v

    db = unique_name("once")
    create_database(spark, db)
    # the partition column depends on the counted function, so listing the
    # partitions by a second query would run it again
    df = (spark.range(0, 200, 1, 4).select(counted("id").alias("id"))
          .withColumn("p", F.col("id") % 3))
    out = catalog_sink(df, f"{db}.t", f"{tmp}/t", partition_by=["p"])
    assert calls.value == 200
    assert out.count() == 200 and show_partitions(spark, f"{db}.t").count() == 3

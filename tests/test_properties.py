"""Seeded random frames: algebraic properties of the operators, and plan checks."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.operators.rows import dedupe, merge_upsert, split_rows
from cairn.operators.shape import split_fields

rows_st = st.lists(st.tuples(st.integers(0, 20), st.one_of(st.none(), st.integers(-5, 5)),
                             st.sampled_from(["a", "b", None])), min_size=0, max_size=30)
SCHEMA = "k int, v int, s string"


@settings(max_examples=15, deadline=None)
@given(rows=rows_st)
def test_split_rows_partitions_input(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    a, b = split_rows(df, "v > 0 AND s = 'a'")
    key = repr
    assert sorted(a.collect() + b.collect(), key=key) == sorted(df.collect(), key=key)
    assert a.intersectAll(b).count() == 0


@settings(max_examples=10, deadline=None)
@given(rows=rows_st)
def test_merge_twice_equals_once(spark, rows):
    src = spark.createDataFrame(rows, SCHEMA).dropDuplicates(["k"])
    stage = spark.createDataFrame([(k, 99, "z") for k in range(0, 25, 3)], SCHEMA)
    once = merge_upsert(src, stage, ["k"])
    twice = merge_upsert(once, stage, ["k"])
    assert sorted(once.collect(), key=repr) == sorted(twice.collect(), key=repr)
    keys = [r.k for r in once.collect()]
    assert len(keys) == len(set(keys))


@settings(max_examples=10, deadline=None)
@given(rows=rows_st)
def test_dedupe_matches_row_number(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(dedupe(df, ["k"]).collect(), key=repr)
    by_key = {}
    for r in sorted(df.collect(), key=lambda r: (r.k, r.v is not None, r.v or 0, r.s is not None, r.s or "")):
        by_key.setdefault(r.k, r)
    assert got == sorted(by_key.values(), key=repr)


def test_split_fields_partitions_schema(spark):
    df = spark.range(3).select("id", (F.col("id") * 2).alias("a"), F.lit("x").alias("b"))
    left, right = split_fields(df, ["a"])
    assert left.columns == ["a"] and right.columns == ["id", "b"]


def test_relationalize_join_restores_nesting(spark):
    from cairn.operators.nested import relationalize
    rnd = random.Random(7)
    rows = [(i, [(rnd.randint(0, 9), float(j)) for j in range(rnd.randint(0, 4))]) for i in range(40)]
    df = spark.createDataFrame(rows, "id_ int, items array<struct<p:int, q:double>>")
    t = relationalize(df, "o", key="id_")
    back = (t["o"].join(t["o_items"], F.col("items") == F.col("id"))
            .groupBy("id_").agg(F.sort_array(F.collect_list(F.struct("index", "`items.p`", "`items.q`")))
                                .alias("x")).collect())
    restored = {r.id_: [(e[1], e[2]) for e in r.x] for r in back}
    expected = {i: [tuple(e) for e in it] for i, it in rows if it}
    assert restored == expected


def test_expression_operators_stay_in_jvm(spark):
    """Shaping, choice resolution and mapping plans hold no Python UDF."""
    from cairn.plans import registry
    qs = registry.queries()
    for n in ["apply_mapping", "resolve_cast_double", "resolve_project_double", "select_fields",
              "dedupe_by_key", "unnest_ddb", "relationalize_items", "merge_upsert", "scd2"]:
        plan = qs[n](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, n


def test_scan_prunes_columns_and_pushes_filters(spark):
    from cairn.plans import registry
    df = registry.queries()["filter_not_equal"](spark, "/root/testdata/sf0.001").select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,P))]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_dense_ids_are_1_to_n(spark):
    from cairn.operators.nested import with_dense_id
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("x"))
    ids = sorted(r.id for r in with_dense_id(df).collect())
    assert ids == list(range(1, 1001))
    plan = with_dense_id(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


@pytest.mark.parametrize("bad", ["cast:foo_type"])
def test_unknown_cast_type_is_reported(spark, bad):
    from cairn.operators.choice import resolve_column, text_to_choice
    df = spark.createDataFrame([("1",)], "a string").withColumn("a", text_to_choice("a"))
    with pytest.raises(Exception):
        resolve_column(df, "a", bad).collect()


def test_one_row_per_key_is_an_aggregate_not_a_window(spark):
    """dedupe / latest_per_key reduce a hot key map-side (partial aggregate)."""
    from cairn.plans import registry
    qs = registry.queries()
    for n in ["dedupe_by_key", "latest_per_key", "clean_orders"]:
        plan = qs[n](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan, n
        assert ("partial_min" in plan) or ("partial_max" in plan), n


def test_file_grouping_changes_scan_tasks(spark, tmp):
    from cairn.sources.files import group_files
    from cairn.sinks.files import write_frame
    write_frame(spark.range(0, 20000, 1, 20), f"{tmp}/many", "parquet")
    old = (spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes"))
    try:
        group_files(spark, max_partition_bytes=128 << 20, open_cost_bytes=1)
        grouped = spark.read.parquet(f"{tmp}/many").rdd.getNumPartitions()
        group_files(spark, max_partition_bytes=1024, open_cost_bytes=1024)
        spread = spark.read.parquet(f"{tmp}/many").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert spread > grouped


def test_documents_depend_on_the_row_alone(spark, tmp):
    """3,500 lines of one order: the documents are the (supplier, date) pairs,
    and a few of the lines alone get the same documents."""
    from cairn.plans.standins import nested_orders
    lines = spark.range(3500).select(
        F.lit(1).cast("bigint").alias("l_orderkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        F.col("id").alias("l_partkey"), F.lit(1.0).alias("l_quantity"),
        F.lit(2.0).alias("l_extendedprice"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("l_suppkey"),
        F.timestamp_add("DAY", (F.col("id") % 2).cast("int"), F.lit("2024-01-01").cast("timestamp"))
        .alias("l_shipdate"))
    spark.range(1, 3).select(F.col("id").alias("o_orderkey"), F.lit(1).cast("bigint").alias("o_custkey"),
                             F.lit(5.0).alias("o_totalprice")).write.parquet(f"{tmp}/orders.parquet")
    spark.createDataFrame([(1, "c", "m")], "c_custkey bigint, c_name string, c_mktsegment string") \
        .write.parquet(f"{tmp}/customer.parquet")
    lines.write.parquet(f"{tmp}/lineitem.parquet")
    docs = {r.doc_id: r["items"] for r in nested_orders(spark, tmp).collect()}
    assert len(docs) == 7 and docs["2/"] is None
    assert sum(len(v) for v in docs.values() if v) == 3500 and "1/-20240101" in docs
    few = tmp + "_few"
    for t in ("orders", "customer"):
        spark.read.parquet(f"{tmp}/{t}.parquet").write.parquet(f"{few}/{t}.parquet")
    lines.filter("l_partkey < 6").write.parquet(f"{few}/lineitem.parquet")
    assert {r.doc_id for r in nested_orders(spark, few).collect()} == docs.keys()


@settings(max_examples=10, deadline=None)
@given(vals=st.lists(st.tuples(st.integers(0, 3), st.one_of(
    st.none(), st.integers(-(1 << 40) + 1, (1 << 40) - 1))), min_size=0, max_size=40))
def test_exact_sum_matches_integer_sum(spark, vals):
    """Split BIGINT sums equal Python's exact sum (negatives, NULLs, large values)."""
    from cairn.functions.money import exact_sum
    df = spark.createDataFrame(vals, "k int, v bigint")
    got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    want = {}
    for k, v in vals:
        want.setdefault(k, None)
        if v is not None:
            want[k] = (want[k] or 0) + v
    assert {k: (None if v is None else int(v)) for k, v in got.items()} == want


def test_exact_sum_past_bigint_range(spark):
    """A group whose total passes 2^63 stays exact (a BIGINT sum would overflow)."""
    from cairn.functions.money import exact_sum
    big = (1 << 40) - 1
    df = spark.range(0, 1 << 24, 1, 8).select(F.lit(big).alias("v"))
    s = df.agg(exact_sum("v").alias("s")).first().s
    assert int(s) == big * (1 << 24) and int(s) > (1 << 63)


def test_schema_lookup_follows_rewrites(spark, tmp):
    """The per-session schema of a table is refreshed when the table is rewritten."""
    import os
    from cairn.session import load
    sf = tmp
    spark.range(3).write.parquet(os.path.join(sf, "t.parquet"))
    assert load(spark, sf, "t").columns == ["id"]
    spark.range(3).selectExpr("id", "id * 2 AS x").write.mode("overwrite").parquet(os.path.join(sf, "t.parquet"))
    assert load(spark, sf, "t").columns == ["id", "x"]


def test_upsert_distinct_keys_add_no_shuffle(spark):
    """The staged keys' distinct and the anti join share one exchange per side."""
    from cairn.operators.rows import merge_upsert
    a = spark.range(0, 1000).selectExpr("id AS k", "id * 2 AS v")
    b = spark.range(0, 100).selectExpr("id % 10 AS k", "id AS v")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merge_upsert(a, b, ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert plan.count("Exchange hashpartitioning") == 2
    assert "LeftAnti" in plan


def test_single_file_table_reused_until_rewritten(spark, tmp):
    """A single-file table is one DataFrame per session until the file changes."""
    import os
    import time
    import pyarrow as pa
    import pyarrow.parquet as pq
    from cairn.session import load
    local = tmp.replace("file:", "")
    path = os.path.join(local, "t.parquet")
    os.makedirs(local, exist_ok=True)
    pq.write_table(pa.table({"id": [1, 2]}), path)
    a, b = load(spark, tmp, "t"), load(spark, tmp, "t")
    assert a is b and a.columns == ["id"]
    time.sleep(0.01)
    pq.write_table(pa.table({"id": [1, 2], "x": [3, 4]}), path)
    c = load(spark, tmp, "t")
    assert c is not a and c.columns == ["id", "x"] and c.count() == 2


def test_headline_plans_have_no_cross_join_or_row_python(spark):
    """At scale (automatic broadcast off): no cartesian or nested-loop join,
    no row-at-a-time Python, and every scan reads fewer columns than its
    table when the query needs fewer."""
    from cairn.plans import registry
    from tools.plan_report import HEADLINE, summarize
    qs = registry.queries()
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in HEADLINE:
            plan = qs[n](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
            ops = summarize(plan)["ops"]
            for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
                assert bad not in ops, (n, bad)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    li = qs["revenue_by_category"](spark, "/root/testdata/sf0.001")
    scans = summarize(li._jdf.queryExecution().executedPlan().toString())["scans"]
    assert dict((t, c) for t, c, _ in scans)["lineitem.parquet"] == 3

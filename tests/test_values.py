"""Values kept as they were read: numbers of documents and lines, sums,
error sets with counts, samples that do not depend on the layout."""

import json
import random

import pytest
from pyspark.sql import functions as F

from cairn.functions.lattice import csv_ddl, learnt
from cairn.functions.money import avg_2dp, sum_2dp
from cairn.operators.checked import Checked
from cairn.operators.nested import unbox, unnest_ddb_json
from cairn.operators.rowfn import spigot


def items(spark, *rows):
    return spark.createDataFrame([(json.dumps(r) if isinstance(r, dict) else r,) for r in rows], "item string")


def test_ddb_numbers_lists_and_maps(spark):
    df = items(
        spark,
        {"id": {"N": "9007199254740993"}, "price": {"N": "1.50"}, "tiny": {"N": "1E-3"}, "huge": {"N": "9" * 39},
         "lines": {"L": [{"M": {"sku": {"S": "a"}, "n": {"N": "12345678901"}, "tags": {"L": [{"S": "x"}, {"S": "y"}]}}},
                         {"M": {"sku": {"S": "b"}, "n": {"N": "1"}, "tags": {"L": []}}}]},
         "grid": {"L": [{"L": [{"N": "1"}, {"N": "2.5"}]}, {"L": []}]}, "set": {"NS": ["1", "99999999999"]},
         "odd": {"S": "t"}, "who": {"M": {"name": {"S": "n"}, "age": {"N": "7"}}}, "gone": {"NULL": True}},
        {"id": {"N": "1"}, "price": {"N": "-200"}, "odd": {"M": {"k": {"BOOL": True}}}, "who": {"M": {"name": {"S": "m"}}}, "lines": {"L": []}},
        {"id": {"N": "2"}, "price": {"NULL": True}}, "not json", None)
    out = unnest_ddb_json(df, "item")
    assert dict(out.dtypes) == {
        "id": "bigint", "price": "decimal(5,2)", "tiny": "decimal(4,3)", "huge": "string", "odd": "string", "set": "array<bigint>",
        "lines": "array<struct<n:bigint,sku:string,tags:array<string>>>", "grid": "array<array<decimal(2,1)>>",
        "who.age": "int", "who.name": "string"}
    rows = {r["id"]: r for r in out.collect()}
    a, b = rows[9007199254740993], rows[1]
    assert str(a["price"]) == "1.50" and str(a["tiny"]) == "0.001" and a["huge"] == "9" * 39 and a["set"] == [1, 99999999999]
    assert [(x["sku"], x["n"], x["tags"]) for x in a["lines"]] == [("a", 12345678901, ["x", "y"]), ("b", 1, [])]
    assert [[str(x) for x in g] for g in a["grid"]] == [["1.0", "2.5"], []]
    assert a["odd"] == "t" and json.loads(b["odd"]) == {"M": {"k": {"BOOL": True}}}
    assert (b["who.name"], b["who.age"], b["lines"], str(b["price"])) == ("m", None, [], "-200.00")
    assert rows[2]["price"] is None and rows[2]["lines"] is None and len(out.collect()) == 5
    given = unnest_ddb_json(df, "item", attributes={"id": "N", "who": {"name": "S"}}, numbers="double")
    assert dict(given.dtypes) == {"id": "double", "who.name": "string"}


@pytest.mark.parametrize("seed", [1, 2])
def test_csv_types_do_not_depend_on_order(spark, seed):
    lines = ['1,a,2.50,1e3,007,,"x,y"', '3000000000,b,100,2.5,8,,"say ""hi"""', '-5,1,0.125,1,9,,', '7,2', None]
    random.Random(seed).shuffle(lines)
    df = spark.createDataFrame([(x,) for x in lines], "line string").repartition(seed + 1)
    assert csv_ddl(df, "line") == "_c0 BIGINT, _c1 STRING, _c2 DECIMAL(6,3), _c3 DOUBLE, _c4 STRING, _c5 STRING, _c6 STRING"
    rows = {r["_c0"]: r for r in unbox(df, "line", "csv").select("line.*").collect()}
    assert str(rows[1]["_c2"]) == "2.500" and rows[1]["_c3"] == 1000.0 and rows[1]["_c4"] == "007" and rows[1]["_c6"] == "x,y"
    assert rows[3000000000]["_c1"] == "b" and rows[7]["_c2"] is None


def test_lattice(spark):
    want = {"0": "INT", "007": "STRING", "-2147483648": "INT", "2147483648": "BIGINT", "9223372036854775808": "DECIMAL(19,0)", "0.004": "DECIMAL(4,3)",
            "1e5": "DOUBLE", "+5": "STRING", "": "STRING", "1" * 39: "STRING"}
    df = spark.createDataFrame(list(enumerate(want)), "pos int, text string")
    assert list(map(learnt(df).get, range(len(want)))) == list(want.values())
    exact = spark.createDataFrame([(0, "1E+3"), (0, "2.5"), (1, "+7")], "pos int, text string")
    assert learnt(exact, exact=True) == {0: "DECIMAL(5,1)", 1: "INT"}
    assert learnt(df.where("pos < 0")) == {}


def test_sums_round_once_at_any_scale(spark):
    df = spark.createDataFrame([(0, 0.004), (0, 0.004), (1, -0.005), (1, -0.01), (2, 1e9), (2, 0.001), (2, -0.002), (3, None)], "g int, x double")
    df = df.withColumn("d", F.col("x").cast("decimal(20,3)"))
    got = {r.g: r[1:] for r in df.groupBy("g").agg(sum_2dp("x", 3).alias("a"), sum_2dp("d").alias("b"), avg_2dp("x", 3).alias("c")).collect()}
    assert got == {0: (0.01, 0.01, 0.0), 1: (-0.02, -0.02, -0.01), 2: (1e9, 1e9, 333333333.33), 3: (None, None, None)}
    two = spark.createDataFrame([("a", 1.25), ("a", -1.5), ("b", 0.03), ("b", 0.02)], "g string, x double")
    assert {r.g: (r.s, r.m) for r in two.groupBy("g").agg(sum_2dp("x", scale=2).alias("s"), avg_2dp("x", scale=2).alias("m")).collect()} == {
        "a": (-0.25, -0.13), "b": (0.05, 0.03)}
    # past the range of a BIGINT of units
    big = spark.range(1000).select(F.lit(10 ** 11).cast("decimal(38,6)").alias("x"))
    assert big.agg(sum_2dp("x", 12).alias("s")).first().s == 1e14
    with pytest.raises(ValueError):
        sum_2dp("x", 19)


def test_error_set_counts_over_three_stages(spark, tmp):
    df = spark.createDataFrame([("1", "5", "2024-01-01"), ("x", "y", "z"), ("2", "n/a", "2024-01-02"), ("3", "7", "soon"), ("4", "500", "2024-01-04"), ("5", None, None)],
                               "id string, n string, day string")
    out = (Checked(df).cast([("id", "string", "id", "int"), ("n", "string", "n", "string"), ("day", "string", "day", "string")], stage="ids")
           .cast([("id", "int", "key", "bigint"), ("n", "string", "n", "int"), ("day", "string", "day", "date")], stage="values")
           .require({"n is too large": "n IS NULL OR n < 100"}, stage="rules").run(f"{tmp}/checked"))
    assert {s: (c.seen, c.errors) for s, c in out.counts.items()} == {"ids": (6, 1), "values": (5, 2), "rules": (3, 1)}
    assert out.stage_errors_count("values") == 2 and out.errors_count() == out.errors.count() == 4
    assert sorted((r.key, r.n) for r in out.frame.collect()) == [(1, 5), (5, None)]
    assert out.frame.dtypes == [("key", "bigint"), ("n", "int"), ("day", "date")]
    bad = {r.stage: (r.message, json.loads(r.record)) for r in out.errors.where("message NOT LIKE 'day%'").collect()}
    assert bad == {"ids": ("id: x is no int", {"id": "x", "n": "y", "day": "z"}), "values": ("n: n/a is no int", {"id": 2, "n": "n/a", "day": "2024-01-02"}),
                   "rules": ("n is too large", {"key": 4, "n": 500, "day": "2024-01-04"})}
    with pytest.raises(RuntimeError):
        out.assert_error_threshold(3)
    with pytest.raises(ValueError):
        Checked(df).require({"m": "true"}, stage="a").require({"m": "true"}, stage="a")
    empty = Checked(df.where("id = 'none'")).require({"m": "true"}).run(f"{tmp}/none")
    assert empty.counts["rules"].seen == 0 and empty.frame.count() == empty.errors.count() == 0


def test_spigot_does_not_depend_on_the_layout(spark, tmp):
    df = spark.range(2000).select((F.col("id") % 1500).alias("a"), F.lit(None).cast("string").alias("b"))
    df = df.unionByName(spark.range(3000).select(F.lit(7).cast("bigint").alias("a"), F.lit("same").alias("b")))
    samples = []
    for n in (3, 7):
        for kw in ({"fraction": 0.1}, {"top": 40}):
            spigot(df.repartition(n), f"{tmp}/s{n}{len(samples)}", **kw)
            samples.append(sorted(r.value for r in spark.read.text(f"{tmp}/s{n}{len(samples)}").collect()))
    assert samples[0] == samples[2] and samples[1] == samples[3] and len(samples[1]) == 40
    assert 400 < len(samples[0]) < 600
    assert 230 < samples[0].count('{"a":7,"b":"same"}') < 370
    spigot(df, f"{tmp}/other", fraction=0.1, seed=1)
    assert sorted(r.value for r in spark.read.text(f"{tmp}/other").collect()) != samples[0]

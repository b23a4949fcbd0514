"""Steps that large inputs pay for: items built once, paths followed in one step, compressed lines."""

import json

from pyspark.sql import functions as F

from cairn.functions import lattice
from cairn.operators.nested import unnest_ddb_json
from cairn.plans import io_sources, mixed_nested
from cairn.session import checkpoint_root

ITEMS = [
    {"id": {"N": "9007199254740994"}, "lines": {"L": [
        {"M": {"line": {"N": "1"}, "quantity": {"N": "17.50"}, "flags": {"L": [{"S": "A"}, {"S": "F"}]}}},
        {"M": {"line": {"N": "22"}, "quantity": {"N": "3"}, "flags": {"L": []}}}]},
     "codes": {"NS": ["0.25", "1234.5"]}, "mixed": {"L": [{"S": "O"}, {"N": "7"}]}, "info": {"M": {"deep": {"M": {"n": {"N": "5"}}}}}},
    {"id": {"N": "-3"}, "lines": {"L": [{"M": {"line": {"N": "2147483648"}}}, {"NULL": True}]}, "mixed": {"NULL": True}},
    {"id": {"N": "4"}, "lines": {"NULL": True}, "info": {"M": {}}},
]


def test_ddb_values_at_any_depth(spark):
    df = spark.createDataFrame([(json.dumps(i),) for i in ITEMS] + [(None,)], "item string")
    got = unnest_ddb_json(df, "item")
    kinds = dict(got.dtypes)
    assert kinds["id"] == "bigint" and kinds["info.deep.n"] == "int" and kinds["codes"] == "array<decimal(6,2)>"
    assert "line:bigint" in kinds["lines"] and "quantity:decimal(4,2)" in kinds["lines"]
    rows = {r["id"]: r.asDict(recursive=True) for r in got.collect()}
    first = rows[9007199254740994]
    assert [(str(x["quantity"]), x["line"], x["flags"]) for x in first["lines"]] == [("17.50", 1, ["A", "F"]), ("3.00", 22, [])]
    assert first["mixed"] == ["O", "7"] and first["info.deep.n"] == 5 and [str(c) for c in first["codes"]] == ["0.25", "1234.50"]
    assert [x and x["line"] for x in rows[-3]["lines"]] == [2147483648, None] and rows[-3]["mixed"] is None
    assert rows[4]["lines"] is None and rows[4]["info.deep.n"] is None and rows[None]["lines"] is None


def test_no_variant_is_taken_out_on_the_way(spark):
    df = spark.createDataFrame([(json.dumps(i),) for i in ITEMS], "item string")
    plan = unnest_ddb_json(df, "item")._jdf.queryExecution().analyzed().toString()
    assert "try_variant_get(try_variant_get(" not in plan


def test_items_are_built_once(spark, monkeypatch):
    built = spark.sparkContext.accumulator(0)

    def count(t: str) -> str:
        built.add(1)
        return t

    items = spark.createDataFrame([(json.dumps(ITEMS[0]),)] * 5, "item string").repartition(1)
    monkeypatch.setattr(mixed_nested, "ddb_orders", lambda spark, sf: items.select(F.udf(count, "string")("item").alias("item")))
    rows = mixed_nested.unnest_ddb_lists(spark, "").collect()
    assert built.value == 5 and len(rows) == 5
    assert rows[0].id == 9007199254740994 and rows[0].line_sum == 23 and rows[0].quantity == 20.5 and rows[0].flags == "AF,"


def test_json_lines_are_compressed_and_bounded(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(io_sources, "scratch", lambda spark, *parts: f"{checkpoint_root(spark)}/json-lines-test")
    write = io_sources.write_frame
    monkeypatch.setattr(io_sources, "write_frame", lambda df, path, fmt, **kw: seen.update(kw) or write(df, path, fmt, **kw))
    from cairn.plans import standins
    docs = spark.createDataFrame([(f"{i}/1", i, "1", ("n", "s"), 1.0, [(1, i, 2.0, 3.0)] if i % 2 else None) for i in range(50)],
                                 "doc_id string, order_id long, part string, customer struct<name:string,segment:string>, total double, "
                                 "items array<struct<line:int,product:long,quantity:double,price:double>>")
    monkeypatch.setattr(standins, "nested_orders", lambda spark, sf: docs)
    df = io_sources.scan_json_nested(spark, "")
    assert {r.order_id: r.first_product for r in df.collect()} == {i: i if i % 2 else None for i in range(50)}
    assert all(f.endswith(".json.gz") for f in df.inputFiles()) and seen["max_records_per_file"] == 1_000_000


def test_short_numbers_are_sized_like_others(spark):
    texts = ["0", "-5", "123456789", "2147483647", "2147483648", "-2147483649", "999999999999999999", "9223372036854775807",
             "9223372036854775808", "0.25", "-17.00", "007", "+5", "1e3", "x", "", None]
    exact = ["INT", "INT", "INT", "INT", "BIGINT", "BIGINT", "BIGINT", "BIGINT", "DECIMAL(19,0)", "DECIMAL(3,2)", "DECIMAL(4,2)",
             "INT", "INT", "DECIMAL(4,0)", "STRING", "STRING", "STRING"]
    got = lattice.learnt(spark.createDataFrame(list(enumerate(texts)), "pos int, text string"), exact=True)
    assert [got[i] for i in range(len(texts))] == exact

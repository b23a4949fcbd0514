"""Worked examples from the reference's guides, typed in as tiny fixtures (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.casting import apply_mapping
from cairn.operators.choice import (ChoiceType, choice_profile, json_to_choice, observed_types,
                                    resolve_choice, resolve_column, text_to_choice)
from cairn.operators.nested import explode_map, relationalize
from cairn.operators.shape import (drop_fields, schema_add_field, schema_get_field,
                                   schema_has_field)
from cairn.sources.files import read_csv


@pytest.fixture()
def messy(spark):
    rows = [("ORD-001", "99.99"), ("ORD-002", "N/A"), ("ORD-003", None), ("ORD-004", "199.50")]
    df = spark.createDataFrame(rows, "order_id string, amount string")
    return df.withColumn("amount", text_to_choice("amount"))


def test_choice_schema_and_cast_double(messy):
    assert observed_types(messy, "amount") == ["DOUBLE", "STRING"]
    got = resolve_column(messy, "amount", "cast:double").orderBy("order_id").collect()
    assert [r.amount for r in got] == [99.99, None, None, 199.5]


def test_choice_project_keeps_nulls_drops_other_types(messy):
    got = resolve_column(messy, "amount", "project:double").orderBy("order_id").collect()
    assert [(r.order_id, r.amount) for r in got] == [("ORD-001", 99.99), ("ORD-003", None),
                                                    ("ORD-004", 199.5)]


def test_choice_make_struct(messy):
    got = resolve_column(messy, "amount", "make_struct").orderBy("order_id").first()
    assert got.amount.asDict() == {"double": 99.99, "string": None}


def test_choice_make_array_and_cast_string(messy):
    arr = resolve_column(messy, "amount", "make_array").orderBy("order_id").collect()
    assert [r.amount for r in arr] == [["99.99"], ["N/A"], None, ["199.50"]]
    s = resolve_column(messy, "amount", "cast:string").orderBy("order_id").collect()
    assert [r.amount for r in s] == ["99.99", "N/A", None, "199.50"]


def test_choice_keeps_the_text(spark):
    texts = ["007", "12D", "199.50", "12345678901234567890", "9007199254740993", "1e3", "NaN", "Infinity", "0x1F", "", " 5 ", "-.5", "5.", "1e999", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("t", text_to_choice("t"))

    def resolved(action):
        return [r.t for r in resolve_column(df, "t", action).orderBy("i").collect()]

    assert resolved("cast:string") == texts
    assert resolved("make_array") == [[t] if t is not None else None for t in texts]
    assert resolved("cast:double") == [7.0, None, 199.5, 12345678901234567890.0, 9007199254740993.0, 1000.0, None, None, None, None, 5.0, -0.5, 5.0, None, None]
    assert resolved("cast:bigint") == [7, None, 199, None, 9007199254740993, 1000, None, None, None, None, 5, 0, 5, None, None]
    assert [None if d is None else str(d) for d in resolved("cast:decimal(20,0)")][3:5] == ["12345678901234567890", "9007199254740993"]
    types = {r.value_type: r.n for r in choice_profile(df, ["t"]).collect()}
    assert types == {"DOUBLE": 8, "STRING": 6, None: 1}
    assert len(resolved("project:string")) == 7 and resolved("project:double")[0] == 7.0


def test_choice_from_json(spark):
    df = spark.createDataFrame([("ORD-001", '132.63'), ("ORD-002", '"N/A"')], "order_id string, j string")
    v = df.withColumn("amount", json_to_choice("j")).drop("j")
    got = resolve_choice(v, choice="cast:double").orderBy("order_id").collect()
    assert [r.amount for r in got] == [132.63, None]


def test_choice_profile_counts(messy):
    got = {(r.value_type, r.n) for r in choice_profile(messy, ["amount"]).collect()}
    assert got == {("DOUBLE", 2), ("STRING", 1), (None, 1)}


def test_choice_type_algebra():
    c = ChoiceType({"double"}).add("STRING")
    assert c == {"double", "string"}
    assert c.merge(["int"]) == {"double", "string", "int"}


def test_apply_mapping_golden(spark):
    rows = [("ORD-001", "john", "Laptop", "999.99", "2024-01-15")]
    df = spark.createDataFrame(rows, "order_id string, customer_name string, product string, "
                                     "amount string, order_date string")
    out = apply_mapping(df, [("order_id", "string", "order_id", "string"),
                             ("customer_name", "string", "customer", "string"),
                             ("amount", "string", "amount", "double"),
                             ("order_date", "string", "order_date", "date")])
    assert out.columns == ["order_id", "customer", "amount", "order_date"]
    assert dict(out.dtypes) == {"order_id": "string", "customer": "string", "amount": "double",
                                "order_date": "date"}
    assert out.first().amount == 999.99


def test_apply_mapping_bad_cast_is_null_and_nested_target(spark):
    df = spark.createDataFrame([("x", "N/A")], "a string, b string")
    out = apply_mapping(df, [("a", "string", "s.a", "string"), ("b", "string", "s.b", "double")])
    r = out.first()
    assert r.s.a == "x" and r.s.b is None


def test_relationalize_golden(spark):
    schema = ("order_id int, customer struct<name:string,email:string>, "
              "items array<struct<product:string,quantity:int,price:double>>")
    df = spark.createDataFrame([(1, ("Alice", "a@x.com"),
                                 [("Laptop", 1, 999.99), ("Mouse", 2, 29.99)])], schema)
    t = relationalize(df, "orders", key="order_id")
    assert sorted(t) == ["orders", "orders_items"]
    root = t["orders"].first().asDict()
    assert root == {"order_id": 1, "customer.name": "Alice", "customer.email": "a@x.com", "items": 1}
    child = [tuple(r) for r in t["orders_items"].orderBy("index").collect()]
    assert child == [(1, 0, "Laptop", 1, 999.99), (1, 1, "Mouse", 2, 29.99)]
    assert t["orders_items"].columns == ["id", "index", "items.product", "items.quantity", "items.price"]


def test_relationalize_dense_ids_and_nested_arrays(spark):
    schema = "name string, tags array<string>, kids array<struct<k:string, toys:array<string>>>"
    rows = [("a", ["x", "y"], [("k1", ["t1", "t2"])]), ("b", [], None), ("c", None, [("k2", [])])]
    t = relationalize(spark.createDataFrame(rows, schema), "p")
    root = {r.name: r for r in t["p"].collect()}
    assert root["b"].tags is None and root["c"].tags is None
    ids = sorted(r.kids for r in root.values() if r.kids is not None)
    assert len(set(ids)) == 2 and all(isinstance(i, int) for i in ids)
    assert {r["tags.val"] for r in t["p_tags"].collect()} == {"x", "y"}
    assert sorted(r["kids.toys.val"] for r in t["p_kids_kids_toys"].collect()) == ["t1", "t2"]


def test_map_column_entries(spark):
    df = spark.createDataFrame([("ORD-001", {"source": "web", "campaign": "summer_sale"}),
                                ("ORD-002", {"source": "mobile"})], "order_id string, metadata map<string,string>")
    assert explode_map(df, "metadata").count() == 3


def test_nested_people_drop_nested_field(spark):
    schema = ("name string, age int, location struct<state:string, county:string>, "
              "friends array<struct<name:string, age:int>>")
    rows = [("a", 1, ("CA", "x"), [("b", 2)]), ("b", None, ("NY", None), []),
            ("c", 3, None, None), ("d", 4, ("TX", "y"), [("e", None)]), ("e", 5, ("WA", "z"), [])]
    df = drop_fields(spark.createDataFrame(rows, schema), ["location.county"])
    assert df.schema["location"].dataType.fieldNames() == ["state"]
    assert df.count() == 5


def test_quoted_csv_with_commas(spark, tmp):
    import os
    os.makedirs(tmp.replace("file:", ""), exist_ok=True)
    path = os.path.join(tmp.replace("file:", ""), "c.csv")
    with open(path, "w") as f:
        f.write('customer_id,customer_name,address,amount\n')
        f.write('1,"Smith, John","12 Main St, Springfield",100.5\n')
        f.write('2,"Doe, Jane","5 Elm St, Shelbyville",20\n')
    df = read_csv(spark, path, schema="customer_id int, customer_name string, address string, amount double")
    r = df.orderBy("customer_id").first()
    assert len(df.columns) == 4 and r.address == "12 Main St, Springfield"


def test_malformed_row_modes(spark, tmp):
    import os
    p = tmp.replace("file:", "")
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, "m.csv"), "w") as f:
        f.write("order_id,amount\nORD-1,10.5\nORD-2,N/A\n")
    schema = "order_id string, amount double"
    perm = read_csv(spark, p, schema=schema, mode="PERMISSIVE").orderBy("order_id").collect()
    assert [r.amount for r in perm] == [10.5, None]
    # malformed detection covers the columns a query reads (CSV column pruning)
    assert len(read_csv(spark, p, schema=schema, mode="DROPMALFORMED").collect()) == 1
    with pytest.raises(Exception):
        read_csv(spark, p, schema=schema, mode="FAILFAST").collect()


def test_schema_helpers():
    st = T.StructType([T.StructField(n, T.StringType()) for n in
                       ["order_id", "customer_name", "product", "amount", "order_date"]])
    assert schema_has_field(st, "amount") and not schema_has_field(st, "quantity")
    st2 = schema_add_field(st, "processed_date", T.DateType())
    assert schema_has_field(st2, "processed_date") and not schema_has_field(st, "processed_date")
    assert schema_get_field(st2, "processed_date").dataType == T.DateType()


def test_enum_membership_via_quality(spark):
    from cairn.operators import quality as Q
    df = spark.createDataFrame([("a",), ("b",), ("z",)], "s string")
    rep = {r.rule: r.n_failed for r in Q.quality_report(df, [Q.in_set("s", ["a", "b"])]).collect()}
    assert rep == {"in_set(s)": 1}


def test_cast_never_raises(spark):
    df = spark.createDataFrame([("12.0",), ("x",), ("Y",), (None,)], "v string")
    from cairn.functions.casting import safe_cast
    got = df.select(safe_cast("v", "int").alias("i"), safe_cast("v", "double").alias("d"),
                    safe_cast("v", "boolean").alias("b"), safe_cast("v", "date").alias("dt")).collect()
    assert [r.i for r in got] == [None, None, None, None]
    assert [r.d for r in got] == [12.0, None, None, None]
    assert got[2].b is True


def test_generators_shape(spark):
    from cairn.sources.generators import gen_flights, gen_orders, gen_shop_orders
    o = gen_orders(spark, 100)
    assert o.count() == 104 and o.select("order_id").distinct().count() == 102
    from cairn.plans.shaping import clean_orders_frame
    cleaned = clean_orders_frame(o)
    assert cleaned.count() == 100
    s = gen_shop_orders(spark, 500)
    assert s.filter(F.col("unit_price").isNull()).count() == 0
    f = gen_flights(spark, 500)
    assert f.filter(F.col("origin") == F.col("destination")).count() == 0
    assert f.filter((F.col("status") != "Delayed") & (F.col("departure_delay_mins") != 0)).count() == 0

"""Synthetic input tables with the reference's vocabularies and ranges.

Generated on the cluster from ``spark.range(n)`` with seeded ``rand`` —
nothing is built on the driver, so ``n`` can be as large as needed. These
are library helpers for demos and tests; registered queries read the driver
tables instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values (must equal the reference's sample generators).
ORDER_CUSTOMERS = ["john smith", "jane doe", "robert brown", "emily davis", "michael wilson",
                   "sarah johnson", "david lee", "lisa anderson", "james taylor", "mary thomas"]
ORDER_PRODUCTS = ["Laptop", "Phone", "Tablet", "Monitor", "Keyboard", "Mouse", "Headphones", "Webcam"]
SHOP_CATEGORIES = ["Electronics", "Clothing", "Books", "Home", "Sports"]
SHOP_PRODUCTS = {
    "Electronics": [("P001", "Laptop"), ("P002", "Phone"), ("P003", "Tablet")],
    "Clothing": [("P004", "T-Shirt"), ("P005", "Jeans"), ("P006", "Jacket")],
    "Books": [("P007", "Python Book"), ("P008", "SQL Book"), ("P009", "ML Book")],
    "Home": [("P010", "Lamp"), ("P011", "Chair"), ("P012", "Table")],
    "Sports": [("P013", "Shoes"), ("P014", "Bag"), ("P015", "Bottle")],
}
SHOP_PRICES = {"P001": 800, "P002": 500, "P003": 350, "P004": 20, "P005": 40, "P006": 80,
               "P007": 30, "P008": 25, "P009": 45, "P010": 15, "P011": 120, "P012": 200,
               "P013": 60, "P014": 35, "P015": 10}
AIRLINES = ["IndiGo", "Air India", "SpiceJet", "Vistara", "GoAir"]
AIRPORTS = ["DEL", "BOM", "BLR", "HYD", "MAA", "CCU", "AMD", "PNQ"]
FLIGHT_STATUS_WEIGHTS = [("On Time", 0.6), ("Delayed", 0.3), ("Cancelled", 0.1)]
START_DATE = "2024-01-01"


def _pick(values: list, r: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(r * len(values)) + 1).cast("int"))


def _randint(lo: int, hi: int, seed: int) -> Column:
    return (F.floor(F.rand(seed) * (hi - lo + 1)) + lo).cast("int")


def _day(max_offset: int, seed: int) -> Column:
    return F.date_add(F.lit(START_DATE).cast("date"), _randint(0, max_offset, seed))


def gen_orders(spark: SparkSession, n: int = 100, seed: int = 42) -> DataFrame:
    """Cleaning-demo orders (all text, like the CSV): ``n`` random rows plus
    two duplicated ids and two rows with a non-positive amount."""
    base = spark.range(1, n + 1).select(
        F.format_string("ORD-%04d", F.col("id")).alias("order_id"),
        _pick(ORDER_CUSTOMERS, F.rand(seed)).alias("customer_name"),
        _pick(ORDER_PRODUCTS, F.rand(seed + 1)).alias("product"),
        F.round(F.rand(seed + 2) * 1990.0 + 10.0, 2).cast("string").alias("amount"),
        F.date_format(_day(365, seed + 3), "yyyy-MM-dd").alias("order_date"))
    extra = spark.createDataFrame([
        ("ORD-0001", "john smith", "Laptop", "999.99", "2024-01-01"),
        ("ORD-0002", "jane doe", "Phone", "599.99", "2024-01-02"),
        (f"ORD-{n + 1:04d}", "test user", "Tablet", "-50.0", "2024-03-01"),
        (f"ORD-{n + 2:04d}", "test user", "Monitor", "0", "2024-03-02"),
    ], base.schema)
    return base.unionByName(extra)


def gen_shop_orders(spark: SparkSession, n: int = 5000, seed: int = 42) -> DataFrame:
    """E-commerce orders: category → one of its three products, fixed price."""
    cat = _pick(SHOP_CATEGORIES, F.rand(seed))
    prod_idx = _randint(0, 2, seed + 1)
    ids = F.create_map(*[x for c, ps in SHOP_PRODUCTS.items()
                         for x in (F.lit(c), F.array(*[F.lit(p) for p, _ in ps]))])
    names = F.create_map(*[x for c, ps in SHOP_PRODUCTS.items()
                           for x in (F.lit(c), F.array(*[F.lit(nm) for _, nm in ps]))])
    prices = F.create_map(*[x for p, v in SHOP_PRICES.items() for x in (F.lit(p), F.lit(float(v)))])
    df = spark.range(1, n + 1).select(
        "id", cat.alias("category"), prod_idx.alias("pi"),
        F.date_format(_day(364, seed + 2), "yyyy-MM-dd").alias("order_date"),
        F.format_string("CUST%04d", _randint(1, 500, seed + 3)).alias("customer_id"),
        _randint(1, 5, seed + 4).alias("quantity"))
    pid = F.element_at(ids[F.col("category")], F.col("pi") + 1)
    return df.select(
        F.format_string("ORD%05d", F.col("id")).alias("order_id"), "order_date", "customer_id",
        pid.alias("product_id"),
        F.element_at(names[F.col("category")], F.col("pi") + 1).alias("product_name"),
        "category", "quantity", prices[pid].alias("unit_price"))


def gen_flights(spark: SparkSession, n: int = 5000, seed: int = 42) -> DataFrame:
    """Flights: two distinct airports, weighted status, delays only when Delayed."""
    r = F.rand(seed)
    status = F.when(r < 0.6, "On Time").when(r < 0.9, "Delayed").otherwise("Cancelled")
    o_idx = _randint(0, len(AIRPORTS) - 1, seed + 1)
    d_off = _randint(1, len(AIRPORTS) - 1, seed + 2)  # never the origin
    ports = F.array(*[F.lit(a) for a in AIRPORTS])
    df = spark.range(1, n + 1).select(
        "id", status.alias("status"), o_idx.alias("o"), d_off.alias("d"),
        _randint(0, 180, seed + 3).alias("dep"), _randint(-5, 20, seed + 4).alias("jitter"))
    delayed = F.col("status") == "Delayed"
    dep = F.when(delayed, F.col("dep")).otherwise(0)
    arr = F.when(delayed, F.greatest(F.col("dep") + F.col("jitter"), F.lit(0))).otherwise(0)
    return df.select(
        F.format_string("FL%05d", F.col("id")).alias("flight_id"),
        F.date_format(_day(364, seed + 5), "yyyy-MM-dd").alias("flight_date"),
        _pick(AIRLINES, F.rand(seed + 6)).alias("airline"),
        F.element_at(ports, F.col("o") + 1).alias("origin"),
        F.element_at(ports, ((F.col("o") + F.col("d")) % len(AIRPORTS)) + 1).alias("destination"),
        dep.alias("departure_delay_mins"), arr.alias("arrival_delay_mins"),
        _randint(300, 3000, seed + 7).alias("distance_km"), "status")

"""Airline job: delay by airline, busiest routes, daily trends.

The reference counts ``count(status == 'Delayed')``, which counts every
non-null status (contract 13). The intended ``count_if`` is built in the main
queries; ``flight_status_count_literal`` pins the literal behaviour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.money import (avg_2dp, avg_from_parts, cents_bigint, exact_sum, pct_2dp,
                                   sql_avg_2dp, sql_pct_2dp)
from cairn.plans._registry import query
from cairn.plans.standins import SQL_FLIGHTS, flights
from cairn.session import load


@query("delay_by_airline", f"""
SELECT airline,
       {sql_avg_2dp('departure_delay_mins')} AS avg_dep_delay_mins,
       {sql_avg_2dp('arrival_delay_mins')} AS avg_arr_delay_mins,
       COUNT(flight_id) AS total_flights,
       {sql_pct_2dp("COUNT(*) FILTER (WHERE status = 'Delayed')", 'COUNT(flight_id)')} AS delay_pct
FROM {SQL_FLIGHTS} f WHERE status <> 'Cancelled'
GROUP BY airline ORDER BY avg_dep_delay_mins DESC, airline""")
def delay_by_airline(spark: SparkSession, sf: str) -> DataFrame:
    f = flights(spark, sf)
    return (f.filter(F.col("status") != "Cancelled")
            .groupBy("airline")
            .agg(avg_2dp("departure_delay_mins", scale=2).alias("avg_dep_delay_mins"),
                 avg_2dp("arrival_delay_mins", scale=2).alias("avg_arr_delay_mins"),
                 F.count("flight_id").alias("total_flights"),
                 pct_2dp(F.count_if(F.col("status") == "Delayed"),
                         F.count("flight_id")).alias("delay_pct"))
            .orderBy(F.desc("avg_dep_delay_mins"), "airline"))


_ROUTES_SQL = f"""
SELECT concat_ws(' -> ', sn.n_name, cn.n_name) AS route,
       COUNT(l_orderkey) AS total_flights,
       {sql_avg_2dp('o_totalprice')} AS avg_dep_delay_mins
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation sn ON s_nationkey = sn.n_nationkey
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation cn ON c_nationkey = cn.n_nationkey
GROUP BY 1 ORDER BY total_flights DESC, route LIMIT 10"""


@query("top_routes", _ROUTES_SQL)
def top_routes(spark: SparkSession, sf: str) -> DataFrame:
    """Route = supplier nation -> customer nation, one flight per line item.

    Orders meet customers first (order-sized); the line items are then
    shuffled once on the order key and once on the supplier key; the stream
    is aggregated to nation pairs (≤ |nation|² rows, partial aggregate in
    every task) and only that small result is joined to the nation names.
    """
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    oc = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "c_nationkey", cents_bigint("o_totalprice").alias("delay_cents"))
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    su = load(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    pairs = (li.join(oc, li.l_orderkey == oc.o_orderkey)
             .join(su, F.col("l_suppkey") == su.s_suppkey)
             .groupBy("s_nationkey", "c_nationkey")
             .agg(F.count(F.lit(1)).alias("n"), exact_sum("delay_cents").alias("delay_cents")))
    nat = load(spark, sf, "nation").select("n_nationkey", "n_name")
    sn = nat.select(F.col("n_nationkey").alias("sk"), F.col("n_name").alias("origin"))
    cn = nat.select(F.col("n_nationkey").alias("ck"), F.col("n_name").alias("destination"))
    named = (pairs.join(sn, pairs.s_nationkey == sn.sk)
             .join(cn, pairs.c_nationkey == cn.ck)
             .withColumn("route", F.concat_ws(" -> ", "origin", "destination")))
    return (named.groupBy("route")
            .agg(F.sum("n").alias("total_flights"),
                 avg_from_parts(F.sum("delay_cents"), F.sum("n")).alias("avg_dep_delay_mins"))
            .orderBy(F.desc("total_flights"), "route")
            .limit(10))


@query("daily_flight_trends", f"""
SELECT flight_date, COUNT(flight_id) AS total_flights,
       {sql_avg_2dp('departure_delay_mins')} AS avg_dep_delay_mins,
       COUNT(*) FILTER (WHERE status = 'Cancelled') AS cancellations
FROM {SQL_FLIGHTS} f GROUP BY flight_date ORDER BY flight_date""")
def daily_flight_trends(spark: SparkSession, sf: str) -> DataFrame:
    return (flights(spark, sf).groupBy("flight_date")
            .agg(F.count("flight_id").alias("total_flights"),
                 avg_2dp("departure_delay_mins", scale=2).alias("avg_dep_delay_mins"),
                 F.count_if(F.col("status") == "Cancelled").alias("cancellations"))
            .orderBy("flight_date"))


@query("flight_status_count_literal", f"""
SELECT flight_date, COUNT(flight_id) AS total_flights,
       COUNT(status = 'Cancelled') AS cancellations,
       {sql_pct_2dp("COUNT(status = 'Delayed')", 'COUNT(flight_id)')} AS delay_pct
FROM {SQL_FLIGHTS} f GROUP BY flight_date ORDER BY flight_date""")
def flight_status_count_literal(spark: SparkSession, sf: str) -> DataFrame:
    """The reference's own expressions: ``count(bool)`` counts non-nulls."""
    st = F.col("status")
    return (flights(spark, sf).groupBy("flight_date")
            .agg(F.count("flight_id").alias("total_flights"),
                 F.count(st == "Cancelled").alias("cancellations"),
                 pct_2dp(F.count(st == "Delayed"), F.count("flight_id")).alias("delay_pct"))
            .orderBy("flight_date"))

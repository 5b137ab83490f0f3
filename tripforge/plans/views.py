"""Trips, points and dimensions derived from the driver's tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.operators.analytics import prepared


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips over fourteen months, with some missing and some negative times and stations."""
    e = F.col("event_id")
    at = F.date_trunc("SECOND", "ts").cast("timestamp_ntz") + F.make_ym_interval(F.lit(0), F.pmod(e, F.lit(14)).cast("int"))
    base = table(spark, sf_dir, "events").select("event_id", "user_id", "value", at.alias("s"))
    seconds = F.floor(F.col("value") * 60)
    end = F.when(e % 17 == 0, None).when(e % 23 == 0, F.col("s") - F.expr("interval 60 second")).otherwise(F.col("s") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")))
    return base.select(
        "event_id",
        F.when(e % 29 != 0, F.col("s")).alias("start_time"),
        end.alias("end_time"),
        F.when(e % 19 != 0, F.concat(F.lit("S"), (F.col("user_id") % 40).cast("string"))).alias("start_station_name"),
        F.concat(F.lit("S"), ((F.col("user_id") * 7 + e) % 40).cast("string")).alias("end_station_name"),
    )


EVENT_TRIPS = """te0 AS (SELECT event_id, user_id, value, date_trunc('second', ts) + to_months((event_id % 14)::INTEGER) AS s FROM events),
te AS (SELECT event_id, CASE WHEN event_id % 29 <> 0 THEN s END AS start_time,
              CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 23 = 0 THEN s - INTERVAL 60 SECOND ELSE s + to_seconds(floor(value * 60)::BIGINT) END AS end_time,
              CASE WHEN event_id % 19 <> 0 THEN 'S' || (user_id % 40) END AS start_station_name,
              'S' || ((user_id * 7 + event_id) % 40) AS end_station_name FROM te0),
t AS (SELECT *, datesub('second', start_time, end_time) AS duration, year(start_time) AS year, month(start_time) AS month, hour(start_time) AS hour, isodow(start_time) AS dow,
             coalesce(datesub('second', start_time, end_time) >= 0, false) AS ok FROM te)"""


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trips from a customer's nation at the order date to a supplier's at the ship date."""
    nations = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    out = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey")).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    out = out.join(nations.toDF("k1", "start_station_name"), F.col("c_nationkey") == F.col("k1")).join(nations.toDF("k2", "end_station_name"), F.col("s_nationkey") == F.col("k2"))
    return out.select(F.col("o_orderdate").cast("timestamp_ntz").alias("start_time"), F.col("l_shipdate").cast("timestamp_ntz").alias("end_time"), "start_station_name", "end_station_name")


ORDER_TRIPS = """te AS (SELECT o_orderdate AS start_time, l_shipdate AS end_time, a.n_name AS start_station_name, b.n_name AS end_station_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON s_nationkey = b.n_nationkey),
t AS (SELECT *, datesub('second', start_time, end_time) AS duration, year(start_time) AS year, month(start_time) AS month, coalesce(datesub('second', start_time, end_time) >= 0, false) AS ok FROM te)"""


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(event_trips(spark, sf_dir))


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event trips with text coordinates around a city, some broken or missing, and dockless ends."""
    e = F.col("event_id")
    base = event_trips(spark, sf_dir)

    def coordinate(name: str, low: float, step: float):
        k = F.substring(F.col(name), 2, 5).cast("int")
        noise = (e * 37 % 101 - 50) * 0.000001
        return F.when(e % 31 == 0, F.lit("n/a")).when(e % 37 == 0, F.lit(None)).when(e % 41 == 0, F.lit("0.0")).otherwise(F.format_string("%.6f", F.lit(low) + F.coalesce(k, F.lit(0)) * step + noise))

    out = base
    for end in ("start", "end"):
        name = f"{end}_station_name"
        out = out.withColumns({f"{end}_lat": coordinate(name, 60.38, 0.0008), f"{end}_lng": coordinate(name, 5.3, 0.001), f"{end}_station_id": F.when(e % 5 != 0, F.substring(F.col(name), 2, 5))})
    return out


_COORD = "CASE WHEN event_id % 31 = 0 THEN 'n/a' WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN '0.0' ELSE printf('%.6f', {low} + coalesce(substr({name}, 2)::INTEGER, 0) * {step} + (event_id * 37 % 101 - 50) * 0.000001) END"
LOCATED = (
    EVENT_TRIPS
    + ", o AS ("
    + " UNION ALL ".join(
        f"SELECT {e}_station_name AS station, CASE WHEN event_id % 5 <> 0 THEN substr({e}_station_name, 2) END AS id, TRY_CAST({_COORD.format(low=60.38, name=f'{e}_station_name', step=0.0008)} AS DOUBLE) AS lat, TRY_CAST({_COORD.format(low=5.3, name=f'{e}_station_name', step=0.001)} AS DOUBLE) AS lng, start_time::DATE AS date FROM te"
        for e in ("start", "end")
    )
    + ")"
)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as named points near 60.39 N: key, name, lat, lng, n_obs, first_seen, last_seen."""
    v = table(spark, sf_dir, "embeddings")
    k = F.col("vec_id")
    return v.select(
        F.concat(F.lit("P"), F.lpad(k.cast("string"), 9, "0")).alias("key"),
        F.concat(F.when(k % 7 == 0, "Temp ").otherwise(""), F.lit("Place "), (k % 211).cast("string")).alias("name"),
        (F.lit(60.39) + F.round(F.col("embedding")[0].cast("double"), 4) * 0.05).alias("lat"),
        (F.lit(5.32) + F.round(F.col("embedding")[1].cast("double"), 4) * 0.1).alias("lng"),
        (k % 13).cast("bigint").alias("n_obs"),
        F.date_add(F.lit("2020-01-01").cast("date"), (k % 400).cast("int")).alias("first_seen"),
        F.when(k % 11 != 0, F.date_add(F.lit("2021-06-01").cast("date"), (k * 3 % 500).cast("int"))).alias("last_seen"),
    )


POINTS = """p AS (SELECT 'P' || lpad(vec_id::VARCHAR, 9, '0') AS key, CASE WHEN vec_id % 7 = 0 THEN 'Temp ' ELSE '' END || 'Place ' || (vec_id % 211) AS name,
60.39::DOUBLE + round(embedding[1]::DOUBLE, 4) * 0.05::DOUBLE AS lat, 5.32::DOUBLE + round(embedding[2]::DOUBLE, 4) * 0.1::DOUBLE AS lng, vec_id % 13 AS n_obs,
DATE '2020-01-01' + (vec_id % 400)::INTEGER AS first_seen, CASE WHEN vec_id % 11 <> 0 THEN DATE '2021-06-01' + (vec_id * 3 % 500)::INTEGER END AS last_seen FROM embeddings)"""

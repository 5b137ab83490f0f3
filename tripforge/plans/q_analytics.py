"""Queries: summaries, stations, windows, clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripforge.operators import analytics as an
from tripforge.operators import fill, lookups, quality
from tripforge.operators import stations as st
from tripforge.plans.catalog import query
from tripforge.plans.views import EVENT_TRIPS, LOCATED, ORDER_TRIPS, POINTS, located, order_trips, points, trips

BOX = (60.375, 5.295, 60.41, 5.336)
_KEYS = "start_time IS NULL OR end_time IS NULL OR start_station_name IS NULL OR end_station_name IS NULL"


def _summary(view: str) -> str:
    rank = lambda q: f"min(duration) FILTER (WHERE cum > floor((n - 1) * {q} + 0.5))"
    return f"""WITH {view},
    c AS (SELECT year, duration, count(*) AS k FROM t WHERE ok AND duration IS NOT NULL GROUP BY ALL),
    r AS (SELECT *, sum(k) OVER (PARTITION BY year ORDER BY duration) AS cum, sum(k) OVER (PARTITION BY year) AS n FROM c),
    q AS (SELECT year, {rank(0.05)} AS d5, {rank(0.25)} AS d25, {rank(0.75)} AS d75, {rank(0.95)} AS d95 FROM r GROUP BY year),
    s AS (SELECT year, count(*) AS trip_count, count(*) FILTER (WHERE ok AND duration IS NOT NULL) AS valid_duration_count,
                 median(duration) FILTER (WHERE ok) AS duration_median, count(*) FILTER (WHERE {_KEYS}) AS null_rows FROM t GROUP BY year)
    SELECT s.year, trip_count, valid_duration_count, null_rows, d5 AS duration_5_percent, d25 AS duration_q1, d75 AS duration_q3, d95 AS duration_95_percent, duration_median
    FROM s LEFT JOIN q ON s.year IS NOT DISTINCT FROM q.year"""


@query(_summary(EVENT_TRIPS))
def summary_by_year(spark, sf_dir):
    return an.summary(trips(spark, sf_dir))


@query(_summary(ORDER_TRIPS))
def summary_by_year_orders(spark, sf_dir):
    return an.summary(an.prepared(order_trips(spark, sf_dir)))


@query(f"""WITH {ORDER_TRIPS}, c AS (SELECT start_station_name, duration, count(*) AS k FROM t WHERE ok GROUP BY ALL),
    r AS (SELECT *, sum(k) OVER (PARTITION BY start_station_name ORDER BY duration) AS cum, sum(k) OVER (PARTITION BY start_station_name) AS n FROM c)
    SELECT start_station_name, min(duration) FILTER (WHERE cum > floor((n - 1) * 0.05 + 0.5)) AS p5, min(duration) FILTER (WHERE cum > floor((n - 1) * 0.5 + 0.5)) AS p50,
           min(duration) FILTER (WHERE cum > floor((n - 1) * 0.95 + 0.5)) AS p95 FROM r GROUP BY 1""")
def duration_quantiles(spark, sf_dir):
    good = an.prepared(order_trips(spark, sf_dir)).where(an.valid())
    return an.nearest_rank(good, ["start_station_name"], "duration", {"p5": 0.05, "p50": 0.5, "p95": 0.95})


@query(f"WITH {EVENT_TRIPS} SELECT year, count(*) FILTER (WHERE {_KEYS}) AS null_rows, count(*) AS trips FROM t GROUP BY year")
def null_rows(spark, sf_dir):
    return an.null_rows(trips(spark, sf_dir))


@query(f"WITH {EVENT_TRIPS} SELECT year, (floor(least(duration, 7200) / 60) * 60)::BIGINT AS bucket, count(*) AS count, 'sample' AS city FROM t WHERE ok AND duration IS NOT NULL AND year IS NOT NULL GROUP BY 1, 2")
def duration_buckets(spark, sf_dir):
    return an.duration_buckets(trips(spark, sf_dir)).withColumn("city", F.lit("sample"))


@query(f"WITH {EVENT_TRIPS} SELECT year, month, count(*) AS trips FROM t WHERE year IS NOT NULL GROUP BY 1, 2")
def volume_by_month(spark, sf_dir):
    return an.volume(trips(spark, sf_dir), "year", "month")


@query(f"WITH {EVENT_TRIPS} SELECT year, hour, count(*) AS trips FROM t WHERE year IS NOT NULL GROUP BY 1, 2")
def by_hour(spark, sf_dir):
    return an.volume(trips(spark, sf_dir), "year", "hour")


@query(f"WITH {EVENT_TRIPS} SELECT year, dow, count(*) AS trips FROM t WHERE year IS NOT NULL GROUP BY 1, 2")
def by_dow(spark, sf_dir):
    return an.volume(trips(spark, sf_dir), "year", "dow")


@query(f"""WITH {EVENT_TRIPS}, e AS (SELECT year, start_station_name AS station, 1 AS s, 0 AS e FROM t UNION ALL SELECT year, end_station_name, 0, 1 FROM t)
    SELECT year, station, sum(s)::BIGINT AS start_trips, sum(e)::BIGINT AS end_trips, count(*) AS total_trips FROM e WHERE station IS NOT NULL AND year IS NOT NULL GROUP BY 1, 2""")
def stations_by_year(spark, sf_dir):
    return an.stations_by_year(trips(spark, sf_dir))


@query(f"""WITH {EVENT_TRIPS}, d AS (SELECT year, start_station_name AS station, count(*) AS n FROM t GROUP BY 1, 2),
    a AS (SELECT year, end_station_name AS station, count(*) AS n FROM t GROUP BY 1, 2)
    SELECT coalesce(d.year, a.year) AS year, coalesce(d.station, a.station) AS station, coalesce(d.n, 0) AS trips_from, coalesce(a.n, 0) AS trips_to FROM d FULL JOIN a ON d.year = a.year AND d.station = a.station""")
def station_flow(spark, sf_dir):
    return an.station_flow(trips(spark, sf_dir))


@query(f"""WITH {EVENT_TRIPS} SELECT year, count(*) AS trips, count(*) FILTER (WHERE start_station_name = end_station_name) AS round_trips,
    round(count(*) FILTER (WHERE start_station_name = end_station_name) / count(*), 4) AS round_trip_share FROM t WHERE year IS NOT NULL GROUP BY 1""")
def round_trip_share(spark, sf_dir):
    return an.round_trip_share(trips(spark, sf_dir))


@query(f"""WITH {EVENT_TRIPS}, b AS (SELECT year, CASE WHEN duration <= 300 THEN '<5' WHEN duration <= 900 THEN '5-15' WHEN duration <= 1800 THEN '15-30' WHEN duration <= 3600 THEN '30-60' ELSE '60+' END AS band,
    CASE WHEN duration <= 300 THEN 1 WHEN duration <= 900 THEN 2 WHEN duration <= 1800 THEN 3 WHEN duration <= 3600 THEN 4 ELSE 5 END AS band_order FROM t WHERE ok AND duration IS NOT NULL AND year IS NOT NULL)
    SELECT year, band, band_order, count(*) AS trips, round(count(*) / sum(count(*)) OVER (PARTITION BY year), 4) AS share FROM b GROUP BY 1, 2, 3""")
def duration_bands(spark, sf_dir):
    return an.duration_bands(trips(spark, sf_dir))


@query(f"""WITH {EVENT_TRIPS}, e AS (SELECT year, start_station_name AS station, 1 AS s FROM t UNION ALL SELECT year, end_station_name, 0 FROM t)
    SELECT year, station, sum(s)::BIGINT AS trips_from, sum(1 - s)::BIGINT AS trips_to FROM e WHERE station IS NOT NULL GROUP BY 1, 2""")
def station_trip_counts(spark, sf_dir):
    return an.station_trip_counts(trips(spark, sf_dir))[0]


@query(f"""WITH {EVENT_TRIPS}, e AS (SELECT year, start_station_name AS station, 1 AS s FROM t UNION ALL SELECT year, end_station_name, 0 FROM t)
    SELECT year, sum(s)::BIGINT AS dockless_from, sum(1 - s)::BIGINT AS dockless_to FROM e WHERE station IS NULL GROUP BY 1""")
def dockless_counts(spark, sf_dir):
    return an.station_trip_counts(trips(spark, sf_dir))[1]


@query(f"""WITH {EVENT_TRIPS}, e AS (SELECT year, start_station_name AS station, 1 AS s FROM t UNION ALL SELECT year, end_station_name, 0 FROM t),
    m AS (SELECT n_name AS name, 'S' || n_nationkey AS alias FROM nation UNION SELECT n_name, 'S' || (n_nationkey + 25) FROM nation WHERE n_nationkey < 10)
    SELECT year, coalesce(name, station) AS station, sum(s)::BIGINT AS trips_from, sum(1 - s)::BIGINT AS trips_to, bool_or(name IS NULL) AS unmatched
    FROM e LEFT JOIN m ON station = alias WHERE station IS NOT NULL GROUP BY 1, 2""")
def rollup_aliases(spark, sf_dir):
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    key = F.col("n_nationkey")
    one, two = F.concat(F.lit("S"), key.cast("string")), F.concat(F.lit("S"), (key + 25).cast("string"))
    canonical = nation.select(F.col("n_name").alias("name"), F.when(key < 10, F.array(one, two)).otherwise(F.array(one)).alias("aliases"))
    return an.roll_up(an.station_trip_counts(trips(spark, sf_dir))[0], canonical)


@query(f"WITH {LOCATED} SELECT station, id, lat, lng, date FROM o")
def station_observations(spark, sf_dir):
    return st.observations(located(spark, sf_dir))


_IN = f"lat IS NOT NULL AND lng IS NOT NULL AND lat BETWEEN {BOX[0]} AND {BOX[2]} AND lng BETWEEN {BOX[1]} AND {BOX[3]}"


@query(f"WITH {LOCATED} SELECT station, round(sum(lat) / count(*), 6) AS lat, round(sum(lng) / count(*), 6) AS lng, min(id) AS id, count(*) AS n_obs, min(date) AS first_seen, max(date) AS last_seen FROM o WHERE station IS NOT NULL AND {_IN} GROUP BY 1")
def station_points(spark, sf_dir):
    return st.station_points(st.observations(located(spark, sf_dir)), BOX)


@query(f"WITH {LOCATED} SELECT station, lat, lng, count(*) AS n_obs, min(date) AS first_seen, max(date) AS last_seen FROM o WHERE station IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL AND NOT ({_IN}) GROUP BY 1, 2, 3")
def rejected_points(spark, sf_dir):
    return st.rejected_points(st.observations(located(spark, sf_dir)), BOX)


@query(f"""WITH {LOCATED} SELECT count(*) AS ends, count(station) AS named, count(*) FILTER (WHERE station IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL) AS located,
    count(*) FILTER (WHERE station IS NOT NULL AND {_IN}) AS kept, count(*) FILTER (WHERE station IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL AND NOT ({_IN})) AS rejected,
    count(*) FILTER (WHERE station IS NULL AND lat IS NOT NULL AND lng IS NOT NULL) AS dockless,
    round(count(*) FILTER (WHERE station IS NOT NULL AND {_IN}) / count(station), 6) AS coverage, count(*) FILTER (WHERE station IS NOT NULL AND {_IN}) / count(station) >= 0.5 AS ok FROM o""")
def endpoint_coverage(spark, sf_dir):
    return quality.coverage(st.coverage_counts(st.observations(located(spark, sf_dir)), BOX), "kept", "named", 0.5)


@query(f"WITH {LOCATED} SELECT coalesce({_IN}, false) AS inside, count(*) AS n FROM o WHERE lat IS NOT NULL AND lng IS NOT NULL GROUP BY 1")
def bbox_split(spark, sf_dir):
    obs = st.observations(located(spark, sf_dir)).where("lat is not null and lng is not null")
    return obs.groupBy(st.in_box(BOX).alias("inside")).agg(F.count("*").alias("n"))


_NEAR = f"""{POINTS}, pairs AS (SELECT a.key AS a, b.key AS b FROM p a JOIN p b ON a.key < b.key AND abs(a.lat - b.lat) < 0.002
    WHERE 6371000.0 * sqrt(pow((b.lat - a.lat) * pi() / 180, 2) + pow((b.lng - a.lng) * pi() / 180 * cos((a.lat + b.lat) / 2 * pi() / 180), 2)) < 60)"""


@query(f"WITH {_NEAR} SELECT a, b FROM pairs")
def near_pairs(spark, sf_dir):
    return st.near_pairs(points(spark, sf_dir), 60.0)


_CLUSTERS = f"""WITH RECURSIVE {_NEAR}, e AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
    reach AS (SELECT key AS a, key AS b FROM p UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
    c AS (SELECT a AS key, min(b) AS cluster FROM reach GROUP BY 1)"""


@query(f"{_CLUSTERS} SELECT key, cluster FROM c")
def station_clusters(spark, sf_dir):
    return st.clusters(points(spark, sf_dir), 60.0)


_POOR = " OR ".join(f"contains(lower(name), '{w}')" for w in st.DEPRIORITIZED)
_CHOSEN = f"""m AS (SELECT p.*, cluster, row_number() OVER (PARTITION BY cluster ORDER BY (NOT ({_POOR}) AND n_obs >= 3) DESC, coalesce(last_seen::VARCHAR, '') DESC, n_obs DESC, key) AS r FROM p JOIN c USING (key))"""


@query(f"{_CLUSTERS}, {_CHOSEN} SELECT cluster, key, name, n_obs, last_seen FROM m WHERE r = 1")
def canonical_member(spark, sf_dir):
    p = points(spark, sf_dir)
    return st.canonical_members(p.join(st.clusters(p, 60.0), "key"), 3).select("cluster", "key", "name", "n_obs", "last_seen")


@query(f"""{_CLUSTERS}, {_CHOSEN}, x AS (SELECT cluster, name, lat, lng FROM m WHERE r = 1)
    SELECT x.name, round(x.lat, 9) AS lat, round(x.lng, 9) AS lng, min(m.first_seen) AS first_seen, max(m.last_seen) AS last_seen, coalesce(string_agg(DISTINCT m.name, '|' ORDER BY m.name) FILTER (WHERE m.name <> x.name), '') AS aliases
    FROM x JOIN m USING (cluster) GROUP BY x.cluster, x.name, x.lat, x.lng""")
def canonical_stations(spark, sf_dir):
    out = st.canonical_stations(points(spark, sf_dir), 60.0, 3)
    return out.select("name", F.round("lat", 9).alias("lat"), F.round("lng", 9).alias("lng"), "first_seen", "last_seen", F.array_join("aliases", "|").alias("aliases"))


@query("""WITH f AS (SELECT (vec_id % 97)::VARCHAR AS id, CASE WHEN vec_id % 10 > 0 THEN 'Place ' || (vec_id % 53) END AS name, 60.0::DOUBLE + round(embedding[1]::DOUBLE, 4) AS lat, 5.0::DOUBLE + round(embedding[2]::DOUBLE, 4) AS lng, vec_id AS seen FROM embeddings),
    n AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY id ORDER BY seen DESC) = 1),
    b AS (SELECT * FROM n WHERE name IS NOT NULL AND lat BETWEEN 59.5 AND 60.5 AND lng BETWEEN 4.5 AND 5.5)
    SELECT name AS station, lat, lng, id, 1::BIGINT AS n_obs, NULL::DATE AS first_seen, NULL::DATE AS last_seen FROM b QUALIFY row_number() OVER (PARTITION BY name ORDER BY seen DESC) = 1""")
def station_points_from_file(spark, sf_dir):
    v, k = spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id")
    rows = v.select((k % 97).cast("string").alias("id"), F.when(k % 10 > 0, F.concat(F.lit("Place "), (k % 53).cast("string"))).alias("name"), (F.lit(60.0) + F.round(F.col("embedding")[0].cast("double"), 4)).alias("lat"), (F.lit(5.0) + F.round(F.col("embedding")[1].cast("double"), 4)).alias("lng"), k.alias("seen"))
    return st.points_from_file(rows, "seen", (59.5, 4.5, 60.5, 5.5))


@query("""WITH b AS (SELECT o_orderkey, o_custkey % 20 AS file, CASE WHEN o_orderkey % 3 = 0 THEN year(o_orderdate) END AS v FROM orders),
    w AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY file ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lo,
                 first_value(v IGNORE NULLS) OVER (PARTITION BY file ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi FROM b)
    SELECT o_orderkey, file, v::INTEGER AS v, CASE WHEN v IS NOT NULL THEN v WHEN lo = hi THEN lo END::INTEGER AS filled FROM w""")
def sandwich_fill(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = o.select("o_orderkey", (F.col("o_custkey") % 20).alias("file"), F.when(F.col("o_orderkey") % 3 == 0, F.year("o_orderdate")).alias("v"))
    return fill.sandwich_fill(rows, "file", "o_orderkey", "v", "filled", block_rows=5_000)


@query("""WITH b AS (SELECT o_custkey % 20 AS file, o_orderdate >= lag(o_orderdate) OVER (PARTITION BY o_custkey % 20 ORDER BY o_orderkey) AS up FROM orders)
    SELECT file, round(avg(up::INTEGER), 6) AS share, count(*) AS n FROM b GROUP BY 1""")
def monotonic_fraction(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select((F.col("o_custkey") % 20).alias("file"), "o_orderkey", "o_orderdate")
    return fill.monotonic_share(o, "file", "o_orderkey", "o_orderdate")


@query("SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_per_key(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return lookups.latest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"])


@query(f"WITH {EVENT_TRIPS} SELECT event_id, duration FROM t WHERE ok AND duration IS NOT NULL")
def valid_trips(spark, sf_dir):
    return trips(spark, sf_dir).where(an.valid()).select("event_id", "duration")


@query(f"WITH {EVENT_TRIPS} SELECT event_id, duration FROM t")
def derive_duration(spark, sf_dir):
    return trips(spark, sf_dir).select("event_id", "duration")


@query(f"WITH {EVENT_TRIPS} SELECT event_id, year, month, hour, dow FROM t")
def calendar_parts(spark, sf_dir):
    return trips(spark, sf_dir).select("event_id", "year", "month", "hour", "dow")

"""Queries: lookups, reference tables, incremental processing, merging, sources and sinks."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.operators import analytics as an
from tripforge.operators import incremental, lookups, publish, quality, reference_tables, stations
from tripforge.operators import columns as cols
from tripforge.plans import feeds
from tripforge.plans.catalog import query
from tripforge.plans.views import EVENT_TRIPS, ORDER_TRIPS, event_trips, order_trips, table, trips
from tripforge.sources import files as src
from tripforge.sources import lines as ln
from tripforge.work import fresh_path, saved


def _line_trips(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("start_station_id"), (F.col("l_partkey") % 120).cast("string").alias("end_station_id"))


def _suppliers(spark, sf_dir):
    return table(spark, sf_dir, "supplier").where("s_suppkey % 10 <> 3").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))


_LINES = "l AS (SELECT l_orderkey, l_linenumber, l_suppkey::VARCHAR AS start_station_id, (l_partkey % 120)::VARCHAR AS end_station_id FROM lineitem), d AS (SELECT s_suppkey::VARCHAR AS id, s_name AS name FROM supplier WHERE s_suppkey % 10 <> 3)"


@query(f"""WITH {_LINES} SELECT l_orderkey, l_linenumber, start_station_id, end_station_id,
    coalesce(a.name, CASE WHEN start_station_id IN ('3', '13', '0') THEN 'Unknown (id ' || start_station_id || ')' END) AS start_station_name,
    coalesce(b.name, CASE WHEN end_station_id IN ('3', '13', '0') THEN 'Unknown (id ' || end_station_id || ')' END) AS end_station_name FROM l LEFT JOIN d a ON start_station_id = a.id LEFT JOIN d b ON end_station_id = b.id""")
def lookup_names_left(spark, sf_dir):
    return lookups.name_both_ends(_line_trips(spark, sf_dir), _suppliers(spark, sf_dir), ["3", "13", "0"])


@query(f"""WITH {_LINES}, m AS (SELECT s_suppkey::VARCHAR AS legacy_id, (s_suppkey % 50 + 1)::VARCHAR AS new_id FROM supplier WHERE s_suppkey % 4 <> 0)
    SELECT l_orderkey, l_linenumber, a.name AS start_station_name, b.name AS end_station_name FROM l JOIN m x ON start_station_id = x.legacy_id JOIN m y ON end_station_id = y.legacy_id JOIN d a ON x.new_id = a.id JOIN d b ON y.new_id = b.id""")
def lookup_names_inner(spark, sf_dir):
    mapping = table(spark, sf_dir, "supplier").where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").cast("string").alias("legacy_id"), (F.col("s_suppkey") % 50 + 1).cast("string").alias("new_id"))
    out = lookups.renumber_and_name(_line_trips(spark, sf_dir), mapping, _suppliers(spark, sf_dir), on_missing="drop")
    return out.select("l_orderkey", "l_linenumber", "start_station_name", "end_station_name")


_YEARLY = "y AS (SELECT 1995 + p_partkey % 4 AS year, (p_partkey % 60)::VARCHAR AS code, p_name AS name FROM part WHERE p_partkey % 7 > 0)"


@query(f"""WITH {_YEARLY}, e AS (SELECT year, code, max(name) AS name FROM y GROUP BY 1, 2), f AS (SELECT code, name FROM e QUALIFY row_number() OVER (PARTITION BY code ORDER BY year DESC, name DESC) = 1),
    l AS (SELECT l_orderkey, l_linenumber, year(l_shipdate) AS year, (l_partkey % 64)::VARCHAR AS s, (l_suppkey % 64)::VARCHAR AS t FROM lineitem)
    SELECT l_orderkey, l_linenumber, coalesce(a.name, b.name) AS start_station_name, coalesce(c.name, d.name) AS end_station_name
    FROM l LEFT JOIN e a ON a.year = l.year AND a.code = s LEFT JOIN f b ON b.code = s LEFT JOIN e c ON c.year = l.year AND c.code = t LEFT JOIN f d ON d.code = t""")
def lookup_by_year_fallback(spark, sf_dir):
    k = F.col("p_partkey")
    yearly = table(spark, sf_dir, "part").where(k % 7 > 0).select((F.lit(1995) + k % 4).cast("int").alias("year"), (k % 60).cast("string").alias("code"), F.col("p_name").alias("name"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("start_time"), (F.col("l_partkey") % 64).cast("string").alias("start_station_code"), (F.col("l_suppkey") % 64).cast("string").alias("end_station_code"))
    return lookups.name_by_year(rows, yearly).select("l_orderkey", "l_linenumber", "start_station_name", "end_station_name")


@query(f"WITH {_LINES}, u AS (SELECT start_station_id AS id FROM l UNION SELECT end_station_id FROM l) SELECT id FROM u WHERE id NOT IN (SELECT id FROM d) AND id NOT IN ('13', '0')")
def uncovered_ids(spark, sf_dir):
    return lookups.uncovered_ids(_line_trips(spark, sf_dir), _suppliers(spark, sf_dir), ["13", "0"])


@query(f"WITH {_LINES} SELECT DISTINCT (p_partkey % 997)::VARCHAR AS id FROM part WHERE (p_partkey % 997)::VARCHAR IN (SELECT id FROM d)")
def stale_allowlist(spark, sf_dir):
    allowed = table(spark, sf_dir, "part").select((F.col("p_partkey") % 997).cast("string").alias("id")).distinct()
    return lookups.stale_allowlist(allowed, _suppliers(spark, sf_dir))


@query(f"WITH {_LINES} SELECT DISTINCT start_station_id AS key FROM l LEFT JOIN d ON start_station_id = id WHERE name IS NULL ORDER BY key LIMIT 25")
def unresolved_names(spark, sf_dir):
    named = lookups.name_both_ends(_line_trips(spark, sf_dir), _suppliers(spark, sf_dir))
    return lookups.unresolved_names(named, "start_station_id", "start_station_name")


@query("""WITH c AS (SELECT DISTINCT year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders WHERE o_orderstatus = 'F'), j AS (SELECT DISTINCT year(l_shipdate) AS year, month(l_shipdate) AS month, 'm' || month(l_shipdate) AS file FROM lineitem)
    SELECT year, month, file FROM j WHERE (year, month) NOT IN (SELECT (year, month) FROM c)""")
def dedup_periods(spark, sf_dir):
    have = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    other = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).distinct().withColumn("file", F.concat(F.lit("m"), F.col("month").cast("string")))
    return lookups.periods_not_covered(have, other)


@query("SELECT trim(l_suppkey::VARCHAR) AS id, l_shipmode AS name FROM (SELECT l_suppkey, l_returnflag || l_linestatus AS l_shipmode, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey DESC, l_returnflag || l_linestatus DESC) AS r FROM lineitem) WHERE r = 1")
def station_list_latest(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit(" "), F.col("l_suppkey").cast("string")).alias("Kiosk ID"), F.concat("l_returnflag", "l_linestatus").alias("Kiosk Name"), "l_orderkey")
    return lookups.station_list(rows, ["Station_ID", "Kiosk ID"], ["Station_Name", "Kiosk Name"], "l_orderkey")


def _old_new(spark, sf_dir):
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier")
    old = s.where(k % 3 > 0).select(k.cast("string").alias("id"), F.col("s_name").alias("name"), F.format_string("%.6f", F.col("s_acctbal") / 1000).alias("lat"))
    new = s.where(k % 5 > 0).select(k.cast("string").alias("id"), F.when(k % 7 == 0, F.concat("s_name", F.lit(" B"))).when(k % 11 == 0, None).otherwise(F.col("s_name")).alias("name"), F.when(k % 13 == 0, "0.000000").otherwise(F.format_string("%.6f", F.col("s_acctbal") / 1000)).alias("lat"))
    return old, new


_OLD_NEW = """o AS (SELECT s_suppkey::VARCHAR AS id, s_name AS name, printf('%.6f', s_acctbal / 1000) AS lat FROM supplier WHERE s_suppkey % 3 > 0),
    n AS (SELECT s_suppkey::VARCHAR AS id, CASE WHEN s_suppkey % 7 = 0 THEN s_name || ' B' WHEN s_suppkey % 11 = 0 THEN NULL ELSE s_name END AS name, CASE WHEN s_suppkey % 13 = 0 THEN '0.000000' ELSE printf('%.6f', s_acctbal / 1000) END AS lat FROM supplier WHERE s_suppkey % 5 > 0)"""


@query(f"WITH {_OLD_NEW} SELECT coalesce(n.id, o.id) AS id, coalesce(n.name, o.name) AS name, coalesce(n.lat, o.lat) AS lat FROM o FULL JOIN n ON o.id = n.id")
def scd_upsert(spark, sf_dir):
    return reference_tables.upsert(*_old_new(spark, sf_dir), "id", ["name", "lat"])[0]


@query(f"""WITH {_OLD_NEW} SELECT n.id, 'added' AS change FROM n WHERE id NOT IN (SELECT id FROM o) UNION ALL SELECT n.id, 'name' FROM n JOIN o USING (id) WHERE n.name IS NOT NULL AND n.name IS DISTINCT FROM o.name
    UNION ALL SELECT n.id, 'lat' FROM n JOIN o USING (id) WHERE n.lat IS NOT NULL AND n.lat IS DISTINCT FROM o.lat""")
def scd_upsert_report(spark, sf_dir):
    return reference_tables.upsert(*_old_new(spark, sf_dir), "id", ["name", "lat"])[1]


@query(f"WITH {_OLD_NEW}, m AS (SELECT coalesce(n.id, o.id) AS id, coalesce(n.name, o.name) AS name, coalesce(n.lat, o.lat) AS lat FROM o FULL JOIN n ON o.id = n.id) SELECT (SELECT count(*) FROM (SELECT * FROM m EXCEPT ALL SELECT * FROM o)) > 0 AS differs, count(*) AS rows FROM m")
def scd_noop(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    merged = reference_tables.upsert(old, new, "id", ["name", "lat"])[0]
    return merged.agg(F.lit(reference_tables.differs(old, merged)).alias("differs"), F.count("*").alias("rows"))


def _manifests(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    path = F.concat(F.lit("f"), k.cast("string"))
    stored = o.where(k % 5 > 0).select(path.alias("path"), F.col("o_custkey").alias("length"), F.col("o_orderdate").alias("modified"))
    current = o.where(k % 7 > 0).select(path.alias("path"), F.when(k % 11 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("length"), F.when(k % 13 == 0, F.col("o_orderdate") + F.expr("interval 1 day")).otherwise(F.col("o_orderdate")).alias("modified"))
    return current, stored


@query("""SELECT 'f' || o_orderkey AS path, CASE WHEN o_orderkey % 5 = 0 THEN 'new' WHEN o_orderkey % 7 = 0 THEN 'removed' WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN 'changed' ELSE 'unchanged' END AS status FROM orders WHERE o_orderkey % 5 > 0 OR o_orderkey % 7 > 0""")
def manifest_diff(spark, sf_dir):
    return incremental.diff(*_manifests(spark, sf_dir))


@query("""WITH r AS (SELECT o_orderkey AS k, unnest(['out' || (o_orderkey // 2), 'own' || o_orderkey]) AS output FROM orders WHERE o_orderkey % 5 > 0)
    SELECT DISTINCT output FROM r WHERE k % 7 = 0 AND output NOT IN (SELECT output FROM r WHERE k % 7 > 0)""")
def orphan_outputs(spark, sf_dir):
    current, stored = _manifests(spark, sf_dir)
    k = F.substring("path", 2, 20).cast("bigint")
    recorded = stored.select("path", F.array(F.concat(F.lit("out"), F.floor(k / 2).cast("string")), F.concat(F.lit("own"), k.cast("string"))).alias("outputs"))
    return incremental.orphan_outputs(recorded, current)


#: The order trips beside the event trips in one statement.
_ORDERS2 = re.sub(r"\bt AS", "t2 AS", re.sub(r"\bte\b", "te2", ORDER_TRIPS))


@query(f"WITH {EVENT_TRIPS}, x AS (SELECT 'events' AS city, year, count(*) AS trips FROM t WHERE year IS NOT NULL GROUP BY 2), {_ORDERS2} SELECT city, year, trips FROM x UNION ALL SELECT 'orders', year, count(*) FROM t2 WHERE year IS NOT NULL GROUP BY 2")
def merge_summaries(spark, sf_dir):
    one = lambda t: t.groupBy("year").agg(F.count("*").alias("trips"))
    return publish.merge_summaries({"orders": one(an.prepared(order_trips(spark, sf_dir))), "events": one(trips(spark, sf_dir))})


@query("SELECT n_name AS city, year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS trips FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3")
def publish_merge(spark, sf_dir):
    """One section of several cities, merged behind the gates; the cities are nations."""
    nation = table(spark, sf_dir, "nation")
    base = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    # every city's section comes from this one small result
    volume = saved(base.groupBy("n_name", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.count("*").alias("trips")), "volume")
    names = [r.n_name for r in volume.select("n_name").distinct().orderBy("n_name").collect()]
    return publish.merge_section({n: {"volume": volume.where(F.col("n_name") == n).drop("n_name")} for n in names}, publish.Output("volume_by_month", "volume", ("city", "year", "month")))


@query("SELECT n_name AS city FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)")
def missing_sections(spark, sf_dir):
    nation, rich = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier").where("s_acctbal > 9000")
    return quality.missing_sections(nation.select(F.col("n_name").alias("city"), "n_nationkey"), rich.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("city"))).select("city")


@query("SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query("""SELECT array_to_string(list_sort(json_keys(props)), ',') AS fields, count(DISTINCT user_id) AS cities FROM events GROUP BY 1""")
def field_mismatches(spark, sf_dir):
    return quality.field_mismatches(table(spark, sf_dir, "events").select(F.col("user_id").alias("city"), F.col("props").alias("record")))


@query("SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY 1")
def parquet_scan(spark, sf_dir):
    lines = spark.read.schema("l_quantity double, l_returnflag string, l_shipdate timestamp_ntz").parquet(f"{sf_dir}/lineitem.parquet")
    return lines.where(F.col("l_shipdate") >= "1997-01-01").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query(f"WITH {EVENT_TRIPS} SELECT year, month, count(*) AS trips, count(end_time) AS ended FROM t GROUP BY 1, 2")
def partitioned_trips(spark, sf_dir):
    """The trip table written by year and month and read back; trips without a start are in the null partition."""
    t = event_trips(spark, sf_dir).withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
    path = fresh_path(spark, "trips")
    feeds.write_trips(t, path)
    return spark.read.parquet(path).groupBy("year", "month").agg(F.count("*").alias("trips"), F.count("end_time").alias("ended"))


@query("SELECT s_suppkey::VARCHAR AS id, CASE WHEN s_suppkey % 9 = 0 THEN NULL WHEN s_suppkey % 8 = 0 THEN '' ELSE s_name END AS name, s_nationkey::VARCHAR AS k FROM supplier")
def scan_csv_roundtrip(spark, sf_dir):
    """CSV with a missing, an empty and a plain text, as gzip with semicolons, read back as text."""
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(k.cast("string").alias("id"), F.when(k % 9 == 0, None).when(k % 8 == 0, "").otherwise(F.col("s_name")).alias("name"), F.col("s_nationkey").cast("string").alias("k"))
    path = fresh_path(spark, "csv")
    s.write.option("header", True).option("sep", ";").option("compression", "gzip").option("emptyValue", '""').option("nullValue", "").csv(path)
    return src.read_csv(spark, path, ["id", "name", "k"], sep=";")


@query("""SELECT doc_id::VARCHAR AS id, md5(replace(replace(text, 'e ', '" '), 'a', chr(92) || '"')) AS digest, length(text) + length(regexp_replace(text, '[^a]', '', 'g')) AS chars, lang FROM documents""")
def csv_quotes(spark, sf_dir):
    """Texts with doubled quotes, backslashes, separators and line breaks as CSV files, read back."""
    quoted = F.replace(F.replace("text", F.lit("e "), F.lit('" ')), F.lit("a"), F.lit('\\"'))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), quoted.alias("text"), "lang")
    path = fresh_path(spark, "csv")
    whole = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    docs.write.options(header=True, quote='"', escape='"', emptyValue='""', nullValue="", **whole).csv(path)
    back = src.read_csv(spark, path, ["id", "text", "lang"])
    return back.select("id", F.md5(F.col("text").cast("binary")).alias("digest"), F.length("text").alias("chars"), "lang")


@query(f"WITH {EVENT_TRIPS} SELECT 'events' AS city, event_id, start_time, end_time, start_station_name, end_station_name, CASE WHEN event_id % 2 = 0 THEN 'classic' ELSE 'electric' END AS bike_type FROM te")
def feed_steps(spark, sf_dir):
    """Raw text trips through a feed's declared steps, gates included."""
    e = F.col("event_id")
    shown = lambda c: F.when(e % 2 == 0, F.date_format(c, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(c, "M/d/yyyy H:mm:ss"))
    raw = event_trips(spark, sf_dir).select("event_id", shown("start_time").alias("Start date"), shown("end_time").alias("End date"), F.col("start_station_name").alias("From"), F.col("end_station_name").alias("To"), F.when(e % 2 == 0, "docked_bike").otherwise("EFIT G5").alias("Model"))
    spec = feeds.FeedSpec(
        "events",
        ["rename", "parse_times", "bike_type", "select_final"],
        rename={"Start date": "start_time", "End date": "end_time", "From": "start_station_name", "To": "end_station_name", "Model": "bike_type"},
        formats=["y-M-d H:m:s", "M/d/y H:m:s"],
        final={"event_id": "bigint", **feeds.BASE_COLUMNS, "bike_type": "string"},
    )
    return feeds.apply_steps(raw, spec).select(F.lit(spec.name).alias("city"), *spec.final)


def _written(df, path, sep):
    """Text files of `df` and their paths."""
    df.write.option("header", True).option("sep", sep).csv(path)
    return [r.path for r in incremental.manifest(df.sparkSession, path, "*.csv").orderBy("path").collect()]


@query(f"""WITH {EVENT_TRIPS} SELECT 'events' AS city, event_id, start_time, end_time, start_station_name || CASE WHEN event_id % 2 = 0 THEN ';a' ELSE ', b' END AS start_station_name, end_station_name,
    CASE WHEN event_id % 2 = 0 THEN 'classic' WHEN event_id % 3 = 0 THEN NULL ELSE 'electric' END AS bike_type, year, month FROM t""")
def feed_files(spark, sf_dir):
    """Event trips as text files of two eras, one with semicolons, one with commas and a file era more, read back as one feed each."""
    e = F.col("event_id")
    t = event_trips(spark, sf_dir)
    shown = lambda c, p: F.date_format(c, p)
    old = t.where(e % 2 == 0).select("event_id", shown("start_time", "M/d/yyyy H:mm:ss").alias("Start; date"), shown("end_time", "M/d/yyyy H:mm:ss").alias("End date"), F.concat("start_station_name", F.lit(";a")).alias("From"), F.col("end_station_name").alias("To"), F.lit("docked_bike").alias("Model"))
    new = t.where(e % 2 == 1).select("event_id", shown("start_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("started_at"), shown("end_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("ended_at"), F.concat("start_station_name", F.lit(", b")).alias("start_station_name"), "end_station_name", F.when(e % 3 > 0, "EFIT G5").alias("rideable_type"))
    steps = ["rename", "drop_all_null", "parse_times", "bike_type", "select_final"]
    final = {"event_id": "bigint", **feeds.BASE_COLUMNS, "bike_type": "string"}
    one = feeds.FeedSpec("events", steps, sep=";", rename={"Start; date": "start_time", "End date": "end_time", "From": "start_station_name", "To": "end_station_name", "Model": "bike_type"}, final=final, formats=["M/d/y H:m:s"])
    two = feeds.FeedSpec("events", steps, rename={"started_at": "start_time", "ended_at": "end_time", "rideable_type": "bike_type"}, final=final, exclude=["none"])
    # of the comma era, some files lack the kind of bike
    folder = fresh_path(spark, "feed")
    commas = _written(new.where(e % 3 > 0), f"{folder}/1", ",") + _written(new.where(e % 3 == 0).drop("rideable_type"), f"{folder}/2", ",")
    both = feeds.read_feed(spark, one, _written(old, f"{folder}/0", ";")).unionByName(feeds.read_feed(spark, two, commas))
    return both.drop("source_file")


@query(f"""WITH {EVENT_TRIPS}, b AS (SELECT *, event_id % 100 = 7 AS clock, event_id % 150 = 11 AS vehicle, event_id % 90 = 5 AS wide FROM t)
    SELECT 'trips' AS step, NULL AS value, count(*) AS n, sum(event_id)::BIGINT AS ids FROM b WHERE NOT (clock OR vehicle OR wide)
    UNION ALL SELECT 'start_time', 'noon', count(*), NULL FROM b WHERE clock AND NOT wide
    UNION ALL SELECT 'bike_type', 'unicycle', count(*), NULL FROM b WHERE vehicle AND NOT wide
    UNION ALL SELECT 'row of another width', NULL, count(*), NULL FROM b WHERE wide""")
def feed_quarantine(spark, sf_dir):
    """A feed with bad values and rows of another width, parsed once: the trips that are kept, and the findings of the others by check."""
    e = F.col("event_id")
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    t = event_trips(spark, sf_dir)
    there = lambda c: F.coalesce(c, F.lit(""))
    cells = [e.cast("string"), F.when(e % 100 == 7, "noon").otherwise(there(shown("start_time"))), there(shown("end_time")), there("start_station_name"), there("end_station_name"), F.when(e % 150 == 11, "unicycle").otherwise("docked_bike")]
    lines = t.select(F.concat_ws(",", *cells, F.when(e % 90 == 5, "more")).alias("line"))
    folder = fresh_path(spark, "feed")
    header = "event_id,start_time,end_time,start_station_name,end_station_name,bike_type"
    # the line's column name is the header, so that the files are CSV with rows of two widths
    plain = {"header": True, "quote": "\u0000", "sep": "\u0001"}
    lines.toDF(header).write.options(**plain).csv(f"{folder}/files")
    spec = feeds.FeedSpec("events", ["parse_times", "bike_type", "select_final"], final={"event_id": "bigint", **feeds.BASE_COLUMNS, "bike_type": "string"})
    feeds.publish_feed(spark, spec, [r.path for r in incremental.manifest(spark, f"{folder}/files", "*.csv").orderBy("path").collect()], f"{folder}/trips", f"{folder}/dead")
    kept = spark.read.parquet(f"{folder}/trips").agg(F.lit("trips").alias("step"), F.lit(None).cast("string").alias("value"), F.count("*").alias("n"), F.sum("event_id").alias("ids"))
    shown_value = F.when(F.col("step") != feeds.WIDTH, F.col("value")).alias("value")
    found = spark.read.parquet(f"{folder}/dead").groupBy("step", shown_value).agg(F.count("*").alias("n"), F.lit(None).cast("bigint").alias("ids"))
    return kept.unionByName(found)


@query(f"""WITH {EVENT_TRIPS} SELECT year, month, count(*) AS trips, sum(event_id)::BIGINT AS ids FROM t WHERE event_id % 4 IN (0, 3) OR (event_id % 4 = 1 AND event_id % 8 < 4) GROUP BY 1, 2""")
def incremental_apply(spark, sf_dir):
    """Two incremental runs over files of event trips: some files stay, one kind is replaced by fewer rows, one goes, one is new."""
    e = F.col("event_id")
    t = event_trips(spark, sf_dir).select("event_id", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("start_time", "end_time")], "start_station_name", "end_station_name")
    folder = fresh_path(spark, "inputs")
    table_path, state = fresh_path(spark, "trips"), fresh_path(spark, "state")
    feed = feeds.FeedSpec("events", ["parse_times", "select_final"], final={"event_id": "bigint", **feeds.BASE_COLUMNS})
    put = lambda k, name, keep: t.where((e % 4 == k) & keep).write.option("header", True).csv(f"{folder}/{name}")
    whole = F.lit(True)
    for k in (0, 1, 2):
        put(k, f"a{k}", whole)
    put(1, "b1", e % 8 < 4)
    put(3, "b3", whole)
    files = saved(incremental.manifest(spark, folder, "*.csv"), "files")
    for kept in (["/a0/", "/a1/", "/a2/"], ["/a0/", "/b1/", "/b3/"]):
        now = files.where(src.wanted_path(F.concat("path", F.lit("/")), exclude=[f"/{x}/" for x in ("a0", "a1", "a2", "b1", "b3") if f"/{x}/" not in kept]))
        incremental.run(spark, now, state, lambda paths: feeds.read_feed(spark, feed, paths, settle=False), table_path)
    return spark.read.parquet(table_path).groupBy("year", "month").agg(F.count("*").alias("trips"), F.sum("event_id").alias("ids"))


@query(f"""WITH {EVENT_TRIPS}, k AS (SELECT year, month, event_id FROM t WHERE event_id % 3 <> 1 OR event_id % 2 = 0)
    SELECT year, month, count(*) AS trips, sum(event_id)::BIGINT AS ids, 'kept,kept,processed' AS statuses, 2 AS cleaned FROM k GROUP BY 1, 2""")
def incremental_chain(spark, sf_dir):
    """Raw lines to cleaned lines to months, twice; between the runs one input of three is replaced by fewer rows, and only it goes through the stages again."""
    e = F.col("event_id")
    shown = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    t = event_trips(spark, sf_dir)
    line = F.concat_ws(";", e.cast("string"), shown("start_time"), shown("end_time"), F.coalesce("start_station_name", F.lit("")), "end_station_name")
    folder = fresh_path(spark, "chain")
    header = "event_id;start_time;end_time;start_station_name;end_station_name"
    spec = feeds.FeedSpec("events", ["parse_times", "select_final"], final={"event_id": "bigint", **feeds.BASE_COLUMNS}, headers=[("", header.replace(";", ","))])
    raw = saved(t.select(F.concat(F.lit("in"), (e % 3).cast("string")).alias("path"), e.alias("n"), (e % 2 == 0).alias("even"), line.alias("line")), "raw")

    def clean(old: bool):
        def make(paths):
            rows = raw.where(F.col("path").isin(paths) & (F.lit(old) | (F.col("path") != "in1") | F.col("even")))
            kept = ln.cleaned(rows.withColumnRenamed("path", "file"), delimiters=True)
            return kept.select(F.col("file").alias("source_file"), incremental.output_name("file").alias("output"), F.lit(0).cast("long").alias("start"), "n", "line")

        return incremental.FileStage(make, f"{folder}/clean", f"{folder}/clean-state")

    for old in (True, False):
        at = F.when((F.col("path") == "in1") & F.lit(not old), F.lit("2024-01-02 00:00:00")).otherwise("2024-01-01 00:00:00").cast("timestamp_ntz")
        now = raw.groupBy("path").agg(F.count_if(F.lit(old) | (F.col("path") != "in1") | F.col("even")).alias("length")).withColumn("modified", at)
        states = incremental.run_chain(spark, now, [clean(old)], lambda paths: feeds.read_feed(spark, spec, incremental.lines_of(spark, paths), settle=False), f"{folder}/trips", f"{folder}/state")
    told = [",".join(sorted(r.status for r in m.select("status").collect())) for m in states]
    out = spark.read.parquet(f"{folder}/trips").groupBy("year", "month").agg(F.count("*").alias("trips"), F.sum("event_id").alias("ids"))
    return out.withColumns({"statuses": F.lit(told[0]), "cleaned": F.lit(told[1].count("kept"))})


@query(f"WITH {EVENT_TRIPS} SELECT event_id, start_time, end_time, CASE WHEN event_id % 2 = 0 THEN 'classic' END AS bike_type FROM t")
def era_dispatch(spark, sf_dir):
    """Two eras told apart by their columns: one with a kind of bike and plain times, one with times that carry an offset."""
    e = F.col("event_id")
    spec = feeds.FeedSpec(
        "events", ["by_era", "select_final"], final={"event_id": "bigint", "start_time": "timestamp_ntz", "end_time": "timestamp_ntz", "bike_type": "string"}, rename={"started": "start_time", "ended": "end_time", "model": "bike_type"},
        eras=[{"has": ["model"], "steps": ["rename", "parse_times", "bike_type"]}, {"has": ["started"], "steps": ["rename", "parse_offset_times"]}],
    )
    shown = lambda pattern: [F.date_format(c, pattern).alias(n) for c, n in (("start_time", "started"), ("end_time", "ended"))]
    t = event_trips(spark, sf_dir)
    old = t.where(e % 2 == 0).select("event_id", *shown("yyyy-MM-dd HH:mm:ss"), F.lit("docked_bike").alias("model"))
    new = t.where(e % 2 == 1).select("event_id", *shown("yyyy-MM-dd HH:mm:ss'+00:00'"))
    return feeds.apply_steps(old, spec).unionByName(feeds.apply_steps(new, spec))


@query("""WITH n AS (SELECT s_nationkey, arg_max(s_name, s_suppkey) AS name FROM supplier WHERE s_suppkey % 5 <> 0 AND s_nationkey % 6 <> 0 GROUP BY 1)
    SELECT c_nationkey::VARCHAR AS station, count(*) AS n_obs, any_value(name) AS name FROM customer LEFT JOIN n ON c_nationkey = s_nationkey GROUP BY 1""")
def names_onto_ids(spark, sf_dir):
    """The latest known name on points that are keyed by id; some names are missing, some ids have none."""
    s = table(spark, sf_dir, "supplier").where("s_nationkey % 6 <> 0")
    names = s.select(F.col("s_nationkey").cast("string").alias("id"), F.when(F.col("s_suppkey") % 5 != 0, F.col("s_name")).alias("name"), F.col("s_suppkey").alias("seen"))
    points = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("string").alias("station")).agg(F.count("*").alias("n_obs"))
    return stations.name_points(points, names, "seen")


@query("SELECT doc_id::VARCHAR AS id, md5(text) AS digest FROM documents")
def charset_read(spark, sf_dir):
    """Texts written in Latin-1 and in UTF-8, each file read in the charset that its contents are valid in."""
    docs, path = table(spark, sf_dir, "documents"), fresh_path(spark, "charsets")
    whole = {"header": True, "quote": '"', "escape": '"', "emptyValue": '""', "nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for k, charset in enumerate(("ISO-8859-1", "UTF-8")):
        docs.where(F.col("doc_id") % 2 == k).select(F.col("doc_id").cast("string").alias("id"), "text").write.options(encoding=charset, **whole).csv(f"{path}/{k}")
    files = [r.path for r in incremental.manifest(spark, path, "*.csv").orderBy("path").collect()]
    parts = [src.read_csv(spark, own, ["id", "text"], encoding=charset) for charset, own in src.pick_encoding(spark, files, "ISO-8859-1").items()]
    return reduce(DataFrame.unionByName, parts).select("id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("""SELECT s_suppkey::VARCHAR AS id, s_name AS name, CASE WHEN s_suppkey % 3 > 0 THEN s_nationkey::VARCHAR END AS lat, CASE WHEN s_suppkey % 3 = 2 THEN s_suppkey::VARCHAR END AS lng, 'stations' || s_suppkey % 3 AS era FROM supplier""")
def station_files_union(spark, sf_dir):
    """Station files of three eras with differing columns, united by name."""
    k, path = F.col("s_suppkey"), fresh_path(spark, "stations")
    s = table(spark, sf_dir, "supplier").select(k.cast("string").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("lat"), k.cast("string").alias("lng"), (k % 3).alias("era"))
    for era, columns in enumerate((["name", "id"], ["id", "name", "lat"], ["lng", "lat", "name", "id"])):
        s.where(F.col("era") == era).select(*columns).write.option("header", True).csv(f"{path}/stations{era}")
    own = [r.path for r in incremental.manifest(spark, path, "*.csv").orderBy("path").collect()]
    eras = {p.rsplit("/", 1)[-1]: p.rsplit("/", 2)[-2] for p in own}
    known = spark.createDataFrame(list(eras.items()) or [("", "")], "file string, era string")
    return src.read_station_files(spark, own).join(F.broadcast(known), "file").select("id", "name", "lat", "lng", "era")


@query("SELECT n_name AS city, year(o_orderdate) AS year, count(*) AS trips FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2")
def publish_roundtrip(spark, sf_dir):
    """A section of several cities, checked, published as JSON lines and read back."""
    base = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    volume = saved(base.groupBy("n_name", F.year("o_orderdate").alias("year")).agg(F.count("*").alias("trips")), "volume")
    names = [r.n_name for r in volume.select("n_name").distinct().orderBy("n_name").collect()]
    root = fresh_path(spark, "published")
    publish.publish({n: {"volume": volume.where(F.col("n_name") == n).drop("n_name")} for n in names}, [publish.Output("volume_by_year", "volume", ("city", "year"))], root)
    return spark.read.schema("city string, year int, trips bigint").json(f"{root}/v1/volume_by_year")


@query("SELECT sum(c_acctbal IS NULL)::BIGINT AS missing, count(*) AS rows FROM customer")
def null_audit(spark, sf_dir):
    return table(spark, sf_dir, "customer").agg(F.count_if(cols.any_null("c_acctbal")).alias("missing"), F.count("*").alias("rows"))


@query("SELECT path, length(path) > 0 AS ok FROM (SELECT 'f' || o_orderkey AS path FROM orders WHERE o_orderkey % 7 > 0 AND (o_orderkey % 5 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0))")
def changed_inputs(spark, sf_dir):
    return incremental.changed(*_manifests(spark, sf_dir)).select("path", (F.length("path") > 0).alias("ok"))

"""Queries: parsing, values, columns, lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripforge.functions import time as tm
from tripforge.functions import values as vl
from tripforge.operators import columns as cols
from tripforge.operators import quality
from tripforge.plans.catalog import query
from tripforge.plans.views import EVENT_TRIPS, event_trips, table
from tripforge.sources import files as src
from tripforge.sources import lines as ln


def _E():
    return F.col("event_id")



def _pick(values: list[str | None], salt: int = 0):
    """A value by event_id; null entries stay null."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.pmod(_E() + salt, F.lit(len(values))) + 1).cast("int"))


def _pick_sql(values: list[str | None], salt: int = 0) -> str:
    items = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"([{items}])[(event_id + {salt}) % {len(values)} + 1]"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _AT():
    return F.date_trunc("SECOND", "ts")


_AT_SQL = "date_trunc('second', ts)"


@query(f"""SELECT event_id, CASE event_id % 6 WHEN 5 THEN NULL WHEN 4 THEN date_trunc('minute', {_AT_SQL}) ELSE {_AT_SQL} END AS at FROM events""")
def parse_multi_format(spark, sf_dir):
    shown = F.when(_E() % 6 == 0, F.date_format(_AT(), "yyyy-MM-dd HH:mm:ss")).when(_E() % 6 == 1, F.concat(F.date_format(_AT(), "yyyy-MM-dd HH:mm:ss"), F.lit(".123456"))).when(_E() % 6 == 2, F.date_format(_AT(), "M/d/yyyy H:mm:ss")).when(_E() % 6 == 3, F.concat(F.lit("Mon, "), F.date_format(_AT(), "yyyy-MM-dd HH:mm:ss"))).when(_E() % 6 == 4, F.date_format(_AT(), "yyyy-MM-dd HH:mm")).otherwise("no date")
    return _events(spark, sf_dir).select("event_id", tm.parse_ntz(shown, ("y-M-d H:m:s", "y-M-d H:m", "M/d/y H:m:s")).alias("at"))


@query(f"SELECT event_id, {_AT_SQL} - CASE WHEN event_id % 2 = 0 THEN INTERVAL 2 HOUR ELSE -INTERVAL 90 MINUTE END AS at FROM events")
def parse_offset(spark, sf_dir):
    shown = F.concat(F.date_format(_AT(), "yyyy-MM-dd HH:mm:ss"), F.when(_E() % 2 == 0, ".5+02:00").otherwise(" -0130"))
    return _events(spark, sf_dir).select("event_id", tm.parse_offset(shown).alias("at"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN s ELSE timezone('Europe/Madrid', timezone('UTC', s)) END AS at
    FROM (SELECT event_id, date_trunc('second', ts) + to_months((event_id % 12)::INTEGER) AS s FROM events)""")
def to_local_time(spark, sf_dir):
    s = _AT().cast("timestamp_ntz") + F.make_ym_interval(F.lit(0), (_E() % 12).cast("int"))
    shown = F.concat(F.date_format(s, "yyyy-MM-dd'T'HH:mm:ss"), F.when(_E() % 3 == 0, "").when(_E() % 3 == 1, "Z").otherwise("+00:00"))
    return _events(spark, sf_dir).select("event_id", tm.to_local(shown, "Europe/Madrid").alias("at"))


@query("SELECT event_id, date_trunc('second', ts) + to_milliseconds(event_id % 1000) AS at FROM events")
def from_epoch_ms(spark, sf_dir):
    millis = F.unix_seconds(F.convert_timezone(F.lit("UTC"), F.current_timezone(), _AT().cast("timestamp_ntz")).cast("timestamp")) * 1000 + _E() % 1000
    return _events(spark, sf_dir).select("event_id", tm.from_epoch_millis(millis.cast("string")).alias("at"))


@query(f"SELECT event_id, {_AT_SQL} AS at FROM events")
def combine_date_time(spark, sf_dir):
    day = F.when(_E() % 2 == 0, F.date_format(_AT(), "yyyy-MM-dd")).otherwise(F.date_format(_AT(), "dd/MM/yyyy"))
    clock = F.when(_E() % 3 == 0, F.date_format(_AT(), "H:mm:ss")).otherwise(F.date_format(_AT(), "hh:mm:ss a"))
    return _events(spark, sf_dir).select("event_id", tm.combine_date_time(day, clock, ("y-M-d", "d/M/y"), ("h:m:s a", "H:m:s")).alias("at"))


@query("SELECT event_id, date_trunc('minute', ts) AS at FROM events")
def two_digit_year(spark, sf_dir):
    shown = F.concat(F.date_format("ts", "M/d/"), F.when(_E() % 2 == 0, F.date_format("ts", "yy")).otherwise(F.date_format("ts", "yyyy")), F.date_format("ts", " H:mm"))
    return _events(spark, sf_dir).select("event_id", tm.fix_two_digit_year(tm.parse_ntz(shown, ("M/d/y H:m",))).alias("at"))


@query(f"SELECT event_id, {_AT_SQL} + to_minutes((event_id * 7 % 3000)::INTEGER) AS end_time FROM events")
def end_from_minutes(spark, sf_dir):
    minutes = F.format_number(F.pmod(_E() * 7, F.lit(3000)), 0)
    return _events(spark, sf_dir).select("event_id", tm.end_from_minutes(_AT().cast("timestamp_ntz"), minutes).alias("end_time"))


_SECONDS, _MINUTES = ["120", None, "x", "90.5"], ["2", "3", None, "4", "oops"]


@query(f"SELECT event_id, coalesce(TRY_CAST({_pick_sql(_SECONDS)} AS DOUBLE), TRY_CAST({_pick_sql(_MINUTES)} AS DOUBLE) * 60) AS seconds FROM events")
def unify_duration(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", tm.unify_seconds(_pick(_SECONDS), _pick(_MINUTES)).alias("seconds"))


@query(f"WITH {EVENT_TRIPS} SELECT event_id, coalesce(end_time, start_time + to_seconds(event_id % 5000)) AS end_time FROM te")
def reconcile_times(spark, sf_dir):
    return event_trips(spark, sf_dir).select("event_id", F.coalesce("end_time", tm.plus_seconds(F.col("start_time"), _E() % 5000)).alias("end_time"))


@query("SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE (event_id % 40) * 3600 + (event_id % 60) * 60 + event_id % 59 END AS seconds FROM events")
def hms_to_seconds(spark, sf_dir):
    text = F.concat_ws(":", F.format_string("%02d", _E() % 40), F.format_string("%02d", _E() % 60), F.format_string("%02d", _E() % 59), F.when(_E() % 4 == 0, F.lit("77")))
    return _events(spark, sf_dir).select("event_id", tm.hms_to_seconds(F.when(_E() % 9 == 0, "17520:06:").otherwise(text)).alias("seconds"))


@query("""SELECT event_id, make_date(2020 + (event_id % 5)::INTEGER, (event_id % 12 + 1)::INTEGER, 1) AS period FROM events""")
def file_period(spark, sf_dir):
    y, m = 2020 + _E() % 5, F.format_string("%02d", _E() % 12 + 1)
    name = F.when(_E() % 3 == 0, F.concat(F.lit("/raw/"), y.cast("string"), m, F.lit("-tripdata.csv"))).when(_E() % 3 == 1, F.concat(F.lit("/raw/trips_"), F.substring(y.cast("string"), 3, 2), F.lit("_"), m, F.lit("_x.json"))).otherwise(F.concat(F.lit("/raw/nomenclatura_"), y.cast("string"), F.lit("_"), m, F.lit(".csv")))
    return _events(spark, sf_dir).select("event_id", tm.file_period(name).alias("period"))


_G = ["0", "1", "2", " Male", "Female", "M", "F", "O", "?", "m", "f", "NULL", "", None, "robot"]
_M = ["Subscriber", "Customer", "member", "casual", "Annual Member", "Casual Member", "\\N", None, "VIP"]
_B = [*vl.BIKE_TYPES, "NULL", None, "unicycle"]


def _case(values: str, mapping: dict) -> str:
    pairs = " ".join(f"WHEN '{k}' THEN {str(v).lower() if isinstance(v, bool) else chr(39) + v + chr(39)}" for k, v in mapping.items() if v is not None)
    return f"CASE trim({values}) {pairs} END"


@query(f"SELECT event_id, {_case(_pick_sql(_G), vl.GENDERS)} AS gender FROM events")
def normalize_gender(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", vl.gender(_pick(_G)).alias("gender"))


@query(f"SELECT event_id, {_pick_sql(_M)} AS membership_type, {_case(_pick_sql(_M), vl.MEMBERS)} AS is_member FROM events")
def derive_is_member(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", _pick(_M).alias("membership_type"), vl.is_member(_pick(_M)).alias("is_member"))


@query(f"SELECT event_id, CASE WHEN trim({_pick_sql(_B)}) NOT IN ('', 'NULL', '\\N') THEN trim({_pick_sql(_B)}) END AS bike_model, {_case(_pick_sql(_B), vl.BIKE_TYPES)} AS bike_type FROM events")
def normalize_bike_type(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", vl.clean(_pick(_B)).alias("bike_model"), vl.bike_type(_pick(_B)).alias("bike_type"))


_Y = ["1994.0", "1987", "NA", "", None, "199", " 2001 "]


@query(f"SELECT event_id, CASE WHEN y >= 1900 THEN y END AS birth_year FROM (SELECT event_id, TRY_CAST(regexp_replace(trim({_pick_sql(_Y)}), '\\.0$', '') AS INTEGER) AS y FROM events)")
def normalize_birth_year(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", vl.birth_year(_pick(_Y)).alias("birth_year"))


_I = ["007", "0", "000", "271-272", " 12 ", "A01", None, "0450"]


@query(f"SELECT event_id, CASE WHEN regexp_full_match(i, '[0-9]+') THEN regexp_replace(i, '^0+([0-9])', '\\1') ELSE i END AS id FROM (SELECT event_id, trim({_pick_sql(_I)}) AS i FROM events)")
def normalize_station_id(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", vl.station_id(_pick(_I)).alias("id"))


_C = [" a ", "", "NULL", "\\N", None, "null", "x"]


@query(f"SELECT event_id, CASE WHEN trim({_pick_sql(_C)}) NOT IN ('', 'NULL', '\\N') THEN trim({_pick_sql(_C)}) END AS v FROM events")
def clean_value(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", vl.clean(_pick(_C)).alias("v"))


@query("SELECT event_id, CASE WHEN event_type IN ('click', 'NULLNULL', '0000-00-00 00:00:00') THEN NULL ELSE event_type END AS event_type FROM events")
def null_sentinels(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", vl.sentinels_to_null(F.col("event_type"), ("click", "NULLNULL", "0000-00-00 00:00:00")).alias("event_type"))


_L = ["60.39", "n/a", "", None, "-5.5"]


@query(f"SELECT event_id, TRY_CAST({_pick_sql(_L)} AS DOUBLE) AS lat, TRY_CAST({_pick_sql(_L, 2)} AS DOUBLE) AS lng FROM events")
def coords_latlng(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", vl.degrees(_pick(_L)).alias("lat"), vl.degrees(_pick(_L, 2)).alias("lng"))


_W = ["POINT (-85.3 35.05)", "POINT(-85.31 35.06)", "nowhere", "", None]


@query(f"SELECT event_id, TRY_CAST(regexp_extract(w, '^POINT ?\\((-?[0-9.]+) (-?[0-9.]+)\\)$', 2) AS DOUBLE) AS lat, TRY_CAST(regexp_extract(w, '^POINT ?\\((-?[0-9.]+) (-?[0-9.]+)\\)$', 1) AS DOUBLE) AS lng FROM (SELECT event_id, {_pick_sql(_W)} AS w FROM events)")
def coords_wkt(spark, sf_dir):
    lat, lng = vl.wkt_point(_pick(_W))
    return _events(spark, sf_dir).select("event_id", lat.alias("lat"), lng.alias("lng"))


@query("SELECT s_suppkey AS station_id, s_name AS station_name, s_nationkey AS region FROM supplier")
def rename_columns(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return cols.rename(s, {"s_suppkey": "station_id", "s_name": "station_name", "s_nationkey": "region", "absent": "nothing"})


@query("SELECT o_orderkey::VARCHAR AS bike_id, NULL::VARCHAR AS gender, o_orderdate AS start_time, NULL::TIMESTAMP AS end_time, o_custkey::INTEGER AS user_id FROM orders")
def select_final(spark, sf_dir):
    o = cols.optional_as_text(cols.rename(table(spark, sf_dir, "orders"), {"o_orderkey": "bike_id", "o_orderdate": "start_time", "o_custkey": "user_id"}))
    return cols.select_final(o, {"bike_id": "string", "gender": "string", "start_time": "timestamp_ntz", "end_time": "timestamp_ntz", "user_id": "int"})


@query(f"WITH {EVENT_TRIPS}, n AS (SELECT CASE WHEN event_id % 5 > 0 THEN start_time END AS a, CASE WHEN event_id % 5 > 0 THEN end_station_name END AS b FROM te) SELECT a, b FROM n WHERE a IS NOT NULL OR b IS NOT NULL")
def drop_all_null(spark, sf_dir):
    t = event_trips(spark, sf_dir)
    return cols.drop_all_null(t.select(F.when(_E() % 5 > 0, F.col("start_time")).alias("a"), F.when(_E() % 5 > 0, F.col("end_station_name")).alias("b")))


@query(f"WITH {EVENT_TRIPS} SELECT event_id, start_station_name FROM te WHERE start_station_name NOT IN ('S1', 'S2', 'S39')")
def remove_invalid(spark, sf_dir):
    return cols.remove_values(event_trips(spark, sf_dir).select("event_id", "start_station_name"), {"start_station_name": ["S1", "S2", "S39"]})[0]


@query(f"""WITH {EVENT_TRIPS} SELECT 'start_station_name' AS "column", start_station_name AS value, count(*) AS rows FROM te WHERE start_station_name IN ('S1', 'S2', 'S39') GROUP BY 2""")
def remove_invalid_audit(spark, sf_dir):
    return cols.remove_values(event_trips(spark, sf_dir), {"start_station_name": ["S1", "S2", "S39"]})[1]


@query("SELECT s_suppkey::VARCHAR AS id, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey::VARCHAR, c_name, NULL, c_mktsegment FROM customer")
def union_diagonal(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return cols.union_relaxed(s, c)


@query("SELECT r_regionkey::VARCHAR AS k, r_name AS n FROM region UNION ALL SELECT n_name, n_nationkey::VARCHAR FROM nation")
def union_relaxed(spark, sf_dir):
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("n"))
    return cols.union_relaxed(r, table(spark, sf_dir, "nation").select(F.col("n_name").alias("k"), F.col("n_nationkey").alias("n")))


@query("SELECT brand, id, row_number() OVER (PARTITION BY brand ORDER BY TRY_CAST(id AS BIGINT) IS NULL, TRY_CAST(id AS BIGINT), id) AS place FROM (SELECT p_brand AS brand, CASE WHEN p_partkey % 4 = 0 THEN 'X' || p_partkey ELSE p_partkey::VARCHAR END AS id FROM part)")
def id_sort(spark, sf_dir):
    """The order of ids within each brand, as a place."""
    k = F.col("p_partkey")
    ids = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.when(k % 4 == 0, F.concat(F.lit("X"), k.cast("string"))).otherwise(k.cast("string")).alias("id"))
    return cols.placed(ids, "brand", cols.id_order("id"), "place")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN json_extract_string(props, '$.k') ELSE '2021-06-01T05:00:00Z' END AS k FROM events")
def json_unwrap(spark, sf_dir):
    raw = F.when(_E() % 2 == 0, F.col("props")).otherwise('{"k": {"$date": "2021-06-01T05:00:00Z"}}')
    return _events(spark, sf_dir).select("event_id", src.json_field(raw, "k").alias("k"))


@query("SELECT doc_id, replace(text, chr(10), chr(10)) AS text FROM documents")
def normalize_newlines(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    broken = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit("\r\n"))).otherwise(F.replace("text", F.lit("\n"), F.lit("\r")))
    return d.select("doc_id", ln.normalize_newlines(broken).alias("text"))


@query("""SELECT doc_id, translate(replace(text, ' the ', ' the; '), ';' || chr(9) || '"', ',') AS text FROM documents""")
def normalize_delimiters(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", ln.normalize_delimiters(F.replace("text", F.lit(" the "), F.lit(" the; "))).alias("text"))


@query("SELECT doc_id, CASE WHEN contains(source, 'src1') THEN replace(replace(text, 'the', 'THE'), 'THE ', 'the_') ELSE text END AS text FROM documents")
def literal_fixes(spark, sf_dir):
    fixes = [("src1", "the", "THE"), ("src1", "THE ", "the_")]
    return table(spark, sf_dir, "documents").select("doc_id", ln.literal_fixes(F.col("text"), F.col("source"), fixes).alias("text"))


@query("""SELECT page_id FROM pages WHERE (length(html) - length(replace(html, '"', ''))) % 2 = 0""")
def drop_unbalanced(spark, sf_dir):
    return table(spark, sf_dir, "pages").where(ln.balanced_quotes(F.col("html"))).select("page_id")


@query("""SELECT doc_id, translate(replace(text, 'the', 'The'), ';' || chr(9) || '"', ',') AS line FROM documents WHERE (length(translate(replace(text, 'the', 'The'), ';' || chr(9) || '"', ',')) - length(replace(translate(replace(text, 'the', 'The'), ';' || chr(9) || '"', ','), '"', ''))) % 2 = 0""")
def clean_lines(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("file"), F.col("text").alias("line"))
    return ln.cleaned(rows, [("src", "the", "The")], drop_unbalanced=True, delimiters=True).select("doc_id", "line")


@query("""SELECT source AS file, CASE WHEN source = 'src0' THEN 'a,b' ELSE 'a,b,c' END AS header, false AS has_header FROM documents GROUP BY 1""")
def header_by_arity(spark, sf_dir):
    line = F.when(F.col("source") == "src0", F.concat_ws(",", "doc_id", "lang")).otherwise(F.concat_ws(",", "doc_id", "lang", "n_chars"))
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("file"), F.col("doc_id").alias("n"), line.alias("line"))
    return ln.header_by_arity(rows, {2: "a,b", 3: "a,b,c"})


@query("""SELECT trim(replace(c, '"', '')) AS "column", count(DISTINCT doc_id) AS files FROM (SELECT doc_id, unnest(string_split(split_part(text, chr(10), 1), ',')) AS c FROM documents) GROUP BY 1""")
def header_census(spark, sf_dir):
    # prose has stray quotes, which SQL cannot pair; both sides drop them
    first = F.replace(F.split_part("text", F.lit("\n"), F.lit(1)), F.lit('"'), F.lit(""))
    return src.header_census(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file"), first.alias("header")))


@query("""WITH l AS (SELECT o_orderdate::DATE AS file, 'o_orderpriority' AS c, o_orderpriority AS v FROM orders UNION ALL SELECT o_orderdate::DATE, 'o_orderstatus', o_orderstatus FROM orders)
    SELECT c AS "column", count(DISTINCT file) AS files, array_to_string(list_slice(list_sort(list(DISTINCT v)), 1, 2), '|') AS samples, CASE c WHEN 'o_orderstatus' THEN 'status' END AS target FROM l GROUP BY c""")
def column_inventory(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("file"), "o_orderpriority", "o_orderstatus")
    return src.column_inventory(o, "file", {"o_orderstatus": "status"}, 2).withColumn("samples", F.array_join("samples", "|"))


@query("SELECT url AS path FROM pages WHERE (contains(regexp_extract(url, '([^/]*)$', 1), '1') OR contains(regexp_extract(url, '([^/]*)$', 1), 'html')) AND NOT contains(url, '/de/') AND NOT contains(url, '/__MACOSX/')")
def input_filter(spark, sf_dir):
    return table(spark, sf_dir, "pages").where(src.wanted_path(F.col("url"), ["1", "html"], ["/de/"])).select(F.col("url").alias("path"))


@query(f"""WITH b AS (SELECT event_id, {_pick_sql(_G)} AS g, {_pick_sql(_Y[:6] + ['19x4'])} AS y FROM events), x AS (SELECT 'gender' AS name, trim(g) AS value FROM b WHERE trim(g) = 'robot' UNION ALL SELECT 'year', y FROM b WHERE trim(y) <> '' AND TRY_CAST(regexp_replace(trim(y), '\\.0$', '') AS INTEGER) IS NULL)
    SELECT name, count(*) AS n, count(DISTINCT value) AS n_values, min(value) AS first_value FROM x GROUP BY 1""")
def unparsed_values(spark, sf_dir):
    g, y = _pick(_G), _pick([*_Y[:6], "19x4"])
    parsed = F.regexp_replace(F.trim(y), r"\.0$", "").try_cast("int")
    found = quality.check(_events(spark, sf_dir), {"gender": (quality.unmapped(g, vl.GENDERS), F.trim(g)), "year": (quality.unparsed(y, parsed), y)})
    return found.select("name", "n", "n_values", F.col("examples")[0].alias("first_value"))


@query(f"SELECT trim({_pick_sql(_B)}) AS value, count(*) AS n FROM events WHERE trim({_pick_sql(_B)}) = 'unicycle' GROUP BY 1")
def unmapped_values(spark, sf_dir):
    b = _pick(_B)
    return _events(spark, sf_dir).where(quality.unmapped(b, vl.BIKE_TYPES)).groupBy(vl.clean(b).alias("value")).agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_quantity::BIGINT AS l_quantity, l_shipdate FROM lineitem")
def typed_override(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int").cast("string"), "l_shipdate")
    return cols.select_final(raw, {"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "bigint", "l_shipdate": "timestamp_ntz"})

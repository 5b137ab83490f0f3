"""Raw files to canonical trips: eras, gates, cleaning, incremental runs."""

from __future__ import annotations

import gzip
import json
import math
import os
import shutil
import time
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripforge.functions import time as tm
from tripforge.functions import values as vl
from tripforge.operators import columns as cols
from tripforge.operators import fill, incremental, lookups, publish, quality, reference_tables
from tripforge.operators import stations as st
from tripforge.plans import feeds
from tripforge.sources import files as src
from tripforge.sources import lines as ln
from tripforge.streaming import ingest


def spec(**more):
    base = dict(
        name="town",
        steps=["clean_headers", "rename", "null_values", "parse_times", "gender", "is_member", "bike_type", "birth_year", "select_final"],
        rename={"starttime": "start_time", "stoptime": "end_time", "from": "start_station_name", "to": "end_station_name", "started_at": "start_time", "ended_at": "end_time", "usertype": "membership_type", "member_casual": "membership_type", "rideable_type": "bike_type", "birth year": "birth_year"},
        null_values=["NULL"],
        final={**feeds.BASE_COLUMNS, "gender": "string", "membership_type": "string", "is_member": "boolean", "bike_type": "string", "bike_model": "string", "birth_year": "int"},
    )
    return feeds.FeedSpec(**(base | more))


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "201805-trips.csv").write_text('starttime,stoptime,from,to,usertype,gender,birth year\n2018-05-01 00:00:01.2340,2018-05-01 00:10:01.9990,A,B,Subscriber,1,1990.0\n2018-05-01 01:00:00,2018-05-01 00:59:00,B,B,Customer,0,NULL\n')
    with gzip.open(tmp_path / "202401-trips.csv.gz", "wt") as f:
        f.write('"rideable_type",started_at,ended_at,from,to,"member_casual"\n"electric_bike",2024-01-05 10:00:00,2024-01-05 10:30:00,"A, north",,member\nelectric_scooter,2024-01-06 08:05:09,2024-01-06 08:06:00,C,A,casual\n')
    return tmp_path


def test_two_eras_give_one_schema(spark, raw):
    paths = [str(p) for p in sorted(raw.iterdir())]
    rows = {r.start_time: r for r in feeds.read_feed(spark, spec(), paths).collect()}
    old = rows[datetime(2018, 5, 1, 0, 0, 1)]
    assert (old.end_time, old.gender, old.is_member, old.birth_year, old.bike_type, old.year, old.month, old.city) == (datetime(2018, 5, 1, 0, 10, 1), "male", True, 1990, None, 2018, 5, "town")
    assert rows[datetime(2018, 5, 1, 1)].birth_year is None
    new = rows[datetime(2024, 1, 5, 10)]
    assert (new.start_station_name, new.end_station_name, new.bike_type, new.bike_model) == ("A, north", None, "electric", "electric_bike")
    scooter = rows[datetime(2024, 1, 6, 8, 5, 9)]
    assert (scooter.bike_type, scooter.bike_model, scooter.is_member) == (None, "electric_scooter", False)


@pytest.mark.parametrize("line, named", [("yesterday,2018-05-01 01:00:00,A,B,Subscriber,1,1990", "yesterday"), ("2018-05-01 01:00:00,2018-05-01 01:01:00,A,B,Emperor,1,1990", "Emperor"), ("2018-05-01 01:00:00,2018-05-01 01:01:00,A,B,Customer,9,1990", "9")])
def test_gate_names_what_it_cannot_take(spark, raw, line, named):
    bad = raw / "201806-trips.csv"
    bad.write_text("starttime,stoptime,from,to,usertype,gender,birth year\n" + line + "\n")
    with pytest.raises(quality.QualityError, match=named):
        feeds.read_feed(spark, spec(), [str(bad)])


def test_short_row_raises_and_quarantine_keeps_it(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,2,3\n4,5\n1,2,3,4\n")
    with pytest.raises(Exception):
        src.read_csv(spark, str(tmp_path / "a.csv"), ["a", "b", "c"]).collect()
    got = src.read_csv(spark, str(tmp_path / "a.csv"), ["a", "b", "c"], quarantine=True).cache()
    assert sorted(r._corrupt for r in got.collect() if r._corrupt) == ["1,2,3,4", "4,5"]


def test_feed_of_semicolons_and_quoted_commas(spark, tmp_path):
    (tmp_path / "a b.csv").write_text('\n"start;date";"end, date";from;to\n2020-01-01 00:00:00;2020-01-01 00:01:00;"A;1";B\n;;;\n')
    (tmp_path / "b.csv").write_text("to;from;end, date;start;date\n")
    feed = feeds.FeedSpec("x", ["rename", "drop_all_null", "parse_times", "select_final"], sep=";", rename={"start;date": "start_time", "end, date": "end_time", "from": "start_station_name", "to": "end_station_name"})
    got = feeds.read_feed(spark, feed, [str(tmp_path / "a b.csv")]).collect()
    assert [(r.start_time, r.end_time, r.start_station_name, r.end_station_name) for r in got] == [(datetime(2020, 1, 1), datetime(2020, 1, 1, 0, 1), "A;1", "B")]
    assert got[0].source_file.endswith("/a b.csv")
    (tmp_path / "c.csv").write_text('"start, date",from\n2020-01-01 00:00:00,A\n')
    one = feeds.read_feed(spark, feeds.FeedSpec("x", ["rename", "parse_times"], rename={"start, date": "start_time", "from": "start_station_name"}), [str(tmp_path / "c.csv")]).first()
    assert (one.start_time, one.start_station_name, one.end_time) == (datetime(2020, 1, 1), "A", None)
    with pytest.raises(quality.QualityError, match="start_time"):
        feeds.read_feed(spark, feeds.FeedSpec("x", ["rename", "parse_times"], rename=feed.rename), [str(tmp_path / "a b.csv")])


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("detect", [False, True])
def test_feed_of_another_charset(spark, tmp_path, packed, detect):
    def put(name, text, encoding):
        data = text.encode(encoding)
        (tmp_path / (name + ".gz" * packed)).write_bytes(gzip.compress(data) if packed else data)
        return str(tmp_path / (name + ".gz" * packed))

    head = "대여일시,반납일시,대여소,반납소\n"
    paths = [put("k.csv", head + "2020-01-01 00:00:00,2020-01-01 00:01:00,가나,다라\n", "euc-kr")]
    if detect:
        paths.append(put("u.csv", head + "2020-02-01 00:00:00,2020-02-01 00:01:00,가나,마\n", "utf-8"))
    feed = feeds.FeedSpec("x", ["rename", "parse_times"], encoding="EUC-KR", detect_encoding=detect, rename={"대여일시": "start_time", "반납일시": "end_time", "대여소": "start_station_name", "반납소": "end_station_name"})
    got = sorted((r.month, r.start_station_name, r.end_station_name) for r in feeds.read_feed(spark, feed, paths).collect())
    assert got == [(1, "가나", "다라"), (2, "가나", "마")][: len(paths)]


@pytest.mark.parametrize("repair", [False, True])
def test_ragged_rows_stop_a_feed_or_are_set_aside(spark, tmp_path, repair):
    (tmp_path / "a.csv").write_text("start_time,end_time,start_station_name,end_station_name,bike\n2020-01-01 00:00:00,,A,B,1\n2020-01-02 00:00:00,,A,B\n2020-01-03 00:00:00,,A,B,1,2\n")
    feed = feeds.FeedSpec("x", ["parse_times", "select_final"], fixes=[("nothing", "a", "b")] if repair else [])
    with pytest.raises(Exception, match="(?i)malformed"):
        feeds.read_feed(spark, feed, [str(tmp_path / "a.csv")]).count()
    with pytest.raises(Exception, match="(?i)malformed"):
        src.read_csv(spark, str(tmp_path / "a.csv"), ["a", "b", "c", "d", "e"]).select("a").collect()
    feed.quarantine = True
    assert [r.start_time.day for r in feeds.read_feed(spark, feed, [str(tmp_path / "a.csv")]).collect()] == [1]
    assert sorted(r.line for r in feeds.quarantined(spark, feed, [str(tmp_path / "a.csv")]).collect()) == ["2020-01-02 00:00:00,,A,B", "2020-01-03 00:00:00,,A,B,1,2"]


def test_files_of_a_feed_and_documents_without_fields(spark, tmp_path):
    trips_file(tmp_path / "2020-trips.csv", "2020-01-01")
    trips_file(tmp_path / "2020-other.csv", "2020-02-01")
    trips_file(tmp_path / "2020-trips_1.csv", "2020-03-01")
    paths = [str(p) for p in sorted(tmp_path.iterdir())]
    feed = feeds.FeedSpec("x", ["parse_times"], include=["trips"], exclude=["trips_1"])
    assert [r.month for r in feeds.read_feed(spark, feed, paths).collect()] == [1]
    with pytest.raises(quality.QualityError, match="no input files"):
        feeds.read_feed(spark, feed, paths[:1])
    (tmp_path / "trips.json").write_text('{"at": {"$date": "2020-05-01 10:00:00"}, "from": "A"}\n')
    feed.rename = {"at": "start_time", "from": "start_station_name"}
    feed.steps = ["rename", "parse_times"]
    with pytest.raises(quality.QualityError, match="json_fields"):
        feeds.read_feed(spark, feed, [str(tmp_path / "trips.json")])
    feed.json_fields = ["at", "from"]
    feed.ordered = True
    got = feeds.read_feed(spark, feed, [*paths, str(tmp_path / "trips.json")]).collect()
    assert sorted((r.month, r.start_station_name) for r in got) == [(1, "A"), (5, "A")]
    (tmp_path / "no-trips.csv").write_text("\n")
    none = feeds.read_feed(spark, feeds.FeedSpec("x", ["parse_times"], quarantine=True), [str(tmp_path / "no-trips.csv")])
    assert none.collect() == [] and none.columns == feeds.read_feed(spark, feed, paths).columns
    assert feeds.quarantined(spark, feeds.FeedSpec("x", [], quarantine=True), [str(tmp_path / "no-trips.csv")]).count() == 0


def test_files_without_headers_and_with_broken_lines(spark, tmp_path):
    (tmp_path / "x_2015.csv").write_text('2015-01-01 00:00:00;A;B\n2015-01-02 00:00:00;"A;B\n2315-01-03 00:00:00;A;\n')
    (tmp_path / "y.csv").write_text("2016-01-01 00:00:00;A\n")
    (tmp_path / "z.csv").write_text("start_time;start_station_name\n2017-01-01 00:00:00;A\n")
    feed = feeds.FeedSpec("x", ["parse_times"], sep=";", fixes=[["2015", "2315", "2015"]], drop_unbalanced=True, headers=[["2015", "start_time;start_station_name;end_station_name"]], headers_by_arity=["start_time;start_station_name"])
    paths = [str(p) for p in sorted(tmp_path.iterdir())]
    got = sorted((r.start_time, r.start_station_name, r.end_station_name) for r in feeds.read_feed(spark, feed, paths).collect())
    assert got == [(datetime(2015, 1, 1), "A", "B"), (datetime(2015, 1, 3), "A", None), (datetime(2016, 1, 1), "A", None), (datetime(2017, 1, 1), "A", None)]
    (tmp_path / "w.csv").write_text("1;2;3;4\n")
    with pytest.raises(Exception, match="no header for 4 fields"):
        feeds.read_feed(spark, feed, [str(tmp_path / "w.csv")])
    (tmp_path / "v.csv").write_text('start_time;"end_time"\t\n2020-01-01 00:00:00;2020-01-01 00:01:00\t\n')
    feed = feeds.FeedSpec("x", ["parse_times"], encoding="ISO-8859-1", delimiters=True)
    assert [r.end_time.minute for r in feeds.read_feed(spark, feed, [str(tmp_path / "v.csv")]).collect()] == [1]


def test_all_gates_of_a_feed_are_told_at_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("start_time,end_time,start_station_name,gender,birth year\n" + "".join(f"bad{k},2020-01-01 00:00:00,A,robot,19x\n" for k in range(7)))
    (tmp_path / "b.csv").write_text("start_time,end_time,usertype\n2020-01-01 00:00:00,2020-01-01 00:01:00,Emperor\n")
    with pytest.raises(quality.QualityError) as e:
        feeds.read_feed(spark, spec(), [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert "start_time: 7 rows, such as ['bad0', 'bad1', 'bad2', 'bad3', 'bad4']" in str(e.value)
    assert all(x in str(e.value) for x in ("gender: 7 rows, such as ['robot']", "birth_year: 7 rows, such as ['19x']", "membership_type: 1 rows, such as ['Emperor']"))


def test_removed_rows_do_not_hide_findings(spark):
    df = spark.createDataFrame([("soon", "X"), ("2020-01-01 00:00:00", "X"), ("2020-01-02 00:00:00", "A")], "start_time string, start_station_name string")
    feed = feeds.FeedSpec("x", ["parse_times", "remove_invalid"], invalid={"start_station_name": ["X"]})
    with pytest.raises(quality.QualityError, match="soon"):
        feeds.apply_steps(df, feed)
    assert feeds.apply_steps(df.where("start_time <> 'soon'"), feed).count() == 1


def test_dates_and_clocks_with_lost_hours(spark, tmp_path):
    rows = ["01/02/2020,9:55:08,01/02/2020,10:00:00", "01/02/2020,9:55:09,01/02/2020,00:30.5", "01/02/2020,55:10.1,01/02/2020,10:59:00", "01/02/2020,9:58:00,01/02/2020,01:10.0", "01/02/2020,10:10:00,01/02/2020,11:02:00"]
    (tmp_path / "s.csv").write_text("d,t,e,u\n" + "\n".join(rows) + "\n")
    names = {"d": "start_date", "t": "start_clock", "e": "end_date", "u": "end_clock"}
    feed = feeds.FeedSpec("x", ["rename", "recover_times", "combine_times"], rename=names, date_formats=["d/M/y"], ordered=True, lost_hour_files=["s.csv"])
    got = feeds.read_feed(spark, feed, [str(tmp_path / "s.csv")]).collect()
    clock = lambda t: None if t is None else t.strftime("%H:%M:%S")
    assert sorted(((clock(r.start_time), clock(r.end_time)) for r in got), key=str) == sorted([("09:55:08", "10:00:00"), ("09:55:09", "10:00:30"), (None, "10:59:00"), ("09:58:00", None), ("10:10:00", "11:02:00")], key=str)
    feed.lost_hour_files = []
    with pytest.raises(quality.QualityError, match="00:30.5"):
        feeds.read_feed(spark, feed, [str(tmp_path / "s.csv")])
    (tmp_path / "s.csv").write_text("d,t,e,u\n" + "\n".join(rows[::-1]) + "\n")
    feed.lost_hour_files = ["s.csv"]
    with pytest.raises(quality.QualityError, match="not sorted"):
        feeds.read_feed(spark, feed, [str(tmp_path / "s.csv")])


def test_steps_by_era(spark):
    yearly = spark.createDataFrame([(2019, "1", "Old"), (2020, "1", "New")], "year int, code string, name string")
    mapping, dim = spark.createDataFrame([("a", "01")], "legacy_id string, new_id string"), spark.createDataFrame([("01", "One"), ("1", "Uno")], "id string, name string")
    feed = feeds.FeedSpec("x", ["by_era", "select_final"], yearly_stations=yearly, renumbering=mapping, stations=dim, eras=[
        {"has": ["start_station_code"], "steps": ["parse_times", "stations_by_year"]},
        {"has": ["legacy"], "steps": ["parse_times", "renumber_stations"]},
        {"has": ["start_station_id"], "steps": ["station_ids", "station_names", "epoch_millis"]},
    ])

    def named(schema, *row):
        r = feeds.apply_steps(spark.createDataFrame([row], schema), feed).first()
        return r.start_station_name, r.end_station_name, r.start_time

    assert named("start_time string, start_station_code string, end_station_code string", "2019-05-01 00:00:00", "1", "1") == ("Old", "Old", datetime(2019, 5, 1))
    assert named("start_time string, start_station_id string, end_station_id string, legacy int", "2019-05-01 00:00:00", "a", "a", 1)[:2] == ("One", "One")
    assert named("start_time string, start_station_id string, end_station_id string", "1556668800123", "001", "1") == ("Uno", "Uno", datetime(2019, 5, 1, 0, 0, 0, 123000))
    with pytest.raises(quality.QualityError, match="start_station_id without a name: 1 rows, such as .'z'"):
        named("start_time string, start_station_id string, end_station_id string, legacy int", "2019-05-01 00:00:00", "z", "a", 1)
    feed.on_missing = "drop"
    assert feeds.apply_steps(spark.createDataFrame([("2019-05-01 00:00:00", "z", "a", 1)], "start_time string, start_station_id string, end_station_id string, legacy int"), feed).count() == 0
    with pytest.raises(quality.QualityError, match="no era"):
        named("when string", "x")


def test_times_do_not_depend_on_the_sessions_zone(spark):
    df = spark.createDataFrame([("2019-03-31 02:30:00", "1553996000000")], "t string, e string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
        r = df.select(tm.parse_ntz(F.col("t"), tm.DEFAULT_FORMATS).cast("string").alias("t"), tm.from_epoch_millis(F.col("e")).cast("string").alias("e")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.t, r.e) == ("2019-03-31 02:30:00", "2019-03-31 01:33:20")


def test_a_rebuild_has_no_months_of_before(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "start_time timestamp_ntz, year int, month int"
    feeds.write_trips(spark.createDataFrame([(None, None, None), (None, 2020, 1), (None, 2020, 2)], schema), path)
    assert spark.read.parquet(path).count() == 3
    feeds.write_trips(spark.createDataFrame([(None, 2020, 2)], schema), path)
    assert [(r.year, r.month) for r in spark.read.parquet(path).collect()] == [(2020, 2)]
    feeds.write_trips(spark.createDataFrame([], schema), path)
    assert not [x for x in os.listdir(path) if x.startswith("year")]


def test_missing_stations_stay_apart_by_side(spark):
    t = spark.createDataFrame([(2020, None, "A"), (2020, "A", None), (2020, None, None)], "year int, start_station_name string, end_station_name string")
    from tripforge.operators import analytics

    flow = sorted(((r.station, r.trips_from, r.trips_to) for r in analytics.station_flow(t).collect()), key=str)
    assert flow == sorted([("A", 1, 1), (None, 2, 0), (None, 0, 2)], key=str)
    assert [(r.dockless_from, r.dockless_to) for r in analytics.station_trip_counts(t)[1].collect()] == [(2, 2)]


def test_components_beyond_one_contraction(spark, monkeypatch):
    import random

    from tripforge.operators import graph

    # within tasks: stars of no more edges than are held at a time
    import pyarrow as pa

    monkeypatch.setattr(graph, "CONTRACTED", 50)
    path = [pa.RecordBatch.from_arrays([pa.array(range(k, k + 20)), pa.array(range(k + 1, k + 21))], ["a", "b"]) for k in range(0, 100, 20)]
    stars = list(graph._contract(iter(path)))
    assert [sorted(set(b.column(0).to_pylist())) for b in stars] == [[0], [60]] and [b.num_rows for b in stars] == [61, 41]
    monkeypatch.undo()
    random.seed(2)
    order = random.sample(range(3000), 3000)
    edges = [(order[k], order[k + 1]) for k in range(2999) if k % 500 != 499] + [(7, 7), (9000, 9000), (5, 5)]
    df = spark.createDataFrame(edges + [(None, 1)], "a long, b long").repartition(6)
    got = {r.node: r.label for r in graph.connected_components(df).collect()}
    want = {x: min(order[k - k % 500 : k - k % 500 + 500]) for k, x in enumerate(order)}
    assert got == want | {9000: 9000}
    words = spark.createDataFrame([("b", "c"), ("a", "b"), ("x", "y")], "a string, b string")
    assert {r.node: r.label for r in graph.connected_components(words).collect()} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}


@pytest.mark.parametrize("hub", [100_000, 30])
def test_components_of_hubs_and_long_paths(spark, monkeypatch, caplog, hub):
    import random

    from tripforge.operators import graph

    monkeypatch.setattr(graph, "_contract", lambda batches: batches)  # so that all is left to the rounds
    monkeypatch.setattr(graph, "HUB", hub)
    rng = random.Random(4)
    names = rng.sample(range(10_000), 4000)
    edges = [(names[0], x) for x in names[1:800]] + [(names[k], names[k + 1]) for k in range(1000, 1400)]
    edges += [(names[2000 + rng.randrange(900)], names[2000 + rng.randrange(900)]) for _ in range(700)] + [(names[3500 + k // 40], x) for k, x in enumerate(names[3600:4000])]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    with caplog.at_level("INFO", logger="tripforge.operators.graph"):
        got = {r.node: r.label for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(16)).collect()}
    assert got == {x: find(x) for x in root}
    assert 1 < len(caplog.records) < 12 and "settled" in caplog.records[-1].message


def test_the_centre_of_a_large_component_is_no_single_tasks(spark):
    """A star of a million edges: no task of a round reads three times the rows of the median one."""
    from tripforge.operators import graph

    n = 1_000_000
    star = spark.range(n).select(F.lit(0).cast("long").alias("a"), (F.col("id") + 1).alias("b")).repartition(8)
    both = graph._nearest(star.select(F.col("a").alias("u"), F.col("b").alias("v")), n)
    sizes = sorted(r["count"] for r in both.groupBy(F.spark_partition_id()).count().collect())
    assert sum(sizes) == n and both.agg(F.min("m"), F.max("m")).first() == (1, 1)
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
    out = graph.connected_components(star)
    assert out.agg(F.count("*"), F.max("label")).first() == (n + 1, 0)


def test_a_feed_without_gates(spark, tmp_path):
    trips_file(tmp_path / "a.csv", "2020-01-01")
    feed = feeds.FeedSpec("x", ["rename"], final={"start_time": "timestamp_ntz", "end_station_name": "string"})
    assert [(r.month, r.end_station_name) for r in feeds.read_feed(spark, feed, [str(tmp_path / "a.csv")]).collect()] == [(1, "B")]


def test_coverage_gate(spark):
    counts = spark.createDataFrame([(9, 10)], "kept long, named long")
    assert quality.require_coverage(counts, "kept", "named", 0.9).first().coverage == 0.9
    with pytest.raises(quality.QualityError, match="coverage under 0.95"):
        quality.require_coverage(counts, "kept", "named", 0.95)


def test_unknown_step_and_unknown_key(spark):
    df = spark.range(1)
    with pytest.raises(KeyError):
        feeds.apply_steps(df, feeds.FeedSpec("x", ["no such step"]))
    with pytest.raises(KeyError):
        feeds.FeedSpec.parse('{"name": "x", "steps": [], "colour": 1}')
    assert feeds.FeedSpec.parse('{"name": "x", "steps": [], "final": {"a": "Int64"}}').final == {"a": "bigint"}


def test_rename_refuses_ambiguous_columns(spark):
    with pytest.raises(ValueError):
        cols.rename(spark.createDataFrame([(1, 2)], "a int, b int"), {"a": "x", "b": "x"})


def test_charset_and_utf8_detection(spark, tmp_path):
    (tmp_path / "k.csv").write_bytes("이름,값\n가,1\n".encode("euc-kr"))
    got = src.read_csv(spark, str(tmp_path / "k.csv"), ["name", "v"], encoding="EUC-KR").collect()
    assert [tuple(r) for r in got] == [("가", "1")]
    (tmp_path / "u.csv").write_text("가\n")
    assert {r.path[-5:]: r.utf8 for r in src.is_utf8(spark, str(tmp_path)).collect()} == {"k.csv": False, "u.csv": True}


def test_listing_headers_and_census(spark, raw):
    os.makedirs(raw / "__MACOSX")
    (raw / "__MACOSX" / "x.csv").write_text("a\n")
    found = [r.path for r in src.listing(spark, str(raw), ["trips"], ["2018"]).collect()]
    assert len(found) == 1 and found[0].endswith("202401-trips.csv.gz")
    census = {r["column"]: r.files for r in src.header_census(src.headers(spark, [str(raw / "201805-trips.csv"), str(raw / "202401-trips.csv.gz")])).collect()}
    assert census["from"] == 2 and census["gender"] == 1


def test_archives_nested_and_broken(spark, tmp_path):
    inner = tmp_path / "inner.bin"
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("deep.txt", "p\nq")
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/x.csv", "1\n2\n")
        z.writestr("__MACOSX/d/._x.csv", "junk")
        z.writestr("in.zip", inner.read_bytes())
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    got = {(r.member, r.line_no, r.line) for r in src.read_archives(spark, str(tmp_path)).collect()}
    assert got == {("d/x.csv", 1, "1"), ("d/x.csv", 2, "2"), ("in.zip!deep.txt", 1, "p"), ("in.zip!deep.txt", 2, "q"), (None, None, None)}
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("y.csv", "a\x0bb,\u2028c\r\n\r\nd\re")
    (tmp_path / "c.rar").write_bytes(b"Rar!")
    got = {(r.member, r.line_no, r.line) for r in src.read_archives(spark, [str(tmp_path / "b.zip"), str(tmp_path / "c.rar")]).collect()}
    assert got == {("y.csv", 1, "a\x0bb,\u2028c"), ("y.csv", 2, ""), ("y.csv", 3, "d"), ("y.csv", 4, "e"), (None, None, "rar archives are not read")}


def test_ndjson_and_gbfs(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"_id": {"$oid": "7"}, "at": {"$date": "2021"}, "t": 5}\n\n{"at": "2022", "t": 6}\n')
    got = src.read_ndjson(spark, str(tmp_path / "m.json"), ["_id", "at", "t"], ["t"]).collect()
    assert {tuple(r) for r in got} == {("7", "2021", "5"), (None, "2022", "6")}
    (tmp_path / "n.json").write_text('{"at": "2022"}\n')
    with pytest.raises(Exception, match="without t"):
        src.read_ndjson(spark, str(tmp_path / "n.json"), ["t"], ["t"]).collect()
    (tmp_path / "o.json").write_text("not json\n")
    with pytest.raises(Exception, match="no JSON"):
        src.read_ndjson(spark, str(tmp_path / "o.json"), ["t"]).collect()
    (tmp_path / "g.json").write_text(json.dumps({"data": {"stations": [{"station_id": "1", "name": "A", "lat": 1.5, "lon": 2.5}]}}, indent=1))
    assert [tuple(r) for r in src.read_gbfs_stations(spark, str(tmp_path / "g.json")).collect()] == [("1", "A", 1.5, 2.5)]


def test_line_repairs_and_parse(spark):
    rows = spark.createDataFrame([("2021.csv", 1, "a;b"), ("2021.csv", 2, 'x;"y'), ("2022.csv", 3, "2323-06-23;z")], "file string, n int, line string")
    out = ln.cleaned(rows, [("2022", "2323-", "2023-")], drop_unbalanced=False, delimiters=True)
    assert {r.line for r in out.collect()} == {"a,b", "x,y", "2023-06-23,z"}
    assert ln.cleaned(rows, drop_unbalanced=True).count() == 2
    parsed = ln.parse_lines(out, src.text_schema(["p", "q"]))
    assert {(r.p, r.q) for r in parsed.collect()} == {("a", "b"), ("x", "y"), ("2023-06-23", "z")}
    with pytest.raises(Exception, match="no header for 2 fields"):
        ln.header_by_arity(rows.withColumn("line", F.lit("1,2")), {3: "a,b,c"}).collect()


def test_times(spark):
    one = spark.createDataFrame([("4/23/15 7:44", "1,027", "9:55:08", "29:01:01", "2019-03-31T00:30:00Z")], "d string, m string, c string, h string, z string")
    r = one.select(
        tm.fix_two_digit_year(tm.parse_ntz(F.col("d"), ("M/d/y H:m",))).alias("d"),
        tm.end_from_minutes(F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz"), F.col("m")).alias("m"),
        tm.combine_date_time(F.lit("02/01/2020"), F.col("c"), ("d/M/y",), ("H:m:s",)).alias("c"),
        tm.hms_to_seconds(F.col("h")).alias("h"),
        tm.to_local(F.col("z"), "Europe/Madrid").alias("z"),
        tm.file_period(F.lit("s3://x/nomenclatura_2019_04.csv")).alias("p"),
    ).first()
    assert r.d == datetime(2015, 4, 23, 7, 44) and r.m == datetime(2020, 1, 1, 17, 7) and r.c == datetime(2020, 1, 2, 9, 55, 8) and r.h == 104461 and r.z == datetime(2019, 3, 31, 1, 30) and str(r.p) == "2019-04-01"
    with pytest.raises(Exception):
        one.select(tm.end_from_minutes(F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz"), F.lit("soon"))).collect()
    with pytest.raises(Exception):
        one.select(vl.birth_year(F.lit("unknown"))).collect()


def test_lookups_raise_or_fall_back(spark):
    trips = spark.createDataFrame([("1", "2"), ("9", "1")], "start_station_id string, end_station_id string")
    dim = spark.createDataFrame([("1", "One"), ("2", "Two")], "id string, name string")
    steps = ["station_names"]
    with pytest.raises(quality.QualityError, match="9"):
        feeds.apply_steps(trips, feeds.FeedSpec("x", steps, stations=dim))
    got = feeds.apply_steps(trips, feeds.FeedSpec("x", steps, stations=dim, allowed_ids=["9"]))
    assert {r.start_station_name for r in got.collect()} == {"One", "Unknown (id 9)"}
    mapping = spark.createDataFrame([("a", "1")], "legacy_id string, new_id string")
    legacy = spark.createDataFrame([("a", "a"), ("a", "z")], "start_station_id string, end_station_id string")
    with pytest.raises(ValueError, match="z"):
        lookups.renumber_and_name(legacy, mapping, dim)
    assert lookups.renumber_and_name(legacy, mapping, dim, "drop").count() == 1


@pytest.mark.parametrize("block", [1, 2, 3, 100])
def test_share_of_rising_steps_across_blocks(spark, block):
    values = [1, 2, None, 2, 1, 5, 4, None, 9]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)] + [("b", 0, 1)], "file string, n int, v int")
    got = {r.file: (r.share, r.n) for r in fill.monotonic_share(df, "file", "n", "v", block).collect()}
    assert got == {"a": (round(4 / 6, 6), 7), "b": (None, 1)}


def test_order_statistics_of_values_of_any_size(spark):
    import random

    from tripforge.operators import analytics

    rng = random.Random(8)
    rows = [(k % 3 or None, v) for k, v in enumerate([0.0, -0.0, 1.0, 1 + 2**-52, 1 - 2**-53, 2.0, 2 - 2**-52, 1e-320, 5e-324, 1e308, -1e308, float("inf"), float("-inf"), -1.5, -1.5 - 2**-50, None] + [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1) * 10 ** rng.randint(-9, 9), float(rng.randint(0, 9)), 600 + rng.random() * 1e-6]) for _ in range(900)])]
    df = spark.createDataFrame(rows, "key int, v double")
    shares = {f"q{k}": k / 20 for k in range(21)}
    got = {r.key: [r[n] for n in shares] for r in analytics.nearest_rank(df, ["key"], "v", shares).collect()}
    mid = {r.key: r.m for r in analytics.interpolated_median(df.where("abs(v) < 1e300"), ["key"], "v", "m").collect()}
    for key in (None, 1, 2):
        own = sorted(v for k, v in rows if k == key and v is not None)
        assert got[key] == [own[math.floor((len(own) - 1) * q + 0.5)] for q in shares.values()]
        own = [v for v in own if abs(v) < 1e300]
        assert mid[key] == (own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2
    whole = spark.createDataFrame([("a", x) for x in (3, 1, 2**60, 2**60 + 1, 2**60 + 3)], "key string, v long")
    assert analytics.nearest_rank(whole, ["key"], "v", {"low": 0.0, "mid": 0.75, "high": 1.0}).collect() == [("a", 1, 2**60 + 1, 2**60 + 3)]


def test_unsorted_files_are_nulled(spark):
    df = spark.createDataFrame([("a", i, i) for i in range(5)] + [("b", i, -i) for i in range(5)], "file string, n int, v int")
    shares = fill.monotonic_share(df, "file", "n", "v")
    got = fill.null_unsorted(df, "file", shares, "v").groupBy("file").agg(F.count("v").alias("k")).collect()
    assert {r.file: r.k for r in got} == {"a": 5, "b": 0}


def test_fill_across_blocks(spark):
    values = [1, None, None, 1, None, 2, None, None, None, None, 2, None]
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(values)], "file string, n int, v int")
    got = [r.o for r in fill.sandwich_fill(df, "file", "n", "v", "o", block_rows=2).orderBy("n").collect()]
    assert got == [1, 1, 1, 1, None, 2, 2, 2, 2, 2, 2, None]
    c = fill.counters(fill.sandwich_fill(df, "file", "n", "v", "o", 2), "v", "o").first()
    assert (c.present, c.recovered, c.missing) == (4, 6, 2)


def trips_file(path, *days):
    path.write_text("start_time,end_time,start_station_name,end_station_name\n" + "".join(f"{d} 10:00:00,{d} 10:05:00,A,B\n" for d in days))


def test_incremental_runs(spark, tmp_path):
    root, table, state = tmp_path / "in put", str(tmp_path / "trips"), str(tmp_path / "state")
    root.mkdir()
    feed = feeds.FeedSpec("x", ["parse_times", "select_final"])
    read_paths = []

    def read(paths):
        read_paths.append(sorted(os.path.basename(p) for p in paths))
        return feeds.read_feed(spark, feed, paths)

    def run(**more):
        out = incremental.run(spark, incremental.manifest(spark, str(root)), state, read, table, **more).collect()
        return {os.path.basename(r.path): (r.status, r.outputs) for r in out}

    months = lambda: sorted(((r.year, r.month, r["count"]) for r in spark.read.parquet(table).groupBy("year", "month").count().collect()), key=str)
    trips_file(root / "a+b.csv", "2020-01-01", "2020-02-01")
    trips_file(root / "b.csv", "2020-02-02")
    assert run() == {"a+b.csv": ("processed", ["year=2020/month=1", "year=2020/month=2"]), "b.csv": ("processed", ["year=2020/month=2"])}
    assert run()["b.csv"] == ("kept", ["year=2020/month=2"]) and read_paths == [["a+b.csv", "b.csv"]]
    time.sleep(0.05)
    trips_file(root / "a+b.csv", "2020-03-01")
    (root / "c.csv").write_text("start_time,end_time,start_station_name,end_station_name\n,,A,B\n")
    assert run() == {"a+b.csv": ("processed", ["year=2020/month=3"]), "b.csv": ("kept", ["year=2020/month=2"]), "c.csv": ("processed", ["year=__HIVE_DEFAULT_PARTITION__/month=__HIVE_DEFAULT_PARTITION__"])}
    assert sorted(os.listdir(f"{table}/year=2020")) == ["month=2", "month=3"]
    shutil.rmtree(f"{table}/year=2020/month=2")
    assert run()["b.csv"][0] == "processed" and read_paths[-1] == ["b.csv"] and (2020, 2, 1) in months()
    os.remove(root / "b.csv")
    os.remove(root / "c.csv")
    assert run() == {"a+b.csv": ("kept", ["year=2020/month=3"])} and months() == [(2020, 3, 1)]
    assert run(force=True)["a+b.csv"][0] == "processed" and months() == [(2020, 3, 1)]


def test_manifest_of_inputs_without_outputs(spark):
    now = spark.createDataFrame([("a", 1, None), ("b", 2, None), ("c", 3, None)], "path string, length long, modified timestamp_ntz")
    outputs = spark.createDataFrame([("b", ["x"])], "path string, outputs array<string>")
    due = spark.createDataFrame([("a",), ("c",)], "path string")
    made = spark.createDataFrame([("c", ["y"])], "path string, made array<string>")
    got = {r.path: (r.outputs, r.status) for r in incremental.recorded(now, outputs, due, made).collect()}
    assert got == {"a": ([], "processed"), "b": (["x"], "kept"), "c": (["y"], "processed")}


def test_reference_table_untouched_when_unchanged(spark, tmp_path):
    old = spark.createDataFrame([("1", "A"), ("2", "B")], "id string, name string")
    merged, report = reference_tables.upsert(old, spark.createDataFrame([("2", None), ("1", "A")], "id string, name string"), "id", ["name"])
    assert report.count() == 0 and not reference_tables.write_if_changed(old, merged, str(tmp_path / "t"))
    merged, report = reference_tables.upsert(old, spark.createDataFrame([("2", "C"), ("3", "D")], "id string, name string"), "id", ["name"])
    assert {(r.id, r.change) for r in report.collect()} == {("2", "name"), ("3", "added")} and reference_tables.write_if_changed(old, merged, str(tmp_path / "t"))


def test_publish_gates_and_same_bytes(spark, tmp_path):
    one = spark.createDataFrame([(2020, 1, 5), (2020, 2, 6)], "year int, month int, trips int")
    out = [publish.Output("volume", "v", ("city", "year", "month"))]
    both = {"a": {"v": one}, "b": {"v": one}}

    def read(k):
        publish.publish(both, out, str(tmp_path / k))
        return [p.read_bytes() for p in (tmp_path / k / "v1" / "volume").glob("*.json")]

    assert read("x") == read("y")
    before = read("x")
    with pytest.raises(quality.QualityError, match="repeated"):
        publish.publish(both | {"c": {"v": one.union(one)}}, out, str(tmp_path / "x"))
    assert [p.read_bytes() for p in (tmp_path / "x" / "v1" / "volume").glob("*.json")] == before
    assert os.listdir(tmp_path / "x") == ["v1"]
    with pytest.raises(quality.QualityError, match="no section"):
        publish.merge_section({"a": {}}, out[0])
    with pytest.raises(quality.QualityError, match="repeated"):
        publish.merge_section({"a": {"v": one.union(one)}}, out[0])
    with pytest.raises(quality.QualityError, match="differ"):
        publish.merge_section({"a": {"v": one}, "b": {"v": one.drop("trips")}}, out[0])
    with pytest.raises(quality.QualityError, match="absent"):
        publish.merge_section(both, publish.Output("volume", "v", ("city", "day")))
    with pytest.raises(quality.QualityError, match="twice"):
        publish.validate(out * 2)
    assert json.loads(publish.small_json(one, ["month"]))[0] == {"year": 2020, "month": 1, "trips": 5}


def test_near_pairs_at_high_latitude(spark):
    import math
    import random

    random.seed(4)
    pts = [(f"{i:04d}", 60.0 + random.choice([-1e-5, 0, 1e-5, 3e-5]) + random.uniform(0, 4e-4), 5.0 + random.uniform(0, 1e-3)) for i in range(150)]
    df = spark.createDataFrame(pts, "key string, lat double, lng double")
    got = {(r.a, r.b) for r in st.near_pairs(df, 5.0).collect()}

    def metres(p, q):
        k = math.pi / 180
        return 6371000.0 * math.hypot((q[1] - p[1]) * k, (q[2] - p[2]) * k * math.cos((p[1] + q[1]) / 2 * k))

    assert got == {(p[0], q[0]) for p in pts for q in pts if p[0] < q[0] and metres(p, q) < 5.0} and got


def _single_linkage(rows, radius):
    def away(a, b):
        p = math.pi / 180
        return 6371000.0 * math.hypot((b[1] - a[1]) * p, (b[2] - a[2]) * p * math.cos((a[1] + b[1]) / 2 * p))

    label = {r[0]: r[0] for r in rows}
    changed = True
    links = [(a[0], b[0]) for i, a in enumerate(rows) for b in rows[i + 1 :] if None not in (*a, *b) and away(a, b) < radius]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("lat, compared", [(0.0, 64), (1.99996, 64), (59.99999, 64), (-45.0, 0), (78.0, 0), (-0.00001, 0)])
def test_clusters_equal_single_linkage(spark, monkeypatch, lat, compared):
    import random

    monkeypatch.setattr(st, "COMPARED", compared)  # without a budget all goes down to single spots
    rng = random.Random(int(lat) + compared)
    metre = 1 / 111194.93
    rows = []
    for _ in range(12):
        y, x = rng.uniform(-60, 60), rng.uniform(-60, 60)
        rows += [(y + rng.gauss(0, s), x + rng.gauss(0, s)) for s in (rng.choice([0.5, 3, 6]),) for _ in range(rng.choice([1, 5, 25]))]
    rows += [(k * 4.9, 100.0) for k in range(8)] + [(k * 5.1, 200.0) for k in range(4)] + [rows[0]] * 3
    rows = [(k * 7 % 997, lat + y * metre, 13.0 + x * metre / math.cos(math.radians(lat))) for k, (y, x) in enumerate(rows)] + [(2000, None, 1.0), (2001, 1.0, None)]
    got = {r.key: r.cluster for r in st.clusters(spark.createDataFrame(rows, "key long, lat double, lng double"), 5.0).collect()}
    assert got == _single_linkage(rows, 5.0)


def test_clusters_of_a_dense_place_in_linear_work(spark):
    n = 100_000
    dense = spark.range(n).select(F.col("id").alias("key"), (F.rand(1) * 4.5e-5 + 48.0).alias("lat"), (F.rand(2) * 4.5e-5 + 11.0).alias("lng"))
    apart = spark.range(3).select((F.col("id") + n).alias("key"), (F.col("id") * 0.001 + 49.0).alias("lat"), F.lit(11.0).alias("lng"))
    began = time.perf_counter()
    got = st.clusters(dense.unionByName(apart), 5.0).groupBy("cluster").count().orderBy("cluster").collect()
    assert [tuple(r) for r in got] == [(0, n)] + [(n + k, 1) for k in range(3)]
    assert time.perf_counter() - began < 60


def test_latest_names_onto_points(spark):
    points = spark.createDataFrame([("1", 5), ("2", 6), ("3", 7)], "station string, n int")
    names = spark.createDataFrame([("1", "Zoo", 2019), ("1", "Arena", 2021), ("2", "B", 2020), ("2", "A", 2020), ("3", None, 2022), (None, "X", 2022)], "id string, name string, year int")
    assert {(r.station, r.name) for r in st.name_points(points, names, "year").collect()} == {("1", "Arena"), ("2", "B"), ("3", None)}


def test_stream_appends_each_file_once(spark, tmp_path):
    source, table = str(tmp_path / "s"), str(tmp_path / "t")
    rows = [(datetime(2024, 1, 1, 10, 5), "A"), (datetime(2024, 1, 1, 10, 50), "A"), (None, "B")]
    schema = "start_time timestamp_ntz, start_station_name string"
    spark.createDataFrame(rows, schema).write.parquet(source)
    for _ in range(2):
        ingest.append_trips(ingest.stream_trips(spark, source, schema), table, str(tmp_path / "c")).awaitTermination(60)
    assert spark.read.parquet(table).count() == 3
    assert [r.trips for r in ingest.hourly_volume(spark.read.parquet(source).where("start_time is not null")).collect()] == [2]


def test_reference_and_station_files(spark, tmp_path):
    (tmp_path / "ref.csv").write_text("id,name,lat,lng\n 7 ,A,1.5,n/a\n")
    r = src.read_reference_table(spark, str(tmp_path / "ref.csv")).first()
    assert tuple(r) == ("7", "A", 1.5, None)
    with pytest.raises(Exception):
        src.read_reference_table(spark, str(tmp_path / "none.csv"))
    (tmp_path / "s_2020_01.csv").write_text("id,name\n1,Old\n2,Two\n")
    (tmp_path / "s_2021_01.csv").write_text("id,name,lat\n1,New,5\n")
    files = src.read_station_files(spark, [str(tmp_path / "s_2020_01.csv"), str(tmp_path / "s_2021_01.csv")])
    got = reference_tables.newest(files, "id", ["name", "lat"], ["file"])
    assert {tuple(r) for r in got.collect()} == {("1", "New", "5"), ("2", "Two", None)}


def test_encodings_are_picked_by_contents(spark, tmp_path):
    (tmp_path / "k.csv").write_bytes("가\n".encode("euc-kr"))
    (tmp_path / "u.csv").write_text("가\n")
    found = src.pick_encoding(spark, str(tmp_path), "EUC-KR")
    assert {k: [os.path.basename(p) for p in v] for k, v in found.items()} == {"EUC-KR": ["k.csv"], "UTF-8": ["u.csv"]}
    assert {r.line for r in src.read_lossy_lines(spark, str(tmp_path / "u.csv")).collect()} == {"가"}


def test_headers_by_file_name(spark):
    df = spark.createDataFrame([("x_2015.csv", "1,2"), ("y.csv", "1")], "file string, line string")
    assert {r.file: r.header for r in ln.header_for_files(df, [("2015", "a,b")]).collect()} == {"x_2015.csv": "a,b", "y.csv": None}


def test_hooks_run_once_and_do_not_stop_the_feed(spark, raw):
    ran = []
    feeds.register_hook("note")(lambda s, f: ran.append(f.name))

    @feeds.register_hook("fail")
    def fail(s, f):
        raise RuntimeError("no network")

    assert feeds.run_hooks(spark, spec(before=["note", "fail"])) == ["fail: no network"] and ran == ["town"]
    with pytest.raises(KeyError):
        feeds.run_hooks(spark, spec(before=["unknown"]))


def test_orphans_and_files_of_their_own(spark, tmp_path):
    recorded = spark.createDataFrame([("a", ["x", "y"]), ("b", ["y"])], "path string, outputs array<string>")
    current = spark.createDataFrame([("b",)], "path string")
    said, kept = incremental.settle_orphans(recorded, current, "prune")
    assert said == ["pruned x"] and [r.path for r in kept.collect()] == ["b"]
    assert incremental.settle_orphans(recorded, current)[1].count() == 2
    out = str(tmp_path / "o")
    incremental.write_by_file(spark.createDataFrame([("f1", 1), ("f2", 2)], "source_file string, v int"), out)
    incremental.write_by_file(spark.createDataFrame([("f2", 3)], "source_file string, v int"), out)
    assert {tuple(r) for r in spark.read.parquet(out).select("source_file", "v").collect()} == {("f1", 1), ("f2", 3)}


def _counted(spark):
    """A step that counts the rows that pass it, and the counter."""
    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    feeds.STEPS["counted"] = lambda df, spec: df.mapInArrow(count, df.schema)
    return rows


def _trip_files(tmp_path, bad):
    (tmp_path / "a.csv").write_text("start_time,end_time,start_station_name,end_station_name,bike_type\n" + "".join(f"2020-01-{i % 28 + 1:02d} 00:00:00,2020-02-01 00:00:00,A{i},B,docked_bike\n" for i in range(200)))
    lines = ["noon,,A,B,docked_bike", "2020-01-01 00:00:00,,A,B,unicycle", "midnight,,A,B,unicycle", "2020-01-02 00:00:00,,A"] if bad else []
    (tmp_path / "b.csv").write_text("\n".join(["start_time,end_time,start_station_name,end_station_name,bike_type", *lines, "2021-03-01 00:00:00,,C,D,"]))
    return [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]


def _town(**more):
    return feeds.FeedSpec("town", ["counted", "drop_all_null", "parse_times", "bike_type", "select_final"], final={**feeds.BASE_COLUMNS, "bike_type": "string"}, **more)


def test_published_in_one_pass_or_not_at_all(spark, tmp_path):
    rows, out = _counted(spark), str(tmp_path / "out")
    assert feeds.publish_feed(spark, _town(), _trip_files(tmp_path, False), out) == {"kept": 201, "found": 0}
    assert rows.value == 201
    assert spark.read.parquet(out).groupBy("year").count().orderBy("year").collect() == [(2020, 200), (2021, 1)]
    (tmp_path / "b.csv").write_text((tmp_path / "b.csv").read_text() + "\nnoon,,A,B,docked_bike\n2020-01-01 00:00:00,,A,B,unicycle\n")
    with pytest.raises(quality.QualityError, match="bike_type: 1 rows, such as .'unicycle'.*start_time: 1 rows, such as .'noon'"):
        feeds.publish_feed(spark, _town(), [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], out)
    assert spark.read.parquet(out).count() == 201
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.csv", "b.csv", "out"]
    del feeds.STEPS["counted"]


@pytest.mark.parametrize("ordered", [False, True])
def test_offenders_go_to_dead_letters_in_one_pass(spark, tmp_path, ordered):
    rows, out, dead = _counted(spark), str(tmp_path / "out"), str(tmp_path / "dead")
    paths = _trip_files(tmp_path, True)
    for _ in range(2):
        assert feeds.publish_feed(spark, _town(ordered=ordered), paths, out, dead) == {"kept": 201, "found": 4}
    assert rows.value == 2 * 205
    trips = spark.read.parquet(out)
    assert set(trips.columns) == {"start_time", "end_time", "start_station_name", "end_station_name", "bike_type", "source_file", "city", "year", "month"} and trips.count() == 201
    found = sorted((r.source_file.rsplit("/", 1)[-1], r.source_row is not None, r.step, r.value) for r in spark.read.parquet(dead).collect())
    assert found == sorted(("b.csv", ordered, *x) for x in [("start_time", "noon"), ("bike_type", "unicycle"), ("start_time", "midnight"), ("bike_type", "unicycle"), (feeds.WIDTH, "2020-01-02 00:00:00,,A")])
    del feeds.STEPS["counted"]


def test_many_headers_are_one_plan(spark, tmp_path):
    names = {"start_time": ["Start", "start time", "begin"], "end_time": ["End", "end time", "finish"], "start_station_name": ["From", "origin"], "end_station_name": ["To", "target"]}
    want = []
    for i in range(60):
        columns = list(names)
        columns = columns[i % 4 :] + columns[: i % 4] + [f"junk {k}" for k in range(i % 3)] + (["usertype"] if i % 5 == 0 else [])
        head = [names[c][i % len(names[c])] if c in names else c for c in columns]
        cell = {"start_time": f"2020-01-01 00:{i:02d}:00", "end_time": "", "start_station_name": f'A "{i}", x', "end_station_name": f"B{i}", "usertype": "Subscriber"}
        row = ['"' + cell.get(c, "j").replace('"', '""') + '"' if cell.get(c, "j") else "" for c in columns]
        (tmp_path / f"{i:03d}.csv").write_text(",".join(f' "{h}"' if k else h for k, h in enumerate(head)) + "\n" + ",".join(row) + "\n")
        want.append((f"2020-01-01 00:{i:02d}:00", f'A "{i}", x', f"B{i}", True if i % 5 == 0 else None))
    feed = feeds.FeedSpec("x", ["clean_headers", "rename", "drop_all_null", "parse_times", "is_member", "select_final"], rename={h: c for c, own in names.items() for h in own} | {"usertype": "membership_type"}, final={**feeds.BASE_COLUMNS, "is_member": "boolean"})
    got = feeds.read_feed(spark, feed, [str(p) for p in sorted(tmp_path.iterdir())])
    assert sorted((str(r.start_time), r.start_station_name, r.end_station_name, r.is_member) for r in got.collect()) == want
    # a table with and one without members, each a scan per width
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 8
    bad = tmp_path / "bad.csv"
    bad.write_text("Start,From\n2020-01-01 00:00:00,A,B\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        feeds.read_feed(spark, feed, [str(p) for p in sorted(tmp_path.iterdir())])


def test_steps_that_ask_for_columns_keep_headers_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("start,from,to\n2020-01-01 00:00:00,A,B\n")
    (tmp_path / "b.csv").write_text("from,to\nA,B\n")
    feed = feeds.FeedSpec("x", ["rename", "parse_times", "select_final"], rename={"start": "start_time", "from": "start_station_name", "to": "end_station_name"})
    with pytest.raises(quality.QualityError, match="start_time"):
        feeds.read_feed(spark, feed, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])


def _stages(spark, tmp_path, log):
    def extract(paths):
        log.append(("extract", sorted(os.path.basename(p) for p in paths)))
        found = src.read_archives(spark, paths, sep=",").where("member is not null")
        return found.select(F.col("archive").alias("source_file"), incremental.output_name("archive", "member").alias("output"), F.lit(0).cast("long").alias("start"), F.col("line_no").alias("n"), "line")

    def clean(paths):
        log.append(("clean", len(paths)))
        kept = ln.cleaned(incremental.lines_of(spark, paths), [("", "Xville", "X")])
        return kept.select(F.col("file").alias("source_file"), incremental.output_name(F.element_at(F.split("file", "output="), -1)).alias("output"), "start", "n", "line")

    feed = feeds.FeedSpec("town", ["parse_times", "select_final"])

    def read(paths):
        log.append(("months", len(paths)))
        return feeds.read_feed(spark, feed, incremental.lines_of(spark, paths))

    raw, clean_at = incremental.FileStage(extract, str(tmp_path / "raw"), str(tmp_path / "raw-state")), incremental.FileStage(clean, str(tmp_path / "clean"), str(tmp_path / "clean-state"))
    return [raw, clean_at], read


def _zip(path, **members):
    with zipfile.ZipFile(path, "w") as z:
        for name, days in members.items():
            z.writestr(f"{name}.csv", "start_time,end_time,start_station_name,end_station_name\n" + "".join(f'{d} 00:00:00,,"Xville ""{name}"",\nnorth",B\n' for d in days))


def test_stages_pass_on_only_what_changed(spark, tmp_path):
    log, root = [], tmp_path / "archives"
    root.mkdir()
    stages, read = _stages(spark, tmp_path, log)
    _zip(root / "a.zip", a1=["2020-01-01", "2020-02-01"], a2=["2020-03-01"])
    _zip(root / "b.zip", b1=["2020-02-02"])
    with zipfile.ZipFile(root / "c.zip", "w") as z:
        z.writestr("readme.md", "nothing here")

    def run():
        log.clear()
        out = incremental.run_chain(spark, incremental.manifest(spark, str(root), "*.zip"), stages, read, str(tmp_path / "trips"), str(tmp_path / "trips-state"))
        names = {os.path.basename(r.path): (r.status, len(r.outputs)) for r in out[0].collect()}
        return names, sorted(r.status for r in out[1].collect()), sorted(r.status for r in out[2].collect())

    def files(name):
        return {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / name).rglob("*.parquet")}

    trips = lambda: sorted((str(r.start_time.date()), r.start_station_name) for r in spark.read.parquet(str(tmp_path / "trips")).collect())
    assert run() == ({"a.zip": ("processed", 2), "b.zip": ("processed", 1), "c.zip": ("processed", 0)}, ["processed"] * 3, ["processed"] * 3)
    assert trips() == [("2020-01-01", 'X "a1",\nnorth'), ("2020-02-01", 'X "a1",\nnorth'), ("2020-02-02", 'X "b1",\nnorth'), ("2020-03-01", 'X "a2",\nnorth')]
    assert run() == ({"a.zip": ("kept", 2), "b.zip": ("kept", 1), "c.zip": ("kept", 0)}, ["kept"] * 3, ["kept"] * 3) and log == []
    before = files("raw") | files("clean") | files("trips")
    time.sleep(0.05)
    _zip(root / "b.zip", b1=["2020-04-02"], b2=["2020-04-03"])
    assert run() == ({"a.zip": ("kept", 2), "b.zip": ("processed", 2), "c.zip": ("kept", 0)}, ["kept"] * 2 + ["processed"] * 2, ["kept"] * 2 + ["processed"] * 2)
    assert log == [("extract", ["b.zip"]), ("clean", 2), ("months", 2)]
    after = files("raw") | files("clean") | files("trips")
    untouched = {f for f in before if after.get(f) == before[f]}
    assert {f for f in untouched if f.startswith("trips")} == {f for f in before if "month=1/" in f or "month=3/" in f}
    assert sum(f.startswith("raw") for f in untouched) == sum(f.startswith("clean") for f in untouched) == 2
    assert [d for d, _ in trips()] == ["2020-01-01", "2020-02-01", "2020-03-01", "2020-04-02", "2020-04-03"]
    (root / "a.zip").unlink()
    run()
    assert [d for d, _ in trips()] == ["2020-04-02", "2020-04-03"] and len(list((tmp_path / "raw").glob("output=*"))) == len(list((tmp_path / "clean").glob("output=*"))) == 2
    shutil.rmtree(next((tmp_path / "clean").glob("output=*b1*")))
    run()
    assert log == [("clean", 1), ("months", 0)] or log == [("clean", 1)]


def test_rows_are_made_once_where_findings_are_settled(spark, tmp_path, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def counted(x):
        made.add(1)
        return x

    name = F.udf(counted, "string").asNondeterministic()
    step = lambda df, spec: quality.marked(df.withColumn("end_station_name", name("end_station_name")), {"end_station_name": (F.col("end_station_name") == "bad", F.col("end_station_name"))})
    monkeypatch.setitem(feeds.STEPS, "counted", step)
    feed, table, state = feeds.FeedSpec("x", ["parse_times", "counted", "select_final"]), tmp_path / "trips", str(tmp_path / "state")
    root = tmp_path / "in"
    root.mkdir()
    trips_file(root / "a.csv", "2020-01-01", "2020-02-01", "2020-02-02")
    assert feeds.read_feed(spark, feed, [str(root / "a.csv")]).where("end_station_name > ''").count() == 3
    assert made.value == 6  # the gate, and the use

    def run():
        made.value = 0
        incremental.run(spark, incremental.manifest(spark, str(root)), state, lambda paths: feeds.read_feed(spark, feed, paths, settle=False), str(table))
        return made.value, sorted(str(r.start_time.date()) for r in spark.read.parquet(str(table)).collect())

    head = "start_time,end_time,start_station_name,end_station_name\n"
    (root / "b.csv").write_text(head + "2020-03-01 00:00:00,,A,bad\n")
    with pytest.raises(quality.QualityError, match="end_station_name: 1 rows, such as .'bad'"):
        run()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["in"]
    (root / "b.csv").unlink()
    assert run() == (3, ["2020-01-01", "2020-02-01", "2020-02-02"])
    trips_file(root / "c.csv", "2020-02-03")
    assert run() == (1, ["2020-01-01", "2020-02-01", "2020-02-02", "2020-02-03"])
    (root / "b.csv").write_text(head + "2020-01-05 00:00:00,,A,bad\n")
    with pytest.raises(quality.QualityError, match="bad"):
        run()
    assert spark.read.parquet(str(table)).count() == 4


def test_a_large_output_is_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "FILE_LINES", 2, raising=False)
    lines = spark.range(10).select(F.lit("a").alias("source_file"), F.lit("x").alias("output"), F.lit(0).cast("long").alias("start"), F.col("id").alias("n"), F.col("id").cast("string").alias("line"))
    now = spark.createDataFrame([("a", 1, datetime(2024, 1, 1))], "path string, length long, modified timestamp_ntz")
    incremental.run_files(spark, now, incremental.FileStage(lambda paths: lines, str(tmp_path / "out"), str(tmp_path / "state")))
    assert len(list((tmp_path / "out" / "output=x").glob("*.parquet"))) == 5
    assert sorted(r.n for r in incremental.lines_of(spark, [str(tmp_path / "out" / "output=x")]).collect()) == list(range(10))

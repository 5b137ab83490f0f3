"""Quoted cells against Python's csv: doubled quotes, separators, backslashes and line breaks, over many blocks."""

from __future__ import annotations

import csv
import gzip
import io
import random

import pytest

from tripforge.plans import feeds
from tripforge.sources import files as src
from tripforge.sources import lines as ln
from tripforge.sources import records

NAMES = ["id", "text", "more"]


def table(seed: int, n: int) -> list[list[str]]:
    rng = random.Random(seed)
    pieces = ['"', '""', ",", ";", "\\", "\n", "\r\n", "\r", "a", "bc ", " ", "é", "가", "x" * 40, ""]
    return [[str(i), *("".join(rng.choice(pieces) for _ in range(rng.randint(1, 8))) + "." for _ in range(2))] for i in range(n)]


def written(rows, sep=",", end="\n", names=NAMES) -> str:
    out = io.StringIO(newline="")
    csv.writer(out, delimiter=sep, lineterminator=end).writerows([names, *rows])
    return out.getvalue()


@pytest.fixture(params=[None, 97])
def blocks(request, spark):
    """Files in one block, or in blocks of some hundred bytes."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    if request.param:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("sep, end, encoding", [(",", "\n", "UTF-8"), (";", "\r\n", "UTF-8"), (",", "\r\n", "EUC-KR")])
def test_files_as_csv_reads_them(spark, tmp_path, blocks, sep, end, encoding):
    rows = [[c.replace("é", "e") if encoding != "UTF-8" else c for c in r] for r in table(3, 120)]
    text = written(rows, sep, end)
    want = [tuple(r) for r in list(csv.reader(io.StringIO(text, newline=""), delimiter=sep))[1:]]
    (tmp_path / "a b.csv").write_bytes(text.encode(encoding))
    plain = written([["7", 'A ""x"" y"', "back\\"], ["8", "", "z"]], sep, end)
    (tmp_path / "plain.csv").write_bytes(plain.encode(encoding))
    want += [tuple(r) for r in list(csv.reader(io.StringIO(plain, newline=""), delimiter=sep))[1:]]
    got = [tuple(r) for r in src.read_csv(spark, str(tmp_path), NAMES, sep, encoding).collect()]
    assert sorted((a, b or "", c) for a, b, c in got) == sorted(want)
    if blocks:
        assert spark.read.option("lineSep", "\n").text(str(tmp_path / "a b.csv")).rdd.getNumPartitions() > 10


def test_order_of_records_and_cells_longer_than_blocks(spark, tmp_path, blocks):
    rows = [["1", "x\n" * 400 + '"', "a"], ["2", "b", "c"], ["3", '"\n' * 300, '\n"\n'], ["4", "d", "e"]]
    (tmp_path / "a.csv").write_text(written(rows), newline="")
    found = src.read_csv(spark, str(tmp_path / "a.csv"), NAMES, place=True).orderBy("__start", "__n").collect()
    assert [[r.id, r.text, r.more] for r in found] == rows
    with gzip.open(tmp_path / "b.csv.gz", "wt", newline="") as f:
        f.write(written(rows))
    assert sorted(tuple(r) for r in src.read_csv(spark, str(tmp_path / "b.csv.gz"), NAMES).collect()) == sorted(map(tuple, rows))


def test_quotes_within_plain_cells_are_text(spark, tmp_path, blocks):
    text = 'id,text,more\n1,5" pipe,a\n2,"x\ny",7" b\n\n3,c""d,"e"\n'
    (tmp_path / "a.csv").write_text(text)
    want = [tuple(r) for r in csv.reader(io.StringIO(text)) if r][1:]
    assert sorted(tuple(r) for r in src.read_csv(spark, str(tmp_path / "a.csv"), NAMES).collect()) == want


def test_open_quote_is_one_record_to_the_end(spark, tmp_path, blocks):
    (tmp_path / "a.csv").write_text("id,text,more\n1,a,b\n" + '2,"open,c\n' + "3,d,e\n" * 50)
    got = src.read_csv(spark, str(tmp_path / "a.csv"), NAMES, quarantine=True).collect()
    assert [(r.id, r._corrupt is None) for r in got if r._corrupt is None] == [("1", True)] and len(got) == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        src.read_csv(spark, str(tmp_path / "a.csv"), NAMES).collect()


@pytest.mark.parametrize("inside", [False, True])
def test_states_compose(inside):
    rng = random.Random(9)
    quotes = records.Quotes(b",")
    for _ in range(300):
        text = "".join(rng.choice(['"', '""', ",", "a", "\n", "\r"]) for _ in range(40)) + "\n"
        state, lines = inside, text.encode().split(b"\n")[:-1]
        for line in lines:
            state = quotes.scan(line, state)[0]
        # the csv module knows the state by whether a further cell would join the last one
        rows = list(csv.reader(io.StringIO(('"' if inside else "") + text + 'END,"', newline="")))
        assert ("END" not in (rows[-1][0], rows[-1][-2] if len(rows[-1]) > 1 else "")) == state, (text, rows[-1])


def test_lines_with_doubled_quotes_and_breaks(spark):
    rows = table(5, 60)
    df = spark.createDataFrame([(i, written([r], names=[]).lstrip("\n").removesuffix("\n")) for i, r in enumerate(rows)], "k int, line string")
    got = ln.parse_lines(df, src.text_schema(NAMES)).orderBy("k").select(*NAMES).collect()
    assert [list(r) for r in got] == rows


@pytest.mark.parametrize("sep", [",", ";", "|"])
def test_census_splits_as_headers_are_parsed(spark, sep):
    heads = [f'a{sep}b', f'"a{sep}b"{sep} "c ""d"""{sep} e ', f'\ufeff"x"{sep}y', f"a{sep}{sep}b", f'"q"r{sep}5" pipe{sep}"\'z\'"', f'a{sep}"" {sep}b', "one", f'é{sep} "ü{sep}{sep}"']
    census = {r["column"]: r.files for r in src.header_census(spark.createDataFrame(list(enumerate(heads)), "file int, header string"), sep).collect()}
    want: dict = {}
    for h in heads:
        for c in set(src.parse_header(h, sep)):
            want[c] = want.get(c, 0) + 1
    assert census == want


@pytest.mark.parametrize("repair", [False, True])
def test_feeds_with_breaks_in_cells_and_names(spark, tmp_path, blocks, repair):
    head = ["start_time", "start\nname", "end_station_name"]
    rows = [[f"2020-01-{i % 28 + 1:02d} 00:00:00", t, m] for i, t, m in table(8, 40) for i in [int(i)]]
    (tmp_path / "a.csv").write_text(written(rows, names=head), newline="")
    (tmp_path / "b.csv").write_text("start_time,start_station_name\n2021-01-01 00:00:00,A\n")
    feed = feeds.FeedSpec("x", ["rename", "parse_times", "select_final"], rename={"start\nname": "start_station_name"}, fixes=[("nothing", "a", "b")] if repair else [], ordered=True)
    got = feeds.read_feed(spark, feed, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()
    assert sorted((r.start_station_name, r.end_station_name or "") for r in got) == sorted([(t, m) for _, t, m in rows] + [("A", "")])

"""CSV records whose quoted cells hold line breaks, from files that stay splittable.

A line break ends a record only outside quotes, and whether it is outside depends on
all that comes before it in the file. Files are therefore read twice, block by block:
first each block tells, for either state that it may begin in, the state that it ends
in; composing these over a file's blocks gives every block's true first state; then
each block cuts its records at breaks outside quotes. The piece of a record that goes
on in the next block meets its other pieces by file and place, the only rows that are
shuffled.

Files without a line of an odd number of quotes have no such cells; they are found by a
count and are left to Spark's own reader.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of records that leave a task at a time.
AT_ONCE = 4 << 20


def file_path() -> Column:
    """The path of a row's file, as readers take it."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def bytewise(encoding: str) -> bool:
    """Whether quotes, commas and breaks of this charset are the bytes that they are in ASCII, and no other characters hold them."""
    return not re.match(r"(?i)utf[-_]?(16|32|7)|.*(ebcdic|cp037|ibm037|ibm1047)|iso[-_]?2022|hz", encoding)


def _lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(file, start, line) of stretches between line feeds, as bytes."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    return raw.select(file_path().alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))


def broken_files(spark: SparkSession, paths: list[str] | str) -> list[str]:
    """The files with a line of an odd number of quotes; as many paths as such files reach the driver."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    odd = (F.length(F.col("value").cast("binary")) - F.length(F.replace("value", F.lit('"'), F.lit("")).cast("binary"))) % 2 == 1
    return sorted(r.file for r in raw.where(odd).select(file_path().alias("file")).distinct().collect())


class Quotes:
    """Follows a text through quoted and plain cells: a quote opens a cell only as its first character, a doubled one inside is text."""

    def __init__(self, sep: bytes) -> None:
        self._edge = re.compile(b"\r(?!$)|" + re.escape(sep))

    def scan(self, line: bytes, inside: bool) -> tuple[bool, list[int]]:
        """(whether the end is inside quotes, places of carriage returns within the line that end a record)."""
        cuts: list[int] = []
        if b'"' not in line and (inside or b"\r" not in line):
            return inside, cuts
        at = 0
        while True:
            if inside:
                while (end := line.find(b'"', at)) >= 0 and line[end + 1 : end + 2] == b'"':
                    at = end + 2
                if end < 0:
                    return True, cuts
                at, inside = end + 1, False
            elif line[at : at + 1] == b'"':
                inside, at = True, at + 1
                continue
            found = self._edge.search(line, at)
            if not found:
                return False, cuts
            if found.group() == b"\r":
                cuts.append(found.start())
            at = found.end()


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes, bool]]:
    """(file, start, line, whether the line is its block's first) in order; a task reads one block after another."""
    now = None
    for batch in batches:
        for file, start, line in zip(*(batch.column(k).to_pylist() for k in range(3))):
            yield file, start, line, (file, start) != now
            now = (file, start)


def _ends(sep: bytes):
    """Per block: whether it ends in quotes if it begins outside them (plain) or in them (quoted), and whether a record ends in it in the second case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes, out = Quotes(sep), []
        for file, start, line, first in _by_block(batches):
            if first:
                out.append([file, start, False, True, False])
            own = out[-1]
            alike = own[2] == own[3]
            now, cuts = quotes.scan(line, own[3])
            own[2] = now if alike else quotes.scan(line, own[2])[0]
            own[3], own[4] = now, own[4] or not now or bool(cuts)
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["file", "start", "plain", "quoted", "ended"])

    return run


def _cut(sep: bytes, states):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes, rows, size = Quotes(sep), [], 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 5
            rows.clear()
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.large_binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["file", "start", "n", "line", "owner"])

        file, start, held, n, inside, owner = None, 0, [], 0, False, None
        for name, block, line, first in _by_block(batches):
            if first:
                if held:
                    rows.append((file, start, n, b"\n".join(held), start if owner is None else owner))
                if (name, block) not in states.value:
                    raise RuntimeError(f"{name} was cut into other blocks when it was read again")
                file, start, held, n = name, block, [], 0
                inside, owner = states.value[name, block]
            now, cuts = quotes.scan(line, inside)
            begin = 0
            for end in [*cuts, None]:
                held.append(line[begin:end])
                begin = (end or 0) + 1
                if end is None and now:
                    break  # goes on in the next line
                record = b"\n".join(held)
                rows.append((file, start, n, record[:-1] if end is None and record.endswith(b"\r") else record, owner))
                size += len(record)
                held, n, owner = [], n + 1, None
            inside = now
            if size > AT_ONCE:
                yield out()
                size = 0
        if held:
            rows.append((file, start, n, b"\n".join(held), start if owner is None else owner))
        yield out()

    return run


def read_records(spark: SparkSession, paths: list[str] | str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """(file, start, n, line) of the records with anything in them, decoded, line breaks within quotes as they are in the file; (start, n) gives their order in a file.

    A quote that is not closed makes the rest of the file one record. A record must
    fit into a row. As many rows as the files have blocks reach the driver.
    """
    cut_at, lines = sep.encode(), _lines(spark, paths)
    ends = lines.mapInArrow(_ends(cut_at), "file string, start long, plain boolean, quoted boolean, ended boolean")
    states: dict[tuple[str, int], tuple[bool, int | None]] = {}
    last, inside, owner = None, False, 0
    for r in ends.orderBy("file", "start").collect():
        inside = inside and r.file == last
        states[r.file, r.start] = (inside, owner if inside else None)
        # of a block that is one stretch of a record, the record's first block stays the owner
        owner = owner if inside and not r.ended else r.start
        last, inside = r.file, r.quoted if inside else r.plain
    told = spark.sparkContext.broadcast(states)
    pieces = lines.mapInArrow(_cut(cut_at, told), "file string, start long, n long, line binary, owner long")
    whole = pieces.where("owner is null").select("file", "start", "n", "line")
    order = F.array_sort(F.collect_list(F.struct("start", "n", "line")))
    joined = F.aggregate(F.slice("p", 2, F.size("p")), F.col("p")[0]["line"], lambda a, b: F.concat(a, F.lit(b"\n"), b["line"]))
    met = pieces.where("owner is not null").groupBy("file", "owner").agg(order.alias("p")).select("file", F.col("owner").alias("start"), F.col("p")[0]["n"].alias("n"), joined.alias("line"))
    text = F.make_valid_utf8(F.col("line").cast("string")) if encoding.upper().replace("-", "") == "UTF8" else F.decode("line", encoding)
    out = whole.unionByName(met).select("file", "start", "n", text.alias("line"))
    return out.where(F.btrim("line", F.lit(" \t\r\n")) != "")

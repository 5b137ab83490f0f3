"""Text members of zip archives, read member by member.

A first job lists the members of every archive from its central directory, which
stands at the archive's end; a second one deals the members out to tasks, whatever
archive they are in, and each is found by its place and unpacked in pieces. Nested
archives are unpacked from front to back as they come out of the outer one, so
neither is held as a whole.

Archives are opened by pyarrow (local paths and the stores that it knows). Those of
other file systems, which only Spark can open, come as one row each and must fit
into a task's memory.
"""

from __future__ import annotations

import codecs
import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.sources.records import Quotes
from tripforge.work import saved

#: Bytes that are unpacked at a time, and characters of lines that leave a task at a time.
PIECE, AT_ONCE = 1 << 20, 4_000_000
#: Bytes of packed members that one task is given, about.
SHARE = 64 << 20
#: File systems that pyarrow opens.
OPENED = ("", "file", "s3", "gs", "gcs", "abfs", "abfss", "hdfs")
#: Marks of a member's header, and of the directory behind all members; the flag of members whose lengths stand behind them.
_LOCAL, _BEHIND, _MORE = b"PK\x03\x04", (b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06"), 8
_NAMES = ["archive", "member", "line_no", "line"]


class _Stream:
    """Bytes from pieces, by number or up to a mark, with what was read too far put back."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self._pieces, self._held = pieces, b""

    def read(self, n: int) -> bytes:
        """n bytes, fewer at the end."""
        parts, have = [self._held], len(self._held)
        while have < n and (piece := next(self._pieces, None)) is not None:
            parts.append(piece)
            have += len(piece)
        whole = b"".join(parts)
        self._held = whole[n:]
        return whole[:n]

    def some(self) -> bytes:
        """Whatever comes next; empty at the end."""
        out, self._held = self._held or next(self._pieces, b""), b""
        return out

    def back(self, rest: bytes) -> None:
        self._held = rest + self._held


def _inflated(stream: _Stream) -> Iterator[bytes]:
    one = zlib.decompressobj(-15)
    while not one.eof:
        packed = one.unconsumed_tail or stream.some()
        if not packed:
            raise zipfile.BadZipFile("a member ends too soon")
        if out := one.decompress(packed, PIECE):
            yield out
    stream.back(one.unused_data)


def _stored(stream: _Stream, size: int) -> Iterator[bytes]:
    while size:
        piece = stream.read(min(size, PIECE))
        if not piece:
            raise zipfile.BadZipFile("a member ends too soon")
        size -= len(piece)
        yield piece


def front_to_back(pieces: Iterator[bytes]) -> Iterator[tuple[str, Iterator[bytes]]]:
    """(name, pieces) of the members of a zip that comes as a stream, by their local headers. A member is passed over before the next one is looked for. A stored member whose length stands behind it cannot be told from what follows and raises."""
    stream = _Stream(pieces)
    while True:
        head = stream.read(30)
        if head[:4] in _BEHIND:
            return
        if head[:4] != _LOCAL or len(head) < 30:
            raise zipfile.BadZipFile("no zip archive, or one that ends too soon")
        _, flags, method, _, _, _, packed, _, n_name, n_extra = struct.unpack("<HHHHHIIIHH", head[4:])
        raw, extra = stream.read(n_name), stream.read(n_extra)
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack("<HH", extra[at : at + 4])
            if kind == 1 and packed == 0xFFFFFFFF and n >= 16:
                packed = struct.unpack("<Q", extra[at + 12 : at + 20])[0]
            at += 4 + n
        if flags & 1 or method not in (0, 8) or method == 0 and flags & _MORE:
            raise zipfile.BadZipFile(f"a nested member packed by method {method} with flags {flags} is not read")
        own = _inflated(stream) if method == 8 else _stored(stream, packed)
        yield raw.decode("utf-8" if flags & 0x800 else "cp437"), own
        for _ in own:
            pass
        if flags & _MORE:
            # checksum and lengths, of 4 or 8 bytes, with or without a mark before them
            tail = stream.read(24)
            cut = next((k for k in (16, 12, 24, 20) if tail[k : k + 2] == b"PK" or len(tail) == k), 16)
            stream.back(tail[cut:])


def _pieces(file) -> Iterator[bytes]:
    while piece := file.read(PIECE):
        yield piece


def _wanted(name: str) -> bool:
    return not name.endswith("/") and not name.rsplit("/", 1)[-1].startswith("._") and "__MACOSX" not in name


def _texts(name: str, pieces: Iterator[bytes], suffixes: tuple[str, ...]) -> Iterator[tuple[str, Iterator[bytes]]]:
    """The texts in a member: itself, or those of a nested archive, at any depth."""
    if name.lower().endswith(".zip"):
        for inner, own in front_to_back(pieces):
            if _wanted(inner):
                for deeper, text in _texts(inner, own, suffixes):
                    yield f"{name}!{deeper}", text
    elif name.lower().endswith(suffixes):
        yield name, pieces


def text_lines(pieces: Iterator[bytes]) -> Iterator[str]:
    """Lines of UTF-8 text, broken characters replaced, ended by line feeds, carriage returns or both."""
    decode = io.IncrementalNewlineDecoder(codecs.getincrementaldecoder("utf-8")("replace"), True)
    left: list[str] = []
    for piece in pieces:
        first, *more = decode.decode(piece).split("\n")
        left.append(first)
        if more:
            yield "".join(left)
            yield from more[:-1]
            left = [more[-1]]
    first, *more = (decode.decode(b"", True)).split("\n")
    left.append(first)
    if more:
        yield "".join(left)
        yield from more[:-1]
        left = [more[-1]]
    if rest := "".join(left):
        yield rest


def whole_records(lines: Iterator[str], sep: str) -> Iterator[str]:
    """Lines joined to CSV records: a quoted cell may hold line breaks, which come out as line feeds."""
    quotes, held, inside = Quotes(sep.encode()), [], False
    for line in lines:
        held.append(line)
        inside = quotes.scan(line.encode(), inside)[0]
        if not inside:
            yield "\n".join(held)
            held = []
    if held:
        yield "\n".join(held)


def _batches(archive: str, name: str, lines: Iterator[str]) -> Iterator[pa.RecordBatch]:
    held, first, size = [], 1, 0

    def out() -> pa.RecordBatch:
        n = len(held)
        return pa.RecordBatch.from_arrays([pa.array([archive] * n, pa.string()), pa.array([name] * n, pa.string()), pa.array(range(first, first + n), pa.int64()), pa.array(held, pa.string())], _NAMES)

    for line in lines:
        held.append(line)
        size += len(line)
        if size > AT_ONCE:
            yield out()
            held, first, size = [], first + len(held), 0
    if held:
        yield out()


def _bad(archive: str, why: str | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([None], pa.string()), pa.array([None], pa.int64()), pa.array([why], pa.string())], _NAMES)


def _open(path: str):
    where, at = fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+://", path) else (fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path))
    return where.open_input_file(at)


def _read(archive: str, z: zipfile.ZipFile, names: list[str], suffixes: tuple[str, ...], sep: str | None = None) -> Iterator[pa.RecordBatch]:
    try:
        for name in names:
            with z.open(name) as member:
                for inner, pieces in _texts(name, _pieces(member), suffixes):
                    lines = text_lines(pieces)
                    yield from _batches(archive, inner, lines if sep is None else whole_records(lines, sep))
    except (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError):
        yield _bad(archive, None)


def list_members(files: DataFrame) -> DataFrame:
    """(archive, member, packed) of the members of zips (path), from their central directories; an archive that cannot be read has a null member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    with _open(path) as f, zipfile.ZipFile(f) as z:
                        found = [(i.filename, i.compress_size) for i in z.infolist() if _wanted(i.filename)]
                except (zipfile.BadZipFile, pa.ArrowInvalid):  # the latter for a seek to before the start of a short file
                    found = [(None, 0)]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(found), pa.string()), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.int64())], ["archive", "member", "packed"])

    return files.select("path").mapInArrow(run, "archive string, member string, packed long")


def read_archives(spark: SparkSession, paths: list[str] | str, keep_json: bool = False, sep: str | None = None) -> DataFrame:
    """(archive, member, line_no, line) of CSV and text members of zip files, nested ones too; with `sep` a line is a whole CSV record.

    Members are read apart from each other, so an archive of any size is spread over
    as many tasks as it has members and needs no more memory than pieces of one;
    lines end at line feeds and carriage returns. An archive that cannot be read, or
    not to its end, gives a row with a null member, a `.rar` one that says so.
    """
    suffixes = (".csv", ".txt", ".json") if keep_json else (".csv", ".txt")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{zip,rar}").load(paths)
    scheme, rar = F.regexp_extract("path", "^([a-z0-9]+):", 1), F.lower("path").endswith(".rar")
    members = saved(list_members(files.where(~rar & scheme.isin(*OPENED)).select("path")), "members")
    rows, size = members.agg(F.count("*"), F.coalesce(F.sum("packed"), F.lit(0))).first()
    kept = members.where(F.col("member").isNotNull() & F.lower("member").rlike(r"\.(zip|csv|txt" + ("|json" if keep_json else "") + ")$"))
    tasks = max(1, min(rows, -(-size // SHARE) + spark.sparkContext.defaultParallelism))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names: dict[str, list[str]] = {}
            for archive, member in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                names.setdefault(archive, []).append(member)
            for archive, own in names.items():
                with _open(archive) as f, zipfile.ZipFile(f) as z:
                    yield from _read(archive, z, own, suffixes, sep)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        yield from _read(path, z, [x for x in z.namelist() if _wanted(x)], suffixes, sep)
                except zipfile.BadZipFile:
                    yield _bad(path, None)

    schema = "archive string, member string, line_no long, line string"
    lines = kept.select("archive", "member").repartition(tasks).mapInArrow(unpack, schema)
    lines = lines.unionByName(files.where(~rar & ~scheme.isin(*OPENED)).select("path", "content").mapInArrow(whole, schema))
    none, n = F.lit(None).cast("string").alias("member"), F.lit(None).cast("long").alias("line_no")
    failed = members.where("member is null").select("archive", none, n, F.lit(None).cast("string").alias("line"))
    return lines.unionByName(failed).unionByName(files.where(rar).select(F.col("path").alias("archive"), none, n, F.lit("rar archives are not read").alias("line")))

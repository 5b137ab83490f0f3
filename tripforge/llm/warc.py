"""WARC archives as a PySpark Python data source, for reading and writing.

Reading plans one partition per archive file; the writer starts a new file at
`maxFileBytes`, so partitions stay bounded. Of each record the headers are
parsed first; predicates on the record type and other header columns that Spark
pushes down, or the `recordTypes` option names, are tested then. A rejected
record's payload is not decoded: files of this writer carry each member's
compressed length in the gzip extra field `sl`, so the reader seeks past it.
Other gzip files are unpacked in pieces of PIECE bytes, whatever the members that
they are cut into; of a rejected record no more is held at a time. Uncompressed
archives are seeked through by Content-Length.

Payloads of HTTP responses come without transfer and content encodings. A glob is no
path. A path that is not there raises, as does a file that ends within a record or
holds something else; an empty folder or file has no records.

Paths may be local or any URI that pyarrow.fs.FileSystem.from_uri knows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from tripforge.work import saved

SCHEMA = "record_type string, record_id string, target_uri string, warc_date string, refers_to string, content_type string, payload_digest string, content_length long, payload binary, file string, offset long"
#: Which header each column holds.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "warc_date": "warc-date", "refers_to": "warc-refers-to", "content_type": "content-type", "payload_digest": "warc-payload-digest"}
MAX_FILE_BYTES = 64 << 20
#: Bytes that reading first inflates of a record to find its headers, and those that headers may take.
HEAD, MOST_HEAD = 2_048, 1 << 20
#: Bytes that are unpacked at a time of gzip files that do not name their members' lengths.
PIECE = 1 << 18
_MAGIC = b"\x1f\x8b\x08\x04"


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _clean(value: str | None) -> str | None:
    """A header value on one line."""
    return None if value is None else " ".join(value.replace("\x00", " ").split())


def record_bytes(row: dict) -> bytes:
    """One record, uncompressed. A payload of a response goes behind an HTTP response head."""
    payload = bytes(row.get("payload") or b"")
    kind = row.get("record_type") or "resource"
    if kind in ("response", "revisit"):
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        block += b"Content-Length: %d\r\n\r\n" % len(payload) + payload if kind == "response" else b"\r\n"
        content = "application/http; msgtype=response"
    else:
        block, content = payload, row.get("content_type") or "application/octet-stream"
    named = [("WARC-Type", kind), ("WARC-Record-ID", row.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", row.get("warc_date") or "1970-01-01T00:00:00Z"), ("WARC-Target-URI", row.get("target_uri")), ("WARC-Refers-To", row.get("refers_to")), ("WARC-Payload-Digest", row.get("payload_digest")), ("Content-Type", content)]
    if kind == "revisit":
        named.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    head = "".join(f"{k}: {_clean(v)}\r\n" for k, v in named if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    """One gzip member that names its own compressed and uncompressed length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    head = _MAGIC + bytes(5) + b"\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, len(body), len(data) & 0xFFFFFFFF)
    return head + body + tail


def parse_head(data: bytes) -> tuple[dict[str, str], int] | None:
    """Lower-cased headers and where the block begins; None when the headers do not end in `data`."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record but {lines[0][:40]!r}")
    out = _fields(lines[1:])
    uri = out.get("warc-target-uri", "")
    if uri.startswith("<") and uri.endswith(">"):  # as older archives write it
        out["warc-target-uri"] = uri[1:-1]
    return out, end + 4


def _fields(lines: list[str]) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with a blank goes on with the one before."""
    out: dict[str, str] = {}
    name = ""
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            out[name] = f"{out[name]} {line.strip()}".strip()
            continue
        name, _, value = line.partition(":")
        name = name.strip().lower()
        out[name] = value.strip()
    return out


def _dechunked(body: bytes) -> bytes | None:
    """A chunked body put together; null if it is none, as where an archive's writer has done that already."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not size or not set(size) <= set(b"0123456789abcdefABCDEF"):
            return None
        n = int(size, 16)
        if not n:
            return b"".join(out)
        piece = body[end + 2 : end + 2 + n]
        if len(piece) < n or body[end + 2 + n : end + 4 + n] != b"\r\n":
            return None
        out.append(piece)
        at = end + 4 + n


def decoded_body(head: bytes, body: bytes) -> bytes:
    """An HTTP body without its transfer and content encodings (chunked; gzip, deflate). One that is not as its head says, or of another encoding, stays as it is."""
    fields = _fields(head.decode("latin-1").split("\r\n")[1:])
    if "chunked" in fields.get("transfer-encoding", "").lower() and (whole := _dechunked(body)) is not None:
        body = whole
    for encoding in reversed([x.strip() for x in fields.get("content-encoding", "").lower().split(",")]):
        if encoding not in ("gzip", "x-gzip", "deflate"):
            break
        try:
            unpack = zlib.decompressobj(47)  # the head tells gzip from zlib
            body = unpack.decompress(body) + unpack.flush()
        except zlib.error:
            break
    return body


def _payload(headers: dict[str, str], block: bytes) -> bytes:
    """A record's block without the HTTP head of a response and the encodings that it names; a revisit has none."""
    kind = headers.get("content-type", "")
    if headers.get("warc-type") == "revisit":
        return b""
    if kind.startswith("application/http"):
        head, _, body = block.partition(b"\r\n\r\n")
        return decoded_body(head, body)
    return block


def _wanted(headers: dict[str, str], tests: list[tuple[str, str, tuple]]) -> bool:
    for header, how, values in tests:
        own = headers.get(header)
        if own is None or (how == "in" and own not in values) or (how == "starts" and not own.startswith(values)):
            return False
    return True


def _unpacked(f, at: int) -> Iterator[tuple[int, bytes]]:
    """(where its gzip member begins, bytes) of a file from `at` on, PIECE bytes at a time."""
    f.seek(at)
    raw = f.read(PIECE)
    while raw:
        start, unpack = f.tell() - len(raw), zlib.decompressobj(31)
        while not unpack.eof:
            data = unpack.decompress(raw, PIECE)
            raw = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
            if data:
                yield start, data
            elif not unpack.eof and not raw:
                raw = f.read(PIECE)
                if not raw:
                    raise ValueError(f"gzip member cut off at {start}")
        raw = (raw or f.read(PIECE)).lstrip(b"\x00")


def _streamed(f, at: int, tests: list[tuple[str, str, tuple]], with_payload: bool) -> Iterator[tuple[int, dict[str, str], bytes | None]]:
    """As `records`, of a gzip file from `at` on whose members hold any number of records, or parts of one. An offset is that of the member in which the record begins."""
    pieces, held, origins = _unpacked(f, at), bytearray(), []

    def more() -> bool:
        got = next(pieces, None)
        if got is not None:
            origins.append((len(held), got[0]))
            held.extend(got[1])
        return got is not None

    def drop(n: int) -> None:
        del held[:n]
        origins[:] = [(max(0, i - n), o) for k, (i, o) in enumerate(origins) if k + 1 == len(origins) or origins[k + 1][0] > n]

    while True:
        blank = 0
        while blank == len(held) or held[blank] in b"\r\n":
            if blank < len(held):
                blank += 1
            elif not more():
                return
        drop(blank)
        origin = origins[0][1]
        while (end := held.find(b"\r\n\r\n")) < 0:
            if len(held) > MOST_HEAD or not more():
                raise ValueError(f"record without end of headers at {origin}")
        head = parse_head(bytes(held[: end + 4]))
        headers, start = head
        drop(start)
        left, block = int(headers.get("content-length", 0)), bytearray()
        wanted = _wanted(headers, tests)
        while left:
            if not held and not more():
                raise ValueError(f"record cut off at {origin}")
            n = min(left, len(held))
            if wanted and with_payload:
                block += held[:n]
            drop(n)
            left -= n
        if wanted:
            yield origin, headers, _payload(headers, bytes(block)) if with_payload else None


def records(f, tests: list[tuple[str, str, tuple]], with_payload: bool) -> Iterator[tuple[int, dict[str, str], bytes | None]]:
    """(offset, headers, payload or None) of a file's records that pass the header tests."""
    size, at = f.size(), 0
    while at < size:
        f.seek(at)
        lead = f.read(24)
        if blank := len(lead) - len(lead.lstrip(b"\r\n")):
            at += blank
            continue
        if lead[:2] == b"\x1f\x8b":
            if lead[:4] != _MAGIC or lead[12:14] != b"sl":
                yield from _streamed(f, at, tests, with_payload)
                return
            extra, (packed,) = struct.unpack("<H", lead[10:12])[0], struct.unpack("<I", lead[16:20])
            begin = at + 12 + extra
            nxt = begin + packed + 8
            unpack = zlib.decompressobj(-15)
            f.seek(begin)
            raw = f.read(min(packed, HEAD))
            data, got = unpack.decompress(raw), len(raw)
            while (head := parse_head(data)) is None and got < packed:
                raw = f.read(min(packed - got, 16 * HEAD))
                got += len(raw)
                data += unpack.decompress(raw)
            if head is None:
                raise ValueError(f"record without end of headers at {at}")
            headers, start = head
            if _wanted(headers, tests):
                if with_payload:
                    data += unpack.decompress(f.read(packed - got)) + unpack.flush()
                    length = int(headers.get("content-length", 0))
                    yield at, headers, _payload(headers, data[start : start + length])
                else:
                    yield at, headers, None
            at = nxt
            continue
        f.seek(at)
        data = f.read(HEAD)
        while (head := parse_head(data)) is None:
            more = f.read(16 * HEAD)
            if not more or len(data) > MOST_HEAD:
                raise ValueError(f"record without end of headers at {at}")
            data += more
        headers, start = head
        length = int(headers.get("content-length", 0))
        if at + start + length > size:
            raise ValueError(f"record cut off at {at}")
        if _wanted(headers, tests):
            block = None
            if with_payload:
                f.seek(at + start)
                block = _payload(headers, f.read(length))
            yield at, headers, block
        at += start + length


@dataclass
class File(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.tests: list[tuple[str, str, tuple]] = []
        if types := options.get("recordtypes"):
            self.tests.append(("warc-type", "in", tuple(x.strip() for x in types.split(","))))

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else ""
            header = HEADERS.get(column)
            if header and isinstance(f, EqualTo):
                self.tests.append((header, "in", (f.value,)))
            elif header and isinstance(f, In):
                self.tests.append((header, "in", tuple(f.value)))
            elif header and isinstance(f, StringStartsWith):
                self.tests.append((header, "starts", (f.value,)))
            elif header and isinstance(f, IsNotNull):
                self.tests.append((header, "there", ()))
            else:
                yield f

    def partitions(self):
        where, path = _at(self.path)
        info = where.get_file_info(path)
        prefix = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else ""
        if info.type == fs.FileType.File:
            return [File(self.path)]
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no WARC archives at {self.path}")
        found = where.get_file_info(fs.FileSelector(path, recursive=True))
        return [File(prefix + x.path) for x in sorted(found, key=lambda x: x.path) if x.type == fs.FileType.File and not x.base_name.startswith((".", "_")) and x.base_name.endswith((".warc", ".warc.gz"))] or [File("")]

    def read(self, partition):
        if not partition.path:
            return
        where, path = _at(partition.path)
        names, held = [x.split()[0] for x in SCHEMA.split(", ")], 0
        kinds = {"long": pa.int64(), "binary": pa.binary()}
        types = [kinds.get(x.split()[1], pa.string()) for x in SCHEMA.split(", ")]
        rows: list[list] = [[] for _ in names]

        def batch() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)
            for c in rows:
                c.clear()
            return got

        with where.open_input_file(path) as f:
            for at, headers, payload in records(f, self.tests, self.with_payload):
                values = [headers.get(HEADERS[n]) for n in names[:7]] + [int(headers.get("content-length", 0)), payload, partition.path, at]
                for c, v in zip(rows, values):
                    c.append(v)
                held += 500 + len(payload or b"")
                if held > 8_000_000:
                    yield batch()
                    held = 0
        if rows[0]:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict, columns: list[str], overwrite: bool) -> None:
        self.path, self.columns, self.overwrite = options["path"], columns, overwrite
        self.most = int(options.get("maxfilebytes", MAX_FILE_BYTES))
        self.packed = options.get("compression", "gzip").lower() == "gzip"

    def write(self, iterator) -> Written:
        """Files under hidden names that no other attempt uses; commit() makes them visible."""
        where, path = _at(self.path)
        where.create_dir(path, recursive=True)
        names, f, size = [], None, 0
        for row in iterator:
            if f is None or size >= self.most:
                if f is not None:
                    f.close()
                names.append(f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.packed)
                f, size = where.open_output_stream(f"{path}/.{names[-1]}", compression=None), 0
            data = record_bytes(dict(zip(self.columns, row)))
            data = gzip_member(data) if self.packed else data
            f.write(data)
            size += len(data)
        if f is not None:
            f.close()
        return Written(names)

    def commit(self, messages) -> None:
        where, path = _at(self.path)
        where.create_dir(path, recursive=True)
        new = {n for m in messages if m is not None for n in m.names}
        if self.overwrite:
            for x in where.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                if x.type == fs.FileType.File and x.base_name.removeprefix(".") not in new:
                    where.delete_file(x.path)
        for n in sorted(new):
            where.move(f"{path}/.{n}", f"{path}/{n}")

    def abort(self, messages) -> None:
        where, path = _at(self.path)
        for m in messages:
            for n in m.names if m is not None else ():
                where.delete_file(f"{path}/.{n}")


class WarcSource(DataSource):
    """Options: path; recordTypes (comma list); payload (false: null payloads); compression (gzip or none); maxFileBytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter({k.lower(): v for k, v in self.options.items()}, schema.names, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def write_warc(df: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    """Writes a record per row of `df`, whose columns are those of SCHEMA that matter; other columns are ignored."""
    register(df.sparkSession)
    df.write.format("warc").mode(mode).options(**options).save(path)


# ---- archives of pages ----------------------------------------------------------------------------------------------

#: Bytes from which equal payloads are stored once.
LEAST_REVISIT = 100
#: Digests of repeated payloads that are broadcast, at most; beyond that they are joined by shuffle.
BROADCAST_DIGESTS = 100_000


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One WARC row per page; payloads of LEAST_REVISIT bytes or more that equal that of a page with a smaller id become revisits.

    A null html is an empty payload. Pages with a null id are responses unless
    another page with an id has their payload; rows that repeat an id and its
    payload are all responses.
    """
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("target_uri"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    base = base.withColumn("digest", F.sha2("payload", 256))
    first = base.where(F.octet_length("payload") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first")
    few = first.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS
    joined = base.join(F.broadcast(first) if few else first, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))

    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))

    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        urn(F.col("page_id")).alias("record_id"),
        "target_uri",
        F.when(again, urn(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; revisits take theirs from the record that they refer to."""
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")
    responses = read_warc(spark, path).where("record_type = 'response'").select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    revisits = read_warc(spark, path, payload="false").where("record_type = 'revisit'").select("record_id", "refers_to", F.regexp_replace("payload_digest", "^sha256:", "").alias("told"))
    kept = saved(responses, "responses")
    sizes = kept.groupBy(F.col("record_id").alias("refers_to"), F.col("payload_digest").alias("told")).agg(F.max("payload_bytes").alias("payload_bytes"))
    resolved = revisits.join(sizes, ["refers_to", "told"], "left")
    one = kept.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    two = resolved.select(number("record_id").alias("page_id"), "payload_bytes", F.col("told").alias("payload_digest"), F.lit("revisit").alias("record_type"), number("refers_to").alias("refers_to"))
    return one.unionByName(two)

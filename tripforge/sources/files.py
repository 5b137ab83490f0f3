"""Reading raw feeds: all-text CSV by header signature, JSON, archives, legacy charsets, headers."""

from __future__ import annotations

import csv
import io
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripforge.sources.archives import read_archives  # noqa: F401
from tripforge.sources.lines import balanced_quotes, cell_texts, parse_lines
from tripforge.sources.records import broken_files, bytewise, file_path, read_records

#: A value that no file holds, so that an empty quoted text stays apart from a missing one.
_NEVER = "\u0001"


def text_schema(header: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in header])


#: Where a row stands: its file, the block that it was read from, and a number that rises within the block.
PLACE = ("source_file", "__start", "__n")


def _place() -> list[Column]:
    return [file_path().alias(PLACE[0]), F.col("_metadata.file_block_start").alias(PLACE[1]), F.monotonically_increasing_id().alias(PLACE[2])]


def read_csv(spark: SparkSession, paths: list[str] | str, header: list[str], sep: str = ",", encoding: str = "UTF-8", with_header: bool = True, quarantine: bool = False, place: bool = False, broken: list[str] | None = None) -> DataFrame:
    """Every column as text; `.gz` is read as such; with `place` the columns PLACE as well. A row of another width raises, or with `quarantine` lands in `_corrupt`.

    Cells are those of RFC 4180: a doubled quote in a quoted cell is one quote, and a
    quoted cell may hold separators and line breaks, which stay as they are. Files
    with such breaks, `broken`, are found by counting quotes if they are not given, one
    pass more over the files, and are read by `read_records`; in other files a cell with a
    break is a row of another width. Charsets that write quotes and breaks with other
    bytes than ASCII are read a file a task.

    Rows are parsed whole whatever columns a query takes, so that a row of
    another width is found by every query that reads rows.
    """
    whole = broken is None and not bytewise(encoding)
    if broken is None:
        broken = [] if whole else broken_files(spark, paths)
    rest, broken = _apart(spark, paths, broken)
    reader = spark.read.option("header", with_header).option("sep", sep).option("quote", '"').option("escape", '"').option("encoding", encoding).option("nullValue", _NEVER).option("emptyValue", "").option("enforceSchema", "true").option("columnPruning", "false").option("multiLine", whole)
    schema = text_schema(header)
    if quarantine:
        schema = schema.add("_corrupt", StringType())
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    else:
        reader = reader.option("mode", "FAILFAST")
    names = [f"`{c}`" for c in schema.names]
    parts = []
    if rest:
        plain = reader.schema(schema).csv(rest)
        parts.append(plain.select(*names, *_place()) if place else plain)
    if broken:
        records = read_records(spark, broken, sep, encoding)
        if with_header:
            first = records.where("start = 0").groupBy("file").agg(F.min("n").alias("__first"))
            # a row for each of the files that `broken` names
            records = records.join(F.broadcast(first), "file").where("start > 0 or n > __first").drop("__first")
        parsed = parse_lines(records.toDF(*PLACE, "line"), text_schema(header), sep, quarantine)
        parts.append(parsed.select(*names, *(PLACE if place else ())))
    return reduce(DataFrame.unionByName, parts)


def _apart(spark: SparkSession, paths: list[str] | str, broken: list[str]) -> tuple[list[str] | str, list[str]]:
    """(the other files below `paths`, those of them that are in `broken`)."""
    if not broken:
        return paths, []
    plain = lambda p: re.sub(r"^file:/+", "/", p)
    known = {plain(b) for b in broken}
    every = [r.path for r in spark.read.format("binaryFile").load(paths).select("path").orderBy("path").collect()]
    return [p for p in every if plain(p) not in known], [p for p in every if plain(p) in known]


def read_whole_lines(spark: SparkSession, paths: list[str] | str, sep: str = ",", encoding: str = "UTF-8", broken: list[str] = ()) -> DataFrame:
    """`read_lines`, but of files in `broken` a line is a whole record, with the line breaks of quoted cells."""
    rest, broken = _apart(spark, paths, list(broken))
    parts = ([read_lines(spark, rest, encoding)] if rest else []) + ([read_records(spark, broken, sep, encoding)] if broken else [])
    return reduce(DataFrame.unionByName, parts)


def read_lines(spark: SparkSession, paths: list[str] | str, encoding: str = "UTF-8") -> DataFrame:
    """(file, start, n, line) of the lines with anything in them, decoded; (start, n) gives their order in a file."""
    # a parser whose separator and quote no text holds leaves lines whole and knows all charsets
    lines = spark.read.option("sep", _NEVER).option("quote", "\u0002").option("escape", "\u0002").option("encoding", encoding).option("mode", "FAILFAST").schema("line string").csv(paths)
    return lines.select(file_path().alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"), "line")


def numbered(rows: DataFrame, file: str, start: str, n: str, out: str) -> DataFrame:
    """Adds `out`, which rises with a row's place in its file. Rows are numbered within the blocks that Spark reads, so no task sorts a whole file."""
    return rows.withColumn(out, F.col(start) + F.row_number().over(Window.partitionBy(file, start).orderBy(n)))


def listing(spark: SparkSession, root: str, include: list[str] = (), exclude: list[str] = (), glob: str = "*.csv*") -> DataFrame:
    """path, length, modificationTime of input files: the base name holds any of `include`, the whole path none of `exclude`, no `__MACOSX` folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root).select("path", "length", "modificationTime")
    return files.where(wanted_path(F.col("path"), include, exclude))


def wanted_path(path: Column, include: list[str] | str = (), exclude: list[str] = ()) -> Column:
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    include = [include] if isinstance(include, str) else list(include)
    keep = F.lit(True) if not include else F.lit(False)
    for word in include:
        keep = keep | base.contains(word)
    for word in (*exclude, "/__MACOSX/"):
        keep = keep & ~path.contains(word)
    return keep


def wanted(path: str, include: list[str] = (), exclude: list[str] = ()) -> bool:
    """`wanted_path` of one path."""
    base = path.rsplit("/", 1)[-1]
    return (not include or any(w in base for w in include)) and not any(w in path for w in (*exclude, "/__MACOSX/"))


def ignored(spark: SparkSession, root: str, include: list[str] = (), exclude: list[str] = (), glob: str = "*.csv*") -> DataFrame:
    """The files that `listing` leaves out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root).select("path", "length", "modificationTime")
    return files.where(~wanted_path(F.col("path"), include, exclude))


def headers(spark: SparkSession, paths: list[str] | str, encoding: str = "UTF-8", sep: str = ",") -> DataFrame:
    """(file, header): the first record of each file that has anything in it."""
    found = first_lines(read_lines(spark, paths, encoding))
    if not bytewise(encoding):
        return found
    cut = [r.file for r in found.where(~balanced_quotes(F.col("header"))).select("file").collect()]
    if not cut:
        return found
    # a name with a line break
    return found.where(~F.col("file").isin(cut)).unionByName(first_lines(read_records(spark, cut, sep, encoding)))


def first_lines(lines: DataFrame) -> DataFrame:
    """(file, header) of `read_lines`."""
    return lines.where("start = 0").groupBy("file").agg(F.min_by("line", "n").alias("header"))


def parse_header(line: str, sep: str = ",") -> tuple[str, ...]:
    """Column names of a header line; names in quotes may hold the separator."""
    line = line.lstrip("\ufeff")
    names = next(csv.reader(io.StringIO(line, newline=""), delimiter=sep, skipinitialspace=True)) if len(sep) == 1 else line.split(sep)
    return tuple(x.strip().strip('"').strip() for x in names)


def header_signatures(spark: SparkSession, paths: list[str] | str, sep: str = ",", encoding: str = "UTF-8") -> dict[tuple[str, ...], list[str]]:
    """Files by header. As many header groups as a feed has schema eras, and as many paths as it has files, reach the driver. Files without a line are left out."""
    out: dict[tuple[str, ...], list[str]] = {}
    for r in headers(spark, paths, encoding, sep).orderBy("file").collect():
        out.setdefault(parse_header(r.header, sep), []).append(r.file)
    return out


def header_census(found: DataFrame, sep: str = ",") -> DataFrame:
    """How many files carry each column; `found` is (file, header), split by the rules of `parse_header`."""
    names = cell_texts(F.regexp_replace("header", "^\ufeff", ""), sep)
    return found.select("file", F.explode(F.array_distinct(names)).alias("column")).groupBy("column").agg(F.count("*").alias("files"))


def column_inventory(df: DataFrame, file: str, targets: dict[str, str], samples: int = 5) -> DataFrame:
    """Per raw column: its target, in how many files it has values, and the first `samples` distinct values."""
    columns = [c for c in df.columns if c != file]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]))
    long = df.select(F.col(file).alias("file"), pairs.alias("p")).select("file", "p.*").where("value is not null")
    out = long.groupBy("column").agg(F.countDistinct("file").alias("files"))
    if samples:
        # tasks pass on their smallest values of a column only
        ranked = long.select("column", "value").distinct().withColumn("r", F.row_number().over(Window.partitionBy("column").orderBy("value"))).where(F.col("r") <= samples)
        out = out.join(ranked.groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("samples")), "column")
    to = F.create_map(*[F.lit(x) for kv in targets.items() for x in kv]) if targets else None
    return out.withColumn("target", F.try_element_at(to, F.col("column")) if to is not None else F.lit(None).cast("string"))


def json_field(raw: Column, name: str) -> Column:
    """A field of a JSON text; a wrapper object with one `$` key is unwrapped."""
    plain = F.get_json_object(raw, f"$.{name}")
    return F.coalesce(F.get_json_object(raw, f"$.{name}.$date"), F.get_json_object(raw, f"$.{name}.$oid"), plain)


def read_ndjson(spark: SparkSession, paths: list[str] | str, fields: list[str], required: list[str] = (), with_file: bool = False) -> DataFrame:
    """Fields of JSON lines as text, and source_file where asked for; a line is parsed once, for all of them. Blank lines are skipped; a line that is no JSON, or lacks a required field, raises."""
    lines = spark.read.text(paths).where(F.trim("value") != "")
    schema = StructType([*text_schema(fields).fields, StructField("__corrupt", StringType())])
    parsed = lines.select(F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"}).alias("r"), "value", *([file_path().alias("source_file")] if with_file else []))
    sound = F.when(F.col("r.__corrupt").isNotNull() | F.col("r").isNull(), F.raise_error(F.concat(F.lit("no JSON: "), F.substring("value", 1, 80))).cast("boolean")).otherwise(True)

    def field(name: str) -> Column:
        raw = F.col("r").getField(name)
        wrapped = F.coalesce(F.get_json_object(raw, "$.$date"), F.get_json_object(raw, "$.$oid"), raw)
        value = F.when(raw.startswith("{"), wrapped).otherwise(raw)
        return F.when(value.isNull(), F.raise_error(F.lit(f"record without {name}"))).otherwise(value) if name in required else value

    return parsed.where(sound).select(*[field(f).alias(f) for f in fields], *(["source_file"] if with_file else []))


def read_gbfs_stations(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """id, name, lat, lng of `data.stations[]` documents."""
    docs = spark.read.schema("data struct<stations:array<struct<station_id:string,name:string,lat:double,lon:double>>>").option("multiLine", True).json(paths)
    return docs.select(F.explode("data.stations").alias("s")).select(F.col("s.station_id").alias("id"), "s.name", "s.lat", F.col("s.lon").alias("lng"))


def is_utf8(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, utf8): whether each file, unpacked if it is a `.gz`, is valid UTF-8 throughout. A file without a line is not listed."""
    lines = spark.read.text(paths)
    return lines.groupBy(file_path().alias("path")).agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"))


def pick_encoding(spark: SparkSession, paths: list[str] | str, declared: str) -> dict[str, list[str]]:
    """Files by charset: UTF-8 where the whole contents, unpacked, are valid, else the feed's declared one. As many paths as files reach the driver."""
    out: dict[str, list[str]] = {}
    for r in is_utf8(spark, paths).orderBy("path").collect():
        out.setdefault("UTF-8" if r.utf8 else declared, []).append(r.path)
    return out


def read_lossy_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(file, line): text lines with broken UTF-8 replaced."""
    return spark.read.text(paths).select(file_path().alias("file"), F.make_valid_utf8("value").alias("line"))


def read_reference_table(spark: SparkSession, path: str) -> DataFrame:
    """A committed table `id,name` or `id,name,lat,lng`: ids trimmed, coordinates leniently as numbers; a missing file raises."""
    header = next(iter(header_signatures(spark, path)))
    if not {"id", "name"} <= set(header):
        raise ValueError(f"no id and name in {path}")
    table = read_csv(spark, path, list(header)).withColumn("id", F.trim("id"))
    return table.withColumns({c: F.col(c).try_cast("double") for c in ("lat", "lng") if c in header})


def read_station_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Station files of differing columns, united by name as text, with `file` to tell which is newer."""
    parts = []
    for header, own in sorted(header_signatures(spark, paths).items()):
        rows = read_csv(spark, own, list(header), place=True)
        parts.append(rows.withColumn("file", F.substring_index("source_file", "/", -1)).drop(*PLACE))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out

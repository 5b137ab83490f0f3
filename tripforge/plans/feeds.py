"""Declarative feeds: how one system's raw files become canonical trips.

A feed names its steps; steps are functions (DataFrame, FeedSpec) -> DataFrame in
a registry that users extend with `register_step`. Files are grouped by charset
and header, each group is read with its own all-text schema and goes through the
steps, and the groups are united on the final columns.

Steps note values that they cannot take on the rows; one aggregate over all
groups settles them before a feed is handed out.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripforge.functions import time as tm
from tripforge.functions import values as vl
from tripforge.operators import columns as cols
from tripforge.operators import fill, lookups, quality
from tripforge.sources import files as src
from tripforge.sources import lines as ln
from tripforge.work import beside, file_system, put_in_place, saved

BASE_COLUMNS = {"start_time": "timestamp_ntz", "end_time": "timestamp_ntz", "start_station_name": "string", "end_station_name": "string"}
#: Names of column types in feed files; others count as text.
TYPES = {"Utf8": "string", "String": "string", "Int64": "bigint", "Float64": "double", "Date": "date", "Datetime": "timestamp_ntz", "Boolean": "boolean"}


#: Columns that the library adds to raw rows; no step of a feed takes them for data.
OWN = ("source_file", "source_row", "_corrupt", quality.GATE)


@dataclass
class FeedSpec:
    """One system's feed.

    Files: `include` and `exclude` pick paths; `sep` and `encoding` hold for
    headers and rows, with `detect_encoding` files that are valid UTF-8 are read
    as such; `json_fields` are the fields of `.json` files of JSON lines.
    Lines: `fixes` (part of a file's name, old, new), `delimiters` and
    `drop_unbalanced` repair them; `headers` (part of a file's name, header) and
    `headers_by_arity` are for files without a header of their own.
    Rows: another width than the header's raises, with `quarantine` such rows are
    left out and `quarantined` gives them; `ordered` adds source_row. Quoted cells may
    hold line breaks, which costs a count of quotes over the files, unless
    `quoted_breaks` is off or `drop_unbalanced` or `delimiters` work line by line.
    Columns in `required` must be there once the final ones are selected.
    """

    name: str
    steps: list[str]
    rename: dict[str, str] = field(default_factory=dict)
    formats: list[str] = field(default_factory=lambda: list(tm.DEFAULT_FORMATS))
    zone: str | None = None
    final: dict[str, str] = field(default_factory=lambda: dict(BASE_COLUMNS))
    sep: str = ","
    encoding: str = "UTF-8"
    detect_encoding: bool = False
    json_fields: list[str] = field(default_factory=list)
    null_values: list[str] = field(default_factory=list)
    include: list[str] = field(default_factory=list)
    exclude: list[str] = field(default_factory=list)
    fixes: list[tuple[str, str, str]] = field(default_factory=list)
    delimiters: bool = False
    drop_unbalanced: bool = False
    headers: list[tuple[str, str]] = field(default_factory=list)
    headers_by_arity: list[str] = field(default_factory=list)
    quarantine: bool = False
    quoted_breaks: bool = True
    ordered: bool = False
    required: list[str] = field(default_factory=lambda: ["start_time"])
    invalid: dict[str, list[str]] = field(default_factory=dict)
    allowed_ids: list[str] = field(default_factory=list)
    date_formats: list[str] = field(default_factory=lambda: ["y-M-d"])
    clock_formats: list[str] = field(default_factory=lambda: ["H:m:s"])
    lost_hour_files: list[str] = field(default_factory=list)
    eras: list[dict] = field(default_factory=list)
    on_missing: str = "raise"
    before: list[str] = field(default_factory=list)
    #: Dimensions, which a feed's text cannot hold: id, name; legacy_id, new_id; year, code, name.
    stations: DataFrame | None = None
    renumbering: DataFrame | None = None
    yearly_stations: DataFrame | None = None

    @classmethod
    def parse(cls, text: str) -> FeedSpec:
        """From JSON. Unknown keys raise; column types may use the names in TYPES."""
        raw = json.loads(text)
        if unknown := sorted(set(raw) - {f.name for f in fields(cls)}):
            raise KeyError(f"unknown feed keys: {', '.join(unknown)}")
        if "final" in raw:
            raw["final"] = {c: TYPES.get(t, t) for c, t in raw["final"].items()}
        return cls(**raw)


Step = Callable[[DataFrame, FeedSpec], DataFrame]
STEPS: dict[str, Step] = {}


def register_step(name: str) -> Callable[[Step], Step]:
    def add(f: Step) -> Step:
        STEPS[name] = f
        return f

    return add


@register_step("clean_headers")
def _clean_headers(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return cols.clean_headers(df)


@register_step("rename")
def _rename(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return cols.rename(df, spec.rename)


@register_step("null_values")
def _null_values(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return df.select(*[vl.sentinels_to_null(F.col(f"`{c}`"), tuple(spec.null_values)).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def _unless_found(df: DataFrame, keep: Column) -> DataFrame:
    """Rows that `keep` holds for, and rows with findings, so that what a step could not take is not lost without a word."""
    return df.where(keep | ~quality.unmarked() if quality.GATE in df.columns else keep)


@register_step("drop_all_null")
def _drop_all_null(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return _unless_found(df, cols.any_there(df, OWN))


@register_step("optional_as_text")
def _optional_as_text(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return cols.optional_as_text(df)


@register_step("remove_invalid")
def _remove_invalid(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return _unless_found(df, cols.without_values({c: v for c, v in spec.invalid.items() if c in df.columns}))


def _parsed(df: DataFrame, parse: Callable) -> DataFrame:
    """Parses start_time and end_time where they are text; values that do not parse are findings."""
    todo = [c for c in ("start_time", "end_time") if dict(df.dtypes).get(c) == "string"]
    if not todo:
        return df
    new = quality.marked(df.withColumns({f"__{c}": parse(F.col(c)) for c in todo}), {c: (quality.unparsed(F.col(c), F.col(f"__{c}")), F.col(c)) for c in todo})
    return new.drop(*todo).withColumnsRenamed({f"__{c}": c for c in todo})


@register_step("parse_times")
def _parse_times(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return _parsed(df, lambda c: tm.parse_ntz(c, tuple(spec.formats)))


@register_step("parse_offset_times")
def _parse_offset_times(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return _parsed(df, tm.parse_offset)


@register_step("parse_local_times")
def _parse_local_times(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return _parsed(df, lambda c: tm.to_local(c, spec.zone))


@register_step("epoch_millis")
def _epoch_millis(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return _parsed(df, tm.from_epoch_millis)


@register_step("recover_times")
def _recover_times(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Clock cells of `lost_hour_files` that lost their hour; needs `ordered`, and comes before steps that join."""
    own = reduce(lambda a, b: a | b, [F.col("source_file").endswith("/" + f) for f in spec.lost_hour_files], F.lit(False))
    whole = tm.combine_date_time(F.col("end_date"), F.col("end_clock"), tuple(spec.date_formats), tuple(spec.clock_formats))
    lost = df.where(own)
    repaired = fill.recover_clocks(lost, "source_file", "source_row", "end_clock", "start_clock", whole) if spec.lost_hour_files else lost
    return df.where(~own).unionByName(repaired)


@register_step("combine_times")
def _combine_times(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """start_time and end_time from start_date, start_clock, end_date and end_clock."""
    quality.require_columns(df, ("start_date", "start_clock", "end_date", "end_clock"))
    out = df
    for end in ("start", "end"):
        date, clock = F.col(f"{end}_date"), F.col(f"{end}_clock")
        out = out.withColumn(f"{end}_time", tm.combine_date_time(date, clock, tuple(spec.date_formats), tuple(spec.clock_formats)))
        out = quality.marked(out, {f"{end}_time": (quality.present(date) & quality.present(clock) & F.col(f"{end}_time").isNull(), F.concat_ws(" ", date, clock))})
    return out.drop("start_date", "start_clock", "end_date", "end_clock")


@register_step("two_digit_years")
def _two_digit_years(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return df.withColumns({c: tm.fix_two_digit_year(F.col(c)) for c in ("start_time", "end_time")})


@register_step("end_from_minutes")
def _end_from_minutes(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return df.withColumn("end_time", tm.end_from_minutes(F.col("start_time"), F.col("duration_minutes")))


@register_step("end_from_duration")
def _end_from_duration(df: DataFrame, spec: FeedSpec) -> DataFrame:
    known = [F.col(c) if c in df.columns else F.lit(None).cast("string") for c in ("duration_seconds", "duration_minutes")]
    if not {"duration_seconds", "duration_minutes"} & set(df.columns):
        raise quality.QualityError("neither duration_seconds nor duration_minutes")
    seconds = tm.unify_seconds(*known)
    end = F.col("end_time") if "end_time" in df.columns else F.lit(None).cast("timestamp_ntz")
    return df.withColumn("duration_seconds", seconds).withColumn("end_time", F.coalesce(end, tm.plus_seconds(F.col("start_time"), F.col("duration_seconds"))))


@register_step("odd_hour_duration")
def _odd_hour_duration(df: DataFrame, spec: FeedSpec) -> DataFrame:
    new = df.withColumn("__d", tm.hms_to_seconds(F.col("duration")))
    return quality.marked(new, {"duration": (quality.unparsed(F.col("duration"), F.col("__d")), F.col("duration"))}).drop("duration").withColumnRenamed("__d", "duration")


def _vocabulary(df: DataFrame, raw: str, out: str, table: dict) -> DataFrame:
    if raw not in df.columns:
        return df
    return quality.marked(df, {raw: (quality.unmapped(F.col(raw), table), F.col(raw))}).withColumn(out, vl.mapped(F.col(raw), table))


@register_step("gender")
def _gender(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return _vocabulary(df, "gender", "gender", vl.GENDERS)


@register_step("is_member")
def _is_member(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return _vocabulary(df, "membership_type", "is_member", vl.MEMBERS)


@register_step("bike_type")
def _bike_type(df: DataFrame, spec: FeedSpec) -> DataFrame:
    if "bike_type" not in df.columns:
        return df
    return _vocabulary(df.withColumn("bike_model", vl.clean(F.col("bike_type"))), "bike_type", "bike_type", vl.BIKE_TYPES)


@register_step("birth_year")
def _birth_year(df: DataFrame, spec: FeedSpec) -> DataFrame:
    if "birth_year" not in df.columns:
        return df
    raw = F.col("birth_year")
    return quality.marked(df, {"birth_year": (~vl.is_year(raw), raw)}).withColumn("birth_year", vl.birth_year(raw, strict=False))


@register_step("station_ids")
def _station_ids(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return df.withColumns({c: vl.station_id(F.col(c)) for c in ("start_station_id", "end_station_id") if c in df.columns})


def _named(df: DataFrame) -> DataFrame:
    """Findings for ids that got no name."""
    ends = [(f"{end}_station_id", f"{end}_station_name") for end in ("start", "end")]
    return quality.marked(df, {f"{key} without a name": (F.col(key).isNotNull() & F.col(name).isNull(), F.col(key)) for key, name in ends})


@register_step("station_names")
def _station_names(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return _named(lookups.name_both_ends(df, spec.stations, spec.allowed_ids))


@register_step("renumber_stations")
def _renumber_stations(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Legacy ids to new ones and to names; with on_missing `drop`, trips that lack one are left out."""
    out = lookups.renumber_and_name(df, spec.renumbering, spec.stations, "keep")
    return _unless_found(out, lookups.have_both_names()) if spec.on_missing == "drop" else _named(out)


@register_step("stations_by_year")
def _stations_by_year(df: DataFrame, spec: FeedSpec) -> DataFrame:
    out = lookups.name_by_year(df, spec.yearly_stations)
    codes = [(f"{end}_station_code", f"{end}_station_name") for end in ("start", "end")]
    return quality.marked(out, {f"{key} without a name": (F.col(key).isNotNull() & F.col(name).isNull(), F.col(key)) for key, name in codes})


@register_step("by_era")
def _by_era(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """The steps of the first of `eras` ({"has": columns, "steps": names}) whose columns are all there; none raises."""
    for era in spec.eras:
        if set(era["has"]) <= set(df.columns):
            return _run_steps(df, spec, era["steps"])
    raise quality.QualityError(f"{spec.name}: no era has the columns {', '.join(df.columns)}")


@register_step("select_final")
def _select_final(df: DataFrame, spec: FeedSpec) -> DataFrame:
    quality.require_columns(df, [c for c in spec.required if c in spec.final])
    own = [c for c in OWN if c in df.columns]
    return df.select(*cols.final_columns(df, spec.final), *own)


def _run_steps(df: DataFrame, spec: FeedSpec, steps: list[str]) -> DataFrame:
    return reduce(lambda d, name: STEPS[name](d, spec), steps, df)


def apply_steps(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """The feed's steps in order, settled; a name that is not registered raises KeyError."""
    return quality.settled(_run_steps(df, spec, spec.steps))


Hook = Callable[[SparkSession, FeedSpec], None]
HOOKS: dict[str, Hook] = {}


def register_hook(name: str) -> Callable[[Hook], Hook]:
    """Hooks run once before a feed is read, such as a refresh of its station table."""

    def add(f: Hook) -> Hook:
        HOOKS[name] = f
        return f

    return add


def run_hooks(spark: SparkSession, spec: FeedSpec) -> list[str]:
    """Runs the feed's hooks; an unknown name raises, a hook that fails is reported and does not stop the feed."""
    failed = []
    for hook in [(name, HOOKS[name]) for name in spec.before]:
        try:
            hook[1](spark, spec)
        except Exception as e:
            failed.append(f"{hook[0]}: {e}")
    return failed


#: Steps that take a missing column just as one without values, but for the columns in PRESENCE.
TOLERANT = {"null_values", "drop_all_null", "optional_as_text", "remove_invalid", "parse_times", "parse_offset_times", "parse_local_times", "epoch_millis", "two_digit_years", "gender", "is_member", "bike_type", "birth_year", "station_ids", "by_era", "select_final"}
PRESENCE = {"start_time", "end_time", "bike_type", "bike_model", "membership_type", "is_member"}
#: Steps on names alone, which are taken before the rows are read, and what they do.
ON_NAMES: dict[str, Callable[[list[str], FeedSpec], list[str]]] = {"clean_headers": lambda names, spec: cols.cleaned_headers(names), "rename": lambda names, spec: cols.renamed(names, spec.rename)}
_BUILT_IN = dict(STEPS)
#: Files whose headers are broadcast together, a row each; more files are read by further scans.
FILES = 100_000


def _alike(spec: FeedSpec, steps: list[str], names: list[str]) -> frozenset[str]:
    """What files must have in common to go through the steps as one table: the columns whose presence the steps ask for, or all where a step is not known to be tolerant."""
    every = [*steps, *(x for era in spec.eras for x in era["steps"])]
    if not all(x in TOLERANT and STEPS.get(x) is _BUILT_IN[x] for x in every):
        return frozenset(names)
    return frozenset(names) & {*PRESENCE, *spec.required, *spec.invalid, *(c for era in spec.eras for c in era["has"])}


def _mapped(spark: SparkSession, spec: FeedSpec, files: dict[str, list[str]], encoding: str, broken: list[str] | None) -> DataFrame:
    """Rows of files with differing headers, `files` with the names of their columns, under the union of the names. Files of one width are one scan; each file's cells go to their columns by a broadcast table of places."""
    columns = list(dict.fromkeys(c for names in files.values() for c in names))
    parts = []
    for width in sorted({len(names) for names in files.values()}):
        own = sorted(f for f, names in files.items() if len(names) == width)
        cells = [f"_{k}" for k in range(width)]
        rows = src.read_csv(spark, own, cells, spec.sep, encoding, quarantine=spec.quarantine, place=True, broken=broken)
        parts.append(rows.select(F.array(*cells).alias("__cells"), *src.PLACE, *(["_corrupt"] if spec.quarantine else [])))
    places = spark.createDataFrame([(f, [names.index(c) if c in names else -1 for c in columns]) for f, names in files.items()], "__file string, __at array<int>")
    rows = reduce(DataFrame.unionByName, parts).join(F.broadcast(places), F.col("source_file") == F.col("__file"))
    at = lambda k: F.get("__at", F.lit(k))
    return rows.select(*[F.when(at(k) >= 0, F.get("__cells", at(k))).alias(c) for k, c in enumerate(columns)], *(["_corrupt"] if spec.quarantine else []), *src.PLACE)


def _by_header(spark: SparkSession, spec: FeedSpec, paths: list[str], encoding: str) -> Iterator[tuple[DataFrame, list[str]]]:
    """Raw rows of files of one charset with source_file and the order of rows, a table for each kind of header that the steps tell apart, and the steps left to do."""
    by_line = spec.drop_unbalanced or spec.delimiters or not spec.quoted_breaks
    broken = [] if by_line else src.broken_files(spark, paths) if src.bytewise(encoding) else None
    if not (spec.fixes or spec.drop_unbalanced or spec.delimiters or spec.headers or spec.headers_by_arity):
        done = 0
        while done < len(spec.steps) and spec.steps[done] in ON_NAMES and STEPS[spec.steps[done]] is _BUILT_IN[spec.steps[done]]:
            done += 1
        kinds: dict[frozenset[str], dict[str, list[str]]] = {}
        for header, own in sorted(src.header_signatures(spark, paths, spec.sep, encoding).items()):
            names = reduce(lambda n, step: ON_NAMES[step](n, spec), spec.steps[:done], list(header))
            if done and len(set(names)) < len(names):
                raise ValueError(f"columns named twice in {own[0]}")
            kinds.setdefault(_alike(spec, spec.steps[done:], names), {}).update(dict.fromkeys(own, names))
        for files in kinds.values():
            listed = sorted(files)
            for k in range(0, len(listed), FILES):
                some = {f: files[f] for f in listed[k : k + FILES]}
                first = next(iter(some.values()))
                if all(names == first for names in some.values()):
                    rows = src.read_csv(spark, list(some), first, spec.sep, encoding, quarantine=spec.quarantine, place=True, broken=broken)
                else:
                    rows = _mapped(spark, spec, some, encoding, broken)
                yield rows if spec.ordered else rows.drop("__start", "__n"), spec.steps[done:]
        return
    sep = "," if spec.delimiters else spec.sep
    repaired = lambda own: ln.cleaned(src.read_whole_lines(spark, own, sep, encoding, broken or ()), spec.fixes, spec.drop_unbalanced, spec.delimiters)
    yield from _from_lines(spec, repaired(paths), repaired, sep)


def _from_lines(spec: FeedSpec, lines: DataFrame, of: Callable[[list[str]], DataFrame], sep: str) -> Iterator[tuple[DataFrame, list[str]]]:
    """Raw rows from lines (file, start, n, line) with or without headers of their own, a table per header; `of` gives the lines of some files."""
    groups: dict[tuple[str, str | None], list[str]] = {}
    arity = {len(src.parse_header(h, sep)): h for h in spec.headers_by_arity}
    firsts = ln.header_for_files(src.first_lines(lines).withColumnRenamed("header", "line"), spec.headers)
    known = firsts.where("header is not null").select("file", "header", F.lit(False).alias("own"))
    rest = firsts.where("header is null").select("file", F.lit(0).alias("n"), "line")
    if arity:
        rest = ln.header_by_arity(rest, arity, sep).select("file", "header", F.col("has_header").alias("own"))
    else:
        rest = rest.select("file", F.col("line").alias("header"), F.lit(True).alias("own"))
    for r in known.unionByName(rest).orderBy("file").collect():
        groups.setdefault((r.header, r.header if r.own else None), []).append(r.file)
    for (header, line), own in sorted(groups.items(), key=str):
        rows = of(own)
        rows = (rows if line is None else rows.where(F.col("line") != line)).withColumnsRenamed({"file": "source_file", "start": "__start", "n": "__n"})
        names = src.parse_header(header, sep)
        yield ln.parse_lines(rows, src.text_schema(list(names)), sep, spec.quarantine).select(*[f"`{c}`" for c in names], *(["_corrupt"] if spec.quarantine else []), "source_file", *(["__start", "__n"] if spec.ordered else [])), spec.steps


def raw_tables(spark: SparkSession, spec: FeedSpec, paths: list[str] | DataFrame) -> list[tuple[DataFrame, list[str]]]:
    """The feed's files as text columns, a table for each charset and kind of header, with source_file and, where asked for, source_row and _corrupt; and the steps that each still goes through. No file left raises."""
    if isinstance(paths, DataFrame):
        kept_lines = ln.cleaned(paths.where(src.wanted_path(F.col("file"), spec.include, spec.exclude)), spec.fixes, spec.drop_unbalanced, spec.delimiters)
        tables = list(_from_lines(spec, kept_lines, lambda own: kept_lines.where(F.col("file").isin(own)), "," if spec.delimiters else spec.sep))
        return [(_ordered(t, spec), steps) for t, steps in tables]
    kept = [p for p in paths if src.wanted(p, spec.include, spec.exclude)]
    if not kept:
        raise quality.QualityError(f"{spec.name}: no input files")
    is_json = lambda p: p.removesuffix(".gz").endswith(".json")
    documents = [p for p in kept if is_json(p)]
    if documents and not spec.json_fields:
        raise quality.QualityError(f"{spec.name}: no json_fields for {documents[0]}")
    tables = [(src.read_ndjson(spark, documents, spec.json_fields, with_file=True), spec.steps)] if documents else []
    if texts := [p for p in kept if not is_json(p)]:
        charsets = src.pick_encoding(spark, texts, spec.encoding) if spec.detect_encoding else {spec.encoding: texts}
        for encoding, own in sorted(charsets.items()):
            tables += _by_header(spark, spec, own, encoding)
    return [(_ordered(t, spec), steps) for t, steps in tables]


def _ordered(table: DataFrame, spec: FeedSpec) -> DataFrame:
    return src.numbered(table, "source_file", "__start", "__n", "source_row").drop("__start", "__n") if spec.ordered and "__n" in table.columns else table


def quarantined(spark: SparkSession, spec: FeedSpec, paths: list[str]) -> DataFrame:
    """(source_file, line) of the rows that a feed with `quarantine` leaves out."""

    def set_aside(t: DataFrame) -> DataFrame:
        # Spark reads the corrupt column only beside another one
        another = F.coalesce(F.length(F.col(f"`{t.columns[0]}`")) >= 0, F.lit(True))
        return t.where(F.col("_corrupt").isNotNull() & another).select("source_file", F.col("_corrupt").alias("line"))

    none = spark.createDataFrame([], "source_file string, line string")
    return reduce(DataFrame.unionByName, [set_aside(t) for t, _ in raw_tables(spark, spec, paths) if "_corrupt" in t.columns], none)


#: The check that rows of another width do not pass.
WIDTH = "row of another width"


def _noted(spark: SparkSession, spec: FeedSpec, paths: list[str], aside: bool = False) -> DataFrame:
    """Trips with the findings of all steps in quality.GATE. Rows of another width are left out, or with `aside` are rows without values and a finding that holds the line."""
    for message in run_hooks(spark, spec):
        warnings.warn(message, stacklevel=3)
    parts = []
    for raw, steps in raw_tables(spark, spec, paths):
        if "_corrupt" in raw.columns and aside:
            sound = F.col("_corrupt").isNull()
            emptied = raw.select(*[F.when(sound, F.col(f"`{c}`")).alias(c) for c in raw.columns if c not in OWN], *[c for c in raw.columns if c in OWN])
            raw = quality.marked(emptied, {WIDTH: (~sound, F.col("_corrupt"))}).drop("_corrupt")
        elif "_corrupt" in raw.columns:
            raw = raw.where("_corrupt is null").drop("_corrupt")
        done = _select_final(_run_steps(raw, spec, steps), spec)
        parts.append(done if quality.GATE in done.columns else quality.marked(done, {}))
    if not parts:
        parts = [quality.marked(spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in (spec.final | {"source_file": "string"}).items())), {})]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.withColumn("city", F.lit(spec.name)).withColumn("year", F.year("start_time")).withColumn("month", F.month("start_time"))


def read_feed(spark: SparkSession, spec: FeedSpec, paths: list[str] | DataFrame, settle: bool = True) -> DataFrame:
    """Canonical trips of files whose headers may differ, with city, year, month and source_file; `paths` may be a table of their lines (file, start, n, line) instead.

    One pass over the files settles every gate; the trips themselves are read
    when they are used (`publish_feed` does both in one pass). Without `settle` trips carry
    their findings, for `incremental.run`, which settles them as it writes. Files without a
    line add nothing.
    """
    rows = _noted(spark, spec, paths).drop("source_row")
    return quality.settled(rows) if settle else rows


def publish_feed(spark: SparkSession, spec: FeedSpec, paths: list[str], table: str, dead: str | None = None) -> dict[str, int]:
    """Writes a feed's trips by year and month in place of what is at `table`, reading the files once; returns rows kept and rows with findings.

    The trips go to a folder beside `table`, and the write itself counts the rows that
    a gate would stop. Without any the folder takes the place of `table`; else it
    is discarded, `table` stays as it is, and QualityError names checks and offenders
    (for which the files are read again).

    With `dead` such rows, and those of another width, are left out instead, and their
    findings replace what is there: source_file, source_row (null unless the feed is
    `ordered`), step (the check), value. Then rows and findings are parsed into one
    table in the shared folder, and both are written from that.
    """
    staged = beside(table)
    fs, to_path = file_system(spark, table)
    if dead is None:
        rows, told = _noted(spark, spec, paths), Observation()
        seen = rows.observe(told, F.count_if(quality.unmarked()).alias("kept"), F.count_if(~quality.unmarked()).alias("found"))
        write_trips(seen.where(quality.unmarked()).drop(quality.GATE, "source_row"), staged)
        if told.get["found"]:
            fs.delete(to_path(staged), True)
            quality.settled(rows)
            raise quality.QualityError(f"{spec.name}: findings that were not met again")
        put_in_place(spark, staged, table)
        return {"kept": told.get["kept"], "found": 0}
    rows, told = _noted(spark, replace(spec, quarantine=True), paths, aside=True), Observation()
    rows = rows if "source_row" in rows.columns else rows.withColumn("source_row", F.lit(None).cast("bigint"))
    parsed = saved(rows.observe(told, F.count_if(quality.unmarked()).alias("kept"), F.count_if(~quality.unmarked()).alias("found")), "parsed")
    write_trips(parsed.where(quality.unmarked()).drop(quality.GATE, "source_row"), staged)
    letters = beside(dead)
    parsed.where(~quality.unmarked()).select("source_file", "source_row", F.explode(quality.GATE).alias("c")).select("source_file", "source_row", F.col("c.name").alias("step"), "c.value").write.parquet(letters)
    put_in_place(spark, letters, dead)
    put_in_place(spark, staged, table)
    return {k: told.get[k] for k in ("kept", "found")}


def write_trips(trips: DataFrame, path: str) -> None:
    """The whole trip table, partitioned by year and month, in place of what is at `path`; no trips leave it empty. Trips without a start go to the null partition. A large month is written by several tasks."""
    cols.spread_by_month(trips).write.partitionBy("year", "month").mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


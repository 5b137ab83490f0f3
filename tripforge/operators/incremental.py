"""Incremental processing by manifests: which inputs changed, which outputs nobody produces any more."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.operators import quality
from tripforge.operators.columns import spread_by_month
from tripforge.work import beside, file_system, put_in_place, saved

SIGNATURE = ("path", "length", "modified")


def manifest(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, length and modified of the files below `path`; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", F.col("modificationTime").cast("timestamp_ntz").alias("modified"))


def changed(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Inputs that are new or whose size or time differs."""
    return current.join(stored.select(*SIGNATURE), list(SIGNATURE), "left_anti")


def removed(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Recorded inputs that are gone."""
    return stored.join(current.select("path"), "path", "left_anti")


def diff(current: DataFrame, stored: DataFrame) -> DataFrame:
    """path and status (new, changed, unchanged, removed)."""
    a, b = current.select(*SIGNATURE), stored.select("path", F.col("length").alias("l"), F.col("modified").alias("m"))
    same = F.col("length").eqNullSafe(F.col("l")) & F.col("modified").eqNullSafe(F.col("m"))
    status = F.when(F.col("l").isNull(), "new").when(F.col("length").isNull(), "removed").when(same, "unchanged").otherwise("changed")
    return a.join(b, "path", "full").select("path", status.alias("status"))


def orphan_outputs(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Outputs of vanished inputs that no present input produces as well. recorded: path, outputs (array)."""
    gone = recorded.join(current.select("path"), "path", "left_anti").select(F.explode("outputs").alias("output")).distinct()
    alive = recorded.join(current.select("path"), "path", "left_semi").select(F.explode("outputs").alias("output")).distinct()
    return gone.join(alive, "output", "left_anti")


def touched_months(old_rows: DataFrame, new_rows: DataFrame) -> DataFrame:
    """(year, month) that changed files held before or hold now; both must be written again."""
    return old_rows.select("year", "month").unionByName(new_rows.select("year", "month")).distinct()


#: Inputs of a run whose paths are broadcast.
INPUTS = 100_000
#: Lines of an output that go into one file, so that the next stage reads a large output in several tasks.
FILE_LINES = 200_000
#: Months of a table that are taken as folder names to the driver, at most.
MONTHS = 100_000


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at `path`; None where there is none yet or it has no rows."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def month_folder() -> Column:
    """The folder of a row's month below a table, as Spark names it."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return F.concat(F.lit("year="), name("year"), F.lit("/month="), name("month"))


def apply_changes(spark: SparkSession, current: DataFrame, stored: DataFrame, read: Callable[[list[str]], DataFrame], table: str, force: bool = False) -> DataFrame:
    """Brings the partitioned trip table at `table` up to date; returns the manifest to store.

    `current` has path, length and modified, `stored` the same and outputs, the
    months that each input went into. An input is processed if it is new, has
    changed, lacks one of its outputs, or with `force`. `read(paths)` gives
    trips with year, month and source_file; findings that are noted on them (quality.GATE)
    are settled as they are written, before the table is touched. Rows of processed and removed inputs
    leave the months that they are in, new rows enter; only those months are
    written. The manifest comes back with status (processed or kept). Paths, not
    rows, are collected: as many as there are files to process.
    """
    inputs = _compared(spark, current, stored, _months_there(spark, table), force)
    todo, gone = _to_do(inputs)
    stale = inputs.where("state <> 'kept'").select(F.col("path").alias("__stale"))
    made = None
    if todo or gone:
        fresh = read(todo) if todo else None
        if fresh is not None and _table(spark, table) is None:
            # nothing to merge with: the rows are written once, and read back for what they touch
            _first(spark, fresh, table)
            fresh = _table(spark, table)
        else:
            fresh = quality.settled_by(fresh, lambda rows: saved(rows, "fresh")) if fresh is not None else None
            _replace(spark, stale, fresh, table)
        if fresh is not None:
            made = fresh.select(F.col("source_file").alias("path"), month_folder().alias("o")).distinct().groupBy("path").agg(F.array_sort(F.collect_list("o")).alias("made"))
    return _after(inputs, made)


def _compared(spark: SparkSession, current: DataFrame, stored: DataFrame, there: DataFrame, force: bool) -> DataFrame:
    """path, length, modified, outputs and state (due, kept or gone) of all inputs that are there or recorded. An input whose outputs are not all among `there` (o) is due."""
    known = stored.select("path", F.col("length").alias("l"), F.col("modified").alias("m"), "outputs" if "outputs" in stored.columns else F.array().cast("array<string>").alias("outputs"))
    lacking = known.select("path", F.explode("outputs").alias("o")).join(F.broadcast(there), "o", "left_anti").select("path", F.lit(True).alias("lacking")).distinct()
    both = current.select(*SIGNATURE, F.lit(True).alias("here")).join(known, "path", "full").join(lacking, "path", "left")
    same = F.col("length").eqNullSafe(F.col("l")) & F.col("modified").eqNullSafe(F.col("m")) & F.col("outputs").isNotNull() & F.col("lacking").isNull() & F.lit(not force)
    return saved(both.select(*SIGNATURE, "outputs", F.when(F.col("here").isNull(), "gone").when(same, "kept").otherwise("due").alias("state")), "inputs")


def _to_do(inputs: DataFrame) -> tuple[list[str], bool]:
    """The paths of inputs that are due, and whether any are gone."""
    rows = inputs.where("state <> 'kept'").select("path", "state").orderBy("path").collect()
    return [r.path for r in rows if r.state == "due"], any(r.state == "gone" for r in rows)


def _after(inputs: DataFrame, made: DataFrame | None) -> DataFrame:
    return recorded(inputs.where("state <> 'gone'").select(*SIGNATURE), inputs.where("outputs is not null").select("path", "outputs"), inputs.where("state = 'due'"), made)


def _months_there(spark: SparkSession, table: str) -> DataFrame:
    """The month folders (o) of a table, as `month_folder` names them."""
    fs, to_path = file_system(spark, table)
    below = lambda p: [x.getPath() for x in fs.listStatus(p) if x.isDirectory()] if fs.exists(p) else []
    names = [f"{y.getName()}/{m.getName()}" for y in below(to_path(table)) if y.getName().startswith("year=") for m in below(y)]
    if len(names) > MONTHS:
        raise ValueError(f"more than {MONTHS} months in the table")
    return spark.createDataFrame([(n,) for n in names], "o string")


def recorded(now: DataFrame, outputs: DataFrame, due: DataFrame, made: DataFrame | None) -> DataFrame:
    """The manifest after a run: path, length, modified, outputs, status. Inputs in `due` (path) have the outputs that `made` (path, made) lists, which may be none, all others keep theirs."""
    out = now.join(outputs, "path", "left").join(due.select("path", F.lit(True).alias("__due")), "path", "left")
    out = out.join(made, "path", "left") if made is not None else out.withColumn("made", F.lit(None).cast("array<string>"))
    none = F.array().cast("array<string>")
    processed = F.col("__due").isNotNull()
    return out.select(*SIGNATURE, F.when(processed, F.coalesce("made", none)).otherwise(F.coalesce("outputs", none)).alias("outputs"), F.when(processed, "processed").otherwise("kept").alias("status"))


def _first(spark: SparkSession, fresh: DataFrame, table: str) -> None:
    """Writes a table beside `table`, which it becomes if no row has findings."""
    staged = beside(table)
    try:
        quality.settled_by(fresh, lambda rows: spread_by_month(rows).write.partitionBy("year", "month").parquet(staged))
    except quality.QualityError:
        fs, to_path = file_system(spark, staged)
        fs.delete(to_path(staged), True)
        raise
    put_in_place(spark, staged, table)


def _replace(spark: SparkSession, stale: DataFrame, fresh: DataFrame | None, table: str) -> None:
    """Takes the rows of stale inputs (__stale) out of the table and puts the fresh ones in, rewriting the months of both."""
    existing = _table(spark, table)
    if existing is None:
        return
    old = existing.join(stale, existing.source_file == stale["__stale"], "left_semi")
    months = saved(touched_months(old, fresh) if fresh is not None else old.select("year", "month").distinct(), "months")
    # no more than the folders of the table and the new rows' months
    slim = F.broadcast(months.toDF("__year", "__month"))
    kept = existing.join(slim, existing.year.eqNullSafe(slim["__year"]) & existing.month.eqNullSafe(slim["__month"]), "left_semi").join(stale, existing.source_file == stale["__stale"], "left_anti")
    # the table is read and written at once, so the new months are set down first
    new = saved(kept.unionByName(fresh, allowMissingColumns=True) if fresh is not None else kept, "months")
    spread_by_month(new).write.partitionBy("year", "month").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(table)
    left = new.select("year", "month").distinct().toDF("__y", "__m")
    empty = months.join(left, months.year.eqNullSafe(left["__y"]) & months.month.eqNullSafe(left["__m"]), "left_anti")
    fs, to_path = file_system(spark, table)
    for r in empty.select(month_folder().alias("o")).toLocalIterator():
        fs.delete(to_path(f"{table}/{r.o}"), True)


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The stored manifest; an empty one where none is stored yet."""
    found = _table(spark, path)
    return spark.createDataFrame([], "path string, length long, modified timestamp_ntz, outputs array<string>") if found is None else found


def store_manifest(rows: DataFrame, path: str) -> None:
    """Writes the manifest beside the old one, which is moved aside and deleted once the new one has its name."""
    staged = beside(path)
    rows.select(*SIGNATURE, "outputs").write.parquet(staged)
    put_in_place(rows.sparkSession, staged, path)


def run(spark: SparkSession, current: DataFrame, state: str, read: Callable[[list[str]], DataFrame], table: str, force: bool = False) -> DataFrame:
    """One incremental run: the stored manifest at `state`, the changes, the new manifest, which comes back with each input's status."""
    after = saved(apply_changes(spark, current, load_manifest(spark, state), read, table, force), "manifest")
    store_manifest(after, state)
    return after


@dataclass
class FileStage:
    """A step from files to files, such as from archives to their members or from raw to cleaned lines.

    `make(inputs)` takes (path) rows as a list of paths and gives the lines of the
    outputs: source_file (the input), output (a name that no other input makes), start,
    n and line. Outputs are folders of Parquet below `target`, one each; `state` keeps
    the stage's manifest.
    """

    make: Callable[[list[str]], DataFrame]
    target: str
    state: str


def output_name(*parts: Column | str) -> Column:
    """A name for an output from the names that it comes from, fit for a folder; different parts give different names."""
    shown = F.regexp_replace(F.concat_ws("!", *parts), "[^A-Za-z0-9._-]", "_")
    return F.concat(F.right(shown, F.lit(80)), F.lit("-"), F.lower(F.hex(F.xxhash64(*parts))))


def made_by(recorded: DataFrame, target: str) -> DataFrame:
    """What the next stage takes as inputs: path, length, modified of each output. The signature is that of the inputs that made it, so an output of unchanged inputs counts as unchanged."""
    each = recorded.select(F.explode("outputs").alias("output"), F.struct(*SIGNATURE).alias("of"))
    one = each.groupBy("output").agg(F.xxhash64(F.array_sort(F.collect_list("of"))).alias("length"), F.max("of.modified").alias("modified"))
    return one.select(F.concat(F.lit(f"{target}/output="), "output").alias("path"), "length", "modified")


def run_files(spark: SparkSession, current: DataFrame, stage: FileStage, force: bool = False) -> DataFrame:
    """Brings a stage's outputs up to date with `current` (path, length, modified); returns its manifest, with each input's outputs, which may be none, and status.

    Inputs are processed that are new or changed, or whose outputs are gone, or all with
    `force`. Outputs that no input makes any more are deleted, and the manifest is
    stored, last of all. Two inputs that make one output raise.
    """
    stored = load_manifest(spark, stage.state)
    # a folder per output: one listing tells which are there
    fs, to_path = file_system(spark, stage.target)
    there = [p.getPath().getName().removeprefix("output=") for p in fs.listStatus(to_path(stage.target))] if fs.exists(to_path(stage.target)) else []
    inputs = _compared(spark, current, stored, spark.createDataFrame([(x,) for x in there], "o string"), force)
    todo, gone = _to_do(inputs)
    if not todo and not gone:
        return _after(inputs, None)
    made = None
    if todo:
        rows = stage.make(todo).hint("rebalance", "output")
        rows.write.partitionBy("output").mode("overwrite").options(partitionOverwriteMode="dynamic", maxRecordsPerFile=FILE_LINES).parquet(stage.target)
        mine = inputs.where("state = 'due'").select(F.col("path").alias("source_file"))
        fresh = spark.read.parquet(stage.target).join(F.broadcast(mine) if len(todo) <= INPUTS else mine, "source_file", "left_semi")
        made = saved(fresh.groupBy(F.col("source_file").alias("path")).agg(F.array_sort(F.collect_set(F.col("output").cast("string"))).alias("made")), "made")
    after = saved(_after(inputs, made), "manifest")
    alive = after.select(F.explode("outputs").alias("output"))
    if twice := alive.groupBy("output").count().where("count > 1").limit(1).collect():
        raise ValueError(f"several inputs make {twice[0].output}")
    orphans = inputs.select(F.explode("outputs").alias("output")).distinct().join(alive, "output", "left_anti")
    for r in orphans.toLocalIterator():
        fs.delete(to_path(f"{stage.target}/output={r.output}"), True)
    store_manifest(after, stage.state)
    return after


def lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, start, n, line) of outputs of a FileStage; `file` is the output's folder."""
    base = paths[0].rsplit("/output=", 1)[0]
    rows = spark.read.option("basePath", base).parquet(*paths)
    return rows.select(F.concat(F.lit(f"{base}/output="), F.col("output").cast("string")).alias("file"), "start", "n", "line")


def run_chain(spark: SparkSession, current: DataFrame, stages: list[FileStage], read: Callable[[list[str]], DataFrame], table: str, state: str) -> list[DataFrame]:
    """Stages one after the other, each on the outputs of the one before, and at the end the months of a trip table; returns their manifests.

    A changed input has its own outputs made again, only these are inputs that changed
    for the next stage, and only the months that they touch are written. `read` gets
    paths of the last stage's outputs, for `lines_of`, and gives trips whose
    source_file is that path.
    """
    manifests = []
    for stage in stages:
        manifests.append(run_files(spark, current, stage))
        current = made_by(manifests[-1], stage.target)
    manifests.append(run(spark, current, state, read, table))
    return manifests


def write_by_file(rows: DataFrame, path: str) -> None:
    """One folder per input file (`source_file`); only the folders of files in `rows` are overwritten."""
    rows.repartition("source_file").write.partitionBy("source_file").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def settle_orphans(recorded: DataFrame, current: DataFrame, policy: str = "warn") -> tuple[list[str], DataFrame]:
    """(messages about vanished inputs' outputs, manifest to keep). `warn` keeps their records, `prune` drops them."""
    if policy not in ("warn", "prune"):
        raise ValueError(f"unknown policy {policy}")
    found = [r.output for r in orphan_outputs(recorded, current).orderBy("output").limit(25).collect()]
    kept = recorded.join(current.select("path"), "path", "left_semi") if policy == "prune" else recorded
    return [f"{'pruned' if policy == 'prune' else 'no input any more for'} {x}" for x in found], kept

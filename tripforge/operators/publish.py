"""Merging per-city results and publishing them."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.operators.quality import QualityError, duplicate_keys, missing_sections
from tripforge.work import saved


def tagged(results: dict[str, DataFrame]) -> DataFrame:
    """All cities' records with their city; fields that some lack are null there."""
    out = None
    for city, df in sorted(results.items()):
        one = df.withColumn("city", F.lit(city))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise QualityError("no city to merge")
    return out


def merge_summaries(results: dict[str, DataFrame]) -> DataFrame:
    """Yearly summaries of all cities; rows without a year are left out."""
    return tagged(results).where("year is not null")


def merge_buckets(results: dict[str, DataFrame]) -> DataFrame:
    return tagged(results)


@dataclass(frozen=True)
class Output:
    """One published file: its name, the section of each city's results, and the key that must be unique."""

    name: str
    section: str
    key: tuple[str, ...]


def validate(outputs: list[Output]) -> None:
    names = [o.name for o in outputs]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise QualityError(f"output named twice: {', '.join(twice)}")
    for o in outputs:
        if not o.key:
            raise QualityError(f"{o.name}: no key")


def merge_section(results: dict[str, dict[str, DataFrame]], output: Output) -> DataFrame:
    """One section over all cities. A city without it, differing fields, a key field that is absent or a repeated key raise."""
    if lacking := sorted(c for c, sections in results.items() if output.section not in sections):
        raise QualityError(f"{output.name}: no section {output.section} for {', '.join(lacking)}")
    fields = {tuple(sorted(sections[output.section].columns)) for sections in results.values()}
    if len(fields) > 1:
        raise QualityError(f"{output.name}: cities' fields differ: {sorted(fields)}")
    merged = tagged({c: sections[output.section] for c, sections in results.items()})
    if absent := [k for k in output.key if k not in merged.columns]:
        raise QualityError(f"{output.name}: key field absent: {', '.join(absent)}")
    if bad := duplicate_keys(merged, list(output.key)).orderBy(*output.key).limit(5).collect():
        raise QualityError(f"{output.name}: key repeated: {[tuple(r) for r in bad]}")
    return merged


#: Rows of an output that go into one file; larger ones are several files in order.
ROWS_PER_FILE = 1_000_000


def publish(results: dict[str, dict[str, DataFrame]], outputs: list[Output], root: str, version: int = 1) -> dict[str, int]:
    """Builds and checks every output, writes all beside root/v<version>, and only then moves them there as JSON lines.

    Rows are in key order, so that a rerun gives the same bytes. A failure before
    the move leaves the published files as they were.
    """
    validate(outputs)
    built = {o.name: (saved(merge_section(results, o), o.name), o) for o in outputs}
    spark = next(iter(built.values()))[0].sparkSession if built else None
    counts, beside = {}, f"{root}/.v{version}-{uuid.uuid4().hex}"
    for name, (df, o) in built.items():
        counts[name] = df.count()
        ordered = df.select(*sorted(df.columns)).orderBy(*o.key)
        (ordered.coalesce(1) if counts[name] <= ROWS_PER_FILE else ordered).write.json(f"{beside}/{name}")
    if built:
        _take_place(spark, beside, f"{root}/v{version}", list(built))
    return counts


def _take_place(spark: SparkSession, beside: str, target: str, names: list[str]) -> None:
    """Moves the folders `names` from `beside` into `target`; what they replace is deleted after all have moved."""
    jvm = spark.sparkContext._jvm
    to_path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = to_path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(to_path(target))
    fs.mkdirs(to_path(f"{beside}/.old"))
    for name in names:
        if fs.exists(to_path(f"{target}/{name}")) and not fs.rename(to_path(f"{target}/{name}"), to_path(f"{beside}/.old/{name}")):
            raise OSError(f"{target}/{name} could not be moved")
        if not fs.rename(to_path(f"{beside}/{name}"), to_path(f"{target}/{name}")):
            raise OSError(f"{beside}/{name} could not be moved")
    fs.delete(to_path(beside), True)


def small_json(df: DataFrame, order: list[str], limit: int = 100_000, minified: bool = True, sort_keys: bool = False) -> str:
    """A small result as one JSON array; more than `limit` rows raise, as they belong into write.json."""
    rows = df.orderBy(*order).limit(limit + 1).toJSON().collect() if order else df.limit(limit + 1).toJSON().collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows")
    return json.dumps([json.loads(r) for r in rows], ensure_ascii=False, sort_keys=sort_keys, separators=(",", ":") if minified else None, indent=None if minified else 2)


def cities_without(spark: SparkSession, cities: list[str], records: DataFrame) -> DataFrame:
    return missing_sections(spark.createDataFrame([(c,) for c in cities], "city string"), records)

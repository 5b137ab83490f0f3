"""Quality gates: a value that is there but cannot be parsed, mapped or joined stops the job and is named.

A gate is one aggregate over all checks; `EXAMPLES` offenders of each go into
the message. Checks of several steps can be noted on the rows (`marked`) and
settled in one aggregate at the end (`settled`). `offenders` gives the values
themselves for a quarantine instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tripforge.functions.values import is_known


#: Offenders of a check that a message shows.
EXAMPLES = 5
#: The column that holds findings until they are settled.
GATE = "__gate"


class QualityError(ValueError):
    """A gate that did not pass."""


def present(raw: Column) -> Column:
    return raw.isNotNull() & (F.trim(raw.cast("string")) != "")


def unparsed(raw: Column, parsed: Column) -> Column:
    """There before, null after parsing."""
    return present(raw) & parsed.isNull()


def unmapped(raw: Column, table: dict) -> Column:
    return ~is_known(raw, table)


def _found(name_value: DataFrame) -> DataFrame:
    """name, n, n_values and examples (the EXAMPLES smallest values) from a row (name, value) per finding."""
    counted = name_value.groupBy("name", "value").agg(F.count("*").alias("n"))
    total = counted.groupBy("name").agg(F.sum("n").alias("n"), F.count("*").alias("n_values"))
    first = counted.withColumn("r", F.row_number().over(Window.partitionBy("name").orderBy("value"))).where(F.col("r") <= EXAMPLES)
    return total.join(first.groupBy("name").agg(F.array_sort(F.collect_list("value")).alias("examples")), "name")


def _marks(checks: dict[str, tuple[Column, Column]]) -> Column:
    one = [F.when(bad, F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))) for name, (bad, value) in checks.items()]
    return F.array_compact(F.array(*one)).cast("array<struct<name:string,value:string>>")


def check(df: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per check with findings: name, n, n_values, examples. checks: name -> (bad, value shown)."""
    return _found(df.select(F.explode(_marks(checks)).alias("c")).select("c.name", "c.value"))


def offenders(df: DataFrame, bad: Column, value: Column, limit: int = EXAMPLES) -> list[str]:
    """The first distinct offending values in order, for a message."""
    return [r[0] for r in df.where(bad).select(value.cast("string").alias("v")).distinct().orderBy("v").limit(limit).collect()]


def _raise_any(found: DataFrame) -> None:
    if rows := found.orderBy("name").collect():
        raise QualityError("; ".join(f"{r.name}: {r.n} rows, such as {r.examples}" for r in rows))


def gate(df: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Returns `df` if no check finds a row, else raises QualityError that names the checks and offenders."""
    _raise_any(check(df, checks))
    return df


def marked(df: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Notes what the checks find in the column GATE, for `settled`."""
    marks = _marks(checks)
    return df.withColumn(GATE, F.concat(GATE, marks) if GATE in df.columns else marks)


def unmarked() -> Column:
    """Rows without findings so far."""
    return F.size(GATE) == 0


def settled(df: DataFrame) -> DataFrame:
    """`df` without GATE if no row has findings, else raises QualityError; one count, whatever the number of checks. Only rows with findings are read again, for the message."""
    if GATE not in df.columns:
        return df
    if df.agg(F.count_if(~unmarked())).first()[0]:
        raise_findings(df)
    return df.drop(GATE)


def settled_by(df: DataFrame, write: Callable[[DataFrame], DataFrame | None]) -> DataFrame | None:
    """What `write` makes of `df` without GATE. The write itself counts findings, so that rows are made once; where it met some, they are named in a QualityError after it."""
    if GATE not in df.columns:
        return write(df)
    told = Observation()
    out = write(df.observe(told, F.count_if(~unmarked()).alias("found")).drop(GATE))
    if told.get.get("found"):
        raise_findings(df)
    return out


def raise_findings(df: DataFrame) -> None:
    """Raises QualityError that names the checks and offenders noted in GATE."""
    _raise_any(_found(df.select(F.explode(GATE).alias("c")).select("c.name", "c.value")))
    raise QualityError("findings that were not met again")


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise QualityError(f"columns missing: {', '.join(missing)}")
    return df


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def missing_sections(cities: DataFrame, records: DataFrame) -> DataFrame:
    """Cities without a record."""
    return cities.join(records.select("city").distinct(), "city", "left_anti")


def field_mismatches(records: DataFrame, city: str = "city", record: str = "record") -> DataFrame:
    """Per set of field names how many cities' JSON records have it; more than one row is a mismatch."""
    names = F.array_join(F.array_sort(F.json_object_keys(record)), ",")
    return records.select(city, names.alias("fields")).distinct().groupBy("fields").agg(F.count("*").alias("cities"))


def coverage(counts: DataFrame, kept: str, named: str, least: float) -> DataFrame:
    """Adds coverage = kept / named and ok; nothing named counts as covered."""
    share = F.when(F.col(named) == 0, 1.0).otherwise(F.round(F.col(kept) / F.col(named), 6))
    return counts.withColumn("coverage", share).withColumn("ok", F.col("coverage") >= least)


def require_coverage(counts: DataFrame, kept: str, named: str, least: float) -> DataFrame:
    """`counts` with coverage; a row under `least` raises."""
    rows = coverage(counts, kept, named, least)
    if low := rows.where(~F.col("ok")).limit(EXAMPLES).collect():
        raise QualityError(f"coverage under {least}: {[r.asDict() for r in low]}")
    return rows

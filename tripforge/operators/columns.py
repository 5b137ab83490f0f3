"""Projections and row filters, from any era's header to the canonical columns."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge.work import saved

OPTIONAL_TEXT = ("bike_id", "gender", "birth_year", "bike_type", "bike_model", "membership_type")


def renamed(columns: list[str], names: dict[str, str]) -> list[str]:
    """The headers under their new names. Two headers that would get one name raise."""
    new = [names.get(c, c) for c in columns]
    if twice := sorted({c for c in new if new.count(c) > 1}):
        raise ValueError(f"several columns would be named {', '.join(twice)}")
    return new


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames the headers that are there."""
    return df.toDF(*renamed(df.columns, names))


def cleaned_headers(columns: list[str]) -> list[str]:
    """Headers trimmed and without one pair of matching quotes around them."""

    def one(c: str) -> str:
        c = c.strip()
        return c[1:-1].strip() if len(c) > 1 and c[0] == c[-1] and c[0] in "\"'" else c

    return [one(c) for c in columns]


def clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*cleaned_headers(df.columns))


def select_final(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Exactly these columns, in this order, of these types; a missing one is null. A value that does not cast raises under ANSI."""
    return df.select(*final_columns(df, types))


def final_columns(df: DataFrame, types: dict[str, str]) -> list[Column]:
    return [(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]


def optional_as_text(df: DataFrame, columns: tuple[str, ...] = OPTIONAL_TEXT) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns if c in df.columns})


def any_there(df: DataFrame, but: tuple[str, ...] = ()) -> Column:
    """Whether a row holds anything in columns other than `but`."""
    return reduce(or_, [F.col(f"`{c}`").isNotNull() for c in df.columns if c not in but], F.lit(False))


def drop_all_null(df: DataFrame, but: tuple[str, ...] = ()) -> DataFrame:
    return df.where(any_there(df, but))


def without_values(invalid: dict[str, list[str]]) -> Column:
    """Rows that hold none of the curated bad values; a null in one of the columns does not pass either."""
    return F.coalesce(reduce(and_, [~F.col(c).isin(v) for c, v in invalid.items()], F.lit(True)), F.lit(False))


def remove_values(df: DataFrame, invalid: dict[str, list[str]]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass `without_values`, audit of removed rows by column and value)."""
    audit = [df.where(F.col(c).isin(v)).groupBy(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")).agg(F.count("*").alias("rows")) for c, v in invalid.items()]
    return df.where(without_values(invalid)), reduce(DataFrame.unionByName, audit)


def any_null(*columns: str) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column that some lack is null there, one of differing types is text."""
    kinds: dict[str, set[str]] = {}
    for f in frames:
        for c, t in f.dtypes:
            kinds.setdefault(c, set()).add(t)
    mixed = {c for c, t in kinds.items() if len(t) > 1}
    cast = [f.withColumns({c: F.col(c).cast("string") for c in f.columns if c in mixed}) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def id_order(column: str) -> list[Column]:
    """Sort keys: numeric ids by value, then the others by text."""
    number = F.col(column).try_cast("bigint")
    return [number.isNull().asc(), number.asc(), F.col(column).asc()]


def placed(df: DataFrame, group: str, order: list[Column], out: str) -> DataFrame:
    """Adds each row's place in its group, from 1. Rows are sorted over all tasks, and a task's places begin where those before it end, so a large group is not one task's."""
    cut = saved(df.orderBy(group, *order).withColumn("__part", F.spark_partition_id()), "sorted")
    counts = cut.groupBy(F.col(group).alias("__g"), F.col("__part").alias("__p")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__g").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__g", "__p", before.alias("__before"))
    own = F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order))
    both = cut.withColumn("__own", own).join(offsets, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p")))
    return both.withColumn(out, F.col("__own") + F.col("__before")).drop("__part", "__own", "__g", "__p", "__before")


def spread_by_month(trips: DataFrame) -> DataFrame:
    """Rows of a month together, in as many tasks as their size asks for."""
    return trips.hint("rebalance", "year", "month")

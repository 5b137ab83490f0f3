"""Cumulative reference tables: newest values win, ids are never dropped, nothing is written when nothing changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripforge.operators.columns import id_order
from tripforge.operators.lookups import latest_per_key

#: Rows of a table that go into one file.
ROWS_PER_FILE = 1_000_000


def newest(files: DataFrame, key: str, values: list[str], order: list[str]) -> DataFrame:
    """One row per id from many dated files; blank ids are left out."""
    slim = files.select(F.trim(F.col(key)).alias(key), *values, *order).where(F.col(key).isNotNull() & (F.col(key) != ""))
    return latest_per_key(slim, key, order).select(key, *values)


def upsert(old: DataFrame, new: DataFrame, key: str, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(merged table, report of changes). A null new value keeps the old one. Changes: added, or the column that changed."""
    a, b = old.select(key, *values), new.select(F.col(key).alias("__k"), *[F.col(v).alias(f"__{v}") for v in values])
    both = a.join(b, F.col(key) == F.col("__k"), "full")
    kept = both.select(F.coalesce(key, "__k").alias(key), *[F.coalesce(f"__{v}", v).alias(v) for v in values])
    added = F.col(key).isNull()
    changes = F.array_compact(F.array(*[F.when(added, None).otherwise(F.when(F.col(f"__{v}").isNotNull() & ~F.col(f"__{v}").eqNullSafe(F.col(v)), v)) for v in values], F.when(added, "added")))
    report = both.select(F.coalesce(key, "__k").alias(key), F.explode(changes).alias("change"))
    return kept, report


def coordinate_text(value: Column) -> Column:
    """Six decimals, an absent coordinate as an empty text."""
    return F.coalesce(F.format_string("%.6f", value), F.lit(""))


def differs(old: DataFrame, new: DataFrame) -> bool:
    """Whether the tables hold different rows, in any order."""
    columns = new.columns
    if old.columns != columns:
        return True
    tagged = old.withColumn("__n", F.lit(1)).unionByName(new.withColumn("__n", F.lit(-1)))
    return bool(tagged.groupBy(*columns).agg(F.sum("__n").alias("n")).where("n <> 0").limit(1).count())


def write_if_changed(old: DataFrame | None, new: DataFrame, path: str, key: str = "id") -> bool:
    """Writes `new` as CSV to `path`, in order of ids, unless `old` holds the same rows; says whether it wrote. Up to ROWS_PER_FILE rows are one file."""
    if old is not None and not differs(old, new):
        return False
    ordered = new.orderBy(*id_order(key))
    few = new.limit(ROWS_PER_FILE + 1).count() <= ROWS_PER_FILE
    (ordered.coalesce(1) if few else ordered).write.mode("overwrite").option("header", True).csv(path)
    return True

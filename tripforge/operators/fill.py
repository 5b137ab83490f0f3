"""Order-dependent repairs of a file's rows: forward and backward fill, monotonicity.

A file's rows are cut into blocks of row numbers. Fills run inside blocks, and
what a block carries over from its neighbours is computed on one row per block,
so a large file is not sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge.operators.quality import QualityError

#: Rows of a block.
BLOCK_ROWS = 100_000


def sandwich_fill(df: DataFrame, file: str, row: str, value: str, out: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Fills null `value` where the last value before and the first after it agree; else `out` stays null."""
    block = F.floor(F.col(row) / block_rows)
    base = df.withColumn("__b", block)
    inner = Window.partitionBy(file, "__b").orderBy(row)
    before = F.last(value, ignorenulls=True).over(inner.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(value, ignorenulls=True).over(inner.rowsBetween(0, Window.unboundedFollowing))
    local = base.withColumn("__before", before).withColumn("__after", after)
    # one row per block: its last and first value, and what earlier and later blocks bring
    ends = base.where(F.col(value).isNotNull()).groupBy(file, "__b").agg(F.max_by(value, row).alias("__last"), F.min_by(value, row).alias("__first"))
    ends = base.groupBy(file, "__b").agg(F.count("*").alias("__n")).join(ends, [file, "__b"], "left")
    across = Window.partitionBy(file).orderBy("__b")
    carried = ends.select(
        file,
        "__b",
        F.last("__last", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("__left"),
        F.first("__first", ignorenulls=True).over(across.rowsBetween(1, Window.unboundedFollowing)).alias("__right"),
    )
    both = local.join(carried, [file, "__b"])
    low, high = F.coalesce("__before", "__left"), F.coalesce("__after", "__right")
    return both.withColumn(out, F.when(F.col(value).isNotNull(), F.col(value)).when(low == high, low)).drop("__b", "__before", "__after", "__left", "__right")


def monotonic_share(df: DataFrame, file: str, row: str, value: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per file the share of consecutive non-null values that do not fall; null for fewer than two values. Steps between blocks are taken from one row per block."""
    base = df.where(F.col(value).isNotNull()).select(file, row, value, F.floor(F.col(row) / block_rows).alias("__b"))
    step = F.col(value) >= F.lag(value).over(Window.partitionBy(file, "__b").orderBy(row))
    inner = base.withColumn("__ok", step).groupBy(file, "__b").agg(F.count_if("__ok").alias("__up"), F.count("*").alias("__n"), F.min_by(value, row).alias("__first"), F.max_by(value, row).alias("__last"))
    across = F.col("__first") >= F.lag("__last").over(Window.partitionBy(file).orderBy("__b"))
    whole = inner.withColumn("__ok", across).groupBy(file).agg((F.sum("__up") + F.count_if("__ok")).alias("__up"), F.sum("__n").alias("n"))
    return whole.select(file, F.when(F.col("n") > 1, F.round(F.col("__up") / (F.col("n") - 1), 6)).alias("share"), "n")


def require_sorted(shares: DataFrame, file: str, least: float = 0.999) -> DataFrame:
    """`shares` if no file's share of rising steps is under `least`, else raises."""
    if bad := shares.where(F.col("share") < least).orderBy("share", file).limit(5).collect():
        raise QualityError(f"not sorted: {[(r[file], r.share) for r in bad]}")
    return shares


def null_unsorted(df: DataFrame, file: str, shares: DataFrame, column: str, least: float = 0.999) -> DataFrame:
    """Nulls `column` in files whose share of rising steps is under `least`."""
    bad = shares.where(F.col("share") < least).select(file, F.lit(True).alias("__bad"))
    return df.join(bad, file, "left").withColumn(column, F.when(F.col("__bad").isNull(), F.col(column))).drop("__bad")


def counters(filled: DataFrame, value: str, out: str) -> DataFrame:
    """How many values were there, were recovered, and stay missing."""
    kept: Column = F.col(value).isNotNull()
    return filled.agg(F.count_if(kept).alias("present"), F.count_if(~kept & F.col(out).isNotNull()).alias("recovered"), F.count_if(F.col(out).isNull()).alias("missing"))


#: A clock cell that lost its hour: minutes, seconds and a fraction.
LOST_HOUR = r"^\d{1,2}:\d{2}\.\d+$"


def recover_clocks(df: DataFrame, file: str, row: str, arrival: str, departure: str, arrived_at: Column, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Repairs `MM:SS.s` cells of files that are sorted by arrival; `arrived_at` orders the whole cells.

    An arrival gets the hour that the last whole arrival before it and the first
    after it share; where they differ it becomes null. Departures that lost their
    hour become null. A file that is not sorted by arrival raises.
    """
    whole = F.when(~F.col(arrival).rlike(LOST_HOUR), arrived_at)
    require_sorted(monotonic_share(df.withColumn("__at", whole), file, row, "__at", block_rows), file)
    hour = F.when(~F.col(arrival).rlike(LOST_HOUR), F.split(arrival, ":")[0].try_cast("int"))
    filled = sandwich_fill(df.withColumn("__hour", hour), file, row, "__hour", "__filled", block_rows)
    minutes = F.split(arrival, r"[:.]")
    told = F.concat_ws(":", F.lpad(F.col("__filled").cast("string"), 2, "0"), F.lpad(minutes[0], 2, "0"), minutes[1])
    repaired = F.when(~F.col(arrival).rlike(LOST_HOUR), F.col(arrival)).when(F.col("__filled").isNotNull(), told)
    return filled.withColumns({arrival: repaired, departure: F.when(~F.col(departure).rlike(LOST_HOUR), F.col(departure))}).drop("__hour", "__filled")

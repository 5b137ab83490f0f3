"""Joins with station dimensions.

A dimension is broadcast when its rows, counted first, stay within
BROADCAST_ROWS; otherwise Spark picks a shuffle join that can split skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def small(dim: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`dim` with a broadcast hint if it has at most `most` rows."""
    return F.broadcast(dim) if dim.limit(most + 1).count() <= most else dim


def name_both_ends(trips: DataFrame, dim: DataFrame, allowed: list[str] = (), how: str = "left", start: str = "start_station_id", end: str = "end_station_id") -> DataFrame:
    """Adds start_station_name and end_station_name from dim(id, name).

    `left` keeps trips without a name; ids in `allowed` get `Unknown (id X)`.
    `inner` drops trips that lack a name at either end.
    """
    dim = small(dim.select("id", "name").dropDuplicates(["id"]))
    out = trips
    for key, name in ((start, "start_station_name"), (end, "end_station_name")):
        out = out.join(dim.toDF("__id", name), F.col(key) == F.col("__id"), how).drop("__id")
        if allowed:
            out = out.withColumn(name, F.coalesce(F.col(name), F.when(F.col(key).isin(list(allowed)), F.concat(F.lit("Unknown (id "), F.col(key), F.lit(")")))))
    return out


def have_both_names() -> Column:
    """Whether a trip has a name at both ends."""
    return F.col("start_station_name").isNotNull() & F.col("end_station_name").isNotNull()


def renumber_and_name(trips: DataFrame, mapping: DataFrame, dim: DataFrame, on_missing: str = "raise") -> DataFrame:
    """Legacy ids to new ids by mapping(legacy_id, new_id), then to names. `drop` loses trips that lack one, `raise` names them, `keep` keeps them."""
    mapping = small(mapping.dropDuplicates(["legacy_id"]))
    out = trips
    for end in ("start", "end"):
        out = out.join(mapping.toDF("__old", f"{end}_new_id"), F.col(f"{end}_station_id") == F.col("__old"), "left").drop("__old")
    out = name_both_ends(out, dim, start="start_new_id", end="end_new_id")
    lost = F.col("start_station_name").isNull() | F.col("end_station_name").isNull()
    if on_missing == "raise":
        bad = out.where(lost).select("start_station_id", "end_station_id").distinct().orderBy("start_station_id", "end_station_id").limit(5).collect()
        if bad:
            raise ValueError(f"trips whose stations have no new id or name: {[tuple(r) for r in bad]}")
    return out if on_missing == "keep" else out.where(have_both_names())


def name_by_year(trips: DataFrame, yearly: DataFrame) -> DataFrame:
    """Names from yearly(year, code, name) of the trip's start year; where that year lacks the code, the code's name of its last year."""
    exact = small(yearly.groupBy("year", "code").agg(F.max("name").alias("name")))
    last = small(yearly.groupBy("code").agg(F.max_by("name", F.struct("year", "name")).alias("name")))
    out = trips
    for end in ("start", "end"):
        one = exact.toDF("__y", "__c", "__exact")
        out = out.join(one, (F.year("start_time") == F.col("__y")) & (F.col(f"{end}_station_code") == F.col("__c")), "left").drop("__y", "__c")
        out = out.join(last.toDF("__c", "__last"), F.col(f"{end}_station_code") == F.col("__c"), "left").drop("__c")
        out = out.withColumn(f"{end}_station_name", F.coalesce("__exact", "__last")).drop("__exact", "__last")
    return out


def used_ids(trips: DataFrame, start: str = "start_station_id", end: str = "end_station_id") -> DataFrame:
    """Distinct ids at either end."""
    return trips.select(F.explode(F.array(start, end)).alias("id")).where("id is not null").distinct()


def uncovered_ids(trips: DataFrame, dim: DataFrame, allowed: list[str] = (), **ends: str) -> DataFrame:
    """Used ids that neither the dimension nor the allow-list has."""
    out = used_ids(trips, **ends).join(small(dim.select("id").distinct()), "id", "left_anti")
    return out.where(~F.col("id").isin(list(allowed))) if allowed else out


def stale_allowlist(allowed: DataFrame, dim: DataFrame) -> DataFrame:
    """Allow-listed ids that the dimension names by now."""
    return allowed.join(dim.where("name is not null").select("id"), "id", "left_semi")


def unresolved_names(trips: DataFrame, key: str, name: str, limit: int = 25) -> DataFrame:
    """Keys that are there without a name, the first `limit` in order, for the report."""
    return trips.where(F.col(key).isNotNull() & F.col(name).isNull()).select(F.col(key).alias("key")).distinct().orderBy("key").limit(limit)


def periods_not_covered(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Files of `secondary` whose (year, month) no file of `primary` has."""
    return secondary.join(primary.select("year", "month").distinct(), ["year", "month"], "left_anti")


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of each key the row that is last in the order columns; other columns decide ties, so the result is the same on every run."""
    rest = [c for c in df.columns if c not in (key, *order)]
    return df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("__r")).select(key, *[F.col(f"__r.{c}").alias(c) for c in (*order, *rest)])


def station_list(df: DataFrame, ids: list[str], names: list[str], order: str) -> DataFrame:
    """(id, name) of a station list whose headers vary; the last row of an id counts."""
    found = [next((c for c in wanted if c in df.columns), None) for wanted in (ids, names)]
    if None in found:
        raise ValueError(f"no station id or name among {df.columns}")
    slim = df.select(F.trim(F.col(f"`{found[0]}`")).alias("id"), F.trim(F.col(f"`{found[1]}`")).alias("name"), F.col(order).alias("__o")).where("id is not null")
    return latest_per_key(slim, "id", ["__o"]).select("id", "name")

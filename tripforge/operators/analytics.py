"""Summaries of a trip table (start_time, end_time, start_station_name, end_station_name, duration)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge.functions.time import calendar, duration_seconds
from tripforge.operators.columns import any_null

KEY_COLUMNS = ("start_time", "end_time", "start_station_name", "end_station_name")
#: Right-closed edges of duration bands in seconds and their names.
BANDS = ((300, "<5"), (900, "5-15"), (1800, "15-30"), (3600, "30-60"), (None, "60+"))
#: Width and cap of duration buckets in seconds.
BUCKET, CAP = 60, 7200


def prepared(trips: DataFrame) -> DataFrame:
    """Adds calendar columns, and duration where the feed has none."""
    out = trips if "duration" in trips.columns else trips.withColumn("duration", duration_seconds(F.col("start_time"), F.col("end_time")))
    return out.withColumns(calendar(F.col("start_time")))


def valid() -> Column:
    """A trip that has a duration and does not end before it starts."""
    return F.col("duration").isNotNull() & F.coalesce(duration_seconds(F.col("start_time"), F.col("end_time")) >= 0, F.lit(False))


#: Parts that a power of two is cut into by the coarse buckets of a value, and parts of a coarse bucket.
COARSE, FINE = 512, 65_536


def _buckets(value: Column) -> tuple[Column, Column]:
    """(coarse, fine): integers that never fall as the value rises, fine ones within a coarse bucket. Both follow from the binary exponent and the digits behind it, so they fit values of any size."""
    x = value.cast("double")
    size, far = F.abs(x), F.isnan(x) | (F.abs(x) == float("inf"))
    power = F.floor(F.log2(size))
    digits = size / F.pow(F.lit(2.0), power) * (COARSE / 2)
    sign = F.when(x < 0, -1).otherwise(1)
    coarse = F.when(x == 0, 0).when(far, F.when(x < 0, -10_000_000).otherwise(10_000_000)).otherwise(sign * ((power + 1100) * COARSE + F.floor(digits)))
    fine = F.when((x == 0) | far, 0).otherwise(sign * F.floor((digits - F.floor(digits)) * FINE))
    return coarse.cast("int"), fine.cast("int")


def at_ranks(counted: DataFrame, keys: list[str], value: str, n: str, places: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Exact order statistics of a table of value counts (keys, value, n): per key, a column for each of `places`, which gives an index from 0 of the ordered values from their number.

    Counts are summed by coarse buckets, of which a key has a few thousand at most; of
    those that hold a wanted index alone, by fine buckets; and only values of one fine
    bucket are put in order. So no key's distinct values are ordered in one task.
    Null values do not count; a key without others has no row. Null keys are a key.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    coarse, fine = _buckets(F.col(value))
    base = counted.where(F.col(value).isNotNull()).select(*[F.col(k).alias(m) for k, m in zip(keys, names)], F.col(value).alias("__v"), F.col(n).alias("__n"), coarse.alias("__b"), fine.alias("__f"))

    def met(rows: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
        there = wanted.select(*[F.col(c).alias(f"{c}_") for c in on], "__name", "__at")
        return rows.join(there, reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in on])).drop(*[f"{c}_" for c in on])

    def step(rows: DataFrame, by: list[str], bucket: str) -> DataFrame:
        """For each name the bucket that holds its index, and the index within it."""
        summed = rows.groupBy(*by, "__name", "__at", bucket).agg(F.sum("__n").alias("__n"))
        before = F.sum("__n").over(Window.partitionBy(*by, "__name").orderBy(bucket)) - F.col("__n")
        return summed.withColumn("__before", before).where("__before <= __at and __at < __before + __n").withColumn("__at", F.col("__at") - F.col("__before"))

    sums = base.groupBy(*names, "__b").agg(F.sum("__n").alias("__n"))
    whole = sums.withColumn("__all", F.sum("__n").over(Window.partitionBy(*names))).withColumn("__before", F.sum("__n").over(Window.partitionBy(*names).orderBy("__b")) - F.col("__n"))
    asked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.floor(place(F.col("__all"))).cast("long").alias("at")) for name, place in places.items()]))
    first = whole.select("*", asked.alias("__w")).where("__before <= __w.at and __w.at < __before + __n").select(*names, "__b", F.col("__w.name").alias("__name"), (F.col("__w.at") - F.col("__before")).alias("__at"))
    second = step(met(base, first, [*names, "__b"]), [*names, "__b"], "__f").select(*names, "__b", "__f", "__name", "__at")
    third = step(met(base, second, [*names, "__b", "__f"]), [*names, "__b", "__f"], "__v")
    picked = third.groupBy(*names).agg(*[F.max(F.when(F.col("__name") == name, F.col("__v"))).alias(name) for name in places])
    return picked.withColumnsRenamed(dict(zip(names, keys)))


def _counted(trips: DataFrame, keys: list[str], value: str) -> DataFrame:
    return trips.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))


def nearest_rank(trips: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Exact quantiles by nearest rank (index floor((n - 1) q + 0.5)), from value counts."""
    return at_ranks(_counted(trips, keys, value), keys, value, "__n", {name: lambda n, q=q: (n - 1) * q + 0.5 for name, q in shares.items()})


def interpolated_median(trips: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Exact medians, the mean of the two middle values, from value counts."""
    both = at_ranks(_counted(trips, keys, value), keys, value, "__n", {"__low": lambda n: (n - 1) / 2, "__high": lambda n: n / 2})
    return both.select(*keys, ((F.col("__low") + F.col("__high")) / 2).alias(name))


def summary(trips: DataFrame, keys: tuple[str, ...] = ("year",)) -> DataFrame:
    """Counts over all rows, duration statistics over valid ones; rows without a year form their own.

    One scan: rows are counted by key and valid duration, and everything else,
    nearest-rank quantiles and interpolated median included, comes from those
    counts. So raw rows are neither joined nor sorted.
    """
    keys, d = list(keys), F.col("__d")
    counted = trips.groupBy(*keys, F.when(valid(), F.col("duration")).alias("__d")).agg(F.count("*").alias("__n"), F.count_if(any_null(*KEY_COLUMNS)).alias("__nulls"))
    totals = counted.groupBy(*keys).agg(F.sum("__n").alias("trip_count"), F.coalesce(F.sum(F.when(d.isNotNull(), F.col("__n"))), F.lit(0)).alias("valid_duration_count"), F.sum("__nulls").alias("null_rows"))
    shares = {"duration_5_percent": 0.05, "duration_q1": 0.25, "duration_q3": 0.75, "duration_95_percent": 0.95}
    places = {name: lambda n, q=q: (n - 1) * q + 0.5 for name, q in shares.items()} | {"__low": lambda n: (n - 1) / 2, "__high": lambda n: n / 2}
    ranks = at_ranks(counted, keys, "__d", "__n", places).withColumnsRenamed({k: f"__{k}" for k in keys})
    both = totals.join(ranks, reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]), "left")
    return both.select(*keys, "trip_count", "valid_duration_count", "null_rows", *shares, ((F.col("__low") + F.col("__high")) / 2).alias("duration_median"))


def null_rows(trips: DataFrame) -> DataFrame:
    return trips.groupBy("year").agg(F.count_if(any_null(*KEY_COLUMNS)).alias("null_rows"), F.count("*").alias("trips"))


def duration_buckets(trips: DataFrame) -> DataFrame:
    """Valid trips by minute of duration; the last bucket holds all from the cap on."""
    bucket = (F.floor(F.least(F.col("duration"), F.lit(CAP)) / BUCKET) * BUCKET).cast("bigint")
    return trips.where(valid() & F.col("year").isNotNull()).groupBy("year", bucket.alias("bucket")).agg(F.count("*").alias("count"))


def volume(trips: DataFrame, *keys: str) -> DataFrame:
    """Trips by calendar keys, rows without a year left out."""
    return trips.where("year is not null").groupBy(*keys).agg(F.count("*").alias("trips"))


def round_trip_share(trips: DataFrame) -> DataFrame:
    """Trips that end where they start; a missing station makes none."""
    same = F.count_if(F.coalesce(F.col("start_station_name") == F.col("end_station_name"), F.lit(False)))
    return trips.where("year is not null").groupBy("year").agg(F.count("*").alias("trips"), same.alias("round_trips")).withColumn("round_trip_share", F.round(F.col("round_trips") / F.col("trips"), 4))


def duration_bands(trips: DataFrame) -> DataFrame:
    """Valid trips by band, with a band's share of its year and its place in order."""
    band, place = F.lit(BANDS[-1][1]), F.lit(len(BANDS))
    for i, (edge, name) in reversed(list(enumerate(BANDS[:-1], 1))):
        band, place = F.when(F.col("duration") <= edge, name).otherwise(band), F.when(F.col("duration") <= edge, i).otherwise(place)
    counted = trips.where(valid() & F.col("year").isNotNull()).groupBy("year", band.alias("band"), place.alias("band_order")).agg(F.count("*").alias("trips"))
    return counted.withColumn("share", F.round(F.col("trips") / F.sum("trips").over(Window.partitionBy("year")), 4))


def endpoints(trips: DataFrame) -> DataFrame:
    """One row per trip end: year, month of the start, station, is_start. One pass over the trips."""
    ends = F.array(F.struct(F.col("start_station_name").alias("station"), F.lit(True).alias("is_start")), F.struct(F.col("end_station_name").alias("station"), F.lit(False).alias("is_start")))
    return trips.select("year", F.explode(ends).alias("e")).select("year", "e.station", "e.is_start")


def _flow(trips: DataFrame, *keys) -> DataFrame:
    return endpoints(trips).groupBy(*keys).agg(F.count_if("is_start").alias("trips_from"), F.count_if(~F.col("is_start")).alias("trips_to"))


def station_flow(trips: DataFrame, per_year: bool = True) -> DataFrame:
    """Departures and arrivals per station (and year of the start). Where a key is missing they are not matched: departures and arrivals are rows of their own."""
    keys = ["year", "station"] if per_year else ["station"]
    return _flow(trips, *keys, F.when(any_null(*keys), F.col("is_start")).alias("__side")).drop("__side")


def stations_by_year(trips: DataFrame) -> DataFrame:
    flow = station_flow(trips).where("station is not null and year is not null")
    return flow.select("year", "station", F.col("trips_from").alias("start_trips"), F.col("trips_to").alias("end_trips"), (F.col("trips_from") + F.col("trips_to")).alias("total_trips"))


def station_trip_counts(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(counts of named stations per year, dockless ends per year); trips without a year count as of one year."""
    flow = _flow(trips, "year", "station")
    return flow.where("station is not null"), flow.where("station is null").select("year", F.col("trips_from").alias("dockless_from"), F.col("trips_to").alias("dockless_to"))


def roll_up(counts: DataFrame, canonical: DataFrame) -> DataFrame:
    """Station counts by canonical name; canonical has name and aliases. A name without an entry stands for itself. Of a name under several entries the first by name counts."""
    names = canonical.select("name", F.explode(F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("__as")).groupBy("__as").agg(F.min("name").alias("__name"))
    joined = counts.join(names, F.col("station") == F.col("__as"), "left")
    return joined.groupBy("year", F.coalesce("__name", "station").alias("station")).agg(F.sum("trips_from").alias("trips_from"), F.sum("trips_to").alias("trips_to"), F.max(F.col("__name").isNull()).alias("unmatched"))

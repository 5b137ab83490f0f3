"""Append-only feeds as streams: new files into the trip table, and windowed volumes with late data bounded.

Changed or deleted files need `operators.incremental`; a file stream sees each file once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_trips(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """Parquet or other trip files as they arrive."""
    return spark.readStream.format(options.pop("format", "parquet")).schema(schema).options(**options).load(path)


def append_trips(trips: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Everything that is there now into the partitioned table, each file once."""
    dated = trips.withColumn("year", F.year("start_time")).withColumn("month", F.month("start_time"))
    return dated.writeStream.format("parquet").partitionBy("year", "month").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_volume(trips: DataFrame, late: str = "1 hour") -> DataFrame:
    """Trips per start hour and station; trips later than `late` behind the newest are dropped."""
    timed = trips.withColumn("at", F.col("start_time").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", "1 hour").alias("w"), "start_station_name").agg(F.count("*").alias("trips")).select(F.col("w.start").alias("hour"), "start_station_name", "trips")

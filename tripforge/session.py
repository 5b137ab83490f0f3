"""Session settings that the library's semantics rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # feeds in other charsets than Spark's own list, such as EUC-KR
    "spark.sql.legacy.javaCharsets": "true",
}


def session(name: str = "tripforge", **more: str) -> SparkSession:
    """A session with SETTINGS; `more` may add or override (dots as double underscores)."""
    builder = SparkSession.builder.appName(name)
    for k, v in {**SETTINGS, **{k.replace("__", "."): v for k, v in more.items()}}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()

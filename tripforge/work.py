"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_made: set[str] = set()


def work_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a temporary folder only where that is unset and the session local, as in tests. A cluster without it raises, as executors share no local folder."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tripforge-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    folder = f"{work_dir(spark)}/tripforge-{uuid.uuid4().hex}"
    _made.add(folder)
    return f"{folder}/{name}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read back: lineage ends here and survives lost executors. It stays until `clean_up`."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """`saved(make(), name)`; the intermediate tables that making it left behind are deleted."""
    before = set(_made)
    made = make()
    left = _made - before
    out = saved(made, name)
    _delete(out.sparkSession, left)
    return out


def file_system(spark: SparkSession, path: str):
    """(the Hadoop file system of a path, function from text to its paths)."""
    to_path = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
    return to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), to_path


def beside(path: str) -> str:
    """A new name beside `path`, on the same file system."""
    return f"{path.rstrip('/')}-{uuid.uuid4().hex}"


def put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """Renames the folder `staged` to `path`. What is at `path` is moved aside first, comes back if the rename fails, and is deleted once it is through."""
    fs, to_path = file_system(spark, path)
    old = beside(path)
    had = fs.exists(to_path(path))
    if had and not fs.rename(to_path(path), to_path(old)):
        raise OSError(f"{path} could not be moved aside")
    if not fs.rename(to_path(staged), to_path(path)):
        if had:
            fs.rename(to_path(old), to_path(path))
        raise OSError(f"{staged} could not be renamed to {path}")
    if had:
        fs.delete(to_path(old), True)


def _delete(spark: SparkSession, folders: set[str]) -> int:
    gone = 0
    for folder in folders:
        _made.discard(folder)
        fs, to_path = file_system(spark, folder)
        gone += fs.delete(to_path(folder), True)
    return gone


def clean_up(spark: SparkSession) -> int:
    """Deletes this process's intermediate tables and says how many. Results that were not written elsewhere cannot be read any more."""
    return _delete(spark, set(_made))


#: Rows and bytes of an Arrow batch that goes to a Python worker, at most, where rows carry whole texts.
BATCH_ROWS, BATCH_BYTES = 2_000, 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch limits, and leaves them so, as plans are run later: batches of long texts stay small on both sides of the exchange."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = str(spark.conf.get(key, str(most))).rstrip("b")
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))

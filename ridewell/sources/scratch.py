"""Tables that are written once and read many times: the model tables of a session, and files made for a query."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Files that a task keeps open while it writes a table by the values of a column; a task that meets more values sorts its rows by them.
OPEN_FILES = 16

_made: dict[tuple[str, str, str, tuple], str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a temporary folder only where it is unset and the master is local."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='ridewell-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that goes when the session ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def _stamp(spark: SparkSession, folder: str) -> tuple:
    """Names, lengths and times of what lies in a folder of tables; a table that is a folder counts by its own time."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return tuple(sorted((x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in found))


def write(df: DataFrame, path: str, *by: str) -> None:
    """Write a new table partitioned by `by`; where it has few values, rows go straight to their files, and no task sorts whole rows."""
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, max(int(before), OPEN_FILES))
    try:
        df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    finally:
        conf.set(key, before)


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame], *by: str) -> DataFrame:
    """The model table `name` over sf_dir, built and written by its first use in the session, partitioned by `by`.

    It is built anew where the tables in sf_dir have another length or time than they had.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name, _stamp(spark, sf_dir))
    if key not in _made:
        df, path = build(spark, sf_dir), new_path(spark, name)
        write(df, path, *by)
        _made[key] = path
    return spark.read.parquet(_made[key])

"""Tables of a system that change together: written under a new version, seen once its pointer moves.

A warehouse has `data/<table>/_system=s:<system>/_version=v<version>` and, for each system, a small file
`current/<system>` that names its version. Readers resolve those first, so they see all tables of a
system in one version; a run that breaks off leaves files that nobody reads, which prune() removes.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _system(version_folder) -> str:
    return unquote(version_folder.getParent().getName()).removeprefix("_system=s:")


def pointers(spark: SparkSession, warehouse: str) -> dict[str, str]:
    """System to version; a file for each system."""
    at, fs = _fs(spark, f"{warehouse}/current")
    if not fs.exists(at):
        return {}
    told = spark.read.option("pathGlobFilter", "*.json").schema("system string, version string").json(at.toString()).collect()
    return {r["system"]: r["version"] for r in told}


def _point(spark: SparkSession, warehouse: str, system: str, version: str) -> None:
    """Write the pointer beside and move it over the old one, which is one step."""
    jvm = spark._jvm
    name = uuid.uuid5(uuid.NAMESPACE_URL, system).hex
    target, fs = _fs(spark, f"{warehouse}/current/{name}.json")
    part, _ = _fs(spark, f"{warehouse}/current/_{name}-{version}")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps({"system": system, "version": version}).encode()))
    out.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(part).toUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(part), fs.makeQualified(target), over)


def commit(warehouse: str, tables: dict[str, DataFrame]) -> str:
    """Write all tables (each with a system_id) under a new version, then point the systems in any of them to it.

    A system becomes what the tables hold of it; other systems stay. With several systems each moves
    by itself. Columns that earlier versions lack are null in them.
    """
    spark = next(iter(tables.values())).sparkSession
    version = f"v{uuid.uuid4().hex}"
    for name, df in tables.items():
        # The letters before keep folder names from being read as numbers.
        df.select("*", F.concat(F.lit("s:"), "system_id").alias("_system"), F.lit(version).alias("_version")).write.mode("append").partitionBy("_system", "_version").parquet(f"{warehouse}/data/{name}")
    systems = set()
    for name in tables:  # names of folders, not rows
        at, fs = _fs(spark, f"{warehouse}/data/{name}")
        systems |= {_system(x.getPath()) for x in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{warehouse}/data/{name}/*/_version={version}")) or []}
    for system in sorted(systems):
        _point(spark, warehouse, system, version)
    return version


def read(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """The table in the current version of every system, by partition pruning; columns are those of any version that is read."""
    now = pointers(spark, warehouse)
    rows = spark.read.option("mergeSchema", True).option("basePath", f"{warehouse}/data/{table}").parquet(f"{warehouse}/data/{table}")
    mine = reduce(lambda a, b: a | b, [(F.col("_system") == f"s:{s}") & (F.col("_version") == v) for s, v in sorted(now.items())], F.lit(False))
    return rows.filter(mine).drop("_system", "_version")


def prune(spark: SparkSession, warehouse: str) -> list[str]:
    """Remove versions that no pointer names: what was replaced, and what a broken run left. Gives the removed folders."""
    now, gone = pointers(spark, warehouse), []
    at, fs = _fs(spark, f"{warehouse}/data")
    for x in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{warehouse}/data/*/_system=*/_version=*")) or []:
        path = x.getPath()
        if now.get(_system(path)) != path.getName().removeprefix("_version="):
            fs.delete(path, True)
            gone.append(path.toString())
    return gone

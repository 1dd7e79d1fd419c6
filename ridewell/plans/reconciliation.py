"""What the writing pass itself counted, and whether audit, manifest and metrics tell the same story."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import versions
from ..sources.landing import SourceFile, spanning_records, survey

#: Parts of an audit row that are measurements, none of which may be lacking.
MEASURES = ("source_records", "rows_landed", "lines_repaired", "kind")


def write_counted(df: DataFrame, path: str, counts: dict[str, Column], keep: Column | None = None, *by: str) -> dict[str, int]:
    """Write df's rows (those that `keep` says) and give aggregates over all of df, gathered in the pass that writes."""
    seen = Observation()
    rows = df.observe(seen, *[c.alias(n) for n, c in counts.items()])
    rows = rows if keep is None else rows.filter(keep)
    rows.write.mode("overwrite").partitionBy(*by).parquet(path)
    return {n: int(v or 0) for n, v in seen.get.items()}


def funnel_counts(reason: str = "reason") -> dict[str, Column]:
    """The row funnel as aggregates to observe: landed, kept and dropped rows by reason."""
    told = F.col(reason)
    return {"landed": F.count("*"), "kept": F.count_if(told.isNull()), **{r: F.count_if(F.coalesce(told == r, F.lit(False))) for r in ("no_time", "no_station", "duplicate")}}


def record(spark: SparkSession, warehouse: str, stage: str, told: dict[str, int]) -> None:
    """Put the stage's metrics in place of those of the same names; all of them change at once."""
    held = {}
    if stage in versions.pointers(spark, f"{warehouse}/metrics"):
        held = {r["metric"]: r["value"] for r in versions.read(spark, f"{warehouse}/metrics", "etl_metrics").filter(F.col("system_id") == stage).collect()}
    rows = [(stage, m, v) for m, v in sorted((held | told).items())]
    versions.commit(f"{warehouse}/metrics", {"etl_metrics": spark.createDataFrame(rows, "system_id string, metric string, value long")})


def metrics(spark: SparkSession, warehouse: str) -> DataFrame:
    """stage, metric and value, as they were recorded last."""
    return versions.read(spark, f"{warehouse}/metrics", "etl_metrics").withColumnRenamed("system_id", "stage")


def disagreements(audit: DataFrame, manifest: DataFrame, told: DataFrame, excluded: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """system_id, period, source_file and problem, one row for each way in which the three differ; none if they agree.

    audit as landing makes it; manifest: system_id, period, sha256; told: stage, metric, value. A file
    may lack a measure, land other than its records, or have no checksum or another than its pin; a
    period may be pinned and not landed, landed and not pinned, or landed and excluded; and the rows
    of all trip files may not be what the extracting stage recorded. An audit without a row is no
    agreement.
    """
    spark = audit.sparkSession
    out = spark.createDataFrame([(*x, True) for x in excluded], "system_id string, period string, _out boolean")
    files = audit.withColumnRenamed("source_period", "period").withColumn("_landed", F.lit(True))
    pins = manifest.select("system_id", "period", F.col("sha256").alias("_pin"), F.lit(True).alias("_listed")).join(out, ["system_id", "period"], "left_anti")
    both = files.join(pins, ["system_id", "period"], "full").join(out, ["system_id", "period"], "left")
    landed, listed = F.col("_landed").isNotNull(), F.col("_listed").isNotNull()
    tests = (
        (landed & F.expr(" or ".join(f"{m} is null" for m in MEASURES)), "a measure is lacking"),
        (landed & (F.col("source_records") != F.col("rows_landed")), "records and landed rows differ"),
        (landed & listed & F.col("source_sha256").isNull(), "no checksum"),
        (landed & listed & (F.col("source_sha256") != F.col("_pin")), "the pin has moved"),
        (~landed, "pinned and not landed"),
        (landed & ~listed & F.col("_out").isNull(), "landed and not pinned"),
        (landed & F.col("_out").isNotNull(), "landed and excluded"),
    )
    found = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), p) for t, p in tests]))
    rows = both.select("system_id", "period", "source_file", F.explode(found).alias("problem"))
    total = files.agg(F.coalesce(F.sum(F.when(F.col("kind") == "trips", F.col("rows_landed"))), F.lit(0)).alias("_sum"), F.count("*").alias("_files"))
    said = told.filter("stage = 'extract' and metric = 'rows_landed'").agg(F.max("value").alias("_said"))
    # One row against one row.
    whole = total.crossJoin(said)
    none = F.lit(None).cast("string")
    summed = whole.filter("_said is not null and _said <> _sum").select(none.alias("system_id"), none.alias("period"), none.alias("source_file"), F.lit("the recorded total is another").alias("problem"))
    empty = whole.filter("_files = 0").select(none.alias("system_id"), none.alias("period"), none.alias("source_file"), F.lit("the audit is empty").alias("problem"))
    return rows.unionByName(summed).unionByName(empty)


def moved(audit: DataFrame, manifest: DataFrame) -> DataFrame:
    """system_id, period and sha256 of the periods whose pin is not what their audit was written from."""
    rows = audit.select("system_id", F.col("source_period").alias("period"), "source_sha256")
    return manifest.join(rows, ["system_id", "period"]).filter(~F.col("source_sha256").eqNullSafe(F.col("sha256"))).select("system_id", "period", "sha256").distinct()


def recount(audit: DataFrame, manifest: DataFrame, files_of: Callable[[str, str], list[SourceFile]]) -> DataFrame:
    """Records of the files of moved periods, counted anew: system_id, period, source_file, was, now, and whether they agree.

    Only periods whose pin has moved, or that have no checksum, are read, so a second run after their
    audit is stamped() reads nothing. files_of gives the files of a (system, period) as they are now.
    """
    spark = audit.sparkSession
    stale = [(r["system_id"], r["period"]) for r in moved(audit, manifest).collect()]  # a row for each period
    files = [f for s, p in sorted(stale) for f in files_of(s, p)]
    seen = survey(spark, files)
    spanning = [s.file.path for s in seen if s.spans]
    by_quotes = {r["path"]: r["records"] for r in spanning_records(spark, spanning).collect()} if spanning else {}
    now = [(s.file.system_id, s.file.period, s.file.name, by_quotes.get(s.path, s.records)) for s in seen]
    fresh = spark.createDataFrame(now, "system_id string, period string, source_file string, now long")
    asked = spark.createDataFrame(stale, "system_id string, period string")
    was = audit.select("system_id", F.col("source_period").alias("period"), "source_file", F.col("rows_landed").alias("was")).join(asked, ["system_id", "period"], "left_semi")
    return was.join(fresh, ["system_id", "period", "source_file"], "full").withColumn("agrees", F.col("was").eqNullSafe(F.col("now")))


def stamped(audit: DataFrame, manifest: DataFrame, recounted: DataFrame) -> DataFrame:
    """The audit with the pins of those periods all of whose recounted files agree; counts stay as they were measured."""
    good = recounted.groupBy("system_id", "period").agg(F.every("agrees").alias("_good")).filter("_good")
    pins = manifest.join(good, ["system_id", "period"]).select("system_id", F.col("period").alias("source_period"), F.col("sha256").alias("_pin"))
    return audit.join(pins, ["system_id", "source_period"], "left").withColumn("source_sha256", F.coalesce("_pin", "source_sha256")).drop("_pin").select(audit.columns)


def weather_years(manifest: DataFrame, held: DataFrame, this_year: int) -> DataFrame:
    """system_id, year, volatile and held: every year from a system's first to its last pinned period.

    manifest: system_id, period (whose first four characters are a year); held: system_id, year. The
    current year, and any later, is volatile: its file still grows, so its pin may move.
    """
    span = manifest.groupBy("system_id").agg(F.min(F.substring("period", 1, 4).cast("int")).alias("a"), F.max(F.substring("period", 1, 4).cast("int")).alias("b"))
    wanted = span.select("system_id", F.explode(F.sequence("a", "b")).alias("year"))
    return wanted.join(held.select("system_id", "year", F.lit(True).alias("held")).distinct(), ["system_id", "year"], "left").select("system_id", "year", (F.col("year") >= this_year).alias("volatile"), F.coalesce("held", F.lit(False)).alias("held"))

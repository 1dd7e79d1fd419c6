"""Counts of the writing pass, agreement of audit, manifest and metrics, weather years, functions in SQL."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ridewell.functions import exprs as X
from ridewell.functions import sql as Q
from ridewell.plans import reconciliation as R
from ridewell.sources import landing as L

AUDIT = "system_id string, source_period string, source_file string, source_sha256 string, rows_landed long, lines_repaired long, rows_too_long long, source_records long, kind string"


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") % 3).cast("string").alias("system_id"), F.when(F.col("id") < 10, "no_time").when(F.col("id") < 15, "duplicate").alias("reason"))
    told = R.write_counted(rows, str(tmp_path / "kept"), R.funnel_counts(), F.col("reason").isNull(), "system_id")
    assert told == {"landed": 100, "kept": 85, "no_time": 10, "no_station": 0, "duplicate": 5} and spark.read.parquet(str(tmp_path / "kept")).count() == 85
    home = str(tmp_path)
    R.record(spark, home, "clean", told)
    R.record(spark, home, "extract", {"rows_landed": 7})
    R.record(spark, home, "clean", {"kept": 1, "more": 2})
    assert {(r.stage, r.metric): r.value for r in R.metrics(spark, home).collect()} == {("extract", "rows_landed"): 7, ("clean", "landed"): 100, ("clean", "kept"): 1, ("clean", "no_time"): 10, ("clean", "no_station"): 0, ("clean", "duplicate"): 5, ("clean", "more"): 2}


def audit(spark, *rows):
    return spark.createDataFrame([("v", p, f"{p}.csv", sha, n, 0, 0, n, "trips") for p, sha, n in rows], AUDIT)


def test_agreement_and_an_empty_audit(spark):
    pins = spark.createDataFrame([("v", "1", "a"), ("v", "2", "b")], "system_id string, period string, sha256 string")
    told = spark.createDataFrame([("extract", "rows_landed", 5)], "stage string, metric string, value long")
    assert R.disagreements(audit(spark, ("1", "a", 2), ("2", "b", 3)), pins, told).count() == 0
    found = R.disagreements(spark.createDataFrame([], AUDIT), pins, told.limit(0), [("v", "2")]).collect()
    assert sorted((r.period or "", r.problem) for r in found) == [("", "the audit is empty"), ("1", "pinned and not landed")]


def test_only_moved_periods_are_recounted(spark, tmp_path):
    for name, body in (("1.csv", "Id\n1\n2\n"), ("2.csv", 'Id,T\n1,"a\nb"\n2,\n3,\n')):
        (tmp_path / name).write_text(body)
    asked = []

    def files_of(system, period):
        asked.append(period)
        return [L.SourceFile(str(tmp_path / f"{period}.csv"), system, period, "new")]

    pins = spark.createDataFrame([("v", "1", "new"), ("v", "2", "new"), ("v", "3", "same")], "system_id string, period string, sha256 string")
    before = audit(spark, ("1", "old", 9), ("2", None, 3), ("3", "same", 4))
    counted = R.recount(before, pins, files_of)
    assert sorted((r.period, r.was, r.now, r.agrees) for r in counted.collect()) == [("1", 9, 2, False), ("2", 3, 3, True)] and asked == ["1", "2"]
    after = R.stamped(before, pins, counted)
    assert sorted((r.source_period, r.source_sha256, r.rows_landed) for r in after.collect()) == [("1", "old", 9), ("2", "new", 3), ("3", "same", 4)]
    assert R.moved(after, pins).count() == 1


def test_weather_years_of_ranges(spark):
    pins = spark.createDataFrame([("t", "2014-2015"), ("t", "2017-03"), ("w", "2020")], "system_id string, period string")
    held = spark.createDataFrame([("t", 2015), ("x", 2000)], "system_id string, year int")
    assert sorted(map(tuple, R.weather_years(pins, held, 2017).collect())) == [("t", 2014, False, False), ("t", 2015, False, True), ("t", 2016, False, False), ("t", 2017, True, False), ("w", 2020, True, False)]


TEXTS = ["43101.5", "  1.0", "NULL", " null ", "0069  7th & Granville", "Rue A / B (old) - C", "", None, "2024-03-05 07:08:09", "3/4/24 5:06", "3/14/2024 5:06:07", "14/3/2024 5:06", "2024/3/4 5:06", "12.00", "99999", "A  b\tC"]
TEXT_FORMS = {"number_of": X.number, "excel_ts": X.excel_ts, "parse_month_first": X.parse_month_first, "parse_day_first": X.parse_day_first, "norm_key": X.norm_key, "norm_name": X.norm_name, "id_prefix": X.id_prefix, "without_prefix": X.without_prefix, "bridge_name": X.bridge_name, "display_label": X.display_label}


@pytest.mark.parametrize("name", sorted(TEXT_FORMS))
def test_functions_of_text_are_the_same_in_sql(spark, name):
    Q.register(spark)
    spark.createDataFrame([(t,) for t in TEXTS], "s string").createOrReplaceTempView("texts")
    made = spark.sql(f"SELECT s, {name}(s) AS a FROM texts").withColumn("b", TEXT_FORMS[name](F.col("s")))
    assert [tuple(r) for r in made.filter("NOT (a <=> b)").collect()] == [] and dict(made.dtypes)["a"] == dict(made.dtypes)["b"]
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()


def test_functions_of_times_and_places_are_the_same_in_sql(spark):
    Q.register(spark)
    rows = [(t, d, i * 86_400_000_123, z, b, 45.0 + i, -73.0) for i, (t, d, z, b) in enumerate([("3/4/24 5:06", "day", "America/Toronto", "utc"), ("3/4/24 5:06", "month", "America/Vancouver", "local"), ("43101.25", "day", "UTC", "utc"), (None, None, "UTC", None)])]
    spark.createDataFrame(rows, "s string, d string, ms long, zone string, basis string, lat double, lon double").createOrReplaceTempView("times")
    made = spark.sql("SELECT *, parse_ts_ord(s, d) AS t1, as_local(parse_ts_ord(s, d), zone, basis) AS t2, to_local(ms, zone) AS t3, hav(lat, lon, 45.5, -73.6) AS m, fix_short_year(TIMESTAMP_NTZ '0024-01-02 03:04:05') AS y FROM times")
    ts = X.parse_ts_ord(F.col("s"), F.col("d"))
    own = {"t1": ts, "t2": X.as_local(ts, F.col("zone"), F.col("basis")), "t3": X.to_local(F.col("ms"), F.col("zone")), "m": X.hav(F.col("lat"), F.col("lon"), F.lit(45.5), F.lit(-73.6)), "y": X.fix_short_year(F.lit("0024-01-02 03:04:05").cast("timestamp_ntz"))}
    both = made.select(*[F.col(c).eqNullSafe(x).alias(c) for c, x in own.items()]).collect()
    assert all(all(r) for r in both)

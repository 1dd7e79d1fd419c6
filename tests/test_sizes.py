"""What tasks shuffle, sort and hold: shapes of plans that keep their figures in proportion to the input."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from ridewell.operators import trips as O
from ridewell.plans import catalog as C
from ridewell.plans import metrics as M
from ridewell.sources import sample as D
from ridewell.sources import scratch

SF = "/root/testdata/sf0.001"


@pytest.fixture
def unbroadcast(spark):
    """Plans as they are where no table is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    yield
    spark.conf.set(key, before)


def nodes(plan):
    plan = plan.initialPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def planned(df):
    return list(nodes(df._jdf.queryExecution().executedPlan()))


def test_lines_are_shuffled_before_they_grow_wide(spark, unbroadcast):
    widths = [p.output().size() for p in planned(D.trips_o(spark, SF)) if p.nodeName() == "Exchange"]
    assert widths and max(widths) <= 6


def test_model_tables_are_written_without_a_sort(spark, monkeypatch):
    """As many files may be open in a task as there are systems, and the session's setting is back afterwards."""
    key, seen, plain = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(int(spark.conf.get(key))), plain(self, *a, **k))[1])
    before = spark.conf.get(key)
    made = scratch.once(spark, SF, "unsorted", lambda s, d: D.read(s, d, "nation").selectExpr("n_regionkey % 2 AS k", "n_nationkey"), "k")
    assert seen and seen[0] >= 5 and spark.conf.get(key) == before
    assert made.count() == 25 and {r["k"] for r in made.select("k").distinct().collect()} == {0, 1}


def test_usage_is_added_up_without_sorting_trips(spark):
    """Labels by latest time, ties to the greater one; NULL texts, lacking labels and times count as events only."""
    cols = "system_id string, departure_station_id string, departure_label string, departure_ts timestamp_ntz, return_station_id string, return_label string, return_ts timestamp_ntz"
    day = lambda d: datetime(2020, 1, d)
    trips = spark.createDataFrame(
        [("s", "a", "old", day(1), "b", "B", day(2)), ("s", "a", "new", day(5), "a", "newer", day(5)), ("s", "a", "NULL", day(9), None, None, None), ("s", "b", None, day(7), "a", "lost", None), ("t", "a", None, None, "a", None, day(3))], cols,
    )
    used = O.usage(trips)
    assert not any(p.nodeName().startswith("Sort") for p in planned(used))
    told = used.groupBy("system_id", "station_id").agg(O.latest_label().alias("label"), F.sum("events").alias("n"), F.min("first_ts").alias("a"), F.max("last_ts").alias("b"))
    assert {tuple(r) for r in told.collect()} == {("s", "a", "newer", 5, day(1), day(9)), ("s", "b", "B", 2, day(2), day(7)), ("t", "a", None, 2, day(3), day(3))}


def test_no_task_holds_all_stations_of_a_system(spark):
    seen = {p.nodeName() for p in planned(O.dim_station(C.usage(spark, SF), C.identity(spark, SF), O.snapshots(D.listed(spark, SF)), D.live(spark, SF)))}
    assert "Window" not in seen


def test_canonical_stations_are_given_without_a_shuffle_of_trips(spark):
    """Renamed ids lie in a table of their own, whose size Spark knows; elsewhere ids stay as they are."""
    fact = D.fact_o(spark, SF)
    made = C.canonical(spark, SF, fact)
    assert not any("Exchange" in p.nodeName() and "Broadcast" not in p.nodeName() for p in planned(made))
    ends = ["system_id", "departure_station_id", "return_station_id"]
    full = {(r["system_id"], r["source_id"]): r["canonical_id"] for r in C.identity(spark, SF).collect()}
    want = sorted(str((r[0], full.get((r[0], r[1])), full.get((r[0], r[2])))) for r in fact.select(*ends).collect())
    assert sorted(str(tuple(r)) for r in made.select(*ends).collect()) == want


def test_a_run_reads_its_cleaned_trips_for_usage_and_fact_only(spark, monkeypatch):
    """Stations are told from few rows of usage, labels and days from the written fact."""
    read = {}
    for name in ("station_identity", "dim_station", "dim_membership", "dim_date"):
        plain = getattr(O, name)
        monkeypatch.setattr(O, name, lambda rows, *more, name=name, plain=plain: (read.update({name: {f.split("/model/")[-1].split("/")[0] for f in rows.inputFiles()}}), plain(rows, *more))[1])
    assert C.QUERIES["run_metrics"](spark, SF).count() == 12
    assert read == {"station_identity": {"station_usage"}, "dim_station": {"station_usage"}, "dim_membership": {"fact_trips"}, "dim_date": {"fact_trips"}}


def test_chains_of_bikes_are_dealt_by_bike(spark, unbroadcast):
    """A system's trips do not meet in one task, however its runs of years are known."""
    fact = D.fact_o(spark, SF)
    dealt = [p.outputPartitioning().toString() for p in planned(M.dwell(fact, M.bike_eras(M.bike_coverage(fact)))) if p.nodeName() == "Exchange" and "bike_id" in {p.output().apply(i).name() for i in range(p.output().size())}]
    assert dealt and all("bike_id" in d for d in dealt)


def test_only_rows_that_may_repeat_are_sorted_and_without_their_texts(spark):
    """Elsewhere a repeat is kept, so its place is not looked for; a row that two reasons drop has the first."""
    rows = C.landed(spark, SF)
    sorted_ = [{p.output().apply(i).name() for i in range(p.output().size())} for p in planned(O.funnel(rows)) if p.nodeName() == "Sort"]
    assert sorted_ and not any(s & {"departure_station_key", "departure_station_name"} for s in sorted_)
    assert {r["system_id"] for r in rows.filter("at is not null").select("system_id").distinct().collect()} == {"sys-1"}
    assert rows.filter("at is null and system_id <=> 'sys-1'").count() == 0 and rows.count() == D.read(spark, SF, "lineitem").count()
    bare = F.col("departure_station_key").isNull() & F.col("departure_station_name").isNull()
    want = F.when(F.col("departure_ts").isNull(), "no_time").when(bare, "no_station").when(F.col("at") > 1, "duplicate")
    assert rows.filter(~F.col("reason").eqNullSafe(want)).count() == 0

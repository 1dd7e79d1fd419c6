"""Small frames whose right answers are known by construction, with the defects that a plain query would pass."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ridewell.functions import exprs as X
from ridewell.operators import scenario as S
from ridewell.operators import trips as O
from ridewell.plans import metrics as M

TS = dt.datetime


def values(spark, column, *texts):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "s string").select(column(F.col("s"))).collect()]


def test_names_and_keys(spark):
    assert values(spark, X.norm_key, " NULL ", "12.0", "", None, "007") == [None, "12", None, None, "007"]
    assert values(spark, X.norm_name, "  A\t b ", "null", "") == ["a b", None, None]
    assert values(spark, X.bridge_name, "Rue A / Rue B (old)", "X - Y") == ["rue a/rue b", "x-y"]
    assert values(spark, X.id_prefix, "0901 Cambie", "Cambie") == ["0901", ""]
    assert values(spark, X.without_prefix, "0901 Cambie", "0901 ") == ["Cambie", None]


def test_numbers_are_strict(spark):
    assert values(spark, X.number, "1d", "1_000", " 2.5 ", "NaN", "") == [None, None, 2.5, None, None]
    assert [r[0] for r in spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double").select(X.whole(F.col("x"))).collect()] == [0, 2, 2]


def test_dates(spark):
    month = lambda s: X.parse_ts_ord(s, F.lit("month"))
    assert values(spark, month, "3/4/2019 7:05", "3/4/19 7:05", "2025-02-01 0:00", "43000.5", "x") == [TS(2019, 3, 4, 7, 5), TS(2019, 3, 4, 7, 5), TS(2025, 2, 1), TS(2017, 9, 22, 12), None]
    assert values(spark, lambda s: X.parse_ts_ord(s, F.lit("day")), "3/4/2019 7:05") == [TS(2019, 4, 3, 7, 5)]


def test_transposed_days_keep_their_fraction(spark):
    df = spark.createDataFrame([(TS(2016, 10, 3, 4, 5, 6, 789),), (TS(2016, 10, 13),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(O.repair_transposed(F.col("t"), F.lit(True))).collect()] == [TS(2016, 3, 10, 4, 5, 6, 789), TS(2016, 10, 13)]


def test_date_orders_are_resolved_or_refused():
    assert O.resolve_orders({("a", "f"): "day", ("a", "g"): "ambiguous"}, {("a", "g"): "month"}) == {("a", "f"): "day", ("a", "g"): "month"}
    for found, told in (({("a", "f"): "conflict"}, {}), ({("a", "f"): "ambiguous"}, {}), ({("a", "f"): "day"}, {("a", "f"): "day"}), ({}, {("a", "f"): "day"})):
        with pytest.raises(ValueError):
            O.resolve_orders(found, told)


def test_twin_docks_do_not_merge(spark):
    place = spark.createDataFrame([("p", 45.0, -73.0), ("q", 46.0, -73.0), ("r", None, None)], "era_id string, lat double, lon double")
    dock = spark.createDataFrame([("1", 45.0001, -73.0), ("2", 45.0004, -73.0), ("3", 46.0001, -73.0)], "station_id string, lat double, lon double")
    assert [(r.era_id, r.station_id) for r in O.nearest(place, dock).collect()] == [("q", "3")]


def test_bridge_takes_the_surest_match(spark):
    gbfs = spark.createDataFrame([("9101", "6001", "A / B (x)", 45.5, -73.5), ("9102", "6002", "C", 45.6, -73.6)], "station_id string, short_name string, name string, lat double, lon double")
    seen = spark.createDataFrame([("m:name:a/b", "a/b", 45.9, -73.9), ("m:name:zz", "zz", 45.6001, -73.6)], "era_id string, nm string, lat double, lon double")
    lost = spark.createDataFrame([("m:77", "C", None, None), ("m:78", "C (old)", None, None), ("m:6001", "C", 45.6, -73.6)], "era_id string, label string, lat double, lon double")
    got = {r.era_id: (r.canonical_id, r.via) for r in O.bridge(gbfs, seen, lost, "m").collect()}
    assert got["m:6001"] == ("m:s9101", "code") and got["m:9102"] == ("m:s9102", "pk")
    assert got["m:name:a/b"] == ("m:s9101", "name") and got["m:name:zz"] == ("m:s9102", "geo") and got["m:77"] == ("m:s9102", "pk-name")
    assert "m:78" not in got


def test_funnel_has_no_residual(spark):
    t = TS(2020, 1, 1)
    rows = spark.createDataFrame([(None, "k", "n", False), (t, None, None, False), (t, "k", None, True), (t, "k", None, False)], "departure_ts timestamp_ntz, departure_station_key string, departure_station_name string, dup boolean")
    out = O.funnel(rows.withColumn("reason", O.drop_reason(F.col("dup"), F.lit(True)))).first().asDict()
    assert out == {"landed": 4, "kept": 1, "no_time": 1, "no_station": 1, "duplicate": 1, "residual": 0}


def test_snapshots_keep_the_last_known_value(spark):
    rows = spark.createDataFrame([("s", "1", "2020", "old", 45.0, -73.0), ("s", "1", "2021", None, 45.1, -73.0)], "system_id string, station_key string, source_period string, station_name string, lat double, lon double")
    r = O.snapshots(rows).first()
    assert (r.station_name, r.lat, r.first_seen_period, r.last_seen_period) == ("old", 45.1, "2020", "2021")


def test_dwell_does_not_cross_withheld_years(spark):
    cov = spark.createDataFrame([("s", 2019, 1.0), ("s", 2020, 1.0), ("s", 2021, 0.5), ("s", 2022, 1.0)], "system_id string, year long, coverage double")
    assert sorted((r.lo, r.hi) for r in M.bike_eras(cov).collect()) == [(2019, 2020), (2022, 2022)]


def planted(days=26):
    rng, rows = np.random.default_rng(1), []
    for year in (2017, 2018, 2019):
        for month in range(1, 13):
            for d in range(1, days + 1):
                hi, lo, rain, snow = rng.normal(12, 8), rng.normal(4, 6), float(rng.integers(0, 9)), float(rng.integers(0, 4))
                date = dt.date(year, month, d)
                y = 5 + 0.03 * hi - 0.01 * lo - 0.2 * np.log1p(rain) - 0.1 * np.log1p(snow) - 0.15 * (date.weekday() >= 5) + 0.02 * month
                rows.append({"system_id": "s", "day": date, "trips": float(np.exp(y)), "temp_max_c": hi, "temp_min_c": lo, "precip_mm": rain, "snow_cm": snow, "is_weekend": date.weekday() >= 5, "block": f"{year}-{month:02d}"})
    return pd.DataFrame(rows)


def test_fit_recovers_planted_coefficients(spark):
    days = planted()
    r = S.fit(spark.createDataFrame(days.assign(reason=None).astype({"reason": object}), "system_id string, day date, trips double, temp_max_c double, temp_min_c double, precip_mm double, snow_cm double, is_weekend boolean, block string, reason string")).first()
    assert np.allclose(r.coefficients[:5], [0.03, -0.01, -0.2, -0.1, -0.15], atol=1e-6)
    assert r.parameters == 41 and r.month_levels == 36 and r.cv_r2_log > 0.999999 and r.cv_held_out_days == len(days)


def test_fit_refuses(spark):
    with pytest.raises(S.Undetermined):
        S.fit_group(planted().head(5))
    with pytest.raises(S.Undetermined):
        S.fit_group(planted().assign(snow_cm=0.0))


def test_reference_year_needs_all_systems(spark):
    days = pd.concat([planted(), planted().assign(system_id="t").query("block < '2019-06'")])
    df = spark.createDataFrame(days[["system_id", "day", "trips"]]).withColumn("reason", F.lit(None).cast("string"))
    assert S.reference_year(df).first()[0] == 2018

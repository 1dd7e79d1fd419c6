"""Files in, landed rows out: layouts, encodings, quoted line breaks, refusals; feeds and weather."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ridewell.operators import cleaning
from ridewell.plans import publishing as P
from ridewell.sources import landing as L
from ridewell.sources import versions as V

MAPS = {"van": L.EraMap({"Start": "departure_raw", "Station": "departure_station_name", "Id": "trip_id", "Remark": "", "Begin": "departure_raw"}, {"code": "station_key", "name": "station_name", "lat": "lat", "lon": "lon"})}


def file(folder, name, content, period="2024-01"):
    (folder / name).write_bytes(content if isinstance(content, bytes) else content.encode())
    return L.SourceFile(str(folder / name), "van", period, "sha")


def test_layouts_encodings_and_audit(spark, tmp_path):
    files = [
        file(tmp_path, "a.csv", "Id,Start,Station,Remark\n1,2024-01-01 10:00,Rue Café,x\n2,2024-01-01 11:00,\n"),
        file(tmp_path, "b.csv", b"Begin,Id\n2024-02-01,3\n", "2024-02"),
        file(tmp_path, "c.csv", b"Id,Start,Station,Remark\n4,2024-03-01,King\x92s College,\n5,2024-03-02,Caf\xc3\xa9,\n6,2024-03-03,odd \x81 byte,\n", "2024-03"),
        file(tmp_path, "d.csv", 'Id,Start,Station,Remark\n7,2024-04-01,"two\nlines",\n8,2024-04-02,"a ""b"" c",\n', "2024-04"),
        file(tmp_path, "s.csv", "code,name,lat,lon\n12,Parc,45.5,-73.5\n", "2024"),
    ]
    landed = L.land(spark, files, MAPS)
    rows = {r.trip_id: r for r in landed.tables["trips"].collect()}
    assert {k: r.departure_station_name for k, r in rows.items()} == {"1": "Rue Café", "2": None, "3": None, "4": "King’s College", "5": "Café", "6": "odd \x81 byte", "7": "two\nlines", "8": 'a "b" c'}
    assert rows["3"].departure_raw == "2024-02-01" and rows["3"].source_file == "b.csv" and rows["3"].source_period == "2024-02"
    audit = {r.source_file: r for r in landed.audit.collect()}
    assert {k: (r.source_records, r.rows_landed, r.lines_repaired, r.kind) for k, r in audit.items()} == {"a.csv": (2, 2, 0, "trips"), "b.csv": (1, 1, 0, "trips"), "c.csv": (3, 3, 2, "trips"), "d.csv": (2, 2, 0, "trips"), "s.csv": (1, 1, 0, "stations")}
    assert [r.station_key for r in landed.tables["stations"].collect()] == ["12"]
    assert {r.kind: (r.files, r.disagree, r.unpinned) for r in L.landing_summary(landed.audit).collect()} == {"trips": (4, 0, 0), "stations": (1, 0, 0)}
    assert [tuple(r) for r in L.repair_summary(landed.audit).collect()] == [("van", 5, 1, 2)]
    L.reload(landed, str(tmp_path / "warehouse"))
    again = L.land(spark, files[:1], MAPS)
    L.reload(again, str(tmp_path / "warehouse"))
    assert V.read(spark, str(tmp_path / "warehouse"), "raw_trips").count() == 2
    assert len(L.header_census(spark, files)) == 3


def test_no_file_is_lost_for_its_name(spark, tmp_path):
    """Blanks and signs in names, paths that end alike, files with a header only or nothing: each listed file has its audit row."""
    names = ["trips 2018.csv", "100%.csv", "a%20b.csv", "x#1.csv", "[ab]{c}*?.csv", "1.csv", "y/1.csv", "deep/y/1.csv", "only header.csv", "nothing.csv", "spanning lines.csv", "a+b&c=d.csv"]
    files = []
    for i, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        body = {"only header.csv": "Id,Start\n", "nothing.csv": "", "spanning lines.csv": f'Id,Start,Remark\n{i},2024,"a\n\n""b"", c"\n\n{i},2025,\n{i},2026,"x\ny"'}.get(name, f"Id,Start\n{i},2024\n{i},2025\n")
        files.append(file(tmp_path, name, body, f"p{i}"))
    landed = L.land(spark, files, MAPS)
    rows = sorted((int(r.source_period[1:]), r.trip_id) for r in landed.tables["trips"].collect())
    assert rows == sorted((i, str(i)) for i, n in enumerate(names) if "header" not in n and "nothing" not in n for _ in range(3 if "spanning" in n else 2))
    audit = {r.source_period: (r.source_records, r.rows_landed, r.kind) for r in landed.audit.collect()}
    assert audit == {f"p{i}": {"only header.csv": (0, 0, "trips"), "nothing.csv": (0, 0, "empty"), "spanning lines.csv": (3, 3, "trips")}.get(n, (2, 2, "trips")) for i, n in enumerate(names)}
    assert [r.source_file for r in L.unaccounted(landed.audit).collect()] == ["nothing.csv"]
    with pytest.raises(L.LandingRefused, match="twice"):
        L.land(spark, [files[0], files[0]], MAPS)
    plan = landed.tables["trips"]._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_records_are_counted_apart_from_rows(spark, tmp_path):
    """A quoted field that never ends swallows rows when it is read; the count by quotes says so."""
    files = [file(tmp_path, "open.csv", 'Id,Start,Remark\n1,2,"a\nb"\n3,4,"never\n5,6,x\n7,8,y\n')]
    (row,) = L.land(spark, files, MAPS).audit.collect()
    assert (row.source_records, row.rows_landed) in {(1, 2)} and L.unaccounted(L.land(spark, files, MAPS).audit).count() == 1


def test_spanning_records_over_blocks(spark, tmp_path):
    """Fields that span lines are counted right wherever a block begins."""
    body = "Id,Start,Remark\n" + "".join(f'{i},2024,"line one of {i}\nline two, ""quoted""\n\nlast"\n' if i % 3 else f"{i},2024,plain\n" for i in range(400))
    f = file(tmp_path, "long.csv", body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert L._lines(spark, [f.path]).select("block").distinct().count() > 10
        assert [r.records for r in L.spanning_records(spark, [f.path]).collect()] == [400]
        assert [(s.header, s.spans) for s in L.survey(spark, [f])] == [(("Id", "Start", "Remark"), True)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_versions_change_together(spark, tmp_path):
    """A run that breaks off between tables leaves the old version whole; later columns lie beside earlier ones."""
    home = str(tmp_path / "wh")
    frame = lambda rows, more="": spark.createDataFrame(rows, "system_id string, n long" + more)
    V.commit(home, {"t": frame([("1", 1), ("b/x", 2)]), "u": frame([("1", 10)])})
    assert sorted(map(tuple, V.read(spark, home, "t").collect())) == [("1", 1), ("b/x", 2)]
    broken = frame([("1", 7)]).withColumn("n", F.raise_error(F.lit("power cut")).cast("long"))
    with pytest.raises(Exception, match="power cut"):
        V.commit(home, {"t": frame([("1", 5)]), "u": broken})
    assert sorted(map(tuple, V.read(spark, home, "t").collect())) == [("1", 1), ("b/x", 2)] and [r.n for r in V.read(spark, home, "u").collect()] == [10]
    V.commit(home, {"t": frame([("1", 3, "new")], ", more string"), "u": frame([], "")})
    assert sorted((r.system_id, r.n, r.more) for r in V.read(spark, home, "t").collect()) == [("1", 3, "new"), ("b/x", 2, None)]
    assert V.read(spark, home, "u").count() == 0
    assert len(V.prune(spark, home)) == 3 and sorted(r.n for r in V.read(spark, home, "t").collect()) == [2, 3]


def test_what_landing_refuses(spark, tmp_path):
    with pytest.raises(L.UnknownColumns):
        L.land(spark, [file(tmp_path, "a.csv", "Id,Start,Mystery\n1,2,3\n")], MAPS)
    with pytest.raises(L.UnknownColumns):
        L.land(spark, [file(tmp_path, "b.csv", "Start,Begin\n1,2\n")], MAPS)
    with pytest.raises(L.UnknownColumns):
        L.land(spark, [file(tmp_path, "c.csv", "What\n1\n")], MAPS)
    long = L.land(spark, [file(tmp_path, "d.csv", "Id,Start\n1,2\n3,4,5\n")], MAPS)
    with pytest.raises(L.RowsUnaccounted):
        L.reload(long, str(tmp_path / "warehouse"))
    assert not (tmp_path / "warehouse").exists()
    listed = {"van": {"sources": {"2024-01": {"sha256": "x"}, "2024-02": {}, "2024-03": {"sha256": "y"}}}}
    with pytest.raises(L.UnpinnedSource):
        L.pinned(listed)
    assert [p for _, p, _ in L.pinned(listed, [("van", "2024-02")], limit=1)] == ["2024-01"]


def test_feed_and_weather(spark, tmp_path):
    stations = [{"station_id": 7, "name": "A", "lat": 49.1, "lon": -123.0, "capacity": 20}, {"station_id": "0008", "short_name": 9, "name": "B", "lat": 49.2, "lon": -123.1}]
    (tmp_path / "feed.json").write_text(json.dumps({"ttl": 1, "data": {"stations": stations}}, indent=1))
    rows = L.station_feed(spark, {"van": str(tmp_path / "feed.json")}).orderBy("name").collect()
    assert [(r.station_id, r.short_name, r.capacity) for r in rows] == [("7", None, 20), ("0008", "9", None)]
    names = ["Climate ID", "Date/Time", *L.WEATHER]
    lines = ['"%s"' % '","'.join(names), '"1","2024-01-01","1.5","2","x","0","",""', '"1","2024-01-02","","","","","",""']
    (tmp_path / "w.csv").write_text("\n".join(lines))
    days = L.weather_daily(spark, "van", [str(tmp_path / "w.csv")], "1").collect()
    assert [(str(d.date_key), d.temp_mean_c, d.temp_min_c, d.precip_mm) for d in days] == [("2024-01-01", 1.5, None, 0.0)]
    with pytest.raises(L.LandingRefused):
        L.weather_daily(spark, "van", [str(tmp_path / "w.csv")], "2")


def test_era_map_file(tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"_note": "x", "trips": {"_c": "remark", "A": "trip_id"}, "stations": {}}))
    made = L.EraMap.load(tmp_path / "m.json")
    assert made.trips == {"A": "trip_id"} and made.kind([" A ", "B"]) == "trips" and made.kind(["B"]) is None


def test_landed_to_identified(spark, tmp_path):
    columns = {c: "string" for c in (*L.PROVENANCE, *L.TRIP_COLUMNS)}
    rows = [{"system_id": "van", "source_file": "f", "departure_raw": "03/02/2024 10:00", "departure_station_name": "0069 7th & Granville", "electric_bike": "true", "duration_s": "12.5"}, {"system_id": "van", "source_file": "f", "departure_raw": "x", "departure_station_name": "y"}, {"system_id": "van", "source_file": "g", "departure_raw": "2024-02-03 10:00", "departure_station_key": "NULL", "departure_station_name": " null "}]
    raw = spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], ", ".join(f"{c} {t}" for c, t in columns.items()))
    orders = spark.createDataFrame([("van", "f", "day")], "system_id string, source_file string, date_order string")
    zones = spark.createDataFrame([("van", "America/Vancouver")], "system_id string, zone string")
    typed = cleaning.typed(raw, orders, zones)
    (row,) = cleaning.identified(cleaning.kept(typed), ("van",), {"van": "flag"}).collect()
    assert (str(row.departure_ts), row.departure_station_id, row.departure_label, row.is_ebike, row.departure_station_match, row.duration_s) == ("2024-02-03 10:00:00", "van:0069", "7th & Granville", True, "id", 12)


SHAPES = {"one": (("system_id", "n"), ("system_id",))}
RULED = P.Policies({"all": "counts all"}, {}, {"one": {"rule": "all", "reason": "counts"}})


def test_artifacts_are_whole_or_not_at_all(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1), ("a", 2)], "system_id string, n long")
    made = P.Artifacts(SHAPES, RULED)
    made.add("one", rows)
    assert made.texts["one"] == '[{"system_id":"a","n":2},{"system_id":"b","n":1}]\n'
    with pytest.raises(P.OverBudget):
        made.write(tmp_path / "out", budget=10)
    assert not (tmp_path / "out").exists()
    assert made.write(tmp_path / "out") == sum(made.sizes().values()) and made.drift(tmp_path / "out") == {}
    (tmp_path / "out/two.json").write_text("[]")
    (tmp_path / "out/one.json").write_text("[]")
    assert made.drift(tmp_path / "out") == {"one": "drifted", "two": "orphaned"}
    for broken in (rows.withColumnRenamed("n", "m"), rows.unionByName(rows), spark.createDataFrame([(None, 1)], "system_id string, n long"), spark.createDataFrame([("a", float("nan"))], "system_id string, n double")):
        with pytest.raises(P.ShapeBroken):
            P.Artifacts(SHAPES, RULED).add("one", broken)
    with pytest.raises(P.ShapeBroken):
        made.add("three", rows)


def test_policies_leave_no_gap():
    P.POLICIES.check(P.SHAPES)
    assert len(P.SHAPES) == 15
    with pytest.raises(P.PolicyGap, match="without a policy"):
        P.POLICIES.check([*P.SHAPES, "more"])
    with pytest.raises(P.PolicyGap, match="not published"):
        P.POLICIES.check(list(P.SHAPES)[1:])
    with pytest.raises(P.PolicyGap, match="governs nothing"):
        P.Policies({"all": "x", "none": "y"}, {}, RULED.artifacts).check()
    with pytest.raises(P.PolicyGap, match="no reason"):
        P.Policies({"all": "x"}, {}, {"one": {"rule": "all", "reason": " "}}).check()
    with pytest.raises(P.PolicyGap, match="unknown threshold"):
        P.Policies({"all": "x"}, {}, {"one": {"rule": "all", "reason": "r", "thresholds": ("t",)}}).check()


def test_refusals(spark):
    part = P.Support(False, "2021-12", "labels end")
    rows = spark.createDataFrame([("a",), ("b",)], "system_id string")
    assert P.Metric("m", False, {"a": P.Support(), "b": part}).admit(rows) is rows
    for metric in (P.Metric("m", True, {"a": P.Support(), "b": part}), P.Metric("m", False, {"a": P.Support()})):
        with pytest.raises(P.UnsupportedSystem):
            metric.admit(rows)
    cases = [(P.refuse_unmapped, "label string", [("x",)], []), (P.refuse_nameless, "departure_name string, return_name string", [("x", None)], [("x", "y")]), (P.refuse_missing_net, "net long", [(None,)], [(0,)]), (P.refuse_residual, "residual long", [(1,)], [(0,)])]
    for refuse, schema, bad, good in cases:
        refuse(spark.createDataFrame(good, schema))
        with pytest.raises(P.PublishingRefused):
            refuse(spark.createDataFrame(bad, schema))
    assert P.governed({"one": '[{"system_id":"z"}]', "two": "[]"}, {"one": P.Metric("one", True, {"a": P.Support()})}) == {"one": "systems ['z']", "two": "no metric is declared"}
    assert P.markdown(spark.createDataFrame([("a", 1234, None)], "s string, n long, x string")) == "| s | n | x |\n|---|---|---|\n| a | 1,234 |  |"

"""From files to artifacts and report in one call, what a finished run refuses, and its settings."""

from __future__ import annotations

import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ridewell.plans import publishing as P
from ridewell.plans import run as RN
from ridewell.plans import sample_run
from ridewell.plans import settings as ST
from ridewell.sources import landing as L
from ridewell.sources import sample

SF = "/root/testdata/sf0.001"


def seen(top: Path) -> dict[str, tuple[int, int]]:
    return {str(p): (p.stat().st_size, p.stat().st_mtime_ns) for p in top.rglob("*") if p.is_file()}


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """A whole run, with a workbook of one more period beside the text files."""
    top = tmp_path_factory.mktemp("run")
    x = sample_run.inputs(spark, SF, str(top / "in"))
    book = top / "in" / "Trips 2002.xlsx"
    # Serial dates whose day and month were swapped: the fifth of each month, written as the first to twelfth of May.
    late = [["Trip Id", "Start", "End", "Start code", "Start dock", "Pass", "Bike"], *[[f"x{i}", 37377 + m, 37377 + m + 0.01, str(i % 40), None, "1-URGENT", f"b{i}"] for i, m in enumerate([m for m in range(12) for _ in range(10)])]]
    book.write_bytes(sample.workbook({"All": late}))
    x = replace(x, files=[*x.files, L.SourceFile(str(book), "tor", "2002", "pin tor 2002")])
    s = ST.Settings(str(top / "out"))
    before = seen(top / "in")
    told = {(r["stage"], r["metric"]): r["value"] for r in RN.run(spark, s, x).collect()}
    return top, s, x, before, told


def test_a_run_closes_and_writes_below_its_root_only(spark, made):
    top, s, x, before, told = made
    assert seen(top / "in") == before and {p.name for p in top.iterdir()} == {"in", "out"}
    assert told["clean", "landed"] == told["extract", "rows_landed"] == told["clean", "kept"] + sum(told["clean", r] for r in ("no_time", "no_station", "duplicate"))
    assert all(told["clean", r] > 0 for r in ("no_time", "no_station", "duplicate")) and told["clean", "kept"] == told["model", "fact_trips"] and told["model", "without_station"] == 0
    # Two ways to name a dock are one station.
    stations = spark.read.parquet(f"{s.warehouse}/model/dim_station").groupBy("system_id").count().collect()
    assert {r[0]: r[1] for r in stations} == {"mtl": 40, "tor": 40, "van": 40}
    via = {r[0] for r in spark.read.parquet(f"{s.warehouse}/model/station_bridge").select("via").distinct().collect()}
    assert via == {"pk", "name"}


def test_dates_that_a_workbook_swapped_are_put_right(spark, made):
    _, s, *_ = made
    fact = spark.read.parquet(f"{s.warehouse}/model/fact_trips").filter("source_period = '2002' and system_id = 'tor'")
    assert {(r[0], r[1], r[2]) for r in fact.groupBy(F.month("departure_ts"), F.dayofmonth("departure_ts")).count().collect()} == {(m, 5, 10) for m in range(1, 13)}


def test_artifacts_and_report_of_a_run(made):
    _, s, _, _, told = made
    files = {p.stem: json.loads(p.read_text()) for p in Path(s.generated).glob("*.json")}
    # No bike rides twice here, no system says which are electric, and no dock has 100 events.
    assert set(files) == set(P.SHAPES) and {n for n, rows in files.items() if not rows} <= {"ebike_share", "dwell", "stations"}
    assert {r["system_id"] for r in files["forecast"]} == {"mtl", "tor", "van"} and sum(r["trips"] for r in files["meta"]) == told["model", "fact_trips"]
    text = (Path(s.generated) / "data-quality.md").read_text()
    assert text.count(RN.STAMP) == 1 and text.count("\n## ") == 12 and f"{told['clean', 'landed']:,}" in text and "| labels_mapped | 0 |" in text


def test_what_a_finished_run_refuses(spark, made):
    _, s, x, *_ = made
    report = Path(s.generated) / "data-quality.md"
    old = report.read_text()
    report.write_text(old.replace("## Systems", "## System"))
    artifact = Path(s.generated) / "meta.json"
    was = artifact.read_text()
    artifact.write_text(was.replace('"trips":', '"trips": '))
    fewer = replace(x, files=[f if f.period != "1997" else replace(f, sha256="new") for f in x.files])
    try:
        with pytest.raises(RN.RunRefused) as e:
            RN.check(spark, s, fewer)
    finally:
        report.write_text(old)
        artifact.write_text(was)
    assert all(part in str(e.value) for part in ("1997: the pin has moved", "artifact meta: drifted", "report: ## System"))
    with pytest.raises(RN.RunRefused, match="no stage"):
        RN.run(spark, s, x, until="fetch")


def test_reports_are_compared_without_their_stamp():
    a = f"# t\n\n{RN.STAMP}1.\n\nx\ny\n"
    assert RN.report_drift(a, a.replace("1.", "2.")) == [] and RN.report_drift(a, a.replace("x", "z")) == ["x", "z"] and RN.report_drift(a, a.replace("x\ny", "y\nx")) == ["the same lines in another order"]
    with pytest.raises(RN.RunRefused):
        RN.report_drift(a, "# t\n")


def test_settings_come_from_the_session(spark):
    conf = {"root": "/a/", "file_limit": "2", "generated": "/g"}
    for k, v in conf.items():
        spark.conf.set(f"{ST.PREFIX}{k}", v)
    try:
        assert ST.Settings.of(spark) == ST.Settings("/a/", "/a/warehouse", "/g", 2) and ST.Settings.of(spark, root="/b", generated="").generated == "/b/generated"
        spark.conf.set(f"{ST.PREFIX}file_limit", "two")
        with pytest.raises(ST.SettingsRefused, match="number"):
            ST.Settings.of(spark)
        spark.conf.set(f"{ST.PREFIX}labels", "x")
        with pytest.raises(ST.SettingsRefused, match="labels"):
            ST.Settings.of(spark)
    finally:
        for k in (*conf, "labels"):
            spark.conf.unset(f"{ST.PREFIX}{k}")
    with pytest.raises(ST.SettingsRefused, match="root"):
        ST.Settings.of(spark)
    with pytest.raises(ST.SettingsRefused, match="twice"):
        ST.dim_system(spark, sample_run.REGISTRY * 2)


def test_a_trial_run_takes_the_first_periods():
    files = [L.SourceFile(f"/{s}{p}", s, p, "") for s in "ab" for p in ("3", "1", "2")]
    assert [f.path for f in RN.limited(files, 2)] == ["/a1", "/a2", "/b1", "/b2"] and RN.limited(files, 0) == files

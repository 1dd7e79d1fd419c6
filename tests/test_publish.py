"""All artifacts from the sample's model, what blocks them, and digests."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ridewell.plans import catalog
from ridewell.plans import dictionary as D
from ridewell.plans import publish_job as J
from ridewell.plans import publishing as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    m = catalog.published(spark, SF)
    known = m.labels.unionByName(m.labels.select("system_id", F.lit("5-LOW").alias("membership_raw"), F.lit("casual").alias("membership_group")).distinct())
    return J.Model(m.fact, m.stations, known, m.fits, m.first_year, m.ebike_systems)


def checks(spark):
    return spark.createDataFrame([(0,)], "residual long"), spark.createDataFrame([(3, 3)], "source_records long, rows_landed long")


def test_all_artifacts_are_published(spark, model, tmp_path):
    """From the model to fifteen files with the declared names, columns and order."""
    size = J.publish(model, tmp_path / "out", *checks(spark))
    told = {p.stem: json.loads(p.read_text()) for p in (tmp_path / "out").glob("*.json")}
    assert set(told) == set(P.SHAPES) and 0 < size < P.BUDGET_BYTES
    for name, rows in told.items():
        columns, order = P.SHAPES[name]
        assert all(tuple(r) == columns for r in rows), name
        keys = [tuple(r[k] for k in order) for r in rows]
        assert keys == sorted(set(keys)), name
    assert {"meta", "trips_monthly", "forecast", "flows", "membership"} <= {n for n, rows in told.items() if rows}
    assert {r["name"] for r in told["forecast"]} >= {"intercept", "coefficient:is_weekend"} and len({r["system_id"] for r in told["forecast"]}) == 3
    held = [r for r in told["membership"] if r["month"] < "1997-01"]
    some = J.tables(J.Model(model.fact, model.stations, model.labels, model.fits, model.first_year, model.ebike_systems, F.col("month") < "1997-01"))["membership"].count()
    assert held and some == len(told["membership"]) - len(held)


def test_what_blocks_publishing(spark, model, tmp_path):
    funnel, audit = checks(spark)
    fewer = J.Model(model.fact, model.stations, catalog.published(spark, SF).labels, model.fits, model.first_year, model.ebike_systems)
    far = J.Model(model.fact, model.stations.withColumn("lat", F.lit(10.0)), model.labels, model.fits, model.first_year, model.ebike_systems)
    cases = [(fewer, funnel, audit, "labels_mapped"), (far, funnel, audit, "places_valid"), (model, funnel.withColumn("residual", F.lit(1)), audit, "funnel_explained"), (model, funnel, audit.withColumn("rows_landed", F.lit(2)), "landing_reconciled")]
    for m, f, a, name in cases:
        with pytest.raises(P.PublishingRefused, match=name):
            J.publish(m, tmp_path / "none", f, a)
    with pytest.raises(P.OverBudget):
        J.publish(model, tmp_path / "none", funnel, audit, budget=100)
    assert not (tmp_path / "none").exists()
    with pytest.raises(P.ShapeBroken, match="double"):
        P.shaped("exclusions", spark.createDataFrame([("a", 1, 1, 1.5)], "system_id string, unterminated long, matched_by_name long, trips double"))


def test_digests_need_no_order(spark):
    rows = spark.createDataFrame([(i, None if i % 5 else "x", float(i)) for i in range(50)] + [(1, "a", 1.0)] * 2, "n long, s string, d double")
    own = J.digest(rows).first()
    assert J.digest(rows.repartition(7).orderBy(F.desc("n")).select("d", "n", "s")).first() == own
    for other in (rows.withColumn("s", F.when(F.col("n") != 7, F.col("s")).otherwise("")), rows.filter("n <> 3"), rows.dropDuplicates(), rows.withColumn("n", F.when(F.col("n") == 4, 5).otherwise(F.col("n"))), rows.withColumnRenamed("n", "m").withColumn("n", F.lit(1)).drop("m")):
        assert J.digest(other).first() != own
    assert tuple(J.digest(rows.limit(0)).first()) == (0, "0", "0")


def test_the_dictionary_follows_schemas_and_policies(spark, model, tmp_path, monkeypatch):
    """Notes come through the plans as metadata; a column without one, or a note on nothing, is refused."""
    made = J.tables(model)
    text = D.dictionary(made)
    assert text == D.dictionary(dict(reversed(made.items()))) and text.count("\n## ") == 15 and "* min_events = 100: " in text and "| net | bigint | returns less departures |" in text
    assert all(f"| {c} | " in text for columns, _ in P.SHAPES.values() for c in columns)
    made["exclusions"].write.parquet(str(tmp_path / "x"))
    assert spark.read.parquet(str(tmp_path / "x")).filter("trips > 0").schema["trips"].metadata == {"comment": D.NOTES["trips"]}
    with pytest.raises(P.PolicyGap):
        D.dictionary({n: t for n, t in made.items() if n != "dwell"})
    with pytest.raises(D.Undocumented, match="no note"):
        D.dictionary(made | {"meta": spark.createDataFrame([], ", ".join(f"{c} {kind}" for c, kind in made["meta"].dtypes))})
    with pytest.raises(D.Undocumented, match="more"):
        D.noted(made["meta"].withColumn("more", F.lit(1)))
    monkeypatch.setitem(D.NOTES, "gone", "no artifact has it")
    with pytest.raises(D.Undocumented, match="gone"):
        D.dictionary(made)

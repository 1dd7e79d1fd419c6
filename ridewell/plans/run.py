"""From listed files to artifacts and report: land, clean, model, publish, check. Every table is written below one root."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import cleaning as C
from ..operators import scenario as S
from ..operators import trips as O
from ..sources import landing as L
from ..sources import versions, workbooks
from . import metrics as M
from . import publish_job as J
from . import publishing as P
from . import reconciliation as R
from .settings import Settings, System, dim_system

#: What makes two trips of a deduplicated system the same; neither file nor trip id is part of it.
SAME = ("departure_ts", "return_ts", "departure_station_key", "return_station_key", "departure_station_name", "return_station_name", "bike_id", "membership_raw", "duration_s", "distance_m")
STAMP = "Written at "


class RunRefused(Exception):
    """A finished run does not hold what it says."""


@dataclass(frozen=True)
class Inputs:
    """What a run reads: files as their manifests pin them, what their columns mean, and what stands beside the trips."""

    files: list[L.SourceFile]
    maps: dict[str, L.EraMap]
    registry: tuple[System, ...]
    #: system_id, membership_raw, membership_group.
    labels: DataFrame
    as_of: str
    first_trusted: int
    #: First year of the seasons, and first day of the weather model.
    first_year: int
    first_model_day: str
    #: Station feed and weather files by system.
    feeds: dict[str, str] = field(default_factory=dict)
    weather: dict[str, list[str]] = field(default_factory=dict)
    #: Date order by (system, file), for files that prove none.
    declared: dict[tuple[str, str], str] = field(default_factory=dict)
    excluded: tuple[tuple[str, str], ...] = ()
    unreliable: Column | None = None
    #: Rows that prove a file's clock, or that its serial dates were swapped.
    clock_rows: int = 5000
    serial_rows: int = 100

    def manifest(self, spark: SparkSession) -> DataFrame:
        """system_id, period and sha256 of every listed period that is not excluded."""
        pins = sorted({(f.system_id, f.period, f.sha256) for f in self.files if (f.system_id, f.period) not in self.excluded})
        return spark.createDataFrame(pins, "system_id string, period string, sha256 string")


def _whole_path(spark: SparkSession, f: L.SourceFile) -> L.SourceFile:
    at = spark._jvm.org.apache.hadoop.fs.Path(f.path)
    return replace(f, path=at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString())


def limited(files: list[L.SourceFile], most: int) -> list[L.SourceFile]:
    """Files of the first `most` periods of each system; all if most is 0."""
    if not most:
        return files
    periods: dict[str, set[str]] = {}
    for f in files:
        periods.setdefault(f.system_id, set()).add(f.period)
    first = {s: set(sorted(p)[:most]) for s, p in periods.items()}
    return [f for f in files if f.period in first[f.system_id]]


def extract(spark: SparkSession, s: Settings, x: Inputs) -> None:
    """Land the files, text and workbooks alike, as one version of their systems; refused where a row is lost."""
    files = limited([f for f in x.files if (f.system_id, f.period) not in x.excluded], s.file_limit)
    books = [_whole_path(spark, f) for f in files if f.name.lower().endswith(".xlsx")]
    plain = [f for f in files if not f.name.lower().endswith(".xlsx")]
    parts = [L.land(spark, plain, x.maps)]
    if books:
        read = spark.read.format("binaryFile").load([L._glob_free(f.path) for f in books]).select("path", "content")
        parts.append(workbooks.land(spark, read, books, x.maps))
    union = lambda dfs: reduce(DataFrame.unionByName, dfs)
    L.reload(L.Landed({k: union([p.tables[k] for p in parts]) for k in L.KINDS}, union([p.audit for p in parts])), s.warehouse)
    told = audit(spark, s).agg(F.count("*").alias("files"), F.coalesce(F.sum(F.when(F.col("kind") == "trips", F.col("rows_landed"))), F.lit(0)).alias("rows_landed")).first()
    R.record(spark, s.warehouse, "extract", told.asDict())


def audit(spark: SparkSession, s: Settings) -> DataFrame:
    return versions.read(spark, s.warehouse, "raw_file_audit")


def _stations(spark: SparkSession, s: Settings) -> DataFrame:
    """Landed station snapshots; none where no file holds any."""
    if audit(spark, s).filter("kind = 'stations' and rows_landed > 0").isEmpty():
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in (*L.PROVENANCE, *L.STATION_COLUMNS)))
    return versions.read(spark, s.warehouse, "raw_stations")


def _localised(rows: DataFrame, x: Inputs) -> DataFrame:
    """Times of files that were proven to be UTC, in the zone of their system. Counts by hour decide; a row for each file."""
    spark = rows.sparkSession
    # A row for each system.
    offsets = spark.createDataFrame([(m.system_id, m.utc_offset) for m in x.registry], "system_id string, utc_offset long")
    zones = spark.createDataFrame([(m.system_id, m.zone) for m in x.registry], "system_id string, _zone string")
    basis = O.zone_basis(rows.select("system_id", "source_file", F.col("departure_ts").alias("ts")), offsets, x.clock_rows).select("system_id", "source_file", "tz_basis")
    out = rows.join(basis, ["system_id", "source_file"], "left").join(F.broadcast(zones), "system_id", "left")
    return out.withColumns({c: X.as_local(F.col(c), F.col("_zone"), F.col("tz_basis")) for c in ("departure_ts", "return_ts")}).drop("_zone", "tz_basis")


def cleaned(raw: DataFrame, x: Inputs) -> DataFrame:
    """Typed trips, each with the `reason` for which it is dropped (null: kept).

    Dates are read in the order that their file proves or declares; serial dates of files in which day
    and month were swapped are swapped back. Only trips of deduplicated systems that would be kept
    otherwise are compared, so no other row is shuffled, and rows without a time make no group.
    """
    spark = raw.sparkSession
    found = {(r["system_id"], r["source_file"]): r["date_order"] for r in O.date_order(raw).collect()}  # a row for each file
    orders = spark.createDataFrame([(*k, v) for k, v in sorted(O.resolve_orders(found, x.declared).items())], "system_id string, source_file string, date_order string")
    zones = spark.createDataFrame([(m.system_id, m.zone) for m in x.registry], "system_id string, zone string")
    serial = lambda end: X.excel_ts(F.col(f"{end}_raw")).isNotNull().alias(f"_{end}_serial")
    swapped = C.serial_signature(raw, x.serial_rows).select("system_id", "source_file", F.lit(True).alias("_swapped"))
    rows = C.typed(raw, orders, zones, serial("departure"), serial("return")).join(swapped, ["system_id", "source_file"], "left")
    wrong = lambda end: F.coalesce("_swapped", F.lit(False)) & F.col(f"_{end}_serial")
    rows = rows.withColumns({f"{end}_ts": O.repair_transposed(F.col(f"{end}_ts"), wrong(end)) for end in ("departure", "return")}).drop("_swapped", "_departure_serial", "_return_serial")
    rows = _localised(rows, x)
    meant = C.usable_key(rows.select(F.struct("*").alias("_row"), "system_id", "source_period", "source_file", "trip_id", *SAME))
    ready = O.drop_reason(F.lit(False), F.lit(False)).isNull() & F.col("system_id").isin(*[m.system_id for m in x.registry if m.deduped])
    order = Window.partitionBy("system_id", *SAME).orderBy("source_period", "source_file", "trip_id")
    both = meant.filter(ready).withColumn("_at", F.row_number().over(order)).unionByName(meant.filter(~ready).withColumn("_at", F.lit(1)))
    return both.select("_row.*", O.drop_reason(F.col("_at") > 1, F.lit(True)).alias("reason"))


def clean(spark: SparkSession, s: Settings, x: Inputs) -> None:
    """Write the kept trips and, from the same pass, what became of every landed row."""
    rows = cleaned(versions.read(spark, s.warehouse, "raw_trips"), x)
    R.record(spark, s.warehouse, "clean", R.write_counted(rows, f"{s.warehouse}/trips", R.funnel_counts(), F.col("reason").isNull(), "system_id"))


def _bridges(trips: DataFrame, listed: DataFrame, docks: DataFrame, x: Inputs) -> DataFrame:
    """era_id, canonical_id and via for every bridged system with a station feed."""
    parts = [trips.sparkSession.createDataFrame([], "era_id string, canonical_id string, via string")]
    for m in x.registry:
        if m.bridged and m.system_id in x.feeds:
            own = lambda df: df.filter(F.col("system_id") == m.system_id)  # noqa: E731, B023
            nameless = own(trips).filter(F.col("departure_station_id").like("%:name:%"))
            observed = nameless.groupBy(F.col("departure_station_id").alias("era_id"), X.bridge_name(F.col("departure_station_name")).alias("nm")).agg(F.median("departure_lat").alias("lat"), F.median("departure_lon").alias("lon"))
            orphans = own(listed).select(F.col("station_id").alias("era_id"), F.col("station_name").alias("label"), "lat", "lon")
            parts.append(O.bridge(own(docks), observed, orphans, m.system_id))
    return reduce(DataFrame.unionByName, parts)


def model(spark: SparkSession, s: Settings, x: Inputs) -> None:
    """Write fact and dimensions below warehouse/model, each from what is written before it."""
    at = f"{s.warehouse}/model"

    def written(name: str, rows: DataFrame, *by: str) -> DataFrame:
        rows.write.mode("overwrite").partitionBy(*by).parquet(f"{at}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{at}/{name}")

    electric = {m.system_id: m.electric for m in x.registry if m.electric}
    known = C.identified(spark.read.parquet(f"{s.warehouse}/trips"), tuple(m.system_id for m in x.registry if m.prefixed), electric)
    trips = O.conform(known.drop("reason"), x.as_of, x.first_trusted)
    listed = O.snapshots(C.clean_stations(_stations(spark, s)))
    docks = L.station_feed(spark, x.feeds) if x.feeds else spark.createDataFrame([], "system_id string, station_id string, short_name string, name string, lat double, lon double")
    bridged = written("station_bridge", _bridges(trips, listed, docks, x))
    used = written("station_usage", O.usage(trips))
    identity = written("station_identity", O.station_identity(used, bridged))
    told = R.write_counted(O.fact_trips(trips, identity), f"{at}/fact_trips", {"fact_trips": F.count("*"), "without_station": F.count_if(F.col("departure_station_id").isNull())}, None, "system_id")
    stations = written("dim_station", O.dim_station(used, identity, listed, docks))
    told |= stations.agg(F.count("*").alias("dim_station"), F.count("lat").alias("dim_station_with_coords")).first().asDict()
    # Labels and days are those of the written fact, so texts are not read for stations once more.
    fact = spark.read.schema(trips.schema).parquet(f"{at}/fact_trips")
    told["dim_membership"] = written("dim_membership", O.dim_membership(fact, x.labels)).count()
    written("dim_date", O.dim_date(M.trusted(fact)))
    told["dim_system"] = written("dim_system", dim_system(spark, x.registry)).count()
    told["station_bridge"] = bridged.count()
    R.record(spark, s.warehouse, "model", told)


def published_from(spark: SparkSession, s: Settings, x: Inputs) -> J.Model:
    """The written model, and the weather model fitted on it."""
    fact, stations = (spark.read.parquet(f"{s.warehouse}/model/{n}") for n in ("fact_trips", "dim_station"))
    parts = [L.weather_daily(spark, system, paths).select("system_id", F.col("date_key").alias("day"), *S.WEATHER) for system, paths in sorted(x.weather.items())]
    none = spark.createDataFrame([], "system_id string, day date, " + ", ".join(f"{w} double" for w in S.WEATHER))
    daily = M.trusted(fact).groupBy("system_id", F.col("date_key").alias("day")).agg(F.count("*").alias("trips"))
    days = S.daily_rows(daily, reduce(DataFrame.unionByName, parts, none), M.incomplete_months(fact), x.first_model_day)
    return J.Model(fact, stations, x.labels, S.fit(days), x.first_year, tuple(m.system_id for m in x.registry if m.electric), x.unreliable)


def _funnel(spark: SparkSession, s: Settings) -> DataFrame:
    """The recorded funnel: one row."""
    told = R.metrics(spark, s.warehouse).filter("stage = 'clean'").groupBy().pivot("metric", ["landed", "kept", "no_time", "no_station", "duplicate"]).agg(F.first("value"))
    return told.withColumn("residual", F.expr("landed - kept - no_time - no_station - duplicate"))


def publish(spark: SparkSession, s: Settings, x: Inputs) -> None:
    J.publish(published_from(spark, s, x), s.generated, _funnel(spark, s), audit(spark, s), s.budget_bytes)


def report(spark: SparkSession, s: Settings, x: Inputs, now: datetime | None = None) -> str:
    """The quality report of a written model as Markdown. But for its stamp it depends on the tables alone: every part is sorted."""
    told, fact, stations = audit(spark, s), *(spark.read.parquet(f"{s.warehouse}/model/{n}") for n in ("fact_trips", "dim_station"))
    by_system = F.col("system_id")
    match = fact.groupBy("system_id").agg(F.count_if(F.col("departure_station_match") == "id").alias("by_id"), F.count_if(F.col("departure_station_match") == "name").alias("by_name"))
    usage = fact.filter("membership_raw is not null").groupBy("system_id", "membership_raw").agg(F.count("*").alias("trips")).join(x.labels, ["system_id", "membership_raw"], "left")
    checks = P.invariants(fact, _funnel(spark, s), told, M.net_flow(fact), M.unmapped(fact, x.labels), stations)
    parts: dict[str, DataFrame] = {
        "What became of the landed rows": _funnel(spark, s),
        "Landed files": L.landing_summary(told).orderBy("kind"),
        "Repaired lines": L.repair_summary(told).orderBy(by_system),
        "What blocks publishing": checks.orderBy("invariant"),
        "Systems": M.meta(fact, stations).orderBy(by_system),
        "Quality flags": M.flag_counts(fact).orderBy(by_system, "flag"),
        "How departures were matched": match.orderBy(by_system),
        "Station bridge": spark.read.parquet(f"{s.warehouse}/model/station_bridge").groupBy("via").agg(F.count("*").alias("entries")).orderBy("via"),
        "Stations": M.stations_meta(stations).orderBy(by_system),
        "Labels": usage.select("system_id", "membership_raw", "membership_group", "trips").orderBy(by_system, "membership_raw"),
        "Incomplete months": M.incomplete_months(fact).orderBy(by_system, "trip_month"),
        "Trips by year": fact.groupBy("system_id", F.col("trip_year").alias("year")).agg(F.count("*").alias("trips")).orderBy(by_system, "year"),
    }
    stamp = f"{STAMP}{(now or datetime.now()).isoformat(timespec='seconds')}."
    return "\n".join(["# Data quality", "", stamp, *[f"\n## {title}\n\n{P.markdown(rows)}" for title, rows in parts.items()]]) + "\n"


def report_drift(committed: str, regenerated: str) -> list[str]:
    """Lines of either report that the other lacks, but for the line with the stamp; a report without exactly one stamp is refused."""
    texts = []
    for text in (committed, regenerated):
        lines = text.splitlines()
        if len([line for line in lines if line.startswith(STAMP)]) != 1:
            raise RunRefused("a report bears one stamp")
        texts.append([line for line in lines if not line.startswith(STAMP)])
    if texts[0] == texts[1]:
        return []
    return sorted(set(texts[0]) ^ set(texts[1])) or ["the same lines in another order"]


def check(spark: SparkSession, s: Settings, x: Inputs) -> None:
    """Refuse a run whose parts tell different stories: funnel, audit and manifest, systems, artifacts, report."""
    wrong = [f"{r['system_id']} {r['period']}: {r['problem']}" for r in R.disagreements(audit(spark, s), x.manifest(spark), R.metrics(spark, s.warehouse), x.excluded).limit(10).collect()] if not s.file_limit else []
    told = {(r["stage"], r["metric"]): r["value"] for r in R.metrics(spark, s.warehouse).collect()}
    if told["clean", "landed"] != told["extract", "rows_landed"]:
        wrong.append(f"{told['extract', 'rows_landed']} rows landed, {told['clean', 'landed']} were cleaned")
    if told["clean", "kept"] != told["model", "fact_trips"]:
        wrong.append(f"{told['clean', 'kept']} trips kept, {told['model', 'fact_trips']} in the fact")
    listed, held = {f.system_id for f in x.files}, {r[0] for r in spark.read.parquet(f"{s.warehouse}/model/fact_trips").select("system_id").distinct().collect()}
    wrong += [f"systems listed {sorted(listed)}, in the fact {sorted(held)}"] if listed != held else []
    again = J.collected(published_from(spark, s, x))
    wrong += [f"artifact {n}: {how}" for n, how in again.drift(s.generated).items()]
    path = Path(s.generated) / "data-quality.md"
    wrong += [f"report: {line}" for line in report_drift(path.read_text(encoding="utf-8"), report(spark, s, x))[:10]]
    if wrong:
        raise RunRefused("; ".join(wrong))


def write_report(spark: SparkSession, s: Settings, x: Inputs) -> None:
    part = Path(s.generated) / "data-quality.md.part"
    part.write_text(report(spark, s, x), encoding="utf-8")
    part.replace(part.with_suffix(""))


STAGES: dict[str, Callable[[SparkSession, Settings, Inputs], None]] = {"extract": extract, "clean": clean, "model": model, "publish": publish, "report": write_report, "check": check}


def run(spark: SparkSession, s: Settings, x: Inputs, until: str = "check") -> DataFrame:
    """All stages in turn up to `until`; gives what they recorded: stage, metric, value. A refusal ends the run where it is.

    Landed tables change as one version; the tables after them are rewritten from these, so a run that
    broke off is simply run again.
    """
    if until not in STAGES:
        raise RunRefused(f"no stage {until}; there are {list(STAGES)}")
    if re.search(r"[{}*?\[\]]", s.root):
        raise RunRefused(f"{s.root}: a root names one folder")
    for name, stage in STAGES.items():
        stage(spark, s, x)
        if name == until:
            break
    return R.metrics(spark, s.warehouse)

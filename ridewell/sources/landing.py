"""Published trip files to landed rows: era maps, encoding repair, provenance, audit. All columns stay text."""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import versions

#: Landed columns in the order of the published record.
TRIP_COLUMNS = (
    "trip_id", "departure_raw", "return_raw", "departure_ms", "return_ms", "departure_station_key", "return_station_key", "departure_station_name", "return_station_name",
    "departure_lat", "departure_lon", "return_lat", "return_lon", "departure_borough", "return_borough", "duration_s", "distance_m", "membership_raw", "bike_id", "bike_model",
    "electric_bike", "departure_temp", "return_temp", "stopover_s", "stopover_count",
)
STATION_COLUMNS = ("station_key", "station_name", "lat", "lon")
PROVENANCE = ("system_id", "source_period", "source_file")
KINDS = {"trips": TRIP_COLUMNS, "stations": STATION_COLUMNS}
#: Bytes that windows-1252 leaves undefined.
UNDEFINED_1252 = "[\u0081\u008d\u008f\u0090\u009d]"
#: Where windows-1252 differs from ISO-8859-1, and what it means there.
CONTROLS = "".join(chr(c) for c in range(0x80, 0xA0) if chr(c) not in UNDEFINED_1252)
PRINTED = CONTROLS.encode("latin-1").decode("cp1252")


class LandingRefused(Exception):
    """A file cannot be landed without losing or guessing something."""


class UnknownColumns(LandingRefused):
    """A header that no era map knows, or two headers for one column."""


class UnpinnedSource(LandingRefused):
    """A listed period has no checksum."""


class RowsUnaccounted(LandingRefused):
    """A file holds more or fewer records than landed."""


@dataclass(frozen=True)
class SourceFile:
    """One published file and where it comes from."""

    path: str
    system_id: str
    period: str
    sha256: str

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


@dataclass(frozen=True)
class EraMap:
    """Published header to landed column, for the trip and the station files of one system; an empty target is dropped on purpose."""

    trips: dict[str, str] = field(default_factory=dict)
    stations: dict[str, str] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | Path) -> EraMap:
        """From a JSON file; keys that start with an underscore are remarks."""
        told = json.loads(Path(path).read_text(encoding="utf-8"))
        part = lambda k: {h: c for h, c in told.get(k, {}).items() if not h.startswith("_")}
        return cls(part("trips"), part("stations"))

    def kind(self, header: list[str]) -> str | None:
        """What a file holds, told by its header: stations if every column is one of theirs, trips if any is."""
        names = [h.strip() for h in header]
        if names and self.stations and all(h in self.stations for h in names):
            return "stations"
        return "trips" if any(h in self.trips for h in names) else None

    def targets(self, header: list[str], where: str) -> tuple[str, list[str]]:
        """Kind and landed column of each header in turn, refusing what the map leaves open."""
        kind = self.kind(header)
        if kind is None:
            raise UnknownColumns(f"{where}: neither a trip nor a station file: {header}")
        known = getattr(self, kind)
        if unknown := [h for h in header if h.strip() not in known]:
            raise UnknownColumns(f"{where}: unmapped headers {unknown}")
        out = [known[h.strip()] for h in header]
        used = [c for c in out if c]
        if len(used) != len(set(used)):
            raise UnknownColumns(f"{where}: two headers for one column: {used}")
        return kind, out


def pinned(manifests: dict[str, dict], excluded: Iterable[tuple[str, str]] = (), limit: int | None = None) -> list[tuple[str, str, dict]]:
    """(system, period, entry) of every listed period in order, at most `limit` for each system.

    Excluded periods are passed over; any other without a checksum is refused, never skipped.
    """
    out, passed = [], set(excluded)
    for system in sorted(manifests):
        mine = []
        for period, entry in sorted(manifests[system].get("sources", {}).items()):
            if (system, period) in passed:
                continue
            if not entry.get("sha256"):
                raise UnpinnedSource(f"{system} {period}: no sha256 in the manifest")
            mine.append((system, period, entry))
        out += mine[:limit]
    return out


def _utf8(name: str) -> str:
    """A header cell read byte for byte, as the text that its bytes mean."""
    raw = name.encode("latin-1")
    for encoding in ("utf-8-sig", "cp1252"):
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    return name


def _glob_free(path: str) -> str:
    """A path that names one file, whatever signs are in it."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines that are not blank, read byte for byte where they lie: path, block, place in the block and the line's number of quotes."""
    reader = spark.read.schema("line string").option("header", False).option("encoding", "ISO-8859-1").option("sep", "\u0001").option("quote", "")
    rows = reader.csv([_glob_free(p) for p in paths]).filter(F.trim("line") != "")
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), "line", F.regexp_count("line", F.lit('"')).alias("quotes"))


@dataclass(frozen=True)
class Surveyed:
    """A listed file as it lies there: the path that Spark tells its rows by, its header, records by lines, and whether a field spans lines."""

    file: SourceFile
    path: str | None
    header: tuple[str, ...]
    records: int
    spans: bool


def survey(spark: SparkSession, files: list[SourceFile]) -> list[Surveyed]:
    """Headers and record counts of all files in one scan; a row for each file comes to the driver.

    A file is told by its whole path, decoded, so names with any sign, and paths that end alike, are
    theirs. A file without a line has no header. A file listed twice is refused.
    """
    if not files:
        return []
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    own: dict[str, SourceFile] = {}
    for f in files:
        at = hadoop(f.path)
        name = _one_slash(at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString())
        if name in own:
            raise LandingRefused(f"{f.path} is listed twice")
        own[name] = f
    lines = _lines(spark, [f.path for f in files])
    told = lines.groupBy("path").agg(F.min_by("line", F.struct("block", "place")).alias("header"), (F.count("*") - 1).alias("records"), F.max(F.col("quotes") % 2 == 1).alias("spans")).collect()
    seen = {_one_slash(unquote(r["path"])): r for r in told}
    if lost := sorted(set(seen) - set(own)):
        raise LandingRefused(f"read but not listed: {lost[:5]}")
    out = []
    for name, f in own.items():
        r = seen.get(name)
        out.append(Surveyed(f, r["path"], _cells(r["header"]), r["records"], r["spans"]) if r else Surveyed(f, None, (), 0, False))
    return out


def _one_slash(path: str) -> str:
    return re.sub(r"^file:/+", "file:/", path)


def _cells(line: str) -> tuple[str, ...]:
    """Column names of a header line that was read byte for byte; empty ones at its end are none."""
    names = [_utf8(c) for c in next(csv.reader([line.removeprefix("\u00ef\u00bb\u00bf")]), [])]
    while names and not names[-1].strip():
        names.pop()
    return tuple(names)


def header_census(spark: SparkSession, files: list[SourceFile]) -> dict[tuple[str, ...], list[SourceFile]]:
    """Files by their layout: how many eras an archive has, and which files are in each."""
    out: dict[tuple[str, ...], list[SourceFile]] = {}
    for s in survey(spark, files):
        out.setdefault(s.header, []).append(s.file)
    return out


def spanning_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path and records (without the header) of files whose quoted fields may span lines, told by quotes alone.

    A record ends with a line after which the number of quotes so far is even. Every block counts the
    lines that would end a record if it began inside a quoted field, and if it did not; which of the
    two holds follows from the quotes of the blocks before it.
    """
    lines = _lines(spark, paths)
    far = Window.partitionBy("path", "block").orderBy("place")
    told = lines.select("path", "block", (F.sum("quotes").over(far) % 2).alias("odd"), (F.col("quotes") % 2).alias("own"))
    blocks = told.groupBy("path", "block").agg(F.count_if(F.col("odd") == 0).alias("outside"), F.count_if(F.col("odd") == 1).alias("inside"), F.sum("own").alias("turns"))
    before = F.coalesce(F.sum("turns").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    ends = F.when(before == 0, F.col("outside")).otherwise(F.col("inside"))
    return blocks.select("path", ends.alias("ends")).groupBy("path").agg((F.sum("ends") - 1).alias("records"))


def repaired(cells: list[str]) -> tuple[list[Column], Column]:
    """Cells that were read byte for byte, as text, and whether their line had to be repaired.

    A line is UTF-8, or else all of it is windows-1252, or ISO-8859-1 where that leaves a byte
    undefined. Nothing is dropped for its encoding.
    """
    raw = {c: F.encode(F.col(f"`{c}`"), "ISO-8859-1") for c in cells}
    told = [F.col(f"`{c}`") for c in cells]
    bad = reduce(lambda a, b: a | b, [F.coalesce(~F.is_valid_utf8(raw[c].cast("string")), F.lit(False)) for c in cells])
    odd = reduce(lambda a, b: a | b, [F.coalesce(c.rlike(UNDEFINED_1252), F.lit(False)) for c in told])
    text = [F.when(~bad, raw[c].cast("string")).when(odd, t).otherwise(F.translate(t, CONTROLS, PRINTED)) for c, t in zip(cells, told, strict=True)]
    return text, bad


def read_layout(spark: SparkSession, paths: list[str], width: int, multi_line: bool) -> DataFrame:
    """Rows of files that share a header of so many columns: c0.., `too_long` for a row with more cells, and the file's path."""
    schema = ", ".join(f"c{i} string" for i in range(width)) + ", too_long string"
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("encoding", "ISO-8859-1").option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"')
    return reader.option("multiLine", multi_line).csv([_glob_free(p) for p in paths]).select("*", F.col("_metadata.file_path").alias("path"))


@dataclass(frozen=True)
class Landed:
    """What a landing made: tables by kind, and what to check about each file."""

    tables: dict[str, DataFrame]
    audit: DataFrame


AUDIT = "system_id string, source_period string, source_file string, source_sha256 string, rows_landed long, lines_repaired long, rows_too_long long, source_records long, kind string"


def land(spark: SparkSession, files: list[SourceFile], maps: dict[str, EraMap]) -> Landed:
    """Landed trips and stations of the files, and their audit. Header by header, so each era is one scan.

    The audit has a row for each listed file, whether or not anything of it landed: records by an
    independent count, rows landed, lines repaired, rows too long for their header, kind (`empty`:
    not even a header) and the checksum that pins the file. Rows find their file by its path alone.
    Files with a quoted line break are read record by record, and counted by their quotes.
    """
    surveyed = survey(spark, files)
    eras: dict[tuple, list[Surveyed]] = {}
    for s in surveyed:
        if s.path is not None:
            eras.setdefault((s.file.system_id, s.header, s.spans), []).append(s)
    tables: dict[str, list[DataFrame]] = {k: [] for k in KINDS}
    seen, kinds = [], {}
    names = spark.createDataFrame([(s.path, s.file.system_id, s.file.period, s.file.name) for s in surveyed if s.path], "path string, system_id string, source_period string, source_file string")
    for (system, header, spans), own in sorted(eras.items()):
        kind, targets = maps[system].targets(list(header), f"{system} {own[0].file.name}")
        kinds |= {s.path: kind for s in own}
        rows = read_layout(spark, [s.file.path for s in own], len(header), spans)
        text, bad = repaired([f"c{i}" for i in range(len(header))])
        rows = rows.select(*[t.alias(c) for t, c in zip(text, targets, strict=True) if c], bad.alias("_bad"), F.col("too_long").isNotNull().alias("_long"), "path")
        seen.append(rows.groupBy("path").agg(F.count("*").alias("rows_landed"), F.count_if("_bad").alias("lines_repaired"), F.count_if("_long").alias("rows_too_long")))
        columns = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in KINDS[kind]]
        tables[kind].append(rows.join(names, "path").select(*PROVENANCE, *columns))
    empty = lambda kind: spark.createDataFrame([], ", ".join(f"{c} string" for c in (*PROVENANCE, *KINDS[kind])))
    made = {k: reduce(DataFrame.unionByName, parts) if parts else empty(k) for k, parts in tables.items()}
    listed = spark.createDataFrame([(s.path, s.file.system_id, s.file.period, s.file.name, s.file.sha256, s.records, kinds.get(s.path, "empty")) for s in surveyed], "path string, system_id string, source_period string, source_file string, source_sha256 string, by_lines long, kind string")
    landed = reduce(DataFrame.unionByName, seen) if seen else spark.createDataFrame([], "path string, rows_landed long, lines_repaired long, rows_too_long long")
    spanning = [s.file.path for s in surveyed if s.spans]
    told = spanning_records(spark, spanning) if spanning else spark.createDataFrame([], "path string, records long")
    audit = listed.join(landed, "path", "left").join(told, "path", "left").fillna(0, ["rows_landed", "lines_repaired", "rows_too_long"]).withColumn("source_records", F.coalesce("records", "by_lines"))
    return Landed(made, audit.select([c.split()[0] for c in AUDIT.split(", ")]))


def unaccounted(audit: DataFrame) -> DataFrame:
    """Files whose landed rows differ from their records, that hold rows their header has no columns for, or nothing at all."""
    return audit.filter("source_records <> rows_landed or rows_too_long > 0 or kind = 'empty'").withColumn("missing", F.col("source_records") - F.col("rows_landed"))


def reconcile(audit: DataFrame) -> None:
    """Refuse a landing that loses rows: what is lost here no later count can see."""
    # A few files at most are shown.
    if wrong := unaccounted(audit).orderBy(*PROVENANCE).limit(20).collect():
        raise RowsUnaccounted("; ".join(f"{r.system_id} {r.source_period} {r.source_file}: {r.source_records} records, {r.rows_landed} landed, {r.rows_too_long} too long" for r in wrong))


def reload(landed: Landed, warehouse: str, after: Callable[[Landed], None] | None = None) -> str:
    """Replace the landed systems in the warehouse and no others, all their tables at once, once every check has passed.

    Checks come first, so a refused landing leaves all that was there; the tables then become a new
    version of their systems (see versions). Gives the version's name.
    """
    audit = landed.audit.persist()
    try:
        reconcile(audit)
        if after is not None:
            after(landed)
        return versions.commit(warehouse, {**{f"raw_{k}": t for k, t in landed.tables.items()}, "raw_file_audit": audit})
    finally:
        audit.unpersist()


def landing_summary(audit: DataFrame) -> DataFrame:
    """Per kind: files, records, rows, files that disagree and files without a checksum."""
    return audit.groupBy("kind").agg(
        F.count("*").alias("files"), F.sum("source_records").alias("records"), F.sum("rows_landed").alias("rows_landed"),
        F.count_if(F.col("source_records") != F.col("rows_landed")).alias("disagree"), F.count_if(F.coalesce("source_sha256", F.lit("")) == "").alias("unpinned"),
    )


def repair_summary(audit: DataFrame) -> DataFrame:
    """Per system: files, files with repaired lines, repaired lines."""
    return audit.groupBy("system_id").agg(F.count("*").alias("files"), F.count_if(F.col("lines_repaired") > 0).alias("files_repaired"), F.sum("lines_repaired").alias("lines_repaired"))


def station_feed(spark: SparkSession, feeds: dict[str, str]) -> DataFrame:
    """Live docks of each system's station feed (a JSON document with data.stations): ids as text, whatever their type."""
    item = "struct<station_id:string,short_name:string,name:string,lat:double,lon:double,capacity:bigint>"
    parts = [
        spark.read.schema(f"data struct<stations:array<{item}>>").option("multiLine", True).json(path).select(F.lit(system).alias("system_id"), F.explode("data.stations").alias("s")).select("system_id", "s.*")
        for system, path in sorted(feeds.items())
    ]
    return reduce(DataFrame.unionByName, parts)


#: Published weather headers and the columns that they become.
WEATHER = {"Mean Temp (°C)": "temp_mean_c", "Max Temp (°C)": "temp_max_c", "Min Temp (°C)": "temp_min_c", "Total Precip (mm)": "precip_mm", "Total Snow (cm)": "snow_cm", "Snow on Grnd (cm)": "snow_ground_cm"}


def weather_daily(spark: SparkSession, system_id: str, paths: list[str], climate_id: str | None = None) -> DataFrame:
    """Observed days of one system's weather files: a day with none of the measures is no observation.

    Columns are taken by their exact names; files of another climate station than `climate_id` are refused.
    """
    rows = spark.read.option("header", True).csv(paths)
    if lacking := [h for h in ("Date/Time", "Climate ID", *WEATHER) if h not in rows.columns]:
        raise UnknownColumns(f"{system_id}: weather files without {lacking}")
    if climate_id is not None:
        others = [r[0] for r in rows.select("Climate ID").distinct().filter(~F.col("Climate ID").eqNullSafe(F.lit(climate_id))).limit(5).collect()]
        if others:
            raise LandingRefused(f"{system_id}: weather of station {others} in place of {climate_id}")
    seen = rows.filter(F.coalesce(*[F.col(f"`{h}`") for h in WEATHER]).isNotNull())
    return seen.select(F.lit(system_id).alias("system_id"), F.col("`Date/Time`").cast("date").alias("date_key"), *[F.col(f"`{h}`").try_cast("double").alias(c) for h, c in WEATHER.items()])


def weather_coverage(spans: DataFrame, weather: DataFrame) -> DataFrame:
    """Per system: days of its window, days with weather, and days with a mean temperature. spans: system_id, a, b."""
    days = spans.select("system_id", F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date_key"))
    seen = weather.select("system_id", "date_key", F.lit(True).alias("_seen"), "temp_mean_c")
    return days.join(seen, ["system_id", "date_key"], "left").groupBy("system_id").agg(F.count("*").alias("days"), F.count("_seen").alias("with_weather"), F.count("temp_mean_c").alias("with_temperature"))


def dimension_csv(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """A small mapping file as text columns, refused where its header is another."""
    rows = spark.read.option("header", True).csv(path)
    if tuple(rows.columns) != columns:
        raise UnknownColumns(f"{path}: {rows.columns} in place of {list(columns)}")
    return rows

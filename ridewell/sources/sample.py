"""Trip-shaped views of the star-schema test tables, so that every operator has rows to run on."""

from __future__ import annotations

import hashlib
import io
import zipfile
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import trips as O
from . import archive, landing, scratch, workbooks

#: First trusted year and the day that stands for today, both inside the data so that either bound marks rows.
FIRST_TRUSTED, AS_OF = 1996, "2001-06-30"
#: Labels of trips_o and their groups; 5-LOW is left unmapped.
GROUPS = (("1-URGENT", "member"), ("2-HIGH", "member"), ("3-MEDIUM", "casual"), ("4-NOT SPECIFIED", "operational"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip for each order line: day-grained times, a return missing for a sixth, some stations known by name only."""
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    order = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_type")
    # 25 nations at any scale.
    who = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey).select("c_custkey", "n_regionkey")
    # Orders meet customers by themselves, and lines carry keys, a time and two flags: they are shuffled twice, before they grow wide.
    placed = order.join(who, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderdate", "o_orderpriority", "n_regionkey")
    kinds = part.select("p_partkey", F.when(F.col("p_type") == "ECONOMY", True).when(F.col("p_type") != "PROMO", False).alias("is_ebike"))
    ended = F.when(~((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")), F.col("l_shipdate")).alias("return_ts")
    line = line.select("l_orderkey", "l_partkey", "l_suppkey", (F.col("l_linenumber") != 7).alias("labelled"), ended)
    line = line.join(kinds, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    rows = line.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    system = F.concat(F.lit("sys-"), F.col("n_regionkey").cast("string"))
    named = F.col("l_suppkey") % 10 == 0
    supplier, dock = F.col("l_suppkey").cast("string"), (F.col("l_partkey") % 100).cast("string")
    back = F.col("l_partkey") % 13 != 0
    return rows.select(
        system.alias("system_id"), F.col("o_orderdate").alias("departure_ts"), "return_ts",
        F.when(named, F.concat(system, F.lit(":name:station "), supplier)).otherwise(F.concat(system, F.lit(":s"), supplier)).alias("departure_station_id"),
        F.when(back, F.concat(system, F.lit(":s"), dock)).alias("return_station_id"),
        F.when(named, "name").otherwise("id").alias("departure_station_match"),
        F.concat(F.lit("Station "), supplier).alias("departure_label"), F.when(back, F.concat(F.lit("Station "), dock)).alias("return_label"),
        F.when(F.col("labelled"), F.col("o_orderpriority")).alias("membership_raw"),
        F.when(~((F.year("o_orderdate") == 1998) & (F.col("l_partkey") % 3 == 0)), F.col("l_partkey").cast("string")).alias("bike_id"),
        "is_ebike",
        F.lit(None).cast("long").alias("duration_s"),
    )


def fact_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table of trips_o, written once for a session, as a warehouse keeps it."""
    return scratch.once(spark, sf_dir, "fact_o", lambda s, d: O.conform(trips_o(s, d), AS_OF, FIRST_TRUSTED), "system_id")


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip for each event, second-grained, spread over two years; a quarter lie on the hour."""
    e = read(spark, sf_dir, "events")
    system = F.concat(F.lit("ev-"), F.col("event_type"))
    start = F.timestamp_add("DAY", (F.col("event_id") % 24 * 31).cast("int"), F.when(F.col("event_id") % 4 == 0, F.date_trunc("hour", "ts").cast("timestamp_ntz")).otherwise(F.col("ts")))
    length = F.when(F.col("event_id") % 4 == 0, F.lit(3600)).otherwise(F.floor(F.col("value") * 60)).cast("int")
    return e.select(
        system.alias("system_id"), start.alias("departure_ts"), F.when(F.col("event_id") % 17 != 0, F.timestamp_add("SECOND", length, start)).alias("return_ts"),
        F.concat(system, F.lit(":s"), (F.col("user_id") % 20).cast("string")).alias("departure_station_id"), F.concat(system, F.lit(":s"), (F.col("event_id") % 20).cast("string")).alias("return_station_id"),
        F.lit("id").alias("departure_station_match"), F.lit(None).cast("long").alias("duration_s"),
        F.when((F.col("event_type") != "error") | (F.col("event_id") % 5 != 0), (F.col("user_id") % 40).cast("string")).alias("bike_id"),
    )


def fact_r(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scratch.once(spark, sf_dir, "fact_r", lambda s, d: O.conform(rides(s, d), "2030-01-01", 2009), "system_id")


def bridged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bridge for trips_o: every other name-only station is the dock with the next number."""
    k = F.col("s_suppkey")
    system = F.explode(F.array(*[F.lit(f"sys-{i}") for i in range(5)])).alias("system")
    rows = read(spark, sf_dir, "supplier").filter(k % 20 == 0).select(system, k)
    return rows.select(F.concat(F.col("system"), F.lit(":name:station "), k.cast("string")).alias("era_id"), F.concat(F.col("system"), F.lit(":s"), (k + 1).cast("string")).alias("canonical_id"), F.lit("name").alias("via"))


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows of a third of the stations of trips_o: two periods, the later without a name or a place now and then."""
    k = F.col("s_suppkey")
    period = F.explode(F.array(F.lit("2019"), F.lit("2020"))).alias("source_period")
    system = F.explode(F.array(*[F.lit(f"sys-{i}") for i in range(5)])).alias("system_id")
    rows = read(spark, sf_dir, "supplier").filter(k % 3 == 0).select("s_suppkey", period).select("*", system)
    late = F.col("source_period") == "2020"
    return rows.select(
        "system_id", "source_period", F.concat(F.lit("s"), k.cast("string")).alias("station_key"), F.when(~(late & (k % 2 == 0)), F.concat_ws(" ", F.lit("Listed"), k.cast("string"), "source_period")).alias("station_name"),
        F.when(~(late & (k % 5 == 0)), F.lit(45.0) + k % 50 * 0.01 + F.when(late, 0.001).otherwise(0.0)).alias("lat"), (F.lit(-73.0) - k % 7 * 0.01).alias("lon"),
    )


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live docks of a quarter of the stations of trips_o; a fifth of them lie where no system is."""
    k = F.col("s_suppkey")
    system = F.explode(F.array(*[F.lit(f"sys-{i}") for i in range(5)])).alias("system_id")
    key = F.col("s_suppkey").cast("string")
    rows = read(spark, sf_dir, "supplier").filter(k % 4 == 0).select("s_suppkey", system)
    return rows.select("system_id", F.concat(F.col("system_id"), F.lit(":s"), key).alias("station_id"), F.concat(F.lit("Live "), key).alias("name"), F.when(k % 5 == 0, 0.0).otherwise(F.lit(46.0) + k % 50 * 0.01).alias("lat"), (F.lit(-74.0) - k % 7 * 0.01).alias("lon"))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as live docks for the bridge: some with an older code, names with remarks and spaces."""
    k = F.col("station_id").cast("long")
    name = F.concat(F.lit("Rue "), k.cast("string"), F.when(k % 4 == 0, F.lit(" / Parc (Old)")).when(k % 4 == 1, F.lit(" - Parc")).otherwise(F.lit("")))
    return docks(spark, sf_dir).select("station_id", F.when(k % 3 == 0, (9000 + k).cast("string")).alias("short_name"), name.alias("name"), "lat", "lon")


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd customers as stations known by name only; a quarter bear a dock's name."""
    k = F.col("k")
    rows = places(spark, sf_dir).withColumn("k", F.col("era_id").cast("long")).filter(k % 2 == 1)
    name = F.when(k % 4 == 1, F.concat(F.lit("rue "), (k % 40).cast("string"))).otherwise(F.concat(F.lit("lane "), k.cast("string")))
    return rows.select(F.concat(F.lit("br:name:"), k.cast("string")).alias("era_id"), name.alias("nm"), "lat", "lon")


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even customers as snapshot stations: under a code, a key or none; some without a place, some far off."""
    k = F.col("k")
    rows = places(spark, sf_dir).withColumn("k", F.col("era_id").cast("long")).filter(k % 2 == 0)
    id_ = F.when(k % 10 == 0, (9003 + k % 3 * 3).cast("string")).when(k % 10 == 2, (1 + k % 9).cast("string")).otherwise(F.concat(F.lit("o"), k.cast("string")))
    label = F.when(k % 3 == 0, F.concat(F.lit("RUE "), (k % 40).cast("string"))).when(k % 3 == 1, F.concat(F.lit("Rue "), (k % 40).cast("string"), F.lit("/Parc"))).otherwise("Avenue")
    return rows.select(F.concat(F.lit("br:"), id_).alias("era_id"), label.alias("label"), F.when(k % 7 != 0, F.col("lat")).alias("lat"), F.when(k % 7 != 0, F.col("lon")).alias("lon"))


#: Two layouts in which the events are published for landing, and where their columns go.
LAYOUTS = (("Trip Id", "Start date", "Start station", "Bike"), ("Bike number", "Trip Id", "Start time", "Station code", "Note"))
ERAS = landing.EraMap({"Trip Id": "trip_id", "Start date": "departure_raw", "Start station": "departure_station_name", "Bike": "bike_id", "Bike number": "bike_id", "Start time": "departure_raw", "Station code": "departure_station_key", "Note": ""})


def landed_events(spark: SparkSession, sf_dir: str) -> landing.Landed:
    """Events written as CSV files in two layouts, a period for each type, and landed again.

    The first layout is not UTF-8, the second has notes that span lines; both lie in folders whose
    names hold blanks and signs.
    """
    e = read(spark, sf_dir, "events")
    id_, ts, bike, files = F.col("event_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), (F.col("user_id") % 40).cast("string"), []
    top = scratch.new_path(spark, "published")
    name = F.concat(F.when(F.col("event_id") % 10 == 3, F.lit('Allée "')).otherwise(F.lit('Rue "')), bike, F.lit('", Parc'))
    note = F.when(F.col("event_id") % 20 == 5, F.lit('two\n\nlines, "quoted"')).otherwise(F.lit("x"))
    forms = ((F.col("event_type").isin("view", "click"), (id_, ts, name, bike), "ISO-8859-1"), (~F.col("event_type").isin("view", "click"), (bike, id_, ts, F.concat(F.lit(" "), bike, F.lit(".0")), note), "UTF-8"))
    for i, (these, cells, encoding) in enumerate(forms):
        rows = e.filter(these).select("event_type", *[c.alias(n) for c, n in zip(cells, LAYOUTS[i], strict=True)])
        folder = f"{top}/trips of layout #{i}, 100%25"
        rows.write.partitionBy("event_type").option("header", True).option("escape", '"').option("encoding", encoding).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(folder).select("path").collect()
        files += [landing.SourceFile(r.path, "ev", r.path.split("event_type=")[1].split("/")[0], "made here") for r in found]
    return landing.land(spark, files, {"ev": ERAS})


def _column(i: int) -> str:
    return (_column(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)


def workbook(sheets: dict[str, list[list]]) -> bytes:
    """A workbook with those rows: text as shared strings, every other one inline, numbers as numbers; null cells left out."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    shared: dict[str, int] = {}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for n, rows in enumerate(sheets.values()):
            lines = []
            for y, row in enumerate(rows):
                cells = []
                for x, v in enumerate(row):
                    ref = f'r="{_column(x)}{y + 1}"'
                    if isinstance(v, bool):
                        cells.append(f'<c {ref} t="b"><v>{int(v)}</v></c>')
                    elif isinstance(v, int | float):
                        cells.append(f"<c {ref}><v>{v}</v></c>")
                    elif v is not None and (x + y) % 2:
                        cells.append(f'<c {ref} t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>')
                    elif v is not None:
                        cells.append(f'<c {ref} t="s"><v>{shared.setdefault(v, len(shared))}</v></c>')
                lines.append(f'<row r="{y + 1}">{"".join(cells)}</row>')
            z.writestr(f"xl/worksheets/sheet{n + 1}.xml", f'<?xml version="1.0" encoding="UTF-8"?><worksheet {ns}><sheetData>{"".join(lines)}</sheetData></worksheet>')
        tabs = "".join(f'<sheet name={quoteattr(name)} sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, name in enumerate(sheets))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook {ns} xmlns:r="{rel}"><sheets>{tabs}</sheets></workbook>')
        ids = "".join(f'<Relationship Id="rId{i + 1}" Type="{rel}/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(sheets)))
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{ids}</Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<?xml version="1.0" encoding="UTF-8"?><sst {ns}>{"".join(f"<si><t xml:space={quoteattr("preserve")}>{escape(v)}</t></si>" for v in shared)}</sst>')
    return out.getvalue()


def _published(group: pa.Table) -> pa.Table:
    """A workbook of the events of one type and some 100,000 ids: two quarters as two worksheets, the later in the other layout."""
    path = f"books/{group['event_type'][0].as_py()} {group['part'][0].as_py()}.xlsx"
    rows = group.sort_by("event_id").to_pylist()
    late = [[r["bike"], r["id"], r["serial"], f" {r['bike']}.0", None if r["event_id"] % 3 else "x"] for r in rows if r["event_id"] % 2]
    early = [[r["id"], r["serial"], f'Allée <{r["bike"]}> & "Parc"', r["bike"]] for r in rows if r["event_id"] % 2 == 0]
    sheets = {"Q3 ": [list(LAYOUTS[0]), *early], "Q4": [[None], list(LAYOUTS[1]), [None, None], *late]}
    return pa.table({"path": [path], "content": pa.array([workbook({k: v for k, v in sheets.items() if len(v) > 3 or k == "Q3 "})], pa.binary())})


def landed_workbooks(spark: SparkSession, sf_dir: str) -> landing.Landed:
    """Events published as workbooks, times as day numbers, and landed again."""
    e = read(spark, sf_dir, "events")
    serial = (F.unix_micros(F.date_trunc("minute", "ts").cast("timestamp")) / 86_400_000_000 + 25569).cast("double")
    bike = (F.col("user_id") % 40).cast("string")
    # At most so many rows as a worksheet may have; read twice, so written once.
    rows = e.select("event_type", F.floor(F.col("event_id") / 100_000).alias("part"), "event_id", F.col("event_id").cast("string").alias("id"), serial.alias("serial"), bike.alias("bike"))
    at = scratch.new_path(spark, "books")
    rows.groupBy("event_type", "part").applyInArrow(_published, "path string, content binary").write.parquet(at)
    books = spark.read.schema("path string, content binary").parquet(at)
    files = [landing.SourceFile(r.path, "ev", r.path.split("/")[1].split(" ")[0], "made here") for r in books.select("path").collect()]
    return workbooks.land(spark, books, files, {"ev": ERAS})


def _zipped(group: pa.Table) -> pa.Table:
    """An archive of the ids of one type and some 100,000 ids: two files, a third in an archive within, and a note."""
    inner, outer = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as within, zipfile.ZipFile(outer, "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(3):
            ids = [i for i in group["event_id"].to_pylist() if i % 3 == k]
            (within if k == 2 else z).writestr(f"part{k}.csv", "".join(f"{i}\n" for i in sorted(ids)))
        z.writestr("readme.txt", "a note")
        within.close()
        z.writestr("more.zip", inner.getvalue())
    content = outer.getvalue()
    return pa.table({"path": [f"{group['event_type'][0].as_py()} {group['part'][0].as_py()}"], "sha256": [hashlib.sha256(content).hexdigest()], "content": pa.array([content], pa.binary())})


def unpacked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published as archives and unpacked into a store of this session."""
    rows = read(spark, sf_dir, "events").select("event_type", F.floor(F.col("event_id") / 100_000).alias("part"), "event_id")
    at = scratch.new_path(spark, "archives")
    rows.groupBy("event_type", "part").applyInArrow(_zipped, "path string, sha256 string, content binary").write.parquet(at)
    archives = spark.read.schema("path string, sha256 string, content binary").parquet(at)
    return archive.unpack_into(scratch.new_path(spark, "store"), archives)[0]


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed text of three systems from the events: every way to write times, keys, names and signals."""
    e = read(spark, sf_dir, "events")
    k, u, f = F.col("event_id") % 6, F.col("user_id") % 7, lambda p: F.date_format("ts", p)
    system = F.element_at(F.array(*map(F.lit, ("van", "mtl", "tor"))), (F.col("event_id") % 3 + 1).cast("int"))
    raw = F.when(k == 0, f("dd/MM/yyyy HH:mm")).when(k == 1, f("MM/dd/yyyy HH:mm:ss")).when(k == 2, f("yyyy/MM/dd HH:mm:ss")).when(k == 4, f("yyyy-MM-dd HH:mm:ss")).when(k == 5, F.when(F.col("event_id") % 12 == 5, (30000 + F.col("event_id") % 10000).cast("string")).otherwise("gone"))
    key = F.when(u == 0, "NULL").when(u == 1, F.concat((F.col("user_id") % 50).cast("string"), F.lit(".0"))).when(u == 2, F.concat(F.lit(" "), (F.col("user_id") % 50).cast("string"), F.lit(" "))).when(u == 3, "")
    name = F.when(u == 0, "null").when(u == 3, F.concat(F.lit("  Rue  "), (F.col("user_id") % 50).cast("string"))).when(u == 4, F.concat((100 + F.col("user_id") % 900).cast("string"), F.lit(" Main & "), u.cast("string"))).when(u == 5, " ")
    cells = {
        "trip_id": F.col("event_id").cast("string"), "departure_raw": raw, "departure_ms": F.when(k == 3, F.unix_millis(F.col("ts").cast("timestamp")).cast("string")), "departure_station_key": key, "departure_station_name": name,
        "duration_s": F.when(u == 6, "n/a").otherwise(F.concat(F.floor("value").cast("string"), F.lit(".5"))), "departure_lat": F.when(u != 2, F.lit("45.5")).otherwise("north"),
        "electric_bike": F.when(u < 3, "TRUE").when(u == 3, "no").when(u == 4, ""), "bike_model": F.when(u < 2, "efit g5").when(u < 4, "ICONIC"), "bike_id": F.concat(F.lit(" "), u.cast("string")),
    }
    rows = e.select(system.alias("system_id"), F.lit("p").alias("source_period"), F.concat(F.lit("f"), k.cast("string")).alias("source_file"), *[c.alias(n) for n, c in cells.items()])
    return rows.select("*", *[F.lit(None).cast("string").alias(c) for c in landing.TRIP_COLUMNS if c not in cells])


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather of sys-0 to sys-3 on the days with orders, but for some days and some temperatures."""
    d = F.dayofyear("date_key")
    days = read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date_key")).distinct().filter(d % 10 != 0)
    return days.select(F.explode(F.array(*[F.lit(f"sys-{i}") for i in range(4)])).alias("system_id"), "date_key", F.when(d % 7 != 0, d.cast("double")).alias("temp_mean_c"))


def order_of_files(spark: SparkSession) -> DataFrame:
    """Date orders of the files of raw_trips, proven elsewhere."""
    return spark.createDataFrame([(s, f"f{i}", o) for s in ("van", "mtl", "tor") for i, o in ((0, "day"), (1, "month"), (2, "year"))], "system_id string, source_file string, date_order string")


def zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("van", "America/Vancouver"), ("mtl", "America/Montreal"), ("tor", "America/Toronto")], "system_id string, zone string")


def mapping(spark: SparkSession) -> DataFrame:
    """Membership groups of the five systems, a fixed small table."""
    return spark.createDataFrame([(f"sys-{i}", label, group) for i in range(5) for label, group in GROUPS], "system_id string, membership_raw string, membership_group string")


def docks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as docks with positions on a lattice."""
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("station_id"), F.col("s_name").alias("name"), (F.lit(45.0) + (F.col("s_suppkey") % 100) * 0.002).alias("lat"), (F.lit(-73.0) - F.floor(F.col("s_suppkey") / 100) * 0.003).alias("lon"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as places near those docks; most are a few metres off one."""
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "supplier").agg(F.count("*").alias("n"))
    k = F.col("c_custkey")
    at = k % F.col("n")
    return c.join(F.broadcast(n)).select(k.cast("string").alias("era_id"), (F.lit(45.0) + (at % 100) * 0.002 + (k % 7) * 0.0001).alias("lat"), (F.lit(-73.0) - F.floor(at / 100) * 0.003).alias("lon"))

"""The orders of the test tables as an archive of three systems, to be run from files to artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import landing as L
from ..sources import sample, scratch
from . import run as RN
from .settings import Settings, System

REGISTRY = (
    System("mtl", "Montreal", "Docks M", "https://m/data", "1995", "America/Montreal", -5, bridged=True),
    System("tor", "Toronto", "Docks T", "https://t/data", "1995", "America/Toronto", -5),
    System("van", "Vancouver", "Docks V", "https://v/data", "1995", "America/Vancouver", -8, prefixed=True, deduped=True),
)
HEADERS = {"Trip Id": "trip_id", "Start": "departure_raw", "End": "return_raw", "Start code": "departure_station_key", "End code": "return_station_key", "Start dock": "departure_station_name", "End dock": "return_station_name", "Pass": "membership_raw", "Bike": "bike_id"}
LABELS = (("1-URGENT", "member"), ("2-HIGH", "member"), ("3-MEDIUM", "casual"), ("4-NOT SPECIFIED", "operational"), ("5-LOW", "casual"))
DOCKS = 40


def rows(spark: SparkSession, sf: str) -> DataFrame:
    """A trip for each order, as its system publishes it: three ways to write dates and stations, rows without time or dock, repeats."""
    k = F.col("o_orderkey")
    system = F.element_at(F.array(*map(F.lit, ("van", "mtl", "tor"))), (F.col("o_custkey") % 3 + 1).cast("int"))
    start = F.timestamp_add("HOUR", (k % 24).cast("int"), F.col("o_orderdate").cast("timestamp_ntz"))
    o = sample.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", system.alias("system_id"), start.alias("a"), F.timestamp_add("MINUTE", (k % 50 + 1).cast("int"), start).alias("b"))
    s, early, lost = F.col("system_id"), F.year("a") < 1996, k % 89 == 0
    text = lambda c: F.when(s == "van", F.date_format(c, "MM/dd/yyyy HH:mm")).when(s == "mtl", F.date_format(c, "dd/MM/yyyy HH:mm")).otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    code = lambda n: F.when((s == "tor") | ((s == "mtl") & ~early), n.cast("string"))
    name = lambda n: F.when(s == "van", F.concat(F.lpad(n.cast("string"), 4, "0"), F.lit(" Rue "), n.cast("string"))).otherwise(F.concat(F.lit("Rue "), n.cast("string")))
    here, there = F.col("o_custkey") % DOCKS, k % DOCKS
    cells = (
        k.cast("string"), F.when(k % 97 != 0, text("a")), F.when(k % 31 != 0, text("b")), F.when(~lost, code(here)), code(there), F.when(~lost, name(here)), name(there), F.when(k % 11 != 0, F.col("o_orderpriority")), k.cast("string"),
    )
    times = F.explode(F.when((s == "van") & (k % 53 == 0), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return o.select("system_id", F.year("a").cast("string").alias("period"), *[c.alias(n) for c, n in zip(cells, HEADERS, strict=True)], times.alias("_n")).drop("_n")


def inputs(spark: SparkSession, sf: str, at: str) -> RN.Inputs:
    """The archive written below `at`: trip files by system and year, station feeds and weather."""
    rows(spark, sf).write.partitionBy("system_id", "period").option("header", True).csv(f"{at}/archive")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(f"{at}/archive").select("path").collect()  # a row for each file
    part = lambda path, key: path.split(f"{key}=")[1].split("/")[0]
    files = [L.SourceFile(r.path, part(r.path, "system_id"), part(r.path, "period"), f"pin {part(r.path, 'system_id')} {part(r.path, 'period')}") for r in found]
    n = F.col("n")
    docks = sample.read(spark, sf, "orders").select((F.col("o_custkey") % DOCKS).alias("n")).distinct()
    span = sample.read(spark, sf, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("d"))
    y = F.dayofyear("d")
    measures = {"Mean Temp (°C)": 10 + 12 * F.sin(y * 0.0172), "Max Temp (°C)": 14 + 12 * F.sin(y * 0.0172) + F.dayofmonth("d") * 0.11, "Min Temp (°C)": 2 + 11 * F.sin(y * 0.0172) + y % 13 * 0.05, "Total Precip (mm)": (y % 5).cast("double"), "Total Snow (cm)": F.when(F.month("d").isin(12, 1, 2), y % 3).otherwise(0).cast("double"), "Snow on Grnd (cm)": F.lit(0.0)}
    days.select(F.col("d").cast("string").alias("Date/Time"), F.lit("c").alias("Climate ID"), *[c.alias(h) for h, c in measures.items()]).write.option("header", True).csv(f"{at}/weather")
    for m in REGISTRY:
        id_ = F.lpad(n.cast("string"), 4, "0") if m.prefixed else n.cast("string")
        dock = F.struct(id_.alias("station_id"), F.concat(F.lit("Rue "), n.cast("string")).alias("name"), (45 + n * 0.01).alias("lat"), (F.lit(-73.0) - n % 7 * 0.01).alias("lon"))
        docks.agg(F.struct(F.collect_list(dock).alias("stations")).alias("data")).write.json(f"{at}/feeds/{m.system_id}")  # DOCKS docks
    labels = spark.createDataFrame([(m.system_id, *pair) for m in REGISTRY for pair in LABELS], "system_id string, membership_raw string, membership_group string")
    ids = [m.system_id for m in REGISTRY]
    return RN.Inputs(files, dict.fromkeys(ids, L.EraMap(HEADERS)), REGISTRY, labels, "2030-01-01", 1990, 1997, "1996-01-01", {i: f"{at}/feeds/{i}" for i in ids}, {i: [f"{at}/weather"] for i in ids})


def recorded(spark: SparkSession, sf: str) -> DataFrame:
    """What a run up to the model has recorded."""
    at = scratch.new_path(spark, "run")
    told = RN.run(spark, Settings(at), inputs(spark, sf, at), until="model")
    return told.filter("metric not in ('files', 'station_bridge')")


def systems(spark: SparkSession, sf: str) -> DataFrame:
    """The registered systems with the rows that each publishes."""
    published = rows(spark, sf).groupBy("system_id").agg(F.count("*").alias("published"))
    return RN.dim_system(spark, REGISTRY).join(published, "system_id", "left")

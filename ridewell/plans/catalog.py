"""Every query by name, over the trip-shaped views of the test tables; oracle.py states the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions import sql as SQ
from ..operators import cleaning as C
from ..operators import scenario as S
from ..operators import trips as O
from ..sources import archive as A
from ..sources import landing as L
from ..sources import sample as D
from ..sources import scratch
from . import metrics as M
from . import publish_job as J
from . import publishing as P
from . import reconciliation as R
from . import sample_run as SR

LONG_RIDE = 400 * 86400
SAMPLE_FIRST_YEAR = 1997


def _o(metric):
    return lambda spark, sf: metric(D.fact_o(spark, sf))


def _r(metric):
    return lambda spark, sf: metric(D.fact_r(spark, sf))


def _mapped(metric):
    return lambda spark, sf: metric(D.fact_o(spark, sf), D.mapping(spark))


def _table(name: str, query):
    return lambda spark, sf: query(D.read(spark, sf, name))


def season_share(fact: DataFrame) -> DataFrame:
    rows = M.seasonality(fact, SAMPLE_FIRST_YEAR)
    total = F.sum("mean_trips").over(Window.partitionBy("system_id"))
    return rows.select("system_id", "month_of_year", (100 * F.col("mean_trips") / total).alias("share"))


def hour_extremes(fact: DataFrame) -> DataFrame:
    """The hours in which docks empty and fill the most."""
    rows = M.hourly(fact, 2009)
    linked = F.sum("departures").over(Window.partitionBy("system_id"))
    y = rows.withColumn("y", 100 * (F.col("returns") - F.col("departures")) / linked)
    return y.groupBy("system_id").agg(F.min_by("hour", F.struct("y", "hour")).alias("drain_hour"), F.max_by("hour", F.struct("y", "hour")).alias("fill_hour"))


def hourly_shares(fact: DataFrame) -> DataFrame:
    """Each hour's share of a system's departures and returns, in per cent."""
    w = Window.partitionBy("system_id")
    share = lambda c: (100 * F.col(c) / F.sum(c).over(w)).alias(f"{c}_share")
    return M.hourly(fact, 2009).select("system_id", "hour", share("departures"), share("returns"))


def grid_share(fact: DataFrame) -> DataFrame:
    """Years with a whole run of months of dwell times, and the share of these that are whole hours."""
    rows = M.dwell(fact, M.bike_eras(M.bike_coverage(fact)))
    return rows.filter("intervals > 0").select("system_id", "year", (F.col("months") == 12).alias("full"), (F.col("on_hour_grid") / F.col("intervals")).alias("grid"))


def moves(fact: DataFrame) -> DataFrame:
    half = F.col("abs_net") / 2
    return M.rebalancing(fact).select("system_id", "year", (half / F.col("days")).alias("moves_per_day"), (1000 * half / F.col("linked_trips")).alias("moves_per_1k"))


def dwell_withheld(fact: DataFrame) -> DataFrame:
    cov = M.bike_coverage(fact)
    able = M.bike_eras(cov).select("system_id").distinct()
    basis = F.when(F.col("with_bike_id") == 0, "no bike identifier published").otherwise("bike identifier incomplete")
    return cov.filter(F.col("coverage") < M.BIKE_COVERAGE).join(F.broadcast(able), "system_id", "left_semi").select("system_id", "year", "trips", "with_bike_id", basis.alias("basis"))


def lost(fact: DataFrame, dim: DataFrame) -> DataFrame:
    era = (F.col("system_id") == "sys-1") & F.col("month").between("1998-10", "1999-12")
    return M.label_lost(M.membership(fact, dim), era)


def label_usage(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return fact.filter("membership_raw is not null").join(dim, ["system_id", "membership_raw"], "left").groupBy("system_id", "membership_raw", "membership_group").agg(F.count("*").alias("n"))


def usage(spark: SparkSession, sf: str) -> DataFrame:
    return scratch.once(spark, sf, "usage", lambda s, d: O.usage(D.fact_o(s, d)))


def identity(spark: SparkSession, sf: str) -> DataFrame:
    return scratch.once(spark, sf, "identity", lambda s, d: O.station_identity(usage(s, d), D.bridged(s, d)))


def dim_station(spark: SparkSession, sf: str) -> DataFrame:
    return scratch.once(spark, sf, "dim_station", lambda s, d: O.dim_station(usage(s, d), identity(s, d), O.snapshots(D.listed(s, d)), D.live(s, d)))


def stations(spark: SparkSession, sf: str) -> DataFrame:
    fact = D.fact_o(spark, sf)
    return M.stations(dim_station(spark, sf), M.net_flow(canonical(spark, sf, fact)), least=20)


def canonical(spark: SparkSession, sf: str, fact: DataFrame) -> DataFrame:
    # Written by themselves, so that joins are planned by the size of what is joined.
    renamed = scratch.once(spark, sf, "renamed", lambda s, d: identity(s, d).filter("source_id <> canonical_id"))
    return O.fact_trips(fact, renamed)


def station_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return O.bridge(D.feed(spark, sf), D.observed(spark, sf), D.orphans(spark, sf), "br")


def clean_typed(spark: SparkSession, sf: str) -> DataFrame:
    return C.typed(D.raw_trips(spark, sf), D.order_of_files(spark), D.zones(spark))


def conformed(spark: SparkSession, sf: str) -> DataFrame:
    return C.identified(C.kept(clean_typed(spark, sf)), ("van",), {"van": "flag", "tor": "model"})


def offered(orders: DataFrame) -> DataFrame:
    """A page for each month with orders; those of odd months have labels that name no period."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    rows = orders.groupBy(month.alias("m"), F.date_format("o_orderdate", "MMMM yyyy").alias("text"), (F.month("o_orderdate") % 2).alias("odd")).agg(F.count("*").alias("n"))
    label = F.when(F.col("odd") == 1, F.concat(F.lit("Data of "), F.col("text"))).otherwise(F.regexp_replace("text", " ", "</b>&nbsp; "))
    return rows.select(F.lit("v").alias("system_id"), F.concat(F.lit('<li><a class="x" href="https://d/'), F.col("m"), F.lit('"><b>'), label, F.lit("</a></li>")).alias("html"))


def periods(orders: DataFrame) -> DataFrame:
    return A.by_period(A.anchors(offered(orders)).withColumnRenamed("href", "url"), A.label_period(F.col("label")))[0]


def merged_manifest(supplier: DataFrame) -> DataFrame:
    k, key = F.col("s_suppkey"), F.col("s_suppkey").cast("string")
    pins = [F.concat(F.lit("sha"), key).alias("sha256"), k.cast("long").alias("bytes"), F.lit("csv").alias("content_format")]
    known = supplier.filter(k % 3 != 0).select(F.lit("v").alias("system_id"), key.alias("period"), F.concat(F.lit("u"), key).alias("url"), *pins)
    found = supplier.filter(k % 2 == 0).select(F.lit("v").alias("system_id"), key.alias("period"), F.concat(F.when(k % 5 == 0, "new").otherwise("u"), key).alias("url"))
    return A.merge(known, found, accept_changes=True)


def archive_gaps(orders: DataFrame) -> DataFrame:
    held = orders.filter(F.month("o_orderdate") % 4 != 0).select(F.concat(F.lit("sys-"), (F.col("o_custkey") % 3).cast("string")).alias("system_id"), F.date_format("o_orderdate", "yyyy-MM").alias("period"))
    return A.month_gaps(held)


def shared_pairs(events: DataFrame) -> DataFrame:
    """Pairs of systems that use one bike id, and how many ids each pair shares."""
    uses = events.select(F.col("event_type").alias("a"), F.col("user_id").alias("bike_id")).distinct()
    other = uses.select(F.col("a").alias("b"), "bike_id")
    return uses.join(other, "bike_id").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))


def top_pairs(spark: SparkSession, sf: str) -> DataFrame:
    names = usage(spark, sf).groupBy("system_id", "station_id").agg(O.latest_label().alias("station_name"))
    return M.top_pairs(D.fact_o(spark, sf), names)


def canonical_fact(spark: SparkSession, sf: str) -> DataFrame:
    return canonical(spark, sf, D.fact_o(spark, sf)).groupBy("system_id", "departure_station_id", "return_station_id").agg(F.count("*").alias("n"))


def resolution(trips: DataFrame) -> DataFrame:
    """How departure stations were told: by an id that docks also have, by name only, or by another key."""
    known = trips.filter("return_station_id is not null").select(F.col("return_station_id").alias("_k")).distinct()
    uses = trips.groupBy("system_id", "departure_station_id").agg(F.count("*").alias("n")).join(known, F.col("departure_station_id") == F.col("_k"), "left")
    bucket = F.when(F.col("_k").isNotNull(), "canonical").when(F.col("departure_station_id").like("%:name:%"), "name").otherwise("key")
    return uses.groupBy("system_id", bucket.alias("bucket")).agg(F.sum("n").alias("trips"), F.count("departure_station_id").alias("ids"))


def calendar_coverage(fact: DataFrame) -> DataFrame:
    days = M.trusted(fact).select("system_id", F.col("date_key").alias("d")).distinct()
    span = days.groupBy("system_id").agg(F.min("d").alias("a"), F.max("d").alias("b"))
    calendar = span.select("system_id", F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("d"))
    return calendar.join(days.withColumn("_x", F.lit(1)), ["system_id", "d"], "left").groupBy("system_id").agg(F.count("*").alias("days"), F.count("_x").alias("observed"))


def month_gaps(fact: DataFrame, least: int = 25) -> DataFrame:
    """Where the line of months with `least` trips breaks: steps of more than one and a half times the system's smallest."""
    index = F.year("trip_month").cast("long") * 12 + F.month("trip_month") - 1
    m = M.complete(fact).groupBy("system_id", index.alias("x")).agg(F.count("*").alias("trips")).filter(F.col("trips") >= least)
    step = m.withColumn("dx", F.col("x") - F.lag("x").over(Window.partitionBy("system_id").orderBy("x"))).filter("dx is not null")
    return step.select("system_id", "x", (F.col("dx") > 1.5 * F.min("dx").over(Window.partitionBy("system_id"))).alias("breaks"))


def far_fence(fact: DataFrame) -> DataFrame:
    """Fence for far outliers of station use: nearest-rank quartiles and three times their distance, within the data."""
    n = M.trusted(fact).groupBy("system_id", F.col("departure_station_id").alias("s")).agg(F.count("*").alias("v"))
    w = Window.partitionBy("system_id")
    r = n.withColumns({"i": F.row_number().over(w.orderBy("v", "s")) - 1, "k": F.count("*").over(w)})
    at = lambda q: F.max(F.when(F.col("i") == F.floor(F.lit(q) * (F.col("k") - 1) + 0.5), F.col("v")))
    q = r.groupBy("system_id").agg(at(0.25).alias("q1"), at(0.75).alias("q3"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    reach = 3 * (F.col("q3") - F.col("q1"))
    return q.select("system_id", F.greatest("lo", F.col("q1") - reach).alias("low"), F.least("hi", F.col("q3") + reach).alias("high"))


def landed(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as landed rows with gaps and repeats; only sys-1 is deduplicated."""
    line = D.read(spark, sf, "lineitem")
    rows = line.select(
        F.concat(F.lit("sys-"), (F.col("l_orderkey") % 3).cast("string")).alias("system_id"), F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"),
        F.when(F.col("l_partkey") % 50 != 0, F.col("l_shipdate")).alias("departure_ts"), F.when(F.col("l_suppkey") % 20 != 0, F.col("l_suppkey").cast("string")).alias("departure_station_key"),
        F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("Dock "), F.col("l_partkey").cast("string"))).alias("departure_station_name"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    )
    # Why a row is dropped by itself is told first, so that texts need not be sorted; repeats are looked for where they are dropped.
    rows = rows.withColumn("reason", O.drop_reason(F.lit(False), F.lit(False)))
    deduped = F.col("system_id").eqNullSafe("sys-1")
    order = Window.partitionBy("system_id", "k1", "k2").orderBy("departure_ts", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    first = rows.filter(deduped).withColumn("at", F.row_number().over(order)).withColumn("reason", F.coalesce("reason", F.when(F.col("at") > 1, "duplicate")))
    return first.unionByName(rows.filter(~deduped).withColumn("at", F.lit(None).cast("int")))


def published(spark: SparkSession, sf: str) -> J.Model:
    """The sample's model, to be published."""
    fact = canonical(spark, sf, D.fact_o(spark, sf))
    return J.Model(fact, dim_station(spark, sf), D.mapping(spark), S.fit(model_days(spark, sf)), SAMPLE_FIRST_YEAR, ("sys-0", "sys-2"))


def publish_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """What would block publishing the sample: labels that no group claims, and orders whose lines did not land as its audit says."""
    m = published(spark, sf)
    audit = landing_audit(spark, sf).select(F.col("records").alias("source_records"), F.col("landed").alias("rows_landed"))
    return P.invariants(m.fact, O.funnel(landed(spark, sf)), audit, M.net_flow(m.fact), M.unmapped(m.fact, m.labels), m.stations)


def buyers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with orders: their number and whichever name, as all of a customer's rows bear the same."""
    rows = D.read(spark, sf, "orders").select("o_custkey").join(D.read(spark, sf, "customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy("o_custkey").agg(F.any_value("c_name").alias("name"), F.count("*").alias("orders"))


def observed_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """The row funnel as the pass that writes the kept rows has seen it."""
    at = scratch.new_path(spark, "kept")
    told = R.write_counted(landed(spark, sf), f"{at}/rows", R.funnel_counts(), F.col("reason").isNull(), "system_id")
    R.record(spark, at, "clean", told)
    seen = R.metrics(spark, at).filter("stage = 'clean'").groupBy().pivot("metric", list(told)).agg(F.first("value"))
    return seen.withColumn("residual", F.col("landed") - F.col("kept") - F.col("no_time") - F.col("no_station") - F.col("duplicate"))


def reconciled_archive(orders: DataFrame) -> DataFrame:
    """A file of orders for each system and month; of months 3, 5, 7, 9 and 11 the audit or the manifest says something else."""
    spark, ts = orders.sparkSession, F.col("o_orderdate")
    files = orders.groupBy(F.concat(F.lit("sys-"), (F.col("o_orderkey") % 3).cast("string")).alias("system_id"), F.date_format(ts, "yyyy-MM").alias("source_period")).agg(F.count("*").alias("n"))
    month = F.substring("source_period", 6, 2)
    sha = F.concat(F.lit("sha"), "source_period")
    audit = files.select(
        "system_id", "source_period", F.concat("source_period", F.lit(".csv")).alias("source_file"), F.when(month != "05", sha).alias("source_sha256"), (F.col("n") - F.when(month == "03", 1).otherwise(0)).alias("rows_landed"),
        F.when(month != "07", F.lit(0).cast("long")).alias("lines_repaired"), F.col("n").alias("source_records"), F.lit("trips").alias("kind"),
    )
    pins = files.filter(month != "11").select("system_id", F.col("source_period").alias("period"), F.when(month == "09", F.concat(F.lit("new"), sha)).otherwise(sha).alias("sha256"))
    later = files.filter(month == "01").select("system_id", F.concat(F.lit("9"), F.substring("source_period", 2, 6)).alias("period"), F.lit("x").alias("sha256"))
    told = orders.agg(F.lit("extract").alias("stage"), F.lit("rows_landed").alias("metric"), F.count("*").alias("value"))
    return R.disagreements(audit, pins.unionByName(later), told, [("sys-1", "1996-02")])


def years_of_weather(orders: DataFrame) -> DataFrame:
    system = F.concat(F.lit("sys-"), (F.col("o_custkey") % 3).cast("string")).alias("system_id")
    rows = orders.filter((F.col("o_custkey") % 3 != 0) | (F.year("o_orderdate") != 1995)).select(system, F.date_format("o_orderdate", "yyyy-MM").alias("period")).distinct()
    held = rows.select("system_id", F.substring("period", 1, 4).cast("int").alias("year")).filter("year % 2 = 0")
    return R.weather_years(rows, held, 1998)


def kept_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = landed(spark, sf).filter("system_id = 'sys-1'").drop("at")
    return O.keep_first(rows, ["system_id", "k1", "k2"], ["departure_ts", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]).select("system_id", "k1", "k2", "departure_ts", "l_partkey", "l_suppkey")


def landing_audit(spark: SparkSession, sf: str) -> DataFrame:
    orders, line = D.read(spark, sf, "orders").select("o_orderkey", "o_orderdate"), D.read(spark, sf, "lineitem").select("l_orderkey")
    landed_rows = line.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    rows = orders.join(landed_rows, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return rows.groupBy(F.concat(F.lit("sys-"), (F.col("o_orderkey") % 3).cast("string")).alias("system_id"), F.date_format("o_orderdate", "yyyy-MM").alias("period")).agg(F.count("*").alias("records"), F.coalesce(F.sum("n"), F.lit(0)).alias("landed"), F.count_if(F.col("n").isNull()).alias("empty"))


def dated_files(events: DataFrame) -> DataFrame:
    k, f = F.col("event_id") % 6, lambda p: F.date_format("ts", p)
    s = (F.when(k == 0, f("dd/MM/yyyy HH:mm")).when(k == 1, f("MM/dd/yyyy HH:mm")).when(k == 2, f("yyyy/MM/dd HH:mm")).when(k == 3, F.concat(F.lit("01/02/"), F.year("ts").cast("string"), F.lit(" 10:00")))
         .when(k == 4, F.when(F.col("user_id") % 2 == 0, f("dd/MM/yyyy")).otherwise(f("MM/dd/yyyy"))).otherwise(f("yyyy-MM-dd")))
    return O.date_order(events.select(F.lit("ev").alias("system_id"), F.concat(F.lit("f"), k.cast("string")).alias("source_file"), s.alias("departure_raw")))


def trough(events: DataFrame) -> DataFrame:
    spark = events.sparkSession
    offsets = spark.createDataFrame([("ev", -5)], "system_id string, utc_offset long")
    return O.zone_basis(events.select(F.lit("ev").alias("system_id"), F.col("event_type").alias("source_file"), "ts"), offsets, least=1000)


def local_times(events: DataFrame) -> DataFrame:
    ts = F.col("ts")
    basis = F.when(F.col("event_type") == "view", "utc").otherwise("local")
    return events.select("event_id", F.convert_timezone(F.lit("UTC"), F.lit("America/Vancouver"), ts).alias("local_ts"), X.as_local(ts, F.lit("America/Toronto"), basis).alias("by_basis"), X.to_local(F.unix_millis(ts.cast("timestamp")), F.lit("America/Montreal")).alias("from_ms"))


def stamp_texts(events: DataFrame) -> DataFrame:
    """Every event's time written in eight ways, and the date order of each."""
    k, f = F.col("k"), lambda p: F.date_format("ts", p)
    rows = events.select("event_id", "ts", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("k"))
    s = (F.when(k == 0, f("yyyy-MM-dd HH:mm:ss.SSSSSS")).when(k == 1, f("yyyy-MM-dd HH:mm")).when(k == 2, f("MM/dd/yyyy HH:mm:ss")).when(k == 3, f("M/d/yyyy H:mm")).when(k == 4, f("yyyy/MM/dd HH:mm:ss"))
         .when(k == 5, f("dd/MM/yyyy HH:mm")).when(k == 6, F.concat((30000 + F.col("event_id") % 20000).cast("string"), F.lit(".25"))).otherwise("no date"))
    return rows.select("event_id", "k", s.alias("s"), F.when(k == 5, "day").otherwise("month").alias("date_order"))


def stamps(events: DataFrame) -> DataFrame:
    return stamp_texts(events).select("event_id", "k", X.parse_ts_ord(F.col("s"), F.col("date_order")).alias("parsed"))


def names(supplier: DataFrame) -> DataFrame:
    k, key, n = F.col("s_suppkey") % 6, F.col("s_suppkey").cast("string"), F.col("s_name")
    s = (F.when(k == 0, "NULL").when(k == 1, F.concat(key, F.lit(".0"))).when(k == 2, F.concat(F.lit("  "), n, F.lit("  (Old)  "))).when(k == 3, "")
         .when(k == 4, F.concat((100 + F.col("s_suppkey") % 900).cast("string"), F.lit(" "), n, F.lit(" / Rue  -  A"))).otherwise(n))
    return supplier.select("s_suppkey", s.alias("s"))


def written(text: str, **views: Callable[[SparkSession, str], DataFrame]):
    """A query in SQL text over views and the SQL functions; views live as long as the session."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        SQ.register(spark)
        for name, make in views.items():
            make(spark, sf).createOrReplaceTempView(name)
        return spark.sql(text)

    return query


def named(**columns: Callable[[Column], Column]):
    return _table("supplier", lambda t: names(t).select("s_suppkey", *[make(F.col("s")).alias(n) for n, make in columns.items()]))


def null_labels(supplier: DataFrame) -> DataFrame:
    null = F.upper(F.trim("s")) == "NULL"
    return names(supplier).groupBy((F.col("s_suppkey") % 3).alias("g")).agg(F.count_if(null).alias("n"), F.countDistinct(F.when(~null, F.col("s"))).alias("labels")).filter("n > 0")


def links(pages: DataFrame) -> DataFrame:
    """Anchors of every page: address and text."""
    pattern = F.lit(r'<a[^>]*href="([^"]*)"[^>]*>([^<]*)</a>')
    pairs = F.arrays_zip(F.regexp_extract_all("html", pattern, F.lit(1)).alias("href"), F.regexp_extract_all("html", pattern, F.lit(2)).alias("label"))
    return pages.select("page_id", F.explode(pairs).alias("p")).select("page_id", "p.href", "p.label")


def range_join(spark: SparkSession, sf: str) -> DataFrame:
    eras = spark.createDataFrame([(1995, 1996), (1997, 1999), (2000, 2001)], "lo int, hi int")
    orders = D.read(spark, sf, "orders").select("o_orderdate", "o_totalprice")
    return orders.join(F.broadcast(eras), F.year("o_orderdate").between(F.col("lo"), F.col("hi"))).groupBy("lo").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))


def semi_anti(spark: SparkSession, sf: str) -> DataFrame:
    orders = D.read(spark, sf, "orders")
    open_ = orders.filter("o_orderstatus = 'P'").select("o_custkey").distinct().withColumn("has", F.lit(True))
    large = orders.filter("o_totalprice > 480000").select("o_custkey")
    c = D.read(spark, sf, "customer").select("c_custkey")
    return c.join(large, F.col("c_custkey") == F.col("o_custkey"), "left_anti").join(open_, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("has", F.lit(False)).alias("has_open"))


def shared_bikes(events: DataFrame) -> DataFrame:
    """Pairs of systems that use one bike id, counted from how many systems each id is in."""
    n = events.select("event_type", "user_id").distinct().groupBy(F.col("user_id").alias("bike_id")).agg(F.count("*").alias("n"))
    return n.filter("n > 1").select("bike_id", (F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("pairs"))


def phantom_days(fact: DataFrame) -> DataFrame:
    rows = M.linked(M.complete(fact)).filter("return_ts is not null")
    ends = rows.select("system_id", F.col("return_ts").cast("date").alias("d")).distinct()
    return ends.join(rows.select("system_id", F.col("date_key").alias("d")).distinct(), ["system_id", "d"], "left_anti").groupBy("system_id").agg(F.count("*").alias("phantom"))


def containment(spark: SparkSession, sf: str) -> DataFrame:
    o, l = D.read(spark, sf, "orders").select("o_orderkey", "o_orderdate"), D.read(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    year = lambda c: F.date_format(c, "yyyy")
    return o.join(l, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(year("o_orderdate").alias("named")).agg((F.count_if(year("l_shipdate") != year("o_orderdate")) / F.count("*")).alias("outside"))


def model_days(spark: SparkSession, sf: str) -> DataFrame:
    """Daily orders of three systems with weather made from the calendar."""
    daily = D.read(spark, sf, "orders").groupBy(F.concat(F.lit("sys-"), (F.col("o_custkey") % 3).cast("string")).alias("system_id"), F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("trips"))
    at, d, m = F.dayofyear("day"), F.dayofmonth("day"), F.month("day")
    weather = daily.select("system_id", "day").withColumns({
        "temp_max_c": F.when(at % 29 != 0, 10 + 12 * F.sin(at * 0.0172) + d * 0.11), "temp_min_c": 2 + 11 * F.sin(at * 0.0172) + d * 0.05,
        "precip_mm": (d % 5).cast("double"), "snow_cm": F.when(m.isin(12, 1, 2), d % 3).otherwise(0).cast("double"),
    })
    stub = spark.createDataFrame([(f"sys-{i}",) for i in range(3)], "system_id string").withColumn("trip_month", F.lit("2001-08-01").cast("date"))
    return S.daily_rows(daily, weather, stub, "1997-01-01")


def _model(query):
    return lambda spark, sf: query(model_days(spark, sf))


def trend(days: DataFrame) -> DataFrame:
    y, x = F.ln("trips"), F.col("temp_max_c")
    return days.filter("reason is null").groupBy("system_id").agg(F.round(F.regr_slope(y, x), 6).alias("slope"), F.round(F.regr_intercept(y, x), 6).alias("intercept"))


def predictions(days: DataFrame) -> DataFrame:
    return S.predict(S.fit(days), days.filter("reason is null").select("system_id", "block", *S.WEATHER, "is_weekend")).groupBy("system_id", "block").agg(F.avg("typical").alias("typical"), F.avg("mean").alias("mean"))


def asked_conditions(days: DataFrame) -> DataFrame:
    """Conditions of used days, some of them made such that no answer is due."""
    k = F.dayofmonth("day") % 7
    rows = days.filter("reason is null")
    return rows.select("system_id", F.when(k == 1, F.concat(F.lit("1990-"), F.date_format("day", "MM"))).otherwise(F.col("block")).alias("block"), (F.col("temp_max_c") + F.when(k == 2, 60).otherwise(0)).alias("temp_max_c"), F.when(k == 3, F.col("temp_max_c") + 0.01).otherwise(F.col("temp_min_c")).alias("temp_min_c"), (F.col("precip_mm") + F.when(k == 4, 100).otherwise(0)).alias("precip_mm"), "snow_cm", "is_weekend")


def refused(days: DataFrame) -> DataFrame:
    told = S.answers(S.fit(days), S.ranges(days), asked_conditions(days))
    return told.groupBy("system_id", F.coalesce("refusal", F.lit("answered")).alias("outcome")).agg(F.count("*").alias("n"), F.count("typical").alias("figures"))


def centroid(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("station_id").cast("long")
    mean = lambda c: F.round(F.sum(F.col(c) * (1 + k % 9)) / F.sum(1 + k % 9), 9).alias(c)
    return D.docks(spark, sf).groupBy((k % 4).alias("g")).agg(mean("lat"), mean("lon"))


def flow_rate(fact: DataFrame) -> DataFrame:
    rows = M.linked(fact)
    end = lambda c, v: F.struct(F.col(c).alias("station_id"), F.lit(v).alias("v"))
    uses = rows.select("system_id", F.explode(F.array(end("departure_station_id", -1), end("return_station_id", 1))).alias("e"))
    return uses.groupBy("system_id", "e.station_id").agg((F.sum("e.v") / F.count("*")).alias("rate"))


QUERIES = {
    "incomplete_months": _o(M.incomplete_months),
    "trips_monthly": _o(M.trips_monthly),
    "trips_monthly_unfiltered": _o(lambda f: f.groupBy("system_id", M.month_text().alias("month")).agg(F.count("*").alias("trips"))),
    "seasonality": _o(lambda f: M.seasonality(f, SAMPLE_FIRST_YEAR)),
    "season_share": _o(season_share),
    "stations_yearly": _o(M.stations_yearly),
    "ebike_share": _o(lambda f: M.ebike_share(f, ["sys-0", "sys-2"])),
    "duration_quartiles": _o(lambda f: M.duration(f, LONG_RIDE)),
    "exclusions": _o(M.exclusions),
    "meta_summary": lambda spark, sf: M.meta(D.fact_o(spark, sf), dim_station(spark, sf)),
    "flag_counts": _o(M.flag_counts),
    "quality_flags": _o(lambda f: f.groupBy("system_id", F.array_join("quality_flags", "+").alias("flags")).agg(F.count("*").alias("n"))),
    "net_flow": _o(M.net_flow),
    "net_flow_zero": _o(lambda f: M.net_flow(f).groupBy("system_id").agg(F.sum("net").alias("net"))),
    "od_concentration": _o(M.flows),
    "concentration_share": _o(lambda f: M.flows(f).select("system_id", (F.col("top_100") / F.col("linked_trips")).alias("top_100_share"))),
    "top_pairs": top_pairs,
    "hourly_flow": _r(lambda f: M.hourly(f, 2009)),
    "hourly_basis": _r(lambda f: M.hourly_basis(f, 2009)),
    "hour_extremes": _r(hour_extremes),
    "hourly_net": _r(lambda f: M.hourly_net(M.hourly(f, 2009), M.hourly_basis(f, 2009))),
    "rebalancing_yearly": _r(M.rebalancing),
    "full_years": _o(lambda f: M.full_years(M.rebalancing(f), f)),
    "headline_year": _o(lambda f: M.headline_year(M.full_years(M.rebalancing(f), f))),
    "moves_per_day": _r(moves),
    "bike_coverage": _r(M.bike_coverage),
    "bike_eras": _o(lambda f: M.bike_eras(M.bike_coverage(f))),
    "dwell_chain": _r(lambda f: M.dwell(f, M.bike_eras(M.bike_coverage(f)))),
    "dwell_totals": _r(lambda f: M.dwell_totals(M.dwell(f, M.bike_eras(M.bike_coverage(f))))),
    "dwell_withheld": _o(dwell_withheld),
    "membership_mix": _mapped(M.membership),
    "member_share": _mapped(lambda f, d: M.membership(f, d).select("system_id", "month", F.when(F.col("member") + F.col("casual") > 0, F.col("member") / (F.col("member") + F.col("casual"))).alias("share"))),
    "label_lost": _mapped(lost),
    "label_lost_shape": _mapped(lambda f, d: lost(f, d).groupBy("system_id").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.count("*").alias("months"), F.sum("trips").alias("trips"), F.max("trips").alias("peak"))),
    "unmapped_labels": _mapped(M.unmapped),
    "label_usage": _mapped(label_usage),
    "dim_membership": _mapped(O.dim_membership),
    "dim_date": _o(lambda f: O.dim_date(M.trusted(f))),
    "dim_station": lambda spark, sf: dim_station(spark, sf).withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)}),
    "stations": lambda spark, sf: stations(spark, sf).withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)}),
    "station_snapshots": lambda spark, sf: O.snapshots(D.listed(spark, sf)).withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)}),
    "station_bridge": station_bridge,
    "bridge_via": lambda spark, sf: station_bridge(spark, sf).groupBy("via").agg(F.count("*").alias("entries")),
    "canonical_identity": identity,
    "landing_csv": lambda spark, sf: D.landed_events(spark, sf).tables["trips"].select("source_period", "trip_id", "departure_raw", "departure_station_key", "departure_station_name", "bike_id"),
    "archive_members": lambda spark, sf: D.unpacked_events(spark, sf).groupBy("archive", "member").agg(F.sum(F.length("content")).alias("bytes"), F.sum(F.length("content") - F.length(F.replace(F.col("content").cast("string"), F.lit("\n"), F.lit("")))).alias("lines")),
    "landing_xlsx": lambda spark, sf: D.landed_workbooks(spark, sf).tables["trips"].select("source_period", "source_file", "trip_id", F.round(F.col("departure_raw").cast("double"), 6).alias("day_number"), "departure_station_key", "departure_station_name", "bike_id"),
    "landing_xlsx_audit": lambda spark, sf: D.landed_workbooks(spark, sf).audit.select("source_file", "kind", "source_records", "rows_landed", "rows_too_long"),
    "landing_reconciliation": lambda spark, sf: D.landed_events(spark, sf).audit.groupBy("source_period").agg(F.sum("source_records").alias("records"), F.sum("rows_landed").alias("rows_landed"), F.sum("lines_repaired").alias("lines_repaired"), F.sum("rows_too_long").alias("rows_too_long")),
    "clean_typed": lambda spark, sf: clean_typed(spark, sf).select("trip_id", "departure_ts", "departure_station_key", "departure_station_name", "duration_s", "departure_lat", "bike_id", "electric_bike"),
    "conformed_identity": lambda spark, sf: conformed(spark, sf).select("trip_id", "departure_station_id", "departure_station_match", "departure_label", "is_ebike"),
    "excel_signature": lambda spark, sf: C.serial_signature(D.read(spark, sf, "orders").select(F.lit("s").alias("system_id"), F.concat(F.lit("y"), (F.col("o_orderkey") % 4).cast("string")).alias("source_file"), F.when(F.col("o_orderkey") % 4 < 2, (36526 + F.col("o_orderkey") % F.when(F.col("o_orderkey") % 4 == 0, 12).otherwise(40)).cast("string")).alias("departure_raw")), 20),
    "weather_coverage": lambda spark, sf: L.weather_coverage(M.trusted(D.fact_o(spark, sf)).groupBy("system_id").agg(F.min("date_key").alias("a"), F.max("date_key").alias("b")), D.weather(spark, sf)),
    "shared_pairs": _table("events", shared_pairs),
    "discover_periods": _table("orders", periods),
    "manifest_merge": _table("supplier", merged_manifest),
    "archive_gaps": _table("orders", archive_gaps),
    "content_kinds": _table("pages", lambda p: p.select("page_id", A.content_kind(F.col("html").cast("binary")).alias("kind"))),
    "fact_by_canonical": canonical_fact,
    "stations_meta": lambda spark, sf: M.stations_meta(dim_station(spark, sf)),
    "unbridged": lambda spark, sf: D.fact_o(spark, sf).groupBy("system_id").agg(F.countDistinct(F.when(F.col("departure_station_id").like("%:name:%"), F.col("departure_station_id"))).alias("name_only"), F.countDistinct("departure_station_id").alias("identities")),
    "resolution_buckets": lambda spark, sf: resolution(D.fact_o(spark, sf)),
    "common_window": _o(lambda f: M.trusted(f).groupBy("system_id").agg(F.min("date_key").alias("a"), F.max("date_key").alias("b")).agg(F.max("a").alias("first_day"), F.min("b").alias("last_day"))),
    "calendar_coverage": _o(calendar_coverage),
    "monthly_pivot": _o(lambda f: M.trips_monthly(f).groupBy("month").pivot("system_id", [f"sys-{i}" for i in range(5)]).agg(F.sum("trips")).toDF("month", *[f"sys_{i}" for i in range(5)])),
    "month_gaps": _o(month_gaps),
    "far_fence": _o(far_fence),
    "any_value": buyers,
    "observed_funnel": observed_funnel,
    "run_metrics": SR.recorded,
    "dim_system": SR.systems,
    "publish_invariants": publish_invariants,
    "artifact_rows": lambda spark, sf: J.digests(J.tables(published(spark, sf))).select("artifact", "rows"),
    "reconcile_archive": _table("orders", reconciled_archive),
    "weather_years": _table("orders", years_of_weather),
    "row_funnel": lambda spark, sf: O.funnel(landed(spark, sf)),
    "dedupe_keep": kept_rows,
    "drop_counts": lambda spark, sf: landed(spark, sf).groupBy("system_id", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n")),
    "landing_audit": landing_audit,
    "date_order_evidence": _table("events", dated_files),
    "zone_trough": _table("events", trough),
    "utc_to_local": _table("events", local_times),
    "transposed_repair": _table("events", lambda e: e.select("event_id", O.repair_transposed(F.col("ts"), F.col("event_id") % 3 == 0).alias("ts"))),
    "parse_timestamps": _table("events", stamps),
    "norm_key": named(norm=X.norm_key),
    "norm_name": _table("documents", lambda d: d.select("doc_id", F.md5(X.norm_name(F.col("text"))).alias("norm"))),
    "bridge_name": named(norm=X.bridge_name),
    "id_prefix": named(prefix=X.id_prefix, label=X.without_prefix),
    "display_label": named(label=X.display_label),
    "sql_norm_key": written("SELECT s_suppkey, norm_key(s) AS norm FROM dock_names", dock_names=_table("supplier", names)),
    "sql_bridge_name": written("SELECT s_suppkey, bridge_name(s) AS norm FROM dock_names", dock_names=_table("supplier", names)),
    "sql_id_prefix": written("SELECT s_suppkey, id_prefix(s) AS prefix, without_prefix(s) AS label FROM dock_names", dock_names=_table("supplier", names)),
    "sql_display_label": written("SELECT s_suppkey, display_label(s) AS label FROM dock_names", dock_names=_table("supplier", names)),
    "sql_haversine": written("SELECT station_id, round(hav(lat, lon, 45.5, -73.6), 3) AS m FROM docks", docks=D.docks),
    "sql_parse_timestamps": written("SELECT event_id, k, parse_ts_ord(s, date_order) AS parsed FROM stamp_texts", stamp_texts=_table("events", stamp_texts)),
    "haversine": lambda spark, sf: D.docks(spark, sf).select("station_id", F.round(X.hav(F.col("lat"), F.col("lon"), F.lit(45.5), F.lit(-73.6)), 3).alias("m")),
    "nearest_station": lambda spark, sf: O.nearest(D.places(spark, sf), D.docks(spark, sf)).withColumn("dist", F.round("dist", 3)),
    "scrape_links": _table("pages", links),
    "range_join": range_join,
    "semi_anti": semi_anti,
    "self_theta": _table("events", shared_bikes),
    "phantom_days": _r(phantom_days),
    "literal_null_labels": _table("supplier", null_labels),
    "containment": containment,
    "id_match_share": _o(lambda f: f.groupBy("system_id").agg((F.count_if(F.array_contains("quality_flags", "station_matched_by_name")) / F.count("*")).alias("by_name"))),
    "model_days": _model(lambda d: d.groupBy("system_id", F.coalesce("reason", F.lit("used")).alias("reason")).agg(F.count("*").alias("days"), F.sum("trips").alias("trips"))),
    "reference_year": _model(S.reference_year),
    "weather_envelope": _model(S.envelope),
    "month_blocks": _model(S.month_blocks),
    "trend_by_temperature": _model(trend),
    "ols_fit": _model(S.fit),
    "scenario_predictions": _model(predictions),
    "scenario_ranges": _model(lambda d: S.ranges(d).select("system_id", "month", *[F.round(f"{c}_{n}", 6).alias(f"{c}_{n}") for c in S.WEATHER for n in ("min", "max")])),
    "scenario_refusals": _model(refused),
    "ols_moments": _model(lambda d: S.moments(S.fit(d), d).select("system_id", "name", F.abs(F.round("moment", 6)).alias("moment"))),
    "busiest_day": lambda spark, sf: S.busiest_day(model_days(spark, sf)),
    "weighted_centroid": centroid,
    "month_index": _table("orders", lambda o: o.select((F.year("o_orderdate").cast("long") * 12 + F.month("o_orderdate") - 1).alias("idx"), F.date_format("o_orderdate", "yyyy-MM").alias("key")).distinct()),
    "flow_rate": _o(flow_rate),
    "hourly_shares": _r(hourly_shares),
    "dwell_grid_share": _r(grid_share),
    "ebike_percent": _o(lambda f: M.ebike_share(f, ["sys-0", "sys-2"]).select("system_id", "month", (100 * F.col("ebike") / F.col("classified")).alias("percent"))),
    "peak_ratio": _o(lambda f: M.seasonality(f, SAMPLE_FIRST_YEAR).groupBy("system_id").agg((F.max("mean_trips") / F.min("mean_trips")).alias("ratio"), F.max_by("month_of_year", F.struct("mean_trips", "month_of_year")).alias("peak_month"))),
}

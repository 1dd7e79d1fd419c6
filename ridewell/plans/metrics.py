"""Published metrics over fact_trips and its dimensions; each returns a small table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X

#: Admission thresholds, all in one place.
STUB_DAYS, EBIKE_SHARE, MIN_EVENTS, BIKE_COVERAGE, DAY_S, FIRST_YEAR = 3, 0.5, 100, 0.99, 86400, 2017
TIERS = {"top_8": 8, "top_10": 10, "top_100": 100, "top_1000": 1000}


def month_text(c: str = "trip_month") -> Column:
    return F.date_format(c, "yyyy-MM")


def trusted(fact: DataFrame) -> DataFrame:
    return fact.filter(~F.array_contains("quality_flags", "implausible_date"))


def month_roll(fact: DataFrame) -> DataFrame:
    """One pass over the fact: each month's trusted trips and days, and whether too few days were observed.

    Too few are three or less, and any missing day in a system's last month.
    """
    ok = ~F.array_contains("quality_flags", "implausible_date")
    days = fact.groupBy("system_id", "trip_month", F.when(ok, F.col("date_key")).alias("_day")).agg(F.count("*").alias("n"))
    months = days.groupBy("system_id", "trip_month").agg(F.count("_day").alias("days_observed"), F.coalesce(F.sum(F.when(F.col("_day").isNotNull(), F.col("n"))), F.lit(0)).alias("trips"))
    # A row for each month of a system.
    last = F.max("trip_month").over(Window.partitionBy("system_id"))
    rows = months.withColumns({"days_in_month": F.dayofmonth(F.last_day("trip_month")).cast("long"), "last_month": last}).filter("trips > 0")
    return rows.withColumn("stub", (F.col("days_observed") <= STUB_DAYS) | ((F.col("trip_month") == F.col("last_month")) & (F.col("days_observed") < F.col("days_in_month"))))


def incomplete_months(fact: DataFrame) -> DataFrame:
    """Months with few observed days, and each system's last month where days are missing."""
    return month_roll(fact).filter("stub").select("system_id", "trip_month", "days_observed", "days_in_month", "trips")


def complete(fact: DataFrame) -> DataFrame:
    """Trusted trips of complete months. What is broadcast has at most a row for each month of each system."""
    return trusted(fact).join(F.broadcast(incomplete_months(fact).select("system_id", "trip_month")), ["system_id", "trip_month"], "left_anti")


def trips_monthly(fact: DataFrame) -> DataFrame:
    return month_roll(fact).filter("not stub").select("system_id", month_text().alias("month"), "trips")


def seasonality(fact: DataFrame, first_year: int) -> DataFrame:
    monthly = month_roll(fact).filter("not stub").filter(F.year("trip_month") >= first_year).select("system_id", "trip_month", F.col("trips").alias("n"))
    return monthly.groupBy("system_id", F.month("trip_month").cast("long").alias("month_of_year")).agg(F.round(F.avg("n")).cast("long").alias("mean_trips"), F.count("*").alias("months"))


def stations_yearly(fact: DataFrame) -> DataFrame:
    return complete(fact).groupBy("system_id", F.col("trip_year").alias("year")).agg(F.countDistinct("departure_station_id").alias("stations"))


def ebike_share(fact: DataFrame, supported: list[str]) -> DataFrame:
    rows = complete(fact).filter(F.col("system_id").isin(*supported)).groupBy("system_id", month_text().alias("month")).agg(F.count_if("is_ebike").alias("ebike"), F.count("is_ebike").alias("classified"), F.count("*").alias("trips"))
    return rows.filter(F.col("classified") >= EBIKE_SHARE * F.col("trips"))


def duration(fact: DataFrame, longest: int = DAY_S) -> DataFrame:
    rows = trusted(fact).filter(F.col("return_ts").isNotNull() & F.col("duration_final_s").between(1, longest))
    return rows.groupBy("system_id").agg(*[X.whole(F.percentile("duration_final_s", p)).alias(n) for n, p in (("p25_s", 0.25), ("median_s", 0.5), ("p75_s", 0.75))], F.count("*").alias("n"))


def linked(fact: DataFrame) -> DataFrame:
    return trusted(fact).filter("departure_station_id is not null and return_station_id is not null")


def net_flow(fact: DataFrame) -> DataFrame:
    """Returns minus departures of each station, over trips that have both."""
    rows = linked(fact)
    out = rows.select("system_id", F.col("departure_station_id").alias("station_id"), F.lit(-1).alias("v"))
    back = rows.select("system_id", F.col("return_station_id").alias("station_id"), F.lit(1).alias("v"))
    return out.unionByName(back).groupBy("system_id", "station_id").agg(F.sum("v").alias("net"))


def counted_pairs(fact: DataFrame) -> DataFrame:
    return linked(fact).groupBy("system_id", "departure_station_id", "return_station_id").agg(F.count("*").alias("trips"))


def pairs(fact: DataFrame) -> DataFrame:
    """Pairs of stations by rank. Filter on rk, so that not all of a system's pairs meet in one task."""
    order = Window.partitionBy("system_id").orderBy(F.desc("trips"), "departure_station_id", "return_station_id")
    return counted_pairs(fact).withColumn("rk", F.row_number().over(order))


def flows(fact: DataFrame) -> DataFrame:
    """Concentration of trips on pairs of stations, round trips, and trips without a return station."""
    n = counted_pairs(fact)
    round_trip = F.when(F.col("departure_station_id") == F.col("return_station_id"), F.col("trips")).otherwise(0)
    total = n.groupBy("system_id").agg(F.count("*").alias("pairs"), F.sum("trips").alias("linked_trips"), F.sum(round_trip).alias("round_trips"))
    # Only the first thousand of a system are ranked, which Spark takes from each task before the shuffle.
    top = pairs(fact).filter(F.col("rk") <= max(TIERS.values()))
    tiers = top.groupBy("system_id").agg(*[F.sum(F.when(F.col("rk") <= k, F.col("trips")).otherwise(0)).alias(t) for t, k in TIERS.items()])
    total = total.join(tiers, "system_id").select("system_id", "pairs", "linked_trips", *TIERS, "round_trips")
    lost = trusted(fact).groupBy("system_id").agg(F.count_if(F.col("return_station_id").isNull()).alias("no_return"))
    return total.join(lost, "system_id")


def top_pairs(fact: DataFrame, stations: DataFrame, k: int = 8) -> DataFrame:
    names = stations.select("system_id", "station_id", "station_name")
    top = pairs(fact).filter(F.col("rk") <= k)
    for end in ("departure", "return"):
        top = top.join(names.toDF("system_id", f"{end}_station_id", f"{end}_name"), ["system_id", f"{end}_station_id"], "left")
    return top.select("system_id", F.col("rk").cast("long").alias("rk"), "departure_station_id", "return_station_id", "departure_name", "return_name", "trips")


def hourly(fact: DataFrame, first_year: int) -> DataFrame:
    rows = complete(fact).filter("departure_station_id is not null and return_station_id is not null and return_ts is not null").filter(F.col("trip_year") >= first_year)
    ends = F.explode(F.array(F.struct(F.hour("departure_ts").alias("h"), F.lit(1).alias("dep"), F.lit(0).alias("ret")), F.struct(F.hour("return_ts").alias("h"), F.lit(0).alias("dep"), F.lit(1).alias("ret"))))
    return rows.select("system_id", ends.alias("e")).groupBy("system_id", F.col("e.h").cast("long").alias("hour")).agg(F.sum("e.dep").alias("departures"), F.sum("e.ret").alias("returns"))


def hourly_basis(fact: DataFrame, first_year: int) -> DataFrame:
    rows = complete(fact).filter("departure_station_id is not null and return_station_id is not null and return_ts is not null").filter(F.col("trip_year") >= first_year)
    return rows.groupBy("system_id").agg(F.count("*").alias("linked_trips"), F.countDistinct("date_key").alias("days"), F.count_if(X.on_hour(F.col("departure_ts")) & X.on_hour(F.col("return_ts"))).alias("on_hour_grid"))


def hourly_net(hours: DataFrame, basis: DataFrame) -> DataFrame:
    """What each hour gains or loses: returns less departures, in per cent of the linked trips and for each day, from hourly() and hourly_basis()."""
    net = F.col("returns") - F.col("departures")
    # Both have a row for each system or hour of one.
    return hours.join(basis, "system_id").select("system_id", "hour", (100 * net / F.col("linked_trips")).alias("share"), (net / F.col("days")).alias("per_day"), (F.col("on_hour_grid") / F.col("linked_trips")).alias("grid"))


def dwell_totals(yearly: DataFrame) -> DataFrame:
    """Per system, from dwell(): its eras, the latest year of twelve months (the latest at all if none has), and the shares of whole hours and of moved bikes."""
    latest = F.coalesce(F.max(F.when(F.col("months") == 12, F.col("year"))), F.max("year"))
    stood, moved = F.sum("intervals"), F.sum("relocated")
    return yearly.groupBy("system_id").agg(
        F.countDistinct("era_first_year", "era_last_year").alias("eras"), latest.alias("latest_full_year"),
        F.try_divide(F.sum("on_hour_grid"), stood).alias("grid"), F.try_divide(moved, stood + moved).alias("relocated"),
    )


def rebalancing(fact: DataFrame) -> DataFrame:
    """Yearly sum of the stations' absolute daily net flows, over days with a departure."""
    rows = complete(fact).filter("departure_station_id is not null and return_station_id is not null and return_ts is not null")
    days = rows.select("system_id", "trip_year", F.col("date_key").alias("d")).distinct()
    end = lambda ts, sid, v: F.struct(F.col(ts).cast("date").alias("d"), F.col(sid).alias("sid"), F.lit(v).alias("v"))
    ev = rows.select("system_id", F.explode(F.array(end("departure_ts", "departure_station_id", -1), end("return_ts", "return_station_id", 1))).alias("e")).select("system_id", "e.*")
    # Net flows first: the join with operating days then sees a row for each station and day only.
    net = ev.groupBy("system_id", "d", "sid").agg(F.sum("v").alias("net"))
    daily = net.groupBy("system_id", "d").agg(F.sum(F.abs("net")).alias("abs_net"))
    yearly = daily.join(days, ["system_id", "d"]).groupBy("system_id", "trip_year").agg(F.count("*").alias("days"), F.sum("abs_net").alias("abs_net"))
    counts = rows.groupBy("system_id", "trip_year").agg(F.count("*").alias("linked_trips"), F.countDistinct("trip_month").alias("months"))
    return yearly.join(counts, ["system_id", "trip_year"]).select("system_id", F.col("trip_year").alias("year"), "days", "months", "abs_net", "linked_trips")


def full_years(yearly: DataFrame, fact: DataFrame) -> DataFrame:
    """Years that lie wholly between a system's first and last trusted trip."""
    span = trusted(fact).groupBy("system_id").agg(F.min("date_key").alias("a"), F.max("date_key").alias("b"))
    y = F.col("year").cast("int")
    inside = (F.make_date(y, F.lit(1), F.lit(1)) >= F.col("a")) & (F.make_date(y, F.lit(12), F.lit(31)) <= F.col("b"))
    return yearly.join(F.broadcast(span), "system_id").withColumn("full_year", inside).drop("a", "b")


def headline_year(full: DataFrame) -> DataFrame:
    """The latest year that is full in every system."""
    systems = full.select("system_id").distinct().agg(F.count("*").alias("systems"))
    every = full.filter("full_year").groupBy("year").agg(F.countDistinct("system_id").alias("n"))
    return every.join(F.broadcast(systems), F.col("n") == F.col("systems")).agg(F.max("year").alias("headline_year"))


def bike_coverage(fact: DataFrame) -> DataFrame:
    rows = complete(fact).groupBy("system_id", F.col("trip_year").alias("year")).agg(F.count("*").alias("trips"), F.count("bike_id").alias("with_bike_id"))
    return rows.withColumn("coverage", F.col("with_bike_id") / F.col("trips"))


def bike_eras(coverage: DataFrame, least: float = BIKE_COVERAGE) -> DataFrame:
    """Runs of years with enough bike ids: system_id, lo, hi."""
    good = coverage.filter(F.col("coverage") >= least)
    island = F.col("year") - F.row_number().over(Window.partitionBy("system_id").orderBy("year"))
    return good.withColumn("island", island).groupBy("system_id", "island").agg(F.min("year").alias("lo"), F.max("year").alias("hi")).drop("island")


def dwell(fact: DataFrame, eras: DataFrame) -> DataFrame:
    """How long bikes stand at a dock, by era and year of arrival; moved bikes and disorder are counted apart."""
    # A row for each run of years of a system. Shuffled to it by system, all trips of one would be in a task, and the chains would be sorted there.
    eras = F.broadcast(eras.withColumnRenamed("system_id", "_s"))
    rows = complete(fact).filter("bike_id is not null").join(eras, (F.col("system_id") == F.col("_s")) & F.col("trip_year").between(F.col("lo"), F.col("hi"))).drop("_s")
    chain = Window.partitionBy("system_id", "bike_id", "lo").orderBy(F.asc_nulls_last("departure_ts"), F.asc_nulls_last("return_ts"), F.asc_nulls_last("departure_station_id"), F.asc_nulls_last("return_station_id"))
    nxt = rows.withColumns({"next_ts": F.lead("departure_ts").over(chain), "next_station": F.lead("departure_station_id").over(chain)})
    nxt = nxt.filter("return_ts is not null and return_station_id is not null and next_ts is not null and next_station is not null").filter(F.year("return_ts").between(F.col("lo"), F.col("hi")))
    same, s = F.col("next_station") == F.col("return_station_id"), F.col("dwell_s")
    stay = same & (s >= 0)
    return nxt.withColumn("dwell_s", X.seconds_between(F.col("return_ts"), F.col("next_ts"))).groupBy("system_id", F.col("lo").alias("era_first_year"), F.col("hi").alias("era_last_year"), F.year("return_ts").cast("long").alias("year")).agg(
        F.countDistinct(F.month("return_ts")).alias("months"), F.count_if(stay).alias("intervals"), F.count_if(~same).alias("relocated"), F.count_if(same & (s < 0)).alias("out_of_order"),
        F.count_if(stay & (s % 3600 == 0)).alias("on_hour_grid"), *[X.whole(F.percentile(F.when(stay, s), p)).alias(n) for n, p in (("p25_s", 0.25), ("median_s", 0.5), ("p75_s", 0.75))],
    )


def membership(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Trips by membership group and month."""
    rows = complete(fact).join(dim.select("system_id", "membership_raw", "membership_group"), ["system_id", "membership_raw"], "left")
    g = F.col("membership_group")
    return rows.groupBy("system_id", month_text().alias("month")).agg(F.count_if(g == "member").alias("member"), F.count_if(g == "casual").alias("casual"), F.count_if(~g.isin("member", "casual")).alias("other"), F.count_if(F.col("membership_raw").isNull()).alias("unlabelled"), F.count("*").alias("trips"))


def label_lost(monthly: DataFrame, unreliable: Column) -> DataFrame:
    """Months whose labels cannot carry a share, and why."""
    few = (F.col("member") <= 0) | (F.col("casual") <= 0)
    basis = F.when(unreliable, "labelling era unreliable").when(few, "a group is missing").when(F.col("unlabelled") > F.col("member") + F.col("casual"), "mostly unlabelled")
    return monthly.withColumn("basis", basis).filter("basis is not null")


def unmapped(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Labels in trusted trips that no group claims; publishing refuses while there are any."""
    mapped = dim.filter("membership_group is not null").select("system_id", "membership_raw")
    return trusted(fact).filter("membership_raw is not null").join(mapped, ["system_id", "membership_raw"], "left_anti").groupBy("system_id", "membership_raw").agg(F.count("*").alias("n"))


def exclusions(fact: DataFrame) -> DataFrame:
    has = lambda f: F.count_if(F.array_contains("quality_flags", f))
    return fact.groupBy("system_id").agg(has("unterminated").alias("unterminated"), has("station_matched_by_name").alias("matched_by_name"), F.count("*").alias("trips"))


def meta(fact: DataFrame, stations: DataFrame) -> DataFrame:
    ok = ~F.array_contains("quality_flags", "implausible_date")
    rows = fact.groupBy("system_id").agg(F.count("*").alias("trips"), F.min(F.when(ok, F.col("date_key"))).cast("string").alias("first_trip"), F.max(F.when(ok, F.col("date_key"))).cast("string").alias("last_trip"), F.countDistinct("departure_station_id").alias("identities"), F.count_if("has_quality_issue").alias("flagged"))
    live = stations.groupBy("system_id").agg(F.count_if("is_active").alias("active_stations"))
    return rows.join(live, "system_id", "left")


def stations_meta(stations: DataFrame) -> DataFrame:
    return stations.groupBy("system_id").agg(F.count_if(F.col("lat").isNull()).alias("no_coordinates"), F.count_if(F.col("lifetime_events") < MIN_EVENTS).alias("few_events"), F.count("*").alias("stations"))


def stations(dim: DataFrame, net: DataFrame, least: int = MIN_EVENTS) -> DataFrame:
    """Stations with a place and enough events, and their net flow; refuse_missing_net() is for publishing."""
    shown = dim.filter(F.col("lat").isNotNull() & (F.col("lifetime_events") >= least))
    return shown.join(net, ["system_id", "station_id"], "left").select("system_id", "station_id", "station_name", "lat", "lon", "lifetime_events", "net", "is_active")


def flag_counts(fact: DataFrame) -> DataFrame:
    return fact.select("system_id", F.explode("quality_flags").alias("flag")).groupBy("system_id", "flag").agg(F.count("*").alias("n"))

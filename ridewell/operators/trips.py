"""Clean, conform and model: from landed rows to the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X

FLAGS = ("unterminated", "negative_duration", "zero_duration", "over_24h", "same_station_under_2min", "no_return_station", "station_matched_by_name", "implausible_date")


def date_order(raw: DataFrame) -> DataFrame:
    """Per file: what its slashed dates prove about the order of day, month and year."""
    first = F.regexp_extract("departure_raw", r"^(\d{1,2})/", 1).try_cast("int")
    second = F.regexp_extract("departure_raw", r"^\d{1,2}/(\d{1,2})/", 1).try_cast("int")
    seen = raw.filter(F.col("departure_raw").like("%/%")).groupBy("system_id", "source_file").agg(
        F.count_if(first > 12).alias("day_evidence"), F.count_if(second > 12).alias("month_evidence"),
        F.count_if(F.col("departure_raw").rlike(r"^\d{4}/")).alias("year_evidence"), F.count("*").alias("slashed_rows"),
    )
    d, m, y = F.col("day_evidence") > 0, F.col("month_evidence") > 0, F.col("year_evidence") > 0
    return seen.withColumn("date_order", F.when(y & ~d & ~m, "year").when(y | (d & m), "conflict").when(d, "day").when(m, "month").otherwise("ambiguous"))


def resolve_orders(found: dict[tuple[str, str], str], declared: dict[tuple[str, str], str]) -> dict[tuple[str, str], str]:
    """Order of each file: derived, or declared where it is ambiguous. Anything else is refused."""
    out = {}
    for key, order in found.items():
        if order == "conflict":
            raise ValueError(f"{key}: two date orders in one file")
        if order == "ambiguous":
            if declared.get(key) not in ("day", "month"):
                raise ValueError(f"{key}: the date order is ambiguous and none is declared")
            out[key] = declared[key]
        else:
            if key in declared:
                raise ValueError(f"{key}: a date order is declared although the file proves one")
            out[key] = order
    if stale := set(declared) - set(found):
        raise ValueError(f"declared date orders of unknown files: {sorted(stale)}")
    return out


def zone_basis(times: DataFrame, offsets: DataFrame, least: int = 5000) -> DataFrame:
    """Per file: local or UTC clock, by the hour with the fewest trips. times: system_id, source_file, ts."""
    hourly = times.filter("ts is not null").groupBy("system_id", "source_file", F.hour("ts").alias("h")).agg(F.count("*").alias("n"))
    total = hourly.groupBy("system_id", "source_file").agg(F.sum("n").alias("rows_parsed"), F.min_by("h", F.struct("n", "h")).cast("long").alias("trough_hour"))
    gap = lambda h: F.abs(h - 4) <= 2
    basis = F.when(F.col("rows_parsed") < least, "unknown").when(gap(F.col("trough_hour")), "local").when(gap(F.pmod(F.col("trough_hour") - F.col("utc_offset"), F.lit(24))), "utc").otherwise("unknown")
    return total.join(offsets, "system_id").withColumn("tz_basis", basis)


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row of each group of equal keys, the first in a total order."""
    return rows.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_at = 1").drop("_at")


def drop_reason(duplicate: Column, deduped: Column) -> Column:
    """Why a landed row is dropped, each row for one reason; null if it is kept."""
    no_time = F.col("departure_ts").isNull()
    no_station = F.col("departure_station_key").isNull() & F.col("departure_station_name").isNull()
    return F.when(no_time, "no_time").when(no_station, "no_station").when(deduped & duplicate, "duplicate")


def funnel(rows: DataFrame) -> DataFrame:
    """landed, kept and dropped rows by reason (column `reason`), and what they leave unexplained."""
    return rows.agg(
        F.count("*").alias("landed"), F.count_if(F.col("reason").isNull()).alias("kept"),
        *[F.count_if(F.col("reason") == r).alias(r) for r in ("no_time", "no_station", "duplicate")],
    ).withColumn("residual", F.col("landed") - F.col("kept") - F.col("no_time") - F.col("no_station") - F.col("duplicate"))


def repair_transposed(ts: Column, wrong: Column) -> Column:
    """Day and month swapped back where `wrong` says so and the day can be a month."""
    swapped = F.make_timestamp_ntz(F.year(ts), F.dayofmonth(ts), F.month(ts), F.hour(ts), F.minute(ts), F.date_part(F.lit("SECOND"), ts).cast("decimal(16,6)"))
    return F.when(wrong & (F.dayofmonth(ts) <= 12), swapped).otherwise(ts)


def conform(trips: DataFrame, as_of: str, first_year: int = 2009) -> DataFrame:
    """Adds month, year, day, duration and quality flags. Rows are marked, never removed.

    trips: departure_ts, return_ts, departure_station_id, return_station_id,
    departure_station_match and duration_s (null where the source has none). as_of stands for today.
    """
    dep, ret = F.col("departure_ts"), F.col("return_ts")
    out = trips.withColumns({"trip_month": X.month_of(dep), "trip_year": F.year(dep).cast("long"), "date_key": dep.cast("date"), "duration_final_s": F.coalesce("duration_s", X.seconds_between(dep, ret))})
    d = F.col("duration_final_s")
    tests = (
        ret.isNull(), ret < dep, d == 0, d > 86400,
        (F.col("departure_station_id") == F.col("return_station_id")) & (d < 120),
        F.col("return_station_id").isNull() & ret.isNotNull(), F.col("departure_station_match") == "name",
        (F.year(dep) < first_year) | (dep > F.lit(as_of).cast("timestamp_ntz") + F.expr("interval 2 day")),
    )
    flags = F.array_compact(F.array(*[F.when(t, name) for t, name in zip(tests, FLAGS, strict=True)]))
    return out.withColumn("quality_flags", flags).withColumn("has_quality_issue", F.size("quality_flags") > 0)


def snapshots(stations: DataFrame) -> DataFrame:
    """The latest known name and position of each station, and when it was first and last listed."""
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("source_period", c))).alias(c)
    return stations.filter("station_key is not null and lat is not null and lon is not null").groupBy("system_id", F.concat_ws(":", "system_id", "station_key").alias("station_id")).agg(
        latest("station_name"), latest("lat"), latest("lon"), F.min("source_period").alias("first_seen_period"), F.max("source_period").alias("last_seen_period")
    )


def nearest(places: DataFrame, docks: DataFrame, within_m: float = 50, apart_m: float = 100) -> DataFrame:
    """era_id and station_id where one dock is within reach and the next one is not near.

    places: era_id, lat, lon; docks: station_id, lat, lon. Both are looked up by cells of a grid a
    little larger than apart_m, so a place meets the docks around it only, however many there are.
    """
    step = apart_m / 111_000.0 * 1.1
    cell = lambda df: df.withColumns({"_y": F.floor(F.col("lat") / step), "_band": F.floor(F.col("lat")).cast("int")})
    # Degrees of longitude shrink with the cosine of the latitude; a whole degree is one band.
    wide = lambda band: F.lit(step) / F.cos(F.radians(F.least(F.greatest(F.abs(band), F.abs(band + 1)), F.lit(89))))
    around = F.array(*map(F.lit, (-1, 0, 1)))
    p = cell(places.filter("lat is not null and lon is not null")).withColumn("_y", F.explode(F.transform(around, lambda d: F.col("_y") + d)))
    p = p.withColumn("_band", F.explode(F.transform(around, lambda d: F.col("_band") + d)))
    p = p.withColumn("_x", F.explode(F.transform(around, lambda d: F.floor(F.col("lon") / wide(F.col("_band"))) + d)))
    d = cell(docks.filter("lat is not null and lon is not null")).withColumn("_x", F.floor(F.col("lon") / wide(F.col("_band"))))
    d = d.select("station_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), "_x", "_y", "_band")
    met = p.join(d, ["_x", "_y", "_band"]).withColumn("dist", X.hav(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")))
    order = Window.partitionBy("era_id").orderBy("dist", "station_id")
    ranked = met.withColumns({"rn": F.row_number().over(order), "next_dist": F.lead("dist").over(order)})
    return ranked.filter((F.col("rn") == 1) & (F.col("dist") <= within_m) & (F.col("next_dist").isNull() | (F.col("next_dist") > apart_m))).select("era_id", "station_id", "dist")


def bridge(gbfs: DataFrame, observed: DataFrame, orphans: DataFrame, prefix: str) -> DataFrame:
    """era_id, canonical_id and via: ids of older eras on today's docks, by the most certain of six matches.

    gbfs: station_id, short_name, name, lat, lon. observed: era_id, nm, lat, lon of stations known by
    name only. orphans: era_id, label, lat, lon of snapshot stations; those that a code or key
    already names are left out here.
    """
    docks = gbfs.withColumn("nm", X.bridge_name(F.col("name")))
    one = lambda df, via: df.select("era_id", "station_id", F.lit(via).alias("via"))
    code = one(docks.filter("short_name is not null").withColumn("era_id", F.concat_ws(":", F.lit(prefix), "short_name")), "code")
    pk = one(docks.withColumn("era_id", F.concat_ws(":", F.lit(prefix), "station_id")), "pk")
    name = one(observed.join(docks.select("nm", "station_id"), "nm"), "name")
    geo = one(nearest(observed.join(name, "era_id", "left_anti"), docks), "geo")
    lost = orphans.filter(~F.col("era_id").like("%:name:%")).join(code, "era_id", "left_anti").join(pk, "era_id", "left_anti").withColumn("nm", X.bridge_name(F.col("label")))
    pairs = lost.join(docks.select("nm", "station_id", F.col("name").alias("_name"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon")), "nm")
    there = F.coalesce(X.placed(F.col("lat"), F.col("lon")), F.lit(False))
    near = there & (X.hav(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")) <= 100)
    same = ~there & (F.lower(F.trim("label")) == F.lower(F.trim("_name")))
    pk_name = one(pairs.filter(near | same), "pk-name")
    pk_geo = one(nearest(lost.join(pk_name, "era_id", "left_anti"), docks), "pk-geo")
    rank = F.array_position(F.array(*map(F.lit, ("code", "pk", "name", "pk-name", "pk-geo", "geo"))), F.col("via"))
    every = reduce(DataFrame.unionByName, (code, pk, name, geo, pk_name, pk_geo)).withColumn("_rank", rank)
    return keep_first(every, ["era_id"], ["_rank", "station_id"]).select("era_id", F.concat(F.lit(f"{prefix}:s"), "station_id").alias("canonical_id"), "via")


def usage(trips: DataFrame) -> DataFrame:
    """Use of stations at both ends of the trips: system_id, station_id, label, events, first_ts, last_ts.

    A station has a row for each label and end. Counts and times have a fixed width, so they are
    added up in hash maps before the shuffle; the latest label is then told from these rows, and no
    trip is sorted for it.
    """
    ends = [trips.filter(F.col(f"{e}_station_id").isNotNull()).groupBy("system_id", F.col(f"{e}_station_id").alias("station_id"), F.col(f"{e}_label").alias("label")).agg(F.count("*").alias("events"), F.min(f"{e}_ts").alias("first_ts"), F.max(f"{e}_ts").alias("last_ts")) for e in ("departure", "return")]
    return ends[0].unionByName(ends[1]).withColumn("label", X.display_label(F.col("label")))


def latest_label(ts: str = "last_ts") -> Column:
    return F.max_by("label", F.when(F.col("label").isNotNull() & F.col(ts).isNotNull(), F.struct(ts, "label")))


def station_identity(used: DataFrame, bridged: DataFrame) -> DataFrame:
    """system_id, source_id and canonical_id of the stations of usage(): a name-only id joins the busiest station that bears its name."""
    step = used.join(bridged.select(F.col("era_id").alias("station_id"), "canonical_id"), "station_id", "left")
    step = step.withColumn("mid", F.coalesce("canonical_id", "station_id"))
    mids = step.groupBy("system_id", "mid").agg(latest_label().alias("name"), F.sum("events").alias("events")).withColumn("key", F.lower(F.trim("name")))
    named = F.col("mid").like("%:name:%")
    best = mids.filter(~named & F.col("name").isNotNull()).groupBy("system_id", "key").agg(F.max_by("mid", F.struct("events", "mid")).alias("best"))
    out = mids.join(best, ["system_id", "key"], "left").select("system_id", "mid", F.when(named, F.coalesce("best", "mid")).otherwise(F.col("mid")).alias("canonical_id"))
    return step.select("system_id", F.col("station_id").alias("source_id"), "mid").distinct().join(out, ["system_id", "mid"]).select("system_id", "source_id", "canonical_id").distinct()


def dim_date(trips: DataFrame) -> DataFrame:
    """Every day from the first to the last trusted trip day."""
    span = trips.agg(F.min("date_key").alias("a"), F.max("date_key").alias("b"))
    days = span.filter("a is not null").select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date_key"))
    iso = (F.weekday("date_key") + 1).cast("long")
    return days.select("date_key", F.year("date_key").cast("long").alias("year"), F.month("date_key").cast("long").alias("month"), F.date_format("date_key", "yyyy-MM").alias("year_month"), iso.alias("iso_weekday"), (iso >= 6).alias("is_weekend"), X.season(F.month("date_key")).alias("season"))


def dim_membership(trips: DataFrame, mapping: DataFrame) -> DataFrame:
    """Labels in use with their group (null: not mapped) and how many labels their system has."""
    labels = trips.filter("membership_raw is not null").select("system_id", "membership_raw").distinct()
    return labels.join(mapping, ["system_id", "membership_raw"], "left").select("system_id", "membership_raw", "membership_group", F.count("*").over(Window.partitionBy("system_id")).alias("labels_in_system"))


def dim_station(used: DataFrame, identity: DataFrame, listed: DataFrame, gbfs: DataFrame) -> DataFrame:
    """Canonical stations of usage(): span and number of events, name and position from one source, active in their system's last six months."""
    uses = used.join(identity.withColumnRenamed("source_id", "station_id"), ["system_id", "station_id"])
    seen = uses.groupBy("system_id", F.col("canonical_id").alias("station_id")).agg(latest_label().alias("used_name"), F.min("first_ts").cast("date").alias("first_seen"), F.max("last_ts").cast("date").alias("last_seen"), F.sum("events").alias("lifetime_events"))
    # A row for each system, so that no task holds all stations of one.
    ends = uses.groupBy("system_id").agg(F.max("last_ts").cast("date").alias("_last"))
    live = gbfs.select("system_id", F.col("station_id").alias("_key"), F.col("name").alias("g_name"), F.col("lat").alias("g_lat"), F.col("lon").alias("g_lon"))
    s = listed.select("system_id", "station_id", F.col("station_name").alias("s_name"), F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"))
    rows = seen.withColumn("_key", F.regexp_replace("station_id", r"^[a-z-]+:s?", "")).join(s, ["system_id", "station_id"], "left").join(live, ["system_id", "_key"], "left").join(F.broadcast(ends), "system_id")
    lat, lon = F.coalesce("g_lat", "s_lat"), F.coalesce("g_lon", "s_lon")
    fits, live_fits = X.placed(lat, lon), F.coalesce(X.placed(F.col("g_lat"), F.col("g_lon")), F.lit(False))
    return rows.select(
        "system_id", "station_id", "first_seen", "last_seen", "lifetime_events",
        F.when(live_fits, F.coalesce("g_name", "used_name", "s_name")).otherwise(F.coalesce("used_name", "s_name")).alias("station_name"),
        F.when(fits, lat).alias("lat"), F.when(fits, lon).alias("lon"), (F.col("last_seen") >= F.add_months("_last", -6)).alias("is_active"),
    )


def fact_trips(trips: DataFrame, identity: DataFrame) -> DataFrame:
    """Trips with canonical stations at both ends. Only ids that change are joined; they are few beside the stations, and Spark sees how few."""
    identity = identity.filter("source_id <> canonical_id")
    for end in ("departure", "return"):
        ids = identity.select("system_id", F.col("source_id").alias(f"{end}_station_id"), F.col("canonical_id").alias(f"_{end}"))
        trips = trips.join(ids, ["system_id", f"{end}_station_id"], "left").withColumn(f"{end}_station_id", F.coalesce(f"_{end}", f"{end}_station_id")).drop(f"_{end}")
    return trips

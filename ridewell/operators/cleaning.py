"""Landed text to typed trips with a station identity at both ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from .trips import drop_reason

TEXTS = ("trip_id", "departure_station_key", "return_station_key", "departure_station_name", "return_station_name", "departure_borough", "return_borough", "membership_raw", "bike_id", "bike_model", "electric_bike")
DECIMALS = {"departure_lat": "departure_lat", "departure_lon": "departure_lon", "return_lat": "return_lat", "return_lon": "return_lon", "departure_temp": "departure_temp_c", "return_temp": "return_temp_c"}
WHOLES = ("duration_s", "distance_m", "stopover_s", "stopover_count")


def text(c: str) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def whole(c: str) -> Column:
    """Long of a decimal text; what is no number, or no long, is null."""
    return F.bround(X.number(F.col(c))).try_cast("long")


def typed(raw: DataFrame, orders: DataFrame, zones: DataFrame, *also: Column) -> DataFrame:
    """Landed trips with typed columns, and `also` made of the landed ones.

    orders: system_id, source_file, date_order of the files that write slashed dates; zones:
    system_id, zone. Text timestamps are read in their file's order; epoch milliseconds become the
    system's local time.
    """
    # Orders have a row for each file and grow with the archive, so how they are joined is left to Spark; zones have one for each system.
    rows = raw.join(orders, ["system_id", "source_file"], "left").join(F.broadcast(zones), "system_id", "left")
    order = F.coalesce("date_order", F.lit("month"))
    stamp = lambda end: F.coalesce(X.parse_ts_ord(F.col(f"{end}_raw"), order), X.to_local(F.col(f"{end}_ms").try_cast("long"), F.col("zone"))).alias(f"{end}_ts")
    return rows.select(
        "system_id", "source_period", "source_file", stamp("departure"), stamp("return"), *[text(c).alias(c) for c in TEXTS],
        *[X.number(F.col(c)).alias(n) for c, n in DECIMALS.items()], *[whole(c).alias(c) for c in WHOLES], *also,
    )


def usable_key(rows: DataFrame) -> DataFrame:
    """departure_station_key and _name by what they mean: the word NULL and empty text name no station."""
    return rows.withColumns({"departure_station_key": X.norm_key(F.col("departure_station_key")), "departure_station_name": F.when(X.norm_name(F.col("departure_station_name")).isNotNull(), F.col("departure_station_name"))})


def kept(rows: DataFrame) -> DataFrame:
    """Typed trips with a departure time and a departure station."""
    reason = drop_reason(F.lit(False), F.lit(False))
    meant = usable_key(rows.select(F.struct("*").alias("_row"), "departure_ts", "departure_station_key", "departure_station_name"))
    return meant.filter(reason.isNull()).select("_row.*")


def identified(trips: DataFrame, prefixed: tuple[str, ...], electric: dict[str, str]) -> DataFrame:
    """Adds station ids, how the departure was matched, labels and is_ebike.

    A station is named by the number in front of its name in the `prefixed` systems, else by its key,
    else by its name. electric tells each system's signal for e-bikes: `flag` (electric_bike) or
    `model` (bike_model); a system without any stays null, which means not published.
    """
    front = F.col("system_id").isin(*prefixed)

    def station(end: str) -> Column:
        key, name = X.norm_key(F.col(f"{end}_station_key")), F.col(f"{end}_station_name")
        number = F.nullif(X.id_prefix(name), F.lit(""))
        by_name = F.concat(F.col("system_id"), F.lit(":name:"), X.norm_name(name))
        return F.when(front & number.isNotNull(), F.concat_ws(":", "system_id", number)).when(key.isNotNull(), F.concat_ws(":", "system_id", key)).when(name.isNotNull(), by_name)

    def label(end: str) -> Column:
        name = F.col(f"{end}_station_name")
        return F.when(front, F.coalesce(X.without_prefix(name), name)).otherwise(name)

    has_number = front & F.nullif(X.id_prefix(F.col("departure_station_name")), F.lit("")).isNotNull()
    match = F.when(has_number | X.norm_key(F.col("departure_station_key")).isNotNull(), "id").otherwise("name")
    flags, models = ([s for s, how in electric.items() if how == kind] for kind in ("flag", "model"))
    ebike = F.when(F.col("system_id").isin(*flags) & F.col("electric_bike").isNotNull(), F.lower("electric_bike").isin("true", "1", "yes"))
    ebike = ebike.when(F.col("system_id").isin(*models) & F.col("bike_model").isNotNull(), F.upper("bike_model").like("EFIT%"))
    return trips.withColumns({
        "departure_station_id": station("departure"), "return_station_id": station("return"), "departure_station_match": match,
        "departure_label": label("departure"), "return_label": label("return"), "is_ebike": ebike,
    })


def clean_stations(raw: DataFrame) -> DataFrame:
    """Station snapshots, typed, each row once."""
    key, name = text("station_key"), text("station_name")
    rows = raw.filter(key.isNotNull() | name.isNotNull())
    return rows.select("system_id", "source_period", key.alias("station_key"), name.alias("station_name"), X.number(F.col("lat")).alias("lat"), X.number(F.col("lon")).alias("lon")).distinct()


def serial_signature(raw: DataFrame, least: int = 100) -> DataFrame:
    """Files whose spreadsheet serial dates never pass the 12th of a month: day and month were swapped before publishing."""
    day = F.dayofmonth(X.excel_ts(F.col("departure_raw")))
    seen = raw.groupBy("system_id", "source_file").agg(F.count(day).alias("serial_rows"), F.max(day).cast("long").alias("last_day"))
    return seen.filter((F.col("serial_rows") >= least) & (F.col("last_day") <= 12))

"""Scalar expressions of the trip tables: columns in, columns out, all within Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How a date begins, and the layouts with seconds and without that it then may have, tried in turn.
MONTH_FIRST = (
    (r"^\d{4}-", ("yyyy-MM-dd HH:mm:ss[.SSSSSS]",), ("yyyy-MM-dd H:mm",)),
    (r"^\d{1,2}/", ("M/d/yyyy H:mm:ss", "M/d/yy H:mm:ss"), ("M/d/yyyy H:mm", "M/d/yy H:mm")),
    (r"^\d{4}/", ("yyyy/M/d H:mm:ss",), ("yyyy/M/d H:mm",)),
)
DAY_FIRST = ((r"^\d{1,2}/", ("d/M/yyyy H:mm:ss", "d/M/yy H:mm:ss"), ("d/M/yyyy H:mm", "d/M/yy H:mm")),)
SECONDS = r":\d+:"
#: Two Earth radii, of station matching (m) and of weather distance (km).
STATION_RADIUS_M, WEATHER_RADIUS_KM = 6_371_000.0, 6371.0088
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(c: Column) -> Column:
    """Double of a decimal text, null for anything else."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def whole(c: Column) -> Column:
    """Long of a double, halves to even."""
    return F.bround(c).cast("long")


def excel_ts(s: Column) -> Column:
    """Spreadsheet serial day 20000..80000 as local time, to the microsecond."""
    d = number(s)
    micros = F.round(d * F.lit(86_400_000_000)).cast("long")
    return F.when(d.between(20000, 80000), F.timestamp_add("MICROSECOND", micros, F.to_timestamp_ntz(F.lit("1899-12-30"))))


def _parsed(s: Column, shapes: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...]) -> Column:
    """The text by the layouts of its shape: a row is parsed once or twice, not by every layout there is."""
    tried = lambda layouts: F.coalesce(*[F.try_to_timestamp(s, F.lit(f)).cast("timestamp_ntz") for f in layouts])
    out = F.lit(None).cast("timestamp_ntz")
    for begins, exact, short in reversed(shapes):
        out = F.when(s.rlike(begins), F.when(s.rlike(SECONDS), tried(exact)).otherwise(tried(short))).otherwise(out)
    return out


def parse_month_first(s: Column) -> Column:
    return _parsed(s, MONTH_FIRST)


def parse_day_first(s: Column) -> Column:
    return _parsed(s, DAY_FIRST)


def fix_short_year(ts: Column) -> Column:
    return F.when(F.year(ts) < 100, ts + F.expr("interval 2000 year")).otherwise(ts)


def parse_ts_ord(s: Column, order: Column) -> Column:
    """Serial day, else the layouts of the file's date order."""
    return fix_short_year(F.coalesce(excel_ts(s), F.when(order == "day", parse_day_first(s)).otherwise(parse_month_first(s))))


def as_local(ts: Column, zone: Column, basis: Column) -> Column:
    """UTC wall clock to the zone's where the file was proven to be UTC."""
    return F.when(basis == "utc", F.convert_timezone(F.lit("UTC"), zone, ts)).otherwise(ts)


def to_local(ms: Column, zone: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), zone, F.timestamp_millis(ms).cast("timestamp_ntz"))


def norm_key(s: Column) -> Column:
    s = F.when(F.upper(F.trim(s)) == "NULL", F.lit(None)).otherwise(F.trim(s))
    return F.nullif(F.regexp_replace(s, r"\.0+$", ""), F.lit(""))


def norm_name(s: Column) -> Column:
    s = F.trim(F.regexp_replace(F.lower(s), r"\s+", " "))
    return F.when(~s.isin("", "null"), s)


def id_prefix(s: Column) -> Column:
    return F.regexp_extract(s, r"^\s*(\d{3,4})\s", 1)


def without_prefix(s: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(s, r"^\s*\d{3,4}\s+", "")), F.lit(""))


def bridge_name(s: Column) -> Column:
    """Name for matching: lower case, parentheses gone, no spaces around / and -."""
    s = F.regexp_replace(F.lower(F.trim(s)), r"\s*\([^)]*\)", "")
    return F.trim(F.regexp_replace(s, r"\s*([/-])\s*", "$1"))


def hav(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = STATION_RADIUS_M) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(a))


def display_label(s: Column) -> Column:
    return F.when(F.upper(F.trim(s)) != "NULL", s)


def placed(lat: Column, lon: Column) -> Column:
    return lat.between(41, 84) & lon.between(-141, -52)


def seconds_between(a: Column, b: Column) -> Column:
    """Second boundaries between two local times."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", a), F.date_trunc("second", b))


def month_of(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def on_hour(ts: Column) -> Column:
    return F.pmod(F.unix_millis(ts.cast("timestamp")), F.lit(3_600_000)) == 0


def season(month: Column) -> Column:
    return F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring").when(month.isin(6, 7, 8), "summer").otherwise("autumn")

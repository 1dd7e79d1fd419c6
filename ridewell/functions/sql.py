"""The scalar expressions as SQL functions, for those who write queries as text; Catalyst inlines them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .exprs import DAY_FIRST, MONTH_FIRST, NUMBER, SECONDS, STATION_RADIUS_M


def _text(pattern: str) -> str:
    return "r'" + pattern + "'"


def _parsed(shapes: tuple) -> str:
    tried = lambda layouts: "coalesce(" + ", ".join(f"cast(try_to_timestamp(s, '{x}') as timestamp_ntz)" for x in layouts) + ")"
    cases = " ".join(f"WHEN s RLIKE {_text(begins)} THEN CASE WHEN s RLIKE {_text(SECONDS)} THEN {tried(exact)} ELSE {tried(short)} END" for begins, exact, short in shapes)
    return f"CASE {cases} END"


#: Name, parameters, result and body, each of which may use those before it.
FUNCTIONS = (
    ("number_of", "s STRING", "DOUBLE", f"CASE WHEN s RLIKE {_text(NUMBER)} THEN try_cast(s AS DOUBLE) END"),
    ("excel_ts", "s STRING", "TIMESTAMP_NTZ", "CASE WHEN number_of(s) BETWEEN 20000 AND 80000 THEN timestampadd(MICROSECOND, cast(round(number_of(s) * 86400000000) AS BIGINT), TIMESTAMP_NTZ '1899-12-30 00:00:00') END"),
    ("parse_month_first", "s STRING", "TIMESTAMP_NTZ", _parsed(MONTH_FIRST)),
    ("parse_day_first", "s STRING", "TIMESTAMP_NTZ", _parsed(DAY_FIRST)),
    ("fix_short_year", "ts TIMESTAMP_NTZ", "TIMESTAMP_NTZ", "CASE WHEN year(ts) < 100 THEN ts + INTERVAL 2000 YEAR ELSE ts END"),
    ("parse_ts_ord", "s STRING, date_order STRING", "TIMESTAMP_NTZ", "fix_short_year(coalesce(excel_ts(s), CASE WHEN date_order = 'day' THEN parse_day_first(s) ELSE parse_month_first(s) END))"),
    ("as_local", "ts TIMESTAMP_NTZ, zone STRING, basis STRING", "TIMESTAMP_NTZ", "CASE WHEN basis = 'utc' THEN convert_timezone('UTC', zone, ts) ELSE ts END"),
    ("to_local", "ms BIGINT, zone STRING", "TIMESTAMP_NTZ", "convert_timezone('UTC', zone, cast(timestamp_millis(ms) AS TIMESTAMP_NTZ))"),
    ("norm_key", "s STRING", "STRING", r"nullif(regexp_replace(CASE WHEN upper(trim(s)) <> 'NULL' THEN trim(s) END, r'\.0+$', ''), '')"),
    ("norm_name", "s STRING", "STRING", r"nullif(nullif(trim(regexp_replace(lower(s), r'\s+', ' ')), ''), 'null')"),
    ("id_prefix", "s STRING", "STRING", r"regexp_extract(s, r'^\s*(\d{3,4})\s', 1)"),
    ("without_prefix", "s STRING", "STRING", r"nullif(trim(regexp_replace(s, r'^\s*\d{3,4}\s+', '')), '')"),
    ("bridge_name", "s STRING", "STRING", r"trim(regexp_replace(regexp_replace(lower(trim(s)), r'\s*\([^)]*\)', ''), r'\s*([/-])\s*', '$1'))"),
    ("hav", "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE", "DOUBLE", f"2 * {STATION_RADIUS_M}D * asin(sqrt(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))"),
    ("display_label", "s STRING", "STRING", "CASE WHEN upper(trim(s)) <> 'NULL' THEN s END"),
)


def register(spark: SparkSession) -> None:
    """Make the functions known to this session's SQL, as temporary ones, in place of any of the same names."""
    for name, parameters, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")

"""The data dictionary of the published artifacts: made from the schemas that the plans end with, their shapes and their policies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import publishing as P

COMMENT = "comment"
#: What each published column says, whichever artifact it is in.
NOTES = {
    "system_id": "the system, as registered", "month": "calendar month, yyyy-MM", "trip_month": "first day of the month", "year": "calendar year of the departure", "month_of_year": "1 to 12",
    "trips": "trips that count here", "first_trip": "first day with a trusted trip", "last_trip": "last day with a trusted trip", "identities": "distinct departure stations", "flagged": "trips with any quality flag",
    "active_stations": "stations used in the system's last six months", "days_observed": "days of the month with a trusted trip", "days_in_month": "days that the month has", "mean_trips": "mean trips of that month over the years",
    "months": "months that the figure is made from", "stations": "stations that count here", "ebike": "trips on e-bikes", "classified": "trips whose bike is known to be one or not", "p25_s": "first quartile in seconds",
    "median_s": "median in seconds", "p75_s": "third quartile in seconds", "n": "trips that the quartiles are made from", "no_coordinates": "stations without a valid place", "few_events": "stations with too few events to be shown",
    "station_id": "canonical station", "station_name": "its latest name", "lat": "latitude in degrees", "lon": "longitude in degrees", "lifetime_events": "departures and returns of all years", "net": "returns less departures",
    "is_active": "used in the system's last six months", "member": "trips of members", "casual": "trips of casual riders", "other": "trips of any other group", "unlabelled": "trips without a label", "rk": "rank of the pair, 1 is the busiest",
    "departure_station_id": "canonical station of departure", "return_station_id": "canonical station of return", "departure_name": "name of the departure station", "return_name": "name of the return station", "days": "days with a departure",
    "abs_net": "sum of the stations' daily net flows without sign", "linked_trips": "trips with a station at both ends", "era_first_year": "first year of the run of years with bike ids", "era_last_year": "last year of that run",
    "intervals": "times that a bike stood between two trips", "relocated": "bikes that left from another station than they came to", "out_of_order": "departures before the bike's return", "on_hour_grid": "intervals of whole hours",
    "unterminated": "trips without a return", "matched_by_name": "trips whose departure station is known by name only", "name": "figure of the model", "value": "its value",
}


class Undocumented(P.PublishingRefused):
    """A published column without a note, or a note on nothing."""


def noted(rows: DataFrame) -> DataFrame:
    """rows whose columns carry their notes as metadata, which projections, filters and written Parquet keep."""
    if lacking := sorted(set(rows.columns) - set(NOTES)):
        raise Undocumented(f"no note on {lacking}")
    return rows.select(*[F.col(c).alias(c, metadata={COMMENT: NOTES[c]}) for c in rows.columns])


def dictionary(tables: dict[str, DataFrame], policies: P.Policies = P.POLICIES, shapes: dict = P.SHAPES) -> str:
    """Markdown with a part for each artifact: its rule and thresholds, why, its order, and every column with type and note.

    Only schemas are read, so no job runs. The text depends on them and the policies alone, so
    it can be compared with a committed one as it stands.
    """
    policies.check(tables)
    if stale := sorted(set(NOTES) - {c for rows in tables.values() for c in rows.columns}):
        raise Undocumented(f"notes on columns that no artifact has: {stale}")
    parts = ["# Data dictionary"]
    for name in sorted(tables):
        told = policies.artifacts[name]
        rules = "; ".join(f"{r}: {policies.rules[r]}" for r in (told["rule"], *told.get("more_rules", ())))
        bounds = [f"* {t} = {policies.thresholds[t][0]:g}: {policies.thresholds[t][1]}" for t in told.get("thresholds", ())]
        fields = tables[name].schema.fields
        if lacking := [f.name for f in fields if COMMENT not in f.metadata]:
            raise Undocumented(f"{name}: no note on {lacking}")
        lines = [f"| {f.name} | {f.dataType.simpleString()} | {f.metadata[COMMENT]} |" for f in fields]
        parts.append("\n".join([f"## {name}", "", f"Why: {told['reason']}. Rules: {rules}.", *bounds, "", f"A row for each {', '.join(shapes[name][1])}, in that order.", "", "| column | type | what it says |", "| --- | --- | --- |", *lines]))
    return "\n\n".join(parts) + "\n"

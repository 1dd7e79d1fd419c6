"""From metric tables to published artifacts: what may be published, in which order, shape and size."""

from __future__ import annotations

import datetime
import decimal
import gzip
import json
import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Compressed bytes that all artifacts together may take.
BUDGET_BYTES = 320 * 1024


class PublishingRefused(Exception):
    """Something that must not be published as it is."""


class UnsupportedSystem(PublishingRefused):
    """A metric would show a system that does not support it."""


class PolicyGap(PublishingRefused):
    """An artifact without a completeness policy, or a policy, rule or threshold that governs nothing."""


class ShapeBroken(PublishingRefused):
    """An artifact that does not have its declared shape."""


class OverBudget(PublishingRefused):
    """Artifacts that are larger together than allowed."""


@dataclass(frozen=True)
class Support:
    """How far one system supports a metric: wholly, until some month, or not, and then why."""

    whole: bool = True
    until: str | None = None
    reason: str = ""


@dataclass(frozen=True)
class Metric:
    """A published metric; a comparable one may show whole support only."""

    name: str
    comparable: bool
    systems: dict[str, Support]

    def supported(self) -> list[str]:
        return sorted(s for s, x in self.systems.items() if x.whole)

    def partly(self) -> list[str]:
        """Systems that support the metric for some of their time, which only a metric that compares nothing may show."""
        return [] if self.comparable else sorted(s for s, x in self.systems.items() if not x.whole and x.until)

    def reasons(self) -> dict[str, str]:
        return {s: x.reason for s, x in sorted(self.systems.items()) if not x.whole}

    def admit(self, rows: DataFrame) -> DataFrame:
        """rows, refused if they show a system that the metric does not admit."""
        # The systems of a metric are a handful.
        shown = {r[0] for r in rows.select("system_id").distinct().collect()}
        if wrong := sorted(shown - {*self.supported(), *self.partly()}):
            why = "; ".join(f"{s}: {self.systems[s].reason if s in self.systems else 'not declared'}" for s in wrong)
            raise UnsupportedSystem(f"{self.name} shows {why}")
        return rows


def refuse_rows(rows: DataFrame, what: str, shown: int = 10) -> None:
    """Refuse publishing while rows has any; a few are named."""
    if found := rows.limit(shown).collect():
        raise PublishingRefused(f"{what}: {[r.asDict() for r in found]}")


def refuse_unmapped(labels: DataFrame) -> None:
    refuse_rows(labels, "membership labels without a group")


def refuse_nameless(pairs: DataFrame) -> None:
    refuse_rows(pairs.filter("departure_name is null or return_name is null"), "station pairs without a name")


def refuse_missing_net(stations: DataFrame) -> None:
    refuse_rows(stations.filter("net is null"), "stations without a net flow")


def refuse_residual(funnel: DataFrame) -> None:
    refuse_rows(funnel.filter("residual <> 0"), "rows that no drop reason explains")


@dataclass(frozen=True)
class Policies:
    """Which completeness rule governs each artifact, by which thresholds, and why."""

    rules: dict[str, str]
    thresholds: dict[str, tuple[float, str]]
    artifacts: dict[str, dict[str, Any]]

    def check(self, published: Iterable[str] | None = None) -> None:
        """Every artifact has a rule and a reason, and every rule and threshold an artifact."""
        gaps = [f"rule {r} has no reason" for r, why in self.rules.items() if not why.strip()]
        gaps += [f"threshold {t} has no reason" for t, (_, why) in self.thresholds.items() if not why.strip()]
        used: set[str] = set()
        applied: set[str] = set()
        for name, told in self.artifacts.items():
            own = (told["rule"], *told.get("more_rules", ()))
            gaps += [f"{name} has no reason"] if not str(told.get("reason", "")).strip() else []
            gaps += [f"{name} names an unknown rule {r}" for r in own if r not in self.rules]
            gaps += [f"{name} names an unknown threshold {t}" for t in told.get("thresholds", ()) if t not in self.thresholds]
            used.update(own)
            applied.update(told.get("thresholds", ()))
        gaps += [f"rule {r} governs nothing" for r in sorted(set(self.rules) - used)]
        gaps += [f"threshold {t} admits nothing" for t in sorted(set(self.thresholds) - applied)]
        if published is not None:
            gaps += [f"{n} is published without a policy" for n in sorted(set(published) - set(self.artifacts))]
            gaps += [f"{n} has a policy and is not published" for n in sorted(set(self.artifacts) - set(published))]
        if gaps:
            raise PolicyGap("; ".join(gaps))


#: The published artifacts, their columns in order, and what makes their order total.
SHAPES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "meta": (("system_id", "trips", "first_trip", "last_trip", "identities", "flagged", "active_stations"), ("system_id",)),
    "incomplete_months": (("system_id", "trip_month", "days_observed", "days_in_month", "trips"), ("system_id", "trip_month")),
    "trips_monthly": (("system_id", "month", "trips"), ("system_id", "month")),
    "seasonality": (("system_id", "month_of_year", "mean_trips", "months"), ("system_id", "month_of_year")),
    "stations_yearly": (("system_id", "year", "stations"), ("system_id", "year")),
    "ebike_share": (("system_id", "month", "ebike", "classified", "trips"), ("system_id", "month")),
    "duration": (("system_id", "p25_s", "median_s", "p75_s", "n"), ("system_id",)),
    "stations_meta": (("system_id", "no_coordinates", "few_events", "stations"), ("system_id",)),
    "stations": (("system_id", "station_id", "station_name", "lat", "lon", "lifetime_events", "net", "is_active"), ("system_id", "station_id")),
    "membership": (("system_id", "month", "member", "casual", "other", "unlabelled", "trips"), ("system_id", "month")),
    "flows": (("system_id", "rk", "departure_station_id", "return_station_id", "departure_name", "return_name", "trips"), ("system_id", "rk")),
    "rebalancing": (("system_id", "year", "days", "months", "abs_net", "linked_trips"), ("system_id", "year")),
    "dwell": (("system_id", "era_first_year", "era_last_year", "year", "months", "intervals", "relocated", "out_of_order", "on_hour_grid", "p25_s", "median_s", "p75_s"), ("system_id", "era_first_year", "year")),
    "exclusions": (("system_id", "unterminated", "matched_by_name", "trips"), ("system_id",)),
    "forecast": (("system_id", "name", "value"), ("system_id", "name")),
}
#: What the columns hold, whichever artifact they are in.
TYPES = {
    **dict.fromkeys(("system_id", "month", "first_trip", "last_trip", "station_id", "station_name", "departure_station_id", "return_station_id", "departure_name", "return_name", "name"), "string"),
    **dict.fromkeys(("trips", "identities", "flagged", "active_stations", "days_observed", "days_in_month", "month_of_year", "mean_trips", "months", "year", "stations", "ebike", "classified", "p25_s", "median_s", "p75_s", "n", "no_coordinates", "few_events", "lifetime_events", "net"), "long"),
    **dict.fromkeys(("member", "casual", "other", "unlabelled", "rk", "days", "abs_net", "linked_trips", "era_first_year", "era_last_year", "intervals", "relocated", "out_of_order", "on_hour_grid", "unterminated", "matched_by_name"), "long"),
    **dict.fromkeys(("lat", "lon", "value"), "double"), "is_active": "boolean", "trip_month": "date",
}
_WIDTHS = {"tinyint": "long", "smallint": "long", "int": "long", "bigint": "long", "float": "double"}
RULES = {
    "whole_archive": "counts every row that the quality report counts",
    "exclude_incomplete": "a month with a few observed days would look like a fall in trips",
    "operating_days": "a day without a departure is a closed system, not a balanced one",
    "whole_years": "a year that begins or ends inside the data compares with none",
    "withhold_era": "a labelling era that is known to be wrong is worse than a gap",
}
THRESHOLDS = {
    "stub_days": (3.0, "at most so many observed days make a month a stub"),
    "ebike_share": (0.5, "a share needs the signal of half the trips"),
    "min_events": (100.0, "fewer events say nothing of a station"),
    "bike_coverage": (0.99, "chains break where bike ids are missing"),
    "longest_trip_s": (86400.0, "a trip over a day is a bike that was not returned"),
    "top_pairs": (8.0, "a table that can be read"),
}
_ALWAYS = {"rule": "exclude_incomplete", "reason": "compares months"}
POLICIES = Policies(RULES, THRESHOLDS, {
    "meta": {"rule": "whole_archive", "reason": "agrees with the report"},
    "incomplete_months": _ALWAYS | {"thresholds": ("stub_days",), "reason": "lists what the others leave out"},
    "trips_monthly": _ALWAYS, "seasonality": _ALWAYS, "stations_yearly": _ALWAYS, "forecast": _ALWAYS,
    "ebike_share": _ALWAYS | {"thresholds": ("ebike_share",)},
    "duration": {"rule": "whole_archive", "thresholds": ("longest_trip_s",), "reason": "quartiles over all trips that ended"},
    "stations_meta": {"rule": "whole_archive", "thresholds": ("min_events",), "reason": "says what the map leaves out"},
    "stations": {"rule": "whole_archive", "thresholds": ("min_events",), "reason": "net flows sum to zero over all trips only"},
    "membership": _ALWAYS | {"more_rules": ("withhold_era",)},
    "flows": {"rule": "whole_archive", "thresholds": ("top_pairs",), "reason": "shares of all linked trips"},
    "rebalancing": _ALWAYS | {"more_rules": ("operating_days", "whole_years")},
    "dwell": _ALWAYS | {"thresholds": ("bike_coverage",)},
    "exclusions": {"rule": "whole_archive", "reason": "accounts for every row"},
})


def shaped(name: str, rows: DataFrame, shapes: dict = SHAPES) -> DataFrame:
    """rows with the artifact's columns and types, in its total order."""
    if name not in shapes:
        raise ShapeBroken(f"{name}: no shape is declared")
    columns, order = shapes[name]
    if set(rows.columns) != set(columns):
        raise ShapeBroken(f"{name}: columns {sorted(rows.columns)} in place of {sorted(columns)}")
    if wrong := {c: t for c, t in rows.dtypes if c in TYPES and _WIDTHS.get(t, t) != TYPES[c]}:
        raise ShapeBroken(f"{name}: {wrong} in place of { {c: TYPES[c] for c in wrong} }")
    return rows.select(*columns).orderBy(*order)


def _plain(value: Any, where: str) -> Any:
    """A value as JSON has it; what JSON has no form for is refused."""
    if isinstance(value, float) and not math.isfinite(value):
        raise ShapeBroken(f"{where}: {value} is no JSON number")
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (list, tuple)):
        return [_plain(v, where) for v in value]
    return value


@dataclass
class Artifacts:
    """Artifacts to be written together or not at all."""

    shapes: dict = field(default_factory=lambda: SHAPES)
    policies: Policies = POLICIES
    texts: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, rows: DataFrame) -> None:
        """Collect a published table: thousands of rows at most, as the budget holds for all of them."""
        made = []
        keys = self.shapes[name][1] if name in self.shapes else ()
        for r in shaped(name, rows, self.shapes).collect():
            row = {k: _plain(v, f"{name}/{len(made)}/{k}") for k, v in r.asDict().items()}
            if any(row[k] is None for k in keys):
                raise ShapeBroken(f"{name}/{len(made)}: a key is null")
            if made and all(row[k] == made[-1][k] for k in keys):
                raise ShapeBroken(f"{name}/{len(made)}: its order is not total")
            made.append(row)
        self.texts[name] = json.dumps(made, separators=(",", ":"), ensure_ascii=False) + "\n"

    def sizes(self) -> dict[str, int]:
        return {n: len(gzip.compress(t.encode(), mtime=0)) for n, t in self.texts.items()}

    def write(self, folder: str | Path, budget: int = BUDGET_BYTES) -> int:
        """Check all, then write all; the compressed size is returned. A refusal leaves the folder as it was."""
        self.policies.check(self.texts)
        if set(self.texts) != set(self.shapes):
            raise ShapeBroken(f"published {sorted(self.texts)}, declared {sorted(self.shapes)}")
        if (total := sum(self.sizes().values())) > budget:
            raise OverBudget(f"{total} bytes compressed, {budget} allowed")
        top = Path(folder)
        top.mkdir(parents=True, exist_ok=True)
        for name, text in self.texts.items():
            part = top / f"{name}.json.part"
            part.write_text(text, encoding="utf-8")
            part.replace(top / f"{name}.json")
        return total

    def drift(self, folder: str | Path, volatile: Iterable[str] = ()) -> dict[str, str]:
        """Artifacts that a folder lacks, has beyond these, or has with other content; `volatile` fields are not compared."""
        top, out = Path(folder), {}
        there = {p.stem for p in top.glob("*.json")}
        hide = re.compile("|".join(rf'"{re.escape(v)}":("[^"]*"|[^,}}]*)' for v in volatile)) if volatile else None
        masked = lambda t: hide.sub("", t) if hide else t
        for name in sorted(set(self.texts) | there):
            if name not in there:
                out[name] = "missing"
            elif name not in self.texts:
                out[name] = "orphaned"
            elif masked((top / f"{name}.json").read_text(encoding="utf-8")) != masked(self.texts[name]):
                out[name] = "drifted"
        return out


def systems_within(payload: Any) -> set[str]:
    """All system ids that a published value mentions, at any depth."""
    if isinstance(payload, dict):
        own = {payload["system_id"]} if isinstance(payload.get("system_id"), str) else set()
        return own.union(*map(systems_within, payload.values()))
    return set().union(*map(systems_within, payload)) if isinstance(payload, list) else set()


def governed(texts: dict[str, str], metrics: dict[str, Metric]) -> dict[str, str]:
    """What the registry says against artifacts: not declared, or with systems that their metric does not admit."""
    out = {}
    for name, text in texts.items():
        if name not in metrics:
            out[name] = "no metric is declared"
        elif wrong := sorted(systems_within(json.loads(text)) - {*metrics[name].supported(), *metrics[name].partly()}):
            out[name] = f"systems {wrong}"
    return out


def markdown(rows: DataFrame, limit: int = 200) -> str:
    """A small table for the report, numbers with separators."""
    names = rows.columns
    cell = lambda v: "" if v is None else f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else f"{v:,.4g}" if isinstance(v, float) else str(v)
    lines = [f"| {' | '.join(cell(v) for v in r)} |" for r in rows.limit(limit).collect()]
    return "\n".join([f"| {' | '.join(names)} |", f"|{'---|' * len(names)}", *lines])


def invariants(fact: DataFrame, funnel: DataFrame, audit: DataFrame, net: DataFrame, unmapped: DataFrame, stations: DataFrame) -> DataFrame:
    """What blocks publishing, a row for each invariant with the number of its violations."""
    def count(name: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.lit(name).alias("invariant"), F.count("*").alias("violations"))

    checks = {
        "funnel_explained": funnel.filter("residual <> 0"),
        "landing_reconciled": audit.filter("source_records <> rows_landed"),
        "net_flow_zero": net.groupBy("system_id").agg(F.sum("net").alias("net")).filter("net <> 0"),
        "labels_mapped": unmapped,
        "stations_known": fact.filter("departure_station_id is null"),
        "places_valid": stations.filter("lat is not null and not (lat between 41 and 84 and lon between -141 and -52)"),
    }
    parts = [count(n, rows) for n, rows in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

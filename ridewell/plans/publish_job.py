"""From fact, stations, labels and models to the published artifacts: one function for all of them, and what blocks it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import metrics as M
from . import publishing as P
from .dictionary import noted


@dataclass(frozen=True)
class Model:
    """What is published from: the fact with canonical stations, dim_station, labels and their groups, and the fitted models."""

    fact: DataFrame
    stations: DataFrame
    labels: DataFrame
    fits: DataFrame
    first_year: int
    ebike_systems: tuple[str, ...]
    #: Trips whose labels are known to be wrong; their months are withheld.
    unreliable: Column | None = None


def forecast(fits: DataFrame) -> DataFrame:
    """system_id, name and value of every figure of a model that predicting needs, and how good it is; none of a refused one."""
    figures = ("intercept", "residual_sd_log", "smearing_factor", "r2_log", "r2_trips", "cv_r2_log", "median_abs_pct_error", "cv_median_abs_pct_error", "days", "parameters")
    own = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in figures])
    levels = F.zip_with("names", "coefficients", lambda n, v: F.struct(F.concat(F.lit("coefficient:"), n).alias("name"), v.alias("value")))
    return fits.filter("refused is null").select("system_id", F.explode(F.concat(own, levels)).alias("x")).select("system_id", "x.name", "x.value")


def tables(m: Model) -> dict[str, DataFrame]:
    """The fifteen artifacts as tables, each with its declared columns, types and notes, in its declared order."""
    net = M.net_flow(m.fact)
    labelled = M.membership(m.fact, m.labels)
    if m.unreliable is not None:
        labelled = labelled.filter(~F.coalesce(m.unreliable, F.lit(False)))
    made = {
        "meta": M.meta(m.fact, m.stations), "incomplete_months": M.incomplete_months(m.fact), "trips_monthly": M.trips_monthly(m.fact), "seasonality": M.seasonality(m.fact, m.first_year),
        "stations_yearly": M.stations_yearly(m.fact), "ebike_share": M.ebike_share(m.fact, list(m.ebike_systems)), "duration": M.duration(m.fact), "stations_meta": M.stations_meta(m.stations),
        "stations": M.stations(m.stations, net), "membership": labelled, "flows": M.top_pairs(m.fact, m.stations), "rebalancing": M.rebalancing(m.fact),
        "dwell": M.dwell(m.fact, M.bike_eras(M.bike_coverage(m.fact))), "exclusions": M.exclusions(m.fact), "forecast": forecast(m.fits),
    }
    return {name: noted(P.shaped(name, rows)) for name, rows in made.items()}


def publish(m: Model, folder: str | Path, funnel: DataFrame, audit: DataFrame, budget: int = P.BUDGET_BYTES) -> int:
    """Write all artifacts, or none where an invariant is violated, a shape broken or the budget exceeded. Gives the compressed size."""
    blocking(P.invariants(m.fact, funnel, audit, M.net_flow(m.fact), M.unmapped(m.fact, m.labels), m.stations))
    return collected(m).write(folder, budget)


def collected(m: Model) -> P.Artifacts:
    """All artifacts as they would be written."""
    made = P.Artifacts()
    for name, rows in tables(m).items():
        made.add(name, rows)
    return made


def blocking(checked: DataFrame) -> None:
    """Refuse to publish while any invariant is violated; six rows at most."""
    if wrong := {r["invariant"]: r["violations"] for r in checked.filter("violations > 0").collect()}:
        raise P.PublishingRefused(f"violated: {wrong}")


def digest(rows: DataFrame) -> DataFrame:
    """rows and two sums of row hashes, which are equal for equal tables in any order and partitioning.

    A row's hashes are 64 bits with unlike seeds; as sums have 38 digits, repeated rows count, and no
    sort is needed at any size. Nulls differ from texts, and columns are taken by name.
    """
    cells = [F.coalesce(F.to_json(F.struct(F.col(f"`{c}`").alias("x"))), F.lit("")) for c in sorted(rows.columns)]
    part = lambda seed: F.coalesce(F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string")
    return rows.agg(F.count("*").alias("rows"), part("a").alias("high"), part("b").alias("low"))


def digests(made: dict[str, DataFrame]) -> DataFrame:
    """artifact, rows, high and low of each table: what tells a stale report or artifact from a fresh one."""
    return reduce(DataFrame.unionByName, [digest(rows).select(F.lit(name).alias("artifact"), "*") for name, rows in sorted(made.items())])

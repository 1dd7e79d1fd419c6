"""Where a run reads and writes, from the session's configuration, and which systems there are, from their registry."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from .publishing import BUDGET_BYTES

#: Paths and limits are read from `spark.ridewell.<name>`; what published bytes mean (era maps, labels, registry) is never configured.
PREFIX = "spark.ridewell."
SYSTEMS = "system_id string, city string, system string, source_page string, first_year string"


class SettingsRefused(ValueError):
    """A setting that is unknown, of another type, or that would mix two trees."""


@dataclass(frozen=True)
class Settings:
    """Folders and limits of a run. `root` moves warehouse and artifacts together; either may be named by itself.

    file_limit is the number of periods of each system that are landed at most (0: all), for trial
    runs; budget_bytes what all artifacts together may take compressed.
    """

    root: str
    warehouse: str = ""
    generated: str = ""
    file_limit: int = 0
    budget_bytes: int = BUDGET_BYTES

    def __post_init__(self) -> None:
        if not self.root.strip():
            raise SettingsRefused(f"{PREFIX}root is not set")
        for name in ("warehouse", "generated"):
            if not getattr(self, name):
                object.__setattr__(self, name, f"{self.root.rstrip('/')}/{name}")
        if self.file_limit < 0 or self.budget_bytes <= 0:
            raise SettingsRefused("limits are not negative, and a budget is not nothing")

    @classmethod
    def of(cls, spark: SparkSession, **own: str | int) -> Settings:
        """What the session says, but for what is given here. An empty text means not set; an unknown name is refused."""
        known = {f.name: f.type for f in fields(cls)}
        said = {k.removeprefix(PREFIX): v for k, v in spark.conf.getAll.items() if k.startswith(PREFIX)}
        if unknown := sorted((set(said) | set(own)) - set(known)):
            raise SettingsRefused(f"unknown settings {unknown}; there are {sorted(known)}")
        told: dict = {k: v for k, v in said.items() if v.strip()} | own
        for name in ("file_limit", "budget_bytes"):
            try:
                told |= {name: int(told[name])} if name in told else {}
            except ValueError as e:
                raise SettingsRefused(f"{PREFIX}{name} is {told[name]!r}, not a number") from e
        return cls(**{"root": ""} | told)


@dataclass(frozen=True)
class System:
    """A system as the registry has it: what it is, and how its files are read."""

    system_id: str
    city: str
    system: str
    source_page: str
    first_year: str
    zone: str
    #: Standard hours from UTC, by which a file's clock is told.
    utc_offset: int
    #: Stations are named by the number in front of their name.
    prefixed: bool = False
    #: `flag` or `model`: what tells an e-bike; None: not published.
    electric: str | None = None
    #: Repeated rows are publishing errors and go.
    deduped: bool = False
    #: Older station ids are matched to today's docks.
    bridged: bool = False


def dim_system(spark: SparkSession, registry: tuple[System, ...]) -> DataFrame:
    """A row for each registered system; the registry stays the only place that says what a system is."""
    ids = [s.system_id for s in registry]
    if twice := sorted({i for i in ids if ids.count(i) > 1}):
        raise SettingsRefused(f"registered twice: {twice}")
    return spark.createDataFrame([(s.system_id, s.city, s.system, s.source_page, s.first_year) for s in registry], SYSTEMS)

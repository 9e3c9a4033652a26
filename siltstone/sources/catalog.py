"""Datasets: landed schema, layer, contract and request window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siltstone.functions.exprs import LOOKBACK_DAYS, lookback_window

# Column names of the landed responses. JSON lists and objects without a
# fixed shape are declared string, which keeps their JSON text.
LAUNCHES = """
    id string, flight_number long, name string, date_utc string, date_unix long,
    date_local string, date_precision string, static_fire_date_utc string,
    static_fire_date_unix long, tdb boolean, net boolean, window long, rocket string,
    success boolean, failures string, upcoming boolean, details string, crew string,
    ships string, capsules string, payloads string, cores string, launchpad string,
    links struct<
        patch: struct<small: string, large: string>,
        reddit: struct<campaign: string, launch: string, media: string, recovery: string>,
        flickr: struct<small: array<string>, original: array<string>>,
        presskit: string, webcast: string, youtube_id: string, article: string,
        wikipedia: string>,
    auto_update boolean
"""
ROCKETS = """
    id string, name string, type string, active boolean, stages long, boosters long,
    cost_per_launch long, success_rate_pct long, first_flight string, country string,
    company string, height struct<meters: double, feet: double>,
    diameter struct<meters: double, feet: double>, mass struct<kg: long, lb: long>,
    payload_weights string
"""
PAYLOADS = """
    id string, name string, type string, reused boolean, mass_kg double, orbit string,
    customers string
"""
CORES = """
    id string, serial string, status string, reuse_count long, rtls_landings long,
    asds_landings long
"""
SOLAR_EVENTS = """
    activityID string, catalog string, startTime string, peakTime string, endTime string,
    eventType string, classType string, sourceLocation string, activeRegionNum long,
    link string, note string, cmeAnalyses string
"""
# The columns a batch is rejected without.
REQUIRED = {
    "launches": ("id", "flight_number", "date_utc"),
    "solar_events": ("activityID", "startTime"),
}
LAUNCH_CONTRACT = ("name", "date_utc", "flight_number", "success")


def parse_schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    ddl: str
    layer: str = "bronze"
    json_path: str | None = None
    required: tuple[str, ...] = ()
    id_column: str | None = "id"
    # text column holding the event time, for datasets requested by window
    window_column: str | None = None
    json_lines: bool = False
    # read files as streams of records instead of whole: for pages too large for one row
    streamed: bool = False
    # text column by whose month the raw table is split
    event_column: str | None = None

    @property
    def key_column(self) -> str | None:
        """The column that identifies a record, or else the first it cannot lack."""
        return self.id_column or next(iter(self.required), None)

    @property
    def schema(self) -> T.StructType:
        return parse_schema(self.ddl)

    def window(self, target: dt.date, days: int = LOOKBACK_DAYS) -> tuple[str, str] | None:
        return lookback_window(target, days) if self.window_column else None


def datasets() -> dict[str, DatasetSpec]:
    specs = (
        DatasetSpec("rockets", ROCKETS),
        DatasetSpec("launches", LAUNCHES, required=REQUIRED["launches"], event_column="date_utc"),
        DatasetSpec("payloads", PAYLOADS),
        DatasetSpec("cores", CORES),
        DatasetSpec(
            "solar_events",
            SOLAR_EVENTS,
            required=REQUIRED["solar_events"],
            id_column=None,
            window_column="startTime",
            event_column="startTime",
        ),
    )
    return {spec.name: spec for spec in specs}


class Reader(Protocol):
    """Extension point: anything that turns a dataset into rows."""

    def read(self, spark: SparkSession, spec: DatasetSpec, location: str) -> DataFrame: ...


@dataclass(frozen=True)
class Contract:
    """Column names a frame must carry; columns are checked before emptiness."""

    name: str
    required: tuple[str, ...]
    on_failure: Callable[[str], Exception] = field(default=ValueError, repr=False)

    def validate(self, df: DataFrame) -> bool:
        missing = [c for c in self.required if c not in df.columns]
        if missing:
            raise self.on_failure(f"{self.name}: missing columns {', '.join(missing)}")
        if df.isEmpty():
            raise self.on_failure(f"{self.name}: no rows")
        return True


CONTRACTS = {"launches": Contract("launches", LAUNCH_CONTRACT)}


def contract(name: str) -> Contract:
    if name not in CONTRACTS:
        raise ValueError(f"no contract registered for {name!r}")
    return CONTRACTS[name]

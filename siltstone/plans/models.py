"""Datasets and the models built on them, as a graph.

A model names what it is built from: ``raw.<dataset>``, ``silver.<view>`` or ``gold.<fact>``. The
graph decides the order, what a selection by tag needs besides, and which models are known to
build on what. Projects are values: adding a dataset or a model gives a new one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame

from siltstone.operators import quality
from siltstone.plans import gold, silver
from siltstone.sources.catalog import DatasetSpec, datasets

Frames = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Model:
    """A silver view: ``build(frames, as_of)`` with a frame for each name in ``depends_on``."""

    name: str
    build: Callable[[Frames, dt.datetime], DataFrame]
    depends_on: tuple[str, ...]
    tags: tuple[str, ...] = ()
    layer: str = "silver"
    # check frames of what was built, from (rows, frames)
    checks: Callable[[DataFrame, Frames], list[DataFrame]] | None = field(default=None, repr=False)

    @property
    def full_name(self) -> str:
        return f"{self.layer}.{self.name}"


@dataclass(frozen=True)
class Fact(Model):
    """A gold table that grows by run, or is rebuilt where it ``loads`` nothing.

    ``loads`` is the dependency of which a run takes the rows with ``event_time`` after the newest of the
    fact. ``reach`` says how far before such a row others may lie that matter to it.
    """

    layer: str = "gold"
    key: str = ""
    event_time: str | None = "launch_at_utc"
    loads: str | None = None
    reach: Mapping[str, dt.timedelta] = field(default_factory=dict)


@dataclass(frozen=True)
class Project:
    specs: Mapping[str, DatasetSpec]
    models: Mapping[str, Model]

    def __post_init__(self) -> None:
        known = {f"raw.{name}" for name in self.specs} | set(self.models)
        for model in self.models.values():
            missing = [d for d in model.depends_on if d not in known]
            if missing:
                raise ValueError(f"{model.full_name} depends on unknown {', '.join(missing)}")
            if isinstance(model, Fact) and model.loads and model.loads not in model.depends_on:
                raise ValueError(f"{model.full_name} loads {model.loads}, which it does not depend on")
            if isinstance(model, Fact) and model.loads and not (model.key and model.event_time):
                raise ValueError(f"{model.full_name} needs a key and an event time to load {model.loads}")
            for part in model.reach if isinstance(model, Fact) else ():
                if part not in model.depends_on:
                    raise ValueError(f"{model.full_name} reaches into {part}, which it does not depend on")
        try:
            self.ordered()
        except CycleError as error:
            raise ValueError(f"models depend on each other: {' -> '.join(error.args[1])}") from error

    def with_datasets(self, *specs: DatasetSpec) -> Project:
        return replace(self, specs={**self.specs, **{s.name: s for s in specs}})

    def with_models(self, *models: Model) -> Project:
        return replace(self, models={**self.models, **{m.full_name: m for m in models}})

    def ordered(self, names: Iterable[str] | None = None) -> list[Model]:
        """The models, each behind those it depends on."""
        wanted = set(self.models if names is None else names)
        graph = {n: [d for d in m.depends_on if d in self.models] for n, m in self.models.items()}
        return [self.models[n] for n in TopologicalSorter(graph).static_order() if n in wanted]

    def ancestors(self, name: str) -> set[str]:
        """Everything a name is built from, raw tables too."""
        out: set[str] = set()
        todo = [name]
        while todo:
            model = self.models.get(todo.pop())
            new = set(model.depends_on) - out if model else set()
            out |= new
            todo += new
        return out

    def selected(self, tag: str | None = None) -> list[Model]:
        """Models with the tag, and the models those are built from; all without a tag."""
        if tag is None:
            return self.ordered()
        chosen = {n for n, m in self.models.items() if tag in m.tags}
        return self.ordered(chosen | {a for n in chosen for a in self.ancestors(n) if a in self.models})

    def levels(self, models: Iterable[Model]) -> list[list[Model]]:
        """Models in groups; none depends on another of its group or of a later one."""
        depth: dict[str, int] = {}
        out: list[list[Model]] = []
        for model in models:
            depth[model.full_name] = at = max((depth[d] + 1 for d in model.depends_on if d in depth), default=0)
            while len(out) <= at:
                out.append([])
            out[at].append(model)
        return out


def _silver(name: str, build: Callable[[DataFrame], DataFrame]) -> Model:
    return Model(name, lambda f, at: build(f[f"raw.{name}"]), (f"raw.{name}",))


def _same_day_check(rows: DataFrame, frames: Frames) -> list[DataFrame]:
    events = frames["silver.solar_events"]
    return [quality.same_day_before_check(rows, events, "launch_after_solar_event", "launch_at_utc", "event_at_utc")]


SILVER = (
    _silver("launches", silver.launches),
    _silver("rockets", silver.rockets),
    _silver("payloads", silver.payloads),
    _silver("cores", silver.cores),
    _silver("solar_events", silver.solar_events),
)

FACTS = (
    Fact(
        "launches_performance",
        lambda f, at: gold.performance(f["silver.launches"], f["silver.rockets"], f["silver.payloads"], f["silver.solar_events"], at),
        ("silver.launches", "silver.rockets", "silver.payloads", "silver.solar_events"),
        ("incremental", "daily", "performance"),
        checks=_same_day_check,
        key="launch_id",
        loads="silver.launches",
        reach={"silver.solar_events": gold.RISK_LOOKBACK},
    ),
    Fact(
        "launch_roi",
        lambda f, at: gold.roi(f["raw.launches"], f["silver.rockets"], f["silver.payloads"], at),
        ("raw.launches", "silver.rockets", "silver.payloads"),
        ("incremental", "daily", "roi"),
        key="launch_id",
        loads="raw.launches",
    ),
    Fact(
        "space_weather_impact",
        lambda f, at: gold.weather(f["silver.launches"], f["silver.solar_events"], at, parted=True),
        ("silver.launches", "silver.solar_events"),
        ("incremental", "daily", "space_weather"),
        key="surrogate_key",
        loads="silver.launches",
        reach={"silver.solar_events": gold.IMPACT_WINDOW},
    ),
)


def default_project() -> Project:
    return Project(datasets(), {m.full_name: m for m in (*SILVER, *FACTS)})

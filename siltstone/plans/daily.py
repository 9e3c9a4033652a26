"""The daily run: ingest, check, build, check again, publish."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.casts import to_ntz, try_ntz
from siltstone.functions.exprs import lookback_window, ntz_literal
from siltstone.functions.jsonx import encode_complex_columns
from siltstone.operators import quality
from siltstone.operators.incremental import newer_than
from siltstone.operators.tables import EVENT_AT, PART, Conflict, Layers, Table, Version
from siltstone.plans.models import Fact, Frames, Model, Project, default_project
from siltstone.session import configure, hadoop_path, size_scans
from siltstone.sources.catalog import DatasetSpec, Reader, datasets
from siltstone.sources.flatten import flatten_struct
from siltstone.sources.landed import LandedReader, in_window


class GateFailed(RuntimeError):
    """A check failed that blocks everything after it."""


# -- bronze ----------------------------------------------------------------------------


def with_lineage(df: DataFrame, spec: DatasetSpec, as_of: dt.datetime) -> DataFrame:
    at = ntz_literal(as_of)
    return df.withColumns(
        {
            "source_endpoint": F.lit(spec.name),
            "data_layer": F.lit(spec.layer),
            "ingestion_timestamp": at,
            "loaded_at": at,
        }
    )


def load_raw(table: Table, rows: DataFrame, spec: DatasetSpec, as_of: dt.datetime) -> quality.Preflight:
    """Full refresh of one raw table; a batch that fails its checks is not published.

    A dataset with an event column is split by its month, and keeps the typed time beside the
    text. The landed text is parsed once; the counts behind the verdict come from the columns
    they need in the files written.
    """
    by_event = spec.event_column is not None and table.event_time == EVENT_AT
    # the landed rows change tasks as they are: flat, encoded and with their lineage they are far wider
    early = by_event and isinstance(dict((f.name, f.dataType) for f in rows.schema.fields).get(spec.event_column), T.AtomicType)
    if early:
        rows = table.by_month(rows.withColumn(EVENT_AT, try_ntz(spec.event_column)))
    flat = encode_complex_columns(with_lineage(flatten_struct(rows), spec, as_of))
    if early:
        flat = flat.select(*(F.col(f"`{c}`") for c in flat.columns if c not in (EVENT_AT, PART)), EVENT_AT, PART)
    elif by_event:
        known = spec.event_column in flat.columns
        flat = flat.withColumn(EVENT_AT, try_ntz(spec.event_column) if known else F.lit(None).cast("timestamp_ntz"))
    staged = table.stage_refresh(flat, arranged=early)
    counts = table.measure(staged, *quality.preflight_metrics(flat, spec))
    verdict = quality.preflight_verdict(spec, counts)
    if verdict.ok:
        table.publish(staged)
        table.expire()
    else:
        table.discard(staged)
    return verdict


def raw_table(layers: Layers, spec: DatasetSpec) -> Table:
    return layers.table("raw", spec.name, EVENT_AT if spec.event_column else None)


def ingest(
    layers: Layers,
    location: str,
    as_of: dt.datetime,
    specs: Iterable[DatasetSpec] | None = None,
    reader: Reader | None = None,
    window: tuple[str, str] | None = None,
) -> dict[str, quality.Preflight | None]:
    """Load every dataset; a failing one leaves an alert and never stops the others.

    Datasets do not depend on each other, so their jobs are submitted side by side.
    """
    reader = reader or LandedReader()

    def one(spec: DatasetSpec) -> quality.Preflight | None:
        try:
            rows = in_window(reader.read(layers.spark, spec, location), spec, window)
            verdict = load_raw(raw_table(layers, spec), rows, spec, as_of)
            if not verdict.ok:
                layers.alert(as_of, spec.name, "; ".join(verdict.errors), "WARNING")
            for warning in verdict.warnings:
                layers.alert(as_of, spec.name, warning, "WARNING")
            return verdict
        except Exception as error:  # isolation between datasets is the point
            layers.alert(as_of, spec.name, str(error))
            return None

    chosen = list(specs if specs is not None else datasets().values())
    with ThreadPoolExecutor(max_workers=max(1, len(chosen))) as pool:
        return dict(zip((s.name for s in chosen), pool.map(one, chosen), strict=True))


# -- silver and gold -------------------------------------------------------------------

# Facts of one level do not depend on each other; this many are built at a time.
FACT_THREADS = 4
# Times a fact is built again because another writer published it meanwhile.
PUBLISH_TRIES = 3


class Raws:
    """The raw tables that exist, as of now: a run resolves each once and sticks to it."""

    def __init__(self, layers: Layers, project: Project):
        found = {name: raw_table(layers, spec) for name, spec in project.specs.items()}
        self.tables = {name: table for name, table in found.items() if table.exists()}
        self.versions = {name: table.current() for name, table in self.tables.items()}
        self.frames = {f"raw.{name}": table.read(self.versions[name]) for name, table in self.tables.items()}

    def since(self, name: str, at: dt.datetime) -> DataFrame:
        return self.tables[name].since(at, self.versions[name])


def source_checks(spark: SparkSession, raws: Raws, project: Project, as_of: dt.datetime) -> DataFrame:
    """Freshness, recency, keys of the raw tables; a table never loaded is an error."""
    checks = []
    for spec in project.specs.values():
        raw = raws.frames.get(f"raw.{spec.name}")
        if raw is None:
            row = [(f"loaded_{spec.name}", 1, "error")]
            checks.append(spark.createDataFrame(row, "check_name string, failing_rows long, status string"))
            continue
        parts = [
            quality.stale(f"freshness_{spec.name}", "ingestion_timestamp", as_of),
            quality.newest_older_than(f"recency_{spec.name}", "ingestion_timestamp", as_of, quality.RECENT_WITHIN),
        ]
        if spec.key_column:
            parts.append(quality.nulls_in(f"not_null_{spec.name}", spec.key_column))
        checks.append(quality.measure(raw, *parts))
        if spec.id_column:
            checks.append(quality.unique(raw, f"unique_{spec.name}", spec.id_column))
    return quality.union_checks(checks)


def gate(layers: Layers, checks: DataFrame, as_of: dt.datetime) -> None:
    """Raise and leave alerts if any check failed; warnings only leave alerts."""
    # one row per check
    bad = [r for r in checks.collect() if r.status != "pass"]
    for r in bad:
        severity = "WARNING" if r.status == "warn" else "CRITICAL"
        layers.alert(as_of, r.check_name, f"{r.status}: {r.failing_rows} failing rows", severity)
    blocking = [r.check_name for r in bad if r.status != "warn"]
    if blocking:
        raise GateFailed(", ".join(sorted(blocking)))


def register_views(layers: Layers, raws: Raws, project: Project, models: Iterable[Model], as_of: dt.datetime) -> dict[str, DataFrame]:
    """Raw tables and silver views for SQL users of the session; returns all frames by full name."""
    frames = dict(raws.frames)
    for name, raw in raws.frames.items():
        layers.view("raw", name.removeprefix("raw."), raw)
    for model in project.ordered(m.full_name for m in models if not isinstance(m, Fact)):
        frames[model.full_name] = layers.view(model.layer, model.name, model.build(frames, as_of))
    return frames


def reduced(project: Project, name: str, raws: Raws, at: dt.datetime, as_of: dt.datetime) -> DataFrame:
    """A raw table or a view of views on raw tables, of rows not before ``at`` (and some others).

    Only a name with a single raw table below it can be cut by time without changing its rows.
    """
    below = [n for n in project.ancestors(name) | {name} if n.startswith("raw.")]
    frames = dict(raws.frames)
    if len(below) == 1:
        frames[below[0]] = raws.since(below[0].removeprefix("raw."), at)
    for model in project.ordered(n for n in project.ancestors(name) | {name} if not n.startswith("raw.")):
        frames[model.full_name] = model.build(frames, as_of)
    return frames[name]


def typed_time(frame: DataFrame, fact: Fact, spec: DatasetSpec | None) -> DataFrame:
    """The frame with the fact's event time, which raw rows hold as text."""
    if fact.event_time in frame.columns or spec is None or spec.event_column is None:
        return frame
    return frame.withColumn(fact.event_time, to_ntz(spec.event_column))


def stage_fact(
    layers: Layers,
    fact: Fact,
    project: Project,
    frames: Frames,
    raws: Raws,
    as_of: dt.datetime,
    full_refresh: bool = False,
    empty_target: str = "nothing",
) -> tuple[Table, Version]:
    """Write the fact's next state without publishing it.

    A run after the first reads the raw months from the mark on, and of the other sides those the
    new rows can reach. Facts on facts, and facts that load nothing, are built from whole frames.
    """
    table = layers.table("gold", fact.name, fact.event_time, fact.key or None)
    if fact.loads is None:
        return table, table.stage_refresh(fact.build(frames, as_of))
    first_run = full_refresh or not table.exists()
    # the mark and what the batch is merged into are of one version
    old = None if first_run else table.current()
    mark = None if old is None else table.high_water_mark(old)
    given = dict(frames)

    def cut(name: str, at: dt.datetime) -> DataFrame:
        on_facts = any(a.startswith("gold.") for a in project.ancestors(name) | {name})
        return frames[name] if on_facts else reduced(project, name, raws, at, as_of)

    if mark is not None:
        given[fact.loads] = cut(fact.loads, mark)
        for name, distance in fact.reach.items():
            given[name] = cut(name, mark - distance)
    source = typed_time(given[fact.loads], fact, project.specs.get(fact.loads.removeprefix("raw.")))
    given[fact.loads] = newer_than(source, fact.event_time, mark, first_run, empty_target)
    batch = fact.build(given, as_of)
    staged = table.stage_full(batch) if first_run else table.stage_delete_insert(batch, fact.key, old)
    return table, staged


def fact_checks(fact: Fact, rows: DataFrame, frames: Frames) -> list[DataFrame]:
    """Checks a staged state has to pass before readers see it."""
    checks = [quality.not_null(rows, f"not_null_{fact.name}", fact.key)] if fact.key else []
    return checks + (fact.checks(rows, frames) if fact.checks else [])


def run(
    spark: SparkSession,
    root: str,
    location: str,
    as_of: dt.datetime,
    window: tuple[str, str] | None = None,
    specs: Iterable[DatasetSpec] | None = None,
    tag: str | None = None,
    full_refresh: bool = False,
    empty_target: str = "nothing",
    project: Project | None = None,
    prefix: str = "",
) -> dict[str, int]:
    """One day's run; returns the published version per fact.

    ``specs`` replace datasets of the project by name or add to them; every dataset is loaded and
    checked. Datasets requested by window are read for ``window``, or else for the days up to
    ``as_of`` (``lookback_window``). ``tag`` selects facts, with whatever they are built from.

    Nothing of a later step is published once a gate has failed; the files it staged are deleted.
    A fact that another run has published meanwhile is built and checked again on that. A fact
    whose months lie in many folders is merged after publishing, and old versions are dropped.
    Raw tables and facts are tables of the catalog in the databases ``<prefix>raw`` and ``<prefix>gold``.
    """
    landed, fs = hadoop_path(spark, location)
    configure(spark, *([location] if fs.exists(landed) else []))
    size_scans(spark)
    project = (project or default_project()).with_datasets(*(specs or ()))
    models = project.selected(tag)
    layers = Layers(spark, root, prefix)
    layers.ensure()
    ingest(layers, location, as_of, project.specs.values(), window=window or lookback_window(as_of.date()))
    raws = Raws(layers, project)
    gate(layers, source_checks(spark, raws, project, as_of), as_of)
    frames = register_views(layers, raws, project, project.selected(), as_of)

    def stage(fact: Fact) -> tuple[Fact, Table, Version]:
        return fact, *stage_fact(layers, fact, project, frames, raws, as_of, full_refresh, empty_target)

    views = [c for m in models if not isinstance(m, Fact) and m.checks for c in m.checks(frames[m.full_name], frames)]
    if views:
        gate(layers, quality.union_checks(views), as_of)
    staged: list[tuple[Fact, Table, Version]] = []
    facts = [m for m in models if isinstance(m, Fact)]
    try:
        for level in project.levels(facts):
            with ThreadPoolExecutor(max_workers=FACT_THREADS) as pool:
                made = list(pool.map(stage, level))
            staged += made
            frames |= {fact.full_name: table.read(state) for fact, table, state in made}
        checks = [c for fact, _, _ in staged for c in fact_checks(fact, frames[fact.full_name], frames)]
        if checks:
            gate(layers, quality.union_checks(checks), as_of)
    except GateFailed:
        for _, table, state in staged:
            table.discard(state)
        raise
    out = {}
    for fact, table, state in staged:
        out[fact.name] = publish(layers, fact, table, state, stage, frames, as_of)
        table.tidy()
        layers.view("gold", fact.name, table.read())
    return out


def publish(layers: Layers, fact: Fact, table: Table, state: Version, stage, frames: dict[str, DataFrame], as_of: dt.datetime) -> int:
    for left in reversed(range(PUBLISH_TRIES)):
        try:
            return table.publish(state)
        except Conflict:
            table.discard(state)
            if not left:
                raise
        _, table, state = stage(fact)
        rows = table.read(state)
        try:
            gate(layers, quality.union_checks(fact_checks(fact, rows, {**frames, fact.full_name: rows})), as_of)
        except GateFailed:
            table.discard(state)
            raise
    raise AssertionError("unreachable")

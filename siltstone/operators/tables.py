"""Published Parquet tables.

A run writes new files next to the old ones and publishes them by writing a new list of
parts. Spark's own ``_SUCCESS`` marker of that list is the commit, so readers see the old
or the new version and never something in between, and a failed run leaves no trace in
what they read. Tables are split by month of event time: an incremental run rewrites only
the months that hold replaced keys.

Two writers cannot take one version number: a number belongs to whoever creates its claim
file, which fails where one exists. A state that was built on an older version than the
newest one is refused, and ``commit`` builds it again on top of that.

A table with a catalog name is an ordinary table there too: each version is an external table over its
folders, and the published name a view that ``publish`` moves to the newest one.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import uuid
import zlib
from collections.abc import Callable
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.exprs import month_of, ntz_literal, utc_literal
from siltstone.operators.incremental import without_keys
from siltstone.session import hadoop_path

PART = "_part"
WHOLE = "all"
MONTH = re.compile(r"\d{4}-\d{2}$")
# A typed event time that is stored beside the rows and not shown to readers.
EVENT_AT = "_event_at"
# Keys of a batch up to which they are looked up by value: Parquet then skips row groups by their
# Bloom filters. More keys are found by a join with the key column.
FEW_KEYS = 2000
# Folders of one month above which ``tidy`` merges them.
MERGE_ABOVE = 4
# A claim without a finished list is another writer at work, and after this a writer that died.
CLAIM_SECONDS = 120.0
# Files no version refers to may be those of a writer at work; later they are of one that failed.
FAILED_AFTER = dt.timedelta(days=1)


class Conflict(RuntimeError):
    """Another writer published first; the refused state has to be built again."""


@dataclass(frozen=True)
class Version:
    """A table state: its schema, the directories its rows are in, by part, and the number of the
    version it was built on (None where it does not depend on one)."""

    schema: T.StructType
    parts: tuple[tuple[str, str], ...] = ()
    base: int | None = None


# States of published versions this process has read or written, by table path and number: they never
# change, and reading one takes a job.
_KNOWN: dict[tuple[str, int], Version] = {}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class Table:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        event_time: str | None = None,
        name: tuple[str, str] | None = None,
        key: str | None = None,
    ):
        """``name`` is the table's (database, table) in the catalog; ``key`` the column by which a batch
        replaces rows, whose files get Bloom filters."""
        self.key = key
        self.spark = spark
        self.path = path
        self.event_time = event_time
        self.name = name

    # -- reading ---------------------------------------------------------------

    def _listing(self, folder: str) -> list:
        hpath, fs = hadoop_path(self.spark, f"{self.path}/{folder}")
        return list(fs.listStatus(hpath)) if fs.exists(hpath) else []

    def _newest(self) -> int | None:
        """Number of the newest published version; unfinished ones do not count."""
        names = sorted((s.getPath().getName() for s in self._listing("_versions")), reverse=True)
        for name in names:
            done, fs = hadoop_path(self.spark, f"{self.path}/_versions/{name}/_SUCCESS")
            if fs.exists(done):
                return int(name)
        return None

    def exists(self) -> bool:
        return self._newest() is not None

    def current(self) -> Version:
        newest = self._newest()
        if newest is None:
            raise FileNotFoundError(f"nothing published at {self.path}")
        return self.version(newest)

    def version(self, number: int) -> Version:
        if (self.path, number) in _KNOWN:
            return _KNOWN[self.path, number]
        # one row per part: bounded by months and runs, not by the data
        rows = self.spark.read.schema("part string, path string, schema string").json(
            f"{self.path}/_versions/{number:08d}"
        )
        found = rows.collect()
        schema = T.StructType.fromJson(json.loads(next(r.schema for r in found if r.schema)))
        _KNOWN[self.path, number] = Version(schema, tuple((r.part, r.path) for r in found if r.path), number)
        return _KNOWN[self.path, number]

    def frame(self, version: Version, parts: set[str] | None = None) -> DataFrame:
        """Rows of a version. Older files lacking a later column read as null there."""
        paths = [p for part, p in version.parts if parts is None or part in parts]
        if not paths:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*(f"{self.path}/{p}" for p in paths))

    def read(self, version: Version | None = None) -> DataFrame:
        rows = self.frame(version or self.current())
        return rows.drop(EVENT_AT)

    def since(self, at: dt.datetime, version: Version | None = None) -> DataFrame:
        """Rows whose event time is not before ``at`` or not known: months before are not listed, and
        within a month the scan skips row groups by the bare column."""
        version = version or self.current()
        if EVENT_AT not in version.schema.fieldNames():
            return self.read(version)
        first = f"{at.year:04d}-{at.month:02d}"
        months = {part for part, _ in version.parts if not MONTH.match(part) or part >= first}
        rows = self.frame(version, months).where((F.col(EVENT_AT) >= ntz_literal(at)) | F.col(EVENT_AT).isNull())
        return rows.drop(EVENT_AT)

    def high_water_mark(self, version: Version | None = None):
        """Newest event time; it lies in the newest month, so only that is read."""
        version = version or self.current()
        dated = [part for part, _ in version.parts if part != "none"]
        if not dated:
            return None
        return self.frame(version, {max(dated)}).agg(F.max(self.event_time)).first()[0]

    # -- writing ---------------------------------------------------------------

    def by_month(self, df: DataFrame) -> DataFrame:
        """The rows of a month together, with its part, ready to be written.

        Few files per month, and a month too large for one task is split again by its size. The
        part may be there already, from rows of which each stands for many of these.
        """
        parted = df if PART in df.columns else df.withColumn(PART, month_of(self.event_time))
        return parted.hint("rebalance", PART)

    def _write(self, df: DataFrame, label: str, arranged: bool = False) -> list[tuple[str, str]]:
        """Write new files; returns their parts. ``arranged`` rows come from ``by_month``."""
        run = f"data/{label}-{uuid.uuid4().hex}"
        blooms = {f"parquet.bloom.filter.enabled#{self.key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
        options = blooms if self.key in df.columns else {}
        if self.event_time is None:
            df.write.options(**options).parquet(f"{self.path}/{run}")
            return [(WHOLE, run)]
        rows = df if arranged else self.by_month(df)
        rows.write.partitionBy(PART).options(**options).parquet(f"{self.path}/{run}")
        names = [s.getPath().getName() for s in self._listing(run) if s.isDirectory()]
        return [(n.split("=", 1)[1], f"{run}/{n}") for n in names]

    def stage_full(self, df: DataFrame, arranged: bool = False) -> Version:
        """A new state holding exactly ``df``."""
        return Version(df.drop(PART).schema, tuple(self._write(df, "full", arranged)))

    def stage_refresh(self, df: DataFrame, arranged: bool = False) -> Version:
        """A new state holding ``df``, in the structure the table already has.

        Known columns are reordered and cast, absent ones are null, unknown ones fail.
        """
        if not self.exists():
            return self.stage_full(df, arranged)
        schema = self.current().schema
        if EVENT_AT in df.columns and EVENT_AT not in schema.fieldNames():
            schema = T.StructType([*schema.fields, df.schema[EVENT_AT]])
        unknown = [c for c in df.columns if c not in schema.fieldNames() and c != PART]
        if unknown:
            raise ValueError(f"{self.path}: unknown columns {', '.join(unknown)}")
        aligned = df.select(
            *(
                (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema.fields
            ),
            *(c for c in df.columns if c == PART),
        )
        return replace(self.stage_full(aligned, arranged), schema=schema)

    def measure(self, version: Version, *metrics: Column) -> dict:
        """Row count and further aggregates of a staged state, from the files written.

        Reads only the columns asked for, and is exact whatever tasks were rerun.
        """
        return self.frame(version).agg(F.count(F.lit(1)).alias("rows"), *metrics).first().asDict()

    def stage_delete_insert(self, batch: DataFrame, key: str, old: Version | None = None) -> Version:
        """A new state in which the batch replaces the rows of its keys in ``old``, by default the
        newest version.

        The batch is written once and read back from there. Months in which no key of the
        batch occurs keep their files; new columns of the batch are added to the schema.
        """
        if not self.exists():
            return replace(self.stage_full(batch), base=0)
        old = old or self.current()
        known = {f.name: f for f in old.schema.fields}
        columns = [known.get(f.name, f) for f in batch.schema.fields if f.name != PART]
        cast = batch.select(
            *(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in columns), *(c for c in batch.columns if c == PART)
        )
        schema = T.StructType(old.schema.fields + [f for f in columns if f.name not in known])
        batch_parts = self._write(cast, "batch")
        staged = self.frame(Version(schema, tuple(batch_parts)))
        size = staged.count()  # from the footers
        if not size:
            return Version(schema, old.parts, old.base)
        keys = staged.select(key).where(F.col(key).isNotNull()).distinct()
        hit = self._hit(old, keys, key, size)
        kept = [p for p in old.parts if p[0] not in hit]
        if hit:
            kept += self._write(without_keys(self.frame(old, hit), keys, key), "kept")
        return Version(schema, tuple(kept + batch_parts), old.base)

    def with_keys(self, version: Version, keys: DataFrame, key: str, most: int) -> DataFrame:
        """Rows of a version whose key is among ``keys`` (distinct, not null, at most ``most``)."""
        rows = self.frame(version)
        if most <= FEW_KEYS and isinstance(rows.schema[key].dataType, T.AtomicType):
            return rows.where(F.col(key).isin([r[0] for r in keys.collect()]))
        return rows.join(keys, key, "left_semi")

    def _hit(self, old: Version, keys: DataFrame, key: str, most: int) -> set[str]:
        """Parts that hold one of the keys."""
        if self.event_time is None:
            return {WHOLE}
        months = self.with_keys(old, keys, key, most).select(month_of(self.event_time).alias("m")).distinct()
        return {r.m for r in months.collect()}  # one row per month

    def stage_compacted(self, above: int = 1) -> Version:
        """The same rows with one directory again for months that have more than ``above``."""
        version = self.current()
        seen: dict[str, int] = {}
        for part, _ in version.parts:
            seen[part] = seen.get(part, 0) + 1
        many = {part for part, n in seen.items() if n > above}
        if not many:
            return version
        kept = [p for p in version.parts if p[0] not in many]
        merged = self._write(self.frame(version, many), "compact")
        return Version(version.schema, tuple(kept + merged), version.base)

    def _claim(self, number: int) -> bool:
        """Whether this writer owns the number now: the file system creates a file once."""
        owner, fs = hadoop_path(self.spark, f"{self.path}/_versions/{number:08d}/_owner")
        try:
            fs.create(owner, False).close()
        except Py4JJavaError as error:
            if not fs.exists(owner):
                raise error
            return False
        for left in self._listing(f"_versions/{number:08d}"):  # of a writer that died
            if left.getPath().getName() != "_owner":
                fs.delete(left.getPath(), True)
        return True

    def _await(self, number: int) -> bool:
        """Waits for the writer that claimed a number; whether it published."""
        folder, fs = hadoop_path(self.spark, f"{self.path}/_versions/{number:08d}")
        owner = hadoop_path(self.spark, f"{self.path}/_versions/{number:08d}/_owner")[0]
        done = hadoop_path(self.spark, f"{self.path}/_versions/{number:08d}/_SUCCESS")[0]
        while not fs.exists(done):
            if not fs.exists(folder):
                return False
            claimed = fs.getFileStatus(owner if fs.exists(owner) else folder).getModificationTime() / 1000
            if time.time() - claimed > CLAIM_SECONDS:
                return False
            time.sleep(0.2)
        return True

    def publish(self, version: Version) -> int:
        """Make a staged state the one readers see.

        Raises ``Conflict`` if the state was built on a version that is no longer the newest.
        """
        while True:
            newest = self._newest() or 0
            if version.base is not None and version.base != newest:
                raise Conflict(f"{self.path}: version {newest} was published after {version.base}")
            number = newest + 1
            while not self._claim(number):
                if self._await(number):
                    break  # published meanwhile: look again
                number += 1  # its writer died
            else:
                break
        rows = [(None, None, version.schema.json()), *((part, path, None) for part, path in version.parts)]
        listing = self.spark.createDataFrame(rows, "part string, path string, schema string")
        listing.coalesce(1).write.mode("append").json(f"{self.path}/_versions/{number:08d}")
        _KNOWN[self.path, number] = replace(version, base=number)
        self.register()
        return number

    def commit(self, stage: Callable[[], Version], tries: int = 5) -> int:
        """Stage and publish; what another writer overtakes is staged again on its version."""
        for left in reversed(range(tries)):
            staged = stage()
            try:
                return self.publish(staged)
            except Conflict:
                self.discard(staged)
                if not left:
                    raise
        raise ValueError("tries must be positive")

    # -- catalog ---------------------------------------------------------------

    def _held(self, version: Version) -> str:
        """Name of the external table of a version; it depends on the folders, so it never changes
        what it shows."""
        folders = f"{self.path} {sorted(version.parts)} {version.schema.json()}"
        return f"{self.name[1]}__v{version.base:08d}_{zlib.crc32(folders.encode()):08x}".lower()

    def register(self) -> None:
        """Let the catalog name show the newest version. One statement switches it, so a query sees
        one version or the other."""
        if self.name is None or not self.exists():
            return
        version = self.current()
        database, table = (quoted(n) for n in self.name)
        held = f"{database}.{quoted(self._held(version))}"
        columns = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in version.schema.fields]
        run = self.spark.sql
        run(f"CREATE DATABASE IF NOT EXISTS {database}")
        folders = [f"'{self.path}/{path}'" for _, path in version.parts]
        if all(part == WHOLE for part, _ in version.parts) and len(folders) == 1:
            run(f"CREATE TABLE IF NOT EXISTS {held} ({', '.join(columns)}) USING parquet LOCATION {folders[0]}")
        else:
            keyed = ", ".join([*columns, f"{PART} string", "_run string"])
            run(f"CREATE TABLE IF NOT EXISTS {held} ({keyed}) USING parquet PARTITIONED BY ({PART}, _run) LOCATION '{self.path}/data'")
            keys = [f"PARTITION ({PART} = '{part}', _run = '{path.split('/')[1]}')" for part, path in version.parts]
            if keys:
                run(f"ALTER TABLE {held} ADD IF NOT EXISTS " + " ".join(f"{k} LOCATION {f}" for k, f in zip(keys, folders, strict=True)))
        shown = ", ".join(quoted(f.name) for f in version.schema.fields if f.name != EVENT_AT)
        run(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT {shown} FROM {held}")

    def _unregister(self, versions: list[Version]) -> None:
        for version in versions if self.name else ():
            self.spark.sql(f"DROP TABLE IF EXISTS {quoted(self.name[0])}.{quoted(self._held(version))}")

    def discard(self, staged: Version) -> None:
        """Delete the files of a staged state that will not be published."""
        used = self._runs(self._published())
        for run in {path.split("/")[1] for _, path in staged.parts} - used:
            folder, fs = hadoop_path(self.spark, f"{self.path}/data/{run}")
            fs.delete(folder, True)

    def tidy(self, keep: int = 7) -> None:
        """After a publish: merge months in many folders, drop old versions."""
        version = self.current()
        merged = self.stage_compacted(MERGE_ABOVE)
        if merged.parts != version.parts:
            self.publish(merged)
        self.expire(keep)

    def expire(self, keep: int = 7) -> None:
        """Drop all but the newest ``keep`` versions and the files only they refer to.

        Files that no version refers to may belong to a writer at work; those older than
        ``FAILED_AFTER`` are of a run that failed, and go too.
        """
        newest = self._newest()
        if newest is None or keep < 1:
            return
        _, fs = hadoop_path(self.spark, self.path)
        numbers = [int(s.getPath().getName()) for s in self._listing("_versions")]
        done = self._published()
        kept = done[-keep:]
        dropped = [n for n in numbers if n < kept[0]]
        used, gone = self._runs(kept), self._runs([n for n in dropped if n in done])
        if self.name:
            self._unregister([self.version(n) for n in dropped if n in done])
        for n in dropped:
            _KNOWN.pop((self.path, n), None)
            fs.delete(hadoop_path(self.spark, f"{self.path}/_versions/{n:08d}")[0], True)
        before = (time.time() - FAILED_AFTER.total_seconds()) * 1000
        for status in self._listing("data"):
            run = status.getPath().getName()
            if run not in used and (run in gone or status.getModificationTime() < before):
                fs.delete(status.getPath(), True)

    def _published(self) -> list[int]:
        numbers = sorted(int(s.getPath().getName()) for s in self._listing("_versions"))
        _, fs = hadoop_path(self.spark, self.path)
        return [n for n in numbers if fs.exists(hadoop_path(self.spark, f"{self.path}/_versions/{n:08d}/_SUCCESS")[0])]

    def _runs(self, numbers: list[int]) -> set[str]:
        """Folders below ``data`` that versions refer to."""
        if not numbers:
            return set()
        if all((self.path, n) in _KNOWN for n in numbers):
            return {path.split("/")[1] for n in numbers for _, path in _KNOWN[self.path, n].parts}
        listed = self.spark.read.schema("path string").json([f"{self.path}/_versions/{n:08d}" for n in numbers])
        # one row per part
        return {r.path.split("/")[1] for r in listed.where("path IS NOT NULL").distinct().collect()}


class Layers:
    """Tables and views by layer below one root folder.

    Each layer is a database of the catalog, named ``<prefix><layer>``.
    """

    LAYERS = ("raw", "silver", "gold")

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def ensure(self) -> None:
        for layer in self.LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(self.prefix + layer)}")

    def table(self, layer: str, name: str, event_time: str | None = None, key: str | None = None) -> Table:
        return Table(self.spark, f"{self.root}/{layer}/{name}", event_time, key=key, name=(self.prefix + layer, re.sub(r"\W", "_", name)))

    def attach(self) -> list[str]:
        """Register every published table, for a session whose catalog does not know them yet."""
        self.ensure()
        found = []
        for layer in self.LAYERS:
            hpath, fs = hadoop_path(self.spark, f"{self.root}/{layer}")
            for status in fs.listStatus(hpath) if fs.exists(hpath) else ():
                table = self.table(layer, status.getPath().getName())
                if table.exists():
                    table.register()
                    found.append(".".join(table.name))
        return sorted(found)

    def view(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Register for SQL users as ``<layer>_<name>``."""
        df.createOrReplaceTempView(f"{layer}_{name}")
        return df

    # -- audit -----------------------------------------------------------------

    AUDIT_SCHEMA = "at timestamp, severity string, dataset string, message string"

    def alert(self, at, dataset: str, message: str, severity: str = "CRITICAL") -> None:
        row = self.spark.createDataFrame([(severity, dataset, message)], "severity string, dataset string, message string")
        row = row.select(utc_literal(at).alias("at"), "*")
        # a folder of its own: alerts of datasets loaded side by side must not collide
        row.coalesce(1).write.parquet(f"{self.root}/audit/{uuid.uuid4().hex}")

    def alerts(self) -> DataFrame:
        hpath, fs = hadoop_path(self.spark, f"{self.root}/audit")
        if not fs.exists(hpath):
            return self.spark.createDataFrame([], self.AUDIT_SCHEMA)
        reader = self.spark.read.schema(self.AUDIT_SCHEMA).option("recursiveFileLookup", True)
        return reader.parquet(f"{self.root}/audit")

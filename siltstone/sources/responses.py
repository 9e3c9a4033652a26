"""Landed responses as a Python data source: records streamed out of the files, small files of one task
one after another.

Spark's JSON reader takes a file that is no JSON Lines file as one row, and a response whose records
lie below a path as one value. Here a file is read in pieces and each record leaves as its own
text, so memory follows the largest record and not the page. Spark parses the records with the
declared schema, like those of other files.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "landed_responses"
# Characters read at a time, and characters of records that leave together.
CHUNK, BATCH = 1 << 16, 1 << 20
# Bytes of files up to which one task reads several, and what opening a file counts.
TASK_BYTES, OPEN_BYTES = 128 << 20, 1 << 20
_SPACE = " \t\r\n"
_DECODER = json.JSONDecoder()


class JsonText:
    """JSON text that is read on demand; what has been consumed is let go."""

    def __init__(self, stream) -> None:
        self.stream, self.text, self.at, self.ended = stream, "", 0, False

    def more(self, wanted: int = CHUNK) -> bool:
        new = "" if self.ended else self.stream.read(wanted)
        self.ended = self.ended or not new
        self.text, self.at = self.text[self.at :] + new, 0
        return not self.ended

    def peek(self) -> str:
        """The next character that is no space; empty at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in _SPACE:
                self.at += 1
            if self.at < len(self.text) or not self.more():
                return self.text[self.at : self.at + 1]

    def take(self, expected: str) -> str:
        found = self.peek()
        if found == "" or found not in expected:
            raise ValueError(f"malformed JSON: expected one of {expected}, found {found or 'the end'}")
        self.at += 1
        return found

    def value(self) -> str:
        """The text of the next value. More is read in doubling steps until it is whole."""
        self.peek()
        wanted = CHUNK
        while True:
            try:
                end = _DECODER.raw_decode(self.text, self.at)[1]
                # a number may go on behind what has been read
                if end < len(self.text) or self.ended:
                    found, self.at = self.text[self.at : end], end
                    return found
            except json.JSONDecodeError:
                if self.ended:
                    raise
            self.more(wanted)
            wanted *= 2


def records(stream, path: tuple[str, ...]) -> Iterator[str]:
    """Texts of the records in a stream of JSON values.

    The record list lies below ``path`` of each value; one object there counts as a list of one. A
    path that is missing or leads through something that is no object gives no records.
    """
    text = JsonText(stream)
    while text.peek():
        yield from _below(text, path)


def _below(text: JsonText, path: tuple[str, ...]) -> Iterator[str]:
    first = text.peek()
    if path and first == "{":
        text.take("{")
        if text.peek() == "}":
            text.take("}")
            return
        while True:
            text.peek()
            key = json.loads(text.value())
            text.take(":")
            if key == path[0]:
                yield from _below(text, path[1:])
            else:
                text.value()
            if text.take(",}") == "}":
                return
    if not path and first == "[":
        text.take("[")
        if text.peek() == "]":
            text.take("]")
            return
        while True:
            yield text.value()
            if text.take(",]") == "]":
                return
    value = text.value()
    if not path and first == "{":
        yield value


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


def dealt(sizes: list[tuple[str, int]], at_least: int) -> list[Files]:
    """Files (path, bytes) in tasks: in ``at_least`` as long as there is something for each, and more
    where a task would get more than ``TASK_BYTES``. A page too large for that is a task of its own."""
    costs = [(path, size + OPEN_BYTES) for path, size in sizes]
    most = min(TASK_BYTES, -(-sum(cost for _, cost in costs) // max(1, at_least)))
    out: list[Files] = []
    mine: list[str] = []
    held = 0
    for path, cost in costs:
        if mine and held + cost > most:
            out.append(Files(tuple(mine)))
            mine, held = [], 0
        mine.append(path)
        held += cost
    return [*out, Files(tuple(mine))]


def _system(location: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(location) if "://" in location or location.startswith("file:") else (fs.LocalFileSystem(), location)


class ResponsesReader(DataSourceReader):
    def __init__(self, location: str, path: tuple[str, ...], tasks: int = 1):
        self.location, self.path, self.tasks = location, path, tasks

    def partitions(self) -> list[Files]:
        system, root = _system(self.location)
        found = system.get_file_info(fs.FileSelector(root, recursive=True)) if system.get_file_info(root).type == fs.FileType.Directory else [system.get_file_info(root)]
        files = sorted((f.path, f.size or 0) for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))
        if not files and any(f.type == fs.FileType.NotFound for f in found):
            raise FileNotFoundError(self.location)
        return dealt(files, self.tasks)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _system(self.location)
        waiting: list[str] = []
        size = 0
        for path in partition.paths:
            with system.open_input_stream(path) as raw:
                # decoded in pieces; a character may lie across two of them
                for record in records(_Utf8(raw), self.path):
                    waiting.append(record)
                    size += len(record)
                    if size >= BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(waiting, pa.string())], names=["record"])
                        waiting, size = [], 0
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(waiting, pa.string())], names=["record"])


class _Utf8:
    """Text of a byte stream."""

    def __init__(self, raw) -> None:
        self.raw, self.decoder = raw, codecs.getincrementaldecoder("utf-8-sig")()

    def read(self, n: int) -> str:
        while True:
            block = self.raw.read(n)
            out = self.decoder.decode(block, final=not block)
            if out or not block:
                return out


class LandedResponses(DataSource):
    """``spark.read.format("landed_responses").option("json_path", "a.b").load(folder)``: one row
    ``record`` (JSON text) per record of the folder's files."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "record string"

    def reader(self, schema: T.StructType) -> ResponsesReader:
        path = self.options.get("json_path") or ""
        return ResponsesReader(self.options["path"], tuple(p for p in path.split(".") if p), int(self.options.get("tasks") or 1))


def stream_responses(spark: SparkSession, location: str, schema: T.StructType, json_path: str | None = None) -> DataFrame:
    """The records of landed responses as rows of ``schema``; malformed text fails the job."""
    spark.dataSource.register(LandedResponses)
    tasks = spark.sparkContext.defaultParallelism
    found = spark.read.format(FORMAT).option("json_path", json_path or "").option("tasks", tasks).load(location)
    row = F.from_json("record", schema, {"mode": "FAILFAST"}).alias("row")
    return found.select(row).select("row.*")

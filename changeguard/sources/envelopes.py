"""Response envelopes as a Spark data source: ``{"status", "body": {<key>: [records], "info"}}``, one page a file.

Writing is all or nothing: tasks write pages under names of their own, and the
commit lists them in one manifest.  Pages that no manifest lists, of tasks that
were lost or repeated, are not read; an aborted write takes its pages away.  A
folder without any manifest is taken as collected responses, all of its
``.json`` files are read.  Files go to tasks by size.
"""

from __future__ import annotations

import datetime
import decimal
import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

NAME = "envelopes"
MANIFESTS = "_committed"
PAGE_ROWS = 200
TASK_BYTES = 64 << 20


def _place(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def _read_json(files: fs.FileSystem, path: str):
    with files.open_input_stream(path) as stream:
        return json.loads(stream.read())


def _write_json(files: fs.FileSystem, path: str, value) -> None:
    with files.open_output_stream(path) as stream:
        stream.write(json.dumps(value, ensure_ascii=False, separators=(",", ":")).encode())


def _plain(value, kind: T.DataType):
    """A value of a column of ``kind`` as JSON has it; decimals and times as text, instants in UTC."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return {f.name: _plain(v, f.dataType) for f, v in zip(kind, value)}
    if isinstance(kind, T.ArrayType):
        return [_plain(v, kind.elementType) for v in value]
    if isinstance(kind, T.MapType):
        return {str(k): _plain(v, kind.valueType) for k, v in value.items()}
    if isinstance(kind, T.DecimalType):
        return str(value)
    if isinstance(kind, T.TimestampType):  # Python has instants as local times
        return value.astimezone(datetime.timezone.utc).isoformat()
    return value.isoformat() if isinstance(value, datetime.date) else value


def _typed(value, kind: T.DataType):
    """A JSON value as one of ``kind``."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return tuple(_typed(value.get(f.name), f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return [_typed(v, kind.elementType) for v in value]
    if isinstance(kind, T.MapType):
        return {k: _typed(v, kind.valueType) for k, v in value.items()}
    if isinstance(kind, T.DecimalType):
        return decimal.Decimal(str(value))
    if isinstance(kind, T.TimestampType):
        return datetime.datetime.fromisoformat(value).astimezone().replace(tzinfo=None)
    if isinstance(kind, T.TimestampNTZType):
        return datetime.datetime.fromisoformat(value)
    if isinstance(kind, T.DateType):
        return datetime.date.fromisoformat(value)
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return float(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


@dataclass
class Pages(InputPartition):
    paths: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...]


class EnvelopeReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path, self.key = schema, options["path"], options.get("key", "data")
        self.task_bytes = int(options.get("task_bytes", TASK_BYTES))

    def partitions(self) -> list[Pages]:
        files, root = _place(self.path)
        found = files.get_file_info(fs.FileSelector(root))
        sizes = {f.base_name: f.size for f in found if f.type == fs.FileType.File and f.extension == "json"}
        manifests = [f for f in found if f.base_name == MANIFESTS]
        if manifests:
            listed = [n for f in files.get_file_info(fs.FileSelector(manifests[0].path)) for n in _read_json(files, f.path)["pages"]]
            sizes = {name: sizes[name] for name in listed}
        out, held, room = [], [], 0
        for name, size in sorted(sizes.items()):
            held.append(posixpath.join(root, name))
            room += size
            if room >= self.task_bytes:
                out.append(Pages(tuple(held)))
                held, room = [], 0
        return out + ([Pages(tuple(held))] if held or not out else [])

    def read(self, partition: Pages) -> Iterator[tuple]:
        files, _ = _place(self.path)
        for path in partition.paths:
            page = _read_json(files, path)
            for record in page.get("body", {}).get(self.key) or []:
                yield tuple(page.get("status") if f.name == "status" and "status" not in record
                            else _typed(record.get(f.name), f.dataType) for f in self.schema)


class EnvelopeWriter(DataSourceWriter):
    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        self.schema, self.path, self.key = schema, options["path"], options.get("key", "data")
        self.page_rows, self.overwrite, self.run = int(options.get("page_rows", PAGE_ROWS)), overwrite, uuid.uuid4().hex
        files, root = _place(self.path)
        files.create_dir(posixpath.join(root, MANIFESTS))

    def write(self, rows: Iterator[T.Row]) -> Written:
        files, root = _place(self.path)
        names, held, attempt = [], [], uuid.uuid4().hex[:12]

        def close(more: bool) -> None:
            name = f"page-{self.run}-{attempt}-{len(names):06d}.json"
            info = {"count": len(held), "more_records": more}
            _write_json(files, posixpath.join(root, name), {"status": 200, "body": {self.key: held, "info": info}})
            names.append(name)

        for row in rows:
            if len(held) == self.page_rows:
                close(True)
                held.clear()
            held.append(_plain(row, self.schema))
        if held:
            close(False)
        return Written(tuple(names))

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _place(self.path)
        folder = posixpath.join(root, MANIFESTS)
        before = [f.path for f in files.get_file_info(fs.FileSelector(folder))] if self.overwrite else []
        pages = [name for m in messages if m is not None for name in m.names]
        _write_json(files, posixpath.join(folder, f"{self.run}.json"), {"pages": pages})
        for path in before:
            files.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _place(self.path)
        for message in messages:
            for name in message.names if message is not None else ():
                files.delete_file(posixpath.join(root, name))


class EnvelopeSource(DataSource):
    """``spark.read.format("envelopes")``; options ``path``, ``key``, ``page_rows``, ``task_bytes``.

    A schema is required for reading; a column ``status`` that records lack is
    the status of their page.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: T.StructType) -> EnvelopeReader:
        return EnvelopeReader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> EnvelopeWriter:
        return EnvelopeWriter(schema, dict(self.options), overwrite)


def register(spark: SparkSession) -> str:
    """Make the format known to the session; returns its name."""
    spark.dataSource.register(EnvelopeSource)
    return NAME


def write_envelopes(df: DataFrame, path: str, key: str = "data", mode: str = "append", page_rows: int = PAGE_ROWS) -> None:
    df.write.format(register(df.sparkSession)).option("key", key).option("page_rows", page_rows).mode(mode).save(path)


def load_envelopes(spark: SparkSession, path: str, schema: T.StructType | str, key: str = "data") -> DataFrame:
    return spark.read.format(register(spark)).schema(schema).option("key", key).load(path)

"""External sinks: load into any connector of the session, and a connector of our own.

``ExternalSink`` has the methods the loader needs of a warehouse, so a freeze is
loaded through any Spark connector; types follow the profile, as in a warehouse,
or the table that is already there where the connector can read it.

``CommittedFiles`` is such a connector, written as a Python data source: tasks write
Parquet files under names of their attempt's own, and the load becomes visible by
one manifest that names the files of the attempts that succeeded.  A failed
task deletes its file; files of lost executors are named by no manifest and never read.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.members import filesystem, open_binary, open_output
from .warehouse import write_format

LOADS = "_loads"
# Bytes of files a reading task gets, but for a longer file.
SPLIT_BYTES = 128 << 20


class ExternalSink:
    """Tables of an external system: ``<prefix>/<table>`` for a folder, else ``<prefix>.<table>``."""

    def __init__(self, spark: SparkSession, fmt: str, prefix: str, options: Mapping[str, str] | None = None):
        self.spark, self.fmt, self.prefix, self.options = spark, fmt, prefix, dict(options or {})
        self._schemas: dict[str, T.StructType] = {}
        if fmt == CommittedFiles.name():
            spark.dataSource.register(CommittedFiles)

    def target(self, table: str) -> str:
        return f"{self.prefix.rstrip('/')}/{table}" if "/" in self.prefix else f"{self.prefix}.{table}"

    def read(self, table: str) -> DataFrame:
        reader, target = self.spark.read.format(self.fmt).options(**self.options), self.target(table)
        return reader.load(target) if "/" in target else reader.option("table", target).load()

    def exists(self, table: str) -> bool:
        """Whether the connector can read the table (one that only writes never can)."""
        return bool(self._there(table))

    def _there(self, table: str) -> T.StructType | None:
        if self.fmt == CommittedFiles.name() and not _loads(self.target(table)):
            return None
        try:
            return self.read(table).schema
        except PySparkException:
            return None

    def create_if_absent(self, table: str, schema: T.StructType, **_) -> bool:
        """Settle the table's types: its own where it is there, else ``schema``; the connector makes it
        with the first rows."""
        there = self._there(table)
        self._schemas[table] = there or schema
        return not there

    def schema(self, table: str) -> T.StructType:
        if table not in self._schemas:
            self._schemas[table] = self.read(table).schema
        return self._schemas[table]

    def append(self, df: DataFrame, table: str) -> None:
        """Append rows; columns are matched by name (missing ones are NULL)."""
        # The writer looks Python sources up in the thread's active session; the loader's threads have none.
        self.spark._jvm.org.apache.spark.sql.SparkSession.setActiveSession(self.spark._jsparkSession)
        have = set(df.columns)
        typed = df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                            for f in self.schema(table).fields])
        write_format(typed, self.fmt, self.target(table), **self.options)


@dataclass
class _Written(WriterCommitMessage):
    path: str | None
    rows: int = 0
    bytes: int = 0


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(None)
        self.paths = paths


def _loads(folder: str) -> list[dict]:
    """The loads that are in force, oldest first: those since the latest that replaced the table."""
    fs, inner = filesystem(f"{folder}/{LOADS}")
    names = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
                   if i.path.endswith(".json"))
    loads = []
    for name in names:
        with fs.open_input_file(name) as fh:
            load = json.loads(fh.read())
        loads = [load] if load["replaces"] else [*loads, load]
    return loads


class CommittedFiles(DataSource):
    """``format("frostline_files")`` with the path of a table's folder."""

    @classmethod
    def name(cls) -> str:
        return "frostline_files"

    @property
    def folder(self) -> str:
        return self.options["path"].rstrip("/")

    def schema(self) -> T.StructType:
        if not (loads := _loads(self.folder)):
            raise FileNotFoundError(f"nothing was loaded into {self.folder}")
        return T.StructType.fromJson(loads[-1]["schema"])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.folder, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        loads = [] if overwrite else _loads(self.folder)
        kinds = lambda s: [(f["name"], f["type"]) for f in s["fields"]]
        if loads and kinds(loads[-1]["schema"]) != kinds(json.loads(schema.json())):
            raise ValueError(f"{self.folder} has other columns: {T.StructType.fromJson(loads[-1]['schema']).simpleString()}")
        return _Writer(self.folder, schema, overwrite)


class _Reader(DataSourceReader):
    def __init__(self, folder: str, schema: T.StructType):
        self.folder, self.schema = folder, schema

    def partitions(self) -> list[_Files]:
        tasks: list[_Files] = []
        room = 0
        for load in _loads(self.folder):
            for f in load["files"]:
                if room <= 0:
                    tasks.append(_Files([]))
                    room = SPLIT_BYTES
                tasks[-1].paths.append(f["path"])
                room -= f["bytes"]
        return tasks or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        kind = to_arrow_schema(self.schema)
        for path in partition.paths:
            with open_binary(path) as fh:
                for batch in pq.ParquetFile(fh).iter_batches():
                    yield from pa.Table.from_batches([batch]).cast(kind).to_batches()


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, schema: T.StructType, overwrite: bool):
        self.folder, self.schema, self.overwrite = folder, schema, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        path, rows, sink, out = f"{self.folder}/part-{uuid.uuid4().hex}.parquet", 0, None, None
        try:
            for batch in iterator:
                if out is None:
                    sink = open_output(path)
                    out = pq.ParquetWriter(sink, batch.schema)
                out.write_batch(batch)
                rows += batch.num_rows
            if out is None:
                return _Written(None)
            out.close()
            sink.close()
        except BaseException:
            if sink is not None:
                sink.close()
                _delete(path)
            raise
        fs, inner = filesystem(path)
        return _Written(path, rows, fs.get_file_info(inner).size)

    def commit(self, messages: list[_Written | None]) -> None:
        """Make the load visible: one manifest, under its name only when it is whole."""
        files = [{"path": m.path, "rows": m.rows, "bytes": m.bytes} for m in messages if m is not None and m.path]
        name = f"{self.folder}/{LOADS}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        load = {"replaces": self.overwrite, "schema": json.loads(self.schema.json()), "files": files}
        with open_output(f"{name}.tmp") as fh:
            fh.write(json.dumps(load).encode())
        fs, inner = filesystem(name)
        fs.move(f"{inner}.tmp", f"{inner}.json")

    def abort(self, messages: list[_Written | None]) -> None:
        for m in messages:
            if m is not None and m.path:
                _delete(m.path)


def _delete(path: str) -> None:
    fs, inner = filesystem(path)
    if fs.get_file_info(inner).type == pafs.FileType.File:
        fs.delete_file(inner)

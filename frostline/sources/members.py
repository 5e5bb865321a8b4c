"""Files and members of archives, and the source that plans how they are read.

A member is one file of a data freeze.  ``MemberSource`` plans its partitions as
Spark plans splits of a text file: an archive is cut into ranges of bytes, small
archives and files share a partition, and a partition takes the entries whose
data begin in its range.  So the work is dealt by compressed bytes, each task
reads the directory of its own archives, and the driver sees names and lengths of
the files it was given, but no entry of an archive.
"""

from __future__ import annotations

import fnmatch
import json
import os
import re
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Compressed bytes a task gets at most, where entries allow it, and what opening a path counts as.
SPLIT_BYTES = 64 << 20
OPEN_BYTES = 1 << 20


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))


def open_binary(path: str):
    """Open a local path, ``file:`` URI or any file system URI pyarrow knows, to read at any place."""
    fs, inner = filesystem(path)
    return open(inner, "rb") if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(inner)


def open_output(path: str):
    """Open a file for writing, in a folder that is made where it is missing
    (so executors can write to the shared folder of a cluster)."""
    fs, inner = filesystem(path)
    if isinstance(fs, pafs.LocalFileSystem):
        os.makedirs(os.path.dirname(inner) or ".", exist_ok=True)
        return open(inner, "wb")
    return fs.open_output_stream(inner)


def find_files(spark: SparkSession, pattern: str | Sequence[str], recursive: bool = False,
               glob: str | None = None) -> DataFrame:
    """Paths (and sizes) of files under paths/globs; contents are not read."""
    paths = [pattern] if isinstance(pattern, str) else list(pattern)
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths).select(F.col("path"), F.col("length").alias("size"))


@dataclass(frozen=True)
class Piece:
    """What a task reads of one path: the whole of a file, or the entries of an
    archive whose data begin at ``start`` or after it and before ``end``."""
    path: str
    archive: bool
    start: int = 0
    end: int | None = None
    error: str | None = None


class Pieces(InputPartition):
    def __init__(self, pieces: list[Piece]):
        super().__init__(None)
        self.pieces = pieces


def _paths(pattern: str) -> list[tuple[str, int]]:
    """``(path, length)`` of a file, of a folder's files, or of the files a pattern matches."""
    fs, inner = filesystem(pattern)
    prefix = pattern[:len(pattern) - len(inner)] if pattern.endswith(inner) else pattern.split("://")[0] + "://"
    here = fs.get_file_info(inner)
    if here.type == pafs.FileType.File:
        return [(pattern, here.size)]
    if isinstance(fs, pafs.LocalFileSystem):
        inner = os.path.abspath(inner)
    base = inner
    if here.type == pafs.FileType.NotFound:
        if not (magic := re.search(r"[*?\[]", inner)):
            return []
        base = inner[:magic.start()].rpartition("/")[0] or ("/" if inner.startswith("/") else ".")
    deep = here.type == pafs.FileType.NotFound and "/" in inner[len(base) + 1:]
    found = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True, recursive=deep))
    want = None
    if here.type == pafs.FileType.NotFound:  # a pattern's part never crosses a folder
        want = [fnmatch.translate(part) for part in inner.split("/")]
    out = []
    for info in found:
        parts = info.path.split("/")
        fits = want is None or (len(parts) == len(want) and all(map(re.match, want, parts)))
        if info.type == pafs.FileType.File and fits and not info.base_name.startswith(("_", ".")):
            out.append((prefix + info.path, info.size))
    return sorted(out)


def plan_pieces(paths: Sequence[str], archives: bool, tasks: int = 1, split_bytes: int = SPLIT_BYTES) -> list[list[Piece]]:
    """The pieces of each task: about ``tasks`` of them, or more of at most
    ``split_bytes`` but for a longer file or entry."""
    whole: list[tuple[int, str]] = []
    planned: list[list[Piece]] = []
    for path in paths:
        found = _archive(path) if archives else _paths(path)
        whole += [(size, name) for name, size in found]
        if not found:
            planned.append([Piece(path, archives, error=("not a readable archive: " if archives else "") + "no such file")])
    share = sum(size + OPEN_BYTES for size, _ in whole) // max(1, tasks)
    most = max(1, min(split_bytes, max(OPEN_BYTES, share)))
    cut: list[tuple[int, Piece]] = []
    for size, name in whole:
        if not archives:
            cut.append((size, Piece(name, False)))
            continue
        starts = range(0, max(size, 1), most)
        cut += [(min(most, size - start), Piece(name, True, start, start + most if start + most < size else None))
                for start in starts]
    room = 0
    for size, piece in sorted(cut, key=lambda c: (-c[0], c[1].path, c[1].start)):
        if not room:
            planned.append([])
            room = most
        planned[-1].append(piece)
        room = max(0, room - size - OPEN_BYTES)
    return planned


def _archive(path: str) -> list[tuple[str, int]]:
    fs, inner = filesystem(path)
    info = fs.get_file_info(inner)
    return [] if info.type == pafs.FileType.NotFound else [(path, info.size or 0)]


def entries(piece: Piece) -> Iterator[tuple[int, zipfile.ZipInfo]]:
    """``(place in the directory, entry)`` of a piece of an archive, folders left out.

    The archive is recognised by its content, not its suffix (a zip may be named ``.gz``).
    """
    with open_binary(piece.path) as fh, zipfile.ZipFile(fh) as zf:
        for place, info in enumerate(zf.infolist()):
            if not info.is_dir() and piece.start <= info.header_offset and (piece.end is None or info.header_offset < piece.end):
                yield place, info


class MemberSource(DataSource):
    """``spark.read.format("frostline_members")``: one row per wanted member, staged as text.

    Option ``request`` is a JSON object: ``archives`` or ``files`` (paths, folders and
    patterns), the wanted ``members`` (all, if empty) and the settings of ``sources.staging``.
    Reading writes each member's text under a name of the attempt's own.
    """

    @classmethod
    def name(cls) -> str:
        return "frostline_members"

    def schema(self) -> str:
        from .staging import META_SCHEMA
        return META_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _MemberReader(json.loads(self.options["request"]))


class _MemberReader(DataSourceReader):
    def __init__(self, request: dict):
        self.request = request

    def partitions(self) -> list[Pieces]:
        archives = self.request.get("archives") or []
        planned = plan_pieces(archives or self.request["files"], bool(archives), self.request.get("tasks") or 1,
                              self.request.get("split_bytes") or SPLIT_BYTES)
        return [Pieces(pieces) for pieces in planned]

    def read(self, partition: Pieces) -> Iterator[tuple]:
        from .staging import stage_pieces
        return stage_pieces(partition.pieces, self.request)

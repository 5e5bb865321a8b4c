"""Staging of members as streams: bounded memory for a member of any size.

An executor streams each member out of its archive (or file) in chunks, decodes
cp1252, repairs quotes, strips the text, applies the file patches and writes
UTF-8 text under ``<table_name>/_member_id=<id>/``.  The rules are carried
across chunk boundaries (a pending backslash, pending whitespace, the tail a
patch could still match), so the chunk size never shows in the text.

A member is one *entry* of an archive: two entries of one name are two members.
Each attempt writes a file of its own name and reports it, so a retried or
speculative task never writes into another's file; the loader reads the
reported files alone.  A fault of the data (checksum, broken archive, a byte
cp1252 leaves undefined) is reported on the member's row; a fault of the file
system fails the task, which Spark runs again.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import lzma
import os
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.naming import table_name_from_path_text
from .members import MemberSource, Piece, entries, open_binary, open_output

META_SCHEMA = ("archive string, member string, table_name string, member_id string, path string, "
               "header string, header_length long, status string, error string")
#: Cleaned header names never begin with an underscore, so no column can take this name.
MEMBER_ID = "_member_id"
CHUNK = 4 << 20
_HEADER_WS = " \t\n\x0b\f\r"
# What a broken or unsupported entry raises; OSError is the file system's.
_DATA_FAULTS = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, NotImplementedError, RuntimeError)


def member_id(archive: str | None, entry: int, member: str) -> str:
    return "m" + hashlib.sha256(f"{archive or ''}\0{entry}\0{member}".encode()).hexdigest()


def _decode(chunks: Iterable[bytes], errors: str) -> Iterator[str]:
    dec = codecs.getincrementaldecoder("cp1252")(
        errors="strict" if errors == "strict" else errors)
    for b in chunks:
        yield dec.decode(b)
    tail = dec.decode(b"", final=True)
    if tail:
        yield tail


def _newlines(parts: Iterable[str]) -> Iterator[str]:
    """CRLF and lone CR to LF (a trailing CR waits for the next chunk)."""
    carry = ""
    for p in parts:
        s = carry + p
        carry = ""
        if s.endswith("\r"):
            s, carry = s[:-1], "\r"
        yield s.replace("\r\n", "\n").replace("\r", "\n")
    if carry:
        yield "\n"


def _unescape_quotes(parts: Iterable[str]) -> Iterator[str]:
    """Every backslash-quote becomes a doubled quote (a trailing backslash
    waits for the next chunk)."""
    carry = ""
    for p in parts:
        s = carry + p
        carry = ""
        if s.endswith("\\"):
            s, carry = s[:-1], "\\"
        yield s.replace('\\"', '""')
    if carry:
        yield carry


def _strip(parts: Iterable[str]) -> Iterator[str]:
    """``str.strip()`` over a stream: leading whitespace dropped, trailing
    whitespace held back until more text follows."""
    started = False
    pending = ""
    for p in parts:
        if not started:
            p = p.lstrip()
            if not p:
                continue
            started = True
        body = p.rstrip()
        if body:
            yield pending + body
            pending = p[len(body):]
        else:
            pending += p


def _replace(parts: Iterable[str], old: str, new: str) -> Iterator[str]:
    """Literal, single-pass, left-to-right replacement across chunk boundaries
    (replaced text is never searched again, as in a whole-text replace)."""
    keep = len(old) - 1
    buf = ""
    for p in parts:
        buf += p
        out = []
        while True:
            i = buf.find(old)
            if i < 0:
                break
            out.append(buf[:i])
            out.append(new)
            buf = buf[i + len(old):]
        if len(buf) > keep:
            cut = len(buf) - keep
            out.append(buf[:cut])
            buf = buf[cut:]
        if out:
            yield "".join(out)
    if buf:
        yield buf


def repaired_text(chunks: Iterable[bytes], member: str, errors: str,
                  patches: Sequence[tuple[str, str, str]], newlines: bool = True) -> Iterator[str]:
    parts = _decode(chunks, errors)
    if newlines:
        parts = _newlines(parts)
    parts = _strip(_unescape_quotes(parts))
    for marker, old, new in patches:
        if marker in member and old:
            parts = _replace(parts, old, new)
    return parts


def _chunks(fh) -> Iterator[bytes]:
    while True:
        b = fh.read(CHUNK)
        if not b:
            return
        yield b


class _Archive:
    """The archive open at hand: a task's members come sorted by archive, so its
    directory is read once for all of them."""

    def __init__(self):
        self.path = self.file = self.zip = None

    def open(self, path: str, entry: int):
        if path != self.path:
            self.close()
            self.file = open_binary(path)
            self.zip = zipfile.ZipFile(self.file)
            self.path = path
        return self.zip.open(self.zip.infolist()[entry])

    def close(self) -> None:
        for held in (self.zip, self.file):
            if held is not None:
                held.close()
        self.path = self.file = self.zip = None


def _stage_one(open_archive: _Archive, archive: str | None, entry: int, member: str, text_dir: str, errors: str,
               patches: Sequence[tuple[str, str, str]], exclude: str | None, newlines: bool):
    mid = member_id(archive, entry, member)
    try:
        table = table_name_from_path_text(member)
    except ValueError:
        table = ""
    if not table:
        return archive, member, None, mid, None, None, None, "error", "member name gives an empty table name"
    if exclude and re.search(exclude, table):
        return archive, member, table, mid, None, None, None, "excluded", "table excluded by pattern"
    path = os.path.join(text_dir, table, f"{MEMBER_ID}={mid}", f"{uuid.uuid4().hex}.txt")
    header, whole = "", False
    try:
        with (open_archive.open(archive, entry) if archive else open_binary(member)) as fin, open_output(path) as out:
            for part in repaired_text(iter(lambda: fin.read(CHUNK), b""), member, errors, patches, newlines):
                if not whole:
                    line, end, _ = part.partition("\n")
                    header, whole = header + line, bool(end)
                out.write(part.encode("utf-8"))
            out.write(b"\n")
    except UnicodeDecodeError:
        return archive, member, table, mid, None, None, None, "error", "byte undefined in cp1252"
    except _DATA_FAULTS as fault:
        return archive, member, table, mid, None, None, None, "error", f"{type(fault).__name__}: {fault}"
    header = header.removesuffix("\r")
    return archive, member, table, mid, path, header, len(header.strip(_HEADER_WS)), "pending", None


def stage_pieces(pieces: Sequence[Piece], request: dict) -> Iterator[tuple]:
    """Stage the wanted members of a task's pieces; one ``META_SCHEMA`` row each.

    Entries that are not wanted give no row; one that is wanted but not a CSV file
    (with ``csv_only``) is reported as skipped.  An archive that cannot be read gives one error row.
    """
    wanted = set(request.get("members") or [])
    held = _Archive()

    def staged(archive: str | None, entry: int, member: str) -> tuple:
        return _stage_one(held, archive, entry, member, request["text_dir"], request["errors"], request["patches"],
                          request.get("exclude"), request["newlines"])

    try:
        for piece in pieces:
            if piece.error:
                yield (piece.path if piece.archive else None, piece.path, None, "", None, None, None,
                       "error" if piece.archive else "not_found", piece.error)
            elif not piece.archive:
                yield staged(None, 0, piece.path)
            else:
                try:
                    found = list(entries(piece))
                except (zipfile.BadZipFile, FileNotFoundError, IsADirectoryError) as fault:
                    # The input is at fault; other failures of the file system are retried with the task.
                    if piece.start == 0:
                        yield piece.path, piece.path, None, "", None, None, None, "error", f"not a readable archive: {fault}"
                    continue
                for entry, info in found:
                    if wanted and info.filename not in wanted:
                        continue
                    if request.get("csv_only") and not info.filename.lower().endswith(".csv"):
                        yield (piece.path, info.filename, None, member_id(piece.path, entry, info.filename), None, None, None,
                               "skipped", "not a CSV member")
                    else:
                        yield staged(piece.path, entry, info.filename)
    finally:
        held.close()


def stage_members(spark: SparkSession, text_dir: str, errors: str, patches: Sequence[tuple[str, str, str]],
                  archives: Sequence[str] | None = None, files: Sequence[str] | None = None,
                  members: Sequence[str] | None = None, exclude: str | None = None, newlines: bool = True,
                  csv_only: bool = False, split_bytes: int | None = None) -> DataFrame:
    """Stream each wanted member into the staging folder; one row per member
    (``META_SCHEMA``).  Lazy: run it with one action."""
    request = {"archives": list(archives or []), "files": list(files or []), "members": list(members or []),
               "text_dir": text_dir, "errors": errors, "patches": [list(p) for p in patches], "exclude": exclude,
               "newlines": newlines, "csv_only": csv_only, "split_bytes": split_bytes,
               "tasks": spark.sparkContext.defaultParallelism}
    spark.dataSource.register(MemberSource)
    return spark.read.format(MemberSource.name()).schema(META_SCHEMA).option("request", json.dumps(request)).load()

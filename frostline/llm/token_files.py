"""Token files: concatenated token ids with Elias-Fano coded document boundaries.

``write_token_files`` range-sorts documents by id, encodes each in its task and
writes one file a range into a shared folder; ``read_token_files`` reads files
back as rows; ``TokenFile`` gives single documents at random.

A file holds, in this order::

    token ids          little-endian, 2 bytes each (4 if the vocabulary needs it)
    boundaries         Elias-Fano code of where each document ends
    document ids       Elias-Fano code of the ids that are not null
    footer             sizes of the three, id width, documents, null ids, mark

Ids precede the code, so a file is written in one pass; only the boundaries of
a file's documents are held meanwhile.  Files are written under a name of the
task attempt and then renamed: a task that is run again, or twice at once,
leaves one whole file under the final name.

Cases: a null or empty text has only the end id.  Documents without an id come
last.  Rows that share an id are ordered by a hash of their text.  An empty
table gives no file and no rows.  Other columns are not stored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .coded import cuts_of
from .elias_fano import EliasFano
from .pieces import Pieces, pieces_of
from .words import groups_of

#: Text bytes that go into one file (about 2/3 of that in ids of two bytes).
FILE_TEXT_BYTES = 16 << 20
# Token ids that a reader holds at once, besides those of a longer document.
_READ_IDS = 1 << 20
_MARK = b"TOKENSEF"
_FOOTER = "<QQQBQQ8s"

# Text bytes that are encoded at a time.
_TEXT_BYTES = 8 << 20
# Cuts are made before white space that follows something else: the tokenizer
# never joins across such a place (``coded.cuts_of`` has the exact places).
_PIECE = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))
    return pafs.LocalFileSystem(), path


def cuts_are_safe(pieces: Pieces) -> bool:
    text = "A bee's  sting\n 2two\r\n\t x\n\nEnd. \n"
    return sum(pieces.encode(_PIECE.findall(text)), []) == pieces.encode([text])[0]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int,
                      doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files; ``(file int, path, n_docs, n_ids, start)`` of each, in order of ids."""
    ensure_checkpoint_dir(docs.sparkSession)
    pieces = Pieces(tokenizer)
    if not cuts_are_safe(pieces):
        raise ValueError("the tokenizer joins words across white space that follows them")
    width = 2 if max(pieces.tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else 4
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"]
    files = max(1, -(-int(total or 0) // FILE_TEXT_BYTES))
    key = F.col("doc_id").asc_nulls_last()
    dealt = rows.repartitionByRange(files, key).sortWithinPartitions(key, F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        fs, place = filesystem(folder)
        own = f"{place}/.{number:06d}-{uuid.uuid4().hex}"
        ends, ids, nulls, out = [np.zeros(1, np.int64)], [], 0, None
        known = pieces_of(tokenizer)
        for batch in batches:
            sizes = [1 + (n or 0) for n in pc.binary_length(batch.column(1)).to_pylist()]
            for a, b in groups_of(sizes, _TEXT_BYTES):
                of = batch.slice(a, b - a)
                if out is None:
                    fs.create_dir(place, recursive=True)
                    out = fs.open_output_stream(own)
                data, lengths = _encoded(of.column(1).to_pylist(), known, end_id, width)
                out.write(data)
                ends.append(ends[-1][-1] + np.cumsum(lengths))
                given = of.column(0).drop_null()
                nulls += of.num_rows - len(given)
                ids.append(given.cast(pa.int64()).to_numpy(zero_copy_only=False))
        if out is None:
            return
        bounds = np.concatenate(ends)
        codes = [EliasFano.of(bounds).to_bytes(), EliasFano.of(np.concatenate(ids)).to_bytes()]
        n_docs, n_ids = len(bounds) - 1, int(bounds[-1])
        out.write(b"".join(codes))
        out.write(struct.pack(_FOOTER, n_ids * width, len(codes[0]), len(codes[1]), width, n_docs, nulls, _MARK))
        out.close()
        final = f"{place}/tokens-{number:06d}.bin"
        fs.move(own, final)
        uri = f"{folder.rstrip('/')}/tokens-{number:06d}.bin"
        yield pa.RecordBatch.from_pydict({"file": pa.array([number], pa.int32()), "path": [uri],
                                          "n_docs": pa.array([n_docs], pa.int64()), "n_ids": pa.array([n_ids], pa.int64())})

    written = dealt.mapInArrow(write, "file int, path string, n_docs long, n_ids long").checkpoint()
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _encoded(texts: list[str | None], pieces: Pieces, end_id: int, width: int) -> tuple[bytes, np.ndarray]:
    """The ids of the texts, each with the end id, and how many each has."""
    whole = [t.encode() if t else b"" for t in texts]
    data = b"".join(whole)
    sizes = np.fromiter(map(len, whole), np.int64, len(whole))
    begins = np.cumsum(sizes) - sizes
    cuts = cuts_of(np.frombuffer(data, np.uint8), begins[sizes > 0]) if data else begins[:0]
    found, counts = pieces.ids_of(data, cuts)
    before = np.append(0, np.cumsum(counts))  # ids before each piece
    lengths = np.diff(before[np.searchsorted(cuts, np.append(begins, len(data)))]) + 1
    ends = np.cumsum(lengths) - 1
    ids = np.full(len(found) + len(texts), end_id, f"<u{width}")
    own = np.ones(len(ids), bool)
    own[ends] = False
    ids[own] = found
    return ids.tobytes(), lengths


class TokenFile:
    """One token file, open for reading."""

    def __init__(self, path: str):
        fs, place = filesystem(path)
        self.file = fs.open_input_file(place)
        size = self.file.size()
        if size < struct.calcsize(_FOOTER):
            raise ValueError(f"{path} is not a token file")
        ids, bounds, docs, self.width, self.n_docs, self.nulls, mark = struct.unpack(
            _FOOTER, self.file.read_at(struct.calcsize(_FOOTER), size - struct.calcsize(_FOOTER)))
        if mark != _MARK:
            raise ValueError(f"{path} is not a token file")
        self.bounds = EliasFano.from_bytes(self.file.read_at(bounds, ids))
        self.doc_ids = EliasFano.from_bytes(self.file.read_at(docs, ids + bounds))

    def _ids(self, a: int, b: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at((b - a) * self.width, a * self.width), dtype=f"<u{self.width}")

    def document(self, i: int) -> tuple[int | None, np.ndarray]:
        """The id and the tokens of the i-th document."""
        doc_id = self.doc_ids.select(i) if i < self.doc_ids.n else None
        return doc_id, self._ids(self.bounds.select(i), self.bounds.select(i + 1))

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(doc_id, start in this file, tokens)`` of each document, a stretch of the file at a time."""
        bounds = self.bounds.values()
        doc_ids = [*self.doc_ids.values().tolist(), *[None] * self.nulls]
        i = 0
        while i < self.n_docs:
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + _READ_IDS, side="right")) - 1)
            tokens = self._ids(int(bounds[i]), int(bounds[j]))
            for d in range(i, j):
                yield doc_ids[d], int(bounds[d]), tokens[bounds[d] - bounds[i]:bounds[d + 1] - bounds[i]]
            i = j


def read_token_files(spark: SparkSession, files: DataFrame, tokens: bool = True) -> DataFrame:
    """Rows of the files of ``write_token_files``: ``doc_id, start, n_tokens, ids_crc32`` and, if asked, ``ids``.

    ``start`` counts the ids of all documents before, over all files;
    ``ids_crc32`` is the CRC-32 of the ids as little-endian 32-bit integers.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if tokens else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                held = 0
                for doc_id, at, ids in TokenFile(path).documents():
                    rows.append((doc_id, start + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                                 *([ids.astype(np.int32)] if tokens else [])))
                    held += len(ids) * tokens
                    if len(rows) >= 8192 or held >= _READ_IDS:
                        yield _rows(rows, tokens)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows, tokens)

    spread = files.select("path", "start").repartition("path")
    return spread.mapInArrow(read, schema)


def _rows(rows: list[tuple], tokens: bool) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
    if tokens:
        arrays.append(pa.array(columns[4], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(arrays)])

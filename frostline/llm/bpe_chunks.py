"""BPE encoding and decoding with content-defined chunk reuse.

1. *Cut.*  A rolling hash over three words decides where a text is cut, at a
   word's start, so that equal passages are cut alike wherever they stand.
2. *Share.*  Chunk keys (128 hash bits of the chunk's words) are counted over
   all documents.  A chunk that several packed blocks of documents hold is
   encoded once, by the block of smallest id, and its ids are joined back to
   the others.  A chunk that one block holds is encoded there, once.
3. *Join and repair.*  At each join of two chunks the words around it are
   encoded again as one text.  If the ids agree with those of the two chunks the
   join stands; if not, the stretch is widened, a word on each side and then
   twice as many, until the ids at both of its ends agree with the chunks', and
   takes their place.

Decoding is the library's own, document by document.

The tokenizer must drop white space and never join words across it; this is
checked when the operator is built.  Any file of the tokenizers library that
does can be used; its path is a parameter.

Cases: a null text is empty; an empty text or one of white space has no ids and
decodes to an empty text.  Strings of special tokens within a text are encoded
as the library does.  Null ids and repeated rows come back as they came, row by
row.  An empty table gives an empty result.  Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks as B
from . import words as W
from .pieces import Pieces, pieces_of

#: Mean words in a chunk (a power of two) and words under the rolling hash.
CHUNK_WORDS = 64
WINDOW = 3
#: Entries of a worker's memo of words; blocks and their ids are in memory beside it.
MEMO = 700_000
#: Text bytes whose chunks are encoded at a time.
RUN_BYTES = 1 << 20
#: Ids that are decoded at a time: as Python integers each takes ten times its bytes.
DECODED_IDS = 1 << 16


def encode_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", memo: int = MEMO) -> DataFrame:
    """``(doc_id, n_tokens long, ids array<int>, decoded string)`` for each document.

    ``memo`` bounds the entries of a worker's memo of words; a lower one costs time, not rows.
    """
    own = Pieces(tokenizer)
    if not drops_white_space(own.encode):
        raise ValueError("the tokenizer must drop white space")
    narrow = own.tokenizer.get_vocab_size() <= 1 << 16
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    packed = B.pack(docs, B.layout_of(docs))

    # Dealt by key once, for the count and for the join below; the joins' filter stands here so that both read one exchange.
    held = B.per_block(packed, ["block", "rows"], "key binary, block long", _keys).where("key IS NOT NULL AND block IS NOT NULL").repartition("key")
    shared = (held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("block").alias("block"))
              .where("n > 1").select("block", "key"))
    coded = B.per_block(B.answers(packed, shared, ["key"]), ["rows", "answers"], "key binary, ids binary",
                        lambda r, a: _encode_shared(r, a, tokenizer, narrow, memo))
    back = held.join(coded, "key").select("block", "key", "ids")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return B.per_block(B.answers(packed, back, ["key", "ids"]), ["rows", "answers"], schema,
                       lambda r, a: _encode_all(r, a, tokenizer, narrow, memo))


def drops_white_space(encode: Callable[[list[str]], list[list[int]]]) -> bool:
    whole, a, b, c = encode([" Bee sting\n\t2 'twas ", "Bee", "sting", "2 'twas"])
    return whole == a + b + c


def _runs(table: pa.Table, most: int = 1 << 20) -> Iterator[tuple[int, list[list[bytes]], list[list[int]]]]:
    """Of each run of documents: the first's number, the words of each (UTF-8), and where its chunks begin."""
    texts = B.texts_of(table)
    for begin, end in W.groups_of(texts, most):
        run = W.Texts(texts[begin:end])
        rolling = W.gram_hashes(run.hashes, WINDOW, 11) & np.uint64(CHUNK_WORDS - 1) == 0
        cuts = np.flatnonzero(rolling) + WINDOW  # before the word after the window
        words, begins = [], []
        for d in range(end - begin):
            a, b = run.first[d], run.first[d + 1]
            own = cuts[np.searchsorted(cuts, a + WINDOW):np.searchsorted(cuts, b)] - a
            words.append(texts[begin + d].split())
            begins.append([0, *own.tolist()] if b > a else [])
        yield begin, words, begins


def _chunks(words: list[bytes], begins: list[int]) -> Iterator[tuple[bytes, bytes]]:
    """Key and text, its words joined by one space, of each chunk."""
    for a, b in zip(begins, [*begins[1:], len(words)]):
        chunk = b" ".join(words[a:b])
        yield xxhash.xxh3_128_digest(chunk), chunk


def _words(chunk: bytes) -> list[str]:
    return chunk.decode().split(" ")


def _coded(chunks: list[bytes], pieces: Pieces) -> list[bytes]:
    """The ids of each chunk, that is of its words, which one space parts."""
    if not chunks:
        return []
    buffer = np.frombuffer(b" ".join(chunks) + b" ", np.uint8)
    space = buffer == 0x20
    ends = np.flatnonzero(space)  # of each word
    begins = np.append(0, ends[:-1] + 1)
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1
    first = np.searchsorted(begins, np.cumsum(sizes) - sizes)  # word of each chunk
    ids, counts = pieces.ids_of(buffer[~space].tobytes(), begins - np.arange(len(begins)))
    to = (4 * np.cumsum(np.add.reduceat(counts, first))).tolist()
    data = ids.tobytes()
    return [data[a:b] for a, b in zip([0, *to], to)]


def _keys(block: int, rows: bytes) -> Iterator[pa.RecordBatch]:
    found = {key for _, words, begins in _runs(B.unpack(rows))
             for w, b in zip(words, begins) for key, _ in _chunks(w, b)}
    yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.binary()), pa.array([block] * len(found), pa.int64())],
                                     names=["key", "block"])


def _encode_shared(rows: bytes, back: list | None, tokenizer: str, narrow: bool, memo: int = MEMO) -> Iterator[pa.RecordBatch]:
    wanted = {bytes(a["key"]) for a in back or ()}
    pieces = pieces_of(tokenizer, memo)
    if not wanted:
        return
    for _, words, begins in _runs(B.unpack(rows)):
        chunks: dict[bytes, bytes] = {}
        for w, b in zip(words, begins):
            chunks.update((key, chunk) for key, chunk in _chunks(w, b) if key in wanted)
        wanted.difference_update(chunks)
        ids = _coded(list(chunks.values()), pieces)
        if narrow:
            ids = [np.frombuffer(i, "<i4").astype("<u2").tobytes() for i in ids]
        if chunks:
            yield pa.RecordBatch.from_arrays([pa.array(list(chunks), pa.binary()), pa.array(ids, pa.binary())],
                                             names=["key", "ids"])


def _encode_all(rows: bytes, back: list | None, tokenizer: str, narrow: bool, memo: int = MEMO) -> Iterator[pa.RecordBatch]:
    table = B.unpack(rows)
    pieces = pieces_of(tokenizer, memo)
    shared = {bytes(a["key"]): a["ids"] for a in back or ()}
    if narrow:
        shared = {k: np.frombuffer(v, "<u2").astype("<i4").tobytes() for k, v in shared.items()}
    own: dict[bytes, bytes] = {}
    for begin, words, begins in _runs(table, RUN_BYTES):
        chunks = [list(_chunks(w, b)) for w, b in zip(words, begins)]
        new = {key: chunk for of in chunks for key, chunk in of if key not in shared and key not in own}
        ends = [w[i - 1] + b" " + w[i] for w, b in zip(words, begins) for i in b[1:]]
        # The two words at a join are encoded each by itself, as a chunk's are, and as one text.
        found = _coded([*new.values(), *ends], pieces)
        own.update(zip(new, found))
        apart = iter(found[len(new):])
        joins = iter(pieces.encode([e.decode() for e in ends]))
        ids = []
        for of in chunks:
            parts = [own[key] if key in own else shared[key] for key, _ in of]
            for i in range(len(of) - 1):
                if _bytes(next(joins)) != next(apart):
                    parts[i], parts[i + 1] = repaired(_words(of[i][1]), _words(of[i + 1][1]), parts[i], parts[i + 1], pieces.encode)
            ids.append(np.frombuffer(b"".join(parts), dtype="<i4"))
        many = np.array([len(i) for i in ids], dtype=np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many)], pa.int32()),
                                         pa.array(np.concatenate([*ids, np.empty(0, "<i4")]), pa.int32()))
        text = [t for a, b in W.groups_of([len(i) for i in ids], DECODED_IDS)
                for t in pieces.tokenizer.decode_batch([i.tolist() for i in ids[a:b]], skip_special_tokens=False)]
        yield pa.RecordBatch.from_arrays(
            [table.column("doc_id").slice(begin, len(ids)).combine_chunks(), pa.array(many), lists, pa.array(text, pa.string())],
            names=["doc_id", "n_tokens", "ids", "decoded"])


def repaired(left: list[str], right: list[str], left_ids: bytes, right_ids: bytes,
             encode: Callable[[list[str]], list[list[int]]]) -> tuple[bytes, bytes]:
    """The ids of two neighbouring chunks whose join does not stand.

    ``width`` words on each side are encoded as one text.  The outer words are
    in agreement when the ids begin as the outer left words' and end as the
    outer right words' own; otherwise the stretch doubles, up to both chunks.
    """
    width = 2
    while width < max(len(left), len(right)):
        a, b = left[-width:], right[:width]
        whole, outer_a, outer_b, inner_a, inner_b = encode(
            [" ".join(a + b), " ".join(a[:width // 2]), " ".join(b[-(width // 2):]), " ".join(a), " ".join(b)])
        head, tail = _bytes(inner_a), _bytes(inner_b)
        if (whole[:len(outer_a)] == outer_a and whole[len(whole) - len(outer_b):] == outer_b
                and left_ids.endswith(head) and right_ids.startswith(tail)):
            return left_ids[:len(left_ids) - len(head)] + _bytes(whole), right_ids[len(tail):]
        width *= 2
    return _bytes(encode([" ".join(left + right)])[0]), b""


def _bytes(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<i4").tobytes()

"""Substring dedup with fixed-block anchors.

Every document is cut into non-overlapping reference blocks of ``span // 2``
words.  Any passage of ``span`` words holds one such block whole, so two equal
passages share a block of the first that meets a rolling window of the second:

1. *Index and probe.*  The hashes of all reference blocks are the index, and
   the rolling windows of the same length, at every word, probe it.  Each
   packed block of documents sends each distinct hash once, with two marks (a
   reference block has it; it occurs more than once here).  A hash is a hit if
   some reference block has it and it occurs at two places or more.
2. *Extend.*  Around the hits, the windows of ``span`` words that hold one are
   candidates; consecutive equal windows make up the maximal exact repeats.
   Each candidate's place of first occurrence is found by an exact key (128
   hash bits of its words), pre-aggregated per packed block.
3. *Remove.*  A word goes if a window covering it also starts earlier: in a
   document of smaller ``doc_id``, or earlier in the same document.  Windows
   are judged on the input, not on what is left.

No pair of places is ever emitted: a passage that a third of all documents
share costs one entry for each packed block.

Cases: a null or empty text has no words, loses none and comes back as an empty
text.  A null ``doc_id`` comes after all others.  Rows that share a ``doc_id``
are ordered by packed block, then by place in it, so of repeated rows exactly
one stays whole.  An empty table gives an empty result.  Further columns of the
input are carried through; a clash with the columns made here (``n_words``,
``n_removed``, ``kept``) is resolved in favour of those made here, but
``shortened_documents`` returns the input's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from . import words as W
from .names import named_back, numbered

SPAN = 20
_NARROW = 40  # hash bits sent beside the group number in the index step
_MADE = ("n_words", "n_removed", "kept")


def dedup_substrings(docs: DataFrame, span: int = SPAN, doc_id: str = "doc_id", text: str = "text",
                     keep_layout: bool = False) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_removed`` and ``kept``.

    ``kept`` holds the kept words joined by one space or, with ``keep_layout``,
    with the white space that followed them.
    """
    if span < 2:
        raise ValueError("span must be at least 2")
    docs = docs.drop(*_MADE)
    layout = B.layout_of(docs, text)
    packed = B.pack(docs, layout, text, doc_id)
    groups, half = layout.groups, span // 2

    probes = B.per_block(packed, ["block", "rows"], "grp int, block long, data binary",
                         lambda b, r: _probe(b, r, groups, half, text))
    hits = probes.groupBy("grp").applyInArrow(_hits, "block long, grp int, data binary")
    with_hits = B.answers(packed, hits, ["grp", "data"])
    wanted = B.per_block(with_hits, ["block", "rows", "answers"], "grp int, block long, data binary, ids binary",
                         lambda b, r, a: _candidates(b, r, a, groups, half, span, doc_id, text))
    later = wanted.groupBy("grp").applyInArrow(_not_first, "block long, data binary")
    with_later = B.answers(packed, later, ["data"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return B.per_block(with_later, ["rows", "answers"], f"{fields}, n_words long, n_removed long, kept string",
                       lambda r, a: _removed(r, a, span, text, keep_layout))


def shortened_documents(docs: DataFrame, span: int = SPAN, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the words that go, in its columns; a document without any words left goes.

    ``n_chars``, if there is one, is the new text's length; all other columns come back as they are.
    """
    own, names = numbered(docs)
    out = dedup_substrings(own, span, names[doc_id], names[text], keep_layout=True).where("n_removed < n_words")
    out = out.withColumn(names[text], F.col("kept"))
    if "n_chars" in names:
        out = out.withColumn(names["n_chars"], F.length("kept").cast(docs.schema["n_chars"].dataType))
    return named_back(out.select(*own.columns), docs.columns)


def _grams(texts: list[bytes], k: int, seeds: tuple[int, ...]) -> Iterator[tuple]:
    """Of each run of texts: its words, which k-grams lie in one text, and their hashes."""
    for begin, end in W.groups_of(texts):
        run = W.Texts(texts[begin:end])
        yield begin, run, run.whole(k), [W.gram_hashes(run.hashes, k, s) for s in seeds]


def _group(h: np.ndarray, groups: int) -> np.ndarray:
    return (h >> np.uint64(_NARROW)) % np.uint64(groups)


def _low(h: np.ndarray) -> np.ndarray:
    return h & np.uint64((1 << _NARROW) - 1)


def _five(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8")


def _split(group: np.ndarray, groups: int) -> list[tuple[int, slice]]:
    """Of values sorted by group, the slice of each group that has any."""
    edge = np.searchsorted(group, np.arange(groups + 1))
    return [(g, slice(edge[g], edge[g + 1])) for g in range(groups) if edge[g] < edge[g + 1]]


def _probe(block: int, rows: bytes, groups: int, half: int, text: str) -> Iterator[pa.RecordBatch]:
    found = []
    for _, run, whole, (h,) in _grams(B.texts_of(B.unpack(rows), text), half, (1,)):
        at = np.arange(len(h)) - np.repeat(run.first[:-1], np.diff(run.first))[:len(h)]
        found.append((h[whole], (at % half == 0)[whole]))
    if not found:
        return
    h, aligned = (np.concatenate(x) for x in zip(*found))
    if not len(h):
        return
    # The group number takes the place of the bits it is made of.
    key = _group(h, groups) << np.uint64(_NARROW) | _low(h)
    order = np.argsort(key, kind="stable")
    key, aligned = key[order], aligned[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    mark = np.logical_or.reduceat(aligned, first) * 1 + (np.diff(np.r_[first, len(key)]) > 1) * 2
    key = key[first]
    out = []
    for g, part in _split(key >> np.uint64(_NARROW), groups):
        m, low = mark[part], _low(key[part])
        sections = [low[m == x] for x in range(4)]
        head = np.array([len(s) for s in sections], dtype="<u4").tobytes()
        out.append((g, block, head + b"".join(map(_five, sections))))
    yield _batch(out, [("grp", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def _hits(table: pa.Table) -> pa.Table:
    """Of one group: the hashes with a reference block and two places, for each block that has them."""
    sent = []
    for data in table.column("data").to_pylist():
        n = np.frombuffer(data[:16], dtype="<u4")
        sent.append((_from_five(data[16:]), np.repeat(np.arange(4, dtype=np.uint8), n)))
    key = np.concatenate([s[0] for s in sent])
    mark = np.concatenate([s[1] for s in sent])
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    size = np.diff(np.r_[first, len(key)])
    marks = np.bitwise_or.reduceat(mark[order], first)
    good = (marks & 1 > 0) & ((size > 1) | (marks & 2 > 0))
    hit = np.empty(len(key), dtype=bool)
    hit[order] = np.repeat(good, size)
    rows, at = [], 0
    grp = table.column("grp")[0].as_py()
    for (values, _), block in zip(sent, table.column("block").to_pylist()):
        own = values[hit[at:at + len(values)]]
        at += len(values)
        if len(own):
            rows.append((block, grp, _five(own)))
    return pa.Table.from_batches([_batch(rows, [("block", pa.int64()), ("grp", pa.int32()), ("data", pa.binary())])])


def _candidates(block: int, rows: bytes, back: list | None, groups: int, half: int, span: int,
                doc_id: str, text: str) -> Iterator[pa.RecordBatch]:
    if not back:
        return
    hits = np.sort(np.concatenate([_from_five(a["data"]) | np.uint64(a["grp"] << _NARROW) for a in back]))
    table = B.unpack(rows)
    ids, keys, checks, docs = B.ids_of(table, doc_id), [], [], []
    for begin, run, whole, (key, check) in _grams(B.texts_of(table, text), span, (2, 3)):
        h = W.gram_hashes(run.hashes, half, 1)
        h = _group(h, groups) << np.uint64(_NARROW) | _low(h)
        at = np.minimum(np.searchsorted(hits, h), len(hits) - 1)
        ahead = np.r_[0, np.cumsum(hits[at] == h)]
        n = len(key)
        near = ahead[span - half + 1:span - half + 1 + n] > ahead[:n]  # a hit within the window
        take = np.flatnonzero(whole & near)
        keys.append(key[take])
        checks.append(check[take])
        docs.append(begin + np.searchsorted(run.first, take, side="right") - 1)
    key, check, doc = (np.concatenate(x) for x in (keys, checks, docs))
    if not len(key):
        return
    first = _first_of_each(key, check)
    key, check, doc = key[first], check[first], doc[first]
    group = _group(key, groups)
    order = np.lexsort((doc, group))
    key, check, doc, group = key[order], check[order], doc[order], group[order]
    out = []
    for g, part in _split(group, groups):
        d = doc[part]
        edge = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        many = np.diff(np.r_[edge, len(d)]).astype("<u4")
        body = key[part].astype("<u8").tobytes() + check[part].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :2].tobytes()
        out.append((g, block, body, ids[d[edge]].astype("<i8").tobytes() + many.tobytes()))
    yield _batch(out, [("grp", pa.int32()), ("block", pa.int64()), ("data", pa.binary()), ("ids", pa.binary())])


def _first_of_each(key: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Index of the first place of each distinct (key, check)."""
    order = np.lexsort((check, key))  # stable: places in order
    k, c = key[order], check[order]
    return order[np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])])]


def _not_first(table: pa.Table) -> pa.Table:
    """Of one group: for each block, the windows that start earlier in another block."""
    key, check, doc, owner = [], [], [], []
    blocks = table.column("block").to_numpy()
    for i, (body, ids) in enumerate(zip(table.column("data").to_pylist(), table.column("ids").to_pylist())):
        n, d = len(body) // 10, len(ids) // 12
        key.append(np.frombuffer(body, dtype="<u8", count=n))
        check.append(np.frombuffer(body, dtype="<u2", offset=8 * n))
        doc.append(np.repeat(np.frombuffer(ids, dtype="<i8", count=d), np.frombuffer(ids, dtype="<u4", offset=8 * d)))
        owner.append(np.full(n, i, dtype=np.int32))
    key, check, doc, owner = (np.concatenate(x) for x in (key, check, doc, owner))
    order = np.lexsort((blocks[owner], doc, check, key))
    k, c = key[order], check[order]
    later = order[1:][(k[1:] == k[:-1]) & (c[1:] == c[:-1])]
    later = later[np.argsort(owner[later], kind="stable")]
    rows = [(int(blocks[i]), key[later[part]].astype("<u8").tobytes())
            for i, part in _split(owner[later], len(blocks))]
    return pa.Table.from_batches([_batch(rows, [("block", pa.int64()), ("data", pa.binary())])])


def _removed(rows: bytes, back: list | None, span: int, text: str, keep_layout: bool) -> Iterator[pa.RecordBatch]:
    table = B.unpack(rows)
    texts = B.texts_of(table, text)
    later = np.sort(np.concatenate([np.frombuffer(a["data"], dtype="<u8") for a in back or ()] or [np.empty(0, "<u8")]))
    runs = list(_grams(texts, span, (2, 3)))
    # Within the block: every place of a window but its first.
    key = np.concatenate([r[3][0][r[2]] for r in runs]) if runs else np.empty(0, np.uint64)
    check = np.concatenate([r[3][1][r[2]] for r in runs]) if runs else np.empty(0, np.uint64)
    again = np.ones(len(key), dtype=bool)
    if len(key):
        again[_first_of_each(key, check)] = False
    if len(later):
        at = np.minimum(np.searchsorted(later, key), len(later) - 1)
        again |= later[at] == key
    n_words, n_removed, kept, seen = [], [], [], 0
    for begin, run, whole, _ in runs:
        n, own = len(run.starts), int(whole.sum())
        step = np.zeros(n + 1, dtype=np.int64)
        start = np.flatnonzero(whole)[again[seen:seen + own]]
        seen += own
        np.add.at(step, start, 1)
        np.add.at(step, np.minimum(start + span, n), -1)
        covered = np.cumsum(step)[:n] > 0
        for d in range(len(run.first) - 1):
            a, b = run.first[d], run.first[d + 1]
            gone = covered[a:b]
            n_words.append(int(b - a))
            n_removed.append(int(gone.sum()))
            kept.append(_kept(run, a, b, gone, run.offsets[d], run.offsets[d + 1] - 1, keep_layout))
    made = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string())]
    yield from pa.Table.from_arrays([*table.columns, *made], names=[*table.column_names, *_MADE]).combine_chunks().to_batches()


def _kept(run: W.Texts, a: int, b: int, gone: np.ndarray, begin: int, end: int, keep_layout: bool) -> bytes:
    if keep_layout:
        if not gone.any():
            return run.data[begin:end]
        # What is left are stretches from a kept word to the next word that goes.
        edge = np.flatnonzero(np.diff(np.r_[True, gone, True].astype(np.int8)))
        until = np.r_[run.starts[a:b], end]
        parts = [run.data[until[s]:until[e]] for s, e in zip(edge[::2], edge[1::2])]
        return b"".join(parts).strip() if parts else b""
    if not gone.any():
        return b" ".join(run.data[begin:end].split())
    words = run.data[begin:end].split()
    return b" ".join([words[i] for i in np.flatnonzero(~gone)])

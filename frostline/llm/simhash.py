"""SimHash near-dedup with deletion-variant signatures.

*Fingerprint.*  A 64-bit SimHash over word shingles: a bit is set if more than
half of the shingles' XXH64 values (seed 42) have it set.

*Index.*  The 64 bits are cut into so few segments that of two fingerprints
which differ in at most ``max_distance`` bits, one segment differs in at most
one.  Such segments agree once a certain single bit is left out, so each
segment is indexed by its variants with one bit left out ("wildcard"): 64 keys
a fingerprint, against the thousands that exact keys of that width would take.
Fingerprints that share a key are compared by Hamming distance.

*Groups of any size.*  Only distinct fingerprints enter the index, so copies
cost nothing.  Within a key, links are found by a search that takes each
fingerprint out of the list once it is reached: a dense cluster costs about its
size, not its square, and gives a spanning forest instead of all pairs.  The
links are exact as to what can be reached from what.  A key's list holds eight
bytes for each distinct fingerprint that agrees in a segment but for one bit.

With many fingerprints, random agreement in a segment of 21 bits becomes the
main cost; ``segments`` and ``together`` then choose wider keys (``together``
of the ``segments`` joined): 3 and 1 give keys of 20 bits, 5 and 2 of 25 bits,
6 and 3 of 31 bits.  The result is the same.

Cases: null or empty texts and texts of white space have fingerprint zero, and
are linked like any other; a text of fewer words than a shingle takes is one
shingle.  A null ``doc_id`` is never a component's id unless no member has an
id (then it is null).  Repeated rows come back as often as they came.  An empty
table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from . import words as W
from .components import smallest_in_component

SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
# Keys with at most so many fingerprints are compared by shifted copies of the whole batch.
_FEW = 24


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", out: str = "fingerprint",
                 carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns and each text's SimHash as a (signed) long."""
    fields = [docs.schema[c] for c in carry] + [T.StructField(out, T.LongType())]
    kept = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [W.lower_ascii(v or b"") for v in batch.column(kept).cast(pa.binary()).to_pylist()]
            made = [_simhash(texts[a:b], shingle) for a, b in W.groups_of(texts, 1 << 19)]
            values = np.concatenate(made) if made else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(values)], names=[f.name for f in fields])

    return docs.select(*(F.col(f"`{c}`") for c in carry), F.col(text).alias("__text")).mapInArrow(run, T.StructType(fields))


def _simhash(texts: list[bytes], shingle: int) -> np.ndarray:
    hash_of = xxhash.xxh64_intdigest
    values: list[int] = []
    many = []
    for text in texts:
        words = text.split()
        line = b" ".join(words)
        before = len(values)
        if len(words) <= shingle:
            if words:
                values.append(hash_of(line, SEED))
        else:
            edge = list(itertools.accumulate(map(len, words), lambda at, n: at + n + 1, initial=0))
            values += [hash_of(line[a:b - 1], SEED) for a, b in zip(edge, edge[shingle:])]
        many.append(len(values) - before)
    bits = np.unpackbits(np.array(values, dtype=">u8").view(np.uint8)).reshape(-1, 64)
    count = np.array(many, dtype=np.int64)
    ones = np.zeros((len(texts), 64), dtype=np.int64)
    if len(bits):
        some = np.flatnonzero(count)
        ones[some] = np.add.reduceat(bits, (np.cumsum(count) - count)[some], axis=0, dtype=np.int32)
    return np.packbits(2 * ones > count[:, None], axis=1).view(">u8").reshape(-1).astype(np.uint64).view(np.int64)


def masks(max_distance: int = MAX_DISTANCE, segments: int = 3, together: int = 1) -> list[int]:
    """Masks of the keys: ``together`` of ``segments`` parts of 64 bits, less one bit."""
    if not 1 <= together < segments <= 64:
        raise ValueError("1 <= together < segments <= 64")
    each, rest = divmod(max_distance, segments)
    if each * together + max(0, together - (segments - rest)) > 1:
        raise ValueError(f"{together} of {segments} segments may differ by more than one bit at distance {max_distance}")
    edge = [round(i * 64 / segments) for i in range(segments + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edge, edge[1:])]
    out = []
    for chosen in itertools.combinations(parts, together):
        whole = sum(chosen)
        out += [whole & ~(1 << bit) for bit in range(64) if whole >> bit & 1]
    return out


def links(distinct: DataFrame, max_distance: int = MAX_DISTANCE, segments: int = 3, together: int = 1) -> DataFrame:
    """Links ``(a, b)`` among distinct fingerprints (column ``f``).

    All links are within ``max_distance``; every pair within that distance is
    connected by them.
    """
    signed = [m - (1 << 64) if m >> 63 else m for m in masks(max_distance, segments, together)]
    keyed = (distinct.select("f", F.posexplode(F.array(*map(F.lit, signed))).alias("variant", "mask"))
             .select("variant", F.col("f").bitwiseAND(F.col("mask")).alias("key"), "f"))
    dealt = keyed.repartition("variant", "key").sortWithinPartitions("variant", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = [np.empty(0, np.int64)] * 3
        for batch in batches:
            rows = [np.concatenate((r, c.to_numpy())) for r, c in zip(rest, batch.columns)]
            change = _changes(rows)
            cut = change[-1] if len(change) else 0  # the last key may go on in the next batch
            yield _linked([r[:cut] for r in rows], max_distance)
            rest = [r[cut:] for r in rows]
        yield _linked(rest, max_distance)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _changes(rows: list[np.ndarray]) -> np.ndarray:
    variant, key, _ = rows
    return np.flatnonzero((variant[1:] != variant[:-1]) | (key[1:] != key[:-1])) + 1


def _linked(rows: list[np.ndarray], most: int) -> pa.RecordBatch:
    f = rows[2].view(np.uint64)
    start = np.r_[0, _changes(rows)] if len(f) else np.empty(0, np.int64)
    size = np.diff(np.r_[start, len(f)])
    a, b = [], []
    group = np.repeat(np.arange(len(start)), size)
    few = np.flatnonzero(np.repeat((size > 1) & (size <= _FEW), size))
    for shift in range(1, _FEW):
        few = few[few + shift < len(f)]
        few = few[group[few] == group[few + shift]]
        if not len(few):
            break
        near = few[np.bitwise_count(f[few] ^ f[few + shift]) <= most]
        a.append(f[near])
        b.append(f[near + shift])
    for g in np.flatnonzero(size > _FEW):
        for x, y in _forest(f[start[g]:start[g] + size[g]], most):
            a.append(np.full(len(y), x, dtype=np.uint64))
            b.append(y)
    empty = np.empty(0, np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([empty, *c]).view(np.int64)) for c in (a, b)], names=["a", "b"])


def _forest(f: np.ndarray, most: int) -> Iterator[tuple[np.uint64, np.ndarray]]:
    """A spanning forest of the fingerprints within ``most`` bits of each other."""
    left = f
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = np.bitwise_count(left ^ at) <= most
            if near.any():
                found = left[near]
                yield at, found
                reached.extend(found)
                left = left[~near]


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                    segments: int = 3, together: int = 1, text: str = "text", doc_id: str = "doc_id",
                    carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: ``doc_id``, ``carry``, ``fingerprint``, ``component_id``, ``component``.

    ``component_id`` is the smallest id reachable over links; ``component`` (a
    fingerprint) identifies the component even where ids are null.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = fingerprints(docs, shingle, text, "f", [doc_id, *carry]).checkpoint()
    one = rows.groupBy("f").agg(F.min(doc_id).alias("least"))
    stars = smallest_in_component(links(one.select("f"), max_distance, segments, together))
    rooted = (one.join(stars.withColumnRenamed("node", "f"), "f", "left")
              .select("f", "least", F.coalesce("root", "f").alias("component")))
    ids = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    member = rooted.join(ids, "component").select("f", "component", "component_id")
    return rows.join(member, "f").select(
        doc_id, *carry, F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id", "component")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component: the smallest id, null ids last.

    Rows that share the id are told apart by a hash of all columns; of rows
    alike in every column one stays.
    """
    columns = docs.columns
    marked = docs.withColumn("__row_hash", F.xxhash64(*(F.col(f"`{c}`") for c in columns)))
    found = near_duplicates(marked, shingle, max_distance, text=text, doc_id=doc_id, carry=["__row_hash"])
    first = found.groupBy("component").agg(F.min(F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"),
                                                          F.col("__row_hash").alias("row"))).alias("first"))
    keep = first.select(F.col("first.id").alias("_keep_id"), F.col("first.row").alias("_keep_row"))
    same = F.col(doc_id).eqNullSafe(F.col("_keep_id")) & (F.col("__row_hash") == F.col("_keep_row"))
    kept = marked.join(keep, same, "left_semi")
    return kept.dropDuplicates([doc_id, "__row_hash"]).select(*(F.col(f"`{c}`") for c in columns))

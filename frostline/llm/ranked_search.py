"""Ranked lexical search: the best documents for each of many query items, by integer scores.

Method: pipelined term partitioning.  The terms of the items are dealt to
*owners* by falling weight, in about equal shares of postings.  Documents lie
in blocks.  A *bundle* is a set of items on its way through one block: it
carries sparse accumulators (item, document, score so far).  Stage after stage
it meets, by cogroup, the postings of the next term owner for its block, which
add their integer contributions; the last stage selects the best of the block,
and a ranked window the best of all.

After each stage an accumulator stays only if it can still matter: its score
and the most that later owners could add in this block (the largest
contribution there of each of their terms) must reach the k-th best score that
the block's documents have already.  That bound is exact, so nothing that could
be selected is lost; frequent terms come last, when few accumulators are left.

The items are the query set: they are taken in parts of bounded size, whose
terms every task holds.  Documents are read once for each part; blocks are
stored, and hold only postings of the part's terms.

Cases: a text that is null or without terms is no document and no query.  Equal
scores go by ascending document id, null last; rows that share an id, or are
alike, are documents, or items, of their own.  Empty tables give an empty
result.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Text bytes of the items that are searched for together.
PART_BYTES = 8 << 20
#: Items of a bundle, documents of a block, and postings at which a block ends early.
BUNDLE_ITEMS, BLOCK_DOCS, BLOCK_POSTINGS = 256, 8192, 2_000_000
#: Owners of terms, one stage each.
OWNERS = 4
_RESULT = "item_id long, rank int, doc_id long, score long"

# Terms are runs of ASCII letters, digits and whatever lies beyond ASCII; A-Z in lower case.
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
               for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TERMS).split() if text else []


@dataclass
class Items:
    """A part of the query set: its terms, and for each term the items that hold it and how often."""

    ids: list[int | None]
    terms: dict[bytes, int]
    first: np.ndarray  # of each term, the first of its entries
    item: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int | None, bytes | None]]) -> "Items":
        terms: dict[bytes, int] = {}
        entries = [(terms.setdefault(term, len(terms)), i, n)
                   for i, (_, text) in enumerate(rows) for term, n in Counter(terms_of(text)).items()]
        term, item, times = np.array(sorted(entries), np.int64).reshape(-1, 3).T
        return cls([r[0] for r in rows], terms, np.searchsorted(term, np.arange(len(terms) + 1)), item, times)


@dataclass
class Weights:
    """What the corpus says of the terms: weight and owner of each, and the corpus' own counts."""

    documents: int
    length: int
    weight: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, documents: int, length: int, found: np.ndarray, owners: int) -> "Weights":
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in found.tolist()], np.int64)
        order = np.lexsort((found, -weight))
        share = np.cumsum(found[order]) - found[order]
        owner = np.empty(len(found), np.int64)
        owner[order] = share * owners // max(1, int(found.sum()))
        return cls(documents, length, weight, owner)

    def contributions(self, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        m = 25 + 75 * length * self.documents // self.length
        return self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def _blocks(items: Items):
    """Documents' terms to blocks: the ids and lengths of the documents, and postings of the items' terms."""
    schema = ("block long, doc_id array<long>, length array<long>, term array<int>, doc array<int>, tf array<int>, "
              "found_term array<int>, found array<long>")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, known = TaskContext.get().partitionId() << 32, items.terms
        ids, lengths, terms, docs, tfs = [], [], [], [], []

        def block() -> pa.RecordBatch:
            found_term, found = np.unique(np.array(terms, np.int64), return_counts=True)
            return _row({"block": number, "doc_id": ids, "length": lengths, "term": terms, "doc": docs, "tf": tfs,
                         "found_term": found_term, "found": found},
                        {"term": pa.int32(), "doc": pa.int32(), "tf": pa.int32(), "found_term": pa.int32()})

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                held = Counter(filter(None.__ne__, map(known.get, words)))
                docs += [len(ids)] * len(held)
                terms += held.keys()
                tfs += held.values()
                ids.append(doc_id)
                lengths.append(len(words))
                if len(ids) >= BLOCK_DOCS or len(terms) >= BLOCK_POSTINGS:
                    yield block()
                    number += 1
                    ids, lengths, terms, docs, tfs = [], [], [], [], []
        if ids:
            yield block()

    return build, schema


def _row(values: dict[str, object], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    """One row: single numbers as they are, everything else as a list."""
    columns = []
    for name, value in values.items():
        if isinstance(value, int):
            columns.append(pa.array([value], pa.int64()))
            continue
        flat = pa.array(value, types.get(name, pa.int64()))
        columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
    return pa.RecordBatch.from_arrays(columns, names=list(values))


def _numbers(table: pa.Table | pa.RecordBatch, name: str, row: int = 0) -> np.ndarray:
    return table.column(name)[row].values.to_numpy(zero_copy_only=False).astype(np.int64)


def _postings_of(owner: int, weights: Weights):
    """Of each block: an owner's postings as contributions, sorted by term, and the most that later owners' terms give."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                term, doc = _numbers(batch, "term", i), _numbers(batch, "doc", i)
                gain = weights.contributions(term, _numbers(batch, "tf", i), _numbers(batch, "length", i)[doc])
                mine = np.flatnonzero((weights.owner[term] == owner) & (gain > 0))
                mine = mine[np.argsort(term[mine], kind="stable")]
                later = np.flatnonzero(weights.owner[term] > owner)
                later = later[np.lexsort((gain[later], term[later]))]
                top = later[np.flatnonzero(np.diff(term[later], append=-1))]  # the last, largest, of each term
                yield _row({"block": batch.column("block")[i].as_py(), "docs": int(len(batch.column("doc_id")[i].values)),
                            "term": term[mine], "doc": doc[mine], "gain": gain[mine],
                            "later_term": term[top], "later_gain": gain[top]}, {"term": pa.int32(), "doc": pa.int32(), "later_term": pa.int32()})

    return build, ("block long, docs long, term array<int>, doc array<int>, gain array<long>, "
                   "later_term array<int>, later_gain array<long>")


_BUNDLE = "block long, bundle long, item array<int>, doc array<int>, score array<long>"


def _stage(items: Items, k: int):
    """Bundles meet an owner's postings; accumulators that cannot be among the best ``k`` any more go."""
    def add(key, bundles: pa.Table, postings: pa.Table) -> pa.Table:
        block, bundle = (part.as_py() for part in key)
        n_items = min(BUNDLE_ITEMS, len(items.ids) - bundle * BUNDLE_ITEMS)
        lowest = bundle * BUNDLE_ITEMS
        score = np.zeros((n_items, postings.column("docs")[0].as_py()), np.int64)
        score[_numbers(bundles, "item"), _numbers(bundles, "doc")] = _numbers(bundles, "score")

        def holders(term: int) -> Iterator[tuple[int, int]]:
            a, b = items.first[term:term + 2]
            a, b = a + np.searchsorted(items.item[a:b], [lowest, lowest + n_items])
            return zip((items.item[a:b] - lowest).tolist(), items.times[a:b].tolist())

        term, doc, gain = _numbers(postings, "term"), _numbers(postings, "doc"), _numbers(postings, "gain")
        begins = np.flatnonzero(np.diff(term, prepend=-1))
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(term)]):
            for item, times in holders(int(term[a])):
                score[item, doc[a:b]] += times * gain[a:b]
        more = np.zeros(n_items, np.int64)
        for t, most in zip(_numbers(postings, "later_term").tolist(), _numbers(postings, "later_gain").tolist()):
            for item, times in holders(t):
                more[item] += times * most
        if score.shape[1] > k:
            least = np.partition(score, -k, axis=1)[:, -k]
            item, doc = np.nonzero((score > 0) & (score + more[:, None] >= least[:, None]))
        else:
            item, doc = np.nonzero(score)
        row = _row({"block": block, "bundle": bundle, "item": item, "doc": doc, "score": score[item, doc]},
                   {"item": pa.int32(), "doc": pa.int32()})
        return pa.Table.from_batches([row])

    return add


def _best(items: Items, k: int):
    """The best of each item in a block, with the documents' ids in place of their numbers."""
    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                item = _numbers(batch, "item", i) + batch.column("bundle")[i].as_py() * BUNDLE_ITEMS
                score = _numbers(batch, "score", i)
                ids = batch.column("doc_id")[i].values.take(pa.array(_numbers(batch, "doc", i)))
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                number = ids.fill_null(0).to_numpy(zero_copy_only=False)
                order = np.lexsort((number, ~known, -score, item))
                begins = np.searchsorted(item[order], item[order])
                order = order[np.arange(len(order)) - begins < k]
                yield pa.RecordBatch.from_pydict({
                    "item": pa.array(item[order]), "item_id": pa.array([items.ids[j] for j in item[order].tolist()], pa.int64()),
                    "doc_id": ids.take(pa.array(order)), "score": pa.array(score[order])})

    return select, "item long, item_id long, doc_id long, score long"


def search(items: DataFrame, docs: DataFrame, k: int = 10, owners: int = OWNERS, item_id: str = "item_id",
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest scores above 0 for each item."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("binary").alias("text"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    parts = -(-size // PART_BYTES)
    out = spark.createDataFrame([], _RESULT)
    for part in range(parts):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        found = _search(spark, Items.of([(r.item_id, None if r.text is None else bytes(r.text)) for r in own.collect()]),
                        rows, k, owners)
        out = out.unionByName(found) if found is not None else out
    return out


def _search(spark: SparkSession, items: Items, rows: DataFrame, k: int, owners: int) -> DataFrame | None:
    folder = scratch_dir(spark, "ranked")
    build, schema = _blocks(items)
    rows.mapInArrow(build, schema).write.parquet(f"{folder}/blocks")
    blocks = spark.read.schema(schema).parquet(f"{folder}/blocks")
    total = blocks.agg(F.sum(F.size("doc_id")).alias("documents"),
                       F.sum(F.expr("aggregate(length, 0L, (a, x) -> a + x)")).alias("length")).first()
    if not items.terms or not total["documents"]:
        return None
    found = np.zeros(len(items.terms), np.int64)
    by_term = blocks.select(F.inline(F.arrays_zip("found_term", "found"))).groupBy("found_term").agg(F.sum("found").alias("n"))
    for row in by_term.collect():  # a row for each term of the items
        found[row["found_term"]] = row["n"]
    weights = Weights.of(total["documents"], total["length"], found, owners)
    bundles = -(-len(items.ids) // BUNDLE_ITEMS)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bundles - 1).cast("long"))).alias("bundle")
    none = [F.array().cast(f"array<{t}>").alias(c) for c, t in (("item", "int"), ("doc", "int"), ("score", "long"))]
    carried = blocks.select("block", each, *none)
    for owner in range(owners):
        build, schema = _postings_of(owner, weights)
        postings = blocks.select("block", "doc_id", "length", "term", "doc", "tf").mapInArrow(build, schema).select("*", each)
        carried = carried.groupBy("block", "bundle").cogroup(postings.groupBy("block", "bundle")).applyInArrow(_stage(items, k), _BUNDLE)
    select, schema = _best(items, k)
    best = carried.join(blocks.select("block", "doc_id"), "block").mapInArrow(select, schema)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")

"""License scan by diagonal voting.

1. The hash of every two consecutive words of every text is joined with the
   same hashes of the templates (license phrases and notices); hashes that no
   template has are left out where they are made.  A match votes for the
   *diagonal* ``place in text - place in template``.
2. Votes are counted by text, template and diagonal.  A template that stands
   unchanged in a text has all its votes on one diagonal; words put in or left
   out move the rest to a neighbouring one.
3. Diagonals of a template within ``BAND`` of each other are merged to a span.
4. Spans are verified.  A phrase must have every word in its place: a vote of
   each of its pairs on one diagonal.  A notice must have ``ENOUGH`` of its
   pairs, in a span not much longer than the notice.

Templates are a fixed list (a few hundred pairs), so they are broadcast; texts
are not shuffled, only their matches and one short row each are.

Cases: a null or empty text has no words and no labels (empty strings), score 0
and null places.  Null ids and repeated rows are scanned row by row.  An empty
table gives an empty result.  Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .license_texts import BASE_PHRASES, NOTICES, PHRASES

BAND = 3
ENOUGH = 0.6
#: A notice's span may be longer than the notice by this factor.
LOOSE = 1.5
# More template pairs than this are refused: they are broadcast.
MOST_PAIRS = 200_000

_MATCH = pa.schema({"tpl": pa.int32(), "tpos": pa.int32(), "need": pa.int32(), "label": pa.string(), "kind": pa.string(), "gram": pa.int64()})
# Text bytes that are scanned at a time.
_TEXT_BYTES = 1 << 19


def _pairs(texts: list[bytes]) -> tuple[W.Texts, np.ndarray, np.ndarray]:
    run = W.Texts([W.lower_ascii(t) for t in texts], W.ALNUM)
    return run, W.gram_hashes(run.hashes, 2, 31).view(np.int64), run.whole(2)


def _templates(base: Mapping[str, str], phrases: Mapping[str, str], notices: Mapping[str, str]) -> pa.Table:
    every = ([(t, label, "base") for t, label in base.items()] + [(t, label, "phrase") for t, label in phrases.items()]
             + [(t, label, "notice") for label, t in notices.items()])
    rows = []
    for number, (text, label, kind) in enumerate(every):
        _, grams, _ = _pairs([text.encode()])
        if not len(grams):
            raise ValueError(f"a template needs two words: {text!r}")
        rows += [(number, at, len(grams), label, kind, int(g)) for at, g in enumerate(grams)]
    if len(rows) > MOST_PAIRS:
        raise ValueError("too many template words to broadcast")
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(_MATCH), _MATCH.types)], schema=_MATCH)


def spans(docs: DataFrame, base: Mapping[str, str] = BASE_PHRASES, phrases: Mapping[str, str] = PHRASES,
          notices: Mapping[str, str] = NOTICES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Verified spans, and one row for each document.

    ``row`` (a number for the document's row), ``doc_id``, ``n_words`` and, for
    each span, ``label, kind, first_word, last_word, score``; in the one row that
    every document has besides, these are null.
    """
    spark = docs.sparkSession
    table = _templates(base, phrases, notices)
    templates = spark.createDataFrame(table)  # of an Arrow table, for which no worker is started
    known = np.unique(table["gram"].to_numpy())
    schema = T.StructType([T.StructField("row", T.LongType()), docs.schema[doc_id], T.StructField("n_words", T.LongType()),
                           T.StructField("pos", T.IntegerType()), T.StructField("gram", T.LongType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [1 + (n or 0) for n in pc.binary_length(batch.column(2)).to_pylist()]
            for a, b in W.groups_of(sizes, _TEXT_BYTES):
                words, grams, whole = _pairs([v or b"" for v in batch.column(2).slice(a, b - a).cast(pa.binary()).to_pylist()])
                n = np.diff(words.first)
                at = np.flatnonzero(whole & np.isin(grams, known))
                of = np.searchsorted(words.first, at, side="right") - 1
                rows = batch.column(0).slice(a, b - a)
                yield pa.RecordBatch.from_arrays(  # the documents' own rows
                    [rows, batch.column(1).slice(a, b - a), pa.array(n), pa.nulls(b - a, pa.int32()), pa.nulls(b - a, pa.int64())], names=names)
                yield pa.RecordBatch.from_arrays(
                    [rows.take(pa.array(of)), pa.nulls(len(at), batch.column(1).type), pa.nulls(len(at), pa.int64()),
                     pa.array((at - words.first[of]).astype(np.int32)), pa.array(grams[at])], names=names)
                W.give_back()

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id), F.col(text).alias("__text"))
    met = (numbered.mapInArrow(run, schema).join(F.broadcast(templates), "gram", "left")
           .where("gram is null or tpl is not null"))
    votes = (met.groupBy("row", "tpl", "need", "label", "kind", (F.col("pos") - F.col("tpos")).alias("diagonal"))
             .agg(F.max(doc_id).alias("doc_id"), F.max("n_words").alias("n_words"), F.collect_set("tpos").alias("tposes"),
                  F.min("pos").alias("first_word"), (F.max("pos") + 1).alias("last_word")))

    # Phrases stay on their diagonal; a notice's neighbouring diagonals are numbered alike.
    along = Window.partitionBy("row", "tpl").orderBy("diagonal")
    apart = (F.col("kind") != "notice") | (F.col("diagonal") - F.lag("diagonal").over(along) > BAND)
    votes = votes.withColumn("apart", F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0))
    votes = votes.withColumn("span", F.sum("apart").over(along))
    merged = (votes.groupBy("row", "tpl", "need", "label", "kind", "span")
              .agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                   F.size(F.array_distinct(F.flatten(F.collect_list("tposes")))).alias("met"),
                   F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word")))
    score = F.col("met") / F.col("need")
    long = F.col("last_word") - F.col("first_word") + 1
    good = (F.col("tpl").isNull() | ((F.col("kind") != "notice") & (F.col("met") == F.col("need")))
            | ((F.col("kind") == "notice") & (score >= ENOUGH) & (long <= LOOSE * (F.col("need") + 1))))
    found = F.col("tpl").isNotNull()
    own = Window.partitionBy("row")  # the document's own row has its id and number of words
    return merged.where(good).select(
        "row", F.max("doc_id").over(own).alias("doc_id"), F.max("n_words").over(own).alias("n_words"), "label", "kind", F.when(found, F.col("first_word")).cast("long").alias("first_word"),
        F.when(found, F.col("last_word")).cast("long").alias("last_word"), F.when(found, score).alias("score"))


def scan(docs: DataFrame, **how) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of each document.

    ``first_word`` and ``last_word`` are the smallest and the largest start of a
    base phrase, ``score`` the best span's share of its template.
    """
    base = F.col("kind") == "base"
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return (spans(docs, **how).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"), F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"), joined("label").alias("labels"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score")).drop("row"))

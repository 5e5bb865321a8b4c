"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs, drawn from its code
point.  The vector of a trigram binds those of its letters, each permuted by its
place: ``rot2(a) * rot(b) * c``.  A text's vector bundles (sums) those of all
its trigrams; a language's prototype bundles those of all its training texts.
A text is given the language whose prototype has the largest cosine with it.

Trigrams are taken over lower-case letters, with one mark for each stretch of
anything else, so that beginnings and ends of words count too.

Learning gathers one integer vector for each language: the tasks' sums are added
up in Spark, over (language, dimension).  Only the prototypes reach the driver
(8 KB a language; more than ``MOST_LANGUAGES`` languages are refused).

Cases: a text that is null or has no letter is ``und`` with score 0, and so is
every text if there was nothing to learn from.  Rows with a null language or
text are not learned from.  The score is the cosine, at least 0; ties go to the
language first in order.  Null ids are not held out, and not learned from.
Repeated rows are judged row by row.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import groups_of, mix

DIMENSIONS = 1024
MOST_LANGUAGES = 4096
UNKNOWN = "und"
# Code points of text handled at once, and trigrams whose vectors are made at once.
_RUN = 1 << 19
_ROWS = 8192


@functools.cache
def _letters() -> np.ndarray:
    table = np.zeros(sys.maxunicode + 1, dtype=bool)
    table[[c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == "L"]] = True
    return table


def _vectors(codes: np.ndarray) -> np.ndarray:
    """The signs of each code point, as int8."""
    word = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    bits = mix(codes[:, None].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + word * np.uint64(0xD1B54A32D192ED03))
    return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


class _Grams:
    """Distinct trigrams of several texts and how often each text has each."""

    def __init__(self, texts: list[str]):
        codes = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4") for t in texts]
        doc = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
        code = np.concatenate(codes)
        letter = _letters()[code]
        self.has_letter = np.bincount(doc[letter], minlength=len(texts)) > 0
        code = np.where(letter, code, np.uint32(0))
        keep = np.r_[True, (code[1:] != 0) | (code[:-1] != 0) | (doc[1:] != doc[:-1])]
        code, doc = code[keep], doc[keep]
        self.alphabet, at = np.unique(code, return_inverse=True)
        base = np.int64(len(self.alphabet))
        gram = (at[:-2] * base + at[1:-1]) * base + at[2:]
        one = doc[:-2] == doc[2:]
        self.grams, which = np.unique(gram[one], return_inverse=True)
        self.doc, self.which = doc[:-2][one], which

    def bundle(self, rows: np.ndarray, n: int) -> np.ndarray:
        """Sums of trigram vectors: ``rows`` gives each text's row, -1 for none."""
        out = np.zeros((n, DIMENSIONS))
        base = len(self.alphabet)
        signs = _vectors(self.alphabet)
        row = rows[self.doc]
        take = row >= 0
        pair, count = np.unique(self.which[take] * np.int64(n) + row[take], return_counts=True)
        for a in range(0, len(self.grams), _ROWS):
            gram = self.grams[a:a + _ROWS]
            bound = (np.roll(signs, 2, axis=1)[gram // (base * base)] * np.roll(signs, 1, axis=1)[gram // base % base]
                     * signs[gram % base])
            i, j = np.searchsorted(pair, (a * n, (a + len(gram)) * n))
            counts = np.zeros((n, len(gram)), dtype=np.float32)
            counts[pair[i:j] % n, pair[i:j] // n - a] = count[i:j]
            out += counts @ bound.astype(np.float32)
        return out


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and their prototypes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = (batch.column(c).to_pylist() for c in (0, 1))
            for a, b in groups_of(texts, _RUN):
                names = sorted(set(langs[a:b]))
                number = {name: i for i, name in enumerate(names)}
                made = _Grams(texts[a:b]).bundle(np.array([number[x] for x in langs[a:b]]), len(names))
                for name, row in zip(names, made):
                    sums[name] = sums.get(name, 0) + row.astype(np.int64)
        for name, row in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * DIMENSIONS), pa.array(range(DIMENSIONS), pa.int32()), pa.array(row)],
                                             names=["lang", "dimension", "value"])

    rows = docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("t is not null and l is not null")
    summed = rows.mapInArrow(run, "lang string, dimension int, value long").groupBy("lang", "dimension").agg(F.sum("value").alias("value"))
    whole = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dimension", "value"))).alias("v"))
    found = whole.select("lang", "v.value").limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    found.sort(key=lambda r: r["lang"])
    return [r["lang"] for r in found], np.array([r["value"] for r in found], dtype=np.float64).reshape(-1, DIMENSIONS)


def predict(docs: DataFrame, languages: list[str], prototypes: np.ndarray, text: str = "text",
            carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns, ``lang_pred`` and ``score``; only the text is looked at."""
    length = np.linalg.norm(prototypes, axis=1, keepdims=True)
    unit = prototypes / np.where(length == 0, 1, length)
    kept = len(carry)
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(kept).to_pylist()]
            names, scores = [], []
            for a, b in groups_of(texts, _RUN):
                grams = _Grams(texts[a:b])
                own = grams.bundle(np.arange(b - a), b - a)
                size = np.linalg.norm(own, axis=1)
                cosine = own @ unit.T / np.where(size == 0, 1, size)[:, None]
                for i in range(b - a):
                    if languages and grams.has_letter[i]:
                        best = int(cosine[i].argmax())
                        names.append(languages[best])
                        scores.append(min(1.0, max(0.0, float(cosine[i, best]))))
                    else:
                        names.append(UNKNOWN)
                        scores.append(0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=schema.names)

    return docs.select(*carry, F.col(text).alias("__text")).mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: a quarter of the ids is held out of learning."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    marked = docs.withColumn("held_out", F.coalesce(fold == 2, F.lit(False)))
    languages, prototypes = learn(marked.where(fold != 2))
    return predict(marked, languages, prototypes, carry=("doc_id", "held_out"))

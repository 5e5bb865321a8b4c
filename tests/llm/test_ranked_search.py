"""Operator 13 against brute force over all pairs of items and documents."""

import math
import random
import re
from collections import Counter

import pytest

from frostline.llm import ranked_search as K

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(items, docs, k=10):
    bags = [(d, Counter(w), len(w)) for d, w in ((d, terms(t)) for d, t in docs) if w]
    N, L = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    weight = {t: math.floor(1000 * math.log((2 * N + 2) / (2 * c + 1))) for t, c in df.items()}
    rows = []
    for item_id, text in items:
        asked, scored = Counter(terms(text)), []
        for doc_id, bag, n in bags:
            m = 100 - 75 + 75 * n * N // L
            score = sum(times * weight[t] * (1000000000 * bag[t] // (1000 * bag[t] + 8 * m)) for t, times in asked.items() if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, r, doc_id, -s) for r, (s, _, _, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=str)


def found(spark, items, docs, parts=3, **options):
    asked = spark.createDataFrame(items, "item_id long, text string")
    held = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    return sorted((tuple(r) for r in K.search(asked, held, **options).collect()), key=str)


def corpus(n=400, words=60):
    rng = random.Random(5)
    vocabulary = [*(f"w{i}" for i in range(words)), "Été", "naïve", "日本", "B2B", "x"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, rng.choice([" ", ", ", "\n", "--"]).join(rng.choices(vocabulary, weights, k=rng.randrange(0, 60)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "!!! ..."), (None, "w0 w1 naïve"), (7, "w3 W3 w4"), docs[3], docs[3], (n + 3, "w1 w2 " * 20000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 30)))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "unknown words only"), (3, items[3][1]), (None, "w5 w6"), (103, "w0 w0 w0 w1"), (104, "ÉTÉ été")]
    return items, docs


@pytest.mark.parametrize("options", [{}, {"owners": 1}, {"owners": 7, "k": 3}])
def test_brute_force(spark, options):
    items, docs = corpus()
    assert found(spark, items, docs, **options) == brute(items, docs, options.get("k", 10))


def test_small_blocks_bundles_and_parts(spark, monkeypatch):
    """Accumulators are dropped in many small blocks, and items dealt to several parts, without a change of the result."""
    for name, value in (("BLOCK_DOCS", 30), ("BUNDLE_ITEMS", 7), ("PART_BYTES", 1500)):
        monkeypatch.setattr(K, name, value)
    items, docs = corpus()
    assert found(spark, items, docs) == brute(items, docs)


def test_accumulators_are_dropped():
    """A document that cannot reach the k-th best any more leaves the bundle before the last stage."""
    import numpy as np
    import pyarrow as pa

    items = K.Items.of([(0, b"rare common")])
    n = 100
    postings = pa.Table.from_batches([K._row({"block": 0, "docs": n, "term": [0] * n, "doc": list(range(n)),
                                              "gain": [1000 + 10 * i for i in range(n)], "later_term": [1], "later_gain": [25]}, {})])
    bundles = pa.Table.from_batches([K._row({"block": 0, "bundle": 0, "item": [], "doc": [], "score": []}, {})])
    out = K._stage(items, 10)((pa.scalar(0), pa.scalar(0)), bundles, postings)
    assert K._numbers(out, "doc").tolist() == list(range(88, 100))
    assert np.array_equal(K._numbers(out, "score"), 1000 + 10 * np.arange(88, 100))


def test_given_tables(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
    items = [tuple(r) for r in read("benchmark").select("item_id", "text").collect()]
    docs = [tuple(r) for r in read("documents").select("doc_id", "text").collect()]
    out = K.search(read("benchmark"), read("documents"))
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(items, docs)


def test_empty_tables_and_clashing_names(spark):
    items, docs = corpus(30)
    assert found(spark, [], docs) == found(spark, items, []) == found(spark, items, [(1, None)]) == []
    asked = spark.createDataFrame([(1, "w0 w1", "q")], "item_id long, text string, block string")
    held = spark.createDataFrame([(d, t, "x", 1.5) for d, t in docs], "doc_id long, text string, item string, score double")
    assert sorted((tuple(r) for r in K.search(asked, held).collect()), key=str) == brute([(1, "w0 w1")], docs)

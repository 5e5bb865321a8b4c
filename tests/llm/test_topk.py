import math
import random

import pytest

from frostline.llm import topk as K


def brute(rows, queries, k):
    def good(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and good(v)]
    out = []
    for own, (i, v) in enumerate(ints):
        if i in queries:
            best = sorted(((-sum(a * b for a, b in zip(v, w)), j) for n, (j, w) in enumerate(ints) if n != own))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def corpus(scale=1.0):
    rng = random.Random(1)
    centre = [[rng.gauss(0, scale) for _ in range(12)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, scale / 3) for x in rng.choice(centre)]) for i in range(600)]
    rows += [(i, rows[7][1]) for i in range(600, 900)]  # copies: ties
    rows += [(1000, None), (1001, [1.0, None] * 6), (1002, [math.nan] * 12), (1003, [math.inf] * 12), (None, rows[3][1]),
             (1004, [0.0] * 12), (1005, []), (1006, [3.0 * scale]), (1007, rows[9][1] + [1.0]), (50, [9.0] * 12)]
    return rows


@pytest.mark.parametrize("scale,kind", [(1.0, "float"), (1e12, "double")])
def test_equals_brute_force(spark, monkeypatch, scale, kind):
    monkeypatch.setattr(K, "CELL_ROWS", 50)
    monkeypatch.setattr(K, "QUERY_ROWS", 8)
    import struct

    fit = lambda x: struct.unpack("f", struct.pack("f", x))[0] if kind == "float" and x is not None else x
    rows = [(i, None if v is None else [fit(x) for x in v]) for i, v in corpus(scale)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(4)
    asked = [i for i in range(0, 1010, 50)] + [1002, 1005, 1006]
    got = K.top_k(df, df.where(df.vec_id.isin(asked)), 5)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    most = (1 << 63) - 1
    want = [(q, r, v, max(-most, min(most, s))) for q, r, v, s in brute(rows, asked, 5)]
    if scale == 1.0:
        assert sorted(map(tuple, got.collect())) == want
    else:  # beyond 64 bits, scores tie and ids decide
        assert sorted((r.query_id, r.rank, r.score) for r in got.collect()) == sorted((q, r, s) for q, r, _, s in want)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.5]), (1, [0.25, -1.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, K.top_k(df, df.where("vec_id = 0")).collect())) == [(0, 1, 2, 49152), (0, 2, 1, -16384)]
    assert K.top_k(df.where("vec_id = 0"), df.where("vec_id = 0")).collect() == []
    assert K.top_k(df.where("false"), df.where("false")).collect() == []


def test_distant_annuli_are_left(spark):
    rng = random.Random(2)
    centre = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(30)]
    rows = [(i, [x + rng.gauss(0, 0.01) for x in centre[i % 30]]) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    base = K._integers(df, "vec_id", "embedding")
    longest = base.agg({"square": "max"}).first()[0]
    pivots, width = K._pivots([K._padded(r.vec, 8) for r in base.collect()], longest, 8)
    cells = K._cells(K._keyed(base, pivots, width, longest, 8))
    one = base.where("id = 0").selectExpr("*", "square * 0.98 least", "row query", "row own")
    visits = K._visits(one, "least", pivots, width, longest, 8, 5)
    met = visits.join(cells, "pivot").where("ring between low and high").selectExpr("sum(size(members)) n").first().n
    assert met < 1000


def test_rows_that_share_an_id_are_candidates_and_queries(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [3.0, 0.0]), (2, [0.5, 0.0]), (0, [1.0, 0.0]), (2, [0.5, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for asked in ([0], [1], [0, 1, 2]):
        got = K.top_k(df, df.where(df.vec_id.isin(asked)), 3)
        assert sorted(map(tuple, got.collect())) == brute(rows, asked, 3)


def test_long_vectors_and_one_hot_id(spark):
    """Vectors of 5000 components, and an id that holds a third of all rows."""
    rng = random.Random(3)
    rows = [(i if i % 3 else 7, [rng.gauss(0, 1) for _ in range(5000)]) for i in range(24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = K.top_k(df, df.where("vec_id in (7, 10)"), 5)
    assert sorted(map(tuple, got.collect())) == brute(rows, [7, 10], 5)

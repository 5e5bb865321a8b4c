"""Exact top-k by inner product over a pivot-distance index.

Components are turned into integers, ``floor(256 * x)``, and scores are integer
inner products.  With ``M`` the longest vector's length, a vector ``x`` is given
one more coordinate, ``sqrt(M^2 - |x|^2)``, and a query the coordinate 0; then
``d(q, x)^2 = |q|^2 + M^2 - 2 q.x``, and the largest inner products are the
smallest distances.

*Index.*  Pivots are picked far apart from a bounded sample of ``SAMPLE`` vectors.
Every vector is keyed by its nearest pivot and, as annuli of a fixed width, its
distance to it.  Vectors of an annulus are packed into rows of about
``CELL_ROWS``; an annulus that holds more is split by a hash of the rows' numbers.

*Search.*  Queries come in blocks of about ``QUERY_ROWS``.  Each first visits the
annuli around its own distance at its nearest pivot, which gives a k-th best
distance ``r``.  By the triangle inequality a vector within ``r`` of the query
has a distance to pivot ``p`` between ``d(q, p) - r`` and ``d(q, p) + r``; the
annuli of every pivot that meet this range are visited, all others are left.
The result is exact for any pivots and any sample.

Cases: rows whose vector is null or holds a null or non-finite component, and
rows without an id, take no part, neither as queries nor as candidates.  Rows that
share an id, or are alike, are queries and candidates of their own.  Vectors of different
lengths are compared as if the shorter ended in zeros.  Fewer candidates than k
give fewer rows.  Scores beyond 64 bits are given as the nearest long.  Ties go
to the smaller id.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

PIVOTS = 48
SAMPLE = 4096
ANNULI = 24
#: The last annulus is open: it holds all that lies further out.
LAST = 4 * ANNULI - 1
CELL_ROWS = 2048
QUERY_ROWS = 512
# Distances are compared with a little slack, for they are rounded; scores are exact.
_SLACK = 1e-9


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """``(query_id long, rank int, vec_id long, score long)``: the k best of all other rows."""
    ensure_checkpoint_dir(vectors.sparkSession)
    base = _integers(vectors, vec_id, vector).checkpoint()
    asked = _integers(queries, vec_id, vector).withColumnRenamed("row", "query").checkpoint()
    stats = base.agg(F.max("dim").alias("dim"), F.max("square").alias("square"), F.count(F.lit(1)).alias("n")).first()
    wide = asked.agg(F.max("dim").alias("dim"), F.count(F.lit(1)).alias("n")).first()
    dim = max(stats["dim"] or 0, wide["dim"] or 0, 1)
    longest = float(stats["square"] or 0.0)
    drawn = F.pmod(F.xxhash64("row"), F.lit(max(1, stats["n"] // SAMPLE))) == 0  # about SAMPLE rows, over all tasks
    sample = [_padded(r["vec"], dim) for r in base.where(drawn).orderBy(F.xxhash64("row"), "row").limit(SAMPLE).collect()]
    pivots, width = _pivots(sample, longest, dim)

    # A query's own row: the same id and vector; of rows alike it does not matter which.
    own = (base.join(asked.select("id").distinct(), "id", "left_semi").groupBy("id", "vec").agg(F.min("row").alias("own")))
    asked = (asked.join(own, ["id", "vec"], "left")
             .select("id", "vec", "square", "query", F.coalesce("own", F.lit(-1)).alias("own")).checkpoint())

    cells = _cells(_keyed(base, pivots, width, longest, dim)).checkpoint()
    blocks = max(1, -(-wide["n"] // QUERY_ROWS))
    near = _visits(asked, None, pivots, width, longest, dim, k)
    first = _best(_searched(near, cells, blocks, dim, k), k)
    reached = (first.groupBy("query").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("least"))
               .where(F.col("found") >= k).select("query", "least"))
    bounded = asked.join(reached, "query", "left")
    visits = _visits(bounded, "least", pivots, width, longest, dim, k)
    return _best(_searched(visits, cells, blocks, dim, k), k).select("query_id", "rank", "vec_id", "score")


def _integers(frame: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id, vec binary, square, dim`` of the rows that take part, and a number for each ``row``."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = (frame.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).where(~bad)
             .select(F.col(vec_id).cast("long").alias("id"), x.alias("x")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.floor(256.0 * np.array(v, dtype=np.float64)) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary()),
                 pa.array([float(r @ r) for r in rows], pa.float64()), pa.array([len(r) for r in rows], pa.int32())],
                names=["id", "vec", "square", "dim"])

    # Numbers are fixed once the frame is checkpointed.
    return whole.mapInArrow(run, "id long, vec binary, square double, dim int").withColumn("row", F.monotonically_increasing_id())


def _padded(vec: bytes, dim: int) -> np.ndarray:
    out = np.zeros(dim)
    own = np.frombuffer(vec, dtype=np.float64)
    out[:len(own)] = own
    return out


def _matrix(vecs: list[bytes], dim: int) -> np.ndarray:
    if all(len(v) == 8 * dim for v in vecs):
        return np.frombuffer(b"".join(vecs), dtype=np.float64).reshape(-1, dim)
    return np.array([_padded(v, dim) for v in vecs]).reshape(-1, dim)


def _lifted(matrix: np.ndarray, longest: float) -> np.ndarray:
    more = np.sqrt(np.maximum(0.0, longest - np.einsum("ij,ij->i", matrix, matrix)))
    return np.column_stack([matrix, more])


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Exact enough for near-equal points: differences are taken first."""
    return np.stack([np.sqrt(np.einsum("ij,ij->i", d, d)) for d in (points - p for p in pivots)], axis=1)


def _pivots(sample: list[np.ndarray], longest: float, dim: int) -> tuple[np.ndarray, float]:
    """Each next pivot is the sample's point farthest from all so far; annuli cut the sample's reach evenly."""
    points = _lifted(np.array(sample).reshape(-1, dim), longest)
    if not len(points):
        return np.zeros((1, dim + 1)), 1.0
    chosen = [points[0]]
    away = _distances(points, points[:1])[:, 0]
    while len(chosen) < PIVOTS and away.max() > 0:
        chosen.append(points[int(away.argmax())])
        away = np.minimum(away, _distances(points, chosen[-1][None])[:, 0])
    reach = float(away.max()) or float(np.sqrt(longest)) or 1.0
    return np.array(chosen), reach / ANNULI


def _keyed(base: DataFrame, pivots: np.ndarray, width: float, longest: float, dim: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, CELL_ROWS):
                part = batch.slice(a, CELL_ROWS)
                away = _distances(_lifted(_matrix(part.column(1).to_pylist(), dim), longest), pivots)
                pivot = away.argmin(axis=1)
                ring = np.minimum(np.floor(away[np.arange(len(pivot)), pivot] / width), LAST)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pivot, pa.int32()), pa.array(ring.astype(np.int64))],
                                                 names=["id", "vec", "row", "pivot", "ring"])

    return base.select("id", "vec", "row").mapInArrow(run, "id long, vec binary, row long, pivot int, ring long")


def _cells(keyed: DataFrame) -> DataFrame:
    """``pivot, ring, members``: packed rows of bounded size; an annulus of many vectors has several."""
    keyed = keyed.checkpoint()
    many = keyed.groupBy("pivot", "ring").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("parts"))
    # PIVOTS * (LAST + 1) rows at most; joined by broadcast, so that a full annulus stays spread over tasks.
    return (keyed.join(F.broadcast(many), ["pivot", "ring"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
            .groupBy("pivot", "ring", "part").agg(F.collect_list(F.struct("row", "id", "vec")).alias("members")))


def _visits(asked: DataFrame, least: str | None, pivots: np.ndarray, width: float, longest: float, dim: int,
            k: int) -> DataFrame:
    """``pivot, low, high, id, vec, query, own``: the annuli a query visits, given its k-th best score so far or none yet.

    Without a column ``least``, these are the annuli about the query's own
    distance at its nearest pivot; where ``least`` is null, all of every pivot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries = _matrix(batch.column(1).to_pylist(), dim)
            square = batch.column(2).to_numpy(zero_copy_only=False)
            away = _distances(np.column_stack([queries, np.zeros(len(queries))]), pivots)
            if least is None:
                row = np.arange(len(queries))
                pivot = away.argmin(axis=1)
                low = np.floor(away[row, pivot] / width) - ANNULI // 4
                high = low + 2 * (ANNULI // 4)
            else:
                score = batch.column(5).to_numpy(zero_copy_only=False).astype(np.float64)  # null: nan
                reach = np.sqrt(np.maximum(0.0, square + longest - 2 * score))
                reach += _SLACK * (1 + reach + np.sqrt(square + longest))
                row, pivot = (x.ravel() for x in np.indices(away.shape))
                low = np.floor((away - reach[:, None]) / width).ravel()
                high = np.floor((away + reach[:, None]) / width).ravel()
            bound = float(1 << 60)
            low, high = np.minimum(np.nan_to_num(low, nan=-bound), LAST), np.nan_to_num(high, nan=bound)
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pivot, pa.int32()), pa.array(np.clip(low, -bound, bound).astype(np.int64)),
                 pa.array(np.clip(high, -bound, bound).astype(np.int64)), *(batch.column(c).take(taken) for c in (0, 1, 3, 4))],
                names=["pivot", "low", "high", "id", "vec", "query", "own"])

    columns = ["id", "vec", "square", "query", "own"] + ([least] if least else [])
    return asked.select(*columns).mapInArrow(run, "pivot int, low long, high long, id long, vec binary, query long, own long")


def _searched(visits: DataFrame, cells: DataFrame, blocks: int, dim: int, k: int) -> DataFrame:
    """The k best of each visited row of the index, for each query: ``query, query_id, vec_id, score``."""
    asked = (visits.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
             .groupBy("pivot", "block").agg(F.collect_list(F.struct("query", "own", "id", "vec", "low", "high")).alias("queries"),
                                            F.min("low").alias("low"), F.max("high").alias("high")))
    pairs = (asked.join(cells, "pivot").where("ring between low and high")
             .withColumn("queries", F.filter("queries", lambda q: F.col("ring").between(q["low"], q["high"])))
             .where(F.size("queries") > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                queries, members = (batch.column(c)[i].values for c in (0, 1))
                yield _scored(queries, members, dim, k)

    return pairs.select("queries", "members").mapInArrow(run, "query long, query_id long, vec_id long, score long")


def _scored(queries: pa.StructArray, members: pa.StructArray, dim: int, k: int) -> pa.RecordBatch:
    asked, ids = (a.field("id").to_numpy() for a in (queries, members))
    number, own_row, rows = queries.field("query").to_numpy(), queries.field("own").to_numpy(), members.field("row").to_numpy()
    q, x = (_matrix(a.field("vec").to_pylist(), dim) for a in (queries, members))
    scores = _products(q, x)
    out = []
    for i in range(len(asked)):
        other = np.flatnonzero(rows != own_row[i])
        own = scores[i, other]
        if len(other) > 8 * k:  # ties at the cut stay in
            cut = np.partition(own, len(own) - k)[len(own) - k]
            other = other[own >= cut]
            own = scores[i, other]
        best = np.lexsort((ids[other], -own))[:k]
        out.append((np.full(len(best), number[i]), np.full(len(best), asked[i]), ids[other[best]], own[best]))
    columns = [np.concatenate([o[c] for o in out] or [np.empty(0, np.int64)]) for c in range(4)]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["query", "query_id", "vec_id", "score"])


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where every partial sum is exact, else in Python's integers."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < 2.0 ** 53:
        return (q @ x.T).astype(np.int64)
    whole = lambda m: np.vectorize(int, otypes=[object])(m)
    most = (1 << 63) - 1
    return np.clip(whole(q) @ whole(x).T, -most, most).astype(np.int64)  # -score must be a long too


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

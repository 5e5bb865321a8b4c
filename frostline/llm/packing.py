"""Packing documents into sequences of a fixed number of tokens.

Method: a linear grouping scheme.  Lengths above ``SMALL`` of a sequence are
sorted and parted into groups of equal cardinality, and each length is rounded
up to the largest of its group.  That leaves few sizes, for which the best mix
of *configurations* (ways to fill one sequence) is found as a linear program by
column generation.  Actual documents then take the places of the rounded ones,
and whatever is left, with all small lengths, goes by best fit, longest first,
into what the sequences still hold.

Only the number of pieces of each length decides a packing, and there are no
more lengths than tokens in a sequence.  ``plan`` therefore works on that
histogram alone: pieces are ranked by falling length, and the plan is a list of
runs of ranks that go to consecutive sequences at one offset.  Its size depends
on the capacity and the number of groups, not on the documents.  Spark encodes
the documents, counts and ranks their pieces, and looks each rank up in the plan.

Cases: a null or empty text has only the end id.  Rows that share an id, or are
alike, are documents of their own.  Longer documents are cut so that only their
first piece may be short.  An empty table gives an empty result.  Other columns
are not read, whatever their names.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .coded import ByteLevel, Coder, cuts_of, spans
from .words import give_back, groups_of

#: Groups of equal cardinality.
GROUPS = 64
#: Lengths of at most this share of a sequence are small: they are not grouped.  Each is
#: tried, and the plan of fewest sequences is taken: a low share serves lengths of which few
#: combinations fit well, a high one lengths of which nearly any fit.
SMALL = (1 / 8, 1 / 4, 1 / 2)
# Text bytes that are encoded at a time, and distinct pieces of text that a worker keeps.
_TEXT_BYTES = 1 << 20
_KEPT_PIECES = 350_000
_EPS = 1e-9


@dataclass
class Plan:
    """Runs of ranks: ``first[i] + k`` goes to sequence ``sequence[i] + k``, at ``offset[i]``."""

    sequences: int = 0
    runs: list[tuple[int, int, int]] = field(default_factory=list)

    def lookup(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first, sequence, offset = np.array(sorted(self.runs), np.int64).reshape(-1, 3).T
        return first, sequence, offset


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Fillings of a sequence by the given sizes, with how often each is used, that meet the demand.

    Column generation: the price of a size is what one more of it would cost;
    an integer knapsack finds the filling worth most, which enters the basis
    unless it is worth no more than the sequence it takes.
    """
    n = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    inverse = np.diag([1 / (capacity // s) for s in sizes])
    used = inverse @ np.array(demand, float)
    for _ in range(50 * n):
        prices = inverse.sum(axis=0)
        column = _best_filling(sizes, prices, capacity)
        if prices @ column <= 1 + 1e-7:
            break
        change = inverse @ column
        rising = np.flatnonzero(change > _EPS)
        out = rising[np.argmin(used[rising] / change[rising])]
        step = used[out] / change[out]
        used -= step * change
        used[out] = step
        basis[:, out] = column
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
    return [(basis[:, j].round().astype(int), float(used[j])) for j in range(n) if used[j] > _EPS]


def _best_filling(sizes: list[int], prices: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size make the filling of the highest price."""
    worth, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for i, (size, price) in enumerate(zip(sizes, prices)):
        if price <= _EPS:
            continue
        for _ in range(capacity // size):  # one more copy with each pass
            more = worth[:-size] + price
            better = np.flatnonzero(more > worth[size:] + _EPS) + size
            if not len(better):
                break
            worth[better] = more[better - size]
            last[better] = i
    column, at = np.zeros(len(sizes)), int(np.argmax(worth))
    while at > 0 and last[at] >= 0:
        column[last[at]] += 1
        at -= sizes[last[at]]
    return column


def plan(counts: np.ndarray, groups: int = GROUPS, small: tuple[float, ...] = SMALL) -> Plan:
    """A packing of ``counts[length]`` pieces of each length up to ``len(counts) - 1``, ranked by falling length."""
    return min((_plan(counts, groups, s) for s in small), key=lambda p: p.sequences)


def _plan(counts: np.ndarray, groups: int, small: float) -> Plan:
    capacity = len(counts) - 1
    total = np.cumsum(counts[::-1])[::-1]  # pieces of this length or longer
    after = np.append(total[1:], 0)  # the first rank of each length
    ends = total[::-1]  # of the lengths capacity, capacity - 1, ...

    def length_of(rank: int) -> int:
        return capacity - int(np.searchsorted(ends, rank, side="right"))

    out = Plan(int(counts[capacity]))
    if counts[capacity]:
        out.runs.append((0, 0, 0))
    least = max(1, int(capacity * small)) + 1
    begin, end = int(total[capacity]), int(total[least]) if least <= capacity else 0
    gaps: dict[int, list[tuple[int, int]]] = {}
    left: list[tuple[int, int]] = []
    if end > begin:
        each = -(-(end - begin) // groups)
        ranks: dict[int, list[int]] = {}  # rounded length -> next rank, end
        for a in range(begin, end, each):
            size = length_of(a)
            ranks.setdefault(size, [a, a])[1] = min(end, a + each)
        sizes = list(ranks)
        for column, times in configurations(sizes, [b - a for a, b in ranks.values()], capacity):
            slots = [ranks[size] for size, n in zip(sizes, column) for _ in range(n)]
            many = min([int(times + 1e-6), *((r[1] - r[0]) // sum(s is r for s in slots) for r in slots)])
            if many:
                firsts = []
                for r in slots:
                    firsts.append(r[0])
                    r[0] += many
                _substitute(out, gaps, firsts, many, after, length_of, capacity)
        left = [(a, b) for a, b in ranks.values() if a < b]
    _best_fit(out, gaps, [*left, (end if end > begin else begin, int(total[0]))], after, total, length_of, capacity)
    return out


def _substitute(out: Plan, gaps, firsts: list[int], many: int, after, length_of, capacity: int) -> None:
    """Actual pieces for ``many`` sequences of one configuration, parted where a length changes."""
    breaks = {0, many}
    for first in firsts:
        top, low = length_of(first), length_of(first + many - 1)
        breaks.update(int(after[v]) - first for v in range(low, top) if 0 < after[v] - first < many)
    for a, b in itertools.pairwise(sorted(breaks)):
        offset = 0
        for first in firsts:
            out.runs.append((first + a, out.sequences + a, offset))
            offset += length_of(first + a)
        gaps.setdefault(capacity - offset, []).append((out.sequences + a, b - a))
    out.sequences += many


def _best_fit(out: Plan, gaps, ranks: list[tuple[int, int]], after, total, length_of, capacity: int) -> None:
    """The given ranks, longest first, each into the fullest sequence that still holds it."""
    room = np.zeros(capacity + 1, bool)
    room[[r for r, runs in gaps.items() if runs]] = True

    def add(space: int, sequence: int, count: int) -> None:
        gaps.setdefault(space, []).append((sequence, count))
        room[space] = True

    for a, b in sorted(ranks):
        while a < b:
            length = length_of(a)
            stop = min(b, int(total[length]))
            fits = np.flatnonzero(room[length:])
            if len(fits):
                space = length + int(fits[0])
                sequence, count = gaps[space].pop()
                room[space] = bool(gaps[space])
                take = min(count, stop - a)
                out.runs.append((a, sequence, capacity - space))
                add(space - length, sequence, take)
                if take < count:
                    add(space, sequence + take, count - take)
                a += take
                continue
            copies = capacity // length
            full, rest = divmod(stop - a, copies)
            for sequences, in_each in ((full, copies), (1, rest)):
                if sequences and in_each:
                    for k in range(in_each):
                        out.runs.append((a, out.sequences, k * length))
                        a += sequences
                    add(capacity - in_each * length, out.sequences, sequences)
                    out.sequences += sequences


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, doc_id: str = "doc_id", text: str = "text",
         tokens: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if asked, ``ids`` of each piece."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long" + ", ids array<int>" * tokens

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, known = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), _coder(tokenizer)
        for batch in batches:
            sizes = [1 + (n or 0) for n in pc.binary_length(batch.column(1)).to_pylist()]
            for a, b in groups_of(sizes, _TEXT_BYTES):
                part = batch.slice(a, b - a)
                ids, lengths = _encoded(part.column(1).to_pylist(), known, end_id)
                yield _pieces(part.column(0), ids, lengths, capacity, task, seen, tokens)
                give_back()

    folder = scratch_dir(spark, "packing")
    rows.mapInArrow(cut, schema).write.parquet(f"{folder}/pieces")
    pieces = spark.read.parquet(f"{folder}/pieces")
    of_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in of_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row for each length
        counts[row["length"]] = row["n"]
    longer = np.append(np.cumsum(counts[::-1])[::-1][1:], 0)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    longer_than = F.element_at(F.lit(longer.tolist()), (F.col("length") + 1).cast("int"))
    ranks = of_task.select("task", "length", (F.coalesce(F.sum("n").over(before), F.lit(0)) + longer_than).alias("first"))
    first, sequence, offset = plan(counts).lookup()

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = pc.add(batch.column("first"), batch.column("nth")).to_numpy(zero_copy_only=False)
            at = np.searchsorted(first, rank, side="right") - 1
            own = [batch.column(c) for c in kept]
            placed = [pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays([*own[:5], *placed, *own[5:]], names=[*kept[:5], "sequence_id", "offset", *kept[5:]])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if tokens else [])]
    return pieces.join(ranks, ["task", "length"]).select(*kept, "nth", "first").mapInArrow(
        look_up, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
                 + ", ids array<int>" * tokens)


_LOADED: dict[str, Coder] = {}


def _coder(path: str) -> Coder:
    """The worker's coder for a tokenizer file."""
    if path not in _LOADED:
        _LOADED[path] = Coder(ByteLevel(path), most=_KEPT_PIECES)
    return _LOADED[path]


def _encoded(texts: list[str | None], coder: Coder, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the texts, each with the end id, and how many each has.

    Texts that hold a special token's string are encoded by themselves.
    """
    tokenizer = coder.sides[0].tokenizer
    apart = {i: np.array(tokenizer.with_special(t), np.int64) for i, t in enumerate(texts)
             if t and any(name in t for name in tokenizer.special)}
    used = [i for i, t in enumerate(texts) if t and i not in apart]
    whole = [texts[i].encode() for i in used]
    data = b"".join(whole)
    sizes = np.fromiter(map(len, whole), np.int64, len(whole))
    begins = np.cumsum(sizes) - sizes
    lengths = np.ones(len(texts), np.int64)
    found = np.empty(0, np.int64)
    if used:
        cuts = cuts_of(np.frombuffer(data, np.uint8), begins)
        (found, counts, _), = coder.encode(data, cuts, np.searchsorted(cuts, begins))
        lengths[used] += counts
    for i, own in apart.items():
        lengths[i] += len(own)
    first = np.cumsum(lengths) - lengths
    ids = np.full(int(lengths.sum()), end_id, "<u4")
    ids[spans(first[used], lengths[used] - 1)] = found
    for i, own in apart.items():
        ids[first[i]:first[i] + len(own)] = own
    return ids, lengths


def _pieces(doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray, capacity: int, task: int, seen: np.ndarray,
            tokens: bool) -> pa.RecordBatch:
    """Rows of the pieces of some documents; ``seen`` counts the task's pieces of each length."""
    number = -(-lengths // capacity)
    of = np.repeat(np.arange(len(lengths)), number)
    piece = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
    short = lengths - (number - 1) * capacity  # the first piece's length
    length = np.where(piece == 0, short[of], capacity)
    start = np.where(piece == 0, 0, short[of] + (piece - 1) * capacity)
    stops = np.cumsum(length)
    data = ids.tobytes()
    crc = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(stops.tolist(), length.tolist())]
    order = np.argsort(length, kind="stable")
    sorted_ = length[order]
    nth = np.empty(len(order), np.int64)
    nth[order] = np.arange(len(order)) - np.searchsorted(sorted_, sorted_)
    nth += seen[length]
    seen += np.bincount(length, minlength=len(seen))
    columns = {"doc_id": doc_ids.take(pa.array(of)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start),
               "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()),
               "task": pa.array(np.full(len(of), task), pa.int32()), "nth": pa.array(nth)}
    if tokens:
        ends = pa.array(np.concatenate(([0], stops)), pa.int32())
        columns["ids"] = pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32)))
    return pa.RecordBatch.from_pydict(columns)

"""Mixing sources to target weights along a time-varying curriculum.

*How much.*  Sources, in the order of their names, share a budget (1.5 times
all words) by weight.  No source is taken more than ``MOST`` times; what a
source cannot take is shared out among the others by weight, until none is
above.  Words are taken from a stream that lays out a source's documents in a
fixed shuffled order, again and again.  Documents are taken whole: a source
with a target of 1.3 times its size gives every document once and a first part
of the order once more.  Where the stream ends, the documents around the border
are chosen so that the total comes as near to the target as it can by leaving
out one of the last ``NEAR`` documents before and adding up to two of the first
``NEAR`` after it; a source with a target is never left out altogether.

*When.*  A source's weight varies over training time ``t`` from 0 to 1 as
``w * (1 + c * (2 t - 1))``, with a slope ``c`` that sources take in turn
(fading out, level, fading in).  Integrated and normalised, that is the share
``t + c (t^2 - t)`` of the source's words that should be met by time ``t``.
Each copy's place in its source's stream is put into the inverse of this, which
gives its training position; range-sorting all copies by position gives the
training order, with the intended blend at every time.

All of it is DataFrame operations.  Positions in a source's stream are prefix
sums in two steps, over buckets and within buckets of about ``BUCKET_ROWS``
documents, so that a source with a third of all rows is spread like any other.

Cases: a null or empty text has size 0 and is taken 0 words.  A null source is
a source, the last.  Documents without an id, rows that share one and repeated rows are
documents of their own, in ``mix`` and in ``curriculum``, and are spread over
the buckets of their source like all others.  An empty table gives an empty
result.  ``mix`` reads the columns it names and no other; ``curriculum`` returns
all columns, whatever their names (hashed to tell rows apart, so no maps).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import with_sort_position
from ..session import ensure_checkpoint_dir
from .names import named_back, numbered

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
MOST = 2
#: Slopes of the weights over training time; between -1 and 1.
SLOPES = (-0.5, 0.0, 0.5)
#: Documents in a bucket of a source's stream, on average.
BUCKET_ROWS = 2000
#: Rows alike that are numbered at once.
ALIKE_ROWS = 10_000
#: Documents on each side of a stream's end that may be left out or added.
NEAR = 16

def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _nth(values: Sequence[float], number: Column) -> Column:
    """The number-th (from 1) of the values, repeating."""
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), (F.pmod(number - 1, F.lit(len(values))) + 1).cast("int"))


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
                   most: float = MOST) -> DataFrame:
    """``source, source_size, n_docs, number, weight, target`` of each source."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = with_sort_position(totals, [F.col("source").asc_nulls_last()], "number")
    ranked = ranked.withColumn("weight", _nth(weights, F.col("number"))).checkpoint()
    cap = most * F.col("source_size")
    # Sources at their cap leave the rest of the budget to the others; each round is one aggregate.
    level = 0.0
    while True:
        full = cap <= F.col("weight") * level
        s = ranked.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, cap).otherwise(0.0)).alias("taken"),
                       F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("open")).first()
        before, level = level, (budget * (s["all"] or 0) - (s["taken"] or 0.0)) / s["open"] if s["open"] else level
        if level <= before:
            break
    return ranked.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: int = MOST,
        slopes: Sequence[float] = SLOPES, text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """One row per document with what the mix takes of it, and when.

    ``doc_id, source, carry, size, source_size, target, taken`` and ``copies``:
    an array of ``(words, position)``, one for each time the document is met;
    ``order`` is a hash that tells rows of a source apart.
    """
    if any(not -1 <= c <= 1 for c in slopes) or any(w <= 0 for w in weights) or not 0 < budget <= most:
        raise ValueError("slopes must be within -1 and 1, weights positive, the budget at most the cap")
    ensure_checkpoint_dir(docs.sparkSession)
    # Sizes are read three times below; as three short columns they are cheap to keep.
    sized = _numbered_rows(docs.select("doc_id", "source", *carry, word_count(text).alias("size"),
                                       F.xxhash64(text).alias("of_text"))).checkpoint()
    targets = source_targets(sized, weights, budget, most).withColumnRenamed("source", "of_source")
    buckets = F.ceil(F.col("n_docs") / BUCKET_ROWS).cast("int")
    place = (sized.join(targets, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
             .withColumn("order", F.xxhash64("source", "doc_id", "of_text", "nth"))
             .withColumn("bucket", F.pmod(F.col("order"), buckets)))

    sums = place.groupBy(F.col("source").alias("s"), F.col("bucket").alias("b")).agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    around = [F.coalesce(F.sum("words").over(earlier.rowsBetween(Window.unboundedPreceding, k)), F.lit(0)) for k in (-2, 1)]
    sums = sums.select("s", "b", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"),
                       around[0].alias("near_from"), around[1].alias("near_until"))
    within = (Window.partitionBy("source", "bucket").orderBy("order", F.col("doc_id").asc_nulls_last(), "size", *carry, "nth")
              .rowsBetween(Window.unboundedPreceding, -1))
    place = (place.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
             .withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))))

    # The target is a number of whole passes and the rest, which a last pass gives.
    whole = F.greatest(F.col("source_size"), F.lit(1))
    place = (place.withColumn("goal", F.round("target").cast("long")).withColumn("rest", F.pmod("goal", whole))
             .withColumn("passes", ((F.col("goal") - F.col("rest")) / whole).cast("long")))
    place = place.join(_last_passes(place), F.col("source").eqNullSafe(F.col("of_source")), "left")
    last = (((F.col("start") + F.col("size") <= F.col("rest")) & ~F.array_contains("leave", F.col("start")))
            | F.array_contains("add", F.col("start")))
    total = F.greatest(F.coalesce("total", "goal"), F.lit(1))
    slope = _nth(slopes, F.col("number"))
    turns = []
    for turn in range(int(-(-most // 1))):
        met = (F.col("passes") > turn) | ((F.col("passes") == turn) & (F.col("rest") > 0) & last)
        share = F.least(F.lit(1.0), (turn * F.col("source_size") + F.col("start") + F.col("size") / 2) / total)
        turns.append(F.struct(F.when(met, F.col("size")).otherwise(0).cast("long").alias("words"),
                              F.least(F.lit(1.0), _time_of(share, slope)).alias("position")))
    met = F.filter(F.array(*turns), lambda c: c["words"] > 0)
    return place.withColumn("copies", met).select(
        "doc_id", "source", *carry, "size", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]).alias("taken"), "copies", "order")


def _numbered_rows(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``nth``, which numbers rows alike from 0, however many there are.

    Rows alike are counted (pre-aggregated by task) and dealt out again in parts
    of ``ALIKE_ROWS``, so a row that a third of the table repeats is spread.
    """
    columns = rows.columns
    parts = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("many")).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("many") - 1) / ALIKE_ROWS).cast("long"))))
    begin = F.col("part") * ALIKE_ROWS
    nth = F.sequence(begin, F.least(begin + ALIKE_ROWS, F.col("many")) - 1)
    return parts.repartition("doc_id", "of_text", "part").select(*columns, F.explode(nth).alias("nth"))


def _last_passes(place: DataFrame) -> DataFrame:
    """``of_source, leave, add, total`` of each source whose stream ends within a pass.

    Documents (``leave`` and ``add``) are named by where they start.  Only the
    bucket in which the stream ends and its neighbours are looked at.
    """
    near = place.where((F.col("rest") > 0) & (F.col("size") > 0)
                       & (F.col("near_from") <= F.col("rest")) & (F.col("rest") < F.col("near_until")))
    inside = F.col("start") + F.col("size") <= F.col("rest")
    document = F.struct(F.abs(F.col("start") - F.col("rest")).alias("off"), "start", "size")
    sides = near.groupBy(F.col("source").alias("of_source")).agg(
        *(F.slice(F.sort_array(F.collect_list(F.when(side, document))), 1, NEAR).alias(name)
          for name, side in (("before", inside), ("after", ~inside))),
        F.min(F.when(~inside, F.col("start"))).alias("border"), F.first("rest").alias("rest"),
        F.first(F.col("passes") * F.col("source_size")).alias("passed"))

    def some(words: Column, *starts: Column) -> Column:
        return F.struct(words.cast("long").alias("words"), F.array(*starts).cast("array<bigint>").alias("starts"))

    none, one = F.array(some(F.lit(0))), lambda c: some(c["size"], c["start"])
    two = F.flatten(F.transform("after", lambda c, i: F.transform(
        F.slice("after", i + 2, NEAR), lambda d: some(c["size"] + d["size"], c["start"], d["start"]))))
    leave, add = F.concat(none, F.transform("before", one)), F.concat(none, F.transform("after", one), two)

    def choice(left: Column, added: Column) -> Column:
        total = F.col("passed") + F.col("border") - left["words"] + added["words"]
        return F.struct((total == 0).alias("nothing"), F.abs(total - F.col("passed") - F.col("rest")).alias("off"),
                        (F.size(left["starts"]) + F.size(added["starts"])).alias("changes"),
                        left["starts"].alias("leave"), added["starts"].alias("add"), total.alias("total"))

    sides = sides.select("*", leave.alias("leaves"), add.alias("adds"))
    best = F.array_min(F.flatten(F.transform("leaves", lambda x: F.transform("adds", lambda y: choice(x, y)))))
    return sides.select("of_source", best.alias("best")).select("of_source", "best.leave", "best.add", "best.total")


def _time_of(share: Column, slope: Column) -> Column:
    """The time t at which ``t + c (t^2 - t)`` is the share."""
    linear = 1 - slope
    root = (-linear + F.sqrt(linear * linear + 4 * slope * share)) / (2 * slope)
    return F.when(slope == 0, share).otherwise(root)


def curriculum(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """The training order: ``docs`` plus ``position``, a row for each time a document is met.

    Texts are whole.  Rows are range-sorted by position.  A column of ``docs`` named
    ``position`` stays, before the one made here.
    """
    own, names = numbered(docs)
    at = {c: names[c] for c in ("doc_id", "source", text)}
    rows = own.withColumns({"row_a": F.xxhash64(*own.columns), "row_b": F.xxhash64(F.lit(1), *own.columns)})
    mixed = mix(rows.select(*(F.col(at[c]).alias(c) for c in at), "row_a", "row_b"), text=text, carry=["row_a", "row_b"], **how)
    times = mixed.select("row_a", "row_b", F.explode("copies.position").alias("position"))
    # Of rows alike in every column one is looked up as often as all of them are met.
    met = rows.dropDuplicates(["row_a", "row_b"]).join(times, ["row_a", "row_b"])
    met = met.orderBy("position", "row_a", "row_b").select(*own.columns, "position")
    return named_back(met, [*docs.columns, "position"])


def mixed_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``curriculum`` in the columns of ``docs``."""
    own, _ = numbered(docs)
    ordered = curriculum(docs, text).toDF(*own.columns, "position")
    return named_back(ordered.drop("position"), docs.columns)


def training_places(mixed: DataFrame) -> DataFrame:
    """``mixed``, of ``mix``, with ``first_position``, ``first_place`` and ``last_place`` for ``copies`` and ``order``.

    All copies are range-sorted by position; a place is a copy's number in that
    order, from 1.  Documents that the mix does not take have nulls.
    """
    columns = [c for c in mixed.columns if c not in ("copies", "order")]
    rows = mixed.withColumn("row", F.monotonically_increasing_id()).checkpoint()
    met = rows.select("row", "order", F.posexplode("copies.position").alias("turn", "position"))
    placed = with_sort_position(met, [F.col("position"), F.col("order"), F.col("turn"), F.col("row")], "place")
    places = placed.groupBy("row").agg(F.min("position").alias("first_position"), F.min("place").alias("first_place"),
                                       F.max("place").alias("last_place"))
    return rows.join(places, "row", "left").select(*columns, "first_position", "first_place", "last_place")

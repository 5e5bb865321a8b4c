"""Ordering with the database's NULL placement, and a visible global position.

The database puts NULLs last on ascending and first on descending keys; Spark
does the reverse by default, so every key gets an explicit placement.

``with_sort_position`` numbers rows in sort order without a single-partition
window: a range-partitioned distributed sort, a reliable checkpoint to pin the
partitions, per-partition counts (one row per partition) turned into offsets,
and a broadcast of those offsets (size bounded by the partition count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def pg_sort_key(col, direction: str = "asc") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if direction == "asc":
        return c.asc_nulls_last()
    if direction == "desc":
        return c.desc_nulls_first()
    raise ValueError("direction must be asc or desc")


def pg_sort_keys(spec: Sequence[tuple[object, str]]) -> list[Column]:
    return [pg_sort_key(c, d) for c, d in spec]


def pg_order_by(df: DataFrame, spec: Sequence[tuple[object, str]]) -> DataFrame:
    return df.orderBy(*pg_sort_keys(spec))


def with_sort_position(df: DataFrame, keys: Sequence[Column], name: str = "pos") -> DataFrame:
    """``df`` plus ``name`` = 1-based position of the row in ``ORDER BY keys``.

    Keys should form a total order (end with a unique column) for a
    deterministic position.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*keys).checkpoint(eager=True)
    tagged = (ordered.withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id()))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    local_index = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), "__pid")
            .withColumn(name, F.col("__off") + local_index + 1)
            .drop("__pid", "__mid", "__off"))

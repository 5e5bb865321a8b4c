"""Data checks: key uniqueness, NOT NULL violations, truncated CSV headers.

Spark enforces neither keys nor NOT NULL on parquet tables, so each declared
constraint becomes a query that returns its violations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a header line of exactly this many characters hints at a
# truncated (corrupt) file.
TRUNCATED_HEADER_LENGTH = 1024


def primary_key_violations(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Key values that occur more than once or are NULL, with their count.

    A missing key column is an error naming the column (the reference warns
    and skips the key).
    """
    keys = [key] if isinstance(key, str) else list(key)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"primary key column(s) not found: {missing}")
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") > 1) | any_null))


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per declared NOT NULL column: the number of NULL rows (one pass)."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__v{i}")
                      for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__v{i}").alias("n_violations"))
                     for i, c in enumerate(columns)])
    return counts.select(F.inline(rows))


def header_line(content: Column) -> Column:
    """First line of a text, without surrounding whitespace."""
    first = F.substring_index(content, "\n", 1)
    return F.regexp_replace(first, r"^\s+|\s+\z", "")


def truncated_header(content: Column) -> tuple[Column, Column]:
    """(header length, header looks truncated)."""
    n = F.length(header_line(content)).cast("bigint")
    return n, n == TRUNCATED_HEADER_LENGTH

"""Columns by number, so that no name of the input can clash with one made here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns called ``c0_``, ``c1_``, ... in order, and what each is called now."""
    now = [f"c{i}_" for i in range(len(docs.columns))]
    return docs.toDF(*now), dict(zip(docs.columns, now))


def named_back(docs: DataFrame, names: Sequence[str]) -> DataFrame:
    """``docs`` with its columns called by ``names``, in order."""
    return docs.toDF(*names)

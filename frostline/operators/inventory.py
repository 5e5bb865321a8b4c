"""Metadata investigation views over code lists, dictionaries and page names.

All are aggregations with map-side partial aggregation; the "items having more
than one row" filters are semi joins against an aggregated key set, never a window over
the rows of an item, and both sides are dealt by item and by a part of it, so
one hot item never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import pg_substr

WORD_CHAR = r"\w"
# Parts that an item's rows are dealt into.
ITEM_PARTS = 256
# Items left out of code-mapping summaries, and dictionary
# tables left out of the page-name search.
SUMMARY_EXCLUDED_ITEMS = ("PAG_NAME",)
PAGE_SEARCH_EXCLUDED_TABLES = ("data_dictionary_annotated", "data_dictionary_harmonized")


def sorted_list(value: str, delimiter: str, order_by: str | None = None):
    """``listagg`` with a defined order (by the value unless ``order_by``)."""
    order = order_by or value
    return F.expr(f"listagg({value}, '{delimiter}') WITHIN GROUP (ORDER BY {order})")


def items_with_many(df: DataFrame, spread: Column, key: str = "itm_name") -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in more than one row (IN ... HAVING).

    ``spread`` parts the rows of one key; it must come out alike each time ``df``
    is computed.  The window sees one row for each part of a key.
    """
    part = F.pmod(F.xxhash64(spread), F.lit(ITEM_PARTS)).alias("__part")
    rows = F.sum("__n").over(Window.partitionBy(key))
    many = (df.select(key, part).groupBy(key, "__part").agg(F.count(F.lit(1)).alias("__n"))
            .withColumn("__rows", rows).filter("__rows > 1").select(key, "__part"))
    return df.select("*", part).join(many, [key, "__part"], "left_semi").drop("__part")


def shared_descriptions(dictionary: DataFrame) -> DataFrame:
    """Per (item, lower-cased description): how many modules use it, and which."""
    return (dictionary
            .filter(F.col("itm_name").rlike(WORD_CHAR))
            .groupBy(F.col("itm_name"), F.lower("dscr").alias("dscr"))
            .agg(F.count("mod_name").alias("n_mod_names"),
                 sorted_list("mod_name", ", ").alias("mod_names")))


def ambiguous_items(dictionary: DataFrame) -> DataFrame:
    """Shared-description rows of items that have more than one description;
    the description is cut to ``substr(dscr, 0, 50)`` (49 characters)."""
    shared = items_with_many(shared_descriptions(dictionary), F.col("dscr"))
    return shared.select("itm_name", pg_substr("dscr", 0, 50).alias("dscr (truncated)"),
                         "n_mod_names", "mod_names")


def code_list_summary(code_list: DataFrame,
                      excluded_items: Sequence[str] = SUMMARY_EXCLUDED_ITEMS) -> DataFrame:
    """One row per (item, module): ``code=decode`` pairs ordered by code."""
    pair = F.concat(F.col("code"), F.lit("="), F.lower("decode"))
    return (code_list
            .filter(~F.col("itm_name").isin(*excluded_items))
            .withColumn("__pair", pair)
            .groupBy("itm_name", "mod_name")
            .agg(sorted_list("__pair", ",", order_by="code").alias("code_mapping")))


def code_list_shared(code_list: DataFrame) -> DataFrame:
    """Per (item, code mapping): how many modules share it, and which."""
    return (code_list_summary(code_list)
            .groupBy("itm_name", "code_mapping")
            .agg(F.count("mod_name").alias("n_mod_names"),
                 sorted_list("mod_name", ", ").alias("mod_names"))
            .select("itm_name", "n_mod_names", "mod_names", "code_mapping"))


def code_list_variable(code_list: DataFrame) -> DataFrame:
    """Items whose code mapping differs between modules."""
    # Pairs of one code may be listed in any order, which leaves the length as it is.
    shared = code_list_shared(code_list)
    return items_with_many(shared, F.length("code_mapping")).select(*shared.columns)


def mod_item_summary(dictionary: DataFrame, code_list: DataFrame,
                     excluded_items: Sequence[str] = SUMMARY_EXCLUDED_ITEMS) -> DataFrame:
    """Dictionary (module, item) with its description and flattened code mapping."""
    dd = dictionary.filter(F.col("itm_name").rlike(WORD_CHAR)
                           & ~F.col("itm_name").isin(*excluded_items))
    summary = code_list_summary(code_list, excluded_items).select(
        F.col("mod_name").alias("s_mod"), F.col("itm_name").alias("s_itm"), "code_mapping")
    joined = dd.join(summary, (dd["mod_name"] == summary["s_mod"])
                     & (dd["itm_name"] == summary["s_itm"]), "left")
    return joined.select(dd["mod_name"], dd["itm_name"], F.lower(dd["dscr"]).alias("dscr"),
                         "code_mapping")


PAIR_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), True),
    T.StructField("pag_name", T.StringType(), True),
])


def page_name_pairs(spark, tables: Mapping[str, DataFrame] | Iterable[tuple[str, DataFrame]],
                    column_pattern: str = "^pag_name$",
                    excluded_tables: Iterable[str] = PAGE_SEARCH_EXCLUDED_TABLES) -> DataFrame:
    """Union of ``SELECT DISTINCT '<table>' AS table_name, <page col> AS pag_name``
    over every table with a column matching ``column_pattern``.

    ``tables`` is ``{name: DataFrame}`` or ``(name, DataFrame)`` pairs; pairs
    allow one name twice (the same table in two schemas), which then appears
    twice, as in a UNION ALL.  See ``sources.catalog.base_tables`` for the
    catalog form.  No qualifying table gives an empty result.
    """
    import re

    rx = re.compile(column_pattern)
    excluded = set(excluded_tables)
    parts = []
    items = tables.items() if isinstance(tables, Mapping) else tables
    for name, df in items:
        if name in excluded:
            continue
        for col in df.columns:
            if rx.search(col):
                parts.append(df.select(F.lit(name).alias("table_name"),
                                       F.col(f"`{col}`").cast("string").alias("pag_name"))
                             .distinct())
    if not parts:
        return spark.createDataFrame([], PAIR_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def table_pages(pairs: DataFrame) -> DataFrame:
    """Per table: number of page names and the list."""
    return pairs.groupBy("table_name").agg(F.count(F.lit(1)).alias("n"),
                                           sorted_list("pag_name", ", ").alias("pag_names"))


def page_tables(pairs: DataFrame) -> DataFrame:
    """Per page name: number of tables and the list."""
    return pairs.groupBy("pag_name").agg(F.count(F.lit(1)).alias("n"),
                                         sorted_list("table_name", ", ").alias("table_names"))

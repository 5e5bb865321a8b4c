"""Catalog-driven sources: overlay CSV files and table discovery."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.codes import CODE_LIST_SCHEMA, DICTIONARY_SCHEMA, nullable
from ..operators.inventory import PAIR_SCHEMA, page_name_pairs

# The code-list overlay shipped with the curated views
# (module, item, code, decode, mapping notes).
REFERENCE_CODE_LIST_OVERLAY = [
    ("SCREEN", "HANDED", "1", "RIGHT", None),
    ("SCREEN", "HANDED", "2", "LEFT", None),
    ("SCREEN", "HANDED", "3", "MIXED", None),
    ("SCREEN", "HISPLAT", "0", "Not Hispanic or Latino", None),
    ("SCREEN", "HISPLAT", "1", "Hispanic or Latino", None),
    ("SCREEN", "RAASIAN", "1", "Asian", None),
    ("SCREEN", "RABLACK", "1", "Black or African American", None),
    ("SCREEN", "RAHAWOPI", "1", "Native Hawaiian or Other Pacific Islander", None),
    ("SCREEN", "RAINDALS", "1", "American Indian or Alaska Native", None),
    ("SCREEN", "RANOS", "1", "Not Specified", None),
    ("SCREEN", "RAUNKNOWN", "1", "Unknown", None),
    ("SCREEN", "RAWHITE", "1", "White", None),
    ("SCREEN", "SEX", "0", "FEMALE", None),
    ("SCREEN", "SEX", "1", "MALE", None),
]
# The dictionary overlay ships with a header only.
REFERENCE_DICTIONARY_OVERLAY: list[tuple] = []


def text_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Rows of text columns that are part of the plan, so that the planner knows their size."""
    columns = list(zip(*rows)) or [()] * len(schema)
    return spark.createDataFrame(pa.table({f.name: pa.array(c, pa.string()) for f, c in zip(schema.fields, columns)}), schema)


def reference_code_list_overlay(spark: SparkSession) -> DataFrame:
    return text_rows(spark, REFERENCE_CODE_LIST_OVERLAY, nullable(CODE_LIST_SCHEMA))


def reference_dictionary_overlay(spark: SparkSession) -> DataFrame:
    return text_rows(spark, REFERENCE_DICTIONARY_OVERLAY, nullable(DICTIONARY_SCHEMA))


def read_overlay_csv(spark: SparkSession, path: str, kind: str = "code_list") -> DataFrame:
    """An overlay CSV (header row, declared columns; an empty field is NULL)."""
    schema = nullable(CODE_LIST_SCHEMA if kind == "code_list" else DICTIONARY_SCHEMA)
    return (spark.read.schema(schema)
            .options(header="true", sep=",", quote='"', escape='"', multiLine="true",
                     mode="FAILFAST")
            .csv(path))


# Dictionary tables left out of the page-name search.
DEFAULT_EXCLUDED = ("data_dictionary_annotated", "data_dictionary_harmonized")


def base_tables(spark: SparkSession, database: str, column: str = "pag_name",
                excluded: Iterable[str] = DEFAULT_EXCLUDED) -> dict[str, DataFrame]:
    """``{table: DataFrame}`` of base tables (not views) in ``database`` that
    have a column matching ``column`` (a regex, full match), minus ``excluded``.

    Only catalog metadata is read; each table is returned as a lazy scan.
    """
    rx = re.compile(column)
    skip = set(excluded)
    out = {}
    for t in spark.catalog.listTables(database):
        if t.isTemporary or t.tableType == "VIEW" or t.name in skip:
            continue
        qualified = f"`{database}`.`{t.name}`"
        cols = [c.name for c in spark.catalog.listColumns(qualified)]
        if any(rx.fullmatch(c) for c in cols):
            out[t.name] = spark.table(qualified)
    return out


# Types whose stored values one scan reads alike for every table that has them.
_PAGE_TYPES = ("string", "tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date")


def _normal(path: str) -> str:
    return re.sub("^file:/+", "/", path).rstrip("/")


def catalog_page_pairs(spark: SparkSession, database: str, column: str = "pag_name",
                       excluded: Iterable[str] = DEFAULT_EXCLUDED) -> DataFrame:
    """``page_name_pairs`` of a database's base tables that have a column matching
    ``column`` (a regex, full match), with one scan for each layout.

    Tables of unpartitioned Parquet files whose matching columns have the same names and
    types are one layout: their files are read together, only those columns, and rows are
    told apart by the file they came from.  So the plan grows with the layouts,
    not with the tables; names and locations of the tables are rows of a small relation in it.
    Other tables, and layouts one of whose locations is missing, are read one by one.  A
    table's pairs are distinct for each matching column, as in ``page_name_pairs``.
    """
    rx, skip = re.compile(column), set(excluded)
    layouts: dict[tuple, list[tuple[str, str]]] = defaultdict(list)
    single: list[str] = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary or t.tableType == "VIEW" or t.name in skip:
            continue
        told = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{t.name}` AS JSON").first()[0])
        pages = [(c["name"], c["type"]["name"]) for c in told["columns"] if rx.fullmatch(c["name"])]
        if not pages:
            continue
        if (str(told.get("provider", "")).lower() == "parquet" and told.get("location") and not told.get("partition_columns")
                and all(kind in _PAGE_TYPES for _, kind in pages)):
            layouts[tuple(pages)].append((t.name, told["location"]))
        else:
            single.append(t.name)
    parts = []
    for pages, tables in layouts.items():
        try:
            parts.append(_layout_pairs(spark, pages, tables))
        except AnalysisException as fault:
            if fault.getCondition() != "PATH_NOT_FOUND":
                raise
            single += [name for name, _ in tables]
    if single:
        parts.append(page_name_pairs(spark, {n: spark.table(f"`{database}`.`{n}`") for n in single}, f"^(?:{column})$", ()))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], PAIR_SCHEMA)


def _layout_pairs(spark: SparkSession, pages: tuple, tables: list[tuple[str, str]]) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StructType.fromDDL(f"x {kind}")["x"].dataType) for name, kind in pages])
    stored = spark.read.schema(schema).parquet(*sorted({location for _, location in tables}))
    file = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
    values = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{name}`").cast("string").alias("pag_name"))
                       for i, (name, _) in enumerate(pages)])
    # a table's location is a folder of files or a file itself
    found = (stored.select(file.alias("file"), F.inline(values)).distinct()
             .select("i", "pag_name", "file", F.regexp_replace("file", "/[^/]*$", "").alias("folder"))
             .select("i", "pag_name", F.explode(F.array("file", "folder")).alias("place")))
    names, places = zip(*[(name, _normal(location)) for name, location in tables])
    known = spark.createDataFrame(pa.table({"table_name": pa.array(names), "place": pa.array(places)}))
    return found.join(known, "place").select("i", "table_name", "pag_name").distinct().drop("i")

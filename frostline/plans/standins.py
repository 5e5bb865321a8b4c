"""Stand-in relations built from the driver's tables.

No clinical data is available, so the curated and metadata views run over
relations derived (by Spark, from whole tables) out of the TPC-H-like tables:

* code list  : order status per order priority (shared definitions) and part
               type per (brand, size) (variable definitions)
* dictionary : part types, size ranges, a page-name item, a blank item and a
               NULL description per brand
* flags      : one-hot style 0/1 columns over lineitem / orders, some NULL

The matching DuckDB text lives in ``plans.oracle``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.catalog import text_rows
from ..sources.parquet import read_parquet
from ..operators.codes import (CODE_LIST_SCHEMA, DICTIONARY_SCHEMA, nullable, overlay_code_list,
                               overlay_dictionary)


class Tables:
    """Lazy access to the driver's parquet tables of one scale factor."""

    NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
             "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_parquet(self.spark, f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def all(self) -> dict[str, DataFrame]:
        """Every table as scanned (no spreading: used where only a few columns
        of each table are read, e.g. the page-name search)."""
        return {n: read_parquet(self.spark, f"{self.sf_dir}/{n}.parquet")
                for n in self.NAMES}


def mm_yyyy(c) -> Column:
    """A timestamp as ``MM/yyyy`` text, the calendar form of the freeze files
    (built from month and year: cheaper per row than a pattern formatter)."""
    ts = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lpad(F.month(ts).cast("string"), 2, "0"), F.lit("/"),
                    F.lpad(F.year(ts).cast("string"), 4, "0"))


def _flag(cond: Column) -> Column:
    return cond.cast("int")


def code_list(t: Tables) -> DataFrame:
    status = (t("orders")
              .select(F.col("o_orderpriority").alias("mod_name"),
                      F.lit("STATUS").alias("itm_name"),
                      F.col("o_orderstatus").alias("code"),
                      F.when(F.col("o_orderstatus") == "F", "Filled")
                       .when(F.col("o_orderstatus") == "O", "Open")
                       .otherwise("Pending").alias("decode"),
                      F.lit(None).cast("string").alias("mapping_notes"))
              .distinct())
    size = (t("part").groupBy("p_brand", "p_size")
            .agg(F.min("p_type").alias("decode"), F.count(F.lit(1)).alias("n"))
            .select(F.col("p_brand").alias("mod_name"), F.lit("SIZE").alias("itm_name"),
                    F.col("p_size").cast("string").alias("code"), "decode",
                    F.concat(F.lit("parts="), F.col("n").cast("string")).alias("mapping_notes")))
    return status.unionByName(size)


# Overlay rows of the stand-in code list and dictionary.  They
# include a NULL decode (falls through to the base), an overlay-only key (never
# shown) and notes-only corrections.
CODE_LIST_OVERLAY_ROWS = [
    ("1-URGENT", "STATUS", "F", "Fulfilled", None),
    ("2-HIGH", "STATUS", "O", None, "label kept"),
    ("9-NONE", "STATUS", "X", "Unknown", None),
    ("Brand#1", "SIZE", "1", "TINY", "resized"),
    ("Brand#2", "SIZE", "10", None, None),
]
DICTIONARY_OVERLAY_ROWS = [
    ("Brand#1", "SIZE", "Overlaid size range", "from overlay"),
    ("Brand#2", "NOTE", None, "notes only"),
    ("Brand#99", "SIZE", "orphan", None),
]


def code_list_overlay(spark: SparkSession) -> DataFrame:
    return text_rows(spark, CODE_LIST_OVERLAY_ROWS, nullable(CODE_LIST_SCHEMA))


def dictionary_overlay(spark: SparkSession) -> DataFrame:
    return text_rows(spark, DICTIONARY_OVERLAY_ROWS, nullable(DICTIONARY_SCHEMA))


#: Where an application stored the code list of a folder's tables.
_STORED: dict[tuple[str, str], str] = {}


def stored_code_list(t: Tables) -> DataFrame:
    """The code list as a stored table, as a loaded freeze has it: looked up many
    times, derived once, and of a size the planner knows."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _STORED:
        path = f"{scratch_dir(t.spark, 'code_list')}/rows"
        code_list(t).write.parquet(path)
        _STORED[key] = path
    return t.spark.read.schema(nullable(CODE_LIST_SCHEMA)).parquet(_STORED[key])


def code_list_view(t: Tables) -> DataFrame:
    return overlay_code_list(stored_code_list(t), code_list_overlay(t.spark))


def dictionary(t: Tables) -> DataFrame:
    part = t("part")
    null_notes = F.lit(None).cast("string").alias("mapping_notes")
    types = (part.groupBy("p_brand", "p_type").agg(F.min("p_name").alias("dscr"))
             .select(F.col("p_brand").alias("mod_name"), F.col("p_type").alias("itm_name"),
                     "dscr", null_notes))
    per_brand = part.groupBy("p_brand").agg(F.min("p_size").alias("lo"), F.max("p_size").alias("hi"))
    size = per_brand.select(
        F.col("p_brand").alias("mod_name"), F.lit("SIZE").alias("itm_name"),
        F.concat(F.lit("Size "), F.col("lo").cast("string"), F.lit(" to "),
                 F.col("hi").cast("string")).alias("dscr"), null_notes)
    extra = [
        per_brand.select(F.col("p_brand").alias("mod_name"), F.lit(item).alias("itm_name"),
                         F.lit(dscr).cast("string").alias("dscr"), null_notes)
        for item, dscr in (("PAG_NAME", "Page name"), ("-", "No item"), ("NOTE", None))
    ]
    return reduce(DataFrame.unionByName, [types, size, *extra])


def dictionary_view(t: Tables) -> DataFrame:
    return overlay_dictionary(dictionary(t), dictionary_overlay(t.spark))


def document_dictionary(t: Tables) -> DataFrame:
    """Documents as dictionary rows: module = source, item = language,
    description = the whole text."""
    return t("documents").select(F.col("source").alias("mod_name"), F.col("lang").alias("itm_name"),
                                 F.col("text").alias("dscr"),
                                 F.lit(None).cast("string").alias("mapping_notes"))


def lineitem_flags(li: DataFrame) -> DataFrame:
    """lineitem plus 0/1 flag columns; ``f_ret`` is NULL for return flag N."""
    return li.select(
        "*",
        _flag(F.col("l_quantity") > 30).alias("f_qty"),
        _flag(F.col("l_tax") > 0.04).alias("f_tax"),
        _flag(F.col("l_discount") > 0.05).alias("f_disc"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("int"))
         .otherwise(_flag(F.col("l_returnflag") == "R")).alias("f_ret"),
        _flag(F.col("l_linestatus") == "O").alias("f_open"),
        _flag(F.col("l_quantity") < 10).alias("f_small"),
        _flag(F.col("l_tax") == 0).alias("f_notax"),
        _flag(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).alias("f_late"),
    )


# Stand-in lookups for the demographics view (column -> (module, item)).
STANDIN_DEMOGRAPHICS_LOOKUPS = {
    "aficberb": ("Brand#1", "SIZE"),
    "ashkjew": ("Brand#1", "SIZE"),
    "basque": ("Brand#1", "SIZE"),
    "sex": ("1-URGENT", "STATUS"),
    "howlive": ("Brand#2", "SIZE"),
    "handed": ("Brand#3", "SIZE"),
    "hisplat": ("2-HIGH", "STATUS"),
}
STANDIN_RACE_FLAGS = (
    ("raasian", ("Brand#1", "SIZE")),
    ("rablack", ("Brand#2", "SIZE")),
    ("rahawopi", ("Brand#3", "SIZE")),
    ("raindals", ("Brand#4", "SIZE")),
    ("ranos", ("Brand#5", "SIZE")),
    ("rawhite", ("Brand#6", "SIZE")),
    ("raunknown", ("Brand#7", "SIZE")),
)


def demographics_raw(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(demographics, socio_economics) with the clinical column names."""
    li = lineitem_flags(t("lineitem"))
    orders = t("orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    demo = li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "inner").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("rec_id"),
        F.col("l_orderkey").alias("patno"),
        mm_yyyy("l_shipdate").alias("infodt"),
        F.col("f_qty").alias("aficberb"), F.col("f_tax").alias("ashkjew"),
        F.col("f_disc").alias("basque"),
        mm_yyyy("o_orderdate").alias("birthdt"),
        F.col("o_orderstatus").alias("sex"),
        F.col("l_linenumber").alias("howlive"),
        F.col("l_linenumber").alias("handed"),
        F.col("l_linestatus").alias("hisplat"),
        F.col("f_qty").alias("raasian"), F.col("f_tax").alias("rablack"),
        F.col("f_disc").alias("rahawopi"), F.col("f_ret").alias("raindals"),
        F.col("f_open").alias("ranos"), F.col("f_small").alias("rawhite"),
        F.col("f_notax").alias("raunknown"),
        F.when(F.col("o_orderstatus") == "P", F.lit("UNK"))
         .otherwise(mm_yyyy("l_shipdate")).alias("orig_entry"),
        F.col("l_shipdate").alias("last_update"),
    )
    socio = t("lineitem").select(F.col("l_orderkey").alias("patno"),
                                 (F.col("l_quantity") / 4).alias("educyrs"))
    return demo, socio


def participant_status_raw(t: Tables) -> DataFrame:
    o = t("orders")
    pink1 = _flag(F.col("o_totalprice") > 300000)
    return o.select(
        F.col("o_orderkey").alias("patno"),
        F.col("o_orderpriority").alias("cohort_definition"),
        mm_yyyy("o_orderdate").alias("enroll_date"),
        F.col("o_orderstatus").alias("enroll_status"),
        F.when(F.col("o_orderstatus") == "P", F.lit("UNK"))
         .otherwise(mm_yyyy("o_orderdate")).alias("status_date"),
        F.col("o_custkey").alias("screenedam4"),
        F.col("o_totalprice").alias("enroll_age"),
        F.col("o_orderpriority").alias("inexpage"),
        pink1.alias("av133stdy"),
        _flag(F.col("o_orderstatus") == "F").alias("taustdy"),
        _flag(F.col("o_orderstatus") == "O").alias("gaitstdy"),
        _flag(F.col("o_orderpriority") == "1-URGENT").alias("pistdy"),
        _flag(F.col("o_orderpriority") == "2-HIGH").alias("sv2astdy"),
        mm_yyyy("o_orderdate").alias("datelig"),
        F.col("o_orderstatus").alias("ppmi_online_enroll"),
        pink1.alias("enrlpink1"),
        _flag(F.col("o_orderstatus") == "F").alias("enrlprkn"),
        _flag(F.col("o_orderstatus") == "O").alias("enrlsrdc"),
        _flag(F.col("o_orderpriority") == "1-URGENT").alias("enrlhpsm"),
        _flag(F.col("o_orderpriority") == "2-HIGH").alias("enrlrbd"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("int"))
         .otherwise(_flag(F.col("o_totalprice") < 100000)).alias("enrllrrk2"),
        _flag(F.col("o_custkey") < 100).alias("enrlsnca"),
        _flag(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).alias("enrlgba"),
        _flag(F.col("o_orderpriority") == "3-MEDIUM").alias("enrlnorm"),
    )


def diagnosis_history_raw(t: Tables) -> DataFrame:
    li = lineitem_flags(t("lineitem"))
    part = t("part").select("p_partkey", "p_brand")
    j = li.join(part, li["l_partkey"] == part["p_partkey"], "left")
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("rec_id"),
        F.col("l_orderkey").alias("patno"),
        F.col("l_linestatus").alias("event_id"),
        F.col("p_brand").alias("pag_name"),
        mm_yyyy("l_shipdate").alias("infodt"),
        F.when(F.col("l_returnflag") == "A", F.lit("UNK"))
         .otherwise(mm_yyyy("l_shipdate")).alias("sxdt"),
        F.when(F.col("l_linestatus") == "F", F.lit(None).cast("string"))
         .otherwise(mm_yyyy("l_shipdate")).alias("pddxdt"),
        mm_yyyy("l_shipdate").alias("orig_entry"),
        F.col("f_qty").alias("dxtremor"), F.col("f_tax").alias("dxrigid"),
        F.col("f_disc").alias("dxbrady"), F.col("f_ret").alias("dxposins"),
        F.col("f_open").alias("dxothsx"),
        F.col("l_linenumber").alias("domside"),
    )


def part_with_wide(t: Tables) -> DataFrame:
    """``part_as_text`` plus a column of integers that 64 bits cannot hold."""
    return part_as_text(t).withColumn("wide", F.concat(F.col("P_PARTKEY"), F.repeat(F.lit("0"), F.lit(18))))


def part_as_text(t: Tables) -> DataFrame:
    """part as the all-text table a CSV scan yields, plus a boolean-looking, a
    mixed int/float and an all-NULL column; brand has NULLs."""
    p = t("part")
    return p.select(
        F.col("p_partkey").cast("string").alias("P_PARTKEY"),
        F.col("p_name").alias("P_NAME"),
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("P-BRAND"),
        F.col("p_type").alias("P TYPE"),
        F.col("p_size").cast("string").alias("p_size"),
        F.col("p_retailprice").cast("string").alias("p_retailprice"),
        F.when(F.col("p_size") > 25, F.lit("true")).otherwise(F.lit("False")).alias("is_big"),
        F.when(F.col("p_size") > 40, F.col("p_retailprice").cast("string"))
         .otherwise(F.col("p_size").cast("string")).alias("mixed"),
        F.lit(None).cast("string").alias("empty_col"),
    )


def orders_with_nulls(t: Tables) -> DataFrame:
    o = t("orders")
    return o.select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        "o_totalprice")

"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query runs one operator of the inventory over whole driver tables (or
relations Spark derives from them, see ``standins``).  Names match the keys of
``plans.oracle.ORACLE_SQL``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import clean_sql_name, dscr_to_table_name, table_name_from_path
from ..functions.scalars import (blanks_to_null, flags_to_tags, mm_yyyy_to_yyyy_mm, number_text,
                                 one_hot_class, round_half_even_smallint, safe_boolean)
from ..operators import inventory as inv
from ..operators.codes import CodeLookup
from ..operators.ordering import pg_sort_keys, with_sort_position
from . import curated
from . import standins as si
from .standins import Tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return register


# ---------------------------------------------------------------- curated views

@query("view_demographics")
def view_demographics(spark, sf_dir):
    t = Tables(spark, sf_dir)
    demo, socio = si.demographics_raw(t)
    return curated.demographics(demo, socio, si.code_list_view(t),
                               lookups=si.STANDIN_DEMOGRAPHICS_LOOKUPS,
                               race_flags=si.STANDIN_RACE_FLAGS)


@query("view_participant_status")
def view_participant_status(spark, sf_dir):
    return curated.participant_status(si.participant_status_raw(Tables(spark, sf_dir)))


@query("view_diagnosis_history")
def view_diagnosis_history(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return curated.diagnosis_history(si.diagnosis_history_raw(t), si.code_list_view(t),
                                    domside_item="SIZE")


# ------------------------------------------------------------- scalar functions

@query("fn_mm_yyyy")
def fn_mm_yyyy(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders")
    raw = (F.when(F.col("o_orderstatus") == "P", F.lit("UNK"))
           .when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
           .otherwise(si.mm_yyyy("o_orderdate")))
    return o.select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", "raw", mm_yyyy_to_yyyy_mm("raw").alias("yyyy_mm"))


@query("fn_safe_boolean")
def fn_safe_boolean(spark, sf_dir):
    li = Tables(spark, sf_dir)("lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag",
                     safe_boolean("l_returnflag").alias("as_boolean"))


@query("fn_flags_to_tags")
def fn_flags_to_tags(spark, sf_dir):
    li = si.lineitem_flags(Tables(spark, sf_dir)("lineitem"))
    genes = {"PINK1": "f_qty", "PRKN": "f_tax", "SRDC": "f_disc", "HPSM": "f_ret",
             "RBD": "f_open", "LRRK2": "f_small", "SNCA": "f_notax", "GBA": "f_late"}
    symptoms = {"TREMOR": "f_qty", "RIGID": "f_tax", "BRADY": "f_disc", "POSINS": "f_ret",
                "OTHSX": "f_open"}
    return li.select("l_orderkey", "l_linenumber",
                     flags_to_tags(genes).alias("mutations"),
                     flags_to_tags(symptoms).alias("dx_symptoms"))


@query("fn_one_hot_class")
def fn_one_hot_class(spark, sf_dir):
    li = si.lineitem_flags(Tables(spark, sf_dir)("lineitem"))
    labels = ["ASIAN", "BLACK", "HAWOPI", "INDALS", "NOS", "WHITE", "UNKNOWN"]
    cols = ["f_qty", "f_tax", "f_disc", "f_ret", "f_open", "f_small", "f_notax"]
    race = one_hot_class([(F.col(c), F.lit(lbl)) for c, lbl in zip(cols, labels)],
                         curated.RACE_NONE, curated.RACE_MANY)
    return li.select("l_orderkey", "l_linenumber", race.alias("race"))


def _size_lookup(spark, sf_dir, output):
    t = Tables(spark, sf_dir)
    part = t("part").select("p_partkey", "p_size")
    lk = CodeLookup(si.code_list_view(t), output=output)
    return lk.add(part, "looked_up", "Brand#1", "SIZE", "p_size")


@query("fn_code_lookup")
def fn_code_lookup(spark, sf_dir):
    return _size_lookup(spark, sf_dir, "code")


@query("fn_code_decode")
def fn_code_decode(spark, sf_dir):
    return _size_lookup(spark, sf_dir, "decode")


@query("lookup_dynamic_module")
def lookup_dynamic_module(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    lk = CodeLookup(si.code_list_view(t), output="decode")
    return lk.add(o, "status_label", F.col("o_orderpriority"), "STATUS", "o_orderstatus")


@query("corr_scalar_max")
def corr_scalar_max(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t("orders").select("o_orderkey")
    mx = (t("lineitem").groupBy("l_orderkey")
          .agg(F.max(round_half_even_smallint(F.col("l_quantity") / 4)).alias("max_qty")))
    return o.join(mx, o["o_orderkey"] == mx["l_orderkey"], "left").select("o_orderkey", "max_qty")


def _url_names(spark, sf_dir):
    return Tables(spark, sf_dir)("pages").select("page_id", "url")


@query("fn_clean_name")
def fn_clean_name(spark, sf_dir):
    return _url_names(spark, sf_dir).select("page_id", clean_sql_name("url").alias("sql_name"))


@query("fn_table_name")
def fn_table_name(spark, sf_dir):
    p = _url_names(spark, sf_dir)
    return p.select("page_id", table_name_from_path(
        F.concat(F.col("url"), F.lit("_20250401.csv"))).alias("table_name"))


@query("fn_dscr_name")
def fn_dscr_name(spark, sf_dir):
    return _url_names(spark, sf_dir).select("page_id", dscr_to_table_name("url").alias("table_name"))


@query("fn_strings")
def fn_strings(spark, sf_dir):
    p = Tables(spark, sf_dir)("part")
    return p.select("p_partkey", F.lower("p_name").alias("name_lower"),
                    F.concat(F.col("p_brand"), F.lit("="), F.lower("p_type")).alias("pair"))


@query("fn_casts")
def fn_casts(spark, sf_dir):
    li = Tables(spark, sf_dir)("lineitem")
    half = F.col("l_quantity") / 2
    return li.select("l_orderkey", "l_linenumber",
                     round_half_even_smallint(half).alias("qty_smallint"),
                     number_text("l_quantity").alias("qty_text"),
                     number_text(half).alias("half_text"))


@query("filter_regex")
def filter_regex(spark, sf_dir):
    p = Tables(spark, sf_dir)("part")
    item = (F.when(F.col("p_type") == "SMALL", F.lit(" "))
            .when(F.col("p_type") == "ECONOMY", F.lit(None).cast("string"))
            .otherwise(F.col("p_type")))
    return (p.select("p_partkey", item.alias("itm_name"))
            .filter(F.col("itm_name").rlike(inv.WORD_CHAR)))


@query("filter_not_in")
def filter_not_in(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders")
    pri = F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM"))
    return (o.select("o_orderkey", pri.alias("priority"))
            .filter(~F.col("priority").isin("1-URGENT", "2-HIGH")))


@query("semi_having")
def semi_having(spark, sf_dir):
    p = Tables(spark, sf_dir)("part").select("p_partkey", "p_name", "p_brand", "p_size")
    return inv.items_with_many(p, F.col("p_partkey"), key="p_name")


@query("sort_nulls")
def sort_nulls(spark, sf_dir):
    o = Tables(spark, sf_dir)("orders")
    df = o.select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("priority"),
                  F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double"))
                   .otherwise(F.col("o_totalprice")).alias("price"))
    keys = pg_sort_keys([("priority", "asc"), ("price", "desc"), ("o_orderkey", "asc")])
    return with_sort_position(df, keys, "pos")


@query("blanks_to_null")
def blanks_to_null_q(spark, sf_dir):
    d = Tables(spark, sf_dir)("documents").select("doc_id", "text", "lang", "source")
    return blanks_to_null(d, ["text", "lang", "source"])


# -------------------------------------------------------- overlays + inventory

@query("overlay_code_list")
def q_overlay_code_list(spark, sf_dir):
    return si.code_list_view(Tables(spark, sf_dir))


@query("overlay_dictionary")
def q_overlay_dictionary(spark, sf_dir):
    return si.dictionary_view(Tables(spark, sf_dir))


@query("shared_descriptions")
def q_shared_descriptions(spark, sf_dir):
    return inv.shared_descriptions(si.dictionary(Tables(spark, sf_dir)))


@query("ambiguous_items")
def q_ambiguous_items(spark, sf_dir):
    return inv.ambiguous_items(si.document_dictionary(Tables(spark, sf_dir)))


@query("code_list_summary")
def q_code_list_summary(spark, sf_dir):
    return inv.code_list_summary(si.code_list(Tables(spark, sf_dir)))


@query("code_list_shared")
def q_code_list_shared(spark, sf_dir):
    return inv.code_list_shared(si.code_list(Tables(spark, sf_dir)))


@query("code_list_variable")
def q_code_list_variable(spark, sf_dir):
    return inv.code_list_variable(si.code_list(Tables(spark, sf_dir)))


@query("mod_item_summary")
def q_mod_item_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return inv.mod_item_summary(si.dictionary(t), si.code_list(t))


NATION_PAGES = r"_nationkey$"


def _pairs(spark, sf_dir):
    return inv.page_name_pairs(spark, Tables(spark, sf_dir).all(), column_pattern=NATION_PAGES)


@query("ident_page_pairs")
def q_ident_page_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).select("pag_name", "table_name")


@query("distinct_pairs")
def q_distinct_pairs(spark, sf_dir):
    c = Tables(spark, sf_dir)("customer")
    return c.select(F.lit("customer").alias("table_name"),
                    F.col("c_nationkey").cast("string").alias("pag_name"),
                    F.col("c_mktsegment").alias("segment")).distinct()


@query("table_pages")
def q_table_pages(spark, sf_dir):
    return inv.table_pages(_pairs(spark, sf_dir))


@query("page_tables")
def q_page_tables(spark, sf_dir):
    return inv.page_tables(_pairs(spark, sf_dir))


def queries() -> dict[str, Query]:
    from . import catalogue_io  # noqa: F401  (registers the profile/check/source queries)
    return dict(REGISTRY)

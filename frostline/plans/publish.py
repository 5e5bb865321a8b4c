"""Publish the curated and metadata views over a loaded warehouse.

The reference builds views in a second schema that shadow the raw tables'
names.  Here each view is a session view with the same name, reading the
warehouse tables by qualified name (``freeze.demographics``), so a view never
reads itself and can be replaced again.  Descriptions are kept in
``VIEW_DESCRIPTIONS``.  Column comments can be taken from the data dictionary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import blanks_to_null
from ..operators import inventory as inv
from ..operators.codes import overlay_code_list, overlay_dictionary
from ..operators.ordering import pg_order_by
from ..sinks.warehouse import Warehouse, _lit, _q
from ..sources.catalog import catalog_page_pairs, reference_code_list_overlay, reference_dictionary_overlay
from . import curated

# View descriptions.
VIEW_DESCRIPTIONS = {
    "data_dict_shared_descriptions_v": "show items and descriptions shared across all mods (tables)",
    "data_dict_ambiguous_items_v": "show all items with ambiguous descriptions",
    "code_list_summary_v": "code list values, one row per (mod_name,itm_name) pair",
    "code_list_shared_definitions_v": "code list items with shared (identical) names and definitions",
    "code_list_variable_definitions_v": "code list items with variable definitions in multiple mods (tables)",
    "mod_item_summary_v": "summary of <mod,item> pairs with descriptions and flattened code mapping",
}


# The presentation order of the views that declare one
# (database NULL placement: last on ascending, first on descending keys).
VIEW_ORDER = {
    "data_dict_shared_descriptions_v": [("itm_name", "asc"), ("dscr", "desc")],
    "code_list_summary_v": [("itm_name", "asc")],
    "code_list_shared_definitions_v": [("itm_name", "asc"), ("n_mod_names", "desc")],
    "unique_table_pag_name_pairs_v": [("pag_name", "asc"), ("table_name", "asc")],
}


def _publish(df: DataFrame, name: str, published: dict[str, DataFrame]) -> None:
    if name in VIEW_ORDER:  # metadata-sized views: a final sort for presentation
        df = pg_order_by(df, VIEW_ORDER[name])
    df.createOrReplaceTempView(name)
    published[name] = df


def _overlay(wh: Warehouse, table: str, given: DataFrame | None, shipped) -> DataFrame:
    """The overlay given, else the warehouse's table, else the rows shipped here."""
    if given is not None:
        return given
    return wh.read(table) if wh.exists(table) else shipped(wh.spark)


def publish_views(spark: SparkSession, wh: Warehouse, code_list_overlay: DataFrame | None = None,
                  dictionary_overlay: DataFrame | None = None,
                  lookup_output: str = "code") -> dict[str, DataFrame]:
    """Create every view whose source tables exist; returns ``{name: DataFrame}``."""
    out: dict[str, DataFrame] = {}
    has = wh.exists
    if has("code_list_annotated"):
        clo = _overlay(wh, "_code_list_overlay", code_list_overlay, reference_code_list_overlay)
        cl = wh.read("code_list_annotated")
        _publish(overlay_code_list(cl, clo), "code_list_v", out)
        _publish(inv.code_list_summary(cl), "code_list_summary_v", out)
        _publish(inv.code_list_shared(cl), "code_list_shared_definitions_v", out)
        _publish(inv.code_list_variable(cl), "code_list_variable_definitions_v", out)
    if has("data_dictionary_annotated"):
        dd = blanks_to_null(wh.read("data_dictionary_annotated"))
        ddo = _overlay(wh, "_data_dictionary_overlay", dictionary_overlay, reference_dictionary_overlay)
        _publish(overlay_dictionary(dd, ddo), "data_dictionary_v", out)
        _publish(inv.shared_descriptions(dd), "data_dict_shared_descriptions_v", out)
        _publish(inv.ambiguous_items(dd), "data_dict_ambiguous_items_v", out)
        if has("code_list_annotated"):
            _publish(inv.mod_item_summary(dd, wh.read("code_list_annotated")), "mod_item_summary_v", out)
    if "code_list_v" in out:
        clv = out["code_list_v"]
        if has("demographics") and has("socio_economics"):
            _publish(curated.demographics(wh.read("demographics"), wh.read("socio_economics"), clv,
                                         output=lookup_output), "demographics", out)
        if has("pd_diagnosis_history"):
            _publish(curated.diagnosis_history(wh.read("pd_diagnosis_history"), clv, output=lookup_output),
                     "pd_diagnosis_history", out)
    if has("participant_status"):
        _publish(curated.participant_status(wh.read("participant_status")), "participant_status", out)
    pairs = catalog_page_pairs(spark, wh.database)
    _publish(pairs.select("pag_name", "table_name"), "unique_table_pag_name_pairs_v", out)
    _publish(inv.table_pages(pairs), "table_pag_names_v", out)
    _publish(inv.page_tables(pairs), "pag_name_tables_v", out)
    return out


def apply_dictionary_comments(spark: SparkSession, wh: Warehouse, dictionary: DataFrame) -> int:
    """Column comments from the dictionary: table = lower(mod_name), column =
    lower(itm_name), comment = description.  Only the dictionary rows of
    existing tables are read (metadata).  Returns the number of comments set."""
    tables = {t.name for t in spark.catalog.listTables(wh.database) if not t.isTemporary}
    rows = (dictionary.select(F.lower("mod_name").alias("t"), F.lower("itm_name").alias("c"), "dscr")
            .filter(F.col("t").isin(*tables) & F.col("dscr").isNotNull())
            .groupBy("t", "c").agg(F.min("dscr").alias("dscr")).collect()) if tables else []
    n = 0
    for r in rows:
        if r.c in {f.name for f in wh.schema(r.t).fields}:
            spark.sql(f"ALTER TABLE {wh.name(r.t)} ALTER COLUMN {_q(r.c)} COMMENT {_lit(r.dscr)}")
            n += 1
    return n

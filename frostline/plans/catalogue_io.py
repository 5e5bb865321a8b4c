"""Profile, check, source and sink queries (registered on import)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.codes import overlay_code_list
from ..session import scratch_dir
from ..sinks.external import CommittedFiles, ExternalSink
from ..sinks.warehouse import Warehouse, export_csv
from ..sources import catalog
from ..sources import csv as csvsrc
from ..sources.catalog import read_overlay_csv
from ..sources.staging import MEMBER_ID
from ..sources.text import FILE_PATCHES, cp1252_decode, cp1252_encode, repair
from .freeze_fixture import Freeze
from .load import load_freeze, scan_staged_table, stage_freeze
from ..operators import checks
from ..operators.profile import merge_profiles, profile, schema_report
from . import standins as si
from .catalog_views import create_views
from .catalogue import query
from .standins import Tables


def _part_profile(spark, sf_dir):
    return profile(si.part_as_text(Tables(spark, sf_dir)), "part")


@query("prf_profile")
def prf_profile(spark, sf_dir):
    return _part_profile(spark, sf_dir)


@query("prf_base_type")
def prf_base_type(spark, sf_dir):
    return _part_profile(spark, sf_dir).select("ordinal", "csv_name", "base_type", "is_nullable")


@query("prf_narrow_types")
def prf_narrow_types(spark, sf_dir):
    return _part_profile(spark, sf_dir).select("csv_name", "sql_name", "sql_type", "spark_type")


@query("prf_merge")
def prf_merge(spark, sf_dir):
    """Profiles of two parts of a table, merged; a column of integers beyond 64 bits."""
    p = si.part_with_wide(Tables(spark, sf_dir))
    large = F.coalesce(F.col("is_big") == "true", F.lit(False))
    return merge_profiles(profile(p.where(~large), "part"), profile(p.where(large), "part"))


@query("prf_report")
def prf_report(spark, sf_dir):
    return schema_report(_part_profile(spark, sf_dir))


@query("chk_primary_key")
def chk_primary_key(spark, sf_dir):
    li = Tables(spark, sf_dir)("lineitem")
    return checks.primary_key_violations(li, "l_orderkey")


@query("chk_not_null")
def chk_not_null(spark, sf_dir):
    o = si.orders_with_nulls(Tables(spark, sf_dir))
    return checks.not_null_violations(o, ["o_orderkey", "o_orderpriority", "o_orderstatus"])


@query("chk_truncated_header")
def chk_truncated_header(spark, sf_dir):
    d = Tables(spark, sf_dir)("documents")
    n, cut = checks.truncated_header(F.col("text"))
    return d.select("doc_id", n.alias("header_length"), cut.alias("truncated"))


# ------------------------------------------------------------ sources / sinks




def _data_columns(df):
    return csvsrc.whole_records(df).drop(MEMBER_ID)


def _loaded(audit, unexpected="status NOT IN ('loaded')"):
    """Fails when a member that should load did not."""
    if rejected := audit.filter(unexpected).collect():
        raise ValueError(f"members not loaded: {rejected}")


def _warehouse(spark):
    return Warehouse(spark, database=f"freeze_{uuid.uuid4().hex[:10]}")


def documents_with_note(t):
    d = t("documents")
    note = (F.when(F.col("lang") == "en", F.lit(""))
            .when(F.col("lang") == "de", F.lit(None).cast("string"))
            .otherwise(F.col("source")))
    return d.select("doc_id", "lang", "source", "text", note.alias("note"))


@query("src_archive")
def src_archive(spark, sf_dir):
    fz = Freeze(spark, Tables(spark, sf_dir)("orders"), "Orders")
    staged = stage_freeze(spark, archives=fz.archives)
    return _data_columns(scan_staged_table(spark, staged, "orders"))


@query("snk_create_load")
def snk_create_load(spark, sf_dir):
    fz = Freeze(spark, Tables(spark, sf_dir)("orders"), "Orders")
    wh = _warehouse(spark)
    _loaded(load_freeze(spark, wh, archives=fz.archives))
    return wh.read("orders")


@query("src_member_filter")
def src_member_filter(spark, sf_dir):
    fz = Freeze(spark, Tables(spark, sf_dir)("orders"), "Orders", partition_by="o_orderpriority")
    wanted = [m for m in fz.members if "=1-URGENT/" in m or "=2-HIGH/" in m]
    wh = _warehouse(spark)
    _loaded(load_freeze(spark, wh, archives=fz.archives, members=wanted + ["missing/Orders_20250401.csv"]),
            "status NOT IN ('loaded', 'not_found')")
    return wh.read("orders")


@query("src_csv_scan")
def src_csv_scan(spark, sf_dir):
    fz_dir = Freeze(spark, documents_with_note(Tables(spark, sf_dir)), "Documents").csv_dir
    return csvsrc.read_text_csv(spark, fz_dir + "/*.csv").drop(csvsrc.CORRUPT)


@query("src_multi_file")
def src_multi_file(spark, sf_dir):
    fz = Freeze(spark, Tables(spark, sf_dir)("customer"), "Customer", container="dir")
    wh = _warehouse(spark)
    _loaded(load_freeze(spark, wh, files=fz.members))
    return wh.read("customer")


@query("src_cp1252_decode")
def src_cp1252_decode(spark, sf_dir):
    d = Tables(spark, sf_dir)("documents")
    return d.select("doc_id", cp1252_decode(cp1252_encode("text")).alias("text"))


@query("src_quote_repair")
def src_quote_repair(spark, sf_dir):
    d = Tables(spark, sf_dir)("documents").select("doc_id", "lang", "text")
    fz = Freeze(spark, d, "Documents", quote_escape="\\")
    staged = stage_freeze(spark, archives=fz.archives)
    return _data_columns(scan_staged_table(spark, staged, "documents"))


STANDIN_PATCHES = (("Primary_Clinical_Diagnosis_", " the ", " THE "), *FILE_PATCHES)


@query("src_file_patch")
def src_file_patch(spark, sf_dir):
    d = Tables(spark, sf_dir)("documents")
    member = F.concat(F.when(F.col("lang") == "en", F.lit("Primary_Clinical_Diagnosis_"))
                      .otherwise(F.lit("Other_")), F.col("doc_id").cast("string"), F.lit(".csv"))
    return d.select("doc_id", repair(F.col("text"), member, STANDIN_PATCHES).alias("text"))


@query("snk_export_csv")
def snk_export_csv(spark, sf_dir):
    path = scratch_dir(spark, "export")
    export_csv(si.part_as_text(Tables(spark, sf_dir)), path)
    return csvsrc.read_text_csv(spark, path + "/*.csv").drop(csvsrc.CORRUPT)


@query("snk_clustered")
def snk_clustered(spark, sf_dir):
    demo, _ = si.demographics_raw(Tables(spark, sf_dir))
    wh = _warehouse(spark)
    wh.create_if_absent("demographics", demo.schema)
    wh.append(demo, "demographics")
    return wh.read("demographics")


# Participants asked for by ``snk_participant_rows`` (keys of the table, some of them absent).
LISTED = (3, 17, 64, 65, 66, 128, 512, 700, 901, 1024, 1300, 1499, 999_999_999)


@query("snk_participant_rows")
def snk_participant_rows(spark, sf_dir):
    """Rows of listed participants from a clustered table, by its buckets, row groups and filters."""
    demo, _ = si.demographics_raw(Tables(spark, sf_dir))
    wh = _warehouse(spark)
    wh.create_if_absent("demographics", demo.schema)
    wh.append(demo, "demographics")
    return wh.rows_of("demographics", LISTED)


@query("snk_external")
def snk_external(spark, sf_dir):
    """A freeze loaded into an external sink through its connector, read back from there."""
    fz = Freeze(spark, Tables(spark, sf_dir)("orders"), "Orders")
    sink = ExternalSink(spark, CommittedFiles.name(), scratch_dir(spark, "external"))
    _loaded(load_freeze(spark, sink, archives=fz.archives))
    return sink.read("orders")


@query("log_load_audit")
def log_load_audit(spark, sf_dir):
    t = Tables(spark, sf_dir)
    orders = Freeze(spark, t("orders"), "Orders", partition_by="o_orderpriority")
    bad = Freeze(spark, t("nation").select("n_nationkey", F.concat("n_name", F.lit("\u0081")).alias("n_name")),
                 "Nation", files=1, encoding="latin-1")
    notes = Freeze(spark, t("region"), "Region", files=1, member_file="notes.txt")
    everything = orders.members + bad.members + notes.members + ["missing/Orders_20250401.csv"]
    audit = load_freeze(spark, _warehouse(spark), archives=orders.archives + bad.archives + notes.archives,
                        members=everything)
    key = F.regexp_extract("member", r"o_orderpriority=([^/]+)/", 1)
    # one row per (table, priority directory, status): members of a directory add up
    return (audit.select("table_name", F.when(key != "", key).alias("member_key"), "n_rows", "status")
            .groupBy("table_name", "member_key", "status")
            .agg(F.sum("n_rows").alias("n_rows")))


# ----------------------------------------------------- overlays / catalog search



@query("overlay_code_list_csv")
def overlay_code_list_csv(spark, sf_dir):
    """Overlay rows go through a CSV file, the overlay loader and a truncate +
    load of the overlay table, then overlay the code list."""
    from ..operators.codes import CODE_LIST_SCHEMA

    path = scratch_dir(spark, "overlay")
    si.code_list_overlay(spark).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
    wh = _warehouse(spark)
    wh.create_if_absent("_code_list_overlay", CODE_LIST_SCHEMA, cluster_by=())
    wh.overwrite(read_overlay_csv(spark, path), "_code_list_overlay")
    return overlay_code_list(si.code_list(Tables(spark, sf_dir)), wh.read("_code_list_overlay"))


@query("catalog_page_pairs")
def catalog_page_pairs(spark, sf_dir):
    """Page-name search driven by the catalog: the driver tables registered as
    external tables of a fresh database (plus a view, which is skipped)."""
    wh = _warehouse(spark)
    for name in Tables.NAMES:
        spark.sql(f"CREATE TABLE `{wh.database}`.`{name}` USING parquet "
                  f"LOCATION '{sf_dir.rstrip('/')}/{name}.parquet'")
    spark.sql(f"CREATE VIEW `{wh.database}`.`nation_v` AS SELECT * FROM `{wh.database}`.`nation`")
    return catalog.catalog_page_pairs(spark, wh.database, column=r".*_nationkey").select("pag_name", "table_name")


def _published(spark, tables, view):
    """A permanent view over tables that were loaded into a warehouse of their own."""
    mark = uuid.uuid4().hex[:12]
    wh = Warehouse(spark, f"published_{mark}")
    for name, df in tables.items():
        wh.create_if_absent(name, df.schema)
        wh.append(df, name)
    create_views(wh, f"curated_{mark}", location=f"{wh.location}-views")
    return spark.table(f"curated_{mark}.{view}")


@query("snk_published_code_list")
def snk_published_code_list(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tables = {"code_list_annotated": si.stored_code_list(t), "_code_list_overlay": si.code_list_overlay(spark)}
    return _published(spark, tables, "code_list_v")


@query("snk_published_status")
def snk_published_status(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _published(spark, {"participant_status": si.participant_status_raw(t)}, "participant_status")

"""Curated views published over a warehouse of hand-made clinical-like tables."""

import datetime as dt

from frostline.plans.catalog_views import DESCRIPTIONS as CATALOG_DESCRIPTIONS
from frostline.plans.catalog_views import create_views
from frostline.plans.publish import VIEW_DESCRIPTIONS, apply_dictionary_comments, publish_views
from frostline.sinks.warehouse import Warehouse

RACE = "raasian rablack rahawopi raindals ranos rawhite raunknown".split()


def _load(spark, wh, name, rows, schema):
    df = spark.createDataFrame(rows, schema)
    wh.create_if_absent(name, df.schema)
    wh.append(df, name)


def test_publish_views(spark, tmp_path):
    wh = Warehouse(spark, database="freeze_pub", location=str(tmp_path / "wh"))
    ts = dt.datetime(2025, 4, 1, 12, 0)
    demo_schema = ("rec_id string, patno bigint, event_id string, pag_name string, infodt string, "
                   "aficberb int, ashkjew int, basque int, birthdt string, sex int, howlive int, "
                   "handed int, hisplat int, " + ", ".join(f"{r} int" for r in RACE)
                   + ", orig_entry string, last_update timestamp_ntz")
    _load(spark, wh, "demographics", [
        ("A1", 1, "SC", "SCREEN", "04/2025", 1, 0, None, "02/1950", 1, 1, 2, 0, 1, 0, 0, 0, 0, 0, 0, "04/2025", ts),
        ("A2", 2, "SC", "SCREEN", "05/2025", 0, 1, 1, "12/1960", 0, 2, 1, 1, 1, 1, 0, 0, 0, 0, 0, "x", ts),
        ("A3", 3, "SC", "SCREEN", "05/2025", 0, 0, 0, None, None, None, None, None, 0, 0, 0, 0, 0, 0, 0, None, ts),
    ], demo_schema)
    _load(spark, wh, "socio_economics", [(1, 12.5), (1, 13.5), (2, 16.0)], "patno bigint, educyrs double")
    _load(spark, wh, "code_list_annotated", [
        ("SCREEN", "SEX", "0", "Female", None), ("SCREEN", "SEX", "1", "Male", None),
        ("SCREEN", "AFICBERB", "0", "No", None), ("SCREEN", "AFICBERB", "1", "Yes", None),
        ("SCREEN", "ASHKJEW", "0", "No", None), ("SCREEN", "ASHKJEW", "1", "Yes", None),
        ("SCREEN", "RAASIAN", "1", "asian", None), ("SCREEN", "HANDED", "1", "Right", None),
        ("SCREEN", "HANDED", "2", "Left", None), ("SCREEN", "DOMSIDE", "1", "Left", None),
        ("SCREEN", "PAG_NAME", "SCREEN", "Screening", None),
    ], "mod_name string, itm_name string, code string, decode string, mapping_notes string")
    _load(spark, wh, "participant_status", [
        (1, "PD", "PD", "04/2025", "Enrolled", "05/2025", 1, 60.0, 1, 0, 0, 0, 0, 0, "01/2025", 0,
         1, 0, 0, 0, 0, 0, 0, 0, 1),
        (2, "HC", "HC", "04/2025", "Enrolled", "05/2025", 1, 61.0, 1, 0, 0, 0, 0, 0, "01/2025", 0,
         None, None, None, 1, None, None, None, None, None),
    ], "patno bigint, cohort string, cohort_definition string, enroll_date string, enroll_status string, "
       "status_date string, screenedam4 int, enroll_age double, inexpage int, av133stdy int, "
       "taustdy int, gaitstdy int, pistdy int, sv2astdy int, datelig string, ppmi_online_enroll int, "
       "enrlpink1 int, enrlprkn int, enrlsrdc int, enrlnorm int, enrlhpsm int, enrlrbd int, "
       "enrllrrk2 int, enrlsnca int, enrlgba int")
    _load(spark, wh, "data_dictionary_annotated", [
        ("DEMOGRAPHICS", "SEX", "Sex", None), ("OTHER", "SEX", "sex", None),
        ("DEMOGRAPHICS", "PATNO", "Participant number", None), ("OTHER", "PATNO", "Subject", None),
        ("DEMOGRAPHICS", "  ", "blank", None),
    ], "mod_name string, itm_name string, dscr string, mapping_notes string")

    views = publish_views(spark, wh, lookup_output="decode")
    made = create_views(wh, "curated_pub", "decode", str(tmp_path / "views"))
    assert set(made) == {"code_list_v", "data_dictionary_v", "demographics", "participant_status",
                         "data_dict_shared_descriptions_v"}
    later = spark.newSession()  # no session view of the first one is left
    assert not [t for t in later.catalog.listTables("curated_pub") if t.isTemporary or t.tableType != "VIEW"]
    for name in made:
        kept, session = later.table(f"curated_pub.{name}"), views[name]
        assert kept.dtypes == session.dtypes, name
        assert sorted(map(str, kept.collect())) == sorted(map(str, session.collect())), name
    described = {r.col_name: r for r in later.sql("DESCRIBE EXTENDED curated_pub.demographics").collect()}
    assert described["sex"].comment == "Sex" and described["Comment"].data_type == CATALOG_DESCRIPTIONS["demographics"]
    demo = {r.rec_id: r for r in spark.table("demographics").collect()}
    assert demo["A1"].sex == "MALE"            # overlay decode wins
    assert demo["A1"].aficberb is True         # 'Yes' -> true
    assert demo["A1"].handed == "LEFT"         # overlay
    assert demo["A1"].race == "Asian"          # overlay label of RAASIAN
    assert demo["A2"].race == "Two or More Races"
    assert demo["A3"].race == "Decline to Answer"
    assert demo["A1"].educyrs == 14 and demo["A2"].educyrs == 16 and demo["A3"].educyrs is None
    assert demo["A1"].birthdt == "1950-02" and demo["A2"].orig_entry == "x"
    # a label added later shows at once, in the looked-up columns and in race
    wh.append(spark.createDataFrame([("SCREEN", "RABLACK", "1", "black", None)], wh.schema("code_list_annotated")),
              "code_list_annotated")
    assert spark.table("data_dictionary_v").count() == 5
    ps = {r.patno: r for r in spark.table("participant_status").collect()}
    assert ps[1].mutations == "GBA,PINK1" and ps[2].mutations is None and ps[1].subgroup is None
    amb = spark.table("data_dict_ambiguous_items_v").collect()
    assert {r.itm_name for r in amb} == {"PATNO"}
    assert set(VIEW_DESCRIPTIONS) <= set(views) | {"data_dict_shared_descriptions_v"}
    pages = {r.pag_name: r.n for r in spark.table("pag_name_tables_v").collect()}
    assert pages == {"SCREEN": 1}
    n = apply_dictionary_comments(spark, wh, wh.read("data_dictionary_annotated"))
    assert n == 2
    cols = {c.name: c.description for c in spark.catalog.listColumns(wh.name("demographics"))}
    assert cols["sex"] == "Sex" and cols["patno"] == "Participant number"


def test_lookup_compares_a_code_list_of_digits_as_text(spark):
    from frostline.operators.codes import CodeLookup, overlay_code_list

    codes = spark.createDataFrame([("M", "SIDE", 1, "Left"), ("M", "SIDE", 2, "Right")],
                                  "mod_name string, itm_name string, code smallint, decode string")
    facts = spark.createDataFrame([("M", "1"), ("M", "UR"), ("M", None), ("N", "2")], "pag string, side string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-lookup", "")
    lookup = CodeLookup(codes, output="decode")
    label = lookup.values([("M", "SIDE", "2")])["k0"]
    assert not tracker.getJobIdsForGroup("build-lookup")  # labels stay in the plan
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    large = CodeLookup(codes, output="decode", max_bytes=0).add(facts, "side_text", "M", "SIDE", "side")
    out = lookup.add(facts, "side_text", "M", "SIDE", "side").withColumn("two", label)
    assert sorted(map(str, large.collect())) == sorted(map(str, out.drop("two").collect()))
    assert sorted(map(str, (r.side_text for r in out.collect()))) == ["Left", "None", "None", "Right"]
    assert {r.two for r in out.collect()} == {"Right"}
    overlay = spark.createDataFrame([("M", "SIDE", "1", "LEFT", None)],
                                    "mod_name string, itm_name string, code string, decode string, mapping_notes string")
    annotated = codes.selectExpr("*", "CAST(NULL AS STRING) AS mapping_notes")
    assert {r.decode for r in overlay_code_list(annotated, overlay).collect()} == {"LEFT", "Right"}


def test_views_are_made_again_over_a_new_overlay(spark, tmp_path):
    from frostline.plans.catalog_views import overlay_tables

    wh = Warehouse(spark, database="freeze_again", location=str(tmp_path / "wh"))
    schema = "mod_name string, itm_name string, code string, decode string, mapping_notes string"
    _load(spark, wh, "code_list_annotated", [("SCREEN", "SEX", "1", "Male", None)], schema)
    assert create_views(wh, "curated_again", location=str(tmp_path / "views")) == ["code_list_v"]
    read = lambda: [tuple(r) for r in spark.table("curated_again.code_list_v").collect()]
    assert read() == [("SCREEN", "SEX", "1", "MALE", None)]  # the shipped overlay
    overlay_tables(wh, spark.createDataFrame([("SCREEN", "SEX", "1", None, "it's a note")], schema))
    assert read() == [("SCREEN", "SEX", "1", "Male", "it's a note")]  # no new view is needed


def test_permanent_diagnosis_view_looks_up_each_row_s_module(spark, tmp_path):
    wh = Warehouse(spark, database="freeze_diag", location=str(tmp_path / "wh"))
    _load(spark, wh, "code_list_annotated", [("SCREEN", "DOMSIDE", "1", "Left", None), ("OTHER", "DOMSIDE", "1", "Links", None)],
          "mod_name string, itm_name string, code string, decode string, mapping_notes string")
    _load(spark, wh, "pd_diagnosis_history", [
        ("D1", 1, "SC", "SCREEN", "04/2025", "03/2020", None, 1, 0, 1, None, 0, 1.0, "04/2025"),
        ("D2", 2, "SC", "OTHER", None, "text", "01/2021", 0, 0, 0, 0, 0, 1.0, None),
    ], "rec_id string, patno bigint, event_id string, pag_name string, infodt string, sxdt string, pddxdt string, "
       "dxbrady int, dxothsx int, dxposins int, dxrigid int, dxtremor int, domside double, orig_entry string")
    views = publish_views(spark, wh, lookup_output="decode")
    assert create_views(wh, "curated_diag", "decode", str(tmp_path / "views")) == ["code_list_v", "pd_diagnosis_history"]
    kept, session = spark.newSession().table("curated_diag.pd_diagnosis_history"), views["pd_diagnosis_history"]
    assert kept.dtypes == session.dtypes
    assert sorted(map(str, kept.collect())) == sorted(map(str, session.collect()))
    assert {r.rec_id: (r.domside, r.dx_symptoms) for r in kept.collect()} == {"D1": ("Left", "BRADY,POSINS"), "D2": ("Links", None)}

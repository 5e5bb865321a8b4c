"""Scalar-function semantics (the traps listed in the survey), on hand-made rows."""

from pathlib import PurePosixPath

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from frostline.functions import naming
from frostline.functions.scalars import (blank_to_null, flags_to_tags, mm_yyyy_to_yyyy_mm,
                                         number_text, one_hot_class, pg_substr,
                                         round_half_even_smallint, safe_boolean)


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_mm_yyyy(spark):
    got = one(spark, [("04/2025",), ("UNK",), (None,), ("4/2025",), ("04/2025\n",), ("12/1999",)],
              "x string", mm_yyyy_to_yyyy_mm("x"))
    assert got == ["2025-04", "UNK", None, "4/2025", "04/2025\n", "1999-12"]


def test_mm_yyyy_bad_month(spark):
    df = spark.createDataFrame([("13/2020",)], "x string")
    assert df.select(mm_yyyy_to_yyyy_mm("x", "null")).first()[0] is None
    assert df.select(mm_yyyy_to_yyyy_mm("x", "pass")).first()[0] == "13/2020"
    with pytest.raises(Exception):
        df.select(mm_yyyy_to_yyyy_mm("x")).collect()


def test_safe_boolean_vocabulary(spark):
    words = ["t", "TR", "tru", "True", "y", "ye", "yes", "on", "1", " yes ",
             "f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0",
             "o", "", "2", "maybe", None]
    got = one(spark, [(w,) for w in words], "x string", safe_boolean("x"))
    assert got == [True] * 10 + [False] * 10 + [None] * 5


def test_flags_to_tags(spark):
    rows = [(1, 0, 1), (0, 0, 0), (None, 1, 2), (None, None, None)]
    got = one(spark, rows, "a int, b int, c int", flags_to_tags({"ZED": "a", "ALPHA": "b", "MID": "c"}))
    assert got == ["MID,ZED", None, "ALPHA", None]


def test_one_hot_class(spark):
    rows = [(0, 0, 0), (1, 1, 0), (0, 1, 0), (1, None, 0), (None, 0, 0), (2, 0, 0)]
    expr = one_hot_class([(F.col("a"), F.lit("A")), (F.col("b"), F.lit("B")), (F.col("c"), F.lit("C"))],
                         "none", "many")
    got = one(spark, rows, "a int, b int, c int", expr)
    # NULL makes the sum NULL: first flag equal to 1 decides, else NULL; a 2 counts as many
    assert got == ["none", "many", "B", "A", None, "many"]


def test_substr_from_zero_keeps_49(spark):
    got = one(spark, [("x" * 100,), ("abc",), (None,)], "s string", pg_substr("s", 0, 50))
    assert [None if g is None else len(g) for g in got] == [49, 3, None]


def test_casts(spark):
    rows = [(0.5,), (1.5,), (2.5,), (-2.5,), (1.0,), (3.25,)]
    got = spark.createDataFrame(rows, "x double").select(
        round_half_even_smallint("x"), number_text("x")).collect()
    assert [r[0] for r in got] == [0, 2, 2, -2, 1, 3]
    assert [r[1] for r in got] == ["0.5", "1.5", "2.5", "-2.5", "1", "3.25"]


def test_smallint_overflow_fails(spark):
    df = spark.createDataFrame([(40000.0,)], "x double")
    with pytest.raises(PySparkException):
        df.select(round_half_even_smallint("x")).collect()


def test_blank_to_null(spark):
    got = one(spark, [(" ",), ("\t\n",), ("",), (" a ",), (None,)], "x string", blank_to_null("x"))
    assert got == [None, None, None, " a ", None]


def test_clean_name_twin_and_column(spark):
    names = ["PATNO", "A-B", "A B", "__x__", "Ärzte", "a--b__c", "!!!"]
    got = one(spark, [(n,) for n in names], "x string", naming.clean_sql_name("x"))
    assert got == ["patno", "a_b", "a_b", "x", "rzte", "a_b_c", None]
    assert naming.clean_sql_name_text("A-B") == "a_b"
    with pytest.raises(ValueError):
        naming.clean_sql_name_text("!!!")


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB_-. 9é/", min_size=1, max_size=12))
def test_clean_name_idempotent(name):
    try:
        once = naming.clean_sql_name_text(name)
    except ValueError:
        return
    assert naming.clean_sql_name_text(once) == once


def test_table_name_matches_pathlib(spark):
    paths = ["data/Vital_Signs_20250401.csv", "x/Name Clash.csv", "a.b.", ".hidden", "a..b.csv",
             "dir/Primary_Clinical_Diagnosis_20250401.csv", "arch.tar.gz", "p/q/", "Demo_2025.csv"]
    got = one(spark, [(p,) for p in paths], "p string", naming.table_name_from_path("p"))
    for p, g in zip(paths, got):
        import re

        stem = PurePosixPath(p).stem
        cleaned = re.sub("_+", "_", re.sub("[^a-z0-9_]+", "_", stem.lower())).strip("_")
        want = re.sub(r"_\d{8}$", "", cleaned) or None
        assert g == want, p
        if want:
            assert naming.table_name_from_path_text(p) == want


def test_dscr_to_table_name(spark):
    got = one(spark, [("Vital Signs (Primary)",), ("A-B  C",), (None,)], "x string",
              naming.dscr_to_table_name("x"))
    assert got == ["vital_signs_primary", "a_b__c", None]

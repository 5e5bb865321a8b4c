"""Overlays, lookups, metadata views, ordering, profiling and checks."""

import pytest
from pyspark.sql import functions as F

from frostline.operators import checks, inventory as inv
from frostline.operators.codes import CodeLookup, overlay_code_list, overlay_dictionary
from frostline.operators.ordering import pg_sort_keys, with_sort_position
from frostline.operators.profile import merge_profiles, profile, sql_names

CL = "mod_name string, itm_name string, code string, decode string, mapping_notes string"


def test_overlay_code_list(spark):
    base = spark.createDataFrame([("M", "I", "1", "One", None), ("M", "I", "2", "Two", "n"),
                                  ("M", "J", "1", "Uno", None)], CL)
    ov = spark.createDataFrame([("M", "I", "1", "ONE!", None), ("M", "I", "2", None, "fixed"),
                                ("M", "I", "9", "only overlay", None)], CL)
    got = sorted(tuple(r) for r in overlay_code_list(base, ov).collect())
    assert got == [("M", "I", "1", "ONE!", None), ("M", "I", "2", "Two", "fixed"),
                   ("M", "J", "1", "Uno", None)]


def test_overlay_duplicates_multiply(spark):
    base = spark.createDataFrame([("M", "I", "1", "One", None)], CL)
    ov = spark.createDataFrame([("M", "I", "1", "A", None), ("M", "I", "1", "B", None)], CL)
    assert sorted(r.decode for r in overlay_code_list(base, ov).collect()) == ["A", "B"]


def test_overlay_dictionary_null_keys_do_not_match(spark):
    dd = spark.createDataFrame([("M", None, "d", None), ("M", "I", "d2", None)],
                               "mod_name string, itm_name string, dscr string, mapping_notes string")
    ov = spark.createDataFrame([("M", None, "x", None), ("M", "I", "over", "n")],
                               "mod_name string, itm_name string, dscr string, mapping_notes string")
    got = sorted((r.itm_name or "", r.dscr) for r in overlay_dictionary(dd, ov).collect())
    assert got == [("", "d"), ("I", "over")]


def test_code_lookup_code_and_decode(spark):
    cl = spark.createDataFrame([("M", "SEX", "0", "F", None), ("M", "SEX", "1", "M", None),
                                ("M", "SEX", "1", "Male", None), ("N", "SEX", "2", "X", None)], CL)
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "sex int")
    code = CodeLookup(cl).add(df, "v", "M", "SEX", "sex")
    dec = CodeLookup(cl, output="decode").add(df, "v", "M", "SEX", "sex")
    assert sorted((r.sex, r.v) for r in code.collect() if r.sex is not None) == [(0, "0"), (1, "1"), (2, None)]
    assert sorted((r.sex, r.v) for r in dec.collect() if r.sex is not None) == [(0, "F"), (1, "M"), (2, None)]
    assert [r.v for r in code.collect() if r.sex is None] == [None]


def test_dynamic_module_lookup(spark):
    cl = spark.createDataFrame([("A", "DOMSIDE", "1", "left", None), ("B", "DOMSIDE", "1", "right", None)], CL)
    df = spark.createDataFrame([("A", 1), ("B", 1), ("C", 1), (None, 1)], "pag_name string, d int")
    got = CodeLookup(cl, output="decode").add(df, "v", F.col("pag_name"), "DOMSIDE", "d")
    assert sorted((r.pag_name or "", r.v) for r in got.collect()) == [("", None), ("A", "left"), ("B", "right"), ("C", None)]


def test_code_list_summary_orders_codes_as_text(spark):
    cl = spark.createDataFrame([("M", "I", "2", "Two", None), ("M", "I", "10", "Ten", None),
                                ("M", "PAG_NAME", "x", "y", None), ("N", "I", "2", "Two", None),
                                ("N", "I", "10", "TEN", None)], CL)
    s = {(r.itm_name, r.mod_name): r.code_mapping for r in inv.code_list_summary(cl).collect()}
    assert s == {("I", "M"): "10=ten,2=two", ("I", "N"): "10=ten,2=two"}
    shared = inv.code_list_shared(cl).collect()
    assert [(r.itm_name, r.n_mod_names, r.mod_names) for r in shared] == [("I", 2, "M, N")]
    assert inv.code_list_variable(cl).count() == 0


def test_ambiguous_items(spark):
    dd = spark.createDataFrame([("M1", "AGE", "Age in years"), ("M2", "AGE", "age IN YEARS"),
                                ("M3", "AGE", "Age at visit " + "x" * 80), ("M1", "SEX", "Sex"),
                                ("M1", " ", "blank item"), ("M1", None, "null item")],
                               "mod_name string, itm_name string, dscr string")
    shared = {(r.itm_name, r.dscr): (r.n_mod_names, r.mod_names)
              for r in inv.shared_descriptions(dd).collect()}
    assert shared[("AGE", "age in years")] == (2, "M1, M2")
    assert all(k[0] in ("AGE", "SEX") for k in shared)
    amb = inv.ambiguous_items(dd).collect()
    assert {r.itm_name for r in amb} == {"AGE"}
    assert max(len(r["dscr (truncated)"]) for r in amb) == 49


def test_rows_of_one_item_are_dealt_to_many_tasks(spark):
    rows = [(f"M{i % 3}", "HOT", f"description {i} " + "y" * (i % 50)) for i in range(600)]
    rows += [("M1", "ONE", "same"), ("M2", "ONE", "SAME"), ("M1", "NULL", None), ("M2", "NULL", "x"), ("M1", None, "a"), ("M2", None, "b")]
    dd = spark.createDataFrame(rows, "mod_name string, itm_name string, dscr string")
    codes = spark.createDataFrame([("HOT", m, str(i), "z" * (i % 40)) for i, (m, _, _) in enumerate(rows[:600])]
                                  + [("HOT", f"N{i}", "1", "v" * i) for i in range(300)] + [("ONE", "M1", "1", "a"), ("ONE", "M2", "1", "a")],
                                  "itm_name string, mod_name string, code string, decode string")
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        amb = inv.ambiguous_items(dd).withColumn("task", F.spark_partition_id()).collect()
        var = inv.code_list_variable(codes).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.itm_name, r["dscr (truncated)"] or "", r.n_mod_names, r.mod_names) for r in amb) == sorted(
        [("HOT", d.lower()[:49], 1, m) for m, _, d in rows[:600]] + [("NULL", "", 1, "M1"), ("NULL", "x", 1, "M2")])
    assert {r.itm_name for r in var} == {"HOT"} and len(var) == 303
    assert len({r.task for r in amb if r.itm_name == "HOT"}) > 8 and len({r.task for r in var}) > 8


def test_page_name_pairs(spark):
    t1 = spark.createDataFrame([(1, "P1"), (2, "P1"), (3, "P2")], "patno int, pag_name string")
    t2 = spark.createDataFrame([(1, "P2")], "patno int, pag_name string")
    dd = spark.createDataFrame([(1, "P9")], "x int, pag_name string")
    pairs = inv.page_name_pairs(spark, {"t1": t1, "t2": t2, "data_dictionary_annotated": dd})
    assert sorted(tuple(r) for r in pairs.collect()) == [("t1", "P1"), ("t1", "P2"), ("t2", "P2")]
    pt = {r.pag_name: (r.n, r.table_names) for r in inv.page_tables(pairs).collect()}
    assert pt == {"P1": (1, "t1"), "P2": (2, "t1, t2")}
    empty = inv.page_name_pairs(spark, {"x": spark.createDataFrame([(1,)], "a int")})
    assert empty.count() == 0 and empty.columns == ["table_name", "pag_name"]


def test_sort_position_nulls(spark):
    rows = [(1, "b", 1.0), (2, None, 2.0), (3, "a", None), (4, "a", 5.0), (5, "b", None)]
    df = spark.createDataFrame(rows, "id int, k string, v double").repartition(3)
    got = with_sort_position(df, pg_sort_keys([("k", "asc"), ("v", "desc"), ("id", "asc")]), "pos")
    order = [r.id for r in got.orderBy("pos").collect()]
    assert order == [3, 4, 5, 1, 2]
    assert sorted(r.pos for r in got.collect()) == [1, 2, 3, 4, 5]


def test_profile_narrowing_bounds(spark):
    rows = [("32767", "-32768", "1.5", "TRUE", None, "x", "2147483648", "1"),
            ("0", "-32769", "2", "false", None, "", "0", "2.")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, "
                                     "g string, h string")
    prof = {r.csv_name: r for r in profile(df, "t").collect()}
    assert prof["a"].sql_type == "SMALLINT NOT NULL"
    assert prof["b"].sql_type == "INTEGER NOT NULL"
    assert prof["c"].sql_type == "DOUBLE PRECISION NOT NULL" and prof["c"].base_type == "Float64"
    assert prof["d"].sql_type == "BOOLEAN NOT NULL"
    assert prof["e"].sql_type == "TEXT NULL" and prof["e"].n_nulls == 2
    assert prof["f"].sql_type == "TEXT NOT NULL"
    assert prof["g"].sql_type == "BIGINT NOT NULL"
    assert prof["h"].base_type == "Float64"
    assert [r.ordinal for r in profile(df, "t").collect()] == list(range(1, 9))


def test_profile_header_only_is_not_null(spark):
    df = spark.createDataFrame([], "a string, b string")
    prof = profile(df, "t").collect()
    assert [(r.base_type, r.sql_type) for r in prof] == [("String", "TEXT NOT NULL")] * 2


def test_name_clash_is_an_error():
    with pytest.raises(ValueError, match="A-B"):
        sql_names(["A-B", "A B"])


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "k int, v string")
    pk = sorted((r.k, r.n) for r in checks.primary_key_violations(df, "k").collect()
                if r.k is not None)
    assert pk == [(1, 2)]
    assert checks.primary_key_violations(df, "k").filter("k is null").count() == 1
    nn = {r.column_name: r.n_violations for r in checks.not_null_violations(df, ["k", "v"]).collect()}
    assert nn == {"k": 1, "v": 1}
    with pytest.raises(ValueError):
        checks.primary_key_violations(df, "nope")
    hdr = spark.createDataFrame([(" " + "a" * 1024 + " \r\nrow",), ("a,b\nx",)], "t string")
    n, cut = checks.truncated_header(F.col("t"))
    assert [(r[0], r[1]) for r in hdr.select(n, cut).collect()] == [(1024, True), (3, False)]


def test_page_name_pairs_same_name_twice(spark):
    t = spark.createDataFrame([(1, "P1")], "patno int, pag_name string")
    pairs = inv.page_name_pairs(spark, [("visits", t), ("visits", t)])
    assert [tuple(r) for r in pairs.collect()] == [("visits", "P1"), ("visits", "P1")]


def test_profile_wide_table_in_passes(spark):
    cols = [f"c{i}" for i in range(7)]
    rows = [tuple(str(i * j) for j in range(7)) for i in range(5)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    one = [tuple(r) for r in profile(df, "w").collect()]
    split = [tuple(r) for r in profile(df, "w", columns_per_pass=3).collect()]
    assert sorted(one) == sorted(split) and len(split) == 7
    assert sorted(r[1] for r in split) == list(range(1, 8))


def test_profile_integers_beyond_64_bits(spark):
    rows = [("9" * 20, "1", "9" * 20, "9" * 39), ("-" + "8" * 19, "9" * 38, "0.5", "1"), (None, "2", "1", "1")]
    prof = {r.csv_name: r for r in profile(spark.createDataFrame(rows, "a string, b string, c string, d string"), "t").collect()}
    assert (prof["a"].sql_type, prof["a"].spark_type, prof["a"].min_value, prof["a"].max_value) == (
        "NUMERIC(38, 0) NULL", "decimal(38,0)", "-" + "8" * 19, "9" * 20)
    assert prof["b"].max_value == "9" * 38 and prof["b"].min_value == "1"
    assert (prof["c"].sql_type, prof["d"].sql_type) == ("DOUBLE PRECISION NOT NULL", "TEXT NOT NULL")


def test_merged_profiles_equal_the_profile_of_all_rows(spark):
    names = "a string, b string, c string, d string, e string, f string"
    one = [("1", "1.5", "true", None, "x", "7"), ("70000", None, "False", None, "2", "8")]
    two = [("9" * 20, "3", "no", None, None, "-9"), ("2", "4", "true", "5", None, "9")]
    part = lambda rows: spark.createDataFrame(rows, names)
    want = [tuple(r) for r in profile(part(one + two), "t").orderBy("ordinal").collect()]
    for a, b in ((one, two), (two, one)):
        got = merge_profiles(profile(part(a), "t"), profile(part(b), "t")).orderBy("ordinal").collect()
        assert [tuple(r) for r in got] == want
    fewer = merge_profiles(profile(part(one).select("a"), "t"), profile(part(two).select("a", "f"), "t")).collect()
    assert {r.sql_name: (r.n_rows, r.n_nulls, r.sql_type) for r in fewer} == {
        "a": (4, 0, "NUMERIC(38, 0) NOT NULL"), "f": (4, 2, "SMALLINT NULL")}


def test_observed_profile_equals_the_profile(spark, tmp_path):
    """Metrics taken while rows are written give what a scan of its own gives."""
    from frostline.operators.profile import ObservedProfile, profile

    rows = [("1", "2.5", "true", "12345678901234567890", None, "x,y"), ("-7", "3", "False", "5", None, ""),
            (None, "NaN", None, None, None, "z")]
    df = spark.createDataFrame(rows * 20, "A string, `B C` string, d string, wide string, none string, t string").repartition(3)
    for data in (df, df.limit(0)):
        want = list(map(tuple, profile(data, "t").orderBy("ordinal").collect()))
        for per_pass in (100, 4):
            seen = ObservedProfile(data, data.columns, columns_per_pass=per_pass, xs=F.count_if(F.col("t") == "z"))
            seen.rows.write.mode("overwrite").parquet(str(tmp_path / "raw"))
            assert list(map(tuple, seen.profile("t").orderBy("ordinal").collect())) == want
            assert seen.extra == {"n_rows": data.count(), "xs": data.where("t = 'z'").count()}

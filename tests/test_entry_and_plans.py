"""Driver contract, oracle agreement on the smallest tables, and plan shape."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from scripts.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"

FAST = ["view_participant_status", "fn_mm_yyyy", "fn_flags_to_tags", "fn_one_hot_class",
        "lookup_dynamic_module", "corr_scalar_max", "fn_table_name", "fn_casts", "sort_nulls",
        "shared_descriptions", "ambiguous_items", "code_list_variable", "mod_item_summary",
        "page_tables", "prf_profile", "chk_not_null", "src_file_patch", "blanks_to_null"]


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["rec_id", "patno", "infodt", "aficberb", "ashkjew", "basque", "birthdt",
                          "sex", "gender", "handed", "ethnicity", "race", "orig_entry",
                          "last_update", "educyrs"]


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_matches_duckdb(spark, duck, name):
    sdf = entry_mod.queries()[name](spark, SF)
    res = duck.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    srows = [tuple(r) for r in sdf.collect()]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_views_have_no_python_udf_and_broadcast_lookups(spark):
    q = entry_mod.queries()
    for name in ("view_demographics", "view_diagnosis_history", "view_participant_status",
                 "code_list_summary", "prf_profile"):
        plan = _plan(q[name](spark, SF))
        assert "PythonUDF" not in plan and "EvalPython" not in plan, name
    assert "BroadcastHashJoin" in _plan(q["view_demographics"](spark, SF))


def test_filters_and_columns_reach_the_scan(spark):
    df = entry_mod.queries()["filter_not_in"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_orderpriority" in plan
    assert "o_totalprice" not in plan  # pruned: only two columns are read


def test_clustered_tables_join_without_shuffle(spark, tmp_path):
    """Tables bucketed on patno (the clustering the loader declares) let the
    per-participant aggregate and its join run without any shuffle."""
    from frostline.plans import curated
    from frostline.plans import standins as si
    from frostline.sinks.warehouse import Warehouse

    t = si.Tables(spark, SF)
    demo, socio = si.demographics_raw(t)
    wh = Warehouse(spark, "freeze_cluster_plan", location=str(tmp_path / "wh"))
    for name, df in (("demographics", demo), ("socio_economics", socio)):
        wh.create_if_absent(name, df.schema)
        wh.append(df, name)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the join a big table would get
    try:
        view = curated.demographics(wh.read("demographics"), wh.read("socio_economics"),
                                   si.code_list_view(t), lookups=si.STANDIN_DEMOGRAPHICS_LOOKUPS,
                                   race_flags=si.STANDIN_RACE_FLAGS)
        plan = view._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "hashpartitioning(patno" not in plan and "hashpartitioning(__se_patno" not in plan
        assert view.count() == demo.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_participant_is_split_by_skew_join(spark):
    """One patno holding a third of the rows: the per-participant join is a
    sort-merge join that AQE splits (skew join), and the result stays whole."""
    from pyspark.sql import functions as F

    from frostline.functions.scalars import round_half_even_smallint

    n = 30000
    demo = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("patno"),
        F.col("id").alias("rec"))
    socio = spark.range(n).select(F.col("id").alias("patno"), (F.col("id") / 4).alias("educyrs"))
    educ = (socio.groupBy("patno").agg(F.max(round_half_even_smallint("educyrs")).alias("educyrs"))
            .withColumnRenamed("patno", "se_patno"))
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        joined = demo.join(educ, demo["patno"] == educ["se_patno"], "left")
        assert len(joined.collect()) == n          # runs this plan; AQE finalises it
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["view_demographics", "view_diagnosis_history", "view_participant_status"])
def test_generated_methods_are_small_enough_to_be_compiled(spark, name):
    """The JVM compiles methods of at most 8000 bytes; lookups add no job while a view is built."""
    from frostline.operators.codes import CodeLookup
    from frostline.plans import standins as si

    df = entry_mod.queries()[name](spark, SF)
    df.collect()
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    assert stages.size() and all(stages.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(stages.size()))
    t = si.Tables(spark, SF)
    view, facts = si.code_list_view(t), si.diagnosis_history_raw(t)
    spark.sparkContext.setJobGroup(f"build-{name}", "")
    lookup = CodeLookup(view)
    lookup.add(facts, "side", "Brand#11", "SIZE", "domside")
    assert lookup.small and not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

"""Property tests: narrowing always holds the data; loads keep every row."""

import zipfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from frostline.operators.profile import profile
from frostline.plans.load import load_freeze
from frostline.sinks.warehouse import Warehouse, write_format

ints = st.lists(st.one_of(st.none(), st.integers(-(2 ** 63), 2 ** 63 - 1)), min_size=1, max_size=20)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=ints)
def test_narrowed_type_holds_min_and_max(spark, values):
    df = spark.createDataFrame([(None if v is None else str(v),) for v in values], "x string")
    p = profile(df, "t").first()
    present = [v for v in values if v is not None]
    if not present:
        assert p.sql_type == "TEXT NULL"
        return
    assert p.base_type == "Int64"
    back = df.selectExpr(f"cast(x as {p.spark_type}) as y").collect()   # ANSI: fails if it does not fit
    assert sorted(r.y for r in back if r.y is not None) == sorted(present)
    assert p.is_nullable == (None in values)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(0, 30), min_size=1, max_size=4))
def test_members_add_up(spark, tmp_path_factory, sizes):
    tmp = tmp_path_factory.mktemp("members")
    archive = str(tmp / "f.zip")
    with zipfile.ZipFile(archive, "w") as zf:
        for i, n in enumerate(sizes):
            rows = "".join(f"{i * 100 + j},v{j}\n" for j in range(n))
            zf.writestr(f"part{i}/Items_20250401.csv", "ID,VAL\n" + rows)
    wh = Warehouse(spark, database=f"freeze_prop_{tmp.name}".replace("-", "_"), location=str(tmp / "wh"))
    audit = load_freeze(spark, wh, archives=[archive], stage=str(tmp / "stage")).collect()
    assert all(r.status == "loaded" for r in audit)
    assert sum(r.n_rows for r in audit) == sum(sizes) == wh.read("items").count()


def test_external_format_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    target = str(tmp_path / "out")
    write_format(df, "json", target, mode="overwrite")
    assert sorted(tuple(r) for r in spark.read.json(target).select("id", "v").collect()) == [(1, "a"), (2, None)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)),
                               st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
                     min_size=1, max_size=40))
def test_sort_positions_match_database_order(spark, rows):
    from frostline.operators.ordering import pg_sort_keys, with_sort_position

    data = [(i, a, b) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, a int, b string").repartition(3)
    got = with_sort_position(df, pg_sort_keys([("a", "asc"), ("b", "desc"), ("id", "asc")]), "pos")
    by_pos = [r.id for r in got.orderBy("pos").collect()]

    def key(r):  # ascending: NULLs last; descending: NULLs first
        _, a, b = r
        return ((a is None, a if a is not None else 0),
                (b is not None, "".join(chr(255 - ord(ch)) for ch in (b or ""))), r[0])

    assert by_pos == [r[0] for r in sorted(data, key=key)]
    assert sorted(r.pos for r in got.collect()) == list(range(1, len(data) + 1))

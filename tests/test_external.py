"""External sinks, lookups by the clustering key, one scan for many tables."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from frostline.__main__ import main
from frostline.sinks.external import CommittedFiles, ExternalSink, write_format
from frostline.sinks.warehouse import Warehouse
from frostline.sources.catalog import catalog_page_pairs


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_load_through_a_connector_and_again(spark, tmp_path, capsys):
    archive, out = str(tmp_path / "f.zip"), str(tmp_path / "out")
    with zipfile.ZipFile(archive, "w") as zf:
        zf.writestr("one/T_20250401.csv", b"PATNO,V,D\n1,x,2.5\n2,,\n")
        zf.writestr("two/T_20250401.csv", b"PATNO,V,D\n70000,y,1\n")
    assert main(["load", "-z", archive, "--to", out, "one/T_20250401.csv"]) == 0
    assert main(["load", "-z", archive, "--to", out, "one/T_20250401.csv"]) == 0
    sink = ExternalSink(spark, CommittedFiles.name(), out)
    assert sink.read("t").schema.simpleString() == "struct<patno:smallint,v:string,d:double>"
    assert _rows(sink.read("t").where("patno = 1")) == [(1, "x", 2.5)] * 2 and sink.read("t").count() == 4
    capsys.readouterr()
    assert main(["load", "-z", archive, "--to", out, "two/T_20250401.csv"]) == 1  # beyond the types that are there
    assert "do not fit" in capsys.readouterr().out and sink.read("t").count() == 4


def test_failed_load_leaves_nothing_behind(spark, tmp_path):
    folder = str(tmp_path / "t")
    sink = ExternalSink(spark, CommittedFiles.name(), str(tmp_path))
    write_format(spark.range(0, 100, numPartitions=4), sink.fmt, folder)
    before = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    assert len(before) == 4 and _rows(sink.read("t")) == [(i,) for i in range(100)]
    late = F.when(F.col("id") == 20_099, F.raise_error(F.lit("no such row"))).otherwise(F.col("id")).cast("long")
    with pytest.raises(Exception, match="no such row"):
        write_format(spark.range(100, 20_100, numPartitions=4).select(late.alias("id")), sink.fmt, folder)
    assert sorted(f for f in os.listdir(folder) if f.endswith(".parquet")) == before and sink.read("t").count() == 100
    with pytest.raises(Exception, match="other columns"):
        write_format(spark.range(3).select(F.col("id").cast("string")), sink.fmt, folder)
    write_format(spark.range(0), sink.fmt, folder)  # no rows, no file
    assert sink.read("t").count() == 100
    write_format(spark.range(7, 9).select(F.col("id").cast("string").alias("name")), sink.fmt, folder, mode="overwrite")
    assert sorted(r.name for r in sink.read("t").collect()) == ["7", "8"] and not sink.exists("absent")


def test_listed_participants_are_read_by_row_group(spark, tmp_path):
    """Of the row groups only those that may hold a listed key are read."""
    wh = Warehouse(spark, "freeze_lookup", location=str(tmp_path / "wh"), buckets=2, row_group_bytes=256 << 10)
    rows = spark.range(400_000).select((F.col("id") * 3).alias("patno"), F.sha1(F.col("id").cast("string")).alias("v"))
    wh.create_if_absent("t", rows.schema)
    wh.append(rows, "t")
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    groups, filters = 0, 0
    for file in (tmp_path / "wh" / "t").glob("*.parquet"):
        source = spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path(str(file)), conf)
        reader = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        blocks = reader.getFooter().getBlocks()
        groups += blocks.size()
        filters += sum(b.getColumns().get(0).getBloomFilterOffset() > 0 for b in blocks)
        reader.close()
    assert groups >= 20 and filters == groups

    def read(values):
        df = wh.rows_of("t", values)
        got = _rows(df.select("patno"))
        df = wh.rows_of("t", values)
        df.collect()
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return [p for p, in got], scan.metrics().apply("numOutputRows").value()

    wanted = [3, 3_000, 3_003, 299_997, 299_994, 600_000, 600_003, 900_000, 900_003, 1_199_997, 0, 30, None, 4, 2**70]
    got, scanned = read(wanted)
    assert got == sorted(v for v in wanted if v is not None and v % 3 == 0 and v < 1_200_000) and scanned < 400_000 // 2
    assert read([601_000]) == ([], 0)  # within the range of a group, but its filter has no such key
    assert read([]) == ([], 0)


def test_one_scan_for_all_tables_of_a_layout(spark, tmp_path):
    """The plan does not grow with the tables; other layouts, formats and empty tables are read, too."""
    def database(name, tables):
        wh = Warehouse(spark, name, location=str(tmp_path / name))
        for i in range(tables):
            df = spark.createDataFrame([(i, f"P{i % 3}"), (i, "all"), (i, None)], "a int, pag_name string")
            folder = str(tmp_path / f"{name} +%files" / f"t{i}")
            df.coalesce(1).write.parquet(folder)
            spark.sql(f"CREATE TABLE {wh.name(f't{i}')} (a int, pag_name string) USING parquet LOCATION '{folder}'")
        return wh

    few, many = database("pages_few", 2), database("pages_many", 24)
    size = lambda wh: catalog_page_pairs(spark, wh.database)._jdf.queryExecution().optimizedPlan().treeString().count("\n")
    assert size(few) == size(many)
    spark.sql(f"CREATE TABLE {many.name('csv_one')} (pag_name string) USING csv")
    spark.sql(f"INSERT INTO {many.name('csv_one')} VALUES ('P9')")
    spark.sql(f"CREATE TABLE {many.name('numbered')} (pag_name int) USING parquet")
    spark.sql(f"INSERT INTO {many.name('numbered')} VALUES (5), (5)")
    many.create_if_absent("empty", spark.table(many.name("t0")).schema)
    many.create_if_absent("data_dictionary_annotated", spark.table(many.name("t0")).schema)
    spark.sql(f"CREATE VIEW {many.name('seen')} AS SELECT * FROM {many.name('t0')}")
    want = {(f"t{i}", p) for i in range(24) for p in (f"P{i % 3}", "all", None)} | {("csv_one", "P9"), ("numbered", "5")}
    got = [tuple(r) for r in catalog_page_pairs(spark, many.database).select("table_name", "pag_name").collect()]
    assert len(got) == len(want) and set(got) == want
    assert catalog_page_pairs(spark, many.database, column="absent").count() == 0

"""Decoding, repair, CSV rules and an end-to-end load of a synthetic freeze."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from frostline.plans.load import LoadOptions, load_freeze
from frostline.sinks.warehouse import Warehouse, export_csv
from frostline.sources import csv as csvsrc
from frostline.sources.text import (C1_UNDEFINED, cp1252_decode, cp1252_encode, cp1252_undefined,
                                    repair, strip_whitespace)


def test_cp1252_all_bytes(spark):
    data = bytes(range(256))
    df = spark.createDataFrame([(bytearray(data),)], "b binary")
    text, bad = df.select(cp1252_decode("b"), cp1252_undefined("b")).first()
    assert bad is True
    want = data.decode("cp1252", errors="ignore")
    assert text.translate({ord(c): None for c in C1_UNDEFINED}) == want
    ignore = df.select(cp1252_decode("b", "ignore")).first()[0]
    assert ignore == want
    ok = spark.createDataFrame([(bytearray("é – “x”".encode("cp1252")),)], "b binary")
    assert ok.select(cp1252_undefined("b")).first()[0] is False


def test_cp1252_round_trip(spark):
    s = "Müller – “quoted” €5 œ"
    df = spark.createDataFrame([(s,)], "t string")
    enc = df.select(cp1252_encode("t").alias("b"))
    assert bytes(enc.first()[0]) == s.encode("cp1252")
    assert enc.select(cp1252_decode("b")).first()[0] == s


def test_repair_and_patch(spark):
    raw = '\ufeff \r\n"R1","no tremors today. \\\\",,"3",\r\n"x \\"y\\""\rz\n '
    df = spark.createDataFrame([(raw, "a/Primary_Clinical_Diagnosis_20250401.csv"),
                                (raw, "a/Other_20250401.csv")], "t string, m string")
    got = [r[0] for r in df.select(repair(F.col("t"), F.col("m"))).collect()]
    py = raw.replace("\r\n", "\n").replace("\r", "\n").replace('\\"', '""').strip()
    assert got[1] == py
    assert got[0] == py.replace('no tremors today. \\"",,"3",', 'no tremors today.",,"3",')
    assert '"R1","no tremors today.",,"3",' in got[0]
    assert df.select(strip_whitespace(F.lit("  a 　"))).first()[0] == "a"


def test_csv_null_versus_empty(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text('a,b,c\n1,,""\n2,"x\r\ny",z\n')
    rows = csvsrc.read_text_csv(spark, str(p)).drop(csvsrc.CORRUPT).orderBy("a").collect()
    # unquoted empty -> NULL, "" -> '', a quoted line break is kept as written
    assert [tuple(r) for r in rows] == [("1", None, ""), ("2", "x\r\ny", "z")]


def test_export_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, None, ""), (2, 'q "x"', "multi\nline")], "ID int, `A-B` string, c string")
    out = str(tmp_path / "exp")
    export_csv(df, out)
    back = csvsrc.read_text_csv(spark, out + "/*.csv").drop(csvsrc.CORRUPT)
    assert back.columns == ["id", "a_b", "c"]
    assert sorted(tuple(r) for r in back.collect()) == [("1", None, ""), ("2", 'q "x"', "multi\nline")]


def _freeze(path):
    header = ",".join(f"column_{i:04d}" for i in range(1, 200))
    header = header[:1024].rstrip(",")
    header = header + "x" * (1024 - len(header))
    assert len(header) == 1024
    members = {
        "FREEZE/Vital_Signs_20250401.csv":
            'REC_ID,PATNO,INFODT,WGTKG,NOTE\r\n"R1",1001,04/2025,70.5,"He said \x93fine\x94 \x96 ok"\r\n'
            '"R2",1002,05/2025,,"line one\r\nline two"\r\n"R3",1003,06/2025,80,""\r\n'.encode("latin-1"),
        "FREEZE/Primary_Clinical_Diagnosis_20250401.csv":
            b'REC_ID,COMMENT,X,Y,Z\n"R1","no tremors today. \\\\",,"3",\n',
        "FREEZE/Quoted.csv": b'A,B,C\n"say \\"hi\\"","x ""y""",\n"",z,""\n',
        "FREEZE/Header_Only.csv": b"A,B\n",
        "FREEZE/Bad_Byte.csv": b"A\n\x81\n",
        "FREEZE/Cut_Header.csv": (header + "\n" + ",".join(["1"] * 300) + "\n").encode(),
        "FREEZE/Name Clash.csv": b"A-B,A B\n1,2\n",
        "FREEZE/notes.txt": b"not a table\n",
    }
    # a zip archive named .gz: recognised by content
    with zipfile.ZipFile(path, "w") as zf:
        for name, data in members.items():
            zf.writestr(name, data)
    return list(members)


def test_end_to_end_freeze(spark, tmp_path):
    archive = str(tmp_path / "FREEZE_20250401.gz")
    names = _freeze(archive)
    wh = Warehouse(spark, database="freeze_e2e", location=str(tmp_path / "wh"))
    audit = load_freeze(spark, wh, archives=[archive], members=names + ["FREEZE/missing.csv"],
                        options=LoadOptions(workers=2),
                        stage=str(tmp_path / "stage"))
    got = {r.member.split("/")[-1]: r for r in audit.collect()}
    assert got["missing.csv"].status == "not_found"
    assert got["notes.txt"].status == "skipped"
    assert got["Bad_Byte.csv"].status == "error" and "undefined" in got["Bad_Byte.csv"].error
    assert got["Name Clash.csv"].status == "error" and "A B" in got["Name Clash.csv"].error
    assert got["Cut_Header.csv"].status == "error"
    assert "truncated" in got["Cut_Header.csv"].error
    for ok in ("Vital_Signs_20250401.csv", "Primary_Clinical_Diagnosis_20250401.csv",
               "Quoted.csv", "Header_Only.csv"):
        assert got[ok].status == "loaded", (ok, got[ok].error)
    assert got["Vital_Signs_20250401.csv"].table_name == "vital_signs"
    assert got["Vital_Signs_20250401.csv"].n_rows == 3

    vs = {r.rec_id: r for r in wh.read("vital_signs").collect()}
    assert vs["R1"].note == "He said “fine” – ok"
    assert vs["R2"].note == "line one\nline two" and vs["R2"].wgtkg is None
    assert vs["R3"].note == ""
    types = dict((f.name, f.dataType.simpleString()) for f in wh.schema("vital_signs").fields)
    assert types == {"rec_id": "string", "patno": "smallint", "infodt": "string",
                     "wgtkg": "double", "note": "string"}
    pcd = wh.read("primary_clinical_diagnosis").first()
    assert (pcd.comment, pcd.x, pcd.y, pcd.z) == ("no tremors today.", None, 3, None)
    q = sorted((r.a, r.b, r.c) for r in wh.read("quoted").collect())
    assert q == [("", "z", ""), ('say "hi"', 'x "y"', None)]
    assert wh.read("header_only").count() == 0
    assert not wh.exists("bad_byte") and not wh.exists("name_clash")


def test_existing_table_keeps_schema_and_rejects_misfits(spark, tmp_path):
    wh = Warehouse(spark, database="freeze_keep", location=str(tmp_path / "wh"))
    archive = str(tmp_path / "a.zip")
    with zipfile.ZipFile(archive, "w") as zf:
        zf.writestr("one/T_20250401.csv", b"PATNO,V\n1,2\n")
        zf.writestr("two/T_20250401.csv", b"PATNO,V\n70000,3\n")
    first = load_freeze(spark, wh, archives=[archive], members=["one/T_20250401.csv"],
                        stage=str(tmp_path / "s1"))
    assert [r.status for r in first.collect()] == ["loaded"]
    second = load_freeze(spark, wh, archives=[archive], members=["two/T_20250401.csv"],
                         stage=str(tmp_path / "s2"))
    r = second.first()
    assert r.status == "error" and "do not fit" in r.error
    assert [tuple(x) for x in wh.read("t").collect()] == [(1, 2)]
    # the clustered layout is declared for patno
    desc = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {wh.name('t')}").collect()}
    assert "patno" in desc.get("Bucket Columns", "")


def test_exclude_pattern(spark, tmp_path):
    archive = str(tmp_path / "h.zip")
    with zipfile.ZipFile(archive, "w") as zf:
        zf.writestr("Visits_20250401.csv", b"PATNO\n1\n")
        zf.writestr("Visits_Harmonized_20250401.csv", b"PATNO\n1\n")
    wh = Warehouse(spark, database="freeze_excl", location=str(tmp_path / "wh"))
    audit = {r.table_name: r.status for r in load_freeze(
        spark, wh, archives=[archive], options=LoadOptions(exclude_tables=r"_harmonized$"),
        stage=str(tmp_path / "st")).collect()}
    assert audit == {"visits": "loaded", "visits_harmonized": "excluded"}
    assert not wh.exists("visits_harmonized")


def test_streamed_repair_matches_whole_text():
    """Chunk boundaries anywhere give the same text as the whole-text rules."""
    import random

    from frostline.sources import staging as lm

    rnd = random.Random(7)
    alphabet = ['a', ' ', '\\', '"', ',', '\n', '\r', 'é', '\t', 'x', 'no tremors today. ']
    patches = (("Primary_", 'no tremors today. \\"",,"3",', 'no tremors today.",,"3",'), ("Primary_", "a a", "b"))
    for _ in range(300):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
        if rnd.random() < 0.3:
            text += ' no tremors today. \\\\",,"3",\n '
        raw = text.encode("cp1252")
        cuts = sorted(rnd.sample(range(len(raw) + 1), min(len(raw) + 1, rnd.randint(0, 6))))
        chunks = [raw[a:b] for a, b in zip([0] + cuts, cuts + [len(raw)])]
        want = text.replace("\r\n", "\n").replace("\r", "\n").replace('\\"', '""').strip()
        for _, old, new in patches:
            want = want.replace(old, new)
        got = "".join(lm.repaired_text(iter(chunks), "x/Primary_1.csv", "strict", patches))
        assert got == want, (text, chunks)
        raw_rule = text.replace('\\"', '""').strip()
        assert "".join(lm.repaired_text(iter(chunks), "x/Other.csv", "strict", (), newlines=False)) == raw_rule


def _load_zip(spark, tmp_path, label, members):
    archive = str(tmp_path / f"{label}.zip")
    with zipfile.ZipFile(archive, "w") as zf:
        for name, data in members:
            zf.writestr(name, data)
    wh = Warehouse(spark, database=f"freeze_{label}", location=str(tmp_path / f"wh_{label}"))
    return archive, wh


@pytest.mark.filterwarnings("ignore:Duplicate name")
def test_entries_of_one_name_are_two_members(spark, tmp_path):
    archive, wh = _load_zip(spark, tmp_path, "twins", [("T_20250401.csv", b"A,B\n1,2\n"), ("T_20250401.csv", b"A,B\n3,4\n")])
    audit = load_freeze(spark, wh, archives=[archive], stage=str(tmp_path / "s")).collect()
    assert [(r.status, r.n_rows) for r in audit] == [("loaded", 1)] * 2
    assert sorted(map(tuple, wh.read("t").collect())) == [(1, 2), (3, 4)]


def test_bad_entry_and_bad_archive_stop_nothing_else(spark, tmp_path):
    archive, wh = _load_zip(spark, tmp_path, "crc", [("Good.csv", b"A\n1\n"), ("Bad.csv", b"A\n22222\n")])
    data = open(archive, "rb").read()
    with open(archive, "wb") as fh:  # stored entries: another byte breaks the checksum
        fh.write(data.replace(b"22222", b"23222"))
    broken = tmp_path / "broken.zip"
    broken.write_bytes(b"no archive")
    audit = {r.member.split("/")[-1]: r for r in load_freeze(
        spark, wh, archives=[archive, str(broken)], stage=str(tmp_path / "s")).collect()}
    assert {m: r.status for m, r in audit.items()} == {"Good.csv": "loaded", "Bad.csv": "error", "broken.zip": "error"}
    assert "CRC" in audit["Bad.csv"].error and "archive" in audit["broken.zip"].error
    assert [tuple(r) for r in wh.read("good").collect()] == [(1,)]


def test_headers_meet_by_cleaned_name_and_none_is_reserved(spark, tmp_path):
    archive, wh = _load_zip(spark, tmp_path, "names", [
        ("a/T.csv", b"A-B,MEMBER_ID\n1,x\n"), ("b/T.csv", b"A B,Member Id\n2,y\n"), ("c/T.csv", b"member_id,_member_id\n1,2\n")])
    audit = {r.member: r.status for r in load_freeze(spark, wh, archives=[archive], stage=str(tmp_path / "s")).collect()}
    assert audit == {"a/T.csv": "loaded", "b/T.csv": "loaded", "c/T.csv": "error"}  # both of c's clean to member_id
    assert sorted(map(tuple, wh.read("t").select("a_b", "member_id").collect())) == [(1, "x"), (2, "y")]


def test_stray_quote_beside_fields_of_many_lines_at_any_chunk_size(spark, tmp_path, monkeypatch):
    """A quote inside an unquoted field is text; what follows keeps its records."""
    lines = ["ID,NOTE", '0,1,5" pipe'.replace("1,5", "1.5")] + [f'{i},"two\nlines ""{i}"""' for i in range(1, 60)]
    archive, wh = _load_zip(spark, tmp_path, "stray", [("Notes.csv", "\n".join(lines).encode())])
    audit = load_freeze(spark, wh, archives=[archive], stage=str(tmp_path / "s")).collect()
    assert [(r.status, r.n_rows) for r in audit] == [("loaded", 60)]
    rows = dict(map(tuple, wh.read("notes").collect()))
    assert rows[0] == '1.5" pipe' and rows[59] == 'two\nlines "59"'


def test_scan_without_a_header_loses_no_field(spark, tmp_path):
    for data in ("A,B\n1,2,3\n", "A,B\n4\n"):
        p = tmp_path / "ragged.csv"
        p.write_text(data)
        with pytest.raises(Exception, match="(?i)malformed"):
            csvsrc.read_text_csv(spark, str(p)).collect()


def test_clustered_append_writes_a_bucket_once_and_keeps_a_hot_key_whole(spark, tmp_path):
    from pyspark.sql import functions as F

    wh = Warehouse(spark, database="freeze_few", location=str(tmp_path / "wh"), buckets=4)
    rows = spark.range(0, 30000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("patno"), F.col("id").alias("v"))
    wh.create_if_absent("t", rows.schema)
    wh.append(rows, "t")
    assert len(list((tmp_path / "wh" / "t").glob("*.parquet"))) <= 8
    got = wh.read("t").agg(F.count("*"), F.sum("v"), F.count_if(F.col("patno") == 7)).first()
    assert tuple(got) == (30000, 29999 * 15000, 10001)


def test_lenient_decoding_and_append_semantics(spark, tmp_path):
    archive = str(tmp_path / "b.zip")
    with zipfile.ZipFile(archive, "w") as zf:
        zf.writestr("Bad_Byte_20250401.csv", b"A,B\nx\x81y,1\n")
    wh = Warehouse(spark, database="freeze_lenient", location=str(tmp_path / "wh"))
    opts = LoadOptions(errors="ignore")
    first = load_freeze(spark, wh, archives=[archive], options=opts, stage=str(tmp_path / "s1")).first()
    assert first.status == "loaded"
    assert [tuple(r) for r in wh.read("bad_byte").collect()] == [("xy", 1)]
    # loading again appends (the load is not idempotent by design)
    load_freeze(spark, wh, archives=[archive], options=opts, stage=str(tmp_path / "s2")).collect()
    assert wh.read("bad_byte").count() == 2


def test_cp1252_encode_replaces_foreign_characters(spark):
    texts = ["plain € ž", "日本 ok", "\U0001F600x", "\x80", "\x81", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [bytes(r.b) for r in df.select(cp1252_encode("t").alias("b")).collect()]
    assert got == ["plain € ž".encode("cp1252"), b"?? ok", b"?x", b"?", b"\x81", b""]


def test_members_are_planned_by_bytes_and_each_is_read_once(spark, tmp_path):
    """An archive is cut into ranges of bytes; an entry belongs to the range its data begin in."""
    import os as _os

    from frostline.sources.members import entries, plan_pieces

    archive = str(tmp_path / "many.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for i in range(40):
            zf.writestr(f"d{i}/T_20250401.csv", b"A,B\n" + b"".join(b"%d,%s\n" % (i, _os.urandom(20).hex().encode())
                                                                     for _ in range(10 if i else 4000)))
    planned = plan_pieces([archive, str(tmp_path / "none.zip")], True, split_bytes=20_000)
    pieces = [p for task in planned for p in task]
    found = [e for p in pieces if not p.error for e, _ in entries(p)]
    assert sorted(found) == list(range(40)) and len(pieces) > 5 and [p.error for p in pieces if p.error]
    wh = Warehouse(spark, database="freeze_ranges", location=str(tmp_path / "wh"))
    opts = LoadOptions(split_bytes=20_000)
    audit = load_freeze(spark, wh, archives=[archive], options=opts, stage=str(tmp_path / "s")).collect()
    assert len(audit) == 40 and {r.status for r in audit} == {"loaded"} and sum(r.n_rows for r in audit) == 4390
    assert wh.read("t").count() == 4390


def test_files_by_folder_and_by_pattern(tmp_path):
    from frostline.sources.members import plan_pieces

    for name in ("a/X.csv", "a/Y.csv", "b/X.csv", "a/deep/X.csv", "a/_SUCCESS"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"A\n1\n")

    def names(*paths):
        return sorted(p.path.removeprefix(str(tmp_path) + "/") for task in plan_pieces(paths, False) for p in task)
    assert names(f"{tmp_path}/a") == ["a/X.csv", "a/Y.csv"]
    assert names(f"{tmp_path}/*/X.csv") == ["a/X.csv", "b/X.csv"]
    assert names(f"file:{tmp_path}/a/[Y]*") == [f"file:{tmp_path}/a/Y.csv"]

"""The command line loads, describes and publishes."""

import zipfile

from frostline.__main__ import main


def test_cli_load_describe_views(spark, tmp_path, capsys):
    archive = str(tmp_path / "f.gz")
    with zipfile.ZipFile(archive, "w") as zf:
        zf.writestr("Participant_Status_20250401.csv",
                    b"PATNO,COHORT_DEFINITION,ENROLL_DATE,ENROLL_STATUS,STATUS_DATE,SCREENEDAM4,ENROLL_AGE,"
                    b"INEXPAGE,AV133STDY,TAUSTDY,GAITSTDY,PISTDY,SV2ASTDY,DATELIG,PPMI_ONLINE_ENROLL,"
                    b"ENRLPINK1,ENRLPRKN,ENRLSRDC,ENRLHPSM,ENRLRBD,ENRLLRRK2,ENRLSNCA,ENRLGBA\n"
                    b"1,PD,04/2025,Enrolled,05/2025,1,60.5,1,0,0,0,0,0,01/2025,0,1,0,0,0,0,0,0,1\n")
        zf.writestr("readme.txt", b"x")
    assert main(["describe", "-z", archive]) == 0
    assert "SMALLINT NOT NULL" in capsys.readouterr().out
    assert main(["load", "-z", archive, "--database", "freeze_cli"]) == 0
    out = capsys.readouterr().out
    assert "loaded" in out and "participant_status" in out and "skipped" in out
    assert main(["views", "--database", "freeze_cli"]) == 0
    assert "participant_status" in capsys.readouterr().out
    row = spark.table("participant_status").first()
    assert row.mutations == "GBA,PINK1" and row.enroll_date == "2025-04"
    assert main(["load", "-z", archive, "--database", "freeze_cli", "missing.csv"]) == 1
    overlay = tmp_path / "overlay.csv"
    overlay.write_text('mod_name,itm_name,code,decode,mapping_notes\nSCREEN,SEX,1,"MALE, own",\n')
    capsys.readouterr()
    assert main(["views", "--database", "freeze_cli", "--schema", "curated_cli", "--code-list-overlay", str(overlay)]) == 0
    assert "curated_cli.participant_status" in capsys.readouterr().out
    assert spark.newSession().table("curated_cli.participant_status").first().mutations == "GBA,PINK1"
    assert spark.table("freeze_cli._code_list_overlay").first().decode == "MALE, own"


def test_missing_archive_is_one_audit_row(spark, tmp_path, capsys):
    """A missing archive is reported; the others are loaded."""
    archive = str(tmp_path / "good.gz")
    with zipfile.ZipFile(archive, "w") as zf:
        zf.writestr("Things_20250401.csv", b"A,B\n1,x\n")
    missing = str(tmp_path / "none.gz")
    assert main(["load", "-z", archive, "-z", missing, "--database", "freeze_missing"]) == 1
    out = capsys.readouterr().out
    assert "none.gz" in out and "not a readable archive" in out
    assert spark.table("freeze_missing.things").count() == 1


def test_describe_reports_members_it_cannot_read(spark, tmp_path, capsys):
    archive = str(tmp_path / "mixed.gz")
    with zipfile.ZipFile(archive, "w") as zf:
        zf.writestr("Good_20250401.csv", b"A,B\n1,x\n")
        zf.writestr("Bad_20250401.csv", b"A,B\n1,\x81\n")  # a byte that the code page does not define
    assert main(["describe", "-z", archive]) == 1
    out = capsys.readouterr()
    assert "schema inferred for good" in out.out and "Bad_20250401.csv" in out.err


def test_describe_shows_source_names_and_malformed_members(spark, tmp_path, capsys):
    archive = str(tmp_path / "names.gz")
    with zipfile.ZipFile(archive, "w") as zf:
        zf.writestr("Good_20250401.csv", b"PATNO,Visit Date\n1,x\n")
        zf.writestr("Ragged_20250401.csv", b"A,B\n1,x\n2,y,z\n")
    assert main(["describe", "-z", archive]) == 1
    out = capsys.readouterr()
    assert "PATNO" in out.out and "Visit Date" in out.out and "visit_date" in out.out
    assert "Ragged_20250401.csv" in out.err and "1 malformed" in out.err and "inferred for ragged" not in out.out


def test_missing_file_is_one_audit_row(spark, tmp_path, capsys):
    good, missing = tmp_path / "Things_20250401.csv", tmp_path / "None_20250401.csv"
    good.write_bytes(b"A,B\n1,x\n")
    assert main(["load", "--database", "freeze_absent", str(good), str(missing)]) == 1
    out = capsys.readouterr().out
    assert "None_20250401.csv" in out and "no such file" in out
    assert spark.table("freeze_absent.things").count() == 1
    assert main(["load", "--database", "freeze_absent", str(missing)]) == 1


def test_audit_is_kept_and_tables_are_exported(spark, tmp_path, capsys):
    archive, home, out = (str(tmp_path / n) for n in ("f.gz", "home", "out"))
    with zipfile.ZipFile(archive, "w") as zf:
        zf.writestr("Things_20250401.csv", b"A,B\n1,x\n2,\n")
        zf.writestr("Bad_20250401.csv", b"A,B\n1,\x81\n")
    for _ in range(2):
        assert main(["load", "-z", archive, "--database", "freeze_kept", "--location", home]) == 1
    audit = spark.table("freeze_kept._load_audit")
    assert sorted((r.table_name, r.status) for r in audit.collect()) == [("bad", "error")] * 2 + [("things", "loaded")] * 2
    assert audit.select("loaded_at").distinct().count() == 2
    assert spark.read.parquet(f"{home}/things").count() == 4
    assert main(["export", "--database", "freeze_kept", "--location", home, "--to", out]) == 0
    assert sorted(map(tuple, spark.read.option("header", True).csv(f"{out}/things").collect())) == [("1", "x"), ("1", "x"), ("2", None), ("2", None)]
    assert main(["export", "--database", "freeze_kept", "--to", out, "--format", "json", "things", "absent"]) == 1
    assert spark.read.json(f"{out}/things").count() >= 4 and "no such table: absent" in capsys.readouterr().err

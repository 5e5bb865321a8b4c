"""Load a data freeze into the warehouse, with a per-member audit.

Flow (one Spark job per arrow unless noted):

1. the member source plans its partitions as ranges of bytes of the archives and
   files; requested names not found, missing or unreadable archives and files and
   non-CSV members go straight to the audit;
2. executors stream each wanted member: decode cp1252, repair quotes, apply file
   patches, write UTF-8 text -> one short row per member (table, header, file);
3. per table (driver thread pool): scan the staged members with the CSV rules
   (one scan per distinct header, columns under their cleaned names), write the
   text columns once to parquet and observe their profile and row counts on the way
   (with several members, rows are counted per member from one column; with malformed
   records, the good members are profiled again), create the table if absent, check casts against
   the table's types per member, append the good members;
4. the audit (one row per member) is returned as a DataFrame.

A failure in one member (undefined byte, bad checksum, malformed record, value
that does not fit an existing table, clashing column names) rejects that member
only.
"""

from __future__ import annotations

import os
import traceback
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import checks
from ..operators.profile import ObservedProfile, profile, sql_names
from ..session import scratch_dir
from ..sinks.warehouse import CLUSTER_COLUMNS, Warehouse
from ..sources import csv as csvsrc
from ..sources.staging import MEMBER_ID, stage_members
from ..sources.text import FILE_PATCHES

#: Where the command line keeps audits; no member can make a table of this name.
AUDIT_TABLE = "_load_audit"

AUDIT_SCHEMA = T.StructType([
    T.StructField("archive", T.StringType(), True),
    T.StructField("member", T.StringType(), False),
    T.StructField("table_name", T.StringType(), True),
    T.StructField("n_rows", T.LongType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("error", T.StringType(), True),
    T.StructField("header_length", T.LongType(), True),
])


@dataclass
class _Member:
    archive: str | None
    member: str
    table_name: str | None
    member_id: str
    path: str | None = None
    header: str | None = None
    header_length: int | None = None
    status: str = "pending"
    error: str | None = None
    n_rows: int | None = None

    def fail(self, error: str) -> None:
        self.status = "error"
        hint = ""
        if self.header_length == checks.TRUNCATED_HEADER_LENGTH:
            hint = "; a header of exactly this length suggests a truncated, corrupt file"
        where = f" (header length {self.header_length})" if self.header_length is not None else ""
        self.error = f"{error}{where}{hint}"

    def row(self):
        return (self.archive, self.member, self.table_name, self.n_rows, self.status, self.error,
                self.header_length)


@dataclass
class LoadOptions:
    create_tables: bool = True
    errors: str = "strict"                       # cp1252 decoding
    patches: Sequence[tuple[str, str, str]] = FILE_PATCHES
    csv_only: bool = True                        # skip members not named *.csv
    exclude_tables: str | None = None            # regex on table names, e.g. "_harmonized$"
    cluster_by: Sequence[str] = CLUSTER_COLUMNS
    workers: int = 4
    universal_newlines: bool = True               # CRLF / CR -> LF, as text-mode reads do
    extra_csv_options: dict = field(default_factory=dict)
    split_bytes: int | None = None                # compressed bytes a staging task gets (the source's default, if None)
    audit_table: str | None = None               # table of the warehouse that keeps the audits of all loads


@dataclass
class Staged:
    """Members decoded and staged as text, before any table is loaded."""
    members: list[_Member]
    text_dir: str
    stage: str

    def tables(self) -> dict[str, list[_Member]]:
        out: dict[str, list[_Member]] = defaultdict(list)
        for m in self.members:
            if m.status == "pending":
                out[m.table_name].append(m)
        return dict(out)


def stage_freeze(spark: SparkSession, archives: Sequence[str] | None = None,
                 files: Sequence[str] | None = None, members: Sequence[str] | None = None,
                 options: LoadOptions | None = None, stage: str | None = None) -> Staged:
    """Steps 1 and 2: list, filter, and stream the members' repaired text."""
    opts = options or LoadOptions()
    stage = stage or scratch_dir(spark, "stage")
    if not archives and not files:
        raise ValueError("give archives or files")
    files = [files] if isinstance(files, str) else files
    text_dir = os.path.join(stage, "text")
    found = []
    for r in stage_members(spark, text_dir, opts.errors, opts.patches, archives, None if archives else files,
                           members if archives else None, opts.exclude_tables, opts.universal_newlines,
                           csv_only=opts.csv_only and bool(archives), split_bytes=opts.split_bytes).collect():
        m = _Member(r["archive"], r["member"], r["table_name"], r["member_id"], r["path"], r["header"],
                    r["header_length"], r["status"], r["error"])
        if m.status == "error":
            m.fail(m.error)
        found.append(m)
    seen = {m.member for m in found}
    absent = [_Member(None, name, None, "", status="not_found", error="requested member is in no archive")
              for name in dict.fromkeys(members or []) if archives and name not in seen]
    found.sort(key=lambda m: (m.archive or "", m.member, m.member_id))
    return Staged(absent + found, text_dir, stage)


def scan_staged_table(spark: SparkSession, staged: Staged, table: str,
                      options: LoadOptions | None = None) -> DataFrame | None:
    """All-text rows of one table's staged members under their cleaned column
    names (plus ``_member_id`` and the corrupt-record column); one CSV scan per
    distinct header."""
    opts = options or LoadOptions()
    members = staged.tables().get(table, [])
    groups: dict[str, list[_Member]] = defaultdict(list)
    for m in members:
        groups[m.header or ""].append(m)
    scans = []
    base = os.path.join(staged.text_dir, table)
    for header, ms in groups.items():
        names = csvsrc.parse_header(header)
        try:
            if not names:
                raise ValueError("empty header")
            names = sql_names(names)
        except ValueError as e:
            for m in ms:
                m.fail(str(e))
            continue
        scans.append(csvsrc.read_text_csv(spark, [m.path for m in ms], header=names, basePath=base,
                                          **opts.extra_csv_options))
    if not scans:
        return None
    raw = scans[0]
    for s in scans[1:]:
        raw = raw.unionByName(s, allowMissingColumns=True)
    return raw


def source_names(staged: Staged, table: str) -> dict[str, str]:
    """What the columns of a table's staged members are called in their headers, by cleaned name."""
    out: dict[str, str] = {}
    for header in dict.fromkeys(m.header or "" for m in staged.tables().get(table, [])):
        names = csvsrc.parse_header(header)
        for clean, name in zip(sql_names(names), names):
            out.setdefault(clean, name)
    return out


def reject_malformed(rows: DataFrame, members: Sequence[_Member]) -> DataFrame:
    """``rows`` of a table scan without the members that hold malformed records, which fail."""
    data = [f"`{c}`" for c in rows.columns if c not in (MEMBER_ID, csvsrc.CORRUPT)]
    # All columns are read, as a record is malformed by its number of fields.
    bad = (rows.groupBy(MEMBER_ID).agg(F.count(csvsrc.CORRUPT).alias("bad"), F.max(F.xxhash64(*data)))
           .where("bad > 0").collect())
    by_id = {m.member_id: m for m in members}
    for r in bad:
        by_id[r[MEMBER_ID]].fail(f"{r['bad']} malformed CSV record(s)")
    return _without_rejected(rows, by_id.values())


def load_freeze(spark: SparkSession, warehouse: Warehouse, archives: Sequence[str] | None = None,
                files: Sequence[str] | None = None, members: Sequence[str] | None = None,
                options: LoadOptions | None = None, stage: str | None = None) -> DataFrame:
    """Load every (or every requested) CSV member into ``warehouse``; returns
    the audit DataFrame (``AUDIT_SCHEMA``)."""
    opts = options or LoadOptions()
    staged = stage_freeze(spark, archives, files, members, opts, stage)
    by_table = staged.tables()

    def run(table: str) -> None:
        try:
            _load_table(spark, warehouse, table, by_table[table], staged, opts)
        except Exception as e:  # noqa: BLE001 - recorded per member, run continues
            for m in by_table[table]:
                if m.status == "pending":
                    m.fail(f"{type(e).__name__}: {e}")
            traceback.print_exc()

    with ThreadPoolExecutor(max_workers=max(1, opts.workers)) as pool:
        list(pool.map(run, sorted(by_table)))
    for m in staged.members:
        if m.status == "pending":
            m.fail("not loaded")
    audit = spark.createDataFrame([m.row() for m in staged.members], AUDIT_SCHEMA)
    if opts.audit_table:
        kept = audit.withColumn("loaded_at", F.current_timestamp())
        warehouse.create_if_absent(opts.audit_table, kept.schema, cluster_by=())
        warehouse.append(kept, opts.audit_table)
    return audit


def _without_rejected(rows: DataFrame, members) -> DataFrame:
    bad = [(m.member_id,) for m in members if m.status != "pending"]
    if not bad:
        return rows
    return rows.join(rows.sparkSession.createDataFrame(bad, f"{MEMBER_ID} string"), MEMBER_ID, "left_anti")


def _load_table(spark: SparkSession, wh: Warehouse, table: str, members: list[_Member],
                staged: Staged, opts: LoadOptions) -> None:
    raw = scan_staged_table(spark, staged, table, opts)
    if raw is None:
        return
    stage = staged.stage
    raw_path = os.path.join(stage, "raw", table)
    data_cols = [c for c in raw.columns if c not in (MEMBER_ID, csvsrc.CORRUPT)]
    seen = ObservedProfile(raw, data_cols, bad=F.count(csvsrc.CORRUPT))
    seen.rows.write.mode("overwrite").parquet(raw_path)
    raw = spark.read.parquet(raw_path)

    by_id = {m.member_id: m for m in members if m.status == "pending"}
    if len(by_id) == 1:
        counts = [(*by_id, seen.extra["n_rows"], seen.extra["bad"])]
    else:
        counts = (raw.groupBy(MEMBER_ID)
                  .agg(F.count(F.lit(1)).alias("n"), F.count(csvsrc.CORRUPT).alias("bad")).collect())
    for member, n, bad in counts:
        if (m := by_id.get(member)) is None:
            continue
        m.n_rows = n
        if bad:
            m.fail(f"{bad} malformed CSV record(s)")
    for m in by_id.values():
        if m.n_rows is None and m.status == "pending":
            m.n_rows = 0
    ok = [i for i, m in by_id.items() if m.status == "pending"]
    if not ok:
        return
    good = _without_rejected(raw, by_id.values())
    if seen.extra["bad"]:  # rows of rejected members do not count
        prof = profile(good.select(*[F.col(f"`{c}`") for c in data_cols]), table)
    else:
        prof = seen.profile(table)
    prof_rows = prof.collect()
    names = {r["csv_name"]: r["sql_name"] for r in prof_rows}
    created = False
    if opts.create_tables:
        schema = T.StructType.fromDDL(", ".join(f"`{r['sql_name']}` {r['spark_type']}" for r in prof_rows))
        created = wh.create_if_absent(table, schema, cluster_by=opts.cluster_by)
    target = {f.name: f.dataType for f in wh.schema(table).fields}
    missing = [c for c in data_cols if names[c] not in target]
    if missing:
        raise ValueError(f"columns not in table {table}: {missing}")
    casts = {c: F.col(f"`{c}`").try_cast(target[names[c]]) for c in data_cols}
    if not created:
        # an existing table keeps its types: check every member's values fit
        # (a new table's types come from this very data, so they always fit)
        failed = F.lit(False)
        for c in data_cols:
            failed = failed | (F.col(f"`{c}`").isNotNull() & casts[c].isNull())
        bad_members = (good.groupBy(MEMBER_ID).agg(F.count_if(failed).alias("n_bad"))
                       .filter("n_bad > 0").collect())
        for r in bad_members:
            by_id[r[MEMBER_ID]].fail(f"{r['n_bad']} value(s) do not fit the types of table {table}")
    ok = [i for i, m in by_id.items() if m.status == "pending"]
    if ok:
        typed = _without_rejected(good, by_id.values()).select(
            *[casts[c].alias(names[c]) for c in data_cols])
        wh.append(typed, table)
    for i in ok:
        by_id[i].status = "loaded"

"""Command line: ``python -m frostline <command> ...``

  load      load a freeze (zip archives or CSV files) into a warehouse database, or
            with --to through a Spark connector
  describe  print the inferred schema report of every table of a freeze
  export    write tables of a warehouse database as CSV or through a Spark connector
  views     publish the curated and metadata views, list them, and set column
            comments from the data dictionary; with --schema also permanent views

Runs in the current Spark environment (``spark-submit -m``-style launchers or a
plain ``python`` with a local session); cluster settings come from there.
"""

from __future__ import annotations

import argparse
import sys


def _session():
    from pyspark.sql import SparkSession

    from .session import ensure_checkpoint_dir

    spark = SparkSession.builder.appName("frostline").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="frostline")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("load", "describe"):
        c = sub.add_parser(name)
        c.add_argument("files", nargs="*", help="CSV files, or member names when --zip-file is given")
        c.add_argument("--zip-file", "-z", action="append", default=[], help="zip archive(s)")
        c.add_argument("--database", default="freeze")
        c.add_argument("--exclude-tables", default=None, help="regex of table names to skip")
    sub.choices["load"].add_argument("--no-create", action="store_true",
                                     help="only append to existing tables")
    sub.choices["load"].add_argument("--to", default=None, help="load into this folder, or name prefix at the connector, not a database")
    sub.choices["load"].add_argument("--format", default="frostline_files", help="connector that --to is for")
    sub.choices["load"].add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="option of the connector")
    x = sub.add_parser("export")
    x.add_argument("tables", nargs="*", help="tables to write; all of the database by default")
    x.add_argument("--database", default="freeze")
    x.add_argument("--to", required=True, help="folder, or name prefix at the connector; the table's name is added")
    x.add_argument("--format", default="csv", help="csv, or any format the session has a connector for")
    x.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="option of the connector")
    v = sub.add_parser("views")
    v.add_argument("--database", default="freeze")
    v.add_argument("--labels", action="store_true", help="lookups return labels, not codes")
    v.add_argument("--schema", default=None, help="make permanent views in this schema, too")
    v.add_argument("--code-list-overlay", default=None, help="CSV that replaces the code-list overlay table")
    v.add_argument("--dictionary-overlay", default=None, help="CSV that replaces the dictionary overlay table")
    for name in ("load", "export", "views"):
        sub.choices[name].add_argument("--location", default=None,
                                       help="shared folder of the database, one that outlives the application")
    args = p.parse_args(argv)

    from .plans.load import AUDIT_TABLE, LoadOptions, load_freeze, reject_malformed, scan_staged_table, source_names, stage_freeze
    from .sinks.warehouse import Warehouse

    spark = _session()
    if args.command == "views":
        from .functions.scalars import blanks_to_null
        from .plans.publish import VIEW_DESCRIPTIONS, apply_dictionary_comments, publish_views

        from .plans.catalog_views import create_views, overlay_tables
        from .sources.catalog import read_overlay_csv

        wh = Warehouse(spark, args.database, args.location)
        overlays = [path and read_overlay_csv(spark, path, kind) for path, kind in
                    ((args.code_list_overlay, "code_list"), (args.dictionary_overlay, "dictionary"))]
        if any(overlays):
            overlay_tables(wh, *overlays)
        if args.schema:
            for name in create_views(wh, args.schema, "decode" if args.labels else "code"):
                print(f"{args.schema}.{name}")
        views = publish_views(spark, wh, lookup_output="decode" if args.labels else "code")
        for name in views:
            print(name + (f"  -- {VIEW_DESCRIPTIONS[name]}" if name in VIEW_DESCRIPTIONS else ""))
        if wh.exists("data_dictionary_annotated"):
            n = apply_dictionary_comments(spark, wh, blanks_to_null(wh.read("data_dictionary_annotated")))
            print(f"{n} column comment(s) set from the data dictionary")
        return 0

    if args.command == "export":
        from .sinks.warehouse import export_csv, write_format

        wh = Warehouse(spark, args.database, args.location)
        options = dict(o.partition("=")[::2] for o in args.option)
        absent = [t for t in args.tables if not wh.exists(t)]
        for table in args.tables or sorted(t for t in wh.base_tables() if not t.startswith("_")):
            if table in absent:
                print(f"no such table: {table}", file=sys.stderr)
                continue
            target = f"{args.to.rstrip('/')}/{table}" if "/" in args.to else f"{args.to}.{table}"
            if args.format == "csv":
                export_csv(wh.read(table), target, **options)
            else:
                write_format(wh.read(table), args.format, target, **options)
            print(f"{table}  {target}")
        return 1 if absent else 0

    archives = args.zip_file or None
    kw = ({"archives": archives, "members": args.files or None} if archives else {"files": args.files})
    opts = LoadOptions(exclude_tables=args.exclude_tables,
                       create_tables=not getattr(args, "no_create", False), audit_table=AUDIT_TABLE)
    if args.command == "describe":
        from .operators.profile import profile, schema_report
        from .sources.csv import CORRUPT
        from .sources.staging import MEMBER_ID

        staged = stage_freeze(spark, options=opts, **kw)
        for table, members in sorted(staged.tables().items()):
            raw = scan_staged_table(spark, staged, table, opts)
            if raw is not None:
                names = source_names(staged, table)
                raw = reject_malformed(raw, [m for m in members if m.status == "pending"])
                if all(m.status != "pending" for m in members):
                    continue
                print(f"-- schema inferred for {table}")
                report = schema_report(profile(raw.drop(MEMBER_ID, CORRUPT), table, csv_names=names)).toPandas()
                print(report.to_string(index=False))
        failed = [m for m in staged.members if m.status in ("error", "not_found")]
        for m in failed:
            print(f"not described: {m.member}  ({m.error})", file=sys.stderr)
        return 1 if failed else 0

    if args.to:
        from .sinks.external import ExternalSink

        sink = ExternalSink(spark, args.format, args.to, dict(o.partition("=")[::2] for o in args.option))
    else:
        sink = Warehouse(spark, args.database, args.location)
    audit = load_freeze(spark, sink, options=opts, **kw)
    rows = audit.collect()
    for r in rows:
        print(f"{r.status:9s} {r.table_name or '-':30s} {r.n_rows if r.n_rows is not None else '-':>10} "
              f"{r.member}" + (f"  ({r.error})" if r.error else ""))
    errors = [r for r in rows if r.status in ("error", "not_found")]
    if errors:
        print(f"{len(errors)} member(s) failed", file=sys.stderr)
    return 1 if errors else 0


if __name__ == "__main__":
    sys.exit(main())

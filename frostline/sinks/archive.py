"""Write tables out as a data freeze: CSV members inside zip archives.

Spark's CSV writer formats the rows (one file per task, header in each); each
file then becomes a member of a zip archive, re-encoded on the way (cp1252 by
default).  Archives are built by executors, a bounded number of members each.
"""

from __future__ import annotations

import os
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.members import find_files, open_binary, open_output

ARCHIVE_SCHEMA = "archive string, member string, source string"


def write_csv_members(df: DataFrame, path: str, files: int | None = None,
                      quote_escape: str = '"', line_sep: str = "\n",
                      partition_by: str | None = None) -> None:
    """Format ``df`` as CSV files under ``path`` (text, UTF-8).

    ``quote_escape='\\\\'`` writes quotes inside fields as ``\\"`` (the broken
    style the loader repairs); ``'"'`` writes standard doubled quotes.
    """
    # round-robin: files stay even even when one partition value holds most rows
    out = df.repartition(files) if files else df
    writer = out.write.mode("overwrite").options(
        header="true", quote='"', escape=quote_escape, lineSep=line_sep, quoteAll="false",
        nullValue="", emptyValue='""', ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)


def _file_members(out_dir: str, member_file: str, encoding: str):
    def copy_group(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for src, member_dir in zip(pdf["path"], pdf["member_dir"]):
                target = os.path.join(out_dir, member_dir, member_file)
                with open_binary(src) as fin, open_output(target) as fout:
                    for line in _lines(fin):
                        fout.write(line.encode(encoding, errors="replace"))
                rows.append((None, target, src))
            yield pd.DataFrame(rows, columns=["archive", "member", "source"])
    return copy_group


def _zip_members(out_dir: str, member_file: str, encoding: str):
    def zip_group(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the partition's listing rows are metadata (a few per archive); all
        # files of one archive are in this partition, so group them first
        frames = list(batches)
        if frames:
            pdf = pd.concat(frames)
            for archive, group in pdf.groupby("archive"):
                rows = []
                target = os.path.join(out_dir, archive)
                with open_output(target) as raw, \
                        zipfile.ZipFile(raw, "w", compression=zipfile.ZIP_DEFLATED) as zf:
                    for src, member_dir in zip(group["path"], group["member_dir"]):
                        member = f"{member_dir}/{member_file}" if member_dir else member_file
                        with open_binary(src) as fin, zf.open(member, "w") as fout:
                            # stream: re-encode line by line, bounded memory
                            for line in _lines(fin):
                                fout.write(line.encode(encoding, errors="replace"))
                        rows.append((target, member, src))
                yield pd.DataFrame(rows, columns=["archive", "member", "source"])
    return zip_group


def _lines(fh, chunk: int = 1 << 20) -> Iterator[str]:
    """The text of a UTF-8 file in chunks of about ``chunk`` characters."""
    import io

    text = io.TextIOWrapper(fh if hasattr(fh, "readable") else io.BufferedReader(fh),
                            encoding="utf-8", newline="")
    while True:
        part = text.read(chunk)
        if not part:
            break
        yield part


def zip_members(spark: SparkSession, csv_dir: str, out_dir: str, member_file: str,
                members_per_archive: int = 8, encoding: str = "cp1252",
                archive_prefix: str = "freeze", container: str = "zip") -> DataFrame:
    """Put every CSV file under ``csv_dir`` into zip archives in ``out_dir``
    (``container='dir'``: plain files ``out_dir/<member>`` instead).

    Member names are ``<sub-directory>/<part>/<member_file>`` so members stay
    unique; returns ``(archive, member, source)`` (one row per member).
    """
    files = find_files(spark, csv_dir, recursive=True, glob="*.csv")
    rel = F.regexp_replace(F.col("path"), r"^.*?" + re.escape(csv_dir.rstrip("/")) + "/?", "")
    part = F.regexp_extract(rel, r"(part-\d+)", 1)
    sub = F.regexp_replace(rel, r"/?[^/]*\z", "")
    member_dir = F.when(sub == "", part).otherwise(F.concat(sub, F.lit("/"), part))
    n_files = files.count()  # metadata: one row per file
    n_archives = max(1, -(-n_files // members_per_archive))
    grouped = files.select(
        "path", member_dir.alias("member_dir"),
        F.concat(F.lit(f"{archive_prefix}-"),
                 F.lpad(F.pmod(F.xxhash64("path"), F.lit(n_archives)).cast("string"), 5, "0"),
                 F.lit(".zip")).alias("archive"))
    n = max(1, min(n_archives, spark.sparkContext.defaultParallelism))
    writer = (_zip_members if container == "zip" else _file_members)(out_dir, member_file, encoding)
    return grouped.repartition(n, "archive").mapInPandas(writer, ARCHIVE_SCHEMA)

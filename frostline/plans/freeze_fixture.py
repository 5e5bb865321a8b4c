"""Data freezes written from the driver tables, for the ingestion queries.

A freeze is built the way real ones arrive: CSV text per table (Spark's CSV
writer, one file per task), re-encoded to cp1252 and packed as members of zip
archives (or left as plain files) in a fresh folder under the shared scratch
root.  Everything here runs as Spark jobs; only the member listing (one short
row per member) reaches the driver.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sinks.archive import write_csv_members, zip_members

FREEZE_DATE = "20250401"


def as_freeze_text(df: DataFrame) -> DataFrame:
    """Timestamps as ``yyyy-MM-dd HH:mm:ss`` text (freeze files carry text)."""
    return df.select(*[
        F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if f.dataType.typeName().startswith("timestamp") else F.col(f.name)
        for f in df.schema.fields])


class Freeze:
    """Members written for one table."""

    def __init__(self, spark: SparkSession, df: DataFrame, name: str, label: str | None = None,
                 files: int | None = None, quote_escape: str = '"', partition_by: str | None = None,
                 encoding: str = "cp1252", container: str = "zip", member_file: str | None = None,
                 members_per_archive: int = 2):
        self.base = scratch_dir(spark, label or name.lower())
        csv_dir = os.path.join(self.base, "csv")
        write_csv_members(as_freeze_text(df), csv_dir, files=files, quote_escape=quote_escape,
                          partition_by=partition_by)
        self.rows = zip_members(spark, csv_dir, os.path.join(self.base, container),
                                member_file or f"{name}_{FREEZE_DATE}.csv", encoding=encoding,
                                members_per_archive=members_per_archive,
                                archive_prefix=name.lower(), container=container).collect()

    @property
    def archives(self) -> list[str]:
        return sorted({r["archive"] for r in self.rows if r["archive"]})

    @property
    def members(self) -> list[str]:
        return sorted(r["member"] for r in self.rows)

    @property
    def csv_dir(self) -> str:
        return os.path.join(self.base, "csv")

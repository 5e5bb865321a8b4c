"""Warehouse sink: create-if-absent tables, append loads, clustered layout,
CSV export and external formats (views are published by ``plans.publish``).

Tables live in a catalog database whose files sit in a shared folder (by
default under the session's checkpoint folder).  Spark enforces neither keys
nor NOT NULL on parquet tables; see ``operators.checks`` for those.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import clean_sql_name_text
from ..session import scratch_root

# Fixed value: columns a table is clustered on when present (the reference
# indexes them).
CLUSTER_COLUMNS = ("patno",)
# Long enough for scans, short enough for a lookup to read little of a large file.
ROW_GROUP_BYTES = 32 << 20
# Up to so many values of one IN reach the Parquet reader as equalities (a default of the
# session); of longer ones it sees the smallest and the largest value alone.
_VALUES_PUSHED = 10


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _fits(value, kind: T.DataType) -> bool:
    """False for an integer that a column of this type cannot hold, and so does not."""
    bits = _BITS.get(type(kind))
    return bits is None or not isinstance(value, int) or -(1 << bits - 1) <= value < 1 << bits - 1


class Warehouse:
    """A catalog database of parquet tables in a shared location."""

    def __init__(self, spark: SparkSession, database: str = "freeze", location: str | None = None,
                 buckets: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES):
        """``buckets``: bucket count of clustered tables.  It must be the same
        for every table (co-located joins need equal counts), so it is one
        warehouse-wide setting; by default the session's shuffle partition
        count, which a cluster sizes for its data.  ``row_group_bytes``: how long
        a row group of a clustered table gets; lookups by its key skip whole ones."""
        self.row_group_bytes = row_group_bytes
        self.spark = spark
        self.database = database
        self.location = location or os.path.join(scratch_root(spark), f"{database}.db")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(database)} LOCATION {_lit(self.location)}")

    def name(self, table: str) -> str:
        return f"{_q(self.database)}.{_q(table)}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{_q(self.database)}.{_q(table)}")

    def create_if_absent(self, table: str, schema: T.StructType,
                         cluster_by: Sequence[str] = CLUSTER_COLUMNS,
                         comments: Mapping[str, str] | None = None,
                         table_comment: str | None = None) -> bool:
        """Create the table unless it exists (an existing table keeps its
        schema).  Columns in ``cluster_by`` that the table has become bucket +
        sort columns.  Returns True when created."""
        if self.exists(table):
            return False
        if not schema.fields:
            raise ValueError(f"table {table!r} has no columns")
        comments = comments or {}
        cols = ", ".join(
            f"{_q(f.name)} {f.dataType.simpleString()}"
            + (f" COMMENT {_lit(comments[f.name])}" if comments.get(f.name) else "")
            for f in schema.fields)
        present = [c for c in cluster_by if c in schema.fieldNames()]
        layout = ""
        if present:
            keys = ", ".join(_q(c) for c in present)
            options = {"parquet.block.size": str(self.row_group_bytes), "parquet.bloom.filter.adaptive.enabled": "true",
                       **{f"parquet.bloom.filter.enabled#{c}": "true" for c in present}}
            pairs = ", ".join(f"{_lit(k)} {_lit(v)}" for k, v in options.items())
            layout = f" OPTIONS ({pairs}) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS"
        comment = f" COMMENT {_lit(table_comment)}" if table_comment else ""
        location = os.path.join(self.location, table)
        if "://" not in location and not location.startswith("file:"):
            os.makedirs(location, exist_ok=True)  # an empty table is an empty folder
        self.spark.sql(
            f"CREATE TABLE {self.name(table)} ({cols}) USING parquet{layout}{comment} "
            f"LOCATION {_lit(location)}")
        return True

    def schema(self, table: str) -> T.StructType:
        return self.spark.table(self.name(table)).schema

    def append(self, df: DataFrame, table: str) -> None:
        """Append rows; columns are matched by name (missing ones are NULL)."""
        target = self.schema(table)
        cols = set(df.columns)
        typed = df.select(*[(F.col(_q(f.name)) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                            for f in target.fields])
        self._by_bucket(typed, table).write.insertInto(self.name(table))

    def _by_bucket(self, df: DataFrame, table: str) -> DataFrame:
        """Rows dealt by the table's bucket columns, so a task writes few files;
        adaptive execution gives a hot key's bucket to several tasks."""
        columns = [c.name for c in self.spark.catalog.listColumns(self.name(table)) if c.isBucket]
        return df.hint("rebalance", self.buckets, *[F.col(_q(c)) for c in columns]) if columns else df

    def overwrite(self, df: DataFrame, table: str) -> None:
        """Replace the rows of a reference table (truncate + load)."""
        target = self.schema(table)
        self._by_bucket(df.select(*[F.col(_q(f.name)).cast(f.dataType).alias(f.name) for f in target.fields]), table) \
          .write.insertInto(self.name(table), overwrite=True)

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def rows_of(self, table: str, values: Iterable, key: str = CLUSTER_COLUMNS[0]) -> DataFrame:
        """The rows whose ``key`` is one of ``values`` (a list a user typed or uploaded).

        On a table clustered by ``key`` only the buckets of the values are listed, and row groups whose range,
        dictionary or Bloom filter leaves a value out are skipped.  Use a semi join for
        values that are rows of a table.
        """
        kind = self.schema(table)[key].dataType
        wanted = sorted({v for v in values if v is not None and _fits(v, kind)})
        if not wanted:
            return self.read(table).where(F.lit(False))
        column = F.col(_q(key))
        tens = [column.isin(*[F.lit(v).cast(kind) for v in wanted[i:i + _VALUES_PUSHED]])
                for i in range(0, len(wanted), _VALUES_PUSHED)]
        return self.read(table).where(reduce(lambda a, b: a | b, tens))

    def base_tables(self) -> dict[str, DataFrame]:
        """``{name: DataFrame}`` of the database's tables (views excluded)."""
        out = {}
        for t in self.spark.catalog.listTables(self.database):
            if t.tableType != "VIEW" and not t.isTemporary:
                out[t.name] = self.read(t.name)
        return out


def write_format(df: DataFrame, fmt: str, target: str, mode: str = "append",
                 **options: str) -> None:
    """Load into an external sink through its Spark connector (format name and
    options are parameters; the connector jar must be on the classpath)."""
    writer = df.write.format(fmt).mode(mode).options(**options)
    if "://" in target or target.startswith("/"):
        writer.save(target)
    else:
        writer.option("table", target).save()


def export_csv(df: DataFrame, path: str, **options: str) -> None:
    """Self-contained CSV export: cleaned header names, all rows, standard
    quoting (NULL as an empty field, '' as ``""``)."""
    names = [clean_sql_name_text(c) for c in df.columns]
    (df.toDF(*names).write.mode("overwrite")
     .options(**{"header": "true", "escape": '"', "quoteAll": "false", **options}).csv(path))

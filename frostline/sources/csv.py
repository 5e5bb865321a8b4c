"""CSV scans with database COPY semantics.

* header row, ``,`` separator, ``"`` quote and ``"`` as its own escape;
* quoted fields may span lines (``multiLine``);
* an unquoted empty field is NULL, a quoted empty field ``""`` is ''.
  Spark turns both into NULL by default; setting ``nullValue`` to a string
  that cannot occur makes only the unquoted empty field NULL;
* every column is read as text; malformed records are kept in a corrupt-record
  column so one bad member can be rejected without failing the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A value that cannot occur in a text file: it only keeps Spark's nullValue
# from matching the quoted empty string.
NULL_SENTINEL = "\u0000\u0001frostline-null\u0001\u0000"
CORRUPT = "_corrupt_record"

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "nullValue": NULL_SENTINEL,
    "emptyValue": "",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "enforceSchema": "true",
    "encoding": "UTF-8",
}


def text_schema(header: Sequence[str], corrupt: bool = True) -> T.StructType:
    fields = [T.StructField(h, T.StringType(), True) for h in header]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def read_text_csv(spark: SparkSession, paths: str | Sequence[str], header: Sequence[str] | None = None,
                  **options: str) -> DataFrame:
    """All-text CSV scan.  With ``header`` the schema is given (and a corrupt
    record column added: the caller must look at it).  Without it the files'
    header names the columns, and a file with another header or a record with
    more or fewer fields fails the scan: no field is lost without notice."""
    reader = spark.read.options(**{**CSV_OPTIONS, **options})
    if header is not None:
        reader = reader.schema(text_schema(header))
    else:
        reader = reader.options(inferSchema="false", mode="FAILFAST", enforceSchema="false")
    return reader.csv([paths] if isinstance(paths, str) else list(paths))


def whole_records(df: DataFrame) -> DataFrame:
    """The rows without the corrupt-record column; a malformed record fails the query."""
    fails = F.raise_error(F.concat(F.lit("malformed CSV record: "), F.col(CORRUPT))).cast("boolean")
    return df.filter(F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(fails)).drop(CORRUPT)


def parse_header(line: str) -> list[str]:
    """Column names of one CSV header line (metadata, parsed on the driver)."""
    import csv
    import io

    rows = list(csv.reader(io.StringIO(line)))
    return rows[0] if rows else []

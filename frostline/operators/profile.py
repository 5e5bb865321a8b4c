"""Column profiling and type narrowing in one aggregation pass.

``profile(df, table_name)`` computes, for every column at once, the non-null
count, how many values read as integer / float / boolean, and min/max, in a
single ``agg`` (map-side partial aggregation: one row per partition is
shuffled).  The one-row result is turned into one row per column with
``inline`` and narrowed with ``CASE`` expressions; nothing is collected.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.naming import clean_sql_name_text

# The text forms a CSV reader types as integer, float and
# boolean when it scans every row (no date parsing).
INT_PATTERN = r"^-?\d+\z"
FLOAT_PATTERN = r"^[-+]?((\d*\.\d+)([eE][-+]?\d+)?|inf|NaN|(\d+)[eE][-+]?\d+|\d+\.)\z"
BOOL_WORDS = ("true", "false")

# Database type bounds used for narrowing (inclusive).
SMALLINT_RANGE = (-32768, 32767)
INTEGER_RANGE = (-2147483648, 2147483647)

# Integers that 64 bits cannot hold.
WIDE_INTEGER, WIDE_BASE = "decimal(38,0)", "Decimal(38, 0)"

PROFILE_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("csv_name", T.StringType(), False),
    T.StructField("sql_name", T.StringType(), False),
    T.StructField("base_type", T.StringType(), False),
    T.StructField("is_nullable", T.BooleanType(), False),
    T.StructField("min_value", T.StringType(), True),
    T.StructField("max_value", T.StringType(), True),
    T.StructField("sql_type", T.StringType(), False),
    T.StructField("spark_type", T.StringType(), False),
    T.StructField("n_rows", T.LongType(), False),
    T.StructField("n_nulls", T.LongType(), False),
])

# Base type names of typed (non-text) input columns.
_TYPED_BASE = {
    T.ByteType: "Int8", T.ShortType: "Int16", T.IntegerType: "Int32", T.LongType: "Int64",
    T.FloatType: "Float32", T.DoubleType: "Float64", T.BooleanType: "Boolean",
    T.DateType: "Date", T.TimestampNTZType: "Datetime", T.TimestampType: "Datetime",
    T.ArrayType: "List", T.StructType: "Struct",
}


def sql_names(columns: list[str]) -> list[str]:
    """Cleaned names; two source columns that clean to one name are an error."""
    seen: dict[str, str] = {}
    out = []
    for c in columns:
        n = clean_sql_name_text(c)
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {c!r} both clean to {n!r}")
        seen[n] = c
        out.append(n)
    return out


def _col_stats(df: DataFrame, i: int, name: str, infer_strings: bool):
    """Aggregate expressions and the per-column struct built from them."""
    c = F.col(f"`{name}`")
    dtype = df.schema[name].dataType
    p = f"__c{i}_"
    aggs = [F.count(c).alias(p + "nn")]
    if isinstance(dtype, T.StringType) and infer_strings:
        # cheap tests first (And short-circuits); numbers are parsed only when
        # the text has their shape (a failed double parse is costly)
        looks_int = c.rlike(INT_PATTERN)
        looks_float = ~looks_int & c.rlike(FLOAT_PATTERN)
        as_long = F.when(looks_int, c.try_cast("bigint"))
        as_double = F.when(looks_int | looks_float, c.try_cast("double"))
        # integers beyond 64 bits, up to 38 digits
        as_wide = F.when(looks_int & as_long.isNull(), c.try_cast(WIDE_INTEGER))
        aggs += [
            F.count(as_wide).alias(p + "nw"), F.min(as_wide).alias(p + "minw"), F.max(as_wide).alias(p + "maxw"),
            F.count_if(looks_int & as_long.isNotNull()).alias(p + "ni"),
            F.count_if(looks_float).alias(p + "nf"),
            F.count_if((F.length(c) <= 5) & F.lower(c).isin(*BOOL_WORDS)).alias(p + "nb"),
            F.min(as_long).alias(p + "mini"), F.max(as_long).alias(p + "maxi"),
            F.min(as_double).alias(p + "minf"), F.max(as_double).alias(p + "maxf"),
        ]

        def finish(n_rows: Column) -> Column:
            nn, ni, nw, nf, nb = (F.col(p + s) for s in ("nn", "ni", "nw", "nf", "nb"))
            base = (F.when(nn == 0, F.lit("String"))
                    .when(ni == nn, F.lit("Int64"))
                    .when(ni + nw == nn, F.lit(WIDE_BASE))
                    .when(ni + nw + nf == nn, F.lit("Float64"))
                    .when(nb == nn, F.lit("Boolean"))
                    .otherwise(F.lit("String")))
            wide = [f(F.col(p + m + "i").cast(WIDE_INTEGER), F.col(p + m + "w")).cast("string")
                    for f, m in ((F.least, "min"), (F.greatest, "max"))]
            lo = (F.when(base == "Int64", F.col(p + "mini").cast("string"))
                  .when(base == WIDE_BASE, wide[0])
                  .when(base == "Float64", F.col(p + "minf").cast("string")))
            hi = (F.when(base == "Int64", F.col(p + "maxi").cast("string"))
                  .when(base == WIDE_BASE, wide[1])
                  .when(base == "Float64", F.col(p + "maxf").cast("string")))
            return base, lo, hi, nn
        return aggs, finish

    numeric = isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                                 T.FloatType, T.DoubleType, T.DecimalType))
    if numeric:
        aggs += [F.min(c).alias(p + "min"), F.max(c).alias(p + "max")]
    if isinstance(dtype, T.DecimalType):
        base_name = f"Decimal({dtype.precision}, {dtype.scale})"
    else:
        base_name = next((v for k, v in _TYPED_BASE.items() if isinstance(dtype, k)), "String")

    def finish_typed(n_rows: Column):
        lo = F.col(p + "min").cast("string") if numeric else F.lit(None).cast("string")
        hi = F.col(p + "max").cast("string") if numeric else F.lit(None).cast("string")
        return F.lit(base_name), lo, hi, F.col(p + "nn")
    return aggs, finish_typed


def narrow_sql_type(base: Column, lo: Column, hi: Column) -> Column:
    """Smallest database type holding the column (ranges inclusive)."""
    lo_l, hi_l = lo.try_cast("bigint"), hi.try_cast("bigint")
    in_range = lambda r: lo_l.isNotNull() & hi_l.isNotNull() & (lo_l >= r[0]) & (hi_l <= r[1])
    return (F.when(base.isin("Int8", "Int16", "UInt8"), F.lit("SMALLINT"))
            .when(base.isin("Int32", "UInt16"), F.lit("INTEGER"))
            .when((base == "Int64") & in_range(SMALLINT_RANGE), F.lit("SMALLINT"))
            .when((base == "Int64") & in_range(INTEGER_RANGE), F.lit("INTEGER"))
            .when(base.isin("Int64", "UInt32"), F.lit("BIGINT"))
            .when(base == "UInt64", F.lit("NUMERIC(20, 0)"))
            .when(base == "Float32", F.lit("REAL"))
            .when(base == "Float64", F.lit("DOUBLE PRECISION"))
            .when(base == "Boolean", F.lit("BOOLEAN"))
            .when(base == "Date", F.lit("DATE"))
            .when(base == "Datetime", F.lit("TIMESTAMP WITHOUT TIME ZONE"))
            .when(base == "Decimal", F.lit("NUMERIC"))
            .when(base.startswith("Decimal("),
                  F.concat(F.lit("NUMERIC"), F.regexp_extract(base, r"(\(.*\))", 1)))
            .when(base.isin("List", "Struct"), F.lit("JSONB"))
            .otherwise(F.lit("TEXT")))


def spark_type_of(sql_type: Column) -> Column:
    """Spark type name for a narrowed database type."""
    t = sql_type
    return (F.when(t == "SMALLINT", F.lit("smallint"))
            .when(t == "INTEGER", F.lit("int"))
            .when(t == "BIGINT", F.lit("bigint"))
            .when(t == "REAL", F.lit("float"))
            .when(t == "DOUBLE PRECISION", F.lit("double"))
            .when(t == "BOOLEAN", F.lit("boolean"))
            .when(t == "DATE", F.lit("date"))
            .when(t == "TIMESTAMP WITHOUT TIME ZONE", F.lit("timestamp_ntz"))
            .when(t.startswith("NUMERIC("),
                  F.concat(F.lit("decimal"), F.regexp_replace(F.regexp_extract(t, r"(\(.*\))", 1), " ", "")))
            .when(t == "NUMERIC", F.lit("decimal(38,10)"))
            .otherwise(F.lit("string")))


# Columns profiled per aggregation pass: keeps one pass's generated code within
# the JVM's method-size limits for wide tables (parquet reads only the pass's
# columns, so several passes read the data once in total).
COLUMNS_PER_PASS = 100


def _aggregates(df: DataFrame, cols: list[str], first: int, infer_strings: bool):
    """The aggregates of one pass, and per column what makes its row of them."""
    aggs = [F.count(F.lit(1)).alias("__n_rows")]
    finishers = []
    for i, c in enumerate(cols):
        a, fin = _col_stats(df, first + i, c, infer_strings)
        aggs += a
        finishers.append(fin)
    return aggs, finishers


def _column_rows(one: DataFrame, finishers, cols: list[str], names: list[str], first: int,
                 csv_names: dict[str, str]) -> DataFrame:
    """One row per column from the row of a pass's aggregates."""
    n_rows = F.col("__n_rows")
    structs = []
    for i, (c, n, fin) in enumerate(zip(cols, names, finishers)):
        base, lo, hi, nn = fin(n_rows)
        structs.append(F.struct(
            F.lit(first + i + 1).alias("ordinal"), F.lit(csv_names.get(c, c)).alias("csv_name"), F.lit(n).alias("sql_name"),
            base.alias("base_type"), (nn < n_rows).alias("is_nullable"),
            lo.alias("min_value"), hi.alias("max_value"),
            n_rows.alias("n_rows"), (n_rows - nn).alias("n_nulls")))
    return one.select(F.inline(F.array(*structs)))


def _profile_pass(df: DataFrame, cols: list[str], names: list[str], first: int,
                  infer_strings: bool, csv_names: dict[str, str]) -> DataFrame:
    aggs, finishers = _aggregates(df, cols, first, infer_strings)
    one = df.select(*[F.col(f"`{c}`") for c in cols]).agg(*aggs)
    return _column_rows(one, finishers, cols, names, first, csv_names)


class ObservedProfile:
    """The profile of rows as they are written: no scan of its own.

    ``rows`` are the input's rows; once an action has run over all of them,
    ``profile`` gives what ``profile()`` of the columns would, and ``extra`` the
    values of further aggregates.  The action must not run twice over a row, so
    write ``rows`` without a shuffle.
    """

    def __init__(self, df: DataFrame, columns: list[str], infer_strings: bool = True,
                 columns_per_pass: int = COLUMNS_PER_PASS, **extra: Column):
        self._spark, self._columns, self._names = df.sparkSession, list(columns), sql_names(columns)
        self._extra = Observation()
        self.rows = df.observe(self._extra, F.count(F.lit(1)).alias("n_rows"), *[e.alias(n) for n, e in extra.items()])
        self._passes = []
        for first in range(0, len(self._columns), columns_per_pass):
            cols = self._columns[first:first + columns_per_pass]
            aggs, finishers = _aggregates(df, cols, first, infer_strings)
            seen = Observation()
            self.rows = self.rows.observe(seen, *aggs)
            self._passes.append((first, cols, df.agg(*aggs).schema, finishers, seen))

    @property
    def extra(self) -> dict:
        return self._extra.get

    def profile(self, table_name: str, csv_names: dict[str, str] | None = None) -> DataFrame:
        parts = []
        for first, cols, schema, finishers, seen in self._passes:
            values = pa.Table.from_pylist([seen.get], schema=to_arrow_schema(schema))
            one = self._spark.createDataFrame(values, schema)
            parts.append(_column_rows(one, finishers, cols, self._names[first:first + len(cols)], first, csv_names or {}))
        if not parts:
            return self._spark.createDataFrame([], PROFILE_SCHEMA)
        return _with_types(reduce(DataFrame.unionByName, parts).withColumn("table_name", F.lit(table_name)))


def profile(df: DataFrame, table_name: str, infer_strings: bool = True,
            columns_per_pass: int = COLUMNS_PER_PASS, csv_names: dict[str, str] | None = None) -> DataFrame:
    """One row per column of ``df`` (see ``PROFILE_SCHEMA``), in column order.

    ``csv_names``: what columns are called in their source, where that differs.
    """
    cols = df.columns
    names = sql_names(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], PROFILE_SCHEMA)
    passes = [_profile_pass(df, cols[i:i + columns_per_pass], names[i:i + columns_per_pass], i,
                            infer_strings, csv_names or {})
              for i in range(0, len(cols), columns_per_pass)]
    rows = reduce(DataFrame.unionByName, passes)
    return _with_types(rows.withColumn("table_name", F.lit(table_name)))


def _with_types(rows: DataFrame) -> DataFrame:
    base_sql = narrow_sql_type(F.col("base_type"), F.col("min_value"), F.col("max_value"))
    return rows.select(
        "table_name", F.col("ordinal").cast("int").alias("ordinal"),
        "csv_name", "sql_name", "base_type", "is_nullable", "min_value", "max_value",
        F.concat(base_sql, F.when(F.col("is_nullable"), F.lit(" NULL")).otherwise(F.lit(" NOT NULL")))
         .alias("sql_type"),
        spark_type_of(base_sql).alias("spark_type"),
        F.col("n_rows").cast("bigint").alias("n_rows"), F.col("n_nulls").cast("bigint").alias("n_nulls"))


def merge_profiles(older: DataFrame, newer: DataFrame) -> DataFrame:
    """The profile of both inputs' rows together, without reading them again.

    Columns meet by table and cleaned name.  Each side's base type votes unless
    it has no values: integers and wide integers give wide integers, numbers of
    both kinds give floats, and anything else that differs gives text, so the
    result does not depend on the order of merging.  A column that one side
    lacks is null in all that side's rows.  Ranges of text columns are lost, as in
    ``profile``.
    """
    both = older.withColumn("side", F.lit(0)).unionByName(newer.withColumn("side", F.lit(1)))
    rows_of = both.groupBy("table_name", "side").agg(F.max("n_rows").alias("n")).groupBy("table_name").agg(F.sum("n").alias("n_rows"))
    votes = F.when(F.col("n_rows") > F.col("n_nulls"), F.col("base_type"))
    number = lambda kind: [f(F.col(c).try_cast(kind)) for f, c in ((F.min, "min_value"), (F.max, "max_value"))]
    double, wide = number("double"), number(WIDE_INTEGER)
    met = both.groupBy("table_name", "sql_name").agg(
        F.min("ordinal").alias("ordinal"), F.max_by("csv_name", "side").alias("csv_name"), F.collect_set(votes).alias("kinds"),
        F.sum(F.col("n_rows") - F.col("n_nulls")).alias("nn"),
        *(e.alias(n) for e, n in zip([*double, *wide], ("mind", "maxd", "minw", "maxw"))))
    only = lambda *names: F.size(F.array_except("kinds", F.array(*map(F.lit, names)))) == 0
    base = (F.when(F.size("kinds") == 0, "String").when(F.size("kinds") == 1, F.element_at("kinds", 1))
            .when(only("Int64", WIDE_BASE), WIDE_BASE).when(only("Int64", WIDE_BASE, "Float64"), "Float64").otherwise("String"))
    met = met.withColumn("base_type", base).join(rows_of, "table_name")

    def bound(side: str) -> Column:
        whole = F.col("base_type").isin("Int8", "Int16", "Int32", "Int64", WIDE_BASE)
        some = F.col("base_type").isin("Float32", "Float64") | F.col("base_type").startswith("Decimal(")
        return F.when(whole, F.col(side + "w").cast("string")).when(some, F.col(side + "d").cast("string"))

    return _with_types(met.select(
        "table_name", "ordinal", "csv_name", "sql_name", "base_type", (F.col("nn") < F.col("n_rows")).alias("is_nullable"),
        bound("min").alias("min_value"), bound("max").alias("max_value"), "n_rows", (F.col("n_rows") - F.col("nn")).alias("n_nulls")))


def schema_report(prof: DataFrame) -> DataFrame:
    """The six-column human report: names, source type, Yes/No, range, SQL type."""
    rng = F.when(F.col("min_value").isNotNull() & F.col("max_value").isNotNull(),
                 F.concat(F.lit("("), F.col("min_value"), F.lit(" to "), F.col("max_value"), F.lit(")"))
                 ).otherwise(F.lit("N/A"))
    return prof.select(
        F.col("csv_name").alias("CSV Name"), F.col("sql_name").alias("SQL Name"),
        F.col("base_type").alias("Polars Type"),
        F.when(F.col("is_nullable"), F.lit("Yes")).otherwise(F.lit("No")).alias("Nullable"),
        rng.alias("Value Range"), F.col("sql_type").alias("Optimal SQL Type"))


def typed(df: DataFrame, prof_rows: list) -> DataFrame:
    """Cast ``df`` to the profiled types under cleaned names (ANSI casts: a
    value that does not fit fails the job, like a failed bulk load).

    ``prof_rows`` are the collected profile rows: metadata, one per column.
    """
    by_name = {r["csv_name"]: r for r in prof_rows}
    return df.select(*[
        F.col(f"`{c}`").cast(by_name[c]["spark_type"]).alias(by_name[c]["sql_name"])
        for c in df.columns
    ])

"""DuckDB text for the profile, check, source and sink queries."""

from __future__ import annotations

INT_RE = r"-?\d+"
FLOAT_RE = r"[-+]?((\d*\.\d+)([eE][-+]?\d+)?|inf|NaN|(\d+)[eE][-+]?\d+|\d+\.)"

PART_TEXT = """pt AS (
  SELECT CAST(p_partkey AS VARCHAR) AS "P_PARTKEY", p_name AS "P_NAME",
    nullif(p_brand, 'Brand#1') AS "P-BRAND", p_type AS "P TYPE",
    CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice,
    CASE WHEN p_size > 25 THEN 'true' ELSE 'False' END AS is_big,
    CASE WHEN p_size > 40 THEN CAST(p_retailprice AS VARCHAR) ELSE CAST(p_size AS VARCHAR) END AS mixed,
    CAST(NULL AS VARCHAR) AS empty_col
  FROM part)"""

PART_COLUMNS = [("P_PARTKEY", "p_partkey"), ("P_NAME", "p_name"), ("P-BRAND", "p_brand"),
                ("P TYPE", "p_type"), ("p_size", "p_size"), ("p_retailprice", "p_retailprice"),
                ("is_big", "is_big"), ("mixed", "mixed"), ("empty_col", "empty_col")]


def _stats(i: int, csv: str, sql: str) -> str:
    c = f'"{csv}"'
    return f"""SELECT {i} AS ordinal, '{csv}' AS csv_name, '{sql}' AS sql_name,
    count(*) AS n_rows, count({c}) AS nn,
    count(*) FILTER (WHERE regexp_full_match({c}, '{INT_RE}') AND TRY_CAST({c} AS BIGINT) IS NOT NULL) AS ni,
    count(*) FILTER (WHERE regexp_full_match({c}, '{FLOAT_RE}')) AS nf,
    count(*) FILTER (WHERE lower({c}) IN ('true', 'false')) AS nb,
    min(TRY_CAST({c} AS BIGINT)) AS mini, max(TRY_CAST({c} AS BIGINT)) AS maxi,
    min(TRY_CAST({c} AS DOUBLE)) AS minf, max(TRY_CAST({c} AS DOUBLE)) AS maxf
  FROM pt"""


PART_PROFILE = "WITH " + PART_TEXT + ",\nst AS (\n" + "\n  UNION ALL\n".join(
    _stats(i + 1, csv, sql) for i, (csv, sql) in enumerate(PART_COLUMNS)) + """),
b AS (SELECT *, CASE WHEN nn = 0 THEN 'String' WHEN ni = nn THEN 'Int64'
                     WHEN ni + nf = nn THEN 'Float64' WHEN nb = nn THEN 'Boolean'
                     ELSE 'String' END AS base_type FROM st),
r AS (SELECT *,
    CASE base_type WHEN 'Int64' THEN CAST(mini AS VARCHAR) WHEN 'Float64' THEN CAST(minf AS VARCHAR) END AS min_value,
    CASE base_type WHEN 'Int64' THEN CAST(maxi AS VARCHAR) WHEN 'Float64' THEN CAST(maxf AS VARCHAR) END AS max_value,
    nn < n_rows AS is_nullable FROM b),
t AS (SELECT *, CASE
      WHEN base_type = 'Int64' AND mini >= -32768 AND maxi <= 32767 THEN 'SMALLINT'
      WHEN base_type = 'Int64' AND mini >= -2147483648 AND maxi <= 2147483647 THEN 'INTEGER'
      WHEN base_type = 'Int64' THEN 'BIGINT'
      WHEN base_type = 'Float64' THEN 'DOUBLE PRECISION'
      WHEN base_type = 'Boolean' THEN 'BOOLEAN'
      ELSE 'TEXT' END AS base_sql FROM r)
SELECT 'part' AS table_name, CAST(ordinal AS INTEGER) AS ordinal, csv_name, sql_name, base_type, is_nullable,
  min_value, max_value,
  base_sql || CASE WHEN is_nullable THEN ' NULL' ELSE ' NOT NULL' END AS sql_type,
  CASE base_sql WHEN 'SMALLINT' THEN 'smallint' WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint'
    WHEN 'DOUBLE PRECISION' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'string' END AS spark_type,
  n_rows, n_rows - nn AS n_nulls
FROM t"""


# The same profile with one more column, of integers up to 38 digits.
_WIDE = (PART_PROFILE.replace("CAST(NULL AS VARCHAR) AS empty_col\n", "CAST(NULL AS VARCHAR) AS empty_col, "
                              "CAST(p_partkey AS VARCHAR) || repeat('0', 18) AS wide\n")
         .replace("\n  FROM pt)", "\n  FROM pt\n  UNION ALL\n" + _stats(len(PART_COLUMNS) + 1, "wide", "wide") + ")")
         .replace("AS BIGINT) IS NOT NULL", "AS HUGEINT) IS NOT NULL").replace("AS BIGINT)) AS m", "AS HUGEINT)) AS m")
         .replace("WHEN ni = nn THEN 'Int64'", "WHEN ni = nn AND (mini < -9223372036854775808 OR maxi > 9223372036854775807) "
                                               "THEN 'Decimal(38, 0)' WHEN ni = nn THEN 'Int64'")
         .replace("CASE base_type WHEN 'Int64'", "CASE replace(base_type, 'Decimal(38, 0)', 'Int64') WHEN 'Int64'")
         .replace("WHEN base_type = 'Boolean'", "WHEN base_type = 'Decimal(38, 0)' THEN 'NUMERIC(38, 0)' WHEN base_type = 'Boolean'")
         .replace("WHEN 'BOOLEAN' THEN", "WHEN 'NUMERIC(38, 0)' THEN 'decimal(38,0)' WHEN 'BOOLEAN' THEN"))


def _from_profile(select: str) -> str:
    return f"SELECT {select} FROM ({PART_PROFILE}) AS prof"


_WS = "'^[\\s\\v]+|[\\s\\v]+$'"

ORACLE_SQL: dict[str, str] = {
    "prf_profile": PART_PROFILE,
    "prf_merge": _WIDE,
    "prf_base_type": _from_profile("ordinal, csv_name, base_type, is_nullable"),
    "prf_narrow_types": _from_profile("csv_name, sql_name, sql_type, spark_type"),
    "prf_report": _from_profile(
        "csv_name AS \"CSV Name\", sql_name AS \"SQL Name\", base_type AS \"Polars Type\", "
        "CASE WHEN is_nullable THEN 'Yes' ELSE 'No' END AS \"Nullable\", "
        "CASE WHEN min_value IS NOT NULL AND max_value IS NOT NULL "
        "THEN '(' || min_value || ' to ' || max_value || ')' ELSE 'N/A' END AS \"Value Range\", "
        "sql_type AS \"Optimal SQL Type\""),
    "chk_primary_key": ("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey "
                        "HAVING count(*) > 1 OR l_orderkey IS NULL"),
    "chk_not_null": ("WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, "
                     "nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders) "
                     "SELECT 'o_orderkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS n_violations FROM o "
                     "UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM o "
                     "UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM o"),
    "chk_truncated_header": (
        f"WITH h AS (SELECT doc_id, length(regexp_replace(split_part(text, chr(10), 1), {_WS}, '', 'g')) AS n "
        f"FROM documents) SELECT doc_id, n AS header_length, n = 1024 AS truncated FROM h"),
}

ORDERS_LOADED = ("CAST(o_orderkey AS SMALLINT) AS o_orderkey, CAST(o_custkey AS SMALLINT) AS o_custkey, "
                 "o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate")
ORDERS_TEXT = ("CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
               "o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, "
               "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority")
STRIP = "regexp_replace({x}, '^[\\s\\v]+|[\\s\\v]+$', '', 'g')"


def _repaired(x: str) -> str:
    return STRIP.format(x=f"replace({x}, '\\\"', '\"\"')")


def _clustered() -> str:
    from .oracle import LF, demo_cte, with_

    return with_(LF, demo_cte()) + "SELECT * FROM demo"


def _listed() -> str:
    from .catalogue_io import LISTED

    return f"SELECT * FROM ({_clustered()}) AS c WHERE patno IN ({', '.join(map(str, LISTED))})"


def _from_main(name: str) -> str:
    from .oracle import ORACLE_SQL as MAIN

    return MAIN[name]


ORACLE_SQL.update({
    "overlay_code_list_csv": _from_main("overlay_code_list"),
    "catalog_page_pairs": _from_main("ident_page_pairs"),
    "snk_clustered": _clustered(),
    "snk_participant_rows": _listed(),
    "snk_external": f"SELECT {ORDERS_LOADED}, o_orderpriority FROM orders",
    "src_archive": f"SELECT {ORDERS_TEXT} FROM orders",
    "snk_create_load": f"SELECT {ORDERS_LOADED}, o_orderpriority FROM orders",
    "src_member_filter": (f"SELECT {ORDERS_LOADED} FROM orders "
                          f"WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"),
    "src_csv_scan": ("SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, text, "
                     "CASE WHEN lang = 'en' THEN '' WHEN lang = 'de' THEN NULL ELSE source END AS note "
                     "FROM documents"),
    "src_multi_file": ("SELECT CAST(c_custkey AS SMALLINT) AS c_custkey, c_name, "
                       "CAST(c_nationkey AS SMALLINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"),
    "src_cp1252_decode": "SELECT doc_id, text FROM documents",
    "src_quote_repair": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text FROM documents",
    "src_file_patch": (f"SELECT doc_id, CASE WHEN lang = 'en' THEN replace({_repaired('text')}, ' the ', ' THE ') "
                       f"ELSE {_repaired('text')} END AS text FROM documents"),
    "snk_export_csv": ("SELECT \"P_PARTKEY\" AS p_partkey, \"P_NAME\" AS p_name, \"P-BRAND\" AS p_brand, "
                       "\"P TYPE\" AS p_type, p_size, p_retailprice, is_big, mixed, empty_col FROM ("
                       + PART_TEXT[len("pt AS ("):-1] + ")"),
    "log_load_audit": ("SELECT 'orders' AS table_name, o_orderpriority AS member_key, count(*) AS n_rows, "
                       "'loaded' AS status FROM orders GROUP BY o_orderpriority "
                       "UNION ALL SELECT 'nation', NULL, NULL, 'error' "
                       "UNION ALL SELECT NULL, NULL, NULL, 'skipped' "
                       "UNION ALL SELECT NULL, NULL, NULL, 'not_found'"),
})

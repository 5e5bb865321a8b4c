"""DuckDB text of every registered query, for the side-by-side correctness check.

Written independently of the Spark code: lookups are correlated scalar
subqueries, "items having more than one" are ``IN (... HAVING)``, positions are
``row_number()`` windows.  The small ``sql_*`` helpers only build SQL text.
"""

from __future__ import annotations

# ------------------------------------------------------------------ helpers


def sql_mm(x: str) -> str:
    """MM/YYYY -> YYYY-MM (other text unchanged) in DuckDB."""
    return (f"CASE WHEN NOT regexp_full_match({x}, '\\d{{2}}/\\d{{4}}') THEN {x} "
            f"ELSE strftime(strptime({x}, '%m/%Y'), '%Y-%m') END")


def sql_month(ts: str) -> str:
    return f"strftime({ts}, '%m/%Y')"


def sql_bool(x: str) -> str:
    words_true = "'t','tr','tru','true','y','ye','yes','on','1'"
    words_false = "'f','fa','fal','fals','false','n','no','of','off','0'"
    v = f"lower(trim({x}))"
    return f"CASE WHEN {v} IN ({words_true}) THEN true WHEN {v} IN ({words_false}) THEN false END"


def sql_tags(flags: dict[str, str]) -> str:
    parts = ", ".join(f"CASE WHEN coalesce({c}, 0) = 1 THEN '{tag}' END"
                      for tag, c in sorted(flags.items()))
    return f"nullif(concat_ws(',', {parts}), '')"


def sql_lookup(module: str, item: str, code: str, out: str = "code") -> str:
    return (f"(SELECT min(clv.{out}) FROM clv WHERE clv.mod_name = {module} "
            f"AND clv.itm_name = '{item}' AND clv.code = {code})")


def sql_num_text(x: str) -> str:
    return (f"CASE WHEN {x} = floor({x}) AND abs({x}) < 9e18 "
            f"THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END")


def sql_clean(x: str) -> str:
    return (f"nullif(trim(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9_]+', '_', 'g'), "
            f"'_+', '_', 'g'), '_'), '')")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CL = """cl AS (
  SELECT DISTINCT o_orderpriority AS mod_name, 'STATUS' AS itm_name, o_orderstatus AS code,
    CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS decode,
    CAST(NULL AS VARCHAR) AS mapping_notes
  FROM orders
  UNION ALL
  SELECT p_brand, 'SIZE', CAST(p_size AS VARCHAR), min(p_type), 'parts=' || CAST(count(*) AS VARCHAR)
  FROM part GROUP BY p_brand, p_size)"""

OV = """ov AS (SELECT * FROM (VALUES
    ('1-URGENT', 'STATUS', 'F', 'Fulfilled', CAST(NULL AS VARCHAR)),
    ('2-HIGH', 'STATUS', 'O', CAST(NULL AS VARCHAR), 'label kept'),
    ('9-NONE', 'STATUS', 'X', 'Unknown', CAST(NULL AS VARCHAR)),
    ('Brand#1', 'SIZE', '1', 'TINY', 'resized'),
    ('Brand#2', 'SIZE', '10', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR))
  ) AS v(mod_name, itm_name, code, decode, mapping_notes))"""

CLV = """clv AS (
  SELECT cl.mod_name, cl.itm_name, cl.code, coalesce(ov.decode, cl.decode) AS decode,
         coalesce(ov.mapping_notes, cl.mapping_notes) AS mapping_notes
  FROM cl LEFT JOIN ov ON cl.mod_name = ov.mod_name AND cl.itm_name = ov.itm_name
                      AND cl.code = ov.code)"""

DD = """dd AS (
  SELECT p_brand AS mod_name, p_type AS itm_name, min(p_name) AS dscr,
         CAST(NULL AS VARCHAR) AS mapping_notes
  FROM part GROUP BY p_brand, p_type
  UNION ALL
  SELECT p_brand, 'SIZE', 'Size ' || CAST(min(p_size) AS VARCHAR) || ' to ' || CAST(max(p_size) AS VARCHAR),
         CAST(NULL AS VARCHAR)
  FROM part GROUP BY p_brand
  UNION ALL SELECT DISTINCT p_brand, 'PAG_NAME', 'Page name', CAST(NULL AS VARCHAR) FROM part
  UNION ALL SELECT DISTINCT p_brand, '-', 'No item', CAST(NULL AS VARCHAR) FROM part
  UNION ALL SELECT DISTINCT p_brand, 'NOTE', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM part)"""

DDO = """ddo AS (SELECT * FROM (VALUES
    ('Brand#1', 'SIZE', 'Overlaid size range', 'from overlay'),
    ('Brand#2', 'NOTE', CAST(NULL AS VARCHAR), 'notes only'),
    ('Brand#99', 'SIZE', 'orphan', CAST(NULL AS VARCHAR))
  ) AS v(mod_name, itm_name, dscr, mapping_notes))"""

LF = """lf AS (
  SELECT *,
    CAST(l_quantity > 30 AS INTEGER) AS f_qty,
    CAST(l_tax > 0.04 AS INTEGER) AS f_tax,
    CAST(l_discount > 0.05 AS INTEGER) AS f_disc,
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_returnflag = 'R' AS INTEGER) END AS f_ret,
    CAST(l_linestatus = 'O' AS INTEGER) AS f_open,
    CAST(l_quantity < 10 AS INTEGER) AS f_small,
    CAST(l_tax = 0 AS INTEGER) AS f_notax,
    CAST(l_shipdate >= TIMESTAMP '2000-01-01' AS INTEGER) AS f_late
  FROM lineitem)"""

SHARED = """s AS (
  SELECT itm_name, lower(dscr) AS dscr, count(mod_name) AS n_mod_names,
         string_agg(mod_name, ', ' ORDER BY mod_name) AS mod_names
  FROM dd WHERE regexp_matches(itm_name, '\\w') GROUP BY 1, 2)"""

SUMMARY = """cls AS (
  SELECT itm_name, mod_name, string_agg(code || '=' || lower(decode), ',' ORDER BY code) AS code_mapping
  FROM cl WHERE itm_name NOT IN ('PAG_NAME') GROUP BY 1, 2)"""

SHARED_DEFS = """sh AS (
  SELECT itm_name, count(mod_name) AS n_mod_names,
         string_agg(mod_name, ', ' ORDER BY mod_name) AS mod_names, code_mapping
  FROM cls GROUP BY itm_name, code_mapping)"""

PAIRS = """pairs AS (
  SELECT DISTINCT 'customer' AS table_name, CAST(c_nationkey AS VARCHAR) AS pag_name FROM customer
  UNION ALL SELECT DISTINCT 'nation', CAST(n_nationkey AS VARCHAR) FROM nation
  UNION ALL SELECT DISTINCT 'supplier', CAST(s_nationkey AS VARCHAR) FROM supplier)"""

GENES = {"PINK1": "f_qty", "PRKN": "f_tax", "SRDC": "f_disc", "HPSM": "f_ret",
         "RBD": "f_open", "LRRK2": "f_small", "SNCA": "f_notax", "GBA": "f_late"}
SYMPTOMS = {"TREMOR": "f_qty", "RIGID": "f_tax", "BRADY": "f_disc", "POSINS": "f_ret",
            "OTHSX": "f_open"}


def _race(cols_labels: list[tuple[str, str]]) -> str:
    total = " + ".join(c for c, _ in cols_labels)
    firsts = " ".join(f"WHEN {c} = 1 THEN {lbl}" for c, lbl in cols_labels)
    return (f"CASE WHEN ({total}) = 0 THEN 'Decline to Answer' "
            f"WHEN ({total}) > 1 THEN 'Two or More Races' "
            f"ELSE CASE {firsts} ELSE NULL END END")


def demo_cte() -> str:
    return f"""demo AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS rec_id,
         l_orderkey AS patno, {sql_month('l_shipdate')} AS infodt,
         f_qty AS aficberb, f_tax AS ashkjew, f_disc AS basque,
         {sql_month('o_orderdate')} AS birthdt, o_orderstatus AS sex,
         l_linenumber AS howlive, l_linenumber AS handed, l_linestatus AS hisplat,
         f_qty AS raasian, f_tax AS rablack, f_disc AS rahawopi, f_ret AS raindals,
         f_open AS ranos, f_small AS rawhite, f_notax AS raunknown,
         CASE WHEN o_orderstatus = 'P' THEN 'UNK' ELSE {sql_month('l_shipdate')} END AS orig_entry,
         l_shipdate AS last_update
  FROM lf JOIN orders ON l_orderkey = o_orderkey)"""


def _demographics() -> str:
    demo = demo_cte()
    se = "se AS (SELECT l_orderkey AS patno, l_quantity / 4 AS educyrs FROM lineitem)"
    race_items = [("raasian", "Brand#1"), ("rablack", "Brand#2"), ("rahawopi", "Brand#3"),
                  ("raindals", "Brand#4"), ("ranos", "Brand#5"), ("rawhite", "Brand#6"),
                  ("raunknown", "Brand#7")]
    race = _race([(c, sql_lookup(f"'{m}'", "SIZE", "'1'")) for c, m in race_items])

    def lk(col, module, item):
        return sql_lookup(f"'{module}'", item, f"CAST(d.{col} AS VARCHAR)")

    return with_(CL, OV, CLV, LF, demo, se) + f"""SELECT d.rec_id, d.patno, d.infodt,
  {sql_bool(lk('aficberb', 'Brand#1', 'SIZE'))} AS aficberb,
  {sql_bool(lk('ashkjew', 'Brand#1', 'SIZE'))} AS ashkjew,
  {sql_bool(lk('basque', 'Brand#1', 'SIZE'))} AS basque,
  {sql_mm('d.birthdt')} AS birthdt,
  {lk('sex', '1-URGENT', 'STATUS')} AS sex,
  {lk('howlive', 'Brand#2', 'SIZE')} AS gender,
  {lk('handed', 'Brand#3', 'SIZE')} AS handed,
  {lk('hisplat', '2-HIGH', 'STATUS')} AS ethnicity,
  {race} AS race,
  {sql_mm('d.orig_entry')} AS orig_entry,
  d.last_update,
  (SELECT max(CAST(round_even(se.educyrs, 0) AS SMALLINT)) FROM se WHERE se.patno = d.patno) AS educyrs
FROM demo d"""


def _participant_status() -> str:
    genes = {"PINK1": "enrlpink1", "PRKN": "enrlprkn", "SRDC": "enrlsrdc", "HPSM": "enrlhpsm",
             "RBD": "enrlrbd", "LRRK2": "enrllrrk2", "SNCA": "enrlsnca", "GBA": "enrlgba"}
    ps = f"""ps AS (
  SELECT o_orderkey AS patno, o_orderpriority AS cohort_definition,
    {sql_month('o_orderdate')} AS enroll_date, o_orderstatus AS enroll_status,
    CASE WHEN o_orderstatus = 'P' THEN 'UNK' ELSE {sql_month('o_orderdate')} END AS status_date,
    o_custkey AS screenedam4, o_totalprice AS enroll_age, o_orderpriority AS inexpage,
    CAST(o_totalprice > 300000 AS INTEGER) AS av133stdy,
    CAST(o_orderstatus = 'F' AS INTEGER) AS taustdy,
    CAST(o_orderstatus = 'O' AS INTEGER) AS gaitstdy,
    CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS pistdy,
    CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS sv2astdy,
    {sql_month('o_orderdate')} AS datelig, o_orderstatus AS ppmi_online_enroll,
    CAST(o_totalprice > 300000 AS INTEGER) AS enrlpink1,
    CAST(o_orderstatus = 'F' AS INTEGER) AS enrlprkn,
    CAST(o_orderstatus = 'O' AS INTEGER) AS enrlsrdc,
    CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS enrlhpsm,
    CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS enrlrbd,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_totalprice < 100000 AS INTEGER) END AS enrllrrk2,
    CAST(o_custkey < 100 AS INTEGER) AS enrlsnca,
    CAST(o_orderdate >= TIMESTAMP '1998-01-01' AS INTEGER) AS enrlgba
  FROM orders)"""
    return with_(ps) + f"""SELECT patno, cohort_definition, {sql_mm('enroll_date')} AS enroll_date,
  enroll_status, {sql_mm('status_date')} AS status_date, screenedam4, enroll_age, inexpage,
  av133stdy, taustdy, gaitstdy, pistdy, sv2astdy, datelig, ppmi_online_enroll,
  {sql_tags(genes)} AS mutations, CAST(NULL AS VARCHAR) AS subgroup
FROM ps"""


def _diagnosis_history() -> str:
    h = f"""h AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS rec_id,
    l_orderkey AS patno, l_linestatus AS event_id, p_brand AS pag_name,
    {sql_month('l_shipdate')} AS infodt,
    CASE WHEN l_returnflag = 'A' THEN 'UNK' ELSE {sql_month('l_shipdate')} END AS sxdt,
    CASE WHEN l_linestatus = 'F' THEN NULL ELSE {sql_month('l_shipdate')} END AS pddxdt,
    {sql_month('l_shipdate')} AS orig_entry,
    f_qty AS dxtremor, f_tax AS dxrigid, f_disc AS dxbrady, f_ret AS dxposins, f_open AS dxothsx,
    l_linenumber AS domside
  FROM lf LEFT JOIN part ON l_partkey = p_partkey)"""
    symptoms = {"TREMOR": "dxtremor", "RIGID": "dxrigid", "BRADY": "dxbrady",
                "POSINS": "dxposins", "OTHSX": "dxothsx"}
    return with_(CL, OV, CLV, LF, h) + f"""SELECT rec_id, patno, event_id, {sql_mm('infodt')} AS infodt,
  {sql_mm('sxdt')} AS sxdt, {sql_mm('pddxdt')} AS pddxdt, {sql_tags(symptoms)} AS dx_symptoms,
  {sql_lookup('h.pag_name', 'SIZE', 'CAST(h.domside AS VARCHAR)')} AS domside,
  {sql_mm('orig_entry')} AS orig_entry
FROM h"""


def _mm_input() -> str:
    return (f"r AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'UNK' "
            f"WHEN o_orderpriority = '5-LOW' THEN NULL ELSE {sql_month('o_orderdate')} END AS raw "
            f"FROM orders)")


def _table_name(x: str) -> str:
    name = f"regexp_extract({x}, '([^/]*)/*$', 1)"
    stem = (f"CASE WHEN regexp_full_match({name}, '.+\\.[^.]+') "
            f"THEN regexp_extract({name}, '^(.+)\\.[^.]+$', 1) ELSE {name} END")
    return f"regexp_replace({sql_clean(stem)}, '_[0-9]{{8}}$', '')"


URL_CSV = "(url || '_20250401.csv')"
_BLANK = "' ' || chr(9) || chr(13) || chr(10)"


def _blank_to_null(c: str) -> str:
    return f"CASE WHEN trim({c}, {_BLANK}) = '' THEN NULL ELSE {c} END AS {c}"


ORACLE_SQL: dict[str, str] = {
    "view_demographics": _demographics(),
    "view_participant_status": _participant_status(),
    "view_diagnosis_history": _diagnosis_history(),
    "fn_mm_yyyy": with_(_mm_input()) + f"SELECT o_orderkey, raw, {sql_mm('raw')} AS yyyy_mm FROM r",
    "fn_safe_boolean": (f"SELECT l_orderkey, l_linenumber, l_returnflag, "
                        f"{sql_bool('l_returnflag')} AS as_boolean FROM lineitem"),
    "fn_flags_to_tags": with_(LF) + (f"SELECT l_orderkey, l_linenumber, {sql_tags(GENES)} AS mutations, "
                                     f"{sql_tags(SYMPTOMS)} AS dx_symptoms FROM lf"),
    "fn_one_hot_class": with_(LF) + "SELECT l_orderkey, l_linenumber, " + _race([
        ("f_qty", "'ASIAN'"), ("f_tax", "'BLACK'"), ("f_disc", "'HAWOPI'"), ("f_ret", "'INDALS'"),
        ("f_open", "'NOS'"), ("f_small", "'WHITE'"), ("f_notax", "'UNKNOWN'")]) + " AS race FROM lf",
    "fn_code_lookup": with_(CL, OV, CLV) + (
        "SELECT p_partkey, p_size, "
        + sql_lookup("'Brand#1'", "SIZE", "CAST(p.p_size AS VARCHAR)") + " AS looked_up FROM part p"),
    "fn_code_decode": with_(CL, OV, CLV) + (
        "SELECT p_partkey, p_size, "
        + sql_lookup("'Brand#1'", "SIZE", "CAST(p.p_size AS VARCHAR)", "decode")
        + " AS looked_up FROM part p"),
    "lookup_dynamic_module": with_(CL, OV, CLV) + (
        "SELECT o_orderkey, o_orderpriority, o_orderstatus, "
        + sql_lookup("o.o_orderpriority", "STATUS", "o.o_orderstatus", "decode")
        + " AS status_label FROM orders o"),
    "corr_scalar_max": ("SELECT o_orderkey, (SELECT max(CAST(round_even(l_quantity / 4, 0) AS SMALLINT)) "
                        "FROM lineitem WHERE l_orderkey = o.o_orderkey) AS max_qty FROM orders o"),
    "fn_clean_name": f"SELECT page_id, {sql_clean('url')} AS sql_name FROM pages",
    "fn_table_name": f"SELECT page_id, {_table_name(URL_CSV)} AS table_name FROM pages",
    "fn_dscr_name": ("SELECT page_id, lower(regexp_replace(regexp_replace(url, '[- ]', '_', 'g'), "
                     "'[()]', '', 'g')) AS table_name FROM pages"),
    "fn_strings": ("SELECT p_partkey, lower(p_name) AS name_lower, p_brand || '=' || lower(p_type) AS pair "
                   "FROM part"),
    "fn_casts": (f"SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 2, 0) AS SMALLINT) AS qty_smallint, "
                 f"{sql_num_text('l_quantity')} AS qty_text, {sql_num_text('(l_quantity / 2)')} AS half_text "
                 f"FROM lineitem"),
    "filter_regex": ("SELECT p_partkey, itm_name FROM (SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN ' ' "
                     "WHEN p_type = 'ECONOMY' THEN NULL ELSE p_type END AS itm_name FROM part) "
                     "WHERE regexp_matches(itm_name, '\\w')"),
    "filter_not_in": ("SELECT o_orderkey, priority FROM (SELECT o_orderkey, nullif(o_orderpriority, '3-MEDIUM') "
                      "AS priority FROM orders) WHERE priority NOT IN ('1-URGENT', '2-HIGH')"),
    "semi_having": ("SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE p_name IN "
                    "(SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1)"),
    "sort_nulls": ("SELECT o_orderkey, priority, price, row_number() OVER (ORDER BY priority ASC NULLS LAST, "
                   "price DESC NULLS FIRST, o_orderkey ASC) AS pos FROM (SELECT o_orderkey, "
                   "nullif(o_orderpriority, '3-MEDIUM') AS priority, CASE WHEN o_orderstatus = 'P' "
                   "THEN NULL ELSE o_totalprice END AS price FROM orders)"),
    "blanks_to_null": ("SELECT doc_id, " + ", ".join(_blank_to_null(c) for c in ("text", "lang", "source"))
                       + " FROM documents"),
    "overlay_code_list": with_(CL, OV, CLV) + "SELECT * FROM clv",
    "overlay_dictionary": with_(DD, DDO) + (
        "SELECT dd.mod_name, dd.itm_name, coalesce(ddo.dscr, dd.dscr) AS dscr, "
        "coalesce(ddo.mapping_notes, dd.mapping_notes) AS mapping_notes FROM dd LEFT JOIN ddo "
        "ON dd.mod_name = ddo.mod_name AND dd.itm_name = ddo.itm_name"),
    "shared_descriptions": with_(DD, SHARED) + "SELECT * FROM s",
    "ambiguous_items": with_(
        "dd AS (SELECT source AS mod_name, lang AS itm_name, text AS dscr FROM documents)", SHARED) + (
        "SELECT itm_name, substr(dscr, 0, 50) AS \"dscr (truncated)\", n_mod_names, mod_names FROM s "
        "WHERE itm_name IN (SELECT itm_name FROM s GROUP BY 1 HAVING count(*) > 1)"),
    "code_list_summary": with_(CL, SUMMARY) + "SELECT * FROM cls",
    "code_list_shared": with_(CL, SUMMARY, SHARED_DEFS) + "SELECT * FROM sh",
    "code_list_variable": with_(CL, SUMMARY, SHARED_DEFS) + (
        "SELECT * FROM sh WHERE itm_name IN (SELECT itm_name FROM sh GROUP BY 1 HAVING count(*) > 1)"),
    "mod_item_summary": with_(DD, CL, SUMMARY) + (
        "SELECT d.mod_name, d.itm_name, lower(d.dscr) AS dscr, cls.code_mapping FROM dd d "
        "LEFT JOIN cls ON d.mod_name = cls.mod_name AND d.itm_name = cls.itm_name "
        "WHERE regexp_matches(d.itm_name, '\\w') AND d.itm_name NOT IN ('PAG_NAME')"),
    "ident_page_pairs": with_(PAIRS) + "SELECT pag_name, table_name FROM pairs",
    "distinct_pairs": ("SELECT DISTINCT 'customer' AS table_name, CAST(c_nationkey AS VARCHAR) AS pag_name, "
                       "c_mktsegment AS segment FROM customer"),
    "table_pages": with_(PAIRS) + ("SELECT table_name, count(*) AS n, string_agg(pag_name, ', ' ORDER BY pag_name) "
                                   "AS pag_names FROM pairs GROUP BY 1"),
    "page_tables": with_(PAIRS) + ("SELECT pag_name, count(*) AS n, string_agg(table_name, ', ' ORDER BY table_name) "
                                   "AS table_names FROM pairs GROUP BY 1"),
}


def oracle_sql() -> dict[str, str]:
    from . import oracle_io

    published = {"snk_published_code_list": ORACLE_SQL["overlay_code_list"],  # a published view returns what its session view does
                 "snk_published_status": ORACLE_SQL["view_participant_status"]}
    return {**ORACLE_SQL, **oracle_io.ORACLE_SQL, **published}

"""Curated views as permanent catalog views: SQL text in a schema of their own.

``plans.publish`` makes session views, which end with the application.  The
views here are stored by the catalog as SQL text over the warehouse's tables,
under the names of the raw tables but in a second schema, with descriptions and
column comments; any later session of the catalog can read them.  Their columns
are fixed when they are made: a column added to a raw table does not show until
the views are made again.

The SQL states what ``plans.curated`` and ``operators.codes`` state as DataFrame
expressions; the constants are theirs, and a test holds each pair of views equal.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import BAD_MM_YYYY, FALSE_WORDS, MM_YYYY, TRUE_WORDS
from ..sinks.warehouse import Warehouse, _lit, _q
from ..sources.catalog import reference_code_list_overlay, reference_dictionary_overlay
from . import curated

# Descriptions of the views.
DESCRIPTIONS = {
    "code_list_v": "code list with overlay decodes and notes",
    "data_dictionary_v": "data dictionary with overlay descriptions and notes",
    "demographics": "demographics with codes looked up, race classified and years of education",
    "participant_status": "participant status with dates as YYYY-MM and enrolment flags as gene tags",
    "pd_diagnosis_history": "diagnosis history with dates as YYYY-MM and symptom flags as tags",
    "data_dict_shared_descriptions_v": "show items and descriptions shared across all mods (tables)",
}


class _Text:
    """SQL texts over the tables of one warehouse; views that read views find them in ``schema``."""

    def __init__(self, wh: Warehouse, schema: str, output: str):
        self.wh, self.schema, self.output = wh, schema, output

    def view(self, name: str) -> str:
        return f"{_q(self.schema)}.{_q(name)}"

    def key(self, table: str, column: str, alias: str) -> str:
        """A column as text, integral numbers without a fraction."""
        x = f"{alias}.{_q(column)}"
        if isinstance(self.wh.schema(table)[column].dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            return (f"CASE WHEN {x} = floor({x}) AND abs({x}) < 9.0E18D THEN CAST(CAST({x} AS BIGINT) AS STRING) "
                    f"ELSE CAST({x} AS STRING) END")
        return f"CAST({x} AS STRING)"

    @staticmethod
    def date(column: str) -> str:
        x = _q(column)
        return (f"CASE WHEN {x} RLIKE r'{BAD_MM_YYYY}' "
                f"THEN CAST(raise_error(concat('month out of range in MM/YYYY value: ', {x})) AS STRING) "
                f"ELSE regexp_replace({x}, r'{MM_YYYY}', '$2-$1') END AS {x}")

    @staticmethod
    def boolean(text: str) -> str:
        def words(of):
            return ", ".join(map(_lit, of))
        x = f"lower(btrim({text}, ' \\t\\n\\r\\u000b\\u000c'))"
        return f"CASE WHEN {x} IN ({words(TRUE_WORDS)}) THEN TRUE WHEN {x} IN ({words(FALSE_WORDS)}) THEN FALSE END"

    @staticmethod
    def tags(flags: Mapping[str, str]) -> str:
        marks = ", ".join(f"CASE WHEN coalesce({_q(flags[t])}, 0) = 1 THEN {_lit(t)} END" for t in sorted(flags))
        return f"nullif(concat_ws(',', {marks}), '')"

    def looked_up(self, module: str, item: str, code: str) -> str:
        return (f"(SELECT min({self.output}) FROM (SELECT CAST(code AS STRING) AS code, decode, mod_name, itm_name "
                f"FROM {self.view('code_list_v')}) l WHERE l.mod_name = {module} AND l.itm_name = {_lit(item)} "
                f"AND l.code = {code})")

    def overlaid(self, base: str, overlay: str, keys: list[str], values: list[str], blank: bool = False) -> str:
        def own(column: str) -> str:
            x = f"b.{_q(column)}"
            text = isinstance(self.wh.schema(base)[column].dataType, T.StringType)
            return f"CASE WHEN btrim({x}, ' \\t\\r\\n') = '' THEN NULL ELSE {x} END" if blank and text else x

        same = " AND ".join(f"CAST({own(k)} AS STRING) = CAST(o.{_q(k)} AS STRING)" for k in keys)
        columns = [*(f"{own(k)} AS {k}" for k in keys), *(f"coalesce(o.{v}, {own(v)}) AS {v}" for v in values)]
        return f"SELECT {', '.join(columns)} FROM {self.wh.name(base)} b LEFT JOIN {self.wh.name(overlay)} o ON {same}"

    def code_list(self) -> str:
        return self.overlaid("code_list_annotated", "_code_list_overlay", ["mod_name", "itm_name", "code"], ["decode", "mapping_notes"])

    def dictionary(self) -> str:
        return self.overlaid("data_dictionary_annotated", "_data_dictionary_overlay", ["mod_name", "itm_name"],
                             ["dscr", "mapping_notes"], blank=True)

    def shared_descriptions(self) -> str:
        # The dictionary's own rows, without the overlay, as the session view has them.
        blank = "CASE WHEN btrim({0}, ' \\t\\r\\n') = '' THEN NULL ELSE {0} END AS {0}"
        rows = f"SELECT {', '.join(map(blank.format, ('mod_name', 'itm_name', 'dscr')))} FROM {self.wh.name('data_dictionary_annotated')}"
        return (f"SELECT itm_name, lower(dscr) AS dscr, count(mod_name) AS n_mod_names, "
                f"listagg(mod_name, ', ') WITHIN GROUP (ORDER BY mod_name) AS mod_names "
                f"FROM ({rows}) WHERE itm_name RLIKE r'\\w' GROUP BY itm_name, lower(dscr)")

    def demographics(self) -> str:
        def coded(column: str) -> str:
            module, item = curated.DEMOGRAPHICS_LOOKUPS[column]
            return self.looked_up(_lit(module), item, self.key("demographics", column, "d"))

        total = " + ".join(f"d.{_q(c)}" for c, _ in curated.RACE_FLAGS)
        first = " ".join(f"WHEN d.{_q(c)} = 1 THEN {self.looked_up(_lit(m), i, _lit('1'))}" for c, (m, i) in curated.RACE_FLAGS)
        race = (f"CASE WHEN {total} = 0 THEN {_lit(curated.RACE_NONE)} WHEN {total} > 1 THEN {_lit(curated.RACE_MANY)} {first} END")
        return (f"SELECT d.rec_id, d.patno, d.infodt, "
                + "".join(f"{self.boolean(coded(c))} AS {c}, " for c in ("aficberb", "ashkjew", "basque"))
                + f"{self.date('birthdt')}, {coded('sex')} AS sex, {coded('howlive')} AS gender, {coded('handed')} AS handed, "
                  f"{coded('hisplat')} AS ethnicity, {race} AS race, {self.date('orig_entry')}, d.last_update, s.educyrs "
                  f"FROM {self.wh.name('demographics')} d LEFT JOIN (SELECT patno AS of_patno, "
                  f"max(CAST(bround(CAST(educyrs AS DOUBLE), 0) AS SMALLINT)) AS educyrs "
                  f"FROM {self.wh.name('socio_economics')} GROUP BY patno) s ON d.patno = s.of_patno")

    def participant_status(self) -> str:
        return (f"SELECT patno, cohort_definition, {self.date('enroll_date')}, enroll_status, {self.date('status_date')}, "
                "screenedam4, enroll_age, inexpage, av133stdy, taustdy, gaitstdy, pistdy, sv2astdy, datelig, ppmi_online_enroll, "
                f"{self.tags(curated.GENE_TAGS)} AS mutations, CAST(NULL AS STRING) AS subgroup "
                f"FROM {self.wh.name('participant_status')}")

    def diagnosis_history(self) -> str:
        domside = self.looked_up("d.pag_name", curated.DOMSIDE_ITEM, self.key("pd_diagnosis_history", "domside", "d"))
        return (f"SELECT rec_id, patno, event_id, {', '.join(map(self.date, ('infodt', 'sxdt', 'pddxdt')))}, "
                f"{self.tags(curated.SYMPTOM_TAGS)} AS dx_symptoms, {domside} AS domside, {self.date('orig_entry')} "
                f"FROM {self.wh.name('pd_diagnosis_history')} d")


def overlay_tables(wh: Warehouse, code_list: DataFrame | None = None, dictionary: DataFrame | None = None) -> None:
    """The overlay tables of the warehouse: given rows replace theirs; a missing table gets the shipped rows."""
    for table, given, shipped in (("_code_list_overlay", code_list, reference_code_list_overlay),
                                  ("_data_dictionary_overlay", dictionary, reference_dictionary_overlay)):
        made = not wh.exists(table)
        rows = given if given is not None else shipped(wh.spark) if made else None
        if made:
            wh.create_if_absent(table, rows.schema)
        if rows is not None:
            wh.overwrite(rows, table)


def create_views(wh: Warehouse, schema: str = "curated", output: str = "code", location: str | None = None) -> list[str]:
    """Create or replace every view whose source tables exist; returns their names.

    Column comments are the descriptions that ``data_dictionary_v`` has for the
    view's name (the module) and column (the item).
    """
    if output not in ("code", "decode"):
        raise ValueError("output must be 'code' or 'decode'")
    spark, text = wh.spark, _Text(wh, schema, output)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(schema)}" + (f" LOCATION {_lit(location)}" if location else ""))
    overlay_tables(wh)
    wanted: list[tuple[str, list[str], Callable[[], str]]] = [
        ("code_list_v", ["code_list_annotated"], text.code_list),
        ("data_dictionary_v", ["data_dictionary_annotated"], text.dictionary),
        ("data_dict_shared_descriptions_v", ["data_dictionary_annotated"], text.shared_descriptions),
        ("demographics", ["demographics", "socio_economics", "code_list_annotated"], text.demographics),
        ("participant_status", ["participant_status"], text.participant_status),
        ("pd_diagnosis_history", ["pd_diagnosis_history", "code_list_annotated"], text.diagnosis_history),
    ]
    made = []
    for name, sources, query in wanted:
        if all(map(wh.exists, sources)):
            sql = query()
            comments = _comments(wh, schema, name) if "data_dictionary_v" in made else {}
            columns = ", ".join(_q(c) + (f" COMMENT {_lit(comments[c])}" if c in comments else "") for c in spark.sql(sql).columns)
            spark.sql(f"CREATE OR REPLACE VIEW {text.view(name)} ({columns}) COMMENT {_lit(DESCRIPTIONS[name])} AS {sql}")
            made.append(name)
    return made


def _comments(wh: Warehouse, schema: str, name: str) -> dict[str, str]:
    """Descriptions of one module's items: a row for each column of a view."""
    rows = (wh.spark.table(f"{_q(schema)}.data_dictionary_v").where(F.lower("mod_name") == name.lower()).where("dscr IS NOT NULL")
            .groupBy(F.lower("itm_name").alias("c")).agg(F.min("dscr").alias("dscr")))
    return {r["c"]: r["dscr"] for r in rows.collect()}

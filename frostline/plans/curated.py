"""Curated views over the loaded freeze tables.

Each view is a ``DataFrame -> DataFrame`` function over tables with the
clinical column names.  Lookups share one keyed structure made of the (small) code
list; the per-participant aggregate is a partial aggregation joined back on
``patno``.  Nothing here is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import (flags_to_tags, mm_yyyy_to_yyyy_mm, number_text, one_hot_class,
                                 round_half_even_smallint, typed_null)
from ..operators.codes import CodeLookup

# Module, items and labels used by the demographics view.
SCREEN = "SCREEN"
DEMOGRAPHICS_LOOKUPS = {
    "aficberb": (SCREEN, "AFICBERB"),
    "ashkjew": (SCREEN, "ASHKJEW"),
    "basque": (SCREEN, "BASQUE"),
    "sex": (SCREEN, "SEX"),
    "howlive": (SCREEN, "HOWLIVE"),
    "handed": (SCREEN, "HANDED"),
    "hisplat": (SCREEN, "HISPLAT"),
}
RACE_FLAGS = (
    ("raasian", (SCREEN, "RAASIAN")),
    ("rablack", (SCREEN, "RABLACK")),
    ("rahawopi", (SCREEN, "RAHAWOPI")),
    ("raindals", (SCREEN, "RAINDALS")),
    ("ranos", (SCREEN, "RANOS")),
    ("rawhite", (SCREEN, "RAWHITE")),
    ("raunknown", (SCREEN, "RAUNKNOWN")),
)
RACE_NONE = "Decline to Answer"
RACE_MANY = "Two or More Races"

# Tag names and their flag columns.
GENE_TAGS = {
    "PINK1": "enrlpink1", "PRKN": "enrlprkn", "SRDC": "enrlsrdc", "HPSM": "enrlhpsm",
    "RBD": "enrlrbd", "LRRK2": "enrllrrk2", "SNCA": "enrlsnca", "GBA": "enrlgba",
}
SYMPTOM_TAGS = {
    "BRADY": "dxbrady", "OTHSX": "dxothsx", "POSINS": "dxposins", "RIGID": "dxrigid",
    "TREMOR": "dxtremor",
}
DOMSIDE_ITEM = "DOMSIDE"


def code_text(df: DataFrame, name: str) -> Column:
    """``col::text`` as the database prints it (integral doubles without .0)."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return number_text(F.col(name))
    return F.col(name).cast("string")


def demographics(demo: DataFrame, socio: DataFrame, code_list: DataFrame,
                 lookups: Mapping[str, tuple[str, str]] = DEMOGRAPHICS_LOOKUPS,
                 race_flags: Sequence[tuple[str, tuple[str, str]]] = RACE_FLAGS,
                 output: str = "code", on_bad_date: str = "error") -> DataFrame:
    """Demographics with coded columns looked up, dates as ``YYYY-MM``, race
    classified from one-hot flags and the largest ``educyrs`` per participant.

    ``on_bad_date``: what a well-formed date with month 00 or 13+ does
    (``error`` as the reference, ``null`` or ``pass``), see
    ``functions.scalars.mm_yyyy_to_yyyy_mm``."""
    lk = CodeLookup(code_list, output=output)
    df = lk.add_all(demo, [(f"__lk_{col}", module, item, code_text(demo, col))
                           for col, (module, item) in lookups.items()],
                    booleans=["__lk_aficberb", "__lk_ashkjew", "__lk_basque"])
    df = df.withColumn("__labels", lk.values([(module, item, "1") for _, (module, item) in race_flags]))
    race = one_hot_class([(F.col(c), F.col(f"__labels.k{n}")) for n, (c, _) in enumerate(race_flags)],
                         RACE_NONE, RACE_MANY)
    educ = (socio.groupBy("patno")
            .agg(F.max(round_half_even_smallint("educyrs")).alias("educyrs"))
            .withColumnRenamed("patno", "__se_patno"))
    df = df.join(educ, df["patno"] == educ["__se_patno"], "left")
    return df.select(
        "rec_id", "patno", "infodt",
        F.col("__lk_aficberb").alias("aficberb"),
        F.col("__lk_ashkjew").alias("ashkjew"),
        F.col("__lk_basque").alias("basque"),
        mm_yyyy_to_yyyy_mm("birthdt", on_bad_date).alias("birthdt"),
        F.col("__lk_sex").alias("sex"),
        F.col("__lk_howlive").alias("gender"),
        F.col("__lk_handed").alias("handed"),
        F.col("__lk_hisplat").alias("ethnicity"),
        race.alias("race"),
        mm_yyyy_to_yyyy_mm("orig_entry", on_bad_date).alias("orig_entry"),
        "last_update",
        "educyrs",
    )


def participant_status(status: DataFrame, gene_tags: Mapping[str, str] = GENE_TAGS,
                       on_bad_date: str = "error") -> DataFrame:
    """Participant status with dates as ``YYYY-MM`` and enrolment flags as a
    sorted gene tag list (NULL when none); ``subgroup`` is a typed NULL."""
    return status.select(
        "patno", "cohort_definition",
        mm_yyyy_to_yyyy_mm("enroll_date", on_bad_date).alias("enroll_date"),
        "enroll_status",
        mm_yyyy_to_yyyy_mm("status_date", on_bad_date).alias("status_date"),
        "screenedam4", "enroll_age", "inexpage", "av133stdy", "taustdy", "gaitstdy", "pistdy",
        "sv2astdy", "datelig", "ppmi_online_enroll",
        flags_to_tags(gene_tags).alias("mutations"),
        typed_null("string").alias("subgroup"),
    )


def diagnosis_history(history: DataFrame, code_list: DataFrame,
                      symptom_tags: Mapping[str, str] = SYMPTOM_TAGS,
                      domside_item: str = DOMSIDE_ITEM, output: str = "code",
                      on_bad_date: str = "error") -> DataFrame:
    """Diagnosis history: dates as ``YYYY-MM``, symptom flags as tags and the
    dominant side looked up in the module named by each row's ``pag_name``."""
    lk = CodeLookup(code_list, output=output)
    df = lk.add(history, "__lk_domside", F.col("pag_name"), domside_item,
                code_text(history, "domside"))
    return df.select(
        "rec_id", "patno", "event_id",
        mm_yyyy_to_yyyy_mm("infodt", on_bad_date).alias("infodt"),
        mm_yyyy_to_yyyy_mm("sxdt", on_bad_date).alias("sxdt"),
        mm_yyyy_to_yyyy_mm("pddxdt", on_bad_date).alias("pddxdt"),
        flags_to_tags(symptom_tags).alias("dx_symptoms"),
        F.col("__lk_domside").alias("domside"),
        mm_yyyy_to_yyyy_mm("orig_entry", on_bad_date).alias("orig_entry"),
    )

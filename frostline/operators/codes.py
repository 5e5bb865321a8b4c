"""Code lists, data dictionaries, overlays and code lookup.

A code list is ``(mod_name, itm_name, code) -> decode, mapping_notes``; a data
dictionary is ``(mod_name, itm_name) -> dscr, mapping_notes``.  Both are small
metadata tables; lookups share one keyed structure behind a bound on bytes.
A loaded code list may hold typed codes (all digits): keys are compared as text.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import as_col
from ..functions.scalars import number_text, safe_boolean

CODE_LIST_SCHEMA = T.StructType([
    T.StructField("mod_name", T.StringType(), False),
    T.StructField("itm_name", T.StringType(), False),
    T.StructField("code", T.StringType(), False),
    T.StructField("decode", T.StringType(), False),
    T.StructField("mapping_notes", T.StringType(), True),
])

DICTIONARY_SCHEMA = T.StructType([
    T.StructField("mod_name", T.StringType(), False),
    T.StructField("itm_name", T.StringType(), False),
    T.StructField("dscr", T.StringType(), True),
    T.StructField("mapping_notes", T.StringType(), True),
])

#: Bytes of a stored code list, with its overlay, that may be folded into one structure.
STRUCTURE_BYTES = 8 << 20
#: Maps of that structure: a look-up compares the keys of one of them.
BUCKETS = 256

_ids = itertools.count()


def nullable(schema: T.StructType) -> T.StructType:
    """The same schema with every field nullable (overlay data may hold NULLs
    that the declared NOT NULL forbids; CHK-2 reports them)."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def _tmp(label: str) -> str:
    return f"__{label}_{next(_ids)}"


def key_text(df: DataFrame, name: str) -> Column:
    """A key column as text, as the database prints it (1.0 is '1')."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
        return number_text(df[name])
    return df[name].cast("string")


def overlay_code_list(annotated: DataFrame, overlay: DataFrame) -> DataFrame:
    """``code_list_v``: annotated rows with overlay ``decode``/``mapping_notes``
    winning where not NULL.  Overlay-only rows never appear; duplicate overlay
    rows multiply their base row (left join semantics)."""
    keys = ["mod_name", "itm_name", "code"]
    o = overlay.select(*[key_text(overlay, k).alias(f"o_{k}") for k in keys],
                       F.col("decode").alias("o_decode"),
                       F.col("mapping_notes").alias("o_mapping_notes"))
    cond = [key_text(annotated, k) == o[f"o_{k}"] for k in keys]
    joined = annotated.join(o, cond, "left")
    return joined.select(
        annotated["mod_name"], annotated["itm_name"], annotated["code"],
        F.coalesce(F.col("o_decode"), annotated["decode"]).alias("decode"),
        F.coalesce(F.col("o_mapping_notes"), annotated["mapping_notes"]).alias("mapping_notes"),
    )


def overlay_dictionary(annotated: DataFrame, overlay: DataFrame) -> DataFrame:
    """``data_dictionary_v``: same rule on ``(mod_name, itm_name)``."""
    keys = ["mod_name", "itm_name"]
    o = overlay.select(*[key_text(overlay, k).alias(f"o_{k}") for k in keys],
                       F.col("dscr").alias("o_dscr"),
                       F.col("mapping_notes").alias("o_mapping_notes"))
    cond = [key_text(annotated, k) == o[f"o_{k}"] for k in keys]
    joined = annotated.join(o, cond, "left")
    return joined.select(
        annotated["mod_name"], annotated["itm_name"],
        F.coalesce(F.col("o_dscr"), annotated["dscr"]).alias("dscr"),
        F.coalesce(F.col("o_mapping_notes"), annotated["mapping_notes"]).alias("mapping_notes"),
    )


def _joint_key(module: Column, item: Column, code: Column) -> Column:
    """One text for the three keys; lengths in front keep it unambiguous.  NULL if any is."""
    return F.concat(F.length(module).cast("string"), F.lit(":"), F.length(item).cast("string"), F.lit(":"),
                    module, item, code)


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def keyed_structure(listed: DataFrame) -> Column:
    """``(key, text, flag)`` rows of distinct keys as a scalar subquery: an array of maps, by the key's bucket."""
    rows = listed.filter(F.col("key").isNotNull())
    in_bucket = rows.groupBy(_bucket(F.col("key")).alias("bucket")).agg(
        F.map_from_entries(F.collect_list(F.struct("key", F.struct("text", "flag")))).alias("codes"))
    whole = in_bucket.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "codes"))).alias("of"))
    return whole.select(F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.try_element_at("of", b))).scalar()


def lookup_table(code_list: DataFrame) -> DataFrame:
    """One row per (mod, item, code): several matches collapse to the smallest
    decode, like a scalar lookup that returns one row."""
    keys = ["mod_name", "itm_name", "code"]
    return (code_list.select(*[key_text(code_list, k).alias(k) for k in keys], "decode").groupBy(*keys)
            .agg(F.min("decode").alias("decode")))


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the stored tables a plan reads, as the planner knows them (no job runs)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


class CodeLookup:
    """Adds looked-up columns to a DataFrame.

    ``output='code'`` returns the matched code (the lookup as written in the
    reference validates a code); ``output='decode'`` returns the label.  Any NULL
    argument or no match gives NULL.

    All lookups of a view share one keyed structure: a scalar subquery folds the
    wanted slices of the de-duplicated code list into an array of ``BUCKETS``
    maps, and a key is sought in the map its hash points to.  The facts are
    neither shuffled nor joined.  That needs a code list whose stored tables have
    at most ``max_bytes``, which the planner knows without a job; beyond, or where
    it does not know, each lookup is a left join and the planner chooses how.
    """

    def __init__(self, code_list: DataFrame, output: str = "code", max_bytes: int = STRUCTURE_BYTES):
        if output not in ("code", "decode"):
            raise ValueError("output must be 'code' or 'decode'")
        self.table = lookup_table(code_list)
        self.output = output
        self.max_bytes = max_bytes

    @cached_property
    def small(self) -> bool:
        return stored_bytes(self.table) <= self.max_bytes

    def add_all(self, df: DataFrame, specs, output: str | None = None, booleans: Sequence[str] = ()) -> DataFrame:
        """``df`` plus one column per spec ``(alias, module, item, code)``.

        The columns in ``booleans`` are the looked-up text as a boolean, which is
        worked out on the code list's rows and not on those of ``df``.
        """
        specs = list(specs)
        out = output or self.output
        items = sorted({item for _, _, item, _ in specs})
        slices = self.table.filter(F.col("itm_name").isin(items))
        if all(isinstance(module, str) for _, module, _, _ in specs):
            slices = slices.filter(F.col("mod_name").isin(sorted({module for _, module, _, _ in specs})))
        listed = slices.select(_joint_key(F.col("mod_name"), F.col("itm_name"), F.col("code")).alias("key"),
                               F.col(out).alias("text"), safe_boolean(F.col(out)).alias("flag"))
        keys = [_joint_key(F.lit(module) if isinstance(module, str) else as_col(module).cast("string"), F.lit(item),
                           as_col(code).cast("string")) for _, module, item, code in specs]
        field = ["flag" if alias in booleans else "text" for alias, *_ in specs]
        if self.small:
            codes = keyed_structure(listed)
            return df.select(*df.columns, *[F.element_at(F.get(codes, _bucket(key)), key)[f].alias(alias)
                                            for key, f, (alias, *_) in zip(keys, field, specs)])
        for n, (alias, *_) in enumerate(specs):
            key = _tmp("key")
            right = listed.select(F.col("key").alias(key), F.col(field[n]).alias(alias))
            df = df.join(right, keys[n] == right[key], "left").drop(right[key])
        return df

    def add(self, df: DataFrame, alias: str, module, item: str, code,
            output: str | None = None) -> DataFrame:
        """``df`` plus column ``alias`` = lookup(module, item, code).

        ``module`` is a literal module name (str) or a Column (per-row module).
        ``code`` is a column name or Column; it is compared as text.
        """
        return self.add_all(df, [(alias, module, item, code)], output)

    def values(self, keys: list[tuple[str, str, str]], output: str | None = None) -> Column:
        """Constant lookups (e.g. the label of code '1' of several items): a
        struct ``k0, k1, ...`` from one scalar subquery over the code list, so a
        later label shows at once.  Give it a column of its own and take the
        fields from there: each mention of the struct is planned as a subquery."""
        out = output or self.output
        cond = F.lit(False)
        labels = []
        for n, (module, item, code) in enumerate(keys):
            hit = (F.col("mod_name") == module) & (F.col("itm_name") == item) & (F.col("code") == code)
            cond = cond | hit
            labels.append(F.max(F.when(hit, F.col(out))).alias(f"k{n}"))
        one = self.table.filter(cond).agg(*labels)
        return one.select(F.struct(*one.columns)).scalar()

"""Scalar functions of the curated views, as Catalyst expressions (no UDFs).

Every function takes column names or Columns and returns a Column, so they
stay inside whole-stage codegen and compose with the DataFrame and SQL APIs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# The text forms a database boolean cast accepts (after trim and
# lower case).  Unique prefixes of true/false/yes/no are accepted; "o" alone is
# ambiguous between on and off.
TRUE_WORDS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
FALSE_WORDS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")

MM_YYYY = r"^(0[1-9]|1[0-2])/(\d{4})\z"
BAD_MM_YYYY = r"^(00|1[3-9]|[2-9]\d)/\d{4}\z"


def mm_yyyy_to_yyyy_mm(c, on_bad: str = "error") -> Column:
    """``MM/YYYY`` -> ``YYYY-MM``; other text unchanged; NULL stays NULL.

    A well-formed value with a month outside 01..12 is an error in the
    reference's date parse.  ``on_bad`` picks what happens to it: ``error``
    (fail the query, as the reference does), ``null`` or ``pass`` (unchanged).
    """
    # Two patterns and few mentions of the value: a view converts many columns in
    # one generated method, which the JVM compiles only while it is small.
    x = as_col(c)
    converted = F.regexp_replace(x, MM_YYYY, "$2-$1")
    if on_bad == "error":
        bad = F.raise_error(F.concat(F.lit("month out of range in MM/YYYY value: "), x)).cast("string")
    elif on_bad == "null":
        bad = F.lit(None).cast("string")
    elif on_bad == "pass":
        return converted
    else:
        raise ValueError(f"on_bad must be error, null or pass, not {on_bad!r}")
    return F.when(x.rlike(BAD_MM_YYYY), bad).otherwise(converted)


def safe_boolean(c) -> Column:
    """Text to boolean with the database vocabulary; NULL when not a boolean."""
    x = F.lower(F.btrim(as_col(c).cast("string"), F.lit(" \t\n\r\x0b\f")))
    return (
        F.when(x.isin(*TRUE_WORDS), F.lit(True))
        .when(x.isin(*FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
    )


def flags_to_tags(flags: Mapping[str, object]) -> Column:
    """Names of the flags equal to 1 (NULL counts as 0), sorted, comma joined.

    ``flags`` maps a tag to its column.  No flag set gives NULL, not ''.
    """
    # The tags are constants, so they are sorted here and not for every row.
    marks = [F.when(F.coalesce(as_col(flags[tag]), F.lit(0)) == 1, F.lit(tag)) for tag in sorted(flags)]
    return F.nullif(F.concat_ws(",", *marks), F.lit(""))


def one_hot_class(flags: Sequence[tuple[object, Column]], none_label: str,
                  many_label: str) -> Column:
    """Classify one-hot flags: sum 0 -> ``none_label``; > 1 -> ``many_label``;
    else the label of the first flag equal to 1, in the given order.

    ``flags`` is a sequence of (column, label Column).  A NULL flag makes the
    sum NULL, which skips both counts and falls to the first-set rule.
    """
    cols = [as_col(c) for c, _ in flags]
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    first = None
    for c, label in flags:
        first = (F.when(as_col(c) == 1, label) if first is None
                 else first.when(as_col(c) == 1, label))
    first = first.otherwise(F.lit(None).cast("string"))
    return (
        F.when(total == 0, F.lit(none_label))
        .when(total > 1, F.lit(many_label))
        .otherwise(first)
    )


def pg_substr(c, start: int, length: int) -> Column:
    """``substr(x, start, length)`` with the SQL-standard window: positions
    before 1 count toward the length (``substr(x, 0, 50)`` keeps 49)."""
    end = start + length  # exclusive
    first = max(start, 1)
    return F.substring(as_col(c), first, max(end - first, 0))


def round_half_even_smallint(c) -> Column:
    """``::smallint`` of a number: round half to even, then a checked cast."""
    return F.bround(as_col(c).cast("double"), 0).cast("smallint")


def number_text(c) -> Column:
    """``::text`` of a number as the database prints it: integral values
    without a fraction (1.0 -> '1')."""
    x = as_col(c)
    integral = (x == F.floor(x)) & (F.abs(x) < F.lit(9.0e18))
    return F.when(integral, x.cast("bigint").cast("string")).otherwise(x.cast("string"))


def typed_null(type_name: str = "string") -> Column:
    return F.lit(None).cast(type_name)


def blank_to_null(c, chars: str = " \t\r\n") -> Column:
    """Blank text (only ``chars``) becomes NULL; other values are kept as is."""
    x = as_col(c)
    return F.when(F.btrim(x, F.lit(chars)) == "", F.lit(None).cast("string")).otherwise(x)


def blanks_to_null(df, columns: Sequence[str] | None = None):
    """Apply :func:`blank_to_null` to every (or the listed) string column."""
    targets = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.select(*[
        blank_to_null(F.col(f"`{n}`")).alias(n) if n in targets else F.col(f"`{n}`")
        for n in df.columns
    ])

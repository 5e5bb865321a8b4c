"""Identifier cleaning: column forms (Catalyst expressions) plus a driver twin
for header names, which are metadata and never data."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# What cannot stand in a name (an underscore parts words like any
# other character) and the freeze date suffix.
SEPARATOR = "[^a-z0-9]+"
DATE_SUFFIX = "_[0-9]{8}"
DSCR_SEPARATORS = "[- ]"
DSCR_DROPPED = "[()]"


def clean_sql_name_text(name: str) -> str:
    """Header twin of :func:`clean_sql_name`; raises when nothing is left."""
    words = [w for w in re.split(SEPARATOR, name.lower()) if w]
    if words:
        return "_".join(words)
    raise ValueError(f"no letter or digit to name anything by in {name!r}")


def clean_sql_name(c) -> Column:
    """The words of a name (letters and digits) in lower case, joined by ``_``.

    A name without words is NULL here (a data column cannot raise per row
    without failing the job); the header twin raises instead.
    """
    words = F.split(F.lower(as_col(c)), SEPARATOR)
    return F.nullif(F.array_join(F.array_remove(words, ""), "_"), F.lit(""))


def path_stem(c) -> Column:
    """Last path component without its last suffix (``pathlib`` rules)."""
    name = F.regexp_extract(as_col(c), r"([^/]*)/*\z", 1)
    # a suffix needs a non-empty stem before it and at least one character after the dot
    has_suffix = name.rlike(r"^.+\.[^.]+\z")
    return F.when(has_suffix, F.regexp_extract(name, r"^(.+)\.[^.]+\z", 1)).otherwise(name)


def table_name_from_path(c) -> Column:
    """Stem -> clean name -> drop a trailing ``_YYYYMMDD`` freeze date."""
    return F.regexp_replace(clean_sql_name(path_stem(c)), DATE_SUFFIX + r"\z", "")


def table_name_from_path_text(path: str) -> str:
    stem = re.sub(r"/+$", "", path).rsplit("/", 1)[-1]
    m = re.match(r"^(.+)\.[^.]+$", stem, flags=re.S)
    if m:
        stem = m.group(1)
    return re.sub(DATE_SUFFIX + "$", "", clean_sql_name_text(stem))


def dscr_to_table_name(c) -> Column:
    """Description to table name: ``-`` and space to ``_``, parentheses dropped,
    lower case.  Runs of ``_`` are kept; NULL stays NULL."""
    x = F.regexp_replace(as_col(c), DSCR_SEPARATORS, "_")
    x = F.regexp_replace(x, DSCR_DROPPED, "")
    return F.lower(x)

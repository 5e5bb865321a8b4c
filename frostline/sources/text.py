"""Decoding and repair of member text, as Catalyst expressions.

cp1252 is not an accepted charset of ``decode`` in Spark 4 (without a legacy
flag, which then replaces undefined bytes silently).  Latin-1 maps every byte to
the code point of the same value, so decoding as ISO-8859-1 and translating the
32 C1 positions to their cp1252 characters gives exact cp1252 text; the five
bytes cp1252 leaves undefined are detected instead of guessed.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions._util import as_col


def _cp1252_tables() -> tuple[str, str, str]:
    """(C1 chars with a cp1252 meaning, their cp1252 chars, undefined C1 chars),
    derived from the standard codec."""
    src, dst, undefined = [], [], []
    for b in range(0x80, 0xA0):
        try:
            ch = bytes([b]).decode("cp1252")
        except UnicodeDecodeError:
            undefined.append(chr(b))
            continue
        src.append(chr(b))
        dst.append(ch)
    return "".join(src), "".join(dst), "".join(undefined)


C1_DEFINED, CP1252_CHARS, C1_UNDEFINED = _cp1252_tables()


def _python_whitespace() -> str:
    """Every character ``str.strip()`` removes (derived from ``str.isspace``)."""
    return "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


PY_WHITESPACE_CHARS = _python_whitespace()


def cp1252_decode(content, errors: str = "strict") -> Column:
    """Text of cp1252 bytes.  ``errors``: ``strict`` keeps undefined bytes as
    their C1 code points (pair with :func:`cp1252_undefined` to reject the
    member), ``ignore`` drops them, ``replace`` maps them to U+FFFD."""
    latin = F.decode(as_col(content), "ISO-8859-1")
    if errors == "strict":
        return F.translate(latin, C1_DEFINED, CP1252_CHARS)
    if errors == "ignore":
        return F.translate(latin, C1_DEFINED + C1_UNDEFINED, CP1252_CHARS)
    if errors == "replace":
        return F.translate(latin, C1_DEFINED + C1_UNDEFINED,
                           CP1252_CHARS + "�" * len(C1_UNDEFINED))
    raise ValueError("errors must be strict, ignore or replace")


def cp1252_undefined(content) -> Column:
    """True when the bytes hold a value cp1252 does not define."""
    cls = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in C1_UNDEFINED) + "]"
    return F.decode(as_col(content), "ISO-8859-1").rlike(cls)


def cp1252_encode(text) -> Column:
    """Bytes of text in cp1252 (characters outside it become '?', undefined C1
    code points their own byte, so ``strict`` decoding is undone)."""
    known = "".join(f"\\x{{{ord(c):X}}}" for c in CP1252_CHARS + C1_UNDEFINED)
    inside = F.regexp_replace(as_col(text), f"[^\\x00-\\x7F\\xA0-\\xFF{known}]", "?")
    return F.encode(F.translate(inside, CP1252_CHARS, C1_DEFINED), "ISO-8859-1")


def strip_whitespace(text) -> Column:
    """Remove surrounding whitespace, as Python's ``str.strip()`` (a character
    set trim: linear, unlike an end-anchored regex that retries at every
    whitespace run of a large text)."""
    return F.btrim(as_col(text), F.lit(PY_WHITESPACE_CHARS))


def repair_quotes(text) -> Column:
    """Every backslash-quote becomes a doubled quote, then the text is stripped.

    One pass, not quote-aware: a field that ends in a backslash breaks, as in
    the reference (the file patches fix the known case).
    """
    return strip_whitespace(F.replace(as_col(text), F.lit('\\"'), F.lit('""')))


# Known broken content, fixed by literal replacement in members
# whose name contains the marker.  Applied after quote repair.
FILE_PATCHES: tuple[tuple[str, str, str], ...] = (
    ("Primary_Clinical_Diagnosis_", 'no tremors today. \\"",,"3",', 'no tremors today.",,"3",'),
)


def apply_patches(text, member, patches: Sequence[tuple[str, str, str]] = FILE_PATCHES) -> Column:
    x = as_col(text)
    m = as_col(member)
    for marker, old, new in patches:
        x = F.when(m.contains(marker), F.replace(x, F.lit(old), F.lit(new))).otherwise(x)
    return x


def universal_newlines(text) -> Column:
    """CRLF and lone CR become LF, as a file opened in text mode reads them, so
    archive members and plain files give the same text whatever their line
    endings (also inside quoted fields)."""
    return F.replace(F.replace(as_col(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def repair(text, member, patches: Sequence[tuple[str, str, str]] = FILE_PATCHES,
           newlines: bool = True) -> Column:
    """(Newline normalisation,) quote repair, strip, then member-scoped patches
    (the reference order: newlines are translated when the file is read)."""
    x = universal_newlines(text) if newlines else as_col(text)
    return apply_patches(repair_quotes(x), member, patches)

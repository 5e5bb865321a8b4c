"""Quality rules, lines first.

Every line with a word is judged on its own and fails if

* *punctuation*: it is short, does not end like a sentence and holds no end of
  one either, or it has more than three marks for every two words
  (``word*** word%%%``, ``SHOUT!! SHOUT!!``);
* *navigation*: it is a row of menu entries parted by ``|`` and the like;
* *boilerplate*: phrases of site furniture make up a quarter of its words or
  more; a paragraph that mentions one stays.

A line of ``SHORT_WORDS`` or more is a paragraph, and its last character alone
does not decide about it.  Where words are not parted by spaces (Chinese, Thai),
``SYLLABLES`` characters count as a word for this.

Failed lines are removed.  A document is then rejected if it lost more than
``MOST_LOST`` of its words, and also if it fails the base rules: fewer than 50
words, or more than half of its words in windows of three that it repeats.

Cases: a null text has no words and is rejected, its cleaned text is null; an
empty text likewise is rejected and stays empty.  Null ids and repeated rows
are judged row by row.  An empty table gives an empty result.  Other columns
are carried; in ``judge`` a clash with the columns made here is resolved in favour
of these, ``kept_documents`` returns the input's own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .names import named_back, numbered

LEAST_WORDS = 50
MOST_LOST = 0.5
MOST_MARKS = 1.5
#: Share of a line's words in phrases of site furniture from which on it fails.
BOILERPLATE_SHARE = 0.25
SYMBOLS = b"#*$%&|<>"
#: Words of a line that is no longer short.
SHORT_WORDS = 10
#: Characters that count as a word in scripts that have none or few spaces.
SYLLABLES = 4
#: Ends of sentences in all scripts: Unicode's Sentence_Terminal, the ellipses and the Tibetan shad.
_SPACED_STOPS = ".!?…"
_STOPS = "".join(chr(c) for a, b in (
    (0x0589, 0x0589), (0x061D, 0x061F), (0x06D4, 0x06D4), (0x0700, 0x0702), (0x07F9, 0x07F9), (0x0837, 0x0837),
    (0x0839, 0x0839), (0x083D, 0x083E), (0x0964, 0x0965), (0x0F0D, 0x0F0E), (0x104A, 0x104B), (0x1362, 0x1362),
    (0x1367, 0x1368), (0x166E, 0x166E), (0x1735, 0x1736), (0x17D4, 0x17D5), (0x1803, 0x1803), (0x1809, 0x1809),
    (0x1944, 0x1945), (0x1AA8, 0x1AAB), (0x1B5A, 0x1B5B), (0x1B5E, 0x1B5F), (0x1C3B, 0x1C3C), (0x1C7E, 0x1C7F),
    (0x203C, 0x203D), (0x2047, 0x2049), (0x2E2E, 0x2E2E), (0x2E3C, 0x2E3C), (0x2E53, 0x2E54), (0x3002, 0x3002),
    (0xA4FF, 0xA4FF), (0xA60E, 0xA60F), (0xA6F3, 0xA6F3), (0xA6F7, 0xA6F7), (0xA876, 0xA877), (0xA8CE, 0xA8CF),
    (0xA92F, 0xA92F), (0xA9C8, 0xA9C9), (0xAA5D, 0xAA5F), (0xAAF0, 0xAAF1), (0xABEB, 0xABEB), (0xFE52, 0xFE52),
    (0xFE56, 0xFE57), (0xFF01, 0xFF01), (0xFF0E, 0xFF0E), (0xFF1F, 0xFF1F), (0xFF61, 0xFF61), (0x10A56, 0x10A57),
    (0x11047, 0x11048), (0x110BE, 0x110C1), (0x11141, 0x11143), (0x111C5, 0x111C6), (0x11238, 0x1123C),
    (0x1144B, 0x1144C), (0x115C2, 0x115C3), (0x11641, 0x11642), (0x1173C, 0x1173E)) for c in range(a, b + 1))
_CLOSERS = "\"')]}”’“‘»«›‹」』】》〉〕）］｝｣"
#: What a line may end with.
ENDS = set(_SPACED_STOPS + ":;" + _STOPS + _CLOSERS) | set("：；︰;")
# An end of a sentence within a line; the first kind only counts before a space.
_SENTENCE = re.compile(f"[^\\W\\d_][{re.escape(_CLOSERS)}]*[{re.escape(_SPACED_STOPS)}]+[{re.escape(_CLOSERS)}]*\\s|[{re.escape(_STOPS)}]")
#: Parts of menus.
SEPARATORS = ("|", "»", "›", "•", "·", "&gt;")
#: Phrases of site furniture, in lower case.
BOILERPLATE = (
    "accept all cookies", "all rights reserved", "back to top", "click here to", "cookie policy", "enable javascript",
    "forgot your password", "lorem ipsum", "privacy policy", "sign up for our newsletter", "skip to content",
    "subscribe to our newsletter", "terms of service", "terms of use", "this site uses cookies", "we use cookies",
)

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines", "n_words_left")
_MADE = T.StructType([*(T.StructField(n, T.LongType()) for n in _COUNTS), *(T.StructField(n, T.BooleanType()) for n in ("base_failed", "kept")),
                      T.StructField("cleaned", T.StringType())])


def _marked(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters)] = True
    return table


_SYMBOL = _marked(SYMBOLS)
_MARKS = _marked(bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum()))
_END = _marked("".join(c for c in ENDS if c.isascii()).encode())
# First bytes of characters of three bytes, but for U+2000 to U+2FFF: punctuation and symbols.
_SYLLABLE = _marked(bytes(c for c in range(0xE0, 0xEE) if c != 0xE2))


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus counts, ``base_failed``, ``kept`` and the ``cleaned`` text."""
    docs = docs.drop(*_MADE.names)
    columns = docs.columns
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(at).cast(pa.binary()).to_pylist()
            texts = [v or b"" for v in values]
            for a, b in W.groups_of(texts):
                made = _judged(texts[a:b])
                made["cleaned"] = [None if v is None else c for v, c in zip(values[a:b], made["cleaned"])]
                arrays = [pa.array(made[f.name], pa.binary()).cast(pa.string()) if f.name == "cleaned" else pa.array(made[f.name])
                          for f in _MADE]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, *arrays], names=[*columns, *_MADE.names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *_MADE.fields]))


def _judged(texts: list[bytes]) -> dict[str, object]:
    run = W.Texts(texts)
    data = np.frombuffer(run.data, dtype=np.uint8)
    n_words = np.diff(run.first)
    characters = _sums((data & 0xC0) != 0x80)
    word_chars = _over(characters[run.ends] - characters[run.starts], run.first)
    n_symbols = np.diff(_sums(_SYMBOL[data])[run.offsets])
    n_repeat = _repeat_words(run)
    base_failed = (n_words < LEAST_WORDS) | (100 * n_repeat > 50 * n_words)

    # The texts are joined by line feeds, so no line spans two texts.
    ends = np.flatnonzero(data == 10)
    starts = np.r_[0, ends[:-1] + 1]
    first, last = np.searchsorted(run.starts, starts), np.searchsorted(run.starts, ends)
    has = last > first
    failed = has & _failed(run, data, starts, ends, first, last)
    line_words = last - first
    line_of = np.searchsorted(starts, run.offsets)
    n_lines, n_failed = _over(has, line_of), _over(failed, line_of)
    left = _over(line_words * ~failed, line_of)
    kept = ~base_failed & (left >= (1 - MOST_LOST) * n_words)

    dups, cleaned = [], []
    for d, text in enumerate(texts):
        a, b = line_of[d], line_of[d + 1]
        lines = text.split(b"\n")
        seen: set[bytes] = set()
        again = 0
        for i, line in enumerate(lines):
            if has[a + i]:
                again += line in seen
                seen.add(line)
        dups.append(again)
        bad = failed[a:b]
        cleaned.append(b"\n".join([line for line, f in zip(lines, bad) if not f]) if bad.any() else text)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
            "n_dup_lines": np.array(dups, dtype=np.int64), "n_repeat_words": n_repeat, "base_failed": base_failed,
            "n_lines": n_lines, "n_failed_lines": n_failed, "n_words_left": left, "kept": kept, "cleaned": cleaned}


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=out[1:])
    return out


def _over(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of the values between consecutive edges."""
    return np.diff(_sums(values)[edges])


def _repeat_words(run: W.Texts) -> np.ndarray:
    """Of each text, the words in windows of three that it holds twice or more."""
    n = len(run.starts)
    whole = np.flatnonzero(run.whole(3))
    grams = W.gram_hashes(run.hashes, 3, 21)
    if not len(whole):
        return np.zeros(len(run.first) - 1, dtype=np.int64)
    doc = np.searchsorted(run.first, whole, side="right").astype(np.uint64)
    _, which, count = np.unique(W.mix(grams[whole] + doc * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    step = np.zeros(n + 1, dtype=np.int64)
    start = whole[count[which] > 1]
    step[start] += 1
    np.add.at(step, np.minimum(start + 3, n), -1)
    return _over(np.cumsum(step)[:n] > 0, run.first)


def _failed(run: W.Texts, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
            first: np.ndarray, last: np.ndarray) -> np.ndarray:
    has = np.flatnonzero(last > first)
    out = np.zeros(len(starts), dtype=bool)
    if not len(has):
        return out
    # Words of each line, as told in the docstring.
    words = np.maximum(last - first, 1)
    syllables = _sums(_SYLLABLE[data])
    words = np.maximum(words, (syllables[ends] - syllables[starts]) // SYLLABLES)
    # Punctuation: the last character of the last word, and marks among all characters.
    final = data[run.ends[last[has] - 1] - 1]
    good = _END[final]
    for i in np.flatnonzero(final >= 0x80):
        word = run.data[run.starts[last[has[i]] - 1]:run.ends[last[has[i]] - 1]]
        good[i] = word.decode()[-1] in ENDS
    good |= words[has] >= SHORT_WORDS
    for i in np.flatnonzero(~good):
        good[i] = _SENTENCE.search(run.data[starts[has[i]]:ends[has[i]]].decode()) is not None
    out[has] = ~good
    marks = _sums(_MARKS[data])
    out |= marks[ends] - marks[starts] > MOST_MARKS * words
    # Navigation and boilerplate: looked for in the whole run, then ascribed to lines.
    lower = run.data.lower()
    parts = np.zeros(len(starts), dtype=np.int64)
    for s in SEPARATORS:
        np.add.at(parts, np.searchsorted(starts, _places(lower, s.encode()), side="right") - 1, 1)
    out |= (parts >= 3) & (4 * parts >= last - first - parts)
    furniture = np.zeros(len(starts), dtype=np.int64)
    for phrase in BOILERPLATE:
        np.add.at(furniture, np.searchsorted(starts, _places(lower, phrase.encode()), side="right") - 1, len(phrase.split()))
    out |= (furniture > 0) & (furniture >= BOILERPLATE_SHARE * words)
    return out


def _places(data: bytes, what: bytes) -> np.ndarray:
    found, at = [], data.find(what)
    while at >= 0:
        found.append(at)
        at = data.find(what, at + len(what))
    return np.array(found, dtype=np.int64)


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, with their cleaned text and its length, in the columns of ``docs``.

    All other columns come back as they are, also if ``judge`` makes one of their name.
    """
    own, names = numbered(docs)
    judged = judge(own, names[text]).where("kept").withColumn(names[text], F.col("cleaned"))
    if "n_chars" in names:
        judged = judged.withColumn(names["n_chars"], F.length("cleaned").cast(docs.schema["n_chars"].dataType))
    return named_back(judged.select(*own.columns), docs.columns)

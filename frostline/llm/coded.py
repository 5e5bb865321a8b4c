"""Ids of many documents at once: distinct pieces are encoded once, everything else is arrays.

Texts are cut where no tokenizer at hand joins anything; a buffer of documents is
thereby a sequence of pieces, most of which occur again and again.  A coder finds
the distinct ones (Arrow's dictionary encoding), encodes those that it has not
kept, and lays out the ids of all documents by indexing.  What a worker keeps is
bounded in pieces and in their length.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa

#: Distinct pieces of text whose ids a worker keeps, and the longest that is kept.
KEPT_PIECES, LONGEST_KEPT = 500_000, 64
# ASCII pieces that are encoded as one text, and other pieces encoded in one call:
# the library's results take far more memory than the ids in them.
_TOGETHER, _AT_ONCE = 512, 1024
# No piece of the second vocabulary may hold a line feed, so nothing joins across it.
_BARRIER = "\n"

# Texts are cut before white space that follows something else.  No cut is made
# before a carriage return (the second vocabulary joins it to what precedes), nor
# after other white space; of characters beyond ASCII, whole ranges that hold
# white space are passed over.
_CUT_BEFORE = np.isin(np.arange(256), [0x20, 0x09, 0x0A])
_NO_CUT_AFTER = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)])
_SPACE_RANGES = [(0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80)]


def cuts_of(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where documents begin in a buffer of UTF-8, and where it may be cut without a change of their tokens."""
    at = np.flatnonzero(_CUT_BEFORE[data[1:]] & ~_NO_CUT_AFTER[data[:-1]]) + 1
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    spaces = (two == 0xC2) & np.isin(one, [0x85, 0xA0])
    for lead, follow in _SPACE_RANGES:
        spaces |= (three == lead) & (two == follow)
    cut = np.zeros(len(data), bool)
    cut[at[~spaces]] = cut[begins] = True
    return np.flatnonzero(cut)


class _Tokenizer:
    """Ids of pieces; ``bytes`` and ``sizes`` tell what each token stands for."""

    bytes: list[bytes]

    def each(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        raise NotImplementedError

    def joined(self, text: str) -> list[int]:
        """The ids of ASCII pieces that stand one after the other."""
        raise NotImplementedError

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all pieces, how many each has, and whether their bytes are the piece's.

        ASCII pieces that begin with white space and end in none may follow each
        other in one text: that is cheaper, and places between them are cuts all the same.
        """
        plain = [p.isascii() and p[0] in " \t\n" and p[-1] > " " for p in pieces]
        ids, counts, exact = [], np.empty(len(pieces), np.int32), np.ones(len(pieces), bool)
        table = self.bytes.__getitem__
        apart = [i for i, one in enumerate(plain) if not one]
        together = [i for i, one in enumerate(plain) if one]
        for k in range(0, len(together), _TOGETHER):
            of = together[k:k + _TOGETHER]
            text = "".join([pieces[i] for i in of])
            listed = self.joined(text)
            found = np.array(listed, np.int32)
            ends = np.cumsum(self.sizes[found])
            stops = np.cumsum([len(pieces[i]) for i in of])
            at = np.searchsorted(ends, stops)
            if b"".join(map(table, listed)) != text.encode() or (ends[at] != stops).any():  # does not give the text back: piece by piece
                apart += of
                continue
            counts[of] = np.diff(at, prepend=-1)
            ids.append((of, found))
        for k in range(0, len(apart), _AT_ONCE):
            of = apart[k:k + _AT_ONCE]
            lists = self.each([pieces[i] for i in of])
            counts[of] = [len(x) for x in lists]
            exact[of] = [b"".join(map(table, x)) == pieces[i].encode() for i, x in zip(of, lists)]
            ids.append((of, np.fromiter(itertools.chain.from_iterable(lists), np.int32)))
        ends = np.cumsum(counts, dtype=np.int64)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        for of, found in ids:
            out[spans(ends[of] - counts[of], counts[of].astype(np.int64))] = found
        return out, counts, exact


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of each span, one span after the other."""
    to = np.cumsum(counts)
    return np.repeat(starts - (to - counts), counts) + np.arange(int(to[-1]) if len(to) else 0)


class ByteLevel(_Tokenizer):
    """Byte-level BPE of a tokenizers file.  Special tokens' strings are plain text; ``special`` lists them.

    ASCII text goes through tiktoken where the file's ids rise with its merges,
    so that they are ranks, and its words are those of the public pattern.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        chars = _byte_chars()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.bytes = [bytes(chars[c] for c in n) if all(c in chars for c in n) else n.encode() for n in names]
        self.sizes = np.fromiter(map(len, self.bytes), np.int32)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocabulary, merges = model["model"]["vocab"], model["model"]["merges"]
        made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        ahead = model["pre_tokenizer"] or {}
        self.ranks = None
        if (made == list(range(256, 256 + len(made))) and ahead.get("type") == "ByteLevel" and ahead.get("use_regex")
                and not ahead.get("add_prefix_space") and not model["normalizer"]):
            ranks = {self.bytes[i]: i for i in vocabulary.values()}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def with_special(self, text: str) -> list[int]:
        """The ids of a text in which special tokens' strings are those tokens."""
        self.tokenizer.encode_special_tokens = False
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        self.tokenizer.encode_special_tokens = True
        return ids

    def joined(self, text: str) -> list[int]:
        return self.ranks.encode_ordinary(text) if self.ranks else self.each([text])[0]


class SentencePieces(_Tokenizer):
    """BPE of a sentencepiece file; text is encoded behind a barrier, so no space is added to it."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(_BARRIER in n for n in names) or any(re.search(r"[^▁\t\n\r][▁\t\n]", n) for n in names):
            raise ValueError("the vocabulary has pieces that join what the cuts part")
        self.bytes = [bytes([int(n[1:-1], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
                      for i, n in enumerate(names)]
        self.sizes = np.fromiter(map(len, self.bytes), np.int32)
        self.lead = len(self.model.encode(_BARRIER))  # the space that is added, and the barrier

    def each(self, texts: list[str]) -> list[list[int]]:
        return [ids[self.lead:] for ids in self.model.encode([_BARRIER + t for t in texts], num_threads=1)]

    def joined(self, text: str) -> list[int]:
        return self.model.encode(_BARRIER + text)[self.lead:]


def _byte_chars() -> dict[str, int]:
    """The characters that byte-level vocabularies write for the bytes 0 to 255."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Ids:
    """Ids of distinct pieces by one tokenizer, one piece after the other."""

    def __init__(self, tokenizer: _Tokenizer):
        self.tokenizer = tokenizer
        self.ids, self.counts, self.exact = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, bool)

    def with_new(self, pieces: list[str]) -> list[np.ndarray]:
        """What is kept, followed by further pieces."""
        return [np.concatenate(both) for both in zip((self.ids, self.counts, self.exact), self.tokenizer.encode(pieces))]


class Coder:
    """One or several tokenizers of a worker, and the pieces it keeps."""

    def __init__(self, *tokenizers: _Tokenizer, most: int = KEPT_PIECES):
        self.sides = [_Ids(t) for t in tokenizers]
        self.most = most
        self.place: dict[str, int] = {}

    def encode(self, data: bytes, cuts: np.ndarray, first: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """Of each tokenizer the ids, how many each document has, and in how many pieces its bytes differ.

        ``cuts`` are the offsets of the pieces, ``first`` the first piece of each document.
        """
        offsets = pa.py_buffer(np.append(cuts, len(data)).astype(np.int32))
        coded = pa.StringArray.from_buffers(len(cuts), offsets, pa.py_buffer(data)).dictionary_encode()
        texts = coded.dictionary.to_pylist()
        at = np.array(list(map(self.place.get, texts, itertools.repeat(-1))), np.int64)
        absent = np.flatnonzero(at < 0)
        # Short pieces come first: those may be kept, so they must follow what is kept.
        short = np.fromiter((len(texts[i]) <= LONGEST_KEPT for i in absent.tolist()), bool, len(absent))
        absent = np.concatenate((absent[short], absent[~short]))
        new = [texts[i] for i in absent.tolist()]
        at[absent] = len(self.place) + np.arange(len(new))
        which = at[coded.indices.to_numpy()]
        keep = int(short.sum()) if len(self.place) + short.sum() <= self.most else 0
        kept = len(self.place) + keep
        out = []
        for side in self.sides:
            ids, counts, exact = side.with_new(new)
            ends = np.cumsum(counts, dtype=np.int64)
            n = counts[which].astype(np.int64)
            of_docs, bad = (np.add.reduceat(x, first) if len(first) else first for x in (n, (~exact[which]).astype(np.int64)))
            out.append((ids[spans(ends[which] - n, n)], of_docs, bad))
            if keep:
                side.ids, side.counts, side.exact = ids[:ends[kept - 1]].copy(), counts[:kept].copy(), exact[:kept].copy()
        self.place.update(zip(new[:keep], range(kept - keep, kept)))
        return out

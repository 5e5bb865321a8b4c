"""Encoding by pieces: a worker's memo from piece of text to token ids.

Texts repeat their words far more than their sentences, and the tokenizers
library spends the same time on each.  A worker therefore encodes each distinct
piece once, as long as its memo has room, and joins the ids of the pieces.  Of a
whole buffer of texts, Arrow finds the distinct pieces, so the memo is asked once
for each, and the ids are laid out by indexing.

A *piece* must be a stretch of text that the tokenizer encodes alike on its own
and in its place; the callers choose the cuts so that this holds.  Within a
piece two more rules save work, each only if the tokenizer was seen to obey it:
a full stop or comma that ends the piece after an ASCII letter is encoded apart,
and ASCII letters may be put in lower case.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterable, Sequence
from sys import getsizeof

import numpy as np
import pyarrow as pa

from .coded import spans

# Entries a worker's memo may hold, and bytes for each on average.
MEMO_PIECES = 1_200_000
ENTRY_BYTES = 200
# Characters of the longest piece that is kept: longer ones hardly come again.
LONGEST_KEPT = 64
# Bytes of an entry in the dictionary itself, besides its key and value.
_SLOT_BYTES = 48
# Pieces that are encoded in one call.
_AT_ONCE = 1024
_TAILS = (".", ",")
_TAIL = np.isin(np.arange(256), [ord(t) for t in _TAILS])
_LETTER = np.isin(np.arange(256) | 0x20, range(ord("a"), ord("z") + 1)) & (np.arange(256) < 0x80)

_LOADED: dict[str, "Pieces"] = {}


def pieces_of(path: str, most: int = MEMO_PIECES) -> "Pieces":
    """The worker's memo for a tokenizer file; it lives as long as the worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path, most)
    return _LOADED[path]


class _Memo(dict):
    """Pieces that stay, and ``passing`` ones of the texts at hand: long ones and those for which there was no room."""

    def __init__(self):
        super().__init__()
        self.passing: dict[str, bytes] = {}
        self.bytes = 0

    def __missing__(self, piece: str) -> bytes:
        return self.passing[piece]


class Pieces:
    def __init__(self, path: str, most: int = MEMO_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.most = most
        self.memo = _Memo()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        whole, a, b, c = self.encode(["Bee, 'twas.", "Bee", ", 'twas", "."])
        self.cut_tails = whole == a + b + c
        self.sizes, self.drops = self._token_bytes()
        upper, lower = self.encode(["BEE's Sting", "bee's sting"])
        self.fold = upper == lower

    def _token_bytes(self) -> tuple[np.ndarray | None, bool]:
        """Bytes of text that each token stands for, and whether the tokenizer drops white space.

        They are None unless the tokenizer is byte level and either keeps every byte and never
        joins across white space that follows something else, or drops white space.
        """
        parts = json.loads(self.tokenizer.to_str())
        ahead = parts["pre_tokenizer"] or {}
        steps = ahead.get("pretokenizers", [ahead])
        drops = bool(suffix := parts["model"].get("end_of_word_suffix"))
        whole, *each = self.encode([" Bee sting\n\t2 'twas ", "Bee", "sting", "2", "'twas"])
        if (any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]] for t in parts["added_tokens"])
                or steps[-1].get("type") != "ByteLevel" or steps[-1].get("add_prefix_space")
                or (whole != sum(each, []) if drops else len(steps) > 1 or not steps[-1].get("use_regex") or parts["normalizer"])):
            return None, False
        added = {t["id"]: len(t["content"].encode()) for t in parts["added_tokens"]}
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        return np.array([added.get(i, len((name or "").removesuffix(suffix or ""))) for i, name in enumerate(names)], np.int64), drops

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [e.ids for e in found]

    def _coded(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers.

        Texts that may follow each other are encoded as one, which is cheaper, and parted by
        the bytes of their tokens; where those do not end with a text, each is encoded apart.
        """
        out = [b""] * len(texts)
        apart, together = list(range(len(texts))), []
        if self.sizes is not None:
            if self.drops:  # a normalizer may change the bytes of other characters
                follows = [t.isascii() and t.isprintable() and " " not in t for t in texts]
            else:
                follows = [t[0] in " \t\n" and not t[-1].isspace() for t in texts]
            apart, together = ([i for i in apart if follows[i] == joins] for joins in (False, True))
        between = " " if self.drops else ""
        for k in range(0, len(together), _AT_ONCE):
            of = together[k:k + _AT_ONCE]
            found = np.array(self.encode([between.join([texts[i] for i in of])])[0], "<i4")
            ends = np.cumsum(self.sizes[found])
            stops = np.cumsum([len(texts[i].encode()) for i in of])
            if not len(found) or ends[-1] != stops[-1] or (ends[at := np.searchsorted(ends, stops)] != stops).any():
                apart += of
                continue
            data, bounds = found.tobytes(), [0, *(4 * at + 4).tolist()]
            for i, begin, end in zip(of, bounds, bounds[1:]):
                out[i] = data[begin:end]
        for k in range(0, len(apart), _AT_ONCE):  # lists are held for few texts at a time
            of = apart[k:k + _AT_ONCE]
            for i, ids in zip(of, self.encode([texts[i] for i in of])):
                out[i] = array("i", ids).tobytes()
        return out

    def learn(self, pieces: Iterable[str]) -> _Memo:
        """A mapping that has each of the pieces: ids as little-endian 32-bit integers."""
        memo = self.memo
        new = [p for p in set(pieces) if p not in memo]  # never walks the memo
        memo.passing = {}
        if not new:
            return memo
        made = {p: parts for p in new if (parts := self._simpler(p)) != (p,)}
        plain = [p for p in new if p not in made]
        if made:
            known = set(plain)
            plain += [p for p in {q for parts in made.values() for q in parts} if p not in memo and p not in known]
        self._keep(dict(zip(plain, self._coded(plain))))
        self._keep({p: b"".join([memo[q] for q in parts]) for p, parts in made.items()})
        return memo

    def ids_of(self, data: bytes, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces of a buffer of UTF-8, and how many each piece has.

        ``begins`` are the offsets of the pieces, 0 first; none is empty.
        """
        if not len(begins):
            return np.empty(0, "<i4"), np.empty(0, np.int64)
        cuts, given = begins, np.arange(len(begins))
        if self.cut_tails:
            buffer = np.frombuffer(data, np.uint8)
            last = np.append(begins[1:], len(data)) - 1
            tails = last[_TAIL[buffer[last]] & (last > begins) & _LETTER[buffer[last - 1]]]
            given = given + np.searchsorted(tails, begins)
            cuts = np.insert(begins, np.searchsorted(begins, tails), tails)
        offsets = pa.py_buffer(np.append(cuts, len(data)).astype(np.int64))
        coded = pa.LargeStringArray.from_buffers(len(cuts), offsets, pa.py_buffer(data)).dictionary_encode()
        texts = coded.dictionary.to_pylist()
        found = list(map(self.learn(texts).__getitem__, texts))
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ends = np.cumsum(counts)
        which = coded.indices.to_numpy()
        many = counts[which]
        ids = np.frombuffer(b"".join(found), "<i4")[spans(ends[which] - many, many)]
        return ids, np.add.reduceat(many, given)

    def _simpler(self, piece: str) -> tuple[str, ...]:
        if self.fold and piece.isascii():
            low = piece.lower()
            if low != piece and not any(t in low for t in self.added):
                piece = low
        if self.cut_tails and piece.endswith(_TAILS) and len(piece) > 1 and "A" <= piece[-2] <= "z" and piece[-2].isalpha():
            return piece[:-1], piece[-1]
        return (piece,)

    def _keep(self, coded: dict[str, bytes]) -> None:
        memo = self.memo
        stay = {p: ids for p, ids in coded.items() if len(p) <= LONGEST_KEPT}
        size = sum(map(getsizeof, stay)) + sum(map(getsizeof, stay.values())) + _SLOT_BYTES * len(stay)
        if len(memo) + len(stay) <= self.most and memo.bytes + size <= self.most * ENTRY_BYTES:
            memo.update(stay)
            memo.bytes += size
            if len(stay) == len(coded):
                return
            coded = {p: ids for p, ids in coded.items() if len(p) > LONGEST_KEPT}
        memo.passing.update(coded)

    @staticmethod
    def joined(pieces: Sequence[str], known: _Memo) -> bytes:
        return b"".join(map(known.__getitem__, pieces))

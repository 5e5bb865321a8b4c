"""Vectorised word positions and word hashes for byte buffers (numpy, inside tasks).

Several operators of this subpackage look at every word of every text.  The
helpers below find the words of a whole buffer of texts at once and give each
word a 64-bit hash, so that no Python loop runs per word.

Hashes serve to find candidates and to compare words of one text; operators
whose contract names a particular hash compute that one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# Bytes hashed at once; bounds the temporary arrays (eight bytes per input byte).
SLICE_BYTES = 1 << 19

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BASE, SLICE_BYTES)
_INVERSE = _powers(_BASE_INVERSE, SLICE_BYTES)


def _table(outside: Iterable[int]) -> np.ndarray:
    inside = np.ones(256, dtype=bool)
    inside[list(outside)] = False
    return inside


#: Words are runs of anything but ASCII white space.
SPACED = _table([0x20, *range(0x09, 0x0E)])
#: Words are runs of ASCII letters, digits and non-ASCII characters.
ALNUM = _table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def lower_ascii(text: bytes) -> bytes:
    """A-Z in lower case; every other byte as it is."""
    return text.lower()  # bytes.lower changes ASCII letters only


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_spans(buffer: np.ndarray, inside: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of a uint8 buffer."""
    flag = np.empty(len(buffer) + 2, dtype=np.int8)
    flag[0] = flag[-1] = 0
    flag[1:-1] = inside[buffer]
    edge = np.diff(flag)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, then ``mix``."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        at = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, at + SLICE_BYTES, side="right")))
        if ends[j - 1] - at > SLICE_BYTES:  # one word longer than a slice
            out[i] = _long_word(buffer[at:ends[i]])
            i += 1
            continue
        piece = _BYTE_CODE[buffer[at:ends[j - 1]]]
        piece *= _POWER[:len(piece)]
        total = np.empty(len(piece) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(piece, out=total[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = (total[e] - total[s]) * _INVERSE[s]
        i = j
    return mix(out)


def _long_word(word: np.ndarray) -> np.uint64:
    total, scale = 0, 1
    step = pow(_BASE, SLICE_BYTES, 1 << 64)
    for k in range(0, len(word), SLICE_BYTES):
        piece = _BYTE_CODE[word[k:k + SLICE_BYTES]]
        total += int((piece * _POWER[:len(piece)]).sum(dtype=np.uint64)) * scale
        scale = scale * step % (1 << 64)
    return np.uint64(total % (1 << 64))


def gram_hashes(words: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """A hash of every ``k`` consecutive word hashes (empty if there are fewer)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    odd = np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, k, dtype=np.uint64)
    odd = odd * np.uint64(2) + np.uint64(1)
    out = words[:n] * odd[0]
    for i in range(1, k):
        out += words[i:n + i] * odd[i]
    return mix(out)


class Texts:
    """Words and word hashes of several texts laid into one buffer.

    ``first[d]:first[d + 1]`` are the words of text ``d``; ``starts``/``ends``
    are offsets in ``data`` (the texts, each followed by a line feed).
    """

    def __init__(self, texts: list[bytes], inside: np.ndarray = SPACED):
        self.data = b"\n".join(texts) + b"\n"
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        buffer = np.frombuffer(self.data, dtype=np.uint8)
        self.starts, self.ends = word_spans(buffer, inside)
        self.hashes = word_hashes(buffer, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, self.offsets)

    def whole(self, k: int) -> np.ndarray:
        """Of each k-gram of the buffer, whether it lies within one text."""
        n = max(0, len(self.starts) - k + 1)
        last = np.repeat(self.first[1:], np.diff(self.first))  # end of each word's text
        return np.arange(n) + k <= last[:n]


def give_back() -> None:
    """Memory that Arrow has freed goes back to the system; workers wait, and are counted, between tasks."""
    pa.default_memory_pool().release_unused()


def groups_of(items: list, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts, or sizes of texts, of about ``most`` bytes together."""
    begin, size = 0, 0
    for i, item in enumerate(items):
        n = item if isinstance(item, int) else len(item) + 1
        if size and size + n > most:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(items):
        yield begin, len(items)

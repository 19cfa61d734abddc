"""Words of many texts at once, as numpy arrays over their bytes.

A word's hash is a sum over its bytes, weighted by powers of an odd number, so no word is cut
out to be hashed.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from tabprep.llm.common import flat

#: Bytes of text hashed at once; a longer text is hashed by itself.
HASHED = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of words: digits, lower-case letters and all beyond ASCII; or all but ASCII white space.
LETTERS, SOLID = np.zeros(256, bool), np.ones(256, bool)
LETTERS[0x30:0x3A] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
SOLID[0x09:0x0E] = SOLID[0x20] = False

_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


_BASE = np.uint64(0x5851F42D4C957F2D)


@lru_cache(maxsize=1)
def _few_powers() -> np.ndarray:
    return _powers(1 << 12)


def _powers(n: int) -> np.ndarray:
    """Powers of an odd number modulo 2**64."""
    up = np.full(n, _BASE, np.uint64)
    up[0] = 1
    return np.multiply.accumulate(up)


class Words:
    """The words of some texts: bytes, where words begin and end, each text's first word, hashes.

    A-Z are lowered unless the case counts. ``kinds`` tells the bytes of words from the others.
    """

    def __init__(self, column: pa.Array, kinds: np.ndarray, lower: bool = True):
        raw, borders = flat(column)
        self.data = _LOWER[raw] if lower else raw
        self.borders = borders
        inside = np.zeros(len(raw) + 1, bool)
        inside[:-1] = kinds[self.data]
        before = np.zeros(len(raw) + 1, bool)
        before[1:] = inside[:-1]
        before[borders] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(raw) + 1, bool)
        after[:-1] = inside[1:]
        cut = borders[borders > 0] - 1
        after[cut] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, borders)
        self.hashes = self._hashes(inside[:-1])

    def _hashes(self, inside: np.ndarray) -> np.ndarray:
        """Sums over each word's bytes, weighted by powers that begin anew with the word."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        begin = int(self.starts[0])
        spans = np.diff(np.append(self.starts, len(self.data)))
        place = np.arange(begin, len(self.data), dtype=np.int64) - np.repeat(self.starts, spans)
        place[~inside[begin:]] = 0
        longest = int(place.max()) + 1
        up = _few_powers() if longest <= 1 << 12 else _powers(longest)
        parts = _BYTE[self.data[begin:]] * up[place]
        parts[~inside[begin:]] = 0
        return mix(np.add.reduceat(parts, self.starts - begin))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the runs of ``size`` words from each word on, and whether the run ends in its text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        out = np.full(n, size, np.uint64)
        for k in range(size):
            out = mix(out * _STEP + self.hashes[k : k + n])
        last = np.repeat(self.first[1:], np.diff(self.first))[:n]
        return out, np.arange(n) + size <= last

    def text(self, a: int, b: int) -> str:
        """Words a to b, joined by spaces."""
        own = self.data[self.starts[a] : self.ends[b - 1]].tobytes()
        at = int(self.starts[a])
        return " ".join(own[s - at : e - at].decode() for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist(), strict=True))

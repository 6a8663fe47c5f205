"""Words of whole texts as arrays: where they stand and a hash of each."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from segmill.llm import hashing
from segmill.llm.common import text_bytes

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """Maximal runs of bytes other than space and 0x09-0x0D, of a batch of texts."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    cuts: np.ndarray  # words before each text, n + 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.cuts)

    def hashes(self, base: int = hashing.BYTE_BASE) -> np.ndarray:
        """A hash of each word, in stretches of the text; a very long word has a hash of its own kind."""
        out, sizes = np.empty(len(self.starts), np.uint64), self.ends - self.starts
        a = 0
        while a < len(out):
            b = max(a + 1, int(np.searchsorted(self.ends, self.starts[a] + hashing.STRETCH, side="right")))
            if sizes[a] <= hashing.STRETCH:
                low = self.starts[a]
                sums = hashing.prefix(self.data[low : self.ends[b - 1]], base)
                out[a:b] = hashing.spans(sums, self.starts[a:b] - low, self.ends[a:b] - low, base)
            else:
                out[a] = xxhash.xxh64_intdigest(self.data[self.starts[a] : self.ends[a]], base)
            a = b
        return out


def words_of(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = text_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = ~_WHITE[data]
    begin = inside.copy()
    if len(data):
        begin[1:] &= ~inside[:-1]
        firsts = offsets[:-1][np.diff(offsets) > 0]
        begin[firsts] = inside[firsts]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:]
        lasts = offsets[1:][np.diff(offsets) > 0] - 1
        finish[lasts] = inside[lasts]
    else:
        finish = begin
    starts = np.flatnonzero(begin)
    return Words(data, starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets))

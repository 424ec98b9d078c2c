"""Words of whole texts as numpy arrays: spans, 64-bit hashes and shingle sets, in bounded slices."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 19  # bytes of text handled at a time; a longer text is a slice of its own

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE = np.random.default_rng(20_231).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(str(base))
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE + 4096), base, dtype=np.uint64)
        have[0] = 1
        _POWERS[str(base)] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts as UTF-8) for ranges of rows that hold about ``SLICE`` bytes each.

    Only a range at a time is unpacked, so a worker's memory doesn't follow the batch's size.
    """
    upto = np.cumsum(np.append(0, pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
    at, n = 0, len(texts)
    while at < n:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + SLICE, side="right")) - 1)
        yield at, texts.slice(at, end - at).cast(pa.binary()).to_pylist()
        at = end
    pa.default_memory_pool().release_unused()


class Words:
    """The words of some texts: ``starts``/``ends`` in ``buf``, ``doc`` (row of each), ``first`` (row -> first word)."""

    def __init__(self, texts: Sequence[bytes | None], lower: bool = False):
        raw = np.frombuffer(b" ".join([t or b"" for t in texts]) + b" ", dtype=np.uint8)
        self.buf = _LOWER[raw] if lower else raw
        space = _SPACE[raw]
        edge = np.diff(space.astype(np.int8), prepend=np.int8(1))
        self.starts = np.flatnonzero(edge == -1)
        self.ends = np.flatnonzero(edge[1:] == 1) + 1 if len(edge) > 1 else np.zeros(0, np.int64)
        doc_ends = np.cumsum([len(t or b"") + 1 for t in texts])
        self.doc = np.searchsorted(doc_ends, self.starts, side="right")
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))

    def hashes(self) -> np.ndarray:
        """A polynomial hash of each word's bytes, mixed; equal words have equal hashes everywhere."""
        n = len(self.buf)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_TABLE[self.buf] * _powers(_BASE, n), out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * _powers(pow(_BASE, -1, 1 << 64), n)[self.starts])


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive word hashes (also across rows; callers mask those)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        out = (out ^ words[j : j + n]) * np.uint64(0xD6E8FEB86659FD93 + 2 * j)
        out ^= out >> np.uint64(32)
    return mix(out)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles, A-Z lowered.

    A text of fewer words has its whole sequence as its only shingle; one without words has none.
    """
    for _, part in slices(texts):
        w = Words(part, lower=True)
        h = w.hashes()
        s = runs(h, size)
        for i in range(len(part)):
            a, b = int(w.first[i]), int(w.first[i + 1])
            if b - a >= size:
                yield np.unique(s[a : b - size + 1])
            elif b > a:
                yield runs(h[a:b], b - a) ^ np.uint64(b - a)
            else:
                yield np.zeros(0, dtype=np.uint64)

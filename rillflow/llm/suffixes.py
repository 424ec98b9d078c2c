"""Suffix arrays of small shards by induced sorting in numpy, and their permuted common prefixes."""

from __future__ import annotations

import numpy as np

from .words import _BASE, _TABLE, _powers, mix


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it (S), False where larger (L)."""
    n = len(s)
    step = np.append(np.sign(s[1:].astype(np.int32) - s[:-1]), 1)
    nearest = np.where(step != 0, np.arange(n), n - 1)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    return step[nearest] > 0


def _dealt(pend: list[list[np.ndarray]], chars: np.ndarray, items: np.ndarray) -> None:
    """Appends the items to their characters' lists in the order given."""
    if len(items):
        order = np.argsort(chars, kind="stable")
        c, x = chars[order], items[order]
        cuts = np.flatnonzero(c[1:] != c[:-1]) + 1
        for part, at in zip(np.split(x, cuts), np.append(0, cuts)):
            pend[c[at]].append(part)


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array from LMS suffixes in order: L suffixes from the left, then S ones from the right.

    A bucket is worked off whole: what it induces goes, in order, to the ends of other buckets'
    lists; what it induces in itself is its next wave.
    """
    k = int(s.max()) + 1
    seeds: list[list[np.ndarray]] = [[] for _ in range(k)]
    _dealt(seeds, s[lms], lms)
    larger: list[list[np.ndarray]] = [[] for _ in range(k)]
    for b in range(k):
        done: list[np.ndarray] = []
        wave = np.concatenate(larger[b]) if larger[b] else np.zeros(0, np.int32)
        while len(wave):
            done.append(wave)
            j = wave[wave > 0] - 1
            j = j[~small[j]]
            c = s[j]
            own = c == b
            _dealt(larger, c[~own], j[~own])
            wave = j[own]
        larger[b] = done
        if seeds[b]:
            j = np.concatenate(seeds[b])
            j = j[j > 0] - 1
            _dealt(larger, s[j], j)
    lists: list[list[np.ndarray]] = [[] for _ in range(k)]  # S suffixes, from the right end of a bucket
    out: list[np.ndarray] = []
    for b in range(k - 1, -1, -1):
        done = []
        wave = np.concatenate(lists[b]) if lists[b] else np.zeros(0, np.int32)
        while len(wave):
            done.append(wave)
            j = wave[wave > 0] - 1
            j = j[small[j]]
            c = s[j]
            own = c == b
            _dealt(lists, c[~own], j[~own])
            wave = j[own]
        left = np.concatenate(larger[b])[::-1] if larger[b] else np.zeros(0, np.int32)
        if len(left):
            j = left[left > 0] - 1
            j = j[small[j]]
            _dealt(lists, s[j], j)
        out += [*done, left]
    if not (len(out) and out[-1].size and s[out[-1][-1]] == 0):  # the sentinel is S and nothing induces it
        out.append(np.array([len(s) - 1], np.int32))
    return np.concatenate(out)[::-1]


def _ranked(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a string of names: pairs of neighbours get new names, doubling
    their reach each time, until all differ."""
    n, reach = len(names), 1
    rank = names.astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[:-reach] = rank[reach:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[order] = np.cumsum(np.append(0, key[order][1:] != key[order][:-1]))
        if new[order[-1]] == n - 1:
            return order
        rank, reach = new, reach * 2


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The suffix array of ``s``, small non-negative integers that end in a 0 found nowhere else."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    s = s.astype(np.int16)
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    sa = _induce(s, small, lms)  # sorts the LMS substrings
    if len(lms) < 2:
        return sa
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    in_order = sa[is_lms[sa]]
    number = np.zeros(n, np.int32)
    number[lms] = np.arange(len(lms))
    ends = np.append(lms[1:], n - 1) + 1  # a substring reaches to the next LMS character
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[s & 255] * _powers(_BASE, n), out=total[1:])
    hashed = mix((total[ends] - total[lms]) * _powers(pow(_BASE, -1, 1 << 64), n)[lms]) ^ (ends - lms).astype(np.uint64)
    h = hashed[number[in_order]]
    names = np.zeros(len(lms), np.int64)
    names[number[in_order]] = np.cumsum(np.append(0, h[1:] != h[:-1]))
    return _induce(s, small, lms[_ranked(names)])


def permuted_prefixes(s: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Per text position the length that its suffix shares with its predecessor in ``sa``, up to ``most``.

    Found for all positions at once, halving the step: prefix hashes tell whether a stretch is equal.
    """
    n = len(s)
    before = np.zeros(n, np.int32)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = n - 1
    powers, back = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 1 << 64), n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[s & 255] * powers[:n], out=total[1:])
    here, there, shared = np.arange(n, dtype=np.int32), before, np.zeros(n, np.int32)
    step = 1 << max(0, int(most).bit_length() - 1)
    while step:
        a, b = here + shared + step, there + shared + step
        fits = (a <= n) & (b <= n)
        a, b, i, j = np.minimum(a, n), np.minimum(b, n), here + shared, there + shared
        same = fits & ((total[a] - total[i]) * back[i] == (total[b] - total[j]) * back[j])
        shared += same * np.int32(step)
        step >>= 1
    return np.minimum(shared, most)

"""Borders merged, cells and tables of a page: small arrays per page, a batch of pages at once.

Spark groups what each page holds; these helpers see the flat arrays of a batch, with the number of its
page beside each entry.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def flat(pages: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The page's number and the fields of each entry of lists of structs."""
    entries = pages.flatten()
    page = np.repeat(np.arange(len(pages)), pages.value_lengths().to_numpy(zero_copy_only=False))
    return page, [f.to_numpy(zero_copy_only=False) for f in entries.flatten()]


def listed(n: int, page: np.ndarray, fields: dict[str, np.ndarray]) -> pa.Array:
    """Entries in the order of their ``n`` pages as lists of structs."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(page, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(f) for f in fields.values()], list(fields)))


def numbers(*keys: np.ndarray) -> np.ndarray:
    """Equal tuples of keys as one number from 0, in their order."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def cells(pages: pa.Array, tolerance: float, most: int) -> pa.Array:
    """Crossings (``x, y, h, v``; ``h, v``: the page's borders that cross) -> smallest closed rectangles of each page.

    Every crossing takes the nearest one below, and of those on its right the nearest whose fourth corner
    is a crossing of both their borders; those that find none go on to the next below, all at once.
    """
    page, (x, y, h, v) = flat(pages)
    n = len(x)
    h, v = numbers(page, h), numbers(page, v)
    down, right = np.lexsort((-y, v)), np.lexsort((x, h))
    at_down, at_right = np.argsort(down), np.argsort(right)
    wide = int(v.max(initial=0)) + 1
    known = np.sort(h * wide + v)

    def met(hs: np.ndarray, vs: np.ndarray) -> np.ndarray:
        key = hs * wide + vs
        return known[np.minimum(np.searchsorted(known, key), n - 1)] == key

    def nearest(p: np.ndarray, base: np.ndarray) -> np.ndarray:
        """The right side for crossings ``p`` over the borders ``base``, NaN if there is none."""
        x1, open_, at = np.full(len(p), np.nan), np.arange(len(p)), at_right[p] + 1
        while len(open_):
            on = at[open_] < n
            on[on] = h[right[at[open_[on]]]] == h[p[open_[on]]]
            open_ = open_[on]
            r = right[at[open_]]
            hit = (x[r] > x[p[open_]] + tolerance) & met(base[open_], v[r])
            x1[open_[hit]] = x[r[hit]]
            open_ = open_[~hit]
            at[open_] += 1
        return x1

    x1, low = np.full(n, np.nan), np.full(n, np.nan)
    p, at = np.arange(n), at_down + 1
    while len(p):
        on = at[p] < n
        on[on] = v[down[at[p[on]]]] == v[p[on]]
        p = p[on]
        q = down[at[p]]
        below = y[q] < y[p] - tolerance
        side = np.full(len(p), np.nan)
        side[below] = nearest(p[below], h[q[below]])
        hit = ~np.isnan(side)
        x1[p[hit]], low[p[hit]] = side[hit], y[q[hit]]
        at[p] += 1
        p = p[~hit]
    found = np.flatnonzero(~np.isnan(x1))
    found = found[np.lexsort((x1[found], -low[found], y[found], x[found], page[found]))]
    key = numbers(page[found], x[found], y[found])  # crossings at one place begin one cell
    found = found[np.diff(key, prepend=-1) > 0]
    found = found[np.bincount(page[found], minlength=len(pages))[page[found]] <= most]
    return listed(len(pages), page[found], {"x0": x[found], "x1": x1[found], "y0": low[found], "y1": y[found]})


def snapped(group: np.ndarray, v: np.ndarray, tolerance: float) -> np.ndarray:
    """The kept value of its group that each value is merged with, as ``layout.snapped`` has it."""
    order = np.lexsort((v, group))
    g, s, i = group[order], v[order], np.arange(len(v))
    start = np.ones(len(v), bool)
    start[1:] = (g[1:] != g[:-1]) | (s[1:] - s[:-1] > tolerance)
    while True:  # each time every run that is too long is cut at its first value beyond the tolerance
        first = np.maximum.accumulate(np.where(start, i, 0))
        beyond = s - s[first] > tolerance
        if not beyond.any():
            break
        start |= beyond & ~np.concatenate([[False], beyond[:-1] & (first[1:] == first[:-1])])
    out = np.empty(len(v))
    out[order] = s[first]
    return out


def runs(group: np.ndarray, low: np.ndarray, high: np.ndarray, apart: float) -> np.ndarray:
    """For each interval the first one (its index) of its run: a new one begins more than ``apart`` after all before it have ended."""
    order = np.lexsort((high, low, group))
    g, a, b = group[order], low[order], high[order]
    by_height = np.argsort(b, kind="stable")
    rank = np.empty(len(b), np.int64)
    rank[by_height] = np.arange(len(b))
    inside = np.cumsum(np.diff(g, prepend=-1) != 0)
    reach = b[by_height[np.maximum.accumulate(inside * len(b) + rank) % max(1, len(b))]]
    new = np.ones(len(b), bool)
    new[1:] = (g[1:] != g[:-1]) | (a[1:] > reach[:-1] + apart)
    out = np.empty(len(b), np.int64)
    out[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(b)), 0))]
    return out


def merged(pages: pa.Array, tolerance: float) -> pa.Array:
    """Segments (``across, low, high``) of each page that touch or overlap on (nearly) one line, as one."""
    page, (across, low, high) = flat(pages)
    order = np.lexsort((across, page))
    band = np.zeros(len(page), np.int64)
    band[order[1:]] = np.cumsum((page[order[1:]] != page[order[:-1]]) | (across[order[1:]] - across[order[:-1]] > tolerance))
    strip = runs(band, low, high, tolerance)
    line = snapped(strip, across, tolerance)
    run = runs(numbers(strip, line), low, high, tolerance)
    first, last = low.copy(), high.copy()
    np.minimum.at(first, run, low)
    np.maximum.at(last, run, high)
    kept = np.flatnonzero(run == np.arange(len(run)))
    return listed(len(pages), page[kept], {"across": line[kept], "low": first[kept], "high": last[kept]})


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index of each one's component."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        for end in (a, b, root[a], root[b]):  # a whole tree moves with its root
            np.minimum.at(new, end, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def tables(pages: pa.Array, tolerance: float) -> pa.Array:
    """Cells (``x0, x1, y0, y1``) -> those of each page that share a border with another, with their table's box and size."""
    page, (x0, x1, y0, y1) = flat(pages)
    n = len(x0)
    of, both = np.tile(np.arange(n), 2), np.tile(page, 2)
    ends = []
    for line, low, high in ((np.concatenate([x0, x1]), y0, y1), (np.concatenate([y0, y1]), x0, x1)):
        group = numbers(both, snapped(both, line, tolerance))
        ends.append(of[runs(group, low[of], high[of] - tolerance, -1e-9)])  # at the tolerance they only touch
    root = components(n, np.concatenate([of, of]), np.concatenate(ends))
    count = np.bincount(root, minlength=n)[root]
    box = {}
    for name, f, values in (("tx0", np.minimum, x0), ("tx1", np.maximum, x1), ("ty0", np.minimum, y0), ("ty1", np.maximum, y1)):
        edge = values.copy()
        f.at(edge, root, values)
        box[name] = edge[root]
    kept = np.flatnonzero(count > 1)
    fields = {"x0": x0, "x1": x1, "y0": y0, "y1": y1} | box | {"n_cells": count.astype(np.int64)}
    return listed(len(pages), page[kept], {k: f[kept] for k, f in fields.items()})


def matrix(tables: pa.Array, tolerance: float) -> pa.Array:
    """Cells (``page, o, text, x0, x1, y1``, in this order) of each table -> a list of its matrix of texts, empty without any text.

    The k-th columns of all tables are folded at once: a column goes on with its left neighbour unless
    that one has, with all that it took so far, a text in one of its rows.
    """
    entries, n = tables.flatten(), len(tables)
    table = np.repeat(np.arange(n), tables.value_lengths().to_numpy(zero_copy_only=False))
    sheet, _, text, *at = entries.flatten()
    x0, x1, y1 = (f.to_numpy(zero_copy_only=False).astype(float) for f in at)
    sheet = sheet.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
    sheet = np.cumsum((np.diff(table, prepend=-1) != 0) | (np.diff(sheet, prepend=-1) != 0))
    has0, has1 = ~np.isnan(x0), ~np.isnan(x1)
    of = np.concatenate([table[has0], table[has1]])
    edge = snapped(of, np.concatenate([x0[has0], x1[has1]]), tolerance)
    last, least = np.full(n, -np.inf), np.full(n, np.inf)
    np.maximum.at(last, of, edge)
    np.minimum.at(least, of, edge)
    column = np.full(len(x0), np.nan)
    column[has0] = edge[: has0.sum()]
    held = np.flatnonzero(has0 & ((column < last[table]) | (least[table] == last[table])))
    top = snapped(sheet[held], np.where(np.isnan(y1), -np.inf, y1)[held], tolerance)
    said = pc.not_equal(text, "").to_numpy(zero_copy_only=False)[held]
    held, top = held[said], top[said]
    row = numbers(table[held], sheet[held], -top)
    column = numbers(table[held], column[held])
    # Texts of one place as one, in the cells' order.
    order = np.lexsort((held, column, row))
    new = np.flatnonzero((np.diff(row[order], prepend=-1) != 0) | (np.diff(column[order], prepend=-1) != 0))
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(new, len(order)), pa.int32()), text.take(pa.array(held[order]))), " ")
    row, column, table = row[order[new]], column[order[new]], table[held[order[new]]]
    first = np.full(n, len(column))
    np.minimum.at(first, table, column)
    nth = column - first[table]
    fold, taken, place = np.zeros(n, np.int64), np.full(len(row), -1), np.zeros(len(row), np.int64)
    by_nth = np.argsort(nth, kind="stable")
    for k in np.split(by_nth, np.cumsum(np.bincount(nth))[:-1]) if len(nth) else []:
        fold[np.unique(table[k][taken[row[k]] == fold[table[k]]])] += 1
        place[k] = taken[row[k]] = fold[table[k]]
    rows = np.zeros(row.max(initial=-1) + 1, np.int64)
    rows[row] = table
    ends = np.concatenate([[0], np.cumsum(fold[rows] + 1)])
    filled = np.full(ends[-1], -1)
    filled[ends[row] + place] = np.arange(len(row))
    texts = pc.fill_null(text.take(pa.array(filled, mask=filled < 0)), "")
    height = np.bincount(rows, minlength=n)
    lists = lambda ends, values: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
    matrices = lists(np.concatenate([[0], np.cumsum(height[height > 0])]), lists(ends, texts))
    return lists(np.concatenate([[0], np.cumsum(height > 0)]), matrices)

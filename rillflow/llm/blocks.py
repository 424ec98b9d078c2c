"""Keyed exchange of positions as packed blocks.

Tasks that scan texts send (key, id, position) triples in binary blocks, a row for each key range
and chunk instead of a row for each triple; the receiving group sorts its arrays. Keys that several
texts of a chunk share are decided in the chunk and sent once or twice, so a key that a third of all
texts hold costs the receivers as many entries as there are chunks, not as there are texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mix

SCHEMA = "bucket int, keys binary, ids binary, which binary, low binary, high binary, doc_id long, at binary"
_NAMES = ["bucket", "keys", "ids", "which", "low", "high", "doc_id", "at"]
_TYPES = [pa.int32(), *[pa.binary()] * 5, pa.int64(), pa.binary()]
BUCKET_BYTES = 8 << 20  # bytes of text for each key range
CHUNK = 2_000_000  # triples that a task gathers at most, about 32 MB


def bucket_bits(docs: DataFrame, least: int = 6) -> int:
    """log2 of the number of key ranges: one for each ``BUCKET_BYTES`` of text, 64 at least."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, int(np.ceil(np.log2(max(1, total / BUCKET_BYTES)))))


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by key, and where each key starts in it."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))


def _by_id(ids: np.ndarray, pos: np.ndarray) -> tuple[list[int], list[bytes]]:
    order = np.lexsort((pos, ids))
    ids, pos = ids[order], pos[order].astype(np.uint32)
    cuts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
    return ids[cuts].tolist(), [p.tobytes() for p in np.split(pos, cuts[1:])] if len(cuts) else []


def _decided(keys: np.ndarray, ids: np.ndarray, mode: str) -> tuple[np.ndarray, np.ndarray]:
    """Masks over the triples: which are decided here, and which to send on.

    ``first``: decided are those whose key a smaller id holds too, and those of the smallest go on.
    ``shared``: decided are all whose key two ids hold; of these, those of the smallest and of the
    largest id go on. ``again``: decided are all whose key occurs twice; two of these go on. Keys
    that nothing decides go on whole.
    """
    if not len(keys):
        return np.zeros(0, bool), np.zeros(0, bool)
    order, starts = _groups(keys)
    g = ids[order]
    size = np.diff(np.append(starts, len(g)))
    done, send = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if mode == "again":
        done[order] = np.repeat(size, size) > 1
        send[order] = np.arange(len(g)) - np.repeat(starts, size) < 2
        return done, send
    low = np.repeat(np.minimum.reduceat(g, starts), size)
    if mode == "first":
        done[order], send[order] = g > low, g == low
        return done, send
    high = np.repeat(np.maximum.reduceat(g, starts), size)
    done[order] = low != high
    send[order] = (low == high) | (g == low) | (g == high)
    return done, send


def sent(chunks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], bits: int, mode: str) -> Iterator[pa.RecordBatch]:
    """Chunks of (keys uint64, ids int64, positions) -> blocks by key range, and what is decided already.

    What is decided goes the same way, in ranges of ids below 0, so the texts are scanned once and
    nothing is written in between.
    """
    for keys, ids, pos in gathered(chunks, bits):
        done, send = _decided(keys, ids, mode)
        who, at = _by_id(ids[done], pos[done])
        if who:
            none = [None] * len(who)
            aside = -1 - (mix(np.array(who, np.int64).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
            yield _batch([aside.tolist(), none, none, none, none, none, who, at])
        keys, ids, pos = keys[send], ids[send], pos[send].astype(np.uint32)
        bucket = (keys >> np.uint64(64 - bits)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket, keys, ids, pos = bucket[order], keys[order], ids[order], pos[order]
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
        cols: list[list] = [[] for _ in _NAMES]
        for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
            every, which = np.unique(ids[a:b], return_inverse=True)
            row = [int(bucket[a]), keys[a:b].tobytes(), np.diff(every, prepend=0).tobytes(), which.astype(np.uint32).tobytes(), (pos[a:b] & 0xFFFF).astype(np.uint16).tobytes(), (pos[a:b] >> 16).astype(np.uint16).tobytes(), None, None]
            for c, v in zip(cols, row):
                c.append(v)
        if cols[0]:
            yield _batch(cols)


def _batch(cols: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], _NAMES)


def gathered(chunks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks joined until each key range has about 256 triples, but at least 100,000 and at most ``CHUNK`` in all."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n = 0
    for c in chunks:
        held.append(c)
        n += len(c[0])
        if n >= min(CHUNK, max(100_000, 256 << bits)):
            yield tuple(map(np.concatenate, zip(*held)))
            held, n = [], 0
    if n:
        yield tuple(map(np.concatenate, zip(*held)))


def settle(mode: str) -> Callable[[pa.Table], pa.Table]:
    """The receiving group's function: the blocks of one key range -> decided (doc_id, at)."""

    def run(t: pa.Table) -> pa.Table:
        if t.column("bucket")[0].as_py() < 0:
            return t.select(["doc_id", "at"])
        keys, ids, pos = [], [], []
        for k, i, w, lo, hi in zip(*(t.column(c).to_pylist() for c in ("keys", "ids", "which", "low", "high"))):
            keys.append(np.frombuffer(k, np.uint64))
            ids.append(np.cumsum(np.frombuffer(i, np.int64))[np.frombuffer(w, np.uint32)])
            pos.append(np.frombuffer(lo, np.uint16).astype(np.uint32) | np.frombuffer(hi, np.uint16).astype(np.uint32) << np.uint32(16))
        key, who, at = np.concatenate(keys), np.concatenate(ids), np.concatenate(pos)
        done, _ = _decided(key, who, mode)
        names, places = _by_id(who[done], at[done])
        return pa.table([pa.array(names, pa.int64()), pa.array(places, pa.binary())], names=["doc_id", "at"])

    return run


def exchanged(blocks: DataFrame, mode: str) -> DataFrame:
    """Blocks of ``sent`` -> a row per id with all its decided positions: ``doc_id, at array<binary>``."""
    return blocks.groupBy("bucket").applyInArrow(settle(mode), "doc_id long, at binary").groupBy("doc_id").agg(F.collect_list("at").alias("at"))


def positions(at: list[bytes] | None) -> np.ndarray:
    """The distinct positions of one id, in order."""
    return np.unique(np.concatenate([np.frombuffer(b, np.uint32) for b in at])) if at else np.zeros(0, np.uint32)

"""Suffix-array dedup of byte strings by induced sorting in shards.

Two equal 200-byte strings choose the same anchor, the 64 bytes of smallest hash in them, so a text
falls into segments: an anchor with all the 200-byte strings that choose it. Segments meet by anchor.
Segments with equal content repeat whole; where an anchor has several contents, one of each goes to
the anchor's shard, whose suffix array is built by induced sorting (``suffixes``); strings repeat
where permuted common prefixes reach 200 bytes. An anchor with too many contents for a shard, such
as a line that a third of all texts hold, has its strings exchanged by hash instead, spread evenly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import CHUNK, SCHEMA, bucket_bits, exchanged, sent
from .common import bitmap, cut, in_bitmap, pick, table
from .suffixes import permuted_prefixes, suffix_array
from .words import _BASE, _TABLE, _powers, mix, slices

LENGTH = 200  # bytes of a repeated string
GRAM = 64  # bytes of an anchor
CHUNK_CONTENTS = 64  # contents of one anchor that a chunk sends to its shard at most
SHARD_CONTENTS = 2048  # contents of one anchor that a shard sorts at most
SHARD_BYTES = 700_000
WHOLE, SEND, SEND_TWICE, HOT = range(4)


class Segments:
    """The segments of some texts: ``doc``, ``lo``/``hi`` (first and last start in the text), anchor and content hashes."""

    def __init__(self, texts: list[bytes | None]):
        self.raw = raw = np.frombuffer(b"".join([t or b"" for t in texts]), np.uint8)
        n = len(raw)
        ends = np.cumsum([len(t or b"") for t in texts])
        self.begin = ends - [len(t or b"") for t in texts]
        powers, self.back = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 1 << 64), n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[raw] * powers[:n], out=self.total[1:])
        self.doc = self.lo = self.hi = self.start = np.zeros(0, np.int64)
        self.anchor = self.content = np.zeros(0, np.uint64)
        if n < LENGTH:
            return
        keys = self.strings(np.arange(n - GRAM + 1), GRAM) & np.uint64(0xFFFFFFFF00000000) | np.arange(n - GRAM + 1, dtype=np.uint64)
        span = LENGTH - GRAM + 1
        rows = np.full(-(-len(keys) // span) * span, np.iinfo(np.uint64).max)
        rows[: len(keys)] = keys
        rows = rows.reshape(-1, span)
        left = np.minimum.accumulate(rows, axis=1).ravel()
        right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        m = n - LENGTH + 1
        chosen = (np.minimum(right[:m], left[span - 1 : span - 1 + m]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        edge = np.zeros(m + 1, np.int64)  # starts whose string ends in the same text
        room = ends - self.begin >= LENGTH
        np.add.at(edge, self.begin[room], 1)
        np.add.at(edge, ends[room] - LENGTH + 1, -1)
        at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        if not len(at):
            return
        a = chosen[at]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        self.start, stop = at[first], at[last] + LENGTH
        self.doc = np.searchsorted(ends, self.start, side="right")
        self.lo, self.hi = self.start - self.begin[self.doc], at[last] - self.begin[self.doc]
        self.anchor = mix(self.strings(a[first], GRAM))
        shape = (stop - self.start).astype(np.uint64) << np.uint64(20) ^ (a[first] - self.start).astype(np.uint64)
        self.content = mix(mix((self.total[stop] - self.total[self.start]) * self.back[self.start]) ^ shape)

    def strings(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the strings of ``length`` bytes that start at these places of ``raw``."""
        return mix((self.total[at + length] - self.total[at]) * self.back[at])


_MEET = ["bucket", "anchors", "contents", "ids", "which", "low", "high", "weights", "hk", "kind", "at"]
_MEET_TYPES = [pa.int32(), *[pa.binary()] * 7, pa.int64(), pa.int32(), pa.binary()]
_MEET_SCHEMA = "bucket int, anchors binary, contents binary, ids binary, which binary, low binary, high binary, weights binary, hk long, kind int, at binary"


def _told(ids: np.ndarray, kinds: np.ndarray, pos: np.ndarray) -> tuple[list[int], list[int], list[bytes]]:
    """Rows (id, kind, packed positions) of some answers."""
    order = np.lexsort((pos, kinds, ids))
    ids, kinds, pos = ids[order], kinds[order], pos[order].astype(np.uint32)
    if not len(ids):
        return [], [], []
    cuts = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (kinds[1:] != kinds[:-1])]))
    return ids[cuts].tolist(), kinds[cuts].tolist(), [p.tobytes() for p in np.split(pos, cuts[1:])]


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of rows equal in all columns starts."""
    return np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)]))


def _chunks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[tuple[np.ndarray, ...]]:
    held, n = [], 0
    for batch in batches:
        ids = batch.column("hk").to_numpy(zero_copy_only=False)
        for lo, texts in slices(batch.column("text")):
            s = Segments(texts)
            held.append((s.anchor, s.content, ids[lo + s.doc], s.lo))
            n += len(s.lo)
            if n >= min(CHUNK, max(60_000, 256 << bits)):
                yield tuple(map(np.concatenate, zip(*held)))
                held, n = [], 0
    if n:
        yield tuple(map(np.concatenate, zip(*held)))


def _meet(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (hk, text) -> segments by anchor range in blocks, and what their chunk decides already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchor, content, ids, pos in _chunks(batches, bits):
            order = np.lexsort((pos, content, anchor))
            anchor, content, ids, pos = anchor[order], content[order], ids[order], pos[order]
            starts = _runs(anchor, content)
            size = np.diff(np.append(starts, len(anchor)))
            again = np.repeat(size > 1, size)
            groups = _runs(anchor[starts])  # the first content of each anchor
            nth = np.arange(len(starts)) - np.repeat(groups, np.diff(np.append(groups, len(starts))))
            late = nth >= CHUNK_CONTENTS
            hot = np.isin(anchor[starts], anchor[starts][late])
            kinds = np.full(int(again.sum()), WHOLE)
            who, kind, at = _told(np.append(ids[again], ids[starts[late]]), np.append(kinds, np.full(int(late.sum()), HOT)), np.append(pos[again], pos[starts[late]]))
            none = [None] * len(who)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([[-1] * len(who), *[none] * 7, who, kind, at], _MEET_TYPES)], _MEET)
            keep = starts[~late]
            weight = (np.minimum(size[~late], 2) + 4 * hot[~late]).astype(np.uint8)
            a, c, i, p = anchor[keep], content[keep], ids[keep], pos[keep].astype(np.uint32)
            bucket = (a >> np.uint64(64 - bits)).astype(np.int32)  # in order, as anchors are
            cols: list[list] = [[] for _ in _MEET]
            cuts = _runs(bucket)
            for x, y in zip(cuts, np.append(cuts[1:], len(bucket))):
                every, which = np.unique(i[x:y], return_inverse=True)
                row = [int(bucket[x]), a[x:y].tobytes(), c[x:y].tobytes(), every.tobytes(), which.astype(np.uint32).tobytes(), (p[x:y] & 0xFFFF).astype(np.uint16).tobytes(), (p[x:y] >> 16).astype(np.uint16).tobytes(), weight[x:y].tobytes(), None, None, None]
                for col, v in zip(cols, row):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _MEET_TYPES)], _MEET)

    return run


def _settle(t: pa.Table) -> pa.Table:
    """The segments of one anchor range -> answers (hk, kind, at)."""
    parts: list[list[np.ndarray]] = [[] for _ in range(5)]
    for a, c, i, w, lo, hi, g in zip(*(t.column(n).to_pylist() for n in _MEET[1:8])):
        pos = np.frombuffer(lo, np.uint16).astype(np.uint32) | np.frombuffer(hi, np.uint16).astype(np.uint32) << np.uint32(16)
        for out, v in zip(parts, (np.frombuffer(a, np.uint64), np.frombuffer(c, np.uint64), np.frombuffer(i, np.int64)[np.frombuffer(w, np.uint32)], pos, np.frombuffer(g, np.uint8))):
            out.append(v)
    anchor, content, ids, pos, flags = map(np.concatenate, parts)
    order = np.lexsort((pos, ids, content, anchor))
    anchor, content, ids, pos, flags = (x[order] for x in (anchor, content, ids, pos, flags))
    starts = _runs(anchor, content)
    size = np.diff(np.append(starts, len(anchor)))
    weight = np.add.reduceat((flags & 3).astype(np.int64), starts)
    groups = _runs(anchor[starts])
    per = np.diff(np.append(groups, len(starts)))
    hot = np.repeat(np.maximum.reduceat(np.maximum.reduceat(flags, starts), groups) >= 4, per)
    many = np.repeat(per > 1, per)
    hot |= np.repeat(per > SHARD_CONTENTS, per)
    again = np.repeat(weight > 1, size)
    kind = np.where(hot, HOT, np.where(weight > 1, SEND_TWICE, SEND))
    one = starts[many | hot]
    who, kinds, at = _told(np.append(ids[again], ids[one]), np.append(np.full(int(again.sum()), WHOLE), kind[many | hot]), np.append(pos[again], pos[one]))
    return pa.table([pa.array(who, pa.int64()), pa.array(kinds, pa.int32()), pa.array(at, pa.binary())], names=["hk", "kind", "at"])


def _asked(said: list[dict], kinds: tuple[int, ...]) -> np.ndarray:
    found = [np.frombuffer(x["at"], np.uint32) for x in said if x["kind"] in kinds]
    return np.unique(np.concatenate(found)).astype(np.int64) if found else np.zeros(0, np.int64)


_FETCHED = ["hk", "lo", "hi", "shard", "anchor", "twice", "part"]
_FETCHED_TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()]


def _fetch(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (hk, text, said) -> ranges of starts that repeat whole, and the segments that shards ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("hk").to_pylist()
            for lo, texts in slices(batch.column("text")):
                said = batch.column("said").slice(lo, len(texts)).to_pylist()
                s = Segments(texts)
                of = np.searchsorted(s.doc, np.arange(len(texts) + 1))
                cols: list[list] = [[] for _ in _FETCHED]
                for i, answers in enumerate(said):
                    mine = slice(of[i], of[i + 1])
                    whole = np.isin(s.lo[mine], _asked(answers, (WHOLE,)))
                    if whole.any():
                        row = [ids[lo + i], s.lo[mine][whole].astype(np.uint32).tobytes(), s.hi[mine][whole].astype(np.uint32).tobytes(), None, None, None, None]
                        for c, v in zip(cols, row):
                            c.append(v)
                    for kind in (SEND, SEND_TWICE):
                        for k in np.flatnonzero(np.isin(s.lo[mine], _asked(answers, (kind,)))) + of[i]:
                            part = texts[i][s.lo[k] : s.hi[k] + LENGTH]
                            row = [ids[lo + i], np.uint32(s.lo[k]).tobytes(), None, int(s.anchor[k] >> np.uint64(64 - bits)), int(s.anchor[k].astype(np.int64)), kind == SEND_TWICE, part]
                            for c, v in zip(cols, row):
                                c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _FETCHED_TYPES)], _FETCHED)

    return run


def _again(parts: list[bytes], twice: list[bool]) -> list[np.ndarray]:
    """Per segment the starts in it whose string occurs twice among all of them."""
    sizes = np.array([len(p) for p in parts])
    text = np.frombuffer(b"\x00".join(parts), np.uint8).astype(np.int16)
    begin = np.cumsum(np.append(0, sizes[:-1] + 1))
    s = np.append(text + 2, [1, 0]).astype(np.int16)
    s[begin[1:] - 1] = 1
    weight = np.zeros(len(s), np.int8)
    for b, n, t in zip(begin, sizes, twice):
        weight[b : b + n - LENGTH + 1] = 2 if t else 1
    sa = suffix_array(s)
    near = permuted_prefixes(s, sa, LENGTH)[sa] >= LENGTH
    runs = np.flatnonzero(~near)
    total = np.repeat(np.add.reduceat(weight[sa], runs, dtype=np.int64), np.diff(np.append(runs, len(sa))))
    again = np.zeros(len(s), bool)
    again[sa] = (total > 1) & (weight[sa] > 0)
    return [np.flatnonzero(again[b : b + n - LENGTH + 1]) for b, n in zip(begin, sizes)]


def _sorted_shard(t: pa.Table) -> pa.Table:
    """The segments of one shard -> (hk, lo, hi): starts whose string occurs twice.

    Segments of different anchors hold different strings, so a shard is sorted in runs of whole
    anchors of about ``SHARD_BYTES``, whatever its size.
    """
    t = t.sort_by("anchor")
    anchors = t.column("anchor").to_numpy()
    edges = np.append(_runs(anchors), len(anchors))
    upto = np.cumsum(np.append(0, pc.binary_length(t.column("part")).to_numpy().astype(np.int64)))
    who: list[int] = []
    starts: list[bytes] = []
    at = 0
    while at < len(edges) - 1:
        end = max(at + 1, int(np.searchsorted(upto[edges], upto[edges[at]] + SHARD_BYTES, side="right")) - 1)
        run = t.slice(edges[at], edges[end] - edges[at])
        found = _again(run.column("part").to_pylist(), run.column("twice").to_pylist())
        for i, lo, hit in zip(run.column("hk").to_pylist(), run.column("lo").to_pylist(), found):
            if len(hit):
                who.append(i)
                starts.append((hit + np.frombuffer(lo, np.uint32)[0]).astype(np.uint32).tobytes())
        at = end
    return pa.table([pa.array(who, pa.int64()), pa.array(starts, pa.binary()), pa.array(starts, pa.binary())], names=["hk", "lo", "hi"])


def _hot(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows (hk, text, said) -> every string of the segments whose anchor is hot."""
    for batch in batches:
        ids = batch.column("hk").to_numpy(zero_copy_only=False)
        for lo, texts in slices(batch.column("text")):
            said = batch.column("said").slice(lo, len(texts)).to_pylist()
            s = Segments(texts)
            of = np.searchsorted(s.doc, np.arange(len(texts) + 1))
            hit = [np.flatnonzero(np.isin(s.lo[of[i] : of[i + 1]], _asked(a, (HOT,)))) + of[i] for i, a in enumerate(said)]
            k = np.concatenate(hit)
            n = s.hi[k] - s.lo[k] + 1
            if len(k):
                at = np.repeat(s.start[k] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
                doc = np.repeat(s.doc[k], n)
                yield s.strings(at, LENGTH), ids[lo + doc], at - s.begin[doc]


def _among(bits: np.ndarray, inside: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows whose hk may be in the bitmap, or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = in_bitmap(bits, b.column("hk").to_numpy(zero_copy_only=False).view(np.uint64))
            yield b.filter(pa.array(hit == inside))

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, gone) -> bytes, removed bytes and runs, and the bytes that stay."""
    for batch in batches:
        for lo, texts in slices(batch.column("text")):
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for t, gone in zip(texts, batch.column("gone").slice(lo, len(texts)).to_pylist()):
                t = t or b""
                out, spans = t, 0
                if gone:
                    edge = np.zeros(len(t) + 1, np.int64)
                    for x in gone:
                        np.add.at(edge, np.frombuffer(x["lo"], np.uint32), 1)
                        np.add.at(edge, np.frombuffer(x["hi"], np.uint32).astype(np.int64) + LENGTH, -1)
                    off = np.cumsum(edge[:-1]) > 0
                    spans = int(np.count_nonzero(np.diff(off.astype(np.int8), prepend=np.int8(0)) == 1))
                    out = np.frombuffer(t, np.uint8)[~off].tobytes()
                n_bytes.append(len(t))
                n_removed.append(len(t) - len(out))
                n_spans.append(spans)
                kept.append(out)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, len(texts)), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def dedup_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Removes each byte that a 200-byte string covers which starts anywhere else too.

    Returns a row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept`` (binary: the other bytes). Matches never cross texts; overlapping occurrences count;
    strings are judged on the input. Null and short texts lose nothing; repeated rows are texts of
    their own, so they remove each other; an empty table gives an empty result; other columns are
    ignored. Strings are compared by 64-bit hashes and in suffix arrays.
    """
    d = pick(docs, doc_id=id_col, text=text_col)
    kind = dict(d.dtypes)["doc_id"]
    rows = d.withColumn("hk", F.xxhash64("doc_id", "text"))
    bits = bucket_bits(d)
    text = rows.select("hk", "text")

    met = cut(text.mapInArrow(_meet(bits), _MEET_SCHEMA))
    answers = met.where("bucket >= 0").groupBy("bucket").applyInArrow(_settle, "hk long, kind int, at binary").union(met.where("bucket < 0").select("hk", "kind", "at"))
    said = cut(answers.groupBy("hk").agg(F.collect_list(F.struct("kind", "at")).alias("said")))
    sends = said.select(F.explode("said").alias("x")).where(F.col("x.kind").isin(SEND, SEND_TWICE)).agg(F.sum(F.octet_length("x.at") / 4)).first()[0] or 0
    shard_bits = max(6, int(np.ceil(np.log2(max(1, sends * 280 / SHARD_BYTES)))))
    named = text.mapInArrow(_among(bitmap(said, F.col("hk"), 26), True), "hk long, text string").join(said, "hk")
    fetched = cut(named.mapInArrow(_fetch(shard_bits), "hk long, lo binary, hi binary, shard int, anchor long, twice boolean, part binary"))
    in_shards = fetched.where("part is not null").groupBy("shard").applyInArrow(_sorted_shard, "hk long, lo binary, hi binary")
    has_hot = said.where(F.exists("said", lambda x: x["kind"] == HOT))
    in_strings = text.mapInArrow(_among(bitmap(has_hot, F.col("hk"), 26), True), "hk long, text string").join(has_hot, "hk")
    in_strings = exchanged(in_strings.mapInArrow(lambda b: sent(_hot(b), bits, "again"), SCHEMA), "again").select(F.col("doc_id").alias("hk"), F.explode("at").alias("lo")).withColumn("hi", F.col("lo"))
    ranges = fetched.where("part is null").select("hk", "lo", "hi").union(in_shards).union(in_strings)
    gone = cut(ranges.groupBy("hk").agg(F.collect_list(F.struct("lo", "hi")).alias("gone")))

    some = bitmap(gone, F.col("hk"), 26)
    shape = f"doc_id {kind}, text string, hk long"
    out = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    changed = rows.mapInArrow(_among(some, True), shape).join(gone, "hk", "left").select("doc_id", "text", "gone").mapInArrow(_kept, out)
    none = F.lit(None).cast("array<struct<lo:binary,hi:binary>>").alias("gone")
    same = rows.mapInArrow(_among(some, False), shape).select("doc_id", "text", none).mapInArrow(_kept, out)
    return changed.unionByName(same)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without the bytes of 200-byte strings that occur twice."""
    return dedup_substrings(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

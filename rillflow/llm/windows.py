"""Substring dedup by difference-cover anchors.

Every text is hashed in windows of ``PERIOD`` words, but only at positions whose remainder modulo
``PERIOD`` lies in a difference cover: any two places have a common shift of less than a period that
brings both to cover positions, so two equal runs of ``2 * PERIOD - 1`` words, however they lie in
their texts, share a window at an aligned anchor. Anchors that two texts share are extended to the
whole 13-word windows around them, which are then compared themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import SCHEMA, bucket_bits, exchanged, positions, sent
from .common import bitmap, cut, in_bitmap, pick, table
from .words import Words, runs, slices

PERIOD = 7
COVER = (0, 1, 3)  # every difference modulo 7 is one of two members
WINDOW = 2 * PERIOD - 1


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    for batch in batches:
        ids = _ids(batch)
        for lo, texts in slices(batch.column("text")):
            w = Words(texts)
            h = runs(w.hashes(), PERIOD)
            at = np.arange(len(h)) - w.first[w.doc[: len(h)]]
            last = w.first[w.doc[: len(h)] + 1] - w.first[w.doc[: len(h)]] - PERIOD
            keep = np.flatnonzero((at <= last) & cover[at % PERIOD])
            yield h[keep], ids[lo + w.doc[keep]], at[keep]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows (doc_id, text, at: shared anchors) -> the whole windows that hold a shared anchor."""
    for batch in batches:
        ids = _ids(batch)
        for lo, texts in slices(batch.column("text")):
            shared = batch.column("at").slice(lo, len(texts)).to_pylist()
            w = Words(texts)
            h = runs(w.hashes(), WINDOW)
            out = []
            for i in range(len(texts)):
                first, n = int(w.first[i]), int(w.first[i + 1] - w.first[i]) - WINDOW + 1
                if n > 0:
                    p = positions(shared[i]).astype(np.int64)
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, np.clip(p - PERIOD + 1, 0, n), 1)
                    np.add.at(edge, np.clip(p + 1, 0, n), -1)
                    starts = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                    out.append((h[first + starts], np.full(len(starts), ids[lo + i]), starts))
            if out:
                yield tuple(map(np.concatenate, zip(*out)))


def _among(bits: np.ndarray, inside: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows whose hk may be in the bitmap, or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = in_bitmap(bits, b.column("hk").to_numpy(zero_copy_only=False).view(np.uint64))
            yield b.filter(pa.array(hit == inside)).select(["doc_id", "text"])

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, at: starts of repeated windows) -> words, removed words, kept text."""
    for batch in batches:
        for lo, texts in slices(batch.column("text")):
            n_words, n_removed, kept = [], [], []
            for t, at in zip(texts, batch.column("at").slice(lo, len(texts)).to_pylist()):
                words = (t or b"").split()  # bytes.split() knows the same six separators
                n_words.append(len(words))
                if at:
                    edge = np.zeros(len(words) + WINDOW + 1, np.int64)
                    p = positions(at).astype(np.int64)
                    edge[p] += 1
                    edge[p + WINDOW] -= 1
                    stay = np.cumsum(edge)[: len(words)] == 0
                    words = [x for x, s in zip(words, stay) if s]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, len(texts)), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def dedup_windows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Removes each word that a 13-word window covers which also starts in a text with a smaller id.

    Returns a row per input row: id, ``n_words``, ``n_removed``, ``kept`` (the other words joined by
    one space). Ids are integers; a null id never matches and keeps its words. Null and short texts
    lose nothing; rows with equal ids are no smaller than one another; windows are judged on the
    input; an empty table gives an empty result; other columns are ignored. Keys are 64-bit hashes.
    Only texts that may hold shared anchors are shuffled; a bitmap of fixed size tells the others.
    """
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    named = d.where(F.col("doc_id").isNotNull())
    bits = bucket_bits(named)
    hashed = named.select("doc_id", "text", F.xxhash64("doc_id").alias("hk"))

    def among(bits_: np.ndarray, inside: bool) -> DataFrame:
        return hashed.mapInArrow(_among(bits_, inside), "doc_id long, text string")

    def marked(found: DataFrame) -> np.ndarray:
        return bitmap(found, F.xxhash64("doc_id"), 26)

    anchors = cut(exchanged(named.mapInArrow(lambda b: sent(_anchors(b), bits, "shared"), SCHEMA), "shared"))
    around = among(marked(anchors), True).join(anchors, "doc_id")
    repeated = cut(exchanged(around.mapInArrow(lambda b: sent(_windows(b), bits, "first"), SCHEMA), "first"))
    shape = "doc_id long, n_words long, n_removed long, kept string"
    none = F.lit(None).cast("array<binary>").alias("at")
    some = marked(repeated)
    changed = among(some, True).join(repeated, "doc_id", "left").select("doc_id", "text", "at").mapInArrow(_kept, shape)
    same = among(some, False).select("doc_id", "text", none).unionByName(d.where(F.col("doc_id").isNull()).select("doc_id", "text", none)).mapInArrow(_kept, shape)
    return changed.unionByName(same)


def op9_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without the words of windows that a smaller doc_id holds too."""
    return dedup_windows(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH words AS (SELECT doc_id, CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS s, w FROM words WHERE len(w) >= 13),
windows AS (SELECT doc_id, s, array_to_string(w[s : s + 12], ' ') AS k FROM starts),
repeated AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY k) AS first FROM windows) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS i FROM repeated),
each AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT e.doc_id, count(*) AS n_kept, string_agg(e.x, ' ' ORDER BY e.i) AS t
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept ON words.doc_id = kept.doc_id
"""

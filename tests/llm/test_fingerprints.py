import hashlib
import struct

import pyarrow.parquet as pq
import xxhash
from helpers import SF, documents

from rillflow.llm.fingerprints import edited_likeness, fingerprints, op8_order_minhash

MASK = (1 << 64) - 1


def h64(*parts, seed=42):
    for p in parts:
        raw = p.encode() if isinstance(p, str) else p
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


def brute(text):
    """Order MinHash written out: numbered k-mers, two least of each of 32 parts, in text order, hashed."""
    w = [x for x in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    kmers = [h64(a, b) for a, b in zip(w, w[1:])] or [h64(x) for x in w]
    seen, parts = {}, {}
    for place, k in enumerate(kmers):
        key = k >> 28
        nth = seen[key] = seen.get(key, -1) + 1
        v = h64(struct.pack("<q", key), struct.pack("<i", nth)) >> 28 if nth else key
        parts.setdefault(v >> 31, []).append((v if v < 1 << 35 else v - (1 << 36), place, v))
    out = set()
    for part, found in parts.items():
        ranked = sorted(found)[:2]
        ordered = [v for _, _, v in sorted(ranked, key=lambda x: x[1])]
        out.add(part << 59 | h64(*(struct.pack("<q", v) for v in ordered)) & (1 << 59) - 1)
    return out


def test_against_brute_force(spark):
    texts = [d["text"] for d in pq.read_table(f"{SF}/documents.parquet").to_pylist()] + ["", "one", "a b", "a b a b a b a b", "x " * 3000, " \n", None]
    rows = fingerprints(documents(spark, texts).select("doc_id", "text"), fp="text").collect()
    for r in rows:
        assert {x & MASK for x in r.fp} == brute(r.text), r.doc_id


def test_edits_and_neighbours(spark):
    docs = sorted(((d["doc_id"], d["text"]) for d in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()), reverse=True)
    got = {r.doc_id: r for r in op8_order_minhash(spark, "/root/testdata/sf0.01").collect()}
    for k, (i, t) in enumerate(docs):
        after, q = docs[(k + 1) % len(docs)][1], len(t) // 3
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256((t[: len(t) - q] + after[:q]).encode()).hexdigest()
    long = [r for i, r in got.items() if len(dict(docs)[i]) > 500]
    assert sum(r.near_edited > r.near_next for r in long) > 0.98 * len(long)


def test_order_matters_and_edges(spark):
    base = [f"w{i}" for i in range(300)]
    moved = base[150:] + base[:150]
    rows = edited_likeness(documents(spark, [" ".join(base), " ".join(base), None, "", " ".join(moved)])).collect()
    by = {r.doc_id: r for r in rows}
    assert by[1].fp == by[0].fp and by[1].near_next == 1.0 and by[3].near_next == 1.0 and by[2].edited == ""
    docs = documents(spark, ["a b c", None])
    assert edited_likeness(docs.unionAll(docs)).count() == 4 and edited_likeness(docs.limit(0)).count() == 0
    assert edited_likeness(docs.limit(1)).first().near_next == 1.0

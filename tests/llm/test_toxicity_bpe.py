import base64
import hashlib
import struct
import zlib

import public_tokenizers
import pyarrow.parquet as pq
import tiktoken
from helpers import SF, documents

from rillflow.llm.bpe import encode, op5_bpe
from rillflow.llm.toxicity import IDENTITY_GROUPS, fit_words, op4_toxicity, toxicity


def reference():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_tiktoken(spark):
    texts = {d["doc_id"]: d["text"] for d in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    e = reference()
    for r in op5_bpe(spark, SF).collect():
        ids = e.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_edges(spark):
    texts = [None, "", " ", "\n\n  \t", "▁ a b \U0001f600́", "a" * 50_000, "<unk><s>", "\x00\x01", "don't  can't", "12345 ½ ٣٤", "ée", "1 2\r\n3 " * 4000]
    e = reference()
    rows = encode(documents(spark, texts)).select("doc_id", "tokens.*", "lang").collect()
    for r in rows:
        t = texts[r.doc_id] or ""
        ids = e.encode_ordinary(t)
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids) and bytes(r.decoded).decode() == t
    assert encode(documents(spark, ["a"]).limit(0)).count() == 0


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    rows = op4_toxicity(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    tp, fp, fn = (sum(1 for y, p in held if (y, p) == k) for k in ((1, 1), (0, 1), (1, 0)))
    assert tp / (tp + fn) > 0.9 and fp <= 0.01 * len(held)


def test_swaps_lower_the_weight_of_identity_terms():
    filler = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(400):
        toxic = i % 4 == 0
        words = filler[i % 30 : i % 30 + 8] + (["vile"] if toxic and i % 3 else []) + (["muslims"] if toxic and i % 8 else [])
        rows.append((words, int(toxic)))
    text = "muslims " + " ".join(filler[:6])
    plain, fair = (fit_words(rows, penalty=p).scorer() for p in (0.0, 50.0))
    assert fair(text) < plain(text)
    swapped = text.replace("muslims", IDENTITY_GROUPS[2][0])
    assert abs(fair(text) - fair(swapped)) < abs(plain(text) - plain(swapped))
    assert fair("vile " + " ".join(filler[:6])) > 0.5


def test_toxicity_edges(spark):
    docs = documents(spark, [None, "", "you moron " * 3, "fine words", "word " * 60_000])
    labels = spark.createDataFrame([(2, 1), (3, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity(docs.unionAll(docs), labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity(docs.limit(0), labels).count() == 0

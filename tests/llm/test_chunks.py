"""Chunked encoding gives the library's ids and texts, whatever is shared, cut or repeated."""

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from rillflow.llm import chunks
from helpers import SF, documents


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(public_tokenizers.path(chunks.VOCABULARY))
    t.no_truncation()
    t.no_padding()
    return lambda x: (e := t.encode(x or "", add_special_tokens=False).ids, t.decode(e, skip_special_tokens=False))


def got(df):
    return sorted(((r["doc_id"], np.frombuffer(bytes(r["ids"]), "<u4").tolist(), r["decoded"]) for r in df.collect()), key=repr)


def want(rows, library):
    return sorted(((i, *library(t)) for i, t in rows), key=repr)


def words(seed, n, sep=" "):
    rng = np.random.default_rng(seed)
    return sep.join("".join(rng.choice(list("aeinrstÉß文字9.'"), rng.integers(1, 9))) for _ in range(n))


def test_equal_passages_fall_into_equal_chunks():
    shared = words(1, 2000).encode()
    a, b = (set(chunks.chunked(p + shared)[1]) for p in (b"one two three ", words(2, 50).encode()))
    assert len(a & b) > 0.9 * len(a)
    for raw in (b"", b"x", shared, "é文".encode() * 9000):
        parts, _ = chunks.chunked(raw)
        assert b"".join(parts) == raw and all(p.decode() and len(p) <= chunks.MOST for p in parts)


def test_shared_cut_and_endless_words(spark, library):
    common, endless = words(3, 900), "文" * 3000 + "x" * 9000
    texts = [None, "", " \n ", "word", common, common + " tail", "Head\t" + common + "\n\n" + common, words(4, 5) + common, endless, "a" + endless, endless + " b " + endless]
    texts += [common.replace(" ", "  \n"), common.replace("e ", "\x1c\u2028 "), common.replace("a", "\u00a0"), words(9, 300).replace("e", "<|endoftext|>"), common.replace(" ", " "), "<|endoftext|>" * 700, common[:3000] + "<|startoftext|>" + common[3000:], "é ́" * 900, "İΣς" * 900, words(5, 4000)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(chunks.encode(df)) == want(rows, library)


def test_repeated_rows_null_ids_and_other_columns(spark, library):
    text = words(6, 600)
    rows = [(None, text)] * 5 + [(7, text)] * 3 + [(7, "short")] * 2 + [(None, None)] * 2 + [(8, text + "s")]
    df = spark.createDataFrame([(i, t, "x", b"y") for i, t in rows], "DOC_ID long, text string, pos string, h binary").withColumnRenamed("DOC_ID", "doc_id").repartition(4)
    out = chunks.encode(df)
    assert out.columns == ["doc_id", "ids", "decoded"] and got(out) == want(rows, library)
    assert chunks.encode(documents(spark, [])).count() == 0


def test_join_that_tokens_cross_is_refused():
    t = tokenizers.Tokenizer(tokenizers.models.BPE({"a": 0, "b": 1, " ": 2, "a ": 3, "a b": 4}, [("a", " "), ("a ", "b")]))
    j = chunks.Joiner(t.to_str())
    j.learn({"a", "b"})
    with pytest.raises(ValueError):
        j.joined("a a a a", "", " b b b b")


def test_words_met_again_are_encoded_once(monkeypatch, library):
    monkeypatch.setattr(chunks, "CACHED", 40)
    with open(public_tokenizers.path(chunks.VOCABULARY), encoding="utf-8") as f:
        j = chunks.Joiner(f.read())
    library_t, given = j.t, []

    class Counted:
        def encode(self, words, **how):
            given.extend(words)
            return library_t.encode(words, **how)

    j.t = Counted()
    often = {"often", "met", "words"}
    for k in range(60):
        some = often | {f"rare{k}x{i}" for i in range(10)}
        j.learn(some)
        assert all(np.frombuffer(j.known[w], j.kind).tolist() == library(w)[0] for w in some) and len(j.known) + len(j.older) <= 2 * (40 + 13)
    assert all(given.count(w) == 1 for w in often) and len(given) == 603


def test_whole_table(spark, library):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(chunks.encode(spark.read.parquet(f"{SF}/documents.parquet"))) == want(rows, library)
    assert chunks.op13_chunk_reuse(spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

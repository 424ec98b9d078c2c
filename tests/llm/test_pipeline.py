from collections import Counter

import corpus_pipeline
import pyarrow.parquet as pq
from helpers import documents
from test_jaccard import brute
from test_toxicity_bpe import reference

from rillflow.llm import stages
from rillflow.llm.common import cut, table
from rillflow.llm.mixing import mix
from rillflow.llm.secrets import scan
from rillflow.llm.toxicity import toxicity

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_against_plain_python(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "jaccard_join", "secret_scan", "source_mix", "byte_bpe"] and corpus_pipeline.ORACLE_SQL is None
    outs, d = [], docs
    for _, stage in corpus_pipeline.STAGES:
        d = cut(stage(spark, d, SF))
        outs.append(d)
    assert all(o.columns == COLUMNS for o in outs[:-1])
    rows = [{r.doc_id: r for r in o.collect()} for o in outs]
    all_docs = {r.doc_id: r for r in docs.collect()}

    scores = {r.doc_id: r.predicted for r in toxicity(docs, table(spark, SF, "labels")).collect()}
    assert rows[0] == {i: r for i, r in all_docs.items() if not scores[i]}

    groups = brute({i: r.text for i, r in rows[0].items()}, 5, 4, 5)
    assert rows[1].keys() == {i for i, (n, root) in groups.items() if i == root}

    found = {r.doc_id: r.found for r in scan(outs[1]).collect()}
    for i, r in rows[1].items():
        text, out, at = r.text, "", 0
        for s in found[i]:
            if s.start >= at:
                if s.start > at or at == 0:
                    out += text[at : s.start] + "[REDACTED]"
            at = max(at, s.end)
        want = out + text[at:]
        assert rows[2][i].text == want and rows[2][i].n_chars == (len(want) if found[i] else r.n_chars)
    assert any(found.values()) and rows[2].keys() == rows[1].keys()

    draws = {r.doc_id: (r.size, r.draws) for r in mix(outs[2]).collect()}
    want = {}
    for i, (size, pieces) in draws.items():
        words = Counter()
        for p in pieces:
            words[p.epoch] += p.words
        want[i] = sum(w * 2 >= size for w in words.values())
    taken = Counter(r.doc_id for r in outs[3].collect())
    assert taken == Counter({i: n for i, n in want.items() if n})

    e = reference()
    last = outs[4].collect()
    assert Counter(r.doc_id for r in last) == taken
    for r in last:
        assert r.round_trip and r.n_tokens == len(e.encode_ordinary(rows[2][r.doc_id].text))


def test_run_is_the_stages_in_turn(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "source", "n_tokens", "ids", "ids_sha256", "round_trip"] and got.count() > 100


def test_edge_rows_pass_the_stages(spark):
    texts = ["a b c d e f", "a b c d e f", None, "", "token=abcdefgh token=abcdefgh", "x"]
    docs = documents(spark, texts, ["s", "s", None, "s", "t", "t"])
    docs = docs.unionAll(docs)
    kept = stages.drop_near_copies(spark, docs, SF).collect()
    assert Counter(r.doc_id for r in kept) == {0: 1, 2: 2, 3: 2, 4: 1, 5: 1}
    redacted = stages.redact_secrets(spark, docs, SF).collect()
    assert len(redacted) == 12 and {r.text for r in redacted if r.doc_id == 4} == {"[REDACTED] [REDACTED]"}
    assert stages.mix_sources(spark, docs, SF).where("doc_id in (2, 3)").count() == 0
    for stage in (stages.drop_near_copies, stages.redact_secrets, stages.mix_sources, stages.tokenize):
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_clashing_columns_pass_the_stages(spark):
    docs = documents(spark, ["a b c d e f", "a b c d e f", "token=abcdefgh"])
    docs = docs.selectExpr("*", "'x' as TEXT", "1 as score", "'y' as found", "2 as kept_id", "3 as copies", "3 as copies")
    for run in (stages.drop_toxic, stages.drop_near_copies, stages.redact_secrets, stages.mix_sources):
        out = run(spark, docs, SF)
        assert out.columns == docs.columns and out.count() > 0
        assert {tuple(r)[5:] for r in out.collect()} == {("x", 1, "y", 2, 3, 3)}
    assert stages.tokenize(spark, docs, SF).count() == 3


def test_clean_documents_stay_in_filtering_stages(spark):
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pylist()}
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    kept = {r.doc_id for r in stages.drop_toxic(spark, docs, "/root/testdata/sf0.1").select("doc_id").collect()}
    clean = [i for i, y in labels.items() if not y]
    assert sum(i in kept for i in clean) > 0.99 * len(clean)
    assert sum(i not in kept for i, y in labels.items() if y) > 0.9 * sum(labels.values())

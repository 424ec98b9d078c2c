"""Rows without an id, or with one id and different texts, keep what is decided for each of them."""

from collections import Counter

from helpers import DOCS, SF

from rillflow.llm import stages
from rillflow.llm.mixing import mix


def text(k, n=30):
    return " ".join(f"w{k}x{i}" for i in range(n))


def rows(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], DOCS)


def test_near_copies_by_row(spark):
    near = text(1) + " end"
    docs = rows(spark, [(None, text(0)), (None, text(1)), (None, ""), (None, None), (7, text(2)), (7, text(3)), (3, near), (9, text(4)), (2, text(4)), (2, text(5)), (5, text(0)), (5, text(0))])
    got = Counter((r.doc_id, r.text) for r in stages.drop_near_copies(spark, docs, SF).collect())
    assert got == Counter([(None, ""), (None, None), (7, text(2)), (7, text(3)), (3, near), (2, text(4)), (2, text(5)), (5, text(0))])
    lone = rows(spark, [(None, text(k)) for k in range(6)])
    assert stages.drop_near_copies(spark, lone, SF).count() == 6


def test_mix_by_row(spark):
    docs = rows(spark, [(None, text(k, 5 + 40 * k)) for k in range(12)] + [(1, text(k, 3 + k)) for k in range(20, 30)] + [(2, text(40))] * 3)
    docs = docs.unionByName(docs.selectExpr("doc_id + 100 as doc_id", "text", "lang", "'t' as source", "n_chars"))
    want = Counter()
    for r in mix(docs).collect():
        epochs = Counter()
        for d in r.draws:
            epochs[d.epoch] += d.words
        want[r.doc_id, r.source, r.size] += sum(w * 2 >= r.size for w in epochs.values())
    got = Counter((r.doc_id, r.source, len(r.text.split())) for r in stages.mix_sources(spark, docs, SF).collect())
    assert got == +want and len({n for (i, s, n), c in got.items() if i is None}) > 1
    of = lambda i: {want[k] for k in want if k[0] == i}
    assert len(of(None)) > 1  # a mean over all rows without an id would be wrong for some

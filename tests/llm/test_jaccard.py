import random
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
from helpers import documents

from rillflow.llm.graph import components
from rillflow.llm.jaccard import jaccard_classes, op2_jaccard


def brute(texts, size, num, den):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}
    at, root = defaultdict(list), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        both = Counter(j for t in s for j in at[t])
        for j, k in both.items():
            if den * k >= num * (len(s) + len(sets[j]) - k):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for t in s:
            at[t].append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_whole_table(spark):
    texts = {d["doc_id"]: d["text"] for d in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()}
    want = brute(texts, 3, 9, 10)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op2_jaccard(spark, "/root/testdata/sf0.01").collect()} == want


def test_groups_of_near_copies_at_the_threshold(spark):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [rnd.choice(vocabulary) for _ in range(60)]
    texts = []
    for i in range(160):
        words = list(base)
        for _ in range(rnd.randrange(4)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        texts.append(" ".join(words))
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(30)) + " " + " ".join(base[:25]) for _ in range(80)]
    texts += [None, "", "Same words", "same WORDS", "one", "a b c d", "x " * 20_000, "\x0b\x0c"]
    for size, num, den in ((3, 9, 10), (5, 4, 5)):
        got = jaccard_classes(documents(spark, texts), size=size, num=num, den=den).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(dict(enumerate(texts)), size, num, den)


def test_repeated_rows_and_empty_table(spark):
    docs = documents(spark, ["a b c d e", None, "a b c d e"])
    rows = jaccard_classes(docs.unionAll(docs).withColumn("TOK", docs.doc_id)).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(0, 0), (0, 0), (1, 1), (1, 1), (2, 0), (2, 0)]
    assert jaccard_classes(docs.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(500, 900), (700, 900)], "a long, b long")
    rows = {r.v: r.root for r in components(edges).collect()}
    assert len(rows) == 203 and {rows[i] for i in range(1, 201)} == {1} and {rows[i] for i in (500, 700, 900)} == {500}


def test_rows_repeated_with_their_id(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(5, " ".join(words))] * 3000 + [(None, " ".join([*words[:-1], "end"]))] * 3000 + [(9, "else " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.component_id) for r in jaccard_classes(df, size=3, num=9, den=10).select("doc_id", "component_id").collect())
    assert got == Counter({(5, 5): 3000, (None, 5): 3000, (9, 9): 1})

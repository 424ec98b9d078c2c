import random
from collections import Counter

import numpy as np
from helpers import documents

from rillflow.llm import substrings
from rillflow.llm.suffixes import permuted_prefixes, suffix_array


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    count = Counter(t[k : k + 200] for t in raw for k in range(len(t) - 199))
    out = []
    for i, t in enumerate(raw):
        gone = {k + j for k in range(len(t) - 199) if count[t[k : k + 200]] > 1 for j in range(200)}
        spans = sum(1 for k in gone if k - 1 not in gone)
        out.append((i, len(t), len(gone), spans, bytes(x for k, x in enumerate(t) if k not in gone)))
    return out


def texts():
    rnd = random.Random(3)
    long = "".join(rnd.choice("abcdé \n") for _ in range(6000))
    out = []
    for i in range(150):
        own = "".join(rnd.choice("efghij") for _ in range(rnd.randrange(150)))
        a = rnd.randrange(5000)
        out.append(own + long[a : a + rnd.randrange(100, 900)] + own[::-1])
    line = "".join(rnd.choice("klmnop") for _ in range(260))
    out += [f"{i} " * 90 + line + f" {i * 7}" * 60 for i in range(150)]
    return out + [None, "", "short", "z" * 1000, out[4], "ab" * 300 + "c", long]


def test_against_brute_force(spark, monkeypatch):
    t = texts()
    want = brute(t)
    assert sorted(map(tuple, substrings.dedup_substrings(documents(spark, t)).collect())) == want
    # small bounds send the common line and the repeats through the exchange by string
    monkeypatch.setattr(substrings, "CHUNK_CONTENTS", 3)
    monkeypatch.setattr(substrings, "SHARD_CONTENTS", 5)
    assert sorted(map(tuple, substrings.dedup_substrings(documents(spark, t)).collect())) == want


def test_repeated_rows_and_empty_table(spark):
    docs = documents(spark, ["q" * 150 + "r" * 80, None])
    rows = substrings.dedup_substrings(docs.unionAll(docs)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(0, 230), (0, 230), (1, 0), (1, 0)]
    assert substrings.dedup_substrings(docs.limit(0)).count() == 0


def test_suffix_arrays():
    rng = np.random.default_rng(1)
    for _ in range(200):
        s = np.append(rng.integers(1, rng.integers(3, 7), rng.integers(1, 60)), 0)
        sa = suffix_array(s)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        p = permuted_prefixes(s, sa, 8)
        for i, j in zip(sa[1:], sa):
            n = next((k for k in range(len(s)) if max(i, j) + k >= len(s) or s[i + k] != s[j + k]), len(s))
            assert p[i] == min(n, 8)

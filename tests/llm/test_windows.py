import random
import re

import duckdb
from helpers import documents

from rillflow.llm.windows import OP9_SQL, dedup_windows, op9_windows


def brute(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(i, first.get(key, i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def test_against_brute_force(spark):
    rnd = random.Random(9)
    long = [f"w{rnd.randrange(400)}" for _ in range(3000)]
    texts = []
    for i in range(120):
        own = [f"d{i}x{k}" for k in range(rnd.randrange(40))]
        a = rnd.randrange(2900)
        texts.append(rnd.choice([" ", "\n", "\t "]).join(own[:10] + long[a : a + rnd.randrange(8, 60)] + own[10:]))
    texts += [None, "", "a b", "same word " * 400, "same word " * 400, texts[3], " ".join(long) * 10]
    docs = documents(spark, texts)
    rows = list(enumerate(texts))
    assert sorted(map(tuple, dedup_windows(docs).collect())) == brute(rows)
    assert sorted(map(tuple, dedup_windows(docs.unionAll(docs)).collect())) == brute(rows + rows)
    assert dedup_windows(docs.limit(0)).count() == 0


def test_whole_table_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.execute(f"select doc_id, n_words, n_removed, kept_sha256 from ({OP9_SQL})").fetchall()
    assert sorted(map(tuple, op9_windows(spark, sf).collect())) == sorted(want)

import hashlib
import re

import pyarrow.parquet as pq
from helpers import SF, documents

from rillflow.llm.mixing import mix, op1_mixing, shards
from rillflow.llm.secrets import op6_secrets, scan


def waterfill(sizes, weights, cap):
    target, open_, left = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while True:
        w = sum(weights[s] for s in open_)
        above = [s for s in open_ if left * weights[s] / w > cap * sizes[s]]
        if not above:
            return target | {s: left * weights[s] / w for s in open_}
        for s in above:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_.remove(s)
        if not open_:
            return target


def test_mix_meets_targets(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    got = op1_mixing(spark, SF).collect()
    size = {d["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"])) for d in docs}
    by = {}
    for d in docs:
        by[d["source"]] = by.get(d["source"], 0) + size[d["doc_id"]]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(by))}
    want = waterfill(by, weights, 3)
    source = {d["doc_id"]: d["source"] for d in docs}
    taken = dict.fromkeys(by, 0)
    assert len(got) == len(docs)
    for r in got:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], by[s]) and abs(r.target - want[s]) < 1e-3
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in by)
    assert sorted(map(tuple, got)) == sorted(map(tuple, op1_mixing(spark, SF).collect()))


def test_mix_edge_rows(spark):
    docs = documents(spark, ["a b c", None, "", "a b c", "x " * 5000, "q"], [None, "s", "s", None, "t", "u"])
    rows = mix(docs.unionAll(docs)).collect()
    assert len(rows) == 12 and sum(r.size for r in rows if r.doc_id in (1, 2)) == 0
    assert mix(docs.limit(0)).count() == 0
    pieces = shards(mix(docs)).collect()
    assert {p.shard for p in pieces} <= set(range(16)) and sum(p.words for p in pieces) == sum(r.taken for r in mix(docs).collect())
    total = sum(r.size for r in rows)
    assert abs(sum(r.taken for r in rows) - total) <= 5


def base_spans(text):
    out = []
    for kind, (name, rx, group, least) in enumerate(
        (
            ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20),
            ("hex", r"[0-9a-f]+", 0, 24),
        )
    ):
        out += [(m.start(), kind, f"{name}:{m.start()}:{m.end()}") for m in re.finditer(rx, text, re.A) if len(m[group]) >= least]
    return ",".join(x[2] for x in sorted(out)), out


def test_secrets_against_re(spark):
    docs = {d["doc_id"]: d["text"] for d in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()}
    got = op6_secrets(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs)
    for r in got:
        said, each = base_spans(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[1] == k for x in each) for k in range(3))
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))


def test_secrets_edges(spark):
    live, copied = "aB3dE5gH7jK9mN1pQ3sT", "zz11yy22xx33ww44vv55"
    texts = ["password=token: abcdefg", None, "", "é token='" + "0f" * 20 + "' " + live, copied, copied, copied, 'API_KEY = "abc" secret:abcdef', "AKIA" + "A" * 15, "x" * 100000 + " AKIA" + "B" * 16]
    rows = {r.doc_id: r for r in scan(documents(spark, texts, [f"s{i}" for i in range(len(texts))])).collect()}
    for i, t in enumerate(texts):
        said, _ = base_spans(t or "")
        from rillflow.llm.secrets import KINDS

        assert ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in rows[i].base) == said
    assert [s.kind for s in rows[3].found][-1] == 3 and rows[4].found == [] and rows[4].n_example == 1
    assert scan(documents(spark, ["a"]).limit(0)).count() == 0
    twice = documents(spark, ["token=abcdefgh"])
    assert scan(twice.unionAll(twice)).count() == 2


def test_opaque_runs_beside_base_spans_of_a_long_text(spark):
    parts = []
    for i in range(3000):
        h = hashlib.sha1(str(i).encode()).hexdigest()
        parts.append([h, "token=" + h[:9], f"Q{h[:22]}Z", "AKIA" + h[:18].upper(), f"zz{h}Gg", f"secret: Q{h[:25]}"][i % 6])
    text = " ".join(parts)
    row = scan(documents(spark, [text])).collect()[0]
    _, base = base_spans(text)
    at = [tuple(map(int, x[2].split(":")[1:])) for x in base]
    opaque = [m.span() for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text) if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])]
    want = [o for o in opaque if not any(b[0] < o[1] and o[0] < b[1] for b in at)]
    assert len(want) >= 500 and [(s.start, s.end) for s in row.found if s.kind == 3] == want

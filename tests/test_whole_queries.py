"""Queries that take every row of their tables, under both of their names."""

import duckdb

from rillflow.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_linked_rounds_follow_every_edge(spark):
    keys = duckdb.sql(f"SELECT DISTINCT l_suppkey, l_partkey % (SELECT count(*) FROM '{SF}/supplier.parquet') FROM '{SF}/lineitem.parquet'").fetchall()
    after: dict = {}
    for src, dst in keys:
        after.setdefault(src, set()).add(dst)
    want = front = {min(after)}
    rounds = dict.fromkeys(want, 0)
    for r in (1, 2, 3):
        front = {d for s in front for d in after.get(s, ())} - rounds.keys()
        rounds |= dict.fromkeys(front, r)
    got = {r.node: r.round for r in QUERIES["linked_rounds_whole"](spark, SF).collect()}
    assert got == rounds == {r.node: r.round for r in QUERIES["linked_rounds"](spark, SF).collect()}


def test_every_document_is_repaired(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet'").fetchall()
    got = {r.doc_id: r.marked for r in QUERIES["ligature_repair"](spark, SF).collect()}
    assert got.keys() == {d[0] for d in docs}
    assert all((got[i] > 0) >= (" the " in text) and (got[i] == 0 or "th" in text) for i, text, _ in docs)
    assert any(got[i] for i, _, lang in docs if lang != "en")


def test_words_with_more_lost_places_are_tried(spark):
    got = {r.word: r.fixed for r in QUERIES["best_candidate_whole"](spark, SF).collect()}
    lost = [w.count("�") for w in got]
    assert {1, 2, 3} == set(lost)
    assert got == {r.word: r.fixed for r in QUERIES["best_candidate"](spark, SF).collect()}


def test_every_line_is_a_cell(spark):
    got = {r["item"]: r["line"] for r in QUERIES["item_in_cell_whole"](spark, SF).collect()}
    assert got.keys() == {r["item"] for r in QUERIES["item_in_cell"](spark, SF).collect()}
    assert any(line % 8 > 1 for line in got.values())


def test_front_matter_holds_whole_texts(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    got = {r.doc_id: r.front for r in QUERIES["frontmatter_whole"](spark, SF).collect()}
    assert got.keys() == texts.keys() and all(len(got[i]) > len(t) for i, t in texts.items())

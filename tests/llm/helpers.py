"""Shared by the tests of this folder."""

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None):
    """A documents table of these texts."""
    sources = sources or ["a"] * len(texts)
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, (t, s) in enumerate(zip(texts, sources))], DOCS)

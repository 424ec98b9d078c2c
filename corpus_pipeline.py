"""A corpus pipeline: toxic documents go, one of each group of near copies stays, secrets are redacted,
sources are mixed to target weights, and what is left becomes token ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rillflow.llm import stages
from rillflow.llm.common import cut, table

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.drop_toxic),
    ("jaccard_join", stages.drop_near_copies),
    ("secret_scan", stages.redact_secrets),
    ("source_mix", stages.mix_sources),
    ("byte_bpe", stages.tokenize),
]

#: No SQL expresses the classifier, the hash permutation or the tokenizer; a test compares run() with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = cut(docs)
    return docs

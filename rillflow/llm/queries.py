"""The queries of this package and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import jaccard, manifest, windows
from .bpe import op5_bpe
from .chunks import op13_chunk_reuse
from .fingerprints import op8_order_minhash
from .jaccard import op2_jaccard
from .manifest import op11_manifest
from .media import op10_media
from .mixing import op1_mixing
from .pages import op7_pages
from .secrets import op6_secrets
from .substrings import op3_substrings
from .toxicity import op4_toxicity
from .whitening import op12_whitening
from .windows import op9_windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mixing, op2_jaccard, op3_substrings, op4_toxicity, op5_bpe, op6_secrets, op7_pages, op8_order_minhash, op9_windows, op10_media, op11_manifest, op12_whitening, op13_chunk_reuse)
}

ORACLE_SQL: dict[str, str] = {"op2_jaccard": jaccard.OP2_SQL, "op9_windows": windows.OP9_SQL, "op11_manifest": manifest.OP11_SQL}

"""Byte-level BPE encoding and decoding by a sentencepiece model made from a rank file."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import added, pick, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CACHED = 150_000  # pre-tokens kept per worker; the cache starts anew when full
_SHIFT = 0x100  # byte b stands in a piece as the character chr(0x100 + b)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | str | int | float | bool) -> bytes:
    """One protobuf field: a varint for integers, fixed 32 bits for floats, else length-delimited."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value & (1 << 64) - 1)
    raw = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(raw)) + raw


def mapped(raw: bytes) -> str:
    """Bytes as the characters that stand for them in pieces."""
    return raw.decode("latin-1").translate(_UP)


_UP = {b: _SHIFT + b for b in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ranks, which must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        ranks = {int(b): base64.b64decode(a) for a, b in (line.split() for line in f if line.strip())}
    return [ranks[i] for i in range(len(ranks))]


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model proto: <unk>, then each token's mapped piece with score -rank.

    Normalisation is the identity: no character map, no dummy prefix, white space kept as it is.
    """
    pieces = [_field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2))]
    pieces += [_field(1, _field(1, mapped(t)) + _field(2, -float(rank)) + _field(3, 1)) for rank, t in enumerate(tokens)]
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, 0) + b"".join(_field(n, -1) for n in (41, 42, 43))
    normalizer = _field(1, "identity") + _field(3, False) + _field(4, False) + _field(5, False)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec(dict):
    """pre-token -> its ids as little-endian unsigned 32-bit integers; encodes and decodes whole texts.

    A pre-token that is itself a token keeps that id; any other goes through sentencepiece, whose
    merges by score are those by rank. Ids in the model are one above the rank because of <unk>.
    """

    def __init__(self, model: bytes, pattern: str):
        super().__init__()
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.sp.get_piece_size() - 1
        down = {_SHIFT + b: b for b in range(256)}
        self.pieces = [self.sp.id_to_piece(i + 1).translate(down).encode("latin-1") for i in range(n)]
        self.whole = {p: i for i, p in enumerate(self.pieces)}
        self.split = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        raw = piece.encode()
        one = self.whole.get(raw)
        ids = [one] if one is not None else [i - 1 for i in self.sp.encode_as_ids(mapped(raw))]
        out = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, text: str | None) -> bytes:
        return b"".join([self[p] for p in self.split(text)]) if text else b""

    def decode(self, ids: bytes) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()])


_codecs: dict[tuple[str, str], Codec] = {}


def codec_column(spark: SparkSession, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Callable[[Column], Column]:
    """A column function: text -> struct(ids binary, decoded binary), ``decoded`` made from ``ids``.

    The model (fixed by the vocabulary file, about 1 MB) is serialised on the driver and broadcast;
    each worker loads it once.
    """
    proto = serialise(read_ranks(path or public_tokenizers.path(VOCABULARY)))
    key = (hashlib.sha256(proto).hexdigest(), pattern)
    model = spark.sparkContext.broadcast(proto)

    @F.arrow_udf("struct<ids:binary,decoded:binary>")
    def encoded(text: pa.Array) -> pa.Array:
        if key not in _codecs:
            _codecs.clear()  # a worker holds one vocabulary at a time
            _codecs[key] = Codec(model.value, pattern)
        codec = _codecs[key]
        ids, back = [], []
        for t in text:
            ids.append(codec.encode(t.as_py()))
            back.append(codec.decode(ids[-1]))
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(back, pa.binary())], ["ids", "decoded"])

    return encoded


def encode(docs: DataFrame, *, text_col: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Adds ``tokens`` (struct of ``ids``, little-endian u32, and ``decoded``, UTF-8) to every row.

    Each match of ``pattern`` is encoded separately, without special tokens. A null or empty text
    has no ids; texts of any length are encoded whole; rows are independent, so repeated rows get
    equal results; an empty table gives an empty result; other columns pass through untouched.
    """
    return added(docs, text_col, tokens=codec_column(docs.sparkSession, path, pattern))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all ``documents`` and their decoding: counts and digests."""
    t = encode(pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"))
    return t.select("doc_id", (F.length("tokens.ids") / 4).cast("long").alias("n_tokens"), F.sha2("tokens.ids", 256).alias("ids_sha256"), F.sha2("tokens.decoded", 256).alias("decoded_sha256"))

"""BPE encoding and decoding by content-defined chunks: what documents share is encoded once."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tokenizers
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, cut, in_bitmap, joined_by_few, pick, table
from .words import _BASE, _TABLE, slices

VOCABULARY = "word_bpe_49k.json"
WINDOW = 48  # bytes that decide whether a chunk ends after them
BITS = 9  # a chunk ends at one in 2**BITS places
LEAST, MOST = 128, 4096  # bytes of a chunk; the last one of a text may be shorter
EDGE = 4  # words at each end of a coded piece that a join may encode again
CACHED = 400_000  # words of a generation; a worker keeps two (about 160 MB), the older one goes when the younger is full
TOGETHER = 64  # documents that are assembled at a time
_ROLL = [_BASE & 0xFFFFFFFF, pow(_BASE, -1, 1 << 32)]  # an odd number and its inverse modulo 2**32
_BYTE = _TABLE.astype(np.uint32)
_POWERS = [np.ones(0, dtype=np.uint32)] * 2
_WORD = re.compile(r"[^ \n\t\r]+")
_SPACE = " \n\t\r"


def _powers(which: int, n: int) -> np.ndarray:
    if len(_POWERS[which]) < n:
        p = np.full(max(n, 1 << 16), _ROLL[which], dtype=np.uint32)
        p[0] = 1
        _POWERS[which] = np.cumprod(p, dtype=np.uint32)
    return _POWERS[which][:n]


def ends(raw: bytes) -> list[int]:
    """Where the chunks of a text end, as byte offsets; the last is the text's length.

    The rolling hash of the ``WINDOW`` bytes before a place decides, so equal passages fall into
    equal chunks wherever they stand. No chunk ends inside a character.
    """
    n = len(raw)
    if n <= LEAST:
        return [n] if n else []
    b = np.frombuffer(raw, dtype=np.uint8)
    upto = np.cumsum(_BYTE[b] * _powers(1, n), dtype=np.uint32)  # a window's hash is a difference of these, shifted back
    roll = upto[WINDOW:] - upto[:-WINDOW]
    roll *= _powers(0, n)[WINDOW:]
    places = np.flatnonzero(roll < np.uint32(1 << (32 - BITS))) + WINDOW + 1
    out, last = [], 0
    for p in [*places[places < n].tolist(), n]:
        while p - last > MOST:
            last += MOST
            while raw[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        if p == n:
            out.append(n)
        elif p - last >= LEAST and raw[p] & 0xC0 != 0x80:
            out.append(p)
            last = p
    return out


def chunked(raw: bytes) -> tuple[list[bytes], list[bytes]]:
    """A text's chunks and their 128-bit digests."""
    at, parts = 0, []
    for e in ends(raw):
        parts.append(raw[at:e])
        at = e
    return parts, [xxhash.xxh3_128_digest(p) for p in parts]


def _known(bits: np.ndarray, digests: list[bytes]) -> np.ndarray:
    return in_bitmap(bits, np.frombuffer(b"".join(digests), dtype=">u8")[::2].astype(np.uint64)) if digests else np.zeros(0, dtype=bool)


class Joiner:
    """Codes chunks, joins coded pieces, encodes and decodes whole texts; ``known`` has the (packed) ids of words.

    The tokenizer drops white space, so words between blanks are encoded for themselves, once a
    worker. Where two pieces meet, a word may have been cut: the words around the join are encoded
    again in one call, and the window grows until its first and last word, which both sides hold
    uncut, get the ids that the sides gave them.
    """

    def __init__(self, model: str):
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.t = tokenizers.Tokenizer.from_str(model)
        self.t.no_truncation()
        self.t.no_padding()
        n = self.t.get_vocab_size()
        self.kind = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        self.tokens = None if self.t.decoder else [self.t.id_to_token(i) or "" for i in range(n)]

    def raw(self, text: str) -> bytes:
        return np.array(self.t.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def learn(self, words: set[str]) -> None:
        """The ids of all ``words`` at once; those not known yet are given to the tokenizer as separate words of one text.

        Words of the older generation that are met again join the younger, so frequent ones are encoded once a worker.
        """
        if len(self.known) >= CACHED:
            self.older, self.known = self.known, {}
        new = []
        for w in words.difference(self.known):
            if w in self.older:
                self.known[w] = self.older[w]
            else:
                new.append(w)
        for at in range(0, len(new), 2000):
            some = new[at : at + 2000]
            e = self.t.encode(some, is_pretokenized=True, add_special_tokens=False)
            if None in e.word_ids:  # a special token belongs to no word
                self.known.update({w: self.raw(w) for w in some})
                continue
            of, ids, size = np.array(e.word_ids), np.array(e.ids, dtype=self.kind).tobytes(), self.kind.itemsize
            ends = (np.searchsorted(of, np.arange(len(some) + 1)) * size).tolist()
            self.known.update({w: ids[a:b] for w, a, b in zip(some, ends, ends[1:])})

    def ids(self, words: list[str]) -> bytes:
        """The ids of words that have been learnt."""
        return b"".join(map(self.known.__getitem__, words))

    def coded(self, text: str) -> tuple[str, bytes | None, str]:
        """(first words, ids of those between, last words); (text, None, "") where too few words stand between two joins."""
        words = _WORD.findall(text)
        if len(words) <= 2 * EDGE:
            return text, None, ""
        lead = " " * (text[0] in _SPACE) + " ".join(words[:EDGE])
        return lead, self.ids(words[EDGE:-EDGE]), " ".join(words[-EDGE:]) + " " * (text[-1] in _SPACE)

    def joined(self, left: str, between: str, right: str) -> bytes:
        """Ids of what stands around a join: last words of one piece, short texts, first words of the next; ends may be empty."""
        before, after = _WORD.findall(left), _WORD.findall(right)
        for k in range(1, EDGE):
            inner = (" ".join(before[EDGE - 1 - k :]) + left[len(left.rstrip(" ")) :] if left else "") + between
            inner += right[: len(right) - len(right.lstrip(" "))] + " ".join(after[: k + 1]) if right else ""
            got = self.raw(inner)
            if (not left or got.startswith(self.known[before[EDGE - 1 - k]])) and (not right or got.endswith(self.known[after[k]])):
                return self.ids(before[: EDGE - 1 - k]) + got + self.ids(after[k + 1 :])
        raise ValueError("tokens reach over white space: chunks can't be joined for this tokenizer")

    def assembled(self, pieces: list[tuple[str, bytes | None, str]]) -> bytes:
        """Ids of a text from its coded pieces, in order."""
        out, left, between = [], "", ""
        for lead, ids, trail in pieces:
            if ids is None:
                between += lead
                continue
            out += [self.joined(left, between, lead), ids]
            left, between = trail, ""
        if left or between:
            out.append(self.joined(left, between, ""))
        return b"".join(out)

    def finished(self, packed: bytes) -> tuple[bytes, str]:
        ids = np.frombuffer(packed, dtype=self.kind)
        if self.tokens is None:
            return ids.astype("<u4").tobytes(), self.t.decode(ids.tolist(), skip_special_tokens=False)
        return ids.astype("<u4").tobytes(), " ".join(map(self.tokens.__getitem__, ids.tolist()))  # without a decoder the library puts blanks between tokens


_joiners: dict[str, Joiner] = {}


def _joiner(model: str) -> Joiner:
    if model not in _joiners:
        _joiners.clear()  # a worker holds one vocabulary at a time
        _joiners[model] = Joiner(model)
    return _joiners[model]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Ids and texts (null: empty) of some rows at a time."""
    for batch in batches:
        for at, texts in slices(batch.column("text")):
            yield batch.column("doc_id").slice(at, len(texts)), [t or b"" for t in texts]


_PIECE = "n long, pos int, h binary, own string"


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit) ``, decoded`` of every row, as the tokenizers library gives them.

    Texts fall into chunks where a rolling hash says so. Chunks that occur more than once in the
    corpus are encoded once, and their ids are joined back to the documents that hold them; other
    chunks are encoded where they stand, and so is a document that shares none, without a shuffle of
    its text. Joins are repaired by encoding the words around them again until both sides agree.
    Special tokens aren't added, but their strings in a text count as such, as in the library.

    A null or empty text has no ids and decodes to nothing; a text of any length, also one without
    any blank, is encoded whole; null and repeated ids are no matter, and rows repeated with id and
    text come back as often; an empty table gives an empty result. Other columns are not looked at.
    The tokenizer's tokens must not hold white space (a join that proves otherwise raises).
    """
    spark = docs.sparkSession
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        model = f.read()
    shipped = spark.sparkContext.broadcast(model)  # about 2 MB, fixed by the vocabulary
    d = pick(docs, doc_id=id_col, text=text_col)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _texts(batches):
            yield pa.record_batch([pa.array([h for t in texts for h in chunked(t)[1]], pa.binary())], ["h"])

    # Which chunks occur again: only digests are shuffled; the bitmap's size is fixed, a full one sends more chunks the shared way.
    again = d.mapInArrow(digests, "h binary").groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    shared = spark.sparkContext.broadcast(bitmap(again, F.conv(F.hex(F.substring("h", 1, 8)), 16, -10).cast("long"), 24))

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _texts(batches):
            found: dict[bytes, list] = {}
            for t in texts:
                parts, hs = chunked(t)
                for i in np.flatnonzero(_known(shared.value, hs)).tolist():
                    found.setdefault(hs[i], [parts[i], 0])[1] += 1
            yield pa.record_batch([pa.array(found, pa.binary()), pa.array([p.decode() for p, _ in found.values()], pa.string()), pa.array([n for _, n in found.values()], pa.int64())], ["h", "chunk", "n"])

    @F.arrow_udf("struct<lead:string,ids:binary,trail:string>")
    def code(chunk: pa.Array) -> pa.Array:
        j = _joiner(shipped.value)
        texts = chunk.to_pylist()
        j.learn({w for t in texts for w in _WORD.findall(t)})
        lead, ids, trail = zip(*[j.coded(t) for t in texts]) if texts else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(lead, pa.string()), pa.array(ids, pa.binary()), pa.array(trail, pa.string())], ["lead", "ids", "trail"])

    once = d.mapInArrow(repeated, "h binary, chunk string, n long").groupBy("h").agg(F.first("chunk").alias("chunk"), F.sum("n").alias("n"))
    coded = cut(once.select("h", "n", code(F.col("chunk")).alias("coded")))

    def unshared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        j = _joiner(shipped.value)
        for ids, texts in _texts(batches):
            keep = [i for i, t in enumerate(texts) if not _known(shared.value, chunked(t)[1]).any()]
            words = [_WORD.findall(texts[i].decode()) for i in keep]
            j.learn(set().union(*words))
            done = [j.finished(j.ids(w)) for w in words]
            yield pa.record_batch([ids.take(pa.array(keep, pa.int64())), pa.array([x for x, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())], ["doc_id", "ids", "decoded"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per shared chunk and per stretch of own ones between them, of each distinct row of a slice."""
        for ids, texts in _texts(batches):
            rows: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(ids.to_pylist(), texts)):
                rows.setdefault(key, []).append(i)
            out: list[tuple] = []
            for (_, t), same in rows.items():
                parts, hs = chunked(t)
                known = _known(shared.value, hs)
                if not known.any():
                    continue
                key, own = xxhash.xxh3_128_digest(t), []
                for i, k in enumerate(known.tolist()):
                    if not k:
                        own.append(parts[i])
                    if own and (k or i + 1 == len(parts)):
                        out.append((same[0], key, len(same), i - 1 + (not k), None, b"".join(own).decode()))
                        own = []
                    if k:
                        out.append((same[0], key, len(same), i, hs[i], None))
            at, key, n, pos, h, own = zip(*out) if out else ((),) * 6
            yield pa.record_batch([ids.take(pa.array(at, pa.int64())), pa.array(key, pa.binary()), pa.array(n, pa.int64()), pa.array(pos, pa.int32()), pa.array(h, pa.binary()), pa.array(own, pa.string())], ["doc_id", "text_key", "n", "pos", "h", "own"])

    @F.arrow_udf("struct<ids:binary,decoded:string>")
    def assemble(parts: pa.Array) -> pa.Array:
        j = _joiner(shipped.value)
        done = []
        for first in range(0, len(parts), TOGETHER):
            some = parts.slice(first, TOGETHER)
            flat = some.flatten()
            coded = flat.field("coded")
            pos, own, lead, ids, trail = (a.to_pylist() for a in (flat.field("pos"), flat.field("own"), *[coded.field(n) for n in ("lead", "ids", "trail")]))
            j.learn({w for texts in (own, lead, trail) for t in texts if t for w in _WORD.findall(t)})
            ends = np.cumsum(some.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            for a, b in zip([0, *ends], ends):
                at = {pos[i]: i for i in range(a, b)}  # repeated rows have each place more than once
                done.append(j.finished(j.assembled([j.coded(own[i]) if own[i] is not None else (lead[i], ids[i], trail[i]) for i in map(at.get, sorted(at))])))
        return pa.StructArray.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())], ["ids", "decoded"])

    kind = d.schema["doc_id"].dataType.simpleString()
    p = d.mapInArrow(pieces, f"doc_id {kind}, text_key binary, {_PIECE}")
    none = F.lit(None).cast("struct<lead:string,ids:binary,trail:string>")
    all_pieces = joined_by_few(p.where("h is not null"), coded, "h", "n").drop("h").unionByName(p.where("h is null").drop("h").withColumn("coded", none))
    each = all_pieces.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("pos", "own", "coded")).alias("parts"), F.collect_list(F.struct("pos", "n")).alias("copies"))
    least = F.array_min(F.transform("copies", lambda x: x["pos"]))
    n = F.aggregate(F.filter("copies", lambda x: x["pos"] == least), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    whole = each.select("doc_id", assemble(F.col("parts")).alias("x"), F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("nth")).select("doc_id", "x.*")
    return d.mapInArrow(unshared, f"doc_id {kind}, ids binary, decoded string").unionByName(whole)


def op13_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all ``documents`` and their decoding: counts and digests."""
    t = encode(table(spark, sf_dir, "documents"))
    return t.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

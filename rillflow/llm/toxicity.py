"""Toxicity by a counterfactual-regularised linear classifier on word and word-part features."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import added, cut, pick, table

# Groups of identity terms that are swapped; the first of each is its neutral stand-in.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("people", "women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("person", "woman", "man", "girl", "boy"),
    ("believers", "christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("believer", "christian", "muslim", "jew", "jewish", "hindu", "buddhist", "atheist"),
    ("citizens", "africans", "asians", "americans", "europeans", "arabs", "mexicans", "immigrants", "refugees"),
    ("citizen", "african", "asian", "american", "european", "arab", "mexican", "immigrant", "refugee", "black", "white", "latino"),
    ("adults", "gays", "lesbians", "bisexuals", "heterosexuals"),
    ("adult", "gay", "lesbian", "bisexual", "heterosexual", "queer", "straight"),
    ("patients", "disabled", "deaf", "blind", "autistic"),
)
WORDS = re.compile(r"\w+")
THRESHOLD = 0.3
MAX_PER_CLASS = 4000  # labelled rows of each class that the fit may see
LEAST, CLEAR, MAX_FEATURES = 3, 3, 20_000  # a kept feature's rows, deviations between the labels' rates, and how many are kept
BLOCK = 1000  # sampled rows that a step of the fit handles at a time
CACHED = 200_000


def features(word: str) -> list[tuple[int, int]]:
    """Ids of the word, its beginnings of 3 to 7 and its ends of 3 to 5 characters.

    An id is the feature's crc32. With each beginning comes the id of "two words share it", else 0.
    """
    n, crc = len(word), zlib.crc32
    out = [(crc(word.encode()), 0)]
    for k in range(3, min(8, n)):
        raw = word[:k].encode() + b"+"
        out.append((crc(raw), crc(raw + b"2")))
    out += [(crc(b"+" + word[-k:].encode()), 0) for k in range(3, min(6, n))]
    return out


class _Features(dict):
    """word -> its features, of which a model's scorer keeps those with a weight; starts anew when full."""

    def __init__(self, weights: Mapping[int, float] | None = None):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> tuple[tuple[int, int], ...]:
        if len(self) >= CACHED:
            self.clear()
        w = self.weights
        out = self[word] = tuple(f for f in features(word) if w is None or f[0] in w or f[1] in w)
        return out


def of_words(words: Iterable[str], known: Mapping[str, Sequence[tuple[int, int]]]) -> set[int]:
    """The features of a text with these distinct words."""
    seen: set[int] = set()
    twice: set[int] = set()
    for w in words:
        for one, two in known[w]:
            if one not in seen:
                seen.add(one)
            elif two:
                twice.add(two)
    return seen | twice


def featured(words: Iterable[str], known: Mapping[str, Sequence[tuple[int, int]]]) -> np.ndarray:
    return np.sort(np.fromiter(of_words(words, known), dtype=np.uint32))


@dataclass
class Model:
    """Weights by feature, and the intercept; a text's logit sums the features that occur in it."""

    weights: dict[int, float] = field(default_factory=dict)
    intercept: float = 0.0

    def scorer(self) -> Callable[[str | None], float]:
        weights, known = self.weights, _Features(self.weights)

        def score(text: str | None) -> float:
            seen = of_words(set(WORDS.findall(text.lower())), known) if text else ()
            z = self.intercept + sum(weights[f] for f in sorted(seen) if f in weights)
            return float(1 / (1 + np.exp(-max(-30.0, min(30.0, z)))))

        return score


def swaps(words: set[str], groups: Sequence[Sequence[str]]) -> list[set[str]]:
    """The counterfactuals of a text: its identity terms neutral, and each by the next of its group."""
    after = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    first = {t: g[0] for g in groups for t in g}
    if not words & after.keys():
        return []
    return [{to.get(w, w) for w in words} for to in (first, after)]


def mentioned(own: np.ndarray, term: str) -> np.ndarray:
    """The features that a text with these features gains by a mention of ``term``."""
    has = np.isin(np.array([one for one, _ in features(term)], np.uint32), own)
    gained = {two if h else one for (one, two), h in zip(features(term), has)} - {0}
    return np.setdiff1d(np.array(sorted(gained), np.uint32), own)


def example(words: Iterable[str], known: Mapping[str, Sequence[tuple[int, int]]], groups: Sequence[Sequence[str]]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """A text's features, and those that each of its counterfactuals loses and gains.

    A text without identity terms gets a mention of one, chosen by its features.
    """
    words = set(words)
    own = featured(words, known)
    others = [featured(x, known) for x in swaps(words, groups)]
    terms = sorted({t for g in groups for t in g})
    if others or not terms:
        return own, [(np.setdiff1d(own, x, assume_unique=True), np.setdiff1d(x, own, assume_unique=True)) for x in others]
    return own, [(own[:0], mentioned(own, terms[zlib.crc32(own.tobytes()) % len(terms)]))]


def clearness(a, b, n_pos: int, n_neg: int, by=F):
    """How clearly a feature's rates in ``a`` of the positive and ``b`` of the negative rows differ; of columns, or arrays by numpy."""
    return by.abs(by.log((a + 0.5) / (n_pos + 1)) - by.log((b + 0.5) / (n_neg + 1))) / by.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))


def of_terms(groups: Sequence[Sequence[str]]) -> list[int]:
    return sorted({f for g in groups for t in g for f, _ in features(t)})


def base_rate(n_pos: int, n_neg: int) -> Model:
    """The model of rows of one label, or of none."""
    rate = n_pos / (n_pos + n_neg) if n_pos + n_neg else 0.0
    return Model(intercept=float(np.log((rate + 0.01) / (1.01 - rate))))


def places(names: np.ndarray, have: np.ndarray) -> np.ndarray:
    """Where the features that are among ``names`` stand there."""
    return np.searchsorted(names, have[np.isin(have, names, assume_unique=True)]).astype(np.int32)


def fit_words(rows: Sequence[tuple[Iterable[str], int]], groups: Sequence[Sequence[str]] = IDENTITY_GROUPS, least: int = LEAST, max_features: int = MAX_FEATURES, **how) -> Model:
    """Fits a model to (distinct lower-case words, label) rows at hand, as ``fit`` does to a table."""
    known = _Features()
    labels = np.array([y for _, y in rows], dtype=float)
    n_pos, n_neg = int(labels.sum()), int(len(labels) - labels.sum())
    if not n_pos or not n_neg:
        return base_rate(n_pos, n_neg)
    examples = [example(w, known, groups) for w, _ in rows]
    ids, at = np.unique(np.concatenate([own for own, _ in examples]), return_inverse=True)
    a = np.bincount(at, np.repeat(labels, [len(own) for own, _ in examples]), len(ids))
    b = np.bincount(at, minlength=len(ids)) - a
    z, enough = clearness(a, b, n_pos, n_neg, np), a + b >= least
    clear = np.lexsort((ids, -z))
    clear = clear[(enough & (z > CLEAR))[clear]][:max_features]
    names = np.union1d(ids[clear], np.intersect1d(np.array(of_terms(groups), np.uint32), ids[enough]))
    kept = [(places(names, own), [(places(names, x), places(names, y)) for x, y in pairs]) for own, pairs in examples]
    return solved(names, labels, kept, **how)


def solved(names: np.ndarray, labels: np.ndarray, rows: Sequence[tuple[np.ndarray, Sequence[tuple[np.ndarray, np.ndarray]]]], penalty: float = 5.0, l2: float = 3e-4, steps: int = 300) -> Model:
    """Fits a model to rows: the places in ``names`` of a text's features, of what each counterfactual loses and of what it gains.

    The loss is the mean logistic loss, plus ``l2``, plus ``penalty`` times the mean squared change
    of the logit when a row's identity terms are swapped for others of their group, the neutral one
    included. A row without such terms gets one: a neutral mention shouldn't change its score either,
    whatever features it shares with words of the corpus. A change is made by the features that
    differ, so only these are held for a counterfactual.
    """
    size = len(names)

    def flat(parts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(parts), dtype=np.int32), [len(x) for x in parts]), np.concatenate([np.zeros(0, np.int32), *parts])

    own = [(labels[at : at + BLOCK], *flat([r[0] for r in rows[at : at + BLOCK]])) for at in range(0, len(rows), BLOCK)]
    pairs = [p for r in rows for p in r[1]]
    (lost_by, lost), (gained_by, gained) = flat([p[0] for p in pairs]), flat([p[1] for p in pairs])
    by, differs, sign = np.concatenate([lost_by, gained_by]), np.concatenate([lost, gained]), np.repeat([1.0, -1.0], [len(lost), len(gained)])
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        g = np.append(2 * l2 * w, 0.0)
        for y, row, col in own:
            z = np.bincount(row, w[col], minlength=len(y))
            err = (1 / (1 + np.exp(-np.clip(z + b, -30, 30))) - y) / len(rows)
            g[:-1] += np.bincount(col, err[row], minlength=size)
            g[-1] += err.sum()
        if pairs:
            change = np.bincount(by, sign * w[differs], minlength=len(pairs)) * (2 * penalty / len(pairs))
            g[:-1] += np.bincount(differs, sign * change[by], minlength=size)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return Model({int(f): float(x) for f, x in zip(names, w) if abs(x) > 1e-3}, float(b))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


_EXAMPLE = "struct<own:{0},pairs:array<struct<lost:{0},gained:{0}>>>"


def _examples(rows: Iterable[tuple[np.ndarray, Sequence[tuple[np.ndarray, np.ndarray]]]], kind: pa.DataType, part: Callable[[np.ndarray], object]) -> pa.Array:
    of = lambda p: {"lost": part(p[0]), "gained": part(p[1])}
    return pa.array([{"own": part(own), "pairs": [of(p) for p in pairs]} for own, pairs in rows], pa.struct([("own", kind), ("pairs", pa.list_(pa.struct([("lost", kind), ("gained", kind)])))]))


def example_column(groups: Sequence[Sequence[str]]) -> Callable[[Column], Column]:
    """A column function: whole text -> its ``example``, ids as signed 32-bit integers."""

    @F.arrow_udf(_EXAMPLE.format("array<int>"))
    def examples(text: pa.Array) -> pa.Array:
        known = _Features()
        return _examples((example(WORDS.findall((t.as_py() or "").lower()), known, groups) for t in text), pa.list_(pa.int32()), lambda x: x.view(np.int32))

    return examples


def kept_column(names: np.ndarray) -> Callable[[Column], Column]:
    """A column function: an example -> the places of its features in ``names``, packed; others are left out."""

    @F.arrow_udf(_EXAMPLE.format("binary"))
    def kept(examples: pa.Array) -> pa.Array:
        ids = lambda x: np.array(x, np.int32).view(np.uint32)
        return _examples(((ids(e["own"]), [(ids(p["lost"]), ids(p["gained"])) for p in e["pairs"]]) for e in (x.as_py() for x in examples)), pa.binary(), lambda x: places(names, x).tobytes())

    return kept


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_per_class: int = MAX_PER_CLASS, groups: Sequence[Sequence[str]] = IDENTITY_GROUPS, least: int = LEAST, max_features: int = MAX_FEATURES, **how) -> Model:
    """Fits on at most ``max_per_class`` labelled rows of each class, first by hash of the id.

    Rows that ``held_out`` names and null labels are left out; of several labels of one id the
    largest counts. Features in at least ``least`` of the sampled rows whose rates differ between the
    labels by more than chance are kept (the ``max_features`` clearest), and those of identity terms.
    Executors count and choose them; only the kept features of the sampled rows reach the driver.
    """
    known = pick(labels, doc_id="doc_id", y=label_col).where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("y") > 0).cast("int").alias("y"))
    order = F.xxhash64(F.lit(5), "doc_id")
    first = lambda y: known.where(F.col("y") == y).orderBy(order, "doc_id").limit(max_per_class)
    sample = F.broadcast(first(0).unionByName(first(1)))  # at most 2 * max_per_class rows of 12 bytes
    rows = cut(pick(docs, doc_id=id_col, text=text_col).join(sample, "doc_id").select("doc_id", "y", example_column(groups)(F.col("text")).alias("x")))
    n_pos, n_all = rows.agg(F.coalesce(F.sum("y"), F.lit(0)), F.count("*")).first()
    if not 0 < n_pos < n_all:
        return base_rate(n_pos, n_all - n_pos)
    each = rows.select("y", F.explode("x.own").alias("f")).groupBy("f").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    z, term = clearness(F.col("a"), F.col("b"), n_pos, n_all - n_pos), F.col("id").isin(of_terms(groups))
    counted = each.select(F.col("f").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)).alias("id"), (F.col("a") + F.col("b")).alias("n"), z.alias("z"))
    counted = cut(counted.where((F.col("n") >= least) & ((F.col("z") > CLEAR) | term)))
    clear = counted.where(F.col("z") > CLEAR).orderBy(F.desc("z"), "id").limit(max_features)
    names = np.unique(np.array([r.id for r in clear.select("id").union(counted.where(term).select("id")).collect()], np.uint32))
    got = rows.select("doc_id", "y", kept_column(names)(F.col("x")).alias("x")).collect()
    got.sort(key=lambda r: (r.doc_id, bytes(r.x.own), [(bytes(p.lost), bytes(p.gained)) for p in r.x.pairs]))
    at = lambda raw: np.frombuffer(raw, np.int32)
    return solved(names, np.array([r.y for r in got], float), [(at(r.x.own), [(at(p.lost), at(p.gained)) for p in r.x.pairs]) for r in got], **how)


_scorers: dict[str, Callable[[str | None], float]] = {}


def score_column(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A column function: whole text -> score from 0 to 1."""
    sent = spark.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        if key not in _scorers:
            _scorers.clear()  # a worker holds one model at a time
            _scorers[key] = sent.value.scorer()
        of = _scorers[key]
        return pa.array([of(t.as_py()) for t in text], pa.float64())

    return score


def toxicity(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", threshold: float = THRESHOLD, **how) -> DataFrame:
    """Adds ``score`` and ``predicted`` (1 at ``threshold`` and above) to every row of ``docs``.

    Scores read the text only. Empty and null texts get the intercept's score; texts of any length
    are read whole; rows are independent, so repeated rows get equal scores; without labels of both
    kinds every row gets the base rate; an empty table gives an empty result; other columns pass through.
    """
    model = fit(docs, labels, text_col=text_col, **how)
    scored = added(docs, text_col, score=score_column(docs.sparkSession, model))
    return added(scored, "score", predicted=lambda s: (s >= threshold).cast("int"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents``, learned from ``labels`` outside the held-out part."""
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    return toxicity(docs, table(spark, sf_dir, "labels")).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

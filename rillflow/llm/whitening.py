"""Embedding whitening: components from spectra that partitions keep up to date row by row, refined over all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, pick, table
from .spectra import Spectrum

SCALE, OFFSET = 64, 1_000_000
FAN_IN = 16  # states that one task merges
RANK = 1e-10  # a component below this share of the largest eigenvalue has no spread to divide by
_STATE = "slot long, body array<double>"


def usable(rows: DataFrame, *, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, x``: vectors of finite entries as integers floor(64 c) + 1,000,000; all of the commonest length (ties: the longest)."""
    d = pick(rows, vec_id=id_col, v=vec_col).where("v is not null and size(v) > 0").withColumn("v", F.col("v").cast("array<double>"))
    d = d.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    d = d.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x"))
    lengths = d.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).agg(F.max_by("d", F.struct("n", "d")).alias("d"))
    return cut(d.join(F.broadcast(lengths.withColumnRenamed("d", "common")), F.size("x") == F.col("common")).drop("common"))  # a single row


def _ints(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def folded(rows: DataFrame, over: Callable[[Iterator[np.ndarray]], np.ndarray | None], merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """One small state of all rows: ``over`` makes one in each task, ``merge`` joins up to 16 of them, in order, round by round."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = over(_ints(b) for b in batches if b.num_rows)
        if state is not None:
            yield pa.record_batch([pa.array([state.ravel()], pa.list_(pa.float64()))], ["body"])

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slot")
        return pd.DataFrame({"slot": [int(pdf["slot"].iloc[0]) // FAN_IN], "body": [merge([np.array(b) for b in pdf["body"]]).ravel()]})

    states = cut(rows.select("x").mapInArrow(task, "body array<double>").withColumn("slot", F.spark_partition_id().cast("long")).select("slot", "body"))
    while states.count() > 1:  # a row per task, then a sixteenth of them each round
        states = cut(states.groupBy(F.floor(F.col("slot") / FAN_IN)).applyInPandas(together, _STATE))
    last = states.first()
    return None if last is None else np.array(last["body"])


@dataclass
class Whitening:
    """What a fit says: exact count and sums, components (columns) by falling eigenvalue, and the covariance's trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S is exact; only the division rounds."""
        return (self.n * x - self.sums) / self.n

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2, exact; null where 64 bits don't hold one."""
        off = self.n * x - self.sums
        if float(np.abs(off).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
            return (off * off).sum(1).tolist()
        exact = [sum(int(c) ** 2 for c in row) for row in off]
        return [v if v < 1 << 63 else None for v in exact]


def fitted(x: DataFrame, components: int = 32) -> Whitening | None:
    """The whitening of the rows ``x`` (integers): None without rows.

    Sums are exact, so every vector is centred before anything is multiplied. Each task adds its
    rows to a spectrum one by one (rank-one updates); spectra are joined by adding each other's
    scaled vectors, 16 at a time until one is left. Its basis then goes over all rows once more:
    the covariance in that basis is summed up, and its small eigenproblem turns the basis into the
    components (Rayleigh-Ritz; the basis is complete, so they are exact to double precision).
    The driver sees states of d x d numbers only. Components without spread are left out.
    """

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for b in parts:
            n, total = n + b.num_rows, total + _ints(b).sum(0)
        if n:
            yield pa.record_batch([pa.array(range(-1, len(total)), pa.int32()), pa.array([n, *total.tolist()], pa.int64())], ["dim", "s"])

    by_dim = {r["dim"]: r["s"] for r in x.select("x").mapInArrow(sums, "dim int, s long").groupBy("dim").agg(F.sum("s").alias("s")).collect()}  # d + 1 rows
    if not by_dim:
        return None
    n, d = by_dim[-1], len(by_dim) - 1
    base = Whitening(n, np.array([by_dim[i] for i in range(d)], dtype=np.int64), np.eye(d), np.ones(d), 0.0)

    def spectrum(parts: Iterator[np.ndarray]) -> np.ndarray | None:
        s = None
        for p in parts:
            s = s or Spectrum(d)
            for v in base.centred(p):
                s.add(v)
        return None if s is None else np.vstack([s.values, s.vectors])

    def combined(states: list[np.ndarray]) -> np.ndarray:
        s = Spectrum(d)
        first, *rest = [b.reshape(d + 1, d) for b in states]
        s.values, s.vectors = first[0], first[1:]
        for b in rest:
            s.merge(b[0], b[1:])
        return np.vstack([s.values, s.vectors])

    basis, _ = np.linalg.qr(folded(x, spectrum, combined).reshape(d + 1, d)[1:][:, ::-1])
    ritz = folded(x, lambda parts: _products(base.centred(p) @ basis for p in parts), lambda s: sum(s[1:], s[0])).reshape(d + 1, d)[1:] / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], basis @ turn[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(d)] < 0, -1.0, 1.0)
    held = int((values > RANK * max(values[0], 0)).sum())
    k = min(components, held)
    return Whitening(n, base.sums, vectors[:, :k], values[:k], float(values.sum()))


def _products(parts: Iterator[np.ndarray]) -> np.ndarray | None:
    """Sums of the rows y and, below, of their products y y^T."""
    out = None
    for y in parts:
        here = np.vstack([y.sum(0), y.T @ y])
        out = here if out is None else out + here
    return out


def identity_error(x: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""
    k = len(w.values)
    if not k:
        return 0.0
    s = folded(x, lambda parts: _products(w.apply(p) for p in parts), lambda s: sum(s[1:], s[0])).reshape(k + 1, k)
    mean = s[0] / w.n
    return float(np.abs(s[1:] / w.n - np.outer(mean, mean) - np.eye(k)).max())


_ROW = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 32) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each usable vector and component.

    Vectors that are null, empty, or hold null or non-finite entries are left out, and so are those
    of another length than most have. Repeated rows and ids count and come back as often as they
    stand; an empty table gives an empty result, and so do vectors without any spread, whose
    eigenvalues are all 0. A deviation that 64 bits can't hold is null. Equal eigenvalues leave
    their components' choice open; other columns are not looked at.
    """
    x = usable(rows, id_col=id_col, vec_col=vec_col)
    w = fitted(x, components)
    kind = x.schema["vec_id"].dataType.simpleString()
    if w is None or not len(w.values):
        return x.sparkSession.createDataFrame([], f"vec_id {kind}, {_ROW}")
    error, k = identity_error(x, w), len(w.values)
    shares = w.values / w.trace

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m, p = b.num_rows, _ints(b)
            each = np.repeat(np.arange(m), k)
            columns = {
                "vec_id": b.column("vec_id").take(pa.array(each)),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                "n": np.full(m * k, w.n, dtype=np.int64),
                "deviation": pa.array(w.deviation(p), pa.int64()).take(pa.array(each)),
                "whitened": w.apply(p).ravel(),
                "explained": np.tile(shares, m),
                "identity_error": np.full(m * k, error),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return x.mapInArrow(out, f"vec_id {kind}, {_ROW}")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings`` whitened to their first 32 components."""
    return whitened(table(spark, sf_dir, "embeddings"))

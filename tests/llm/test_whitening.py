"""Spectra against plain eigendecompositions; whole whitening against numpy over exact integers."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillflow.llm import spectra, whitening
from helpers import SF


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 12), st.integers(0, 30), st.sampled_from(["plain", "rounded", "same", "flat", "tiny", "repeated"]), st.integers(0, 2**32 - 1))
def test_spectrum(d, n, kind, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.exp(-3.0 * np.arange(d) * (kind == "tiny"))
    x = np.round(x) if kind == "rounded" else np.ones((n, d)) if kind == "same" else x[rng.integers(0, max(n, 1), n)] if kind == "repeated" else x
    x[:, d // 2 :] *= kind != "flat"
    s, t = spectra.Spectrum(d), spectra.Spectrum(d)
    for v in x[: n // 2]:
        s.add(v)
    for v in x[n // 2 :]:
        t.add(v)
    s.merge(t.values, t.vectors)
    want, scale = x.T @ x, max(1e-300, np.abs(x.T @ x).max(initial=0) * d)
    assert np.abs(s.vectors.T @ s.vectors - np.eye(d)).max() < 1e-11
    assert np.abs((s.vectors * s.values) @ s.vectors.T - want).max() <= 1e-12 * scale
    assert np.abs(s.values - np.linalg.eigvalsh(want)).max() <= 1e-12 * scale


def test_secular_roots_lie_between_poles():
    lam = np.array([0.0, 1e-9, 1.0, 1.0 + 1e-6, 5.0])
    new, q = spectra.secular(lam, np.array([1.0, -1e-3, 0.5, 2.0, 1e-4]))
    assert (new > lam).all() and (new[:-1] < lam[1:]).all() and np.abs(q.T @ q - np.eye(5)).max() < 1e-13


def check(rows, got, k=32):
    """``got`` against numpy: exact deviations, components up to their sign."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for _, v in kept], dtype=object)
    n, s = len(x), x.sum(0)
    off = n * x - s
    centred = off.astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, int((values > 1e-10 * values[0]).sum()))
    assert len(got) == n * k and {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] <= 1e-9
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    deviation = [int(v) for v in (off * off).sum(1)]
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append(r)
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
    seen = {}
    for (i, _), row, dev in zip(kept, want, deviation):
        mine = [r for r in by[i] if r["deviation"] == dev]
        assert len(mine) % k == 0 and mine
        for r in mine:
            seen.setdefault(r["component"], []).append((row[r["component"] - 1], r["whitened"]))
    for pairs in seen.values():
        a, b = np.array(pairs).T
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-7


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = whitening.op12_whitening(spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, got.collect())


def test_bad_rows_repeats_and_clashes(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [9, 5, 3, 1, 0.5]]) for i in range(90)]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [float("nan")] * 5), (903, [float("inf")] + [0.0] * 4), (904, [])]
    df = spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows + bad + [(None, rows[0][1])] * 40], "vec_id long, embedding array<double>, x double, n int").repartition(37)
    check(rows + [(None, rows[0][1])] * 40 + bad, whitening.whitened(df).collect())
    assert whitening.usable(spark.createDataFrame([(1, [1.0]), (2, [2.0, 1.0]), (3, [4.0, 4.0])], "vec_id long, embedding array<float>"), id_col="vec_id", vec_col="embedding").count() == 2


def test_no_rows_and_no_spread(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).count() == 0
    flat = [(i, [float(i % 7), 3.0, float(i % 7)]) for i in range(30)]
    check(flat, whitening.whitened(spark.createDataFrame(flat, schema)).collect())


def test_deviation_beyond_64_bits_is_null():
    w = whitening.Whitening(3 * 10**9, np.array([0, 0]), np.eye(2), np.ones(2), 2.0)
    assert w.deviation(np.array([[1, 1], [10**9, 0]])) == [2 * (3 * 10**9) ** 2 if 2 * (3 * 10**9) ** 2 < 1 << 63 else None, None]

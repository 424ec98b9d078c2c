"""Eigenvalues and eigenvectors of a sum of outer products, kept up to date one vector at a time."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
STEPS = 60  # of the root finder at most; it halves the bracket where its own step leaves it


class Spectrum:
    """``values`` (ascending) and ``vectors`` (columns) of sum v v^T over the vectors added so far."""

    def __init__(self, d: int):
        self.values, self.vectors = np.zeros(d), np.eye(d)

    def add(self, v: np.ndarray) -> None:
        """A rank-one update: deflate, solve the secular equation, rotate the vectors that change."""
        z = self.vectors.T @ v
        lam, norm2 = self.values, float(z @ z)
        if norm2 == 0:
            return
        tol = 8 * EPS * max(float(lam[-1]), norm2)
        live = z * z > tol * EPS  # a vector that v hardly touches stays
        self._merge_equal(z, live, tol)
        at = np.flatnonzero(live)
        if len(at):
            new, q = secular(lam[at], z[at])
            self.values = lam = lam.copy()
            lam[at] = new
            self.vectors[:, at] = self.vectors[:, at] @ q
        order = np.argsort(lam, kind="stable")
        if (np.diff(order) != 1).any():
            self.values, self.vectors = lam[order], self.vectors[:, order]

    def _merge_equal(self, z: np.ndarray, live: np.ndarray, tol: float) -> None:
        """Among (nearly) equal values all of z is turned into the last vector; the others then stay."""
        at = np.flatnonzero(live)
        for i, j in zip(at, at[1:]):
            if self.values[j] - self.values[i] <= tol:
                r = np.hypot(z[i], z[j])
                c, s = z[j] / r, z[i] / r
                u, w = self.vectors[:, i].copy(), self.vectors[:, j].copy()
                self.vectors[:, i], self.vectors[:, j] = c * u - s * w, s * u + c * w
                z[i], z[j], live[i] = 0.0, r, False

    def merge(self, values: np.ndarray, vectors: np.ndarray) -> None:
        """Another spectrum, as one rank-one update for each of its vectors."""
        for value, u in zip(values, vectors.T):
            if value > 0:
                self.add(np.sqrt(value) * u)


def secular(lam: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(``lam``) + z z^T (``lam`` strictly ascending, z without zeros) and its eigenvectors.

    The roots of 1 + sum z^2 / (lam - t), one above each pole, are found all at once as distances
    from the nearer pole; z is then taken anew from the roots, so the vectors are orthogonal.
    """
    m, z2 = len(lam), z * z
    width = np.append(np.diff(lam), z2.sum())
    poles = np.append(lam, lam[-1] + width[-1])
    i = np.arange(m)
    middle = lam + width / 2
    right = 1 + (z2[None, :] / (lam[None, :] - middle[:, None])).sum(1) < 0  # still below zero half way: the upper pole is nearer
    right[-1] = False
    origin = i + right
    gap = lam[None, :] - poles[origin][:, None]  # pole j seen from root i's origin
    low = np.where(right, -width / 2, 0.0)
    high = np.where(right, 0.0, width / 2)
    high[-1] = width[-1]
    x = (low + high) / 2
    below = i[None, :] <= i[:, None]
    a0, b0 = lam - poles[origin], poles[i + 1] - poles[origin]  # the poles around each root
    for _ in range(STEPS):
        delta = gap - x[:, None]
        term = z2[None, :] / delta
        slope = term / delta
        f = 1 + term.sum(1)
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        psi = np.where(below, slope, 0.0).sum(1)
        phi = slope.sum(1) - psi
        da, db = a0 - x, b0 - x
        c = f - da * psi - db * phi
        a = (da + db) * f - da * db * (psi + phi)
        b = da * db * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        to = x + step
        half = (low + high) / 2
        to = np.where((to > low) & (to < high), to, half)
        done = (np.abs(f) <= EPS * m * (1 + np.abs(term).sum(1))) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        x = np.where(done, x, to)
        if done.all():
            break
    away = gap - x[:, None]  # lam_j - root_i
    # z_j^2 is the product of (root_k - lam_j) over all roots by that of (lam_k - lam_j) over the other poles;
    # each root goes with the pole below it (k < j) or above it, so nothing overflows.
    with_pole = np.append(lam, np.inf)[i[:, None] + below] - lam[None, :]
    with_pole[-1] = 1.0
    ratio = -away / with_pole
    zhat = np.copysign(np.sqrt(np.abs(ratio.prod(0))), z)
    q = zhat[:, None] / away.T
    q /= np.linalg.norm(q, axis=0)
    return poles[origin] + x, q
